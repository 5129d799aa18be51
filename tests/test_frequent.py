"""Frequent keywords from bounded summaries equal the full count."""

import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import keywords as kw


def reviews(spark, names):
    rows = [(job, f"r{i}", f'{{"{name}": "x"}}') for i, (job, name) in enumerate(names)]
    df = spark.createDataFrame(rows, "job_id string, review_id string, text string")
    return df.select(
        "job_id", "review_id", F.timestamp_seconds(F.lit(1_700_000_000)).alias("ts"), F.lit(False).alias("empty"),
        F.parse_json("text").alias("keywords"), (F.crc32("review_id") % 5).alias("part"),
    )


def summaries(rows, tracked):
    return kw.merged_summaries(kw.keyword_summaries(rows, F.col("part"), tracked=tracked), "job_id", tracked=tracked)


def both(rows, tracked, k=3):
    flat = lambda df: sorted(map(tuple, df.select("job_id", "keyword", "total", "keyword_rank").collect()))
    return flat(kw.frequent_keywords(rows, summaries(rows, tracked), k, tracked)), flat(kw.top_keywords(rows, k))


@pytest.mark.parametrize("tracked", [8, 64])
def test_equal_to_the_full_count(spark, tracked):
    rng = random.Random(3)
    heavy = [("heavy", f"k{int(rng.paretovariate(1.1)) % 400}") for _ in range(3_000)]
    flat = [("flat", f"k{i % 300}") for i in range(900)]  # no keyword stands out, the summary settles nothing
    few = [("few", "a"), ("few", "b"), ("few", "a")]
    got, want = both(reviews(spark, heavy + flat + few), tracked)
    assert got == want and {r[0] for r in want} == {"heavy", "flat", "few"}


def test_size_does_not_grow_with_the_keywords(spark):
    size = lambda n: summaries(
        reviews(spark, [("j", f"keyword-{i:06d}") for i in range(n)]), 64).select(F.length("summary.sketch")).first()[0]
    assert size(20_000) <= 2 * size(64)


def test_left_out_keywords_are_under_the_bound(spark):
    rng = random.Random(5)
    names = [("j", f"k{int(rng.paretovariate(0.8)) % 3000}") for _ in range(20_000)]
    rows = reviews(spark, names)
    found = kw.frequent_candidates(summaries(rows, 64), 64).collect()
    exact = {}
    for _, name in names:
        exact[name] = exact.get(name, 0) + 1
    kept = {r["keyword"] for r in found}
    assert found and max(n for name, n in exact.items() if name not in kept) <= found[0]["missed"]
