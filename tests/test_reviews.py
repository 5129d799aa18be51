import random

import pytest
from clock import at
from pyspark.sql import functions as F

from tallyloom import schema as S
from tallyloom.operators import documents as doc
from tallyloom.operators import metrics as mx
from tallyloom.operators import parse, reviews

POS, NEG, NEU = S.SENTIMENTS


def tables(spark, left, right):
    """Reviews ``(job, review, second)`` and analyses ``(job, review, second, label)``."""
    t = spark.createDataFrame(
        [(j, r, at(s), float(i % 5)) for i, (j, r, s) in enumerate(left)],
        "job_id string, review_id string, ts timestamp, rating double",
    )
    a = spark.createDataFrame(
        [(j, r, at(s), label, f"n{i}") for i, (j, r, s, label) in enumerate(right)],
        "job_id string, review_id string, ts timestamp, sentiment string, summary string",
    )
    return t, a


def pairs(left, right, within=90):
    return [(t, a) for t in left for a in right if t[:2] == a[:2] and abs(t[2] - a[2]) <= within]


def test_interval_ends_are_included(spark):
    for gap, met in ((90, 1), (-90, 1), (90.001, 0), (-90.001, 0), (91, 0), (0, 1)):
        t, a = tables(spark, [("j", "r", 0)], [("j", "r", gap, POS)])
        assert reviews.join_reviews(t, a).count() == met, gap
        assert reviews.match_counts(t, a).agg(F.sum("matches")).first()[0] == met, gap


def test_other_keys_do_not_meet(spark):
    t, a = tables(spark, [("j", "r", 0), ("", "", 0)], [("j", "s", 0, POS), ("k", "r", 0, POS), ("", "", 5, NEG)])
    assert reviews.join_reviews(t, a).count() == 0  # rows without review id have nothing in common
    literal = reviews.join_reviews(t, a, pair_missing_ids=True)
    assert [(r.job_id, r.sentiment) for r in literal.collect()] == [("", NEG)]


def test_reviews_without_id_make_no_pairs(spark):
    t, a = tables(spark, [("j", "", i % 50) for i in range(400)] + [("j", "r", 0)], [("j", "", i % 50, POS) for i in range(400)])
    assert reviews.join_reviews(t, a).count() == 0
    row = mx.join_drop_rate(t, a).first()
    assert (row.reviews, row.dropped, row.without_id) == (401, 401, 400)
    counts = reviews.match_counts(t, a, pair_missing_ids=True).agg(F.sum(F.col("reviews") * F.col("matches"))).first()[0]
    assert counts == 160_000 == reviews.join_reviews(t, a, pair_missing_ids=True).count()


@pytest.mark.parametrize("slice_seconds", [7, 90, 600, 100_000])
def test_join_equals_brute_force(spark, slice_seconds):
    rng = random.Random(slice_seconds)
    # one review holds a third of all rows
    key = lambda: ("hot", "r") if rng.random() < 0.34 else (f"j{rng.randrange(3)}", f"r{rng.randrange(8)}")
    left = [(*key(), rng.choice([rng.randrange(0, 1500), rng.random() * 1500])) for _ in range(150)]
    right = [(*key(), rng.choice([rng.randrange(0, 1500), rng.random() * 1500]), rng.choice([POS, NEG, NEU, None]))
             for _ in range(150)]
    left = [(j, r, round(s, 3)) for j, r, s in left]
    right = [(j, r, round(s, 3), x) for j, r, s, x in right]
    t, a = tables(spark, left, right)
    want = pairs(left, right)
    got = reviews.join_reviews(t, a, slice_seconds=slice_seconds)
    assert sorted((r.job_id, r.review_id, r.ts, r.analysis_ts) for r in got.collect()) == sorted(
        (x[0], x[1], at(x[2]).replace(tzinfo=None), at(y[2]).replace(tzinfo=None)) for x, y in want)

    stats = {r.job_id: r for r in doc.joined_job_stats(t, a, slice_seconds=slice_seconds).collect()}
    rating = {i: float(i % 5) for i in range(len(left))}
    for job in {x[0] for x, _ in want}:
        mine = [(i, x, y) for i, x in enumerate(left) for y in right if (x, y) in set(want) and x[0] == job and x[:2] == y[:2]]
        s = stats[job]
        assert s.joined_rows == len(mine)
        assert s.positive == sum(y[3] == POS for _, _, y in mine)
        assert s.avg_rating == pytest.approx(sum(rating[i] for i, _, _ in mine) / len(mine))
        assert s.avg_lag_seconds == pytest.approx(sum(y[2] - x[2] for _, x, y in mine) / len(mine), abs=1e-6)
    drops = {r.job_id: r.dropped for r in mx.join_drop_rate(t, a, slice_seconds=slice_seconds).collect()}
    for job in drops:
        assert drops[job] == sum(x[0] == job and not any(p[0] == x for p in want) for x in left)


def test_joined_rows_have_all_columns_in_order(messages):
    t = parse.parse_transform(
        messages({"job_id": "j", "review_id": "r", "rating": 3, "is_valid": True, "keywords": {"k": "v"}}), S.PASS_THROUGH)
    a = parse.flatten_analysis(messages({"results": [{"job_id": "j", "review_id": "r", "summary": "s"}]}))
    rows = reviews.joined_rows(reviews.join_reviews(t, a))
    assert rows.columns == list(S.JOINED_COLUMNS)
    row = rows.withColumn("keywords", F.to_json("keywords")).first()
    assert (row.keywords, row.is_valid, row.summary, row.sentiment, row.tag if "tag" in row else None) == (
        '{"k":"v"}', 1, "s", None, None)


def test_latest_wins_whatever_the_input_order(spark):
    rows = [("j", f"r{i % 4}", at(i % 7), i) for i in range(40)]
    want = {}
    for row in sorted(rows, key=lambda r: (r[2], r[3])):
        want[row[1]] = row[3]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "job_id string, review_id string, ts timestamp, n int").repartition(3)
        got = reviews.latest_review(df, ("ts", "n")).collect()
        assert {r.review_id: r.n for r in got} == want
