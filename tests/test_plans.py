"""What the plans must look like, and what a hot key must not do."""

import re

import pytest
from clock import at
from pyspark.sql import functions as F

from __spark_entry__ import SMOKE_DIR
from tallyloom import session
from tallyloom.operators import control as ct
from tallyloom.operators import keywords as kw
from tallyloom.operators import parse, ratings, reviews
from tallyloom.plans import fixtures as fx
from tallyloom.plans.catalog import QUERIES

# The plan of a stream query is that of reading its sink.
BATCH = [name for name in QUERIES if not name.startswith("stream_")]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SMOKE_DIR))
    for node in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in plan, node


def test_each_message_is_parsed_once(spark):
    messages = fx.lineitem_messages(spark, SMOKE_DIR)
    for df in (ratings.transform_profile(parse.parse_transform(messages)),
               ct.distinct_counts(parse.parse_transform(messages)),
               parse.flatten_analysis(fx.analysis_messages(spark, SMOKE_DIR)),
               parse.quarantine(messages)):
        assert plan_of(df).count("from_json(") == 1


def test_unused_fields_are_not_parsed(spark):
    plan = plan_of(ratings.transform_profile(parse.parse_transform(fx.document_messages(spark, SMOKE_DIR))))
    fields = re.search(r"from_json\((.*?)value#", plan).group(1)
    assert "clean_text" not in fields and "keywords" not in fields


def test_scan_reads_needed_columns(spark):
    plan = plan_of(fx.lineitem_messages(spark, SMOKE_DIR).select("ts"))
    assert "ReadSchema: struct<l_shipdate:timestamp_ntz>" in plan


def test_ledger_joins_need_no_extra_shuffle(spark):
    counts = spark.createDataFrame([("j", "r", at(0), 1)], "job_id string, review_id string, ts timestamp, expected_count bigint")
    expected = ct.latest_by_key(counts.select("job_id", "ts", "expected_count"), ["job_id"], ["ts"]).select(
        "job_id", "expected_count", F.col("ts").alias("collected_at"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(ct.ledger(expected, ct.distinct_counts(counts), ct.distinct_counts(counts)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # one per aggregation: expected, and ids and jobs of each side
    assert plan.count("Exchange hashpartitioning") <= 5


def test_rows_are_never_broadcast(spark):
    """Rows parsed from a small file may be many; joins of them meet by sort and merge."""
    rows = parse.parse_transform(fx.transform_messages(spark, SMOKE_DIR), ("keywords",))
    analyses = parse.flatten_analysis(fx.analysis_messages(spark, SMOKE_DIR))
    summaries = kw.merged_summaries(kw.keyword_summaries(rows), "job_id")
    for made in (reviews.join_reviews(rows, analyses), kw.keyword_items(rows), kw.keyword_tags(rows), kw.frequent_keywords(rows, summaries)):
        plan = plan_of(made)
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_observations_are_counted_where_they_lie(spark):
    """The quantiles are broadcast, not the observations, whatever the threshold."""
    for threshold in ("-1", "100m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            plan = plan_of(QUERIES["duration_quantiles"](spark, SMOKE_DIR))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert "BuildLeft" in plan and "SortMergeJoin" not in plan


def test_top_keywords_prune_before_the_shuffle(spark):
    rows = parse.parse_transform(fx.transform_messages(spark, SMOKE_DIR), ("keywords",))
    assert "WindowGroupLimit" in plan_of(kw.top_keywords(rows))


def hot(spark, n=3000):
    """A third of all rows are copies of one review."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("j"), F.col("id") % 5)).alias("job_id"),
        F.when(F.col("id") % 3 == 0, "r").otherwise(F.col("id").cast("string")).alias("review_id"),
        (F.lit(at(0)) + F.col("id") * F.expr("INTERVAL 2 SECONDS")).alias("ts"),
        (F.col("id") % 11 / 2).alias("rating"),
        F.lit("긍정").alias("sentiment"),
        F.lit("x").alias("summary"),
    )


def test_copies_of_a_hot_review_spread_over_slices(spark):
    sliced = hot(spark).withColumn("s", reviews.slice_of(F.col("ts"), reviews.SLICE_SECONDS))
    sizes = sliced.groupBy("job_id", "review_id", "s").count().agg(F.max("count")).first()[0]
    assert sizes <= reviews.SLICE_SECONDS / 6 + 1  # one copy per six seconds, not the third of all rows
    joined = reviews.join_reviews(hot(spark), hot(spark)).groupBy("job_id").count()
    counted = reviews.match_counts(hot(spark), hot(spark)).groupBy("job_id").agg(
        F.sum(F.col("reviews") * F.col("matches")).alias("count"))
    assert sorted(joined.collect()) == sorted(counted.collect())


def test_shares_of_a_keyword_with_very_many_tags(spark):
    """The window partitions hold distinct counts, not tags."""
    counts = spark.range(20_000).select(
        F.lit("j").alias("job_id"), F.lit("k").alias("keyword"), F.col("id").cast("string").alias("tag"),
        (F.col("id") % 4 + 1).alias("n"))
    ladder = kw._ladder(counts, ["job_id", "keyword"])
    assert ladder.count() == 4
    assert {(r.n, r._rank, r._total) for r in ladder.collect()} == {
        (4, 1, 50_000), (3, 5_001, 50_000), (2, 10_001, 50_000), (1, 15_001, 50_000)}


def test_tags_of_one_keyword_are_joined_in_many_tasks(spark):
    counts = spark.range(200_000).select(
        F.lit("j").alias("job_id"), F.lit("k").alias("keyword"), F.col("id").cast("string").alias("tag"),
        F.lit(1).cast("bigint").alias("n"))
    settings = {"spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "200"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        shares = kw._ranked_shares(counts, ["job_id", "keyword"], lambda n, total: n / total)
        sizes = [r["count"] for r in shares.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 200_000 and len(sizes) >= kw.SALTS / 2 and max(sizes) < 60_000


class Cluster:
    """Just what ``work_dir`` asks a session for."""

    def __init__(self, **settings):
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: settings.get(key, default))})


def test_work_dir_is_shared(spark):
    shared = Cluster(**{"spark.checkpoint.dir": "hdfs:///work/"})
    assert session.work_dir(shared, "x").startswith("hdfs:///work/x-")
    assert session.work_dir(Cluster(**{"spark.sql.warehouse.dir": "hdfs:///tables"}), "x").startswith("hdfs:///tables/work/x-")
    assert session.work_dir(spark, "x") != session.work_dir(spark, "x")
