"""Steps are told once when their limit passes, also while no message comes."""

from clock import at
from pyspark.sql import functions as F

from tallyloom.operators import control as ct
from tallyloom.operators import reviews
from tallyloom.sources import sinks
from tallyloom.streaming import timers

MINUTE = 60
LEDGER = "job_id string, expected_count bigint, collected_at timestamp, transform_count bigint, analysis_count bigint"


class Feed:
    def __init__(self, spark, path):
        self.spark, self.path, self.progress = spark, path, None
        spark.createDataFrame([], timers.UPDATE_LAYOUT).write.parquet(f"{path}/updates")
        spark.createDataFrame([], "at timestamp").write.parquet(f"{path}/clock")

    def run(self, seconds, *jobs):
        """Updates at a moment, the clock going on to it; all steps told so far."""
        if jobs:
            rows = ct.with_done_flags(self.spark.createDataFrame(jobs, LEDGER)).withColumn("at", F.lit(at(seconds)))
            rows.write.mode("append").parquet(f"{self.path}/updates")
        self.spark.createDataFrame([(at(seconds),)], "at timestamp").write.mode("append").parquet(f"{self.path}/clock")
        read = self.spark.readStream.schema
        told = timers.step_timeouts(read(timers.UPDATE_LAYOUT).parquet(f"{self.path}/updates"), read("at timestamp").parquet(f"{self.path}/clock"))
        query = sinks.run_available(sinks.append(told, f"{self.path}/rows", f"{self.path}/checkpoint"))
        self.progress = query.recentProgress
        return sorted((r["job_id"], r["step"], r["actual_count"]) for r in self.spark.read.parquet(f"{self.path}/rows").collect())


def test_limits_pass_while_no_message_comes(spark, tmp_path):
    feed = Feed(spark, str(tmp_path))
    assert feed.run(0, ("a", 5, at(0), 3, None), ("b", 5, at(0), 5, 5)) == []
    assert feed.run(15 * MINUTE - 0.001) == []
    first = [("a", "aggregation", 0)]
    assert feed.run(15 * MINUTE) == first  # a limit that is just reached has passed
    # the transform step is done in time, the other is not
    assert feed.run(20 * MINUTE, ("a", 5, at(0), 5, 2)) == first
    assert feed.run(40 * MINUTE) == first
    second = sorted([*first, ("a", "analysis", 2)])
    assert feed.run(50 * MINUTE) == second
    # told once, also after a late update and much later
    assert feed.run(60 * MINUTE, ("a", 5, at(0), 5, 3)) == second
    assert feed.run(9 * 24 * 60 * MINUTE) == second
    assert feed.progress[-1].stateOperators[0].numRowsTotal <= 1  # the jobs are forgotten


def test_agrees_with_the_batch_form(spark, tmp_path):
    jobs = [(f"j{i}", 4, at(i * 7 * MINUTE), i % 6, (i * 3) % 7) for i in range(12)]
    now = 70 * MINUTE
    ledger = ct.with_done_flags(spark.createDataFrame(jobs, LEDGER))
    want = sorted((r["job_id"], r["step"], r["actual_count"]) for r in ct.step_timeouts(ledger, F.lit(at(now))).collect())
    # overdue jobs that are first heard of at the end are told in the same run
    assert want and Feed(spark, str(tmp_path)).run(now, *jobs) == want


def test_timers_in_the_default_state_store(spark, tmp_path):
    """A session without this package's settings keeps state in Spark's default store."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        feed = Feed(spark, str(tmp_path))
        assert feed.run(0, ("a", 5, at(0), 3, None), ("b", 5, at(0), 5, 5)) == []
        assert feed.run(50 * MINUTE) == [("a", "aggregation", 0), ("a", "analysis", 0), ("a", "transform", 3)]
    finally:
        spark.conf.set(name, before)


def test_updates_in_any_order_of_one_batch(spark, tmp_path):
    feed = Feed(spark, str(tmp_path))
    done, undone = ("a", 1, at(0), 1, 1), ("a", 1, at(0), 1, None)
    assert feed.run(16 * MINUTE, done, undone) == []


def test_one_review_lies_in_many_state_partitions(spark, tmp_path):
    """A much repeated review is joined in as many tasks as its time has slices."""
    times = [(at(i * 700),) for i in range(40)]
    copies = spark.createDataFrame(times, "ts timestamp").select(F.lit("j").alias("job_id"), F.lit("r").alias("review_id"), "ts")
    for name in ("t", "a"):
        copies.write.parquet(f"{tmp_path}/{name}")
    stream = lambda name: spark.readStream.schema(copies.schema).parquet(f"{tmp_path}/{name}").withWatermark("ts", "1 day")
    joined = reviews.join_reviews(stream("t"), stream("a")).withColumn("task", F.spark_partition_id())
    sinks.run_available(sinks.append(joined, f"{tmp_path}/rows", f"{tmp_path}/cp"))
    rows = spark.read.parquet(f"{tmp_path}/rows")
    assert rows.count() == 40 and rows.select("task").distinct().count() > 1
