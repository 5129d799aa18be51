"""From arrival to aggregate: when a job's results became complete, and how long
the messages behind them had been there by then."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators import control as ct

# Upper bounds of the latency histogram, in seconds.
LATENCY_BOUNDS = (60, 3_600, 86_400, 604_800)


def reached_at(rows: DataFrame, expected: DataFrame) -> DataFrame:
    """``(job_id, reached_at)``: when each job's distinct reviews came to its expected count.

    Jobs that expect nothing or too much are absent. Arrivals are counted by
    job and minute first, and only those of the minute in which the count is
    reached are ranked, so no task orders all reviews of a job.
    """
    first = rows.groupBy("job_id", "review_id").agg(F.min("ts").alias("ts"))
    first = first.withColumn("minute", F.date_trunc("minute", "ts"))
    minutes = first.groupBy("job_id", "minute").agg(F.count(F.lit(1)).alias("n"))
    so_far = F.sum("n").over(Window.partitionBy("job_id").orderBy("minute"))
    goals = expected.select("job_id", "expected_count")
    passed = minutes.withColumn("_after", so_far).join(goals, "job_id")
    passed = passed.filter((F.col("_after") - F.col("n") < F.col("expected_count")) & (F.col("expected_count") <= F.col("_after")))
    passed = passed.select("job_id", "minute", (F.col("expected_count") - F.col("_after") + F.col("n")).alias("_place"))
    place = F.row_number().over(Window.partitionBy("job_id").orderBy("ts", "review_id"))
    ranked = first.join(passed, ["job_id", "minute"]).withColumn("_at", place)
    return ranked.filter(F.col("_at") == F.col("_place")).select("job_id", F.col("ts").alias("reached_at"))


def done_events(transform: DataFrame, analysis: DataFrame, control: DataFrame) -> DataFrame:
    """``(job_id, done_at)``: the moment from which a job was collected and both sides had come to its expected count."""
    expected = ct.expected_counts(control)
    done = expected.filter(F.col("expected_count") <= 0).select("job_id", "collected_at")
    sides = [reached_at(rows, expected).withColumnRenamed("reached_at", name) for rows, name in ((transform, "_t"), (analysis, "_a"))]
    both = expected.join(sides[0], "job_id").join(sides[1], "job_id")
    both = both.select("job_id", F.greatest("collected_at", "_t", "_a").alias("done_at"))
    # nothing expected is reached by the first row of either side, as in the ledger
    some = [rows.groupBy("job_id").agg(F.min("ts").alias(name)) for rows, name in ((transform, "_t"), (analysis, "_a"))]
    none = done.join(some[0], "job_id").join(some[1], "job_id")
    return both.union(none.select("job_id", F.greatest("collected_at", "_t", "_a").alias("done_at")))


def arrivals(transform: DataFrame, analysis: DataFrame) -> DataFrame:
    """``(job_id, ts)`` of every message row of either side, copies included."""
    return transform.select("job_id", "ts").union(analysis.select("job_id", "ts"))


def aggregate_latency(
    rows: DataFrame, done: DataFrame, lifetime: str, window: str = "1 hour", bounds: Sequence[int] = LATENCY_BOUNDS
) -> DataFrame:
    """Per job and window of its done event: rows that were there by then, and how long they had waited.

    ``rows`` have ``(job_id, ts)``, ``done`` has ``(job_id, done_at)``. A row
    counts for a done event of its job up to ``lifetime`` after it. Streams need
    watermarks on ``ts`` and ``done_at``; state then spans ``lifetime``, and append
    mode emits a window once no row of either stream can change it.
    """
    events = done.select(F.col("job_id").alias("_job"), "done_at")
    behind = (F.col("ts") <= F.col("done_at")) & (F.col("ts") > F.col("done_at") - F.expr(f"INTERVAL {lifetime}"))
    met = rows.join(events, (F.col("job_id") == F.col("_job")) & behind)
    waited = F.unix_micros("done_at") - F.unix_micros("ts")
    seconds = lambda micros: micros / F.lit(1_000_000.0)
    share = lambda bound: F.count_if(F.col("_waited") <= bound * 1_000_000) / F.count(F.lit(1))
    return (
        met.withColumn("_waited", waited)
        .groupBy(F.window("done_at", window).alias("_w"), "job_id")
        .agg(
            F.count(F.lit(1)).alias("arrivals"),
            seconds(F.sum("_waited")).alias("seconds"),
            seconds(F.min("_waited")).alias("shortest"),
            seconds(F.max("_waited")).alias("longest"),
            *[share(bound).alias(f"within_{bound}") for bound in bounds],
        )
        .select("job_id", F.col("_w.start").alias("window_start"), "arrivals", "seconds", "shortest", "longest", *[f"within_{b}" for b in bounds])
    )
