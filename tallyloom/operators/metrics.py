"""Operating figures over the control log and the review tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom import schema as S
from tallyloom.functions import scalars as sc
from tallyloom.operators import reviews

# Upper bounds of the duration histogram, in seconds.
DURATION_BOUNDS = (1, 5, 10, 30, 60, 120, 300, 600, 1800, 3600)


def control_metrics(control: DataFrame) -> DataFrame:
    return control.groupBy("step", "status").agg(F.count(F.lit(1)).alias("messages"))


def step_duration(control: DataFrame, bounds: Sequence[float] = DURATION_BOUNDS) -> DataFrame:
    """Processing times per step: count, sum and how many lie at or under each bound."""
    time = F.col("processing_time")
    return (
        control.filter(time.isNotNull())
        .groupBy("step")
        .agg(
            F.count(F.lit(1)).alias("observations"),
            F.sum(time).alias("seconds"),
            F.min(time).alias("shortest"),
            F.max(time).alias("longest"),
            *[F.count_if(time <= bound).alias(f"le_{bound}") for bound in bounds],
        )
    )


def duration_sketches(control: DataFrame, window: str = "1 hour", k: int = 200) -> DataFrame:
    """``(step, window_start, sketch)``: a quantile sketch of the processing times of each step and window.

    Stored as they are, sketches of any range merge to that of the range; ``k``
    sets their size, and with it the error of ranks (about 1.7 % at 200).
    """
    known = control.filter(F.col("processing_time").isNotNull() & F.col("step").isNotNull())
    sketches = known.groupBy("step", F.window("ts", window).alias("_w")).agg(F.kll_sketch_agg_double("processing_time", k).alias("sketch"))
    return sketches.select("step", F.col("_w.start").alias("window_start"), "sketch")


def duration_quantiles(sketches: DataFrame, ranks: Sequence[float] = (0.5, 0.9, 0.99)) -> DataFrame:
    """``(step, observations, rank, seconds)`` of all windows given, merged."""
    merged = sketches.groupBy("step").agg(F.kll_merge_agg_double("sketch").alias("_s"))
    found = [F.struct(F.lit(r).alias("rank"), F.kll_sketch_get_quantile_double("_s", F.lit(r)).alias("seconds")) for r in ranks]
    return merged.select("step", F.kll_sketch_get_n_double("_s").alias("observations"), F.inline(F.array(*found)))


def active_jobs(control: DataFrame, steps: Sequence[str] = S.STEPS) -> DataFrame:
    """Jobs per step that have done the step before and said nothing of this one."""
    seen = control.filter(F.col("step").isin(*steps)).groupBy("job_id").agg(
        *[F.bool_or(F.col("step") == s).alias(f"_any_{s}") for s in steps],
        *[F.bool_or((F.col("step") == s) & (F.col("status") == "done")).alias(f"_done_{s}") for s in steps],
    )
    counts = seen.agg(
        *[
            F.count_if(F.col(f"_done_{before}") & ~F.col(f"_any_{step}")).alias(step)
            for before, step in zip(steps, steps[1:])
        ]
    )
    cells = F.array(*[F.struct(F.lit(s).alias("step"), F.col(s).alias("jobs")) for s in steps[1:]])
    return counts.select(F.inline(cells))


def waiting_times(control: DataFrame, steps: Sequence[str] = S.STEPS) -> DataFrame:
    """``(job_id, step, started, ended)``: a job waits in a step from when the step before is first done until the
    first message about the step from then on; ``ended`` is null while there is none."""
    found = []
    for before, step in zip(steps, steps[1:]):
        started = control.filter((F.col("step") == before) & (F.col("status") == "done")).groupBy("job_id").agg(F.min("ts").alias("started"))
        told = control.filter(F.col("step") == step).select("job_id", "ts")
        met = started.join(told, "job_id", "left").groupBy("job_id", "started")
        ended = met.agg(F.min(F.when(F.col("ts") >= F.col("started"), F.col("ts"))).alias("ended"))
        found.append(ended.select("job_id", F.lit(step).alias("step"), "started", "ended"))
    return reduce(DataFrame.union, found)


def active_jobs_over_time(control: DataFrame, steps: Sequence[str] = S.STEPS, stretch: str = "month") -> DataFrame:
    """``(step, ts, active)``: how many jobs wait in a step from each instant on at which that number may change.

    A sweep over +1 at each start and -1 at each end. Changes of one instant
    become one row first. Running sums are taken within stretches of time, each
    on top of what the stretches before it leave, so no task sees a whole step.
    """
    waits = waiting_times(control, steps)
    change = lambda ts, by: waits.select("step", F.col(ts).alias("ts"), F.lit(by).cast("bigint").alias("by"))
    changes = change("started", 1).union(change("ended", -1)).filter(F.col("ts").isNotNull())
    instants = changes.groupBy("step", "ts").agg(F.sum("by").alias("by")).withColumn("_part", F.date_trunc(stretch, "ts"))
    parts = instants.groupBy("step", "_part").agg(F.sum("by").alias("_sum"))
    carried = F.sum("_sum").over(Window.partitionBy("step").orderBy("_part")) - F.col("_sum")
    parts = parts.select("step", "_part", carried.alias("_carried"))
    within = F.sum("by").over(Window.partitionBy("step", "_part").orderBy("ts"))
    return instants.join(parts, ["step", "_part"]).select("step", "ts", (F.col("_carried") + within).alias("active"))


def ops_metrics(rows: DataFrame, window: str = "1 hour", ts: str = "ts") -> DataFrame:
    """Reviews and reviews per second by window."""
    counts = rows.groupBy(F.window(ts, window).alias("_w")).agg(F.count(F.lit(1)).alias("reviews"))
    start, end = F.col("_w.start"), F.col("_w.end")
    seconds = (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000.0)
    return counts.select(
        start.alias("window_start"), "reviews", (F.col("reviews") / seconds).alias("reviews_per_second")
    )


def match_rate(control: DataFrame) -> DataFrame:
    """Per step: share of done, of failed or timed out, and of exact counts."""
    total = F.count(F.lit(1))
    share = lambda test: sc.pct(F.count_if(test), total)
    return control.groupBy("step").agg(
        total.alias("messages"),
        share(F.col("status") == "done").alias("completion_rate"),
        share(F.col("status") != "done").alias("failure_rate"),
        share(F.col("expected_count") == F.col("actual_count")).alias("match_rate"),
    )


def join_drop_rate(transform: DataFrame, analysis: DataFrame, **interval) -> DataFrame:
    """Per job: reviews without any analysis inside the join interval, and how
    many of them have no review id to be joined by."""
    per_review = reviews.match_counts(transform, analysis, **interval)
    dropped = F.sum(F.when(F.col("matches") == 0, F.col("reviews")).otherwise(F.lit(0)))
    return per_review.groupBy("job_id").agg(
        F.sum("reviews").alias("reviews"),
        dropped.alias("dropped"),
        F.sum(F.when(F.col("review_id") == "", F.col("reviews")).otherwise(F.lit(0))).alias("without_id"),
        sc.pct(dropped, F.sum("reviews")).alias("drop_rate"),
    )
