"""Job completion: distinct counts against expected counts, and the messages
that follow from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom import schema as S
from tallyloom.functions import scalars as sc
from tallyloom.operators.reviews import latest_by_key

WORKER = "tallyloom-worker"
SERVER = "tallyloom"


# --- predicates and projections on parsed control messages


def is_collection_done() -> Column:
    return (F.col("step") == "collection") & (F.col("status") == "done")


def collection_done(control: DataFrame) -> DataFrame:
    return control.filter(is_collection_done())


def step_done(control: DataFrame) -> DataFrame:
    return control.filter(F.col("step").isin("transform", "analysis") & (F.col("status") == "done"))


def expected_counts(control: DataFrame) -> DataFrame:
    """The expected count of each job's last collection-done message."""
    return latest_by_key(
        collection_done(control).select("job_id", "ts", "expected_count"),
        ["job_id"],
        ["ts", "expected_count"],
    ).select("job_id", "expected_count", F.col("ts").alias("collected_at"))


def job_step_status(control: DataFrame, step: str, status: str = "done") -> DataFrame:
    """Jobs with a message of this step and status: the wait condition of a
    scheduler. Pass ``status='failed'`` for the failure branch."""
    return control.filter((F.col("step") == step) & (F.col("status") == status)).select("job_id").distinct()


def step_completion(control: DataFrame) -> DataFrame:
    """Which of the two parallel steps each job has finished."""
    done = step_done(control).groupBy("job_id").agg(
        F.bool_or(F.col("step") == "transform").alias("transform_done"),
        F.bool_or(F.col("step") == "analysis").alias("analysis_done"),
    )
    return done.withColumn("both_done", F.col("transform_done") & F.col("analysis_done"))


def step_verdict(control: DataFrame) -> DataFrame:
    """Data-quality rule on each message: a required field missing or the two
    counts differing makes the step failed.

    ``control`` carries ``is_valid`` from ``valid_control``, since the parsed
    fields have defaults and no longer tell whether they were there.
    """
    reason = F.when(~F.col("is_valid"), F.lit("missing field")).when(
        F.col("expected_count") != F.col("actual_count"), F.lit("count mismatch")
    )
    return control.withColumn("reason", reason).withColumn(
        "verdict", F.when(F.col("reason").isNotNull(), F.lit("failed")).otherwise(F.col("status"))
    )


# --- counts


def distinct_counts(rows: DataFrame) -> DataFrame:
    """Distinct reviews per job. Copies collapse map-side under the two-column
    key first, so a hot job is spread over all tasks before it is counted."""
    return rows.select("job_id", "review_id").distinct().groupBy("job_id").agg(F.count(F.lit(1)).alias("n"))


def approx_distinct_counts(rows: DataFrame, rsd: float = 0.02) -> DataFrame:
    """The sketch form of ``distinct_counts``: one small state per job and task
    instead of a shuffle of all ids, at a relative error of ``rsd``."""
    return rows.groupBy("job_id").agg(F.approx_count_distinct("review_id", rsd).alias("n"))


def review_sketches(rows: DataFrame, window: str = "1 hour", lg_entries: int = 12) -> DataFrame:
    """``(job_id, window_start, sketch)``: a set sketch of the reviews of each job and window.

    Sketches of windows unite to those of ranges, and those of two sides
    intersect. Up to ``2**lg_entries`` distinct reviews are counted exactly,
    more at a relative error of about ``2**(-lg_entries / 2)``.
    """
    sketches = rows.groupBy("job_id", F.window("ts", window).alias("_w")).agg(F.theta_sketch_agg("review_id", lg_entries).alias("sketch"))
    return sketches.select("job_id", F.col("_w.start").alias("window_start"), "sketch")


def reviews_on_both_sides(transform: DataFrame, analysis: DataFrame, lg_entries: int = 12) -> DataFrame:
    """``(job_id, transform_count, analysis_count, both_count)`` from the ``review_sketches`` of the two sides, no id read again."""
    united = lambda side, name: side.groupBy("job_id").agg(F.theta_union_agg("sketch", lg_entries).alias(name))
    sides = united(transform, "_t").join(united(analysis, "_a"), "job_id")
    count = F.theta_sketch_estimate
    return sides.select(
        "job_id", count("_t").alias("transform_count"), count("_a").alias("analysis_count"), count(F.theta_intersection("_t", "_a")).alias("both_count")
    )


def array_counts(messages: DataFrame, array: str, value: str = "value") -> DataFrame:
    """Elements of a named array per job, over all messages."""
    parsed = F.from_json(F.col(value), f"job_id string, `{array}` array<variant>")
    return (
        messages.select(parsed.alias("_m"))
        .select(
            sc.job_id_or_unknown(F.col("_m.job_id")).alias("job_id"),
            F.coalesce(F.array_size(F.col("_m")[array]), F.lit(0)).alias("_n"),
        )
        .groupBy("job_id")
        .agg(F.sum("_n").alias("n"))
    )


def hourly_counts(rows: DataFrame, window: str = S.COUNT_WINDOW, ts: str = "ts") -> DataFrame:
    """Rows per job and tumbling window. On a stream, set the watermark to the
    grace period: append mode then emits each window once, when it closes."""
    return (
        rows.groupBy(F.window(ts, window).alias("_w"), "job_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("job_id", F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "n")
    )


def closed_windows(counts: DataFrame, newest: Column, grace: str = S.COUNT_GRACE) -> DataFrame:
    """The windows a stream would have closed after seeing an event at ``newest``."""
    return counts.filter(F.col("window_end") <= newest - F.expr(f"INTERVAL '{grace}'"))


def hours_asked(control: DataFrame) -> DataFrame:
    """``(job_id, collected_at, expected_count, window_start)``: for each collection-done message the hour windows
    starting within the hour up to it. Windows start on whole hours, so these are one or two."""
    asked = collection_done(control).select("job_id", F.col("ts").alias("collected_at"), "expected_count")
    last = F.date_trunc("hour", F.col("collected_at"))
    first = F.when(F.col("collected_at") == last, last - F.expr("INTERVAL 1 HOUR")).otherwise(last)
    return asked.withColumn("window_start", F.explode(F.sequence(first, last, F.expr("INTERVAL 1 HOUR"))))


def counts_at_collection(control: DataFrame, transform_hours: DataFrame, analysis_hours: DataFrame) -> DataFrame:
    """For each collection-done message, what both sides counted in the hour
    windows starting within the hour up to the message. An equi-join by hour.
    """
    hours = hours_asked(control).distinct()
    side = lambda df, name: df.select("job_id", "window_start", F.col("n").alias(name))
    keys = ["job_id", "window_start"]
    return (
        hours.join(side(transform_hours, "_t"), keys, "left")
        .join(side(analysis_hours, "_a"), keys, "left")
        .groupBy("job_id", "collected_at", "expected_count")
        .agg(
            F.coalesce(F.sum("_t"), F.lit(0)).alias("transform_count"),
            F.coalesce(F.sum("_a"), F.lit(0)).alias("analysis_count"),
        )
    )


# --- completion


def step_complete(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """Actual against expected count of one step. ``is_complete`` uses >=;
    ``exact_match`` is the stricter rule of equal counts."""
    n, want = F.col("n"), F.col("expected_count")
    return counts.join(expected, "job_id").select(
        "job_id",
        n.alias("actual_count"),
        "expected_count",
        (n >= want).alias("is_complete"),
        (n == want).alias("exact_match"),
    )


def min_counts(transform_counts: DataFrame, analysis_counts: DataFrame) -> DataFrame:
    t, a = transform_counts.withColumnRenamed("n", "_t"), analysis_counts.withColumnRenamed("n", "_a")
    return t.join(a, "job_id").select("job_id", F.least("_t", "_a").alias("n"))


def ledger(expected: DataFrame, transform_counts: DataFrame, analysis_counts: DataFrame) -> DataFrame:
    """One row per collected job with both counts and all three done flags.

    A side without a single review is not done, even when nothing was expected.
    All inputs are grouped by job already: the joins shuffle nothing more.
    """
    t, a = transform_counts.withColumnRenamed("n", "_t"), analysis_counts.withColumnRenamed("n", "_a")
    rows = expected.join(t, "job_id", "left").join(a, "job_id", "left")
    return with_done_flags(
        rows.withColumns({"transform_count": F.col("_t"), "analysis_count": F.col("_a")}).drop("_t", "_a")
    )


def with_done_flags(counted: DataFrame) -> DataFrame:
    want = F.col("expected_count")
    done = lambda name: F.coalesce(F.col(name) >= want, F.lit(False))
    return (
        counted.withColumns({"transform_done": done("transform_count"), "analysis_done": done("analysis_count")})
        .withColumn(
            "min_count",
            F.when(
                F.col("transform_count").isNotNull() & F.col("analysis_count").isNotNull(),
                F.least("transform_count", "analysis_count"),
            ),
        )
        .withColumn("aggregation_done", F.col("transform_done") & F.col("analysis_done") & done("min_count"))
    )


def aggregation_complete(job_ledger: DataFrame) -> DataFrame:
    return job_ledger.filter("aggregation_done").select(
        "job_id", "expected_count", F.col("min_count").alias("actual_count")
    )


# --- messages


def control_message(
    job_id: Column,
    step: Column,
    status: Column,
    expected: Column,
    actual: Column,
    ts: Column,
    error: Column | None = None,
    processing_time: Column | None = None,
    worker_id: str = WORKER,
    server_info: str = SERVER,
    stamp=sc.kst_iso,
) -> Column:
    """The control message as JSON text. ``stamp`` writes the time: ``kst_iso``
    for messages the jobs emit, ``utc_iso`` for those a client builds.

    Null fields are left out, so ``error_message`` shows only where it is set.
    """
    fields = [
        job_id.alias("job_id"),
        step.alias("step"),
        status.alias("status"),
        expected.alias("expected_count"),
        actual.alias("actual_count"),
        stamp(ts).alias("timestamp"),
        F.struct(
            (processing_time if processing_time is not None else F.lit(0.0)).alias("processing_time"),
            F.lit(worker_id).alias("worker_id"),
            F.concat(F.lit("batch-"), F.unix_millis(ts.cast("timestamp")).cast("string")).alias("batch_id"),
            F.lit(server_info).alias("server_info"),
        ).alias("metadata"),
    ]
    if error is not None:
        fields.append(error.alias("error_message"))
    return F.to_json(F.struct(*fields))


def done_message(step: str, job_id: Column, expected: Column, actual: Column, ts: Column, **more) -> Column:
    if step not in S.STEPS:
        raise ValueError(f"step must be one of {S.STEPS}, not {step!r}")
    return control_message(job_id, F.lit(step), F.lit("done"), expected, actual, ts, **more)


def failure_message(
    job_id: Column, step: Column, error: Column, expected: Column, actual: Column, ts: Column, **more
) -> Column:
    return control_message(job_id, step, F.lit("failed"), expected, actual, ts, error=error, **more)


def timeout_message(job_id: Column, step: Column, expected: Column, actual: Column, ts: Column, **more) -> Column:
    return control_message(
        job_id, step, F.lit("timeout"), expected, actual, ts, error=F.lit(S.TIMEOUT_TEXT), **more
    )


def encode_event(ts: Column) -> Column:
    """The JSON message of an event row; ``error_message`` shows on failure."""
    return control_message(
        F.col("job_id"), F.col("step"), F.col("status"), F.col("expected_count"), F.col("actual_count"), ts,
        error=F.when(F.col("status") != "done", F.lit(S.TIMEOUT_TEXT)),
    )


def _event(key_part: str, when: Column, step: str, status: str, actual: Column) -> Column:
    zero = F.lit(0).cast("bigint")
    return F.when(
        when,
        F.struct(
            sc.composite_key(F.col("job_id"), F.lit(key_part)).alias("event_key"),
            F.lit(step).alias("step"),
            F.lit(status).alias("status"),
            F.coalesce(actual, zero).alias("actual_count"),
        ),
    )


def control_events(
    job_ledger: DataFrame, as_of: Column | None = None, timeout_minutes: int = S.JOB_TIMEOUT_MINUTES
) -> DataFrame:
    """All messages a ledger row gives rise to, one row per job and step.

    Done messages of transform, analysis and aggregation; with ``as_of`` also
    the failure of jobs that are overdue. One pass over the ledger, so the
    counts behind it are computed once and not once per kind of message.
    """
    events = [
        _event("transform", F.col("transform_done"), "transform", "done", F.col("transform_count")),
        _event("analysis", F.col("analysis_done"), "analysis", "done", F.col("analysis_count")),
        _event("aggregation", F.col("aggregation_done"), "aggregation", "done", F.col("min_count")),
    ]
    if as_of is not None:
        events.append(
            _event("timeout", is_overdue(as_of, timeout_minutes), "aggregation", "failed", F.lit(None).cast("bigint"))
        )
    return job_ledger.select(
        "job_id", "expected_count", F.inline(F.array_compact(F.array(*events)))
    ).select("event_key", "job_id", "step", "status", "expected_count", "actual_count")


def ledger_events(
    job_ledger: DataFrame, as_of: Column | None = None, timeout_minutes: int = S.JOB_TIMEOUT_MINUTES
) -> DataFrame:
    """``control_events`` and, with ``as_of``, the steps that are past their own limit."""
    events = control_events(job_ledger, as_of, timeout_minutes)
    if as_of is None:
        return events
    key = sc.composite_key(F.col("job_id"), F.col("step"), F.col("status")).alias("event_key")
    return events.unionByName(step_timeouts(job_ledger, as_of).select(key, "*"))


def is_overdue(as_of: Column, timeout_minutes: int = S.JOB_TIMEOUT_MINUTES) -> Column:
    limit = F.lit(timeout_minutes * 60_000).cast("bigint")
    return ~F.col("aggregation_done") & sc.older_than(F.col("collected_at"), limit, as_of)


def job_timeouts(
    job_ledger: DataFrame, as_of: Column, timeout_minutes: int = S.JOB_TIMEOUT_MINUTES
) -> DataFrame:
    """Jobs collected at least ``timeout_minutes`` before ``as_of`` and not
    aggregated since: their aggregation has failed."""
    return control_events(job_ledger, as_of, timeout_minutes).filter("status = 'failed'")


def step_timeouts(job_ledger: DataFrame, as_of: Column) -> DataFrame:
    """Steps still open at ``as_of`` past their own limit, counted from the end
    of the collection."""
    steps = {
        "transform": ("transform_done", "transform_count"),
        "analysis": ("analysis_done", "analysis_count"),
        "aggregation": ("aggregation_done", "min_count"),
    }
    cells = F.array(
        *[
            F.struct(
                F.lit(step).alias("step"),
                F.col(flag).alias("_done"),
                F.coalesce(F.col(count), F.lit(0).cast("bigint")).alias("actual_count"),
            )
            for step, (flag, count) in steps.items()
        ]
    )
    rows = job_ledger.select("job_id", "expected_count", "collected_at", F.inline(cells))
    late = sc.older_than(F.col("collected_at"), sc.step_timeout(F.col("step")), as_of)
    return rows.filter(~F.col("_done") & late).select(
        "job_id", "step", F.lit("timeout").alias("status"), "expected_count", "actual_count"
    )
