"""Streaming forms of the joins, counts and completion messages.

State is bounded by watermarks. Where a result needs every review id of a job
(distinct counts), ``lifetime`` says how long after a review's event time a
copy of it may still arrive; only ``lifetime=None`` keeps the ids for good.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tallyloom import schema as S
from tallyloom.functions import scalars as sc
from tallyloom.operators import control as ct
from tallyloom.operators import documents as doc
from tallyloom.operators import latency as lt
from tallyloom.operators import reviews
from tallyloom.sources import sinks

LEDGER_LAYOUT = """
  job_id string, expected_count bigint, collected_at timestamp, transform_count bigint, analysis_count bigint,
  transform_done boolean, analysis_done boolean, min_count bigint, aggregation_done boolean"""
KNOWN_LAYOUT = f"{LEDGER_LAYOUT}, told array<string>"
EVENT_LAYOUT = """
  event_key string, job_id string, step string, status string, expected_count bigint, actual_count bigint,
  message string"""


def join_reviews(transform: DataFrame, analysis: DataFrame, delay: str = "0 seconds", **interval) -> DataFrame:
    """The interval join; a row that comes more than ``delay`` late is dropped."""
    return reviews.join_reviews(
        transform.withWatermark("ts", delay), analysis.withWatermark("ts", delay), **interval
    )


def hourly_counts(rows: DataFrame, grace: str = S.COUNT_GRACE) -> DataFrame:
    """Append mode emits each window once, ``grace`` after its end."""
    return ct.hourly_counts(rows.withWatermark("ts", grace))


def once_per_key(rows: DataFrame, keys: list[str], lifetime: str | None) -> DataFrame:
    if lifetime is None:
        return rows.dropDuplicates(keys)
    return rows.withWatermark("ts", lifetime).dropDuplicatesWithinWatermark(keys)


def distinct_counts(rows: DataFrame, lifetime: str | None = S.JOB_LIFETIME) -> DataFrame:
    """Distinct reviews per job, for update mode."""
    ids = once_per_key(rows.select("job_id", "review_id", "ts"), ["job_id", "review_id"], lifetime)
    return ids.groupBy("job_id").agg(F.count(F.lit(1)).alias("n"))


def counts_at_collection(transform: DataFrame, analysis: DataFrame, control: DataFrame, grace: str = S.COUNT_GRACE) -> DataFrame:
    """For each collection-done message and hour it asks for, what both sides counted in that hour; append mode.

    A windowed count of both sides, then a join of its closed windows with the
    messages by job and window: two stateful operators under one watermark,
    which bounds the state of both. A row comes out once its window is closed; a
    window without rows counts zero. ``counts_of_messages`` adds up what has come out.
    """
    kind = lambda rows, is_transform: rows.select("job_id", "ts", F.lit(is_transform).alias("_t"))
    both = kind(transform, True).union(kind(analysis, False)).withWatermark("ts", grace)
    counts = both.groupBy(F.window("ts", S.COUNT_WINDOW).alias("_w"), F.col("job_id").alias("_job"))
    counts = counts.agg(F.count_if("_t").alias("_transform"), F.count_if(~F.col("_t")).alias("_analysis"))
    asked = ct.hours_asked(control).withWatermark("window_start", grace)
    asked = asked.select("job_id", "collected_at", "expected_count", F.window("window_start", S.COUNT_WINDOW).alias("_asked"))
    # the same message again asks for nothing new
    asked = asked.dropDuplicatesWithinWatermark(asked.columns)
    met = asked.join(counts, (F.col("job_id") == F.col("_job")) & (F.col("_asked") == F.col("_w")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return met.select(
        "job_id", "collected_at", "expected_count", F.col("_asked.start").alias("window_start"),
        zero("_transform").alias("transform_count"), zero("_analysis").alias("analysis_count"),
    )


def counts_of_messages(rows: DataFrame) -> DataFrame:
    """The written rows of ``counts_at_collection``, summed over the hours of each message."""
    return rows.groupBy("job_id", "collected_at", "expected_count").agg(
        F.sum("transform_count").alias("transform_count"), F.sum("analysis_count").alias("analysis_count")
    )


def aggregate_latency(arrivals: DataFrame, done: DataFrame, lifetime: str = S.JOB_LIFETIME, delay: str = "0 seconds", **options) -> DataFrame:
    """Append mode emits a window of done events ``lifetime`` and ``delay`` after its end.

    The two streams are joined and then counted by window: two stateful
    operators under one watermark.
    """
    return lt.aggregate_latency(arrivals.withWatermark("ts", delay), done.withWatermark("done_at", delay), lifetime, **options)


def combined_job_stats(transform: DataFrame, analysis: DataFrame) -> DataFrame:
    """The combined figures of each job with rows on both sides, for update mode."""
    return doc.combined_from_tagged(transform, analysis)


def ledger(
    transform: DataFrame,
    analysis: DataFrame,
    control: DataFrame,
    lifetime: str | None = S.JOB_LIFETIME,
    heartbeat: DataFrame | None = None,
) -> DataFrame:
    """Counts and expectation of each collected job, for update mode.

    The three streams meet as one tagged union under one aggregation. A
    collection message counts as one item, named by its time and content. Rows
    of ``heartbeat``, whatever they hold, change nothing; they only make a
    micro-batch run, so that timeouts are noticed while no message comes. They
    carry the oldest time and so move no watermark.
    """
    item = lambda rows, kind: rows.select(
        F.lit(kind).alias("kind"), "job_id", "review_id", "ts", F.lit(None).cast("bigint").alias("expected_count")
    )
    collected = ct.collection_done(control).select(
        F.lit("collection").alias("kind"),
        "job_id",
        F.concat_ws(":", F.unix_micros("ts"), "expected_count").alias("review_id"),
        "ts",
        "expected_count",
    )
    items = item(transform, "transform").unionByName(item(analysis, "analysis")).unionByName(collected)
    if heartbeat is not None:
        text, number = F.lit(None).cast("string"), F.lit(None).cast("bigint")
        items = items.unionByName(
            heartbeat.select(
                F.lit("heartbeat").alias("kind"), text.alias("job_id"), text.alias("review_id"),
                F.timestamp_micros(F.lit(0)).alias("ts"), number.alias("expected_count"),
            )
        )
    once = once_per_key(items, ["kind", "job_id", "review_id"], lifetime)
    is_kind = lambda kind: F.col("kind") == kind
    order = F.when(is_kind("collection"), F.struct("ts", "expected_count"))
    none_if_zero = lambda n: F.nullif(n, F.lit(0))
    return (
        once.groupBy("job_id")
        .agg(
            F.max_by("expected_count", order).alias("expected_count"),
            F.max(F.when(is_kind("collection"), F.col("ts"))).alias("collected_at"),
            F.count_if(is_kind("transform")).alias("_t"),
            F.count_if(is_kind("analysis")).alias("_a"),
        )
        .filter(F.col("expected_count").isNotNull())
        .select(
            "job_id",
            "expected_count",
            "collected_at",
            none_if_zero(F.col("_t")).alias("transform_count"),
            none_if_zero(F.col("_a")).alias("analysis_count"),
        )
    )


def emit_events(
    spark: SparkSession,
    ledger_updates: DataFrame,
    ledger_path: str,
    events_path: str,
    checkpoint: str,
    as_of: Column | None = None,
    timeout_minutes: int = S.JOB_TIMEOUT_MINUTES,
    remember: str = S.JOB_LIFETIME,
) -> DataStreamWriter:
    """Writes each control event once, with its message, however often its job is updated.

    Per micro-batch: store the updated ledger rows, lay them over the jobs that
    the batch before handed on, derive the events, leave out those a job was
    told before, and hand the jobs on with what they were told. With ``as_of``
    open jobs are checked for their timeouts as well. Finished jobs are handed on
    until ``remember`` after their collection, so that late updates tell
    nothing twice. A batch costs its updates and the jobs handed on and reads
    no output of earlier batches. A repeated batch starts from the same jobs
    and writes the same again.
    """
    updates, known = f"{ledger_path}/updates", f"{ledger_path}/known"
    sinks.write_batch(spark.createDataFrame([], KNOWN_LAYOUT), known, -1)
    none = F.array().cast("array<string>")

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        sinks.write_batch(ct.with_done_flags(batch), updates, batch_id)
        updated = sinks.read_batch(session, updates, batch_id, LEDGER_LAYOUT)
        before = sinks.read_batch(session, known, batch_id - 1, KNOWN_LAYOUT)
        renewed = updated.join(before.select("job_id", "told"), "job_id", "left")
        current = renewed.unionByName(before.join(updated.select("job_id"), "job_id", "left_anti"))
        current = current.withColumn("told", F.coalesce("told", none))

        now = pinned(session, F.current_timestamp() if as_of is None else as_of)
        events = ct.ledger_events(current, None if as_of is None else now, timeout_minutes)
        fresh = events.join(current.select("job_id", "told"), "job_id").filter(~F.array_contains("told", F.col("event_key")))
        fresh = fresh.withColumn("message", ct.encode_event(now)).select("event_key", "job_id", "step", "status", "expected_count", "actual_count", "message")
        sinks.write_batch(fresh, events_path, batch_id)

        written = sinks.read_batch(session, events_path, batch_id, EVENT_LAYOUT)
        news = written.groupBy("job_id").agg(F.collect_list("event_key").alias("news"))  # a few for each job
        after = current.join(news, "job_id", "left").withColumn("told", F.concat("told", F.coalesce("news", none)))
        finished = F.col("aggregation_done") | F.array_contains("told", sc.composite_key(F.col("job_id"), F.lit("timeout")))
        newest = current.agg(F.max("collected_at").alias("t")).first()["t"]
        if newest is not None:
            expired = F.col("collected_at") < F.lit(newest) - F.expr(f"INTERVAL {remember}")
            after = after.filter(~(finished & expired))
        sinks.write_batch(after.drop("news"), known, batch_id)

    return sinks.updates(ledger_updates, checkpoint, handle)


def pinned(spark: SparkSession, time: Column) -> Column:
    """The time's value now, so that several queries judge by the same moment."""
    micros = spark.range(1).select(F.unix_micros(time)).first()[0]
    return F.timestamp_micros(F.lit(micros))


def read_events(spark: SparkSession, events_path: str) -> DataFrame:
    return sinks.read_changelog(spark, events_path, EVENT_LAYOUT).drop(sinks.BATCH)


def count_observer(rows: DataFrame, name: str) -> DataFrame:
    """Attaches row and job counts to each batch's progress report."""
    return rows.observe(
        name, F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("job_id").alias("jobs")
    )
