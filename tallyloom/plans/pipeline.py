"""The whole job: three message streams in, rows, documents and events out.

The batch form parses each stream once into typed tables in the output folder
and works on those, so later steps read only the columns they need and a lost
executor costs no parsing again. The streaming form does the same with one
query per topic and one per output.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyloom import schema as S
from tallyloom.functions import scalars as sc
from tallyloom.operators import cells as cl
from tallyloom.operators import control as ct
from tallyloom.operators import documents as doc
from tallyloom.operators import parse, reviews
from tallyloom.sources import sinks
from tallyloom.sources.readers import Source, read_messages
from tallyloom.streaming import flows


@dataclass(frozen=True)
class Inputs:
    transform: Source
    analysis: Source
    control: Source


@dataclass(frozen=True)
class Outputs:
    """Folders under one root that all executors share."""

    root: str

    def __getattr__(self, name: str) -> str:
        if name.startswith("_"):
            raise AttributeError(name)
        return f"{self.root.rstrip('/')}/{name}"


def run_batch(spark: SparkSession, inputs: Inputs, out: Outputs, as_of: Column | None = None) -> None:
    """Writes ``rows``, ``documents``, ``documents_spec``, ``events`` and the
    unreadable messages under ``quarantine``. ``as_of`` is the time written
    into documents and the one timeouts are judged by; default now."""
    now = flows.pinned(spark, as_of if as_of is not None else F.current_timestamp())
    typed = {
        "reviews": parse.parse_transform(read_messages(spark, inputs.transform), S.PASS_THROUGH, on_error="mark"),
        "analyses": parse.flatten_analysis(read_messages(spark, inputs.analysis), on_error="mark"),
        "control": parse.parse_control(read_messages(spark, inputs.control), key="key", on_error="mark"),
    }
    typed = {name: _store(rows, getattr(out, name)) for name, rows in typed.items()}
    for i, (name, rows) in enumerate(typed.items()):
        bad = rows.filter("unreadable IS NOT NULL").select(F.lit(name).alias("source"), "ts", "unreadable")
        bad.write.mode("append" if i else "overwrite").parquet(out.quarantine)
    good, analysis, control = (rows.filter("unreadable IS NULL").drop("unreadable") for rows in typed.values())

    reviews.joined_rows(reviews.join_reviews(good, analysis)).write.mode("overwrite").parquet(out.rows)
    cells = _store(cl.job_cells(good, analysis), out.cells)
    doc.job_document(cells, sc.kst_iso(now)).write.mode("overwrite").parquet(out.documents)
    doc.job_document_spec(cells).write.mode("overwrite").parquet(out.documents_spec)
    ledger = ct.ledger(
        ct.expected_counts(control), ct.distinct_counts(good), ct.distinct_counts(analysis)
    )
    events = ct.ledger_events(ledger, now)
    events.withColumn("message", ct.encode_event(now)).write.mode("overwrite").parquet(out.events)


def _store(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def start_streams(
    spark: SparkSession,
    inputs: Inputs,
    out: Outputs,
    trigger: dict | None = None,
    lifetime: str | None = S.JOB_LIFETIME,
    delay: str = "0 seconds",
    as_of: Column | None = None,
    heartbeat: DataFrame | None = None,
) -> list[StreamingQuery]:
    """Starts the queries behind ``rows``, ``hours``, ``documents``, ``events`` and ``quarantine``.

    Three queries parse each topic once into the typed tables ``reviews``,
    ``analyses`` and ``control``; the others read those. ``trigger`` holds the
    arguments of ``DataStreamWriter.trigger``; default is to process what is
    there and stop. ``as_of`` is the time for timeouts and documents, default
    the current one. A stream that runs on gets a heartbeat of a row a second,
    so that jobs become overdue while no message comes.
    """
    timing = trigger or {"availableNow": True}
    messages = lambda source: read_messages(spark, source, streaming=True)
    typed = {
        "reviews": parse.parse_transform(messages(inputs.transform), S.PASS_THROUGH, on_error="mark"),
        "analyses": parse.flatten_analysis(messages(inputs.analysis), on_error="mark"),
        "control": parse.parse_control(messages(inputs.control), key="key", on_error="mark"),
    }

    def start(name: str, writer) -> StreamingQuery:
        return writer.queryName(name).trigger(**timing).start()

    queries = []
    for name, rows in typed.items():
        query = start(name, sinks.append(rows, getattr(out, name), f"{out.checkpoints}/{name}"))
        query.awaitTermination() if trigger is None else query.processAllAvailable()
        queries.append(query)

    def table(name: str) -> DataFrame:
        return spark.readStream.schema(typed[name].schema).parquet(getattr(out, name))

    def good(name: str) -> DataFrame:
        return table(name).filter("unreadable IS NULL").drop("unreadable")

    now = as_of if as_of is not None else F.current_timestamp()
    if heartbeat is None and trigger is not None:
        heartbeat = spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def publish(batch: DataFrame, batch_id: int) -> None:
        cells = sinks.write_compacting(batch, out.cells, batch_id, cl.KEYS, cl.LAYOUT)
        jobs = sinks.read_batch(spark, f"{out.cells}/changes", batch_id, cl.LAYOUT).select("job_id").distinct()
        changed = doc.job_document(cells.join(jobs, "job_id", "left_semi"), sc.kst_iso(flows.pinned(spark, now)))
        sinks.write_batch(changed, out.documents, batch_id)

    unreadable = [table(name).filter("unreadable IS NOT NULL").select(F.lit(name).alias("source"), "ts", "unreadable") for name in typed]
    updates = flows.ledger(good("reviews"), good("analyses"), good("control"), lifetime, heartbeat)
    joined = reviews.joined_rows(flows.join_reviews(good("reviews"), good("analyses"), delay))
    writers = {
        "rows": sinks.append(joined, out.rows, f"{out.checkpoints}/rows"),
        "hours": sinks.append(flows.hourly_counts(good("reviews")), out.hours, f"{out.checkpoints}/hours"),
        "documents": sinks.updates(cl.job_cells(good("reviews"), good("analyses")), f"{out.checkpoints}/documents", publish),
        "events": flows.emit_events(spark, updates, out.ledger, out.events, f"{out.checkpoints}/events", now),
        "quarantine": sinks.append(
            unreadable[0].unionByName(unreadable[1]).unionByName(unreadable[2]), out.quarantine, f"{out.checkpoints}/quarantine"
        ),
    }
    return queries + [start(name, writer) for name, writer in writers.items()]


def current_documents(spark: SparkSession, out: Outputs) -> DataFrame:
    """The latest published document of each job."""
    return sinks.read_latest(spark, out.documents, ["job_id"])
