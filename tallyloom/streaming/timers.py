"""Timeouts of steps by event-time timers, one state for each job.

A batch touches the jobs that were updated and those whose limit has passed,
however many others are open. The clock is a stream of times: each update of
the ledger carries the time it was written, and rows of a heartbeat carry the
time alone, so that limits pass while no message comes.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyloom import schema as S
from tallyloom.operators import control as ct
from tallyloom.session import find_package
from tallyloom.sources import sinks

UPDATE_LAYOUT = """
  job_id string, expected_count bigint, collected_at timestamp, transform_count bigint, analysis_count bigint,
  transform_done boolean, analysis_done boolean, min_count bigint, aggregation_done boolean, at timestamp"""
TIMEOUT_LAYOUT = "job_id string, step string, status string, expected_count bigint, actual_count bigint"
_STEPS = {"transform": "transform_count", "analysis": "analysis_count", "aggregation": "min_count"}
_JOB_LAYOUT = "expected_count string, collected_ms bigint, counts string, open string, told string"
#: How long a job is remembered after its collection, so that no step is told twice.
REMEMBER_MS = 7 * 24 * 3_600_000


def write_updates(ledger_updates: DataFrame, path: str, checkpoint: str, now: Column | None = None) -> DataStreamWriter:
    """Writes the updated rows of ``flows.ledger`` with their flags and the time ``at``, a folder a batch."""
    time = F.current_timestamp() if now is None else now

    def handle(batch: DataFrame, batch_id: int) -> None:
        sinks.write_batch(ct.with_done_flags(batch).withColumn("at", time), path, batch_id)

    return sinks.updates(ledger_updates, checkpoint, handle)


def _tell(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Tells each step of a job once that is open when its limit passes."""
    if key[0] is None:  # the clock
        return
    told = state.get[4].split() if state.exists else []
    if not state.hasTimedOut:
        rows = [r for batch in batches for r in batch.itertuples(index=False)]
        # figures travel as text: numbers with nulls would become floats
        number = lambda text: int(text) if isinstance(text, str) else 0
        last = max(rows, key=lambda r: (r.at_us, r.collected_us, number(r.transform_count), number(r.analysis_count)))
        # rounded up: a limit that ends within a millisecond passes with the next one
        collected_ms = -(-int(last.collected_us) // 1000)
        still_open = [step for step in _STEPS if not getattr(last, f"{step}_done")]
        expected = last.expected_count if isinstance(last.expected_count, str) else None
        job = (expected, collected_ms, " ".join(str(number(getattr(last, c))) for c in _STEPS.values()))
    else:
        still_open, job = state.get[3].split(), state.get[:3]
    expected, collected_ms, counts = job
    now, due = state.getCurrentWatermarkMs(), []
    for step, actual in zip(_STEPS, counts.split()):
        if step in still_open and step not in told and collected_ms + limit_ms(step) <= now:
            told.append(step)
            due.append((key[0], step, "timeout", None if expected is None else int(expected), int(actual)))
    if collected_ms + REMEMBER_MS <= now:
        state.remove()
    else:
        state.update((*job, " ".join(still_open), " ".join(told)))
        # one timer at the next limit; after the last, one that forgets the job. It fires once the time is past it
        ends = [collected_ms + limit_ms(step) for step in still_open if step not in told]
        state.setTimeoutTimestamp(max(min(ends, default=collected_ms + REMEMBER_MS) - 1, 1))
    if due:
        told_now = pd.DataFrame(due, columns=["job_id", "step", "status", "expected_count", "actual_count"])
        yield told_now.astype({"expected_count": "Int64", "actual_count": "int64"})


def limit_ms(step: str) -> int:
    return int(timedelta(minutes=S.STEP_TIMEOUT_MINUTES.get(step, S.DEFAULT_TIMEOUT_MINUTES)).total_seconds() * 1000)


def step_timeouts(updates: DataFrame, clock: DataFrame | None = None, delay: str = "0 seconds") -> DataFrame:
    """The steps that are open when their limit passes, each once; append mode.

    ``updates`` has the columns of ``UPDATE_LAYOUT``, ``clock`` a time ``at``. The
    newest time of both is the time now, less ``delay``, by which an update may
    come late. A step that is done after it was told stays told, and a job is
    forgotten a week after its collection.
    """
    rows = updates
    if clock is not None:
        rows = rows.unionByName(clock.select("at"), allowMissingColumns=True)
    find_package(rows.sparkSession)
    micros = lambda c: F.coalesce(F.unix_micros(c), F.lit(0))
    rows = rows.withWatermark("at", delay).select(
        "job_id", "at", micros("at").alias("at_us"), micros("collected_at").alias("collected_us"),
        *[F.col(c).cast("string").alias(c) for c in ("expected_count", *_STEPS.values())],
        *[F.coalesce(f"{step}_done", F.lit(False)).alias(f"{step}_done") for step in _STEPS],
    )
    return rows.groupBy("job_id").applyInPandasWithState(
        _tell, TIMEOUT_LAYOUT, _JOB_LAYOUT, "append", GroupStateTimeout.EventTimeTimeout
    )
