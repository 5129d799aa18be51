"""Repaired dead letters come back in, each once.

A message is named by its position in the source: topic, partition and offset,
or file and row. Only positions in quarantine can come back, so whatever was
counted already is not counted again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import parse
from tallyloom.sources import sinks


def reentering(
    dead: DataFrame, repairs: DataFrame, at: Sequence[str], replayed: DataFrame | None = None, value: str = "value"
) -> DataFrame:
    """The rows of ``dead`` with the value of their latest readable repair.

    ``repairs`` holds the position ``at``, the new value and ``repaired_at``;
    of repairs at one moment the one of largest text holds. Repairs that cannot
    be read, and those of positions that are not dead or are in ``replayed``,
    change nothing. A dead letter that was put aside twice comes back once.
    Rows without a position have none to be repaired by. Time and key stay.
    """
    at = list(at)
    waiting = dead.dropDuplicates(at)
    if replayed is not None:
        waiting = waiting.join(replayed.select(*at), at, "left_anti")
    # only repairs of what waits are parsed
    asked = repairs.select(*at, value, "repaired_at").join(waiting.select(*at), at, "left_semi")
    readable = parse.valid_records(asked, value)
    latest = readable.groupBy(*at).agg(F.max_by(value, F.struct("repaired_at", value)).alias("_repair"))
    columns = [c for c in dead.columns if c != "reason"]
    return waiting.join(latest, at).withColumn(value, F.col("_repair")).select(*columns)


def replay(spark: SparkSession, dead: DataFrame, repairs: DataFrame, at: Sequence[str], path: str, run: int) -> DataFrame:
    """Writes what comes back in run number ``run`` as messages under ``path`` and returns it.

    The runs before it are read for the positions that are back already; the
    first has number 0. A run that is repeated writes its own folder again.
    Streams take ``path`` up as one more source of messages.
    """
    columns = [(f.name, f.dataType.simpleString()) for f in dead.schema.fields if f.name != "reason"]
    layout = ", ".join(f"`{name}` {kind}" for name, kind in columns)
    replayed = None
    for earlier in range(run):
        rows = sinks.read_batch(spark, path, earlier, layout)
        replayed = rows if replayed is None else replayed.unionByName(rows)
    sinks.write_batch(reentering(dead, repairs, at, replayed), path, run)
    return sinks.read_batch(spark, path, run, layout)
