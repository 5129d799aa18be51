"""Result sinks.

``append`` writes rows that never change. ``changelog`` writes the updated rows
of each micro-batch into a folder of that batch: a repeated batch overwrites
its own folder, so every update is there exactly once. ``read_latest`` turns a
changelog back into the table of current rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tallyloom.functions import codec
from tallyloom.operators.reviews import latest_by_key

BATCH = "batch_id"


def as_messages(df: DataFrame, key: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows as ``(key, value)`` with JSON values that keep their nulls."""
    return df.select(key.alias("key"), codec.encode_json(*(columns or df.columns)).alias("value"))


def to_kafka(messages: DataFrame, servers: str, topic: str):
    """The writer for ``(key, value)`` messages; needs Spark's Kafka connector."""
    writer = messages.writeStream if messages.isStreaming else messages.write
    return writer.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)


def append(df: DataFrame, path: str, checkpoint: str, format: str = "parquet") -> DataStreamWriter:
    return (
        df.writeStream.outputMode("append")
        .format(format)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def read_batch(spark: SparkSession, path: str, batch_id: int, layout: str) -> DataFrame:
    """What one micro-batch wrote."""
    return spark.read.schema(layout).parquet(f"{path}/{BATCH}={batch_id}")


def changelog(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    return updates(df, checkpoint, lambda batch, batch_id: write_batch(batch, path, batch_id))


def updates(df: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    return (
        df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(handle)
    )


def read_changelog(spark: SparkSession, path: str, layout: str | None = None) -> DataFrame:
    reader = spark.read.option("basePath", path)
    if layout:
        reader = reader.schema(f"{layout}, {BATCH} bigint")
    return reader.parquet(path).withColumn(BATCH, F.col(BATCH).cast("bigint"))


def read_latest(spark: SparkSession, path: str, keys: Sequence[str], layout: str | None = None) -> DataFrame:
    return latest_by_key(read_changelog(spark, path, layout), keys, [BATCH]).drop(BATCH)


#: A compacting changelog starts a new base every so many batches.
BLOCK = 20


def write_compacting(df: DataFrame, path: str, batch_id: int, keys: Sequence[str], layout: str, block: int = BLOCK) -> DataFrame:
    """Writes a batch of updates and returns the current rows of all keys.

    Every ``block`` batches the current rows become a new base, so a batch
    reads one base and the updates since, whatever came before. Folders are
    named by batch number and never listed.
    """
    spark = df.sparkSession
    number, base = batch_id // block, f"{path}/base"
    if batch_id == 0:
        write_batch(spark.createDataFrame([], layout), base, 0)
    elif batch_id % block == 0:
        write_batch(_since(spark, path, number - 1, batch_id - 1, keys, layout, block), base, number)
    write_batch(df, f"{path}/changes", batch_id)
    return _since(spark, path, number, batch_id, keys, layout, block)


def _since(spark: SparkSession, path: str, number: int, last: int, keys: Sequence[str], layout: str, block: int) -> DataFrame:
    rows = read_batch(spark, f"{path}/base", number, layout).withColumn(BATCH, F.lit(-1))
    for batch_id in range(number * block, last + 1):
        rows = rows.unionByName(read_batch(spark, f"{path}/changes", batch_id, layout).withColumn(BATCH, F.lit(batch_id)))
    return latest_by_key(rows, keys, [BATCH]).drop(BATCH)


def compact(spark: SparkSession, path: str, keys: Sequence[str], target: str) -> None:
    """Writes the current rows of a changelog as a changelog of one batch."""
    write_batch(read_latest(spark, path, keys), target, 0)


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Processes what is there now and stops."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
