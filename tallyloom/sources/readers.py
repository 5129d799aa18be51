"""Message streams as ``(key, value, ts)`` tables, batch or streaming.

``kafka`` needs Spark's Kafka connector on the class path. ``parquet``,
``orc``, ``json`` and ``avro`` tables name their message columns; ``text``
files hold one message per line and take the file time as event time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import parse


@dataclass(frozen=True)
class Source:
    """Where a message stream lives and which columns carry it."""

    format: str = "parquet"
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    schema: str | None = None
    key: str | None = "key"
    value: str = "value"
    ts: str = "ts"

    @staticmethod
    def kafka(servers: str, topic: str, **options: str) -> Source:
        settings = {
            "kafka.bootstrap.servers": servers,
            "subscribe": topic,
            "startingOffsets": "earliest",
            **{name.replace("__", "."): text for name, text in options.items()},
        }
        return Source("kafka", options=settings, ts="timestamp")

    @staticmethod
    def lines(path: str, **options: str) -> Source:
        return Source("text", path, options=dict(options), key=None)


def read_messages(spark: SparkSession, source: Source, streaming: bool = False) -> DataFrame:
    reader = (spark.readStream if streaming else spark.read).format(source.format).options(**source.options)
    layout = source.schema
    if layout is None and streaming and source.format not in ("kafka", "text"):
        # a file stream wants its schema up front; the files have it
        layout = spark.read.format(source.format).options(**source.options).load(source.path).schema
    if layout is not None:
        reader = reader.schema(layout)
    df = reader.load(source.path) if source.path else reader.load()
    if source.format == "text":
        ts = F.col("_metadata.file_modification_time")
        return df.select(F.lit(None).cast("string").alias("key"), F.col("value"), ts.alias("ts"))
    key = F.col(source.key).cast("string") if source.key else F.lit(None).cast("string")
    return df.select(
        key.alias("key"),
        F.col(source.value).cast("string").alias("value"),
        F.col(source.ts).cast("timestamp").alias("ts"),
    )


def read_transform(spark: SparkSession, source: Source, carry=(), streaming: bool = False, figures=parse.FIGURES) -> DataFrame:
    return parse.parse_transform(read_messages(spark, source, streaming), carry, figures=figures)


def read_analysis(spark: SparkSession, source: Source, streaming: bool = False) -> DataFrame:
    return parse.flatten_analysis(read_messages(spark, source, streaming))


def read_control(spark: SparkSession, source: Source, streaming: bool = False) -> DataFrame:
    return parse.parse_control(read_messages(spark, source, streaming), key="key")
