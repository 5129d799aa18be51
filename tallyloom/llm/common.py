"""What the operators share: saved intermediate results, joins on hot keys, components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import find_package as find_package

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: ASCII bytes that are neither letters nor digits become spaces, A-Z become a-z; what bytes.split()
#: then yields are the matches of WORD in the lower-cased text.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def words_of(text: Column) -> Column:
    """The words of a text as an array; null has none."""
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def text_version(text: Column) -> Column:
    """Tells texts under one document id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def saved(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the folder of ``spark.checkpoint.dir``.

    A session without that setting keeps them beside its tables, in the
    warehouse, which all its executors share as well.
    """
    _shared(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the same folder, which the caller of the job owns."""
    path = f"{_shared(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _shared(spark: SparkSession) -> str:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints")
    return context.getCheckpointDir()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def salted_join(rows: DataFrame, facts: DataFrame, key: str, salt: Column, how: str = "inner", salts: int = 16) -> DataFrame:
    """Joins many rows of a key with its one fact; the rows of a hot key go to ``salts`` tasks.

    Keys compare null-safely. ``rows`` and ``facts`` share no other column name.
    """
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(salts)).cast("int"))
    right = facts.withColumnRenamed(key, "_key").withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    joined = left.join(right, left[key].eqNullSafe(right["_key"]) & (left["_salt"] == right["_other"]), how)
    return joined.drop("_key", "_salt", "_other")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every linked node: the smallest node that links reach.

    Alternates the large-star and small-star steps, which need a number of
    rounds logarithmic in the longest chain, until no link changes. Each round
    is saved; only a count and a checksum reach the driver.
    """
    hi, lo = F.greatest(a, b), F.least(a, b)
    edges = saved(links.where(F.col(a) != F.col(b)).select(hi.alias("x"), lo.alias("y")).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select("y", "x"))
        least = both.groupBy("x").agg(F.least("x", F.min("y")).alias("m"))
        large = salted_join(both, least, "x", F.col("y")).where("y > x and y <> m").select(F.col("y").alias("x"), F.col("m").alias("y"))
        large = saved(large.distinct())
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        small = salted_join(large, least, "x", F.col("y")).where("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y"))
        edges = saved(small.union(least.select("x", "m")).distinct())
        before, state = state, _state(edges)
        if before == state:
            break
    roots = edges.groupBy("y").count().select(F.col("y").alias("node"), F.col("y").alias("root"))
    return edges.select(F.col("x").alias("node"), F.col("y").alias("root")).union(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("x", "y"))).first())


#: Bits of a sketch, and so the rows of its broadcast table: at most 2**14 words of 64 bits.
SKETCH_BITS = 20


def maybe_in(rows: DataFrame, keys: DataFrame, *columns: str, also: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Splits ``rows`` into those whose key may be among ``keys`` and those whose key surely is not.

    Looks hashes of the key up in a bitmap of fixed size, so no row is moved.
    Both frames have the key under the names ``columns``; none other than those
    of ``rows`` is kept. Rows where ``also`` holds go with the first.
    """
    place = F.xxhash64(*columns).bitwiseAND((1 << SKETCH_BITS) - 1)
    bit = F.expr("shiftleft(1L, cast(_place & 63 as int))")
    words = keys.select(place.alias("_place")).groupBy(F.shiftright("_place", 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    placed = rows.withColumn("_place", place)
    joined = placed.join(F.broadcast(words), F.shiftright("_place", 6) == F.col("_word"), "left")
    known = F.coalesce(F.col("_bits").bitwiseAND(bit), F.lit(0)) != 0
    known = known if also is None else known | also
    return joined.where(known).select(*rows.columns), joined.where(~known).select(*rows.columns)
