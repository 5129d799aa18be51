"""SimHash near-duplicates over a segment-popcount embedding.

A 64-bit fingerprint is cut into 16 segments of 4 bits and mapped to the vector
of their bit counts. Flipping a bit moves one coordinate by one, so the
Manhattan distance of two vectors is a lower bound of the Hamming distance of
the fingerprints, and fingerprints within two bits lie in grid cells at most two
steps apart: some cell is within one step of both. Every fingerprint is
entered into its own cell and those one step away, cells are joined with
themselves, and each pair that meets is verified bit by bit.

A cell that holds more than ``CROWDED`` fingerprints is not joined. Its
fingerprints are entered under the 65 values at most one flip away instead. Two
fingerprints are within two bits exactly if they share such a value, and all
that share one are within two bits of each other, so a link from each to the
smallest one keeps every component, with as many links as entries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tallyloom.llm.common import components, salted_join, saved, text_version

BITS, SEGMENTS = 64, 16
WIDTH = BITS // SEGMENTS
DISTANCE = 2
CROWDED = 64
_BLOCK = 1 << 15


def fingerprint(text: str | None) -> int:
    """The SimHash of the 3-word shingles of a text, as an unsigned integer; 0 if it has no words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < 3:
        words = [b" ".join(words)] + [b""] * 2
        shingles: Iterator[bytes] = iter(words[:1])
        total = 1
    else:
        shingles = map(b" ".join, zip(words, words[1:], words[2:]))
        total = len(words) - 2
    counts = np.zeros(BITS, np.int64)
    for start in range(0, total, _BLOCK):
        size = min(_BLOCK, total - start)
        hashes = np.fromiter((xxh64_intdigest(x, 42) for _, x in zip(range(size), shingles)), np.uint64, size)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(size, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, version, fp)``: one signed 64-bit fingerprint for each row; ``version`` tells texts under one id apart."""
    schema = f"id {docs.schema[key].dataType.simpleString()}, version bigint, fp bigint"

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x.as_py()) for x in batch.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], names=["id", "version", "fp"])

    return docs.select(F.col(key).alias("id"), text_version(F.col(text)).alias("version"), text).mapInArrow(hashed, schema)


def popcounts(fp: Column) -> list[Column]:
    """The coordinates of the embedding: bits set in each segment, lowest first."""
    return [F.bit_count(F.shiftrightunsigned(fp, WIDTH * i).bitwiseAND(2**WIDTH - 1)).cast("long") for i in range(SEGMENTS)]


def cells(fp: Column) -> Column:
    """The cell of a fingerprint and all cells one step away, as packed numbers of 3 bits a coordinate."""
    parts = popcounts(fp)
    own = sum((F.shiftleft(part, 3 * i) for i, part in enumerate(parts)), F.lit(0).cast("long"))
    up = [F.when(part < WIDTH, own + (1 << 3 * i)) for i, part in enumerate(parts)]
    down = [F.when(part > 0, own - (1 << 3 * i)) for i, part in enumerate(parts)]
    return F.array_compact(F.array(own, *up, *down))


def flips(fp: Column) -> Column:
    """A fingerprint and the 64 values one flip away."""
    return F.array(fp, *(fp.bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(BITS)))


def links(fps: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """``(a, b)`` links between distinct fingerprints whose components are those of distance 2 or less.

    Outside crowded cells every pair within two bits is a link.
    """
    entered = fps.select("fp", F.explode(cells(F.col("fp"))).alias("cell"))
    full = saved(entered.groupBy("cell").count().where(F.col("count") > crowded).select("cell"))
    sparse = salted_join(entered, full.withColumn("hot", F.lit(True)), "cell", F.col("fp"), "left")
    quiet = sparse.where("hot is null")
    a, b = quiet.select("cell", F.col("fp").alias("a")), quiet.select("cell", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE
    pairs = a.join(b, (a["cell"] == b["cell"]) & (F.col("a") < F.col("b")) & near).select("a", "b")
    hot = sparse.where("hot").select("fp").distinct()
    shared = hot.select("fp", F.explode(flips(F.col("fp"))).alias("value"))
    least = shared.groupBy("value").agg(F.min("fp").alias("b"), F.max("fp").alias("most")).where("b < most")
    stars = salted_join(shared, least, "value", F.col("fp")).where("fp <> b").select(F.col("fp").alias("a"), "b")
    return pairs.union(stars).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, fingerprint, component_id)`` for each row of ``docs``.

    Texts of less than three words have one shingle, null and empty texts have
    fingerprint zero and are linked like all others. Rows with a null key take
    part; a component of such rows only has a null id. Repeated rows are kept
    each. Other columns are not read; an empty table gives an empty result.
    Equal fingerprints become one before any are compared.
    """
    found = _classed(docs, key, text)
    return found.select(F.col("id").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _classed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(id, version, fp, component_id)`` for each row."""
    rows = saved(fingerprints(docs, key, text))
    unique = saved(rows.groupBy("fp").agg(F.min("id").alias("least")))
    found = saved(components(links(unique.select("fp"))))
    rooted = saved(unique.join(found, unique["fp"] == found["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    ids = saved(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    named = rooted.select("fp", F.col("root").alias("of")).join(ids, F.col("of") == F.col("root")).select("fp", "component_id")
    return salted_join(rows, named, "fp", F.col("id"))


def _rooted(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(id, version, root)`` for each row; ``root`` names its component."""
    rows = saved(fingerprints(docs, key, text))
    unique = saved(rows.select("fp").distinct())
    found = saved(components(links(unique)))
    named = unique.join(found, unique["fp"] == found["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return salted_join(rows, named, "fp", F.monotonically_increasing_id()).select("id", "version", "root")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """The rows of ``docs`` with one document of each component: that with the smallest key.

    Rows with a null key are kept, since nothing tells them apart; equal rows
    are one document and stay together; rows with one key but other texts are
    judged each. With ``whole`` one row of each component stays, whatever its
    rows have as keys: the first by key, nulls last, and text version, and of
    rows equal in both any one.
    """
    if whole:
        return _one_each(docs, key, text)
    found = _classed(docs, key, text).where(F.col("id") != F.col("component_id"))
    dropped = found.select("id", "version").distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("_id"), text_version(F.col(text)).alias("_version"))
    return rows.join(dropped, (F.col("_id") == F.col("id")) & (F.col("_version") == F.col("version")), "left_anti").select("row.*")


def _one_each(docs: DataFrame, key: str, text: str) -> DataFrame:
    counted = _rooted(docs, key, text).groupBy("root", "id", "version").agg(F.count("*").alias("n"))
    counted = saved(counted.withColumn("rank", F.struct(F.col("id").isNull().alias("none"), "id", "version")))
    first = saved(counted.groupBy("root").agg(F.min("rank").alias("first")))
    judged = salted_join(counted, first, "root", F.col("rank")).select("id", "version", "n", (F.col("rank") != F.col("first")).alias("drop"))
    # ids and versions of rows that go, or of which one stays
    judged = saved(judged.where("drop or n > 1").select("id", "version", "drop"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("_id"), text_version(F.col(text)).alias("_version"))
    same = F.col("_id").eqNullSafe(F.col("id")) & (F.col("_version") == F.col("version"))
    some = rows.join(judged, same, "left")
    alone = some.where("drop is null").select("row.*")
    # partial aggregates make one of many equal rows before they are moved
    copies = rows.join(judged.where("not drop"), same).groupBy("_id", "_version").agg(F.first("row").alias("row")).select("row.*")
    return alone.union(copies)
