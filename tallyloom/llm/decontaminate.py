"""Benchmark decontamination by a prefix-filtered set join on word shingles.

A window is 13 consecutive words of a benchmark item, or the whole of a shorter
one. Its elements are shingles of three words (of all its words if it has
fewer). A document holds the window only if it holds all of its shingles, so
the necessary prefix is a single one: the rarest, by how often each benchmark
shingle occurs in all documents.

1. One pass over the texts hashes their shingles and looks them up in a bitmap
   of the benchmark's, whose size is fixed. Kept are runs of hits long enough
   for a window: the length bound, before anything is shuffled.
2. Shingles in the runs are counted over all documents; each window gets its
   rarest one as prefix.
3. Runs are joined with windows on the prefix; the place of the shingle in the
   window gives the start, which must leave room for the whole window (the
   positional bound); then the words themselves are compared.

The bitmap alone is sent to all tasks. The benchmark may be of any size: its
windows are shuffled like the runs, and a full bitmap only lets more runs
through to the exact comparison.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import WORD_BYTES, saved, text_version, words_of

WINDOW, SHINGLE = 13, 3
MAP_BITS = 23

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def slots(words: list[int], size: int) -> np.ndarray:
    """The bitmap slot of each ``size``-word shingle, from the CRC-32 of its words."""
    codes = np.array(words, np.uint64)
    code = np.full(max(0, len(codes) - size + 1), size, np.uint64)
    for i in range(size if len(code) else 0):
        code = (code ^ codes[i : i + len(code)]) * _SPREAD
        code ^= code >> np.uint64(29)
    return (code >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


class _Codes(dict):
    MOST = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        self[word] = code = zlib.crc32(word)
        return code


def item_slots(benchmark: DataFrame, text: str) -> tuple[np.ndarray, dict[int, int]]:
    """The bitmap of the benchmark's shingles, and for each shingle size the fewest in a row that a window has."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = set()
        for batch in batches:
            for x in batch.column(0):
                words = [zlib.crc32(w) for w in split_words(x.as_py())]
                size = min(SHINGLE, len(words))
                least = min(WINDOW, len(words)) - size + 1
                pairs.update((int(slot) >> 6, 1 << (int(slot) & 63), size, least) for slot in slots(words, size)) if words else None
        rows = [(w, b - (1 << 64) if b >> 63 else b, s, n) for w, b, s, n in pairs]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)] or [pa.array([], pa.int64())] * 4, names=["word", "bit", "size", "least"])

    parts = benchmark.select(text).mapInArrow(found, "word bigint, bit bigint, size bigint, least bigint")
    parts = saved(parts.groupBy("word", "size").agg(F.bit_or("bit").alias("bits"), F.min("least").alias("least")))
    words = np.zeros(1 << (MAP_BITS - 6), np.int64)
    for row in parts.groupBy("word").agg(F.bit_or("bits").alias("bits")).toLocalIterator():  # at most one row for each word of the bitmap
        words[row["word"]] = row["bits"]
    sizes = {r["size"]: r["least"] for r in parts.groupBy("size").agg(F.min("least").alias("least")).collect()}  # at most SHINGLE rows
    return words, sizes


def candidate_runs(docs: DataFrame, key: str, text: str, bitmap: np.ndarray, sizes: dict[int, int]) -> DataFrame:
    """``(id, version, n_words, runs)``: stretches of words all of whose shingles may be in the benchmark."""
    sent = docs.sparkSession.sparkContext.broadcast(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))
    kind = pa.list_(pa.struct([("size", pa.int32()), ("words", pa.list_(pa.string())), ("start", pa.int64())]))

    def runs_of(words: list[bytes], codes: _Codes, bits: np.ndarray) -> list:
        numbers, found = list(map(codes.__getitem__, words)), []
        for size, least in sizes.items():
            hit = bits[slots(numbers, size)]
            if int(hit.sum()) < least:
                continue
            edges = np.flatnonzero(np.diff(hit, prepend=0, append=0).astype(bool))
            for start, end in edges.reshape(-1, 2):
                if end - start >= least:
                    found.append((size, [w.decode() for w in words[start : end + size - 1]], int(start)))
        return found

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, bits = _Codes(), sent.value
        for batch in batches:
            counts, runs = [], []
            for x in batch.column(2):
                words = split_words(x.as_py())
                counts.append(len(words))
                runs.append(runs_of(words, codes, bits))
            runs = [[dict(zip(("size", "words", "start"), r)) for r in found] for found in runs]
            columns = [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(runs, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "version", "n_words", "runs"])

    schema = f"id {docs.schema[key].dataType.simpleString()}, version bigint, n_words bigint, runs array<struct<size int, words array<string>, start bigint>>"
    return docs.select(F.col(key).alias("id"), text_version(F.col(text)).alias("version"), text).mapInArrow(scan, schema)


def _shingles(words: Column, size: Column) -> Column:
    """The shingles of ``size`` words, in place order."""
    last = F.size(words) - size + 1
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(words, i, size), " ")))


def windows_of(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """``(item, size, window)``: the word arrays that may not occur, and the size of their shingles."""
    words = benchmark.select(F.col(item).alias("item"), words_of(F.col(text)).alias("words")).where(F.size("words") > 0)
    length = F.least(F.lit(WINDOW), F.size("words"))
    starts = F.explode(F.sequence(F.lit(1), F.size("words") - length + 1))
    placed = words.withColumn("i", starts)
    cut = placed.select("item", F.slice("words", F.col("i"), F.least(F.lit(WINDOW), F.size("words"))).alias("window"))
    return cut.distinct().withColumn("size", F.least(F.lit(SHINGLE), F.size("window")))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``(key, n_words, n_hit, n_items, items_sha256, contaminated)`` for each row of ``docs``.

    A document is contaminated if hit words are at least a twentieth of its
    words. Null and empty texts have no words; items without words have no
    windows; items with a null id count as none; repeated items are one;
    repeated documents are judged each. Other columns are not read; empty
    tables give no hits or no rows.
    """
    found = _found(docs, benchmark, key, text, item, item_text)
    return found.select(F.col("id").alias(key), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def _found(docs: DataFrame, benchmark: DataFrame, key: str, text: str, item: str, item_text: str) -> DataFrame:
    bitmap, sizes = item_slots(benchmark, item_text)
    rows = candidate_runs(docs, key, text, bitmap, sizes).withColumn("row", F.monotonically_increasing_id())
    rows = saved(rows)
    dirty, clean = rows.where(F.size("runs") > 0), rows.where(F.size("runs") == 0).select("id", "version", "n_words")
    return _judged(dirty, clean, saved(windows_of(benchmark, item, item_text)))


def _judged(dirty: DataFrame, clean: DataFrame, windows: DataFrame) -> DataFrame:
    runs = dirty.select("row", F.explode("runs").alias("run")).select("row", "run.*").withColumn("run", F.monotonically_increasing_id())
    runs = saved(runs)
    places = runs.select("run", "size", F.posexplode(_shingles(F.col("words"), F.col("size"))).alias("at", "shingle"))
    counts = saved(places.groupBy("size", "shingle").agg(F.count("*").alias("n")))
    parts = windows.select("window", "size").distinct()
    parts = parts.select("window", "size", F.posexplode(_shingles(F.col("window"), F.col("size"))).alias("offset", "shingle"))
    rated = parts.join(counts, ["size", "shingle"])
    rarest = F.min(F.struct("n", "shingle", "offset"))
    prefixes = rated.groupBy("window").agg(rarest.alias("p"), F.first("size").alias("size"), F.count("*").alias("known"))
    # a shingle that no document has rules its window out
    prefixes = prefixes.where(F.col("known") == F.size("window") - F.col("size") + 1)
    prefixes = saved(prefixes.select(F.col("p.shingle").alias("prefix"), F.col("p.offset").alias("offset"), "window", F.col("size").alias("window_size")))
    meet = places.join(prefixes, (F.col("shingle") == F.col("prefix")) & (F.col("size") == F.col("window_size")))
    meet = meet.where("at >= offset").select("run", (F.col("at") - F.col("offset")).alias("first"), "window")
    whole = F.slice("words", F.col("first") + 1, F.size("window")) == F.col("window")
    text_runs = runs.select(F.col("run").alias("of"), "row", "words", "start")
    held = meet.join(text_runs, meet["run"] == text_runs["of"]).where(whole)
    held = saved(held.select("row", (F.col("start") + F.col("first")).alias("at"), "window"))
    spans = held.select("row", "at", (F.col("at") + F.size("window")).alias("end")).groupBy("row", "at").agg(F.max("end").alias("end"))
    hits = spans.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "end"))).alias("spans"))
    # words covered by spans in order of their starts: what each adds beyond the furthest end so far
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("far"), F.lit(0).cast("long").alias("n")),
        lambda acc, x: F.struct(
            F.greatest(acc["far"], x["end"]).alias("far"),
            (acc["n"] + F.greatest(F.lit(0).cast("long"), x["end"] - F.greatest(acc["far"], x["at"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    hits = hits.select(F.col("row").alias("hit_row"), covered.alias("n_hit"))
    in_row = held.groupBy("row", "window").count().select("row", F.col("window").alias("w"))
    items = in_row.join(windows.where("item is not null"), F.col("w") == F.col("window")).select("row", F.col("item").cast("string").alias("item")).distinct()
    items = items.groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items")).select(F.col("row").alias("item_row"), "items")
    full = dirty.select("row", "id", "version", "n_words").join(hits, F.col("row") == F.col("hit_row"), "left").join(items, F.col("row") == F.col("item_row"), "left")
    none = F.array().cast("array<string>")
    full = full.select("id", "version", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", none).alias("items"))
    full = full.union(clean.select("id", "version", "n_words", F.lit(0).cast("long"), none))
    return full.select(
        "id",
        "version",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, whatever other rows share their id.

    Rows with a null id stay, unless ``whole`` asks to judge them too.
    """
    bad = _found(docs, benchmark, key, text, "item_id", "text").where("contaminated").select("id", "version").distinct()
    # whole rows in one column, so that none of theirs clashes
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("_id"), text_version(F.col(text)).alias("_version"))
    named = F.col("_id").eqNullSafe(F.col("id")) if whole else F.col("_id") == F.col("id")
    return rows.join(bad, named & (F.col("_version") == F.col("version")), "left_anti").select("row.*")
