"""Importance resampling towards a target distribution, on Arrow kernels.

Texts are taken in blocks. A block is lower-cased and split by Arrow
(``ascii_lower``, ``split_pattern_regex``), its word lists are flattened and
dictionary-encoded, and n-grams are pairs of dictionary indices shifted against
each other, so only the distinct ones of a block are hashed (CRC-32) into
buckets. The first pass counts buckets of the raw and of the target texts; the
second takes the gain of each feature's bucket and sums the gains by document.

A bucket's gain is the logarithm of its smoothed share in the target over that in
the raw texts. Gumbel noise from a hash of the id is added to a document's mean
gain, and the documents with the highest sums are the sample. Ranks come from a
range partitioning by score with running numbers, so no task sees all rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import saved, text_version

BUCKETS = 10_000
#: The longest run of words that is a feature.
RUN = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
NOT_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of text that the kernels hold at a time; a longer text is a block of its own.
BLOCK = 8 << 20


def blocks(texts: pa.Array) -> Iterator[pa.Array]:
    """Consecutive rows of up to ``BLOCK`` bytes."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > BLOCK:
            yield texts.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(texts):
        yield texts.slice(start)


def features(texts: pa.Array, buckets: int, run: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(rows, places)`` for runs of one word, of two and so on: the row, ascending, and the bucket of every feature."""
    # taken anew: ascii_lower misreads slices of larger arrays
    texts = pc.fill_null(texts, "").cast(pa.large_string()).take(pa.array(np.arange(len(texts))))
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), NOT_WORDS)
    row, word = pc.list_parent_indices(lists), pc.list_flatten(lists)
    there = pc.not_equal(word, "")  # a text that begins or ends between words has an empty part there
    row, word = pc.filter(row, there).to_numpy(zero_copy_only=False), pc.dictionary_encode(pc.filter(word, there))
    names = [w.encode() for w in word.dictionary.to_pylist()]
    index = word.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    crc = np.fromiter(map(zlib.crc32, names), np.int64, len(names))
    found, gram = [(row, crc[index] % buckets)], index
    for n in range(2, min(run, len(index)) + 1):
        # the run of n words from a place on is the run of n - 1 from there and one more word of the same row
        start, last, end = gram[: len(index) - n + 1], index[n - 1 :], row[n - 1 :]
        whole = (start >= 0) & (row[: len(end)] == end)
        pairs, which = np.unique(start[whole] * len(names) + last[whole], return_inverse=True)
        before, after = np.divmod(pairs, max(len(names), 1))
        crc = np.fromiter((zlib.crc32(b" " + names[w], c) for w, c in zip(after.tolist(), crc[before].tolist())), np.int64, len(pairs))
        gram = np.full(len(end), -1, np.int64)
        gram[whole] = which
        found.append((end[whole], crc[which] % buckets))
    return found


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS, run: int = RUN) -> DataFrame:
    """``(bucket, n)``: how many features of all texts fall into each bucket that has any."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for block in blocks(batch.column(0)):
                for _, places in features(block, buckets, run):
                    total += np.bincount(places, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])

    parts = texts.select(F.col(text).cast("string")).mapInArrow(counted, "bucket int, n bigint")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, text: str = "text", buckets: int = BUCKETS, run: int = RUN) -> DataFrame:
    """``(bucket, gain)`` for every bucket: thousandths of the logarithm of its share in the target over that in the raw texts."""
    s, t = (bucket_counts(docs, text, buckets, run).select("bucket", F.col("n").cast("double").alias(c)) for docs, c in ((raw, "s"), (target, "t")))
    spark = raw.sparkSession
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = every.join(s, "bucket", "left").join(t, "bucket", "left").select("bucket", *(F.coalesce(c, F.lit(0.0)).alias(c) for c in "st"))
    both = saved(both)
    total = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    share = (F.col("t") + 1) * (F.col("all_s") + buckets) / ((F.col("s") + 1) * (F.col("all_t") + buckets))
    return both.crossJoin(F.broadcast(total)).select("bucket", F.floor(1000 * F.log(share)).cast("long").alias("gain"))


def weights(docs: DataFrame, gain: np.ndarray, key: str, text: str, run: int = RUN) -> DataFrame:
    """``(id, version, n_words, n_features, weight)`` for each row; ``version`` tells texts under one id apart."""
    buckets = len(gain)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for block in blocks(batch.column(2)):
                n = len(block)
                total, count, words = (np.zeros(n, np.int64) for _ in range(3))
                for k, (rows, places) in enumerate(features(block, buckets, run)):
                    if len(rows):
                        first = np.flatnonzero(np.diff(rows, prepend=-1))
                        total[rows[first]] += np.add.reduceat(gain[places], first)
                    here = np.bincount(rows, minlength=n).astype(np.int64)
                    count += here
                    words = here if k == 0 else words
                mean = total // np.maximum(count, 1)
                ids, versions = batch.column(0).slice(at, n), batch.column(1).slice(at, n)
                yield pa.RecordBatch.from_arrays(
                    [ids, versions, pa.array(words), pa.array(count), pa.array(mean)], names=["id", "version", "n_words", "n_features", "weight"]
                )
                at += n

    schema = f"id {docs.schema[key].dataType.simpleString()}, version bigint, n_words bigint, n_features bigint, weight bigint"
    return docs.select(F.col(key).alias("id"), text_version(F.col(text)).alias("version"), F.col(text).cast("string")).mapInArrow(weighed, schema)


def ranked(rows: DataFrame, *order) -> DataFrame:
    """``rows`` with ``place``, their running number from 1 in an order, and ``n_placed``, how many there are.

    A range partitioning, a sort within its partitions and the sums of the sizes of the partitions before: nothing meets in one
    task but one row for each partition.
    """
    sorted_parts = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # the number holds the partition in its upper bits and the place within it in its lower 33
    numbered = saved(sorted_parts.withColumn("_at", F.monotonically_increasing_id()))
    part, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = numbered.groupBy(part.alias("_part")).agg((F.max(inside) + 1).alias("_size"))
    before = "sum(_size) OVER (ORDER BY _part) - _size AS _before"
    offsets = saved(sizes.selectExpr("_part", before, "sum(_size) OVER () AS n_placed"))
    met = numbered.withColumn("_of", part).join(F.broadcast(offsets), F.col("_of") == F.col("_part"))
    return met.withColumn("place", F.col("_before") + inside + 1).drop("_of", "_part", "_before", "_size", "_at")


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS, run: int = RUN,
    least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """``(key, n_features, weight, score, rank)`` for each row of ``docs``; ``rank`` is null where a document is not drawn.

    Words are what lies between ASCII characters that are neither letters nor
    digits, A-Z lower-cased. Of the N documents of ``least_words`` words or more,
    ``percent`` in a hundred are drawn, rounded down. Null and empty texts have
    no features, weight 0 and are not drawn unless ``least_words`` is 0. A null
    id counts as an empty one in the noise and comes after all ids among equal
    scores. Rows that repeat an id are documents each, with the same noise; equal
    scores under one id go by text, and rows equal in all are interchangeable.
    Other columns are not read. Without target texts all weights follow the raw
    counts alone; an empty table gives an empty result.
    """
    # one number for each bucket reaches the driver
    gain = np.array([r["gain"] for r in gains(docs, target, text, buckets, run).orderBy("bucket").collect()], np.int64)
    rows = weights(docs, gain, key, text, run)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("long")
    rows = saved(rows.withColumn("score", F.col("weight") + noise))
    order = (F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("version"), F.col("weight"))
    placed = ranked(rows.where(F.col("n_words") >= least_words), *order)
    drawn = F.col("place") <= F.floor(F.col("n_placed") * percent / 100)
    placed = placed.select("id", "n_features", "weight", "score", F.when(drawn, F.col("place")).alias("rank"))
    short = rows.where(F.col("n_words") < least_words).select("id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return placed.union(short).withColumnRenamed("id", key)
