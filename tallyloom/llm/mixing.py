"""Mixing sources to target weights by the cube method.

Each source has a target number of words. A document of a source is taken
``target / source size`` times on average: the whole part always, the rest as
an inclusion probability of a balanced sample. The cube method moves the vector
of these probabilities at random inside the null space of the constraints, here
the words and the number of documents of the source, until every probability
but a few is 0 or 1. With two constraints a group of three documents always has
a direction to move in, so the flight walks through a group of documents with
three undecided at a time.

A source is split into groups of bounded size that fly on their own, each
leaving two documents undecided at most; those of all groups of the source fly
again, until one group is left. That last pair is the landing problem: the
documents are taken in part, so that the words still add up to the target.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import saved

#: The weights of sources in the order of their names, and the size of the mix.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
GROUP = 5_000
#: Equal rows are numbered in blocks of this size.
BLOCK = 10_000
_EPS = 1e-9


def sizes(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``(key, source, size)``: the words of each document."""
    words = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return docs.select(F.col(key), F.col(source).alias("source"), words.cast("long").alias("size"))


def numbered(sized: DataFrame, key: str) -> DataFrame:
    """The same rows with a column ``place`` that counts equal ones from 0.

    Equal rows are counted, not sorted, and the count is dealt out in blocks, so
    a third of all rows under one id is the work of many tasks.
    """
    counted = sized.groupBy(key, "source", "size").agg(F.count(F.lit(1)).alias("equal"))
    blocks = counted.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("equal") - 1) / BLOCK))))
    blocks = blocks.repartition(int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions")), key, "source", "size", "block")
    first = F.col("block") * BLOCK
    place = F.explode(F.sequence(first, F.least(first + BLOCK, F.col("equal")) - 1))
    return blocks.select(key, "source", "size", place.alias("place"))


def targets(sized: DataFrame, weights: Iterable[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(source, source_size, target)``: one row for each source.

    The whole is ``share`` of all words. Sources get it by weight; none gets
    more than ``most`` times its own words, and what is over goes to the others
    by weight, until none is above. Each round brings one row to the driver.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1  # one row a source
    kinds = [float(w) for w in weights]
    weight = F.element_at(F.array(*map(F.lit, kinds)), (place % len(kinds) + 1).cast("int"))
    known = saved(per_source.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most))))
    total = (known.agg(F.sum("source_size")).first()[0] or 0) * share
    level = 0.0
    while True:
        full = F.col("cap") <= F.lit(level) * F.col("weight")
        row = known.agg(F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("weight")))).first()
        rest = row[1] or 0.0
        higher = max(0.0, total - (row[0] or 0.0)) / rest if rest else level
        if higher <= level * (1 + 1e-12):
            break
        level = higher
    return known.select("source", "source_size", F.least("cap", F.lit(level) * F.col("weight")).alias("target"))


def fly(size: list[int], chance: list[float], seed: str) -> list[float]:
    """One flight over a group: all but two chances at most become 0 or 1, words and documents stay balanced."""
    rng = random.Random(int.from_bytes(hashlib.sha256(seed.encode()).digest()[:8], "big"))
    chance = list(chance)
    waiting: list[int] = []
    for i, c in enumerate(chance):
        if not _EPS < c < 1 - _EPS:
            chance[i] = float(round(c))
            continue
        waiting.append(i)
        if len(waiting) < 3:
            continue
        a, b, c3 = waiting
        move = (size[b] - size[c3], size[c3] - size[a], size[a] - size[b])
        if not any(move):
            move = (1, -1, 0)
        up = min((1 - chance[j]) / m if m > 0 else chance[j] / -m for j, m in zip(waiting, move) if m)
        down = min(chance[j] / m if m > 0 else (1 - chance[j]) / -m for j, m in zip(waiting, move) if m)
        step = up if rng.random() * (up + down) < down else -down
        for j, m in zip(waiting, move):
            chance[j] += step * m
            if not _EPS < chance[j] < 1 - _EPS:
                chance[j] = float(round(chance[j]))
        waiting = [j for j in waiting if 0.0 < chance[j] < 1.0]
    return chance


def _flight(seed: int):
    def flown(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["tie", "id_text", "size", "place"], kind="stable")
        first = frame.iloc[0]
        frame["chance"] = fly(frame["size"].tolist(), frame["chance"].tolist(), f"{seed}/{first['source']}/{first['tie']}")
        return frame

    return flown


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Iterable[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = 7,
    group: int = GROUP,
) -> DataFrame:
    """``(key, source, size, source_size, target, copies, part, taken)`` for each row of ``docs``.

    ``copies`` are taken whole and ``part`` words of one more, ``taken`` words
    in all. Null and empty texts have no words and are never taken; a null
    source is a source of its own, the last; repeated rows are documents each;
    equal rows are numbered and spread over the groups, in any order as they are
    interchangeable, so reruns give the same result. Other
    columns are not read; an empty table gives an empty result.
    """
    rows = saved(numbered(sizes(docs, key, text, source), key))
    goals = saved(targets(rows, weights, share, most))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    facts = F.broadcast(goals) if goals.count() <= 10_000 else goals  # one short row a source
    rows = rows.withColumnRenamed("source", "of").join(facts, F.col("of").eqNullSafe(F.col("source")))
    rows = rows.drop("of").withColumn("rate", rate).withColumn("copies", F.floor("rate"))
    rows = rows.withColumn("chance", F.when(F.col("size") > 0, F.col("rate") - F.col("copies")).otherwise(0.0))
    id_text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    rows = rows.withColumn("id_text", id_text).withColumn("tie", F.xxhash64(F.lit(seed), id_text, "size", "place"))
    open_ = (F.col("chance") > _EPS) & (F.col("chance") < 1 - _EPS)
    rows, done = saved(rows), []
    level = 0
    while True:
        # groups are numbered by a hash that changes with the level, their number by the rows still open
        count = rows.where(open_).groupBy("source").agg(F.count("*").alias("n")).withColumnRenamed("source", "s")
        count = saved(count.withColumn("groups", F.ceil(F.col("n") / F.lit(group))))
        most_groups = count.agg(F.max("groups")).first()[0] or 0
        if not most_groups:
            break
        done.append(rows.where(~open_))
        spread = rows.where(open_).join(F.broadcast(count) if goals.count() <= 10_000 else count, F.col("source").eqNullSafe(F.col("s")))
        spread = spread.withColumn("shard", F.pmod(F.xxhash64(F.lit(level), "tie"), "groups")).drop("s", "n", "groups")
        rows = saved(spread.groupBy("source", "shard").applyInPandas(_flight(seed + level), spread.schema).drop("shard"))
        level += 1
        if most_groups == 1:
            break
    for part in done:
        rows = rows.union(part)
    whole = F.col("copies") + F.when(F.col("chance") >= 1 - _EPS, 1).otherwise(0)
    landing = F.when(open_, F.round(F.col("chance") * F.col("size"))).otherwise(0).cast("long")
    out = rows.select(key, "source", "size", "source_size", "target", whole.cast("long").alias("copies"), landing.alias("part"))
    return out.withColumn("taken", F.col("copies") * F.col("size") + F.col("part"))


def first_words(text: Column, n: Column) -> Column:
    """A text up to the end of its ``n``-th word."""
    return F.when(n > 0, F.regexp_substr(text, F.concat(F.lit(r"^[\x20\x09-\x0D]*(?:[^\x20\x09-\x0D]+[\x20\x09-\x0D]*){"), n.cast("string"), F.lit("}"))))


def mixed_texts(docs: DataFrame, plan: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The mix itself: each row of ``docs`` with a key of the plan as often as taken whole, then in part. Keys are unique."""
    wanted = plan.where("copies > 0 or part > 0").select(F.col(key).alias("_key"), F.col("copies").alias("_copies"), F.col("part").alias("_part"))
    joined = docs.join(wanted, docs[key] == F.col("_key"))
    whole = joined.where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copy")
    cut = joined.where("_part > 0").withColumn(text, first_words(F.col(text), F.col("_part")))
    return whole.union(cut).drop("_key", "_copies", "_part")
