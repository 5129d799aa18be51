"""Chat formatting: conversations in reply order, with quotations resolved.

A message is cut into blocks of lines of one quote level ("> " once for each
level). Each block at level one or deeper is a quoted passage. Passages are
normalised (markers and runs of white space removed, lower-cased), hashed as a
whole and joined with the runs of unquoted lines, and the single lines, of
the conversation's messages: its original is the latest message before the quoting
one that has it whole. Failing that it is the earlier message with most of its
lines, the latest of those with equally many. A message replies to
the original of its shallowest quotation; without a known one it starts a
thread of its own. Messages are put in order by thread, each thread by depth of
reply and turn, and lose their quotations.

The latest holder is found in stretches of turns, without pairs. Lines with more
than ``COMMON`` holders are counted for every candidate that other lines of the
passage bring; for the rest, messages with the same set of such lines form a
class, passages are compared with classes, and the latest earlier member of each
class that shares a line is a candidate. Reply chains are followed by pointer doubling, and places in
a conversation come from counts per stretch of threads, not from a sort of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import salted_join, saved

#: Shorter lines of a passage that nobody wrote as a whole do not count: they are equal by chance.
LINE_CHARS = 4
#: Lines that more messages of a conversation have are compared by the classes of messages that have the same of them.
COMMON = 64
#: Threads whose first messages have turns in one stretch of this many are ordered together.
STRETCH = 256


def quote_level(line: str) -> tuple[int, str]:
    """How often a line is quoted, and what is left of it."""
    level, rest = 0, line
    while True:
        bare = rest.lstrip(" \t")
        if not bare.startswith(">"):
            return level, rest if level == 0 else bare
        level, rest = level + 1, bare[1:]


def normalised(line: str) -> str:
    return " ".join(line.lower().split())


def parsed(text: str | None) -> tuple[str | None, list[tuple[int, int, str]], list[str]]:
    """The text without quotations, its quoted lines as (passage, level, normalised line), and its own normalised lines."""
    if text is None:
        return None, [], []
    kept, quoted, own = [], [], []
    passage, before = -1, 0
    for line in text.split("\n"):
        level, rest = quote_level(line)
        if level == 0:
            kept.append(line)
            own.append(normalised(rest))
        else:
            if level != before:
                passage += 1
            quoted.append((passage, level, normalised(rest)))
        before = level
    body = "\n".join(kept).strip("\n") if quoted else text
    return body, [q for q in quoted if q[2]], [x for x in own if x]


def runs_of(text: str | None) -> list[str]:
    """The runs of own lines between quotations, each as its normalised lines."""
    runs: list[list[str]] = [[]]
    for line in (text or "").split("\n"):
        if quote_level(line)[0]:
            runs.append([])
        else:
            runs[-1] += parsed(line)[2]
    return ["\n".join(r) for r in runs if r]


_PARSED = "body string, quoted array<struct<passage int, level int, line string>>, own array<string>, runs array<string>, n_quoted int"


def _parse(text: Column) -> Column:
    @F.pandas_udf(_PARSED)
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = [parsed(t) for t in texts]
            yield pd.DataFrame(
                {
                    "body": [b for b, _, _ in rows],
                    "quoted": [[{"passage": p, "level": n, "line": x} for p, n, x in q] for _, q, _ in rows],
                    "own": [o for _, _, o in rows],
                    "runs": [runs_of(t) for t in texts],
                    "n_quoted": [sum(quote_level(x)[0] > 0 for x in (t or "").split("\n")) for t in texts],
                }
            )

    return parse(text)


def _roots(links: DataFrame) -> DataFrame:
    """``(node, root, depth)`` of messages that reply to another, by pointer doubling over ``(node, parent)``."""
    hops = saved(links.select("node", F.col("parent").alias("up"), F.lit(1).cast("long").alias("depth")))
    while True:
        further = hops.select(F.col("node").alias("n"), F.col("up").alias("next"), F.col("depth").alias("more"))
        joined = salted_join(hops, further.withColumnRenamed("n", "up"), "up", F.col("node"), "left")
        hops = saved(joined.select("node", F.coalesce("next", "up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("next").isNotNull().alias("moved")))
        if not hops.where("moved").take(1):
            return hops.select("node", F.col("up").alias("root"), "depth")
        hops = hops.drop("moved")


def _latest(asks: DataFrame, holders: DataFrame) -> DataFrame:
    """``asks`` ``(key, turn, node, ask)`` with ``had``, the ``(turn, node)`` of the last holder of the key before them, or null."""
    none = F.lit(None).cast(asks.schema["ask"].dataType)
    had = F.struct("turn", "node")
    rows = holders.select("key", "turn", "node", none.alias("ask"), had.alias("own"))
    rows = rows.union(asks.select("key", "turn", "node", "ask", F.when(F.lit(False), had).alias("own")))
    rows = rows.withColumn("part", F.struct("key", F.floor(F.col("turn") / STRETCH).alias("stretch")))
    # a message is asked for before it holds
    order = Window.partitionBy("part").orderBy("turn", "node", F.col("own").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    near = rows.withColumn("near", F.last("own", ignorenulls=True).over(order)).where("ask is not null")
    ends = rows.groupBy("part").agg(F.max("own").alias("own"))
    before = Window.partitionBy("part.key").orderBy("part.stretch").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("part", F.max("own").over(before).alias("far"))
    joined = salted_join(near.drop("own"), ends, "part", F.col("node"))
    return joined.select("key", "ask", F.coalesce("near", "far").alias("had"))


def _common_votes(common: DataFrame, held: DataFrame) -> DataFrame:
    """``(ask, had, n)``: for each passage and class of messages that have the same common lines, how many lines of the
    passage those have, with the latest of them before it.

    ``common`` ``(key, turn, node, ask, times)`` holds the common lines of the
    passages, ``held`` ``(key, turn, node)`` those of the messages. Only
    distinct sets of lines are paired, however many passages and messages have them.
    """
    named = lambda c: F.struct("conv", F.xxhash64(c).alias("x"), F.xxhash64(F.lit(3), c).alias("y"))
    members = held.groupBy(F.col("key.conv").alias("conv"), "turn", "node").agg(F.sort_array(F.collect_list("key")).alias("lines"))
    members = saved(members.select(named("lines").alias("class"), "lines", "turn", "node"))
    asks = common.groupBy(F.col("key.conv").alias("conv"), "turn", "node", "ask").agg(F.sort_array(F.collect_list(F.struct("key", "times"))).alias("lines"))
    asks = saved(asks.select(named("lines").alias("wanted"), "lines", "turn", "node", "ask"))
    wanted = asks.groupBy("wanted").agg(F.any_value("lines").alias("lines")).select("wanted", F.inline("lines"))
    classes = members.groupBy("class").agg(F.any_value("lines").alias("lines")).select("class", F.explode("lines").alias("k"))
    shared = wanted.join(classes, F.col("key").eqNullSafe(F.col("k"))).groupBy("wanted", "class").agg(F.sum("times").alias("n"))
    shared = shared.withColumnRenamed("wanted", "w")
    pairs = asks.drop("lines").join(shared, F.col("wanted").eqNullSafe(F.col("w")))
    pairs = pairs.select(F.col("class").alias("key"), "turn", "node", F.struct("ask", "n").alias("ask"))
    latest = _latest(pairs, members.select(F.col("class").alias("key"), "turn", "node")).where("had is not null")
    return latest.select("ask.ask", "had", "ask.n")


def link_quotations(messages: DataFrame) -> DataFrame:
    """``(node, passage, level, original, share)``: the original message of each quoted passage that has one.

    ``messages`` has ``node``, ``conv``, ``turn``, ``quoted``, ``own`` and
    ``runs``. ``share`` is the part of the passage's lines that the original
    has, of those with ``LINE_CHARS`` characters if it does not have all.
    """
    key = lambda c: F.struct("conv", F.xxhash64(c).alias("x"), F.xxhash64(F.lit(3), c).alias("y")).alias("key")
    held = lambda c: messages.select("conv", "node", "turn", F.explode(F.array_distinct(c)).alias("held")).select(key("held"), "node", "turn")
    own = saved(held("own"))
    lines = messages.select("conv", "node", "turn", F.posexplode("quoted").alias("at", "q")).select("conv", "node", "turn", "at", "q.*")
    passages = lines.groupBy("conv", "node", "turn", "passage", "level").agg(F.sort_array(F.collect_list(F.struct("at", "line"))).alias("lines"))
    passages = passages.select("conv", "node", "turn", "passage", "level", F.col("lines.line").alias("lines"))
    asks = passages.select(key(F.array_join("lines", "\n")), "node", "turn", F.struct("conv", "node", "turn", "passage", "level", "lines").alias("ask"))
    whole = saved(_latest(asks, held("runs").union(own).distinct()))
    found = whole.where("had is not null").select("ask.node", "ask.passage", "ask.level", F.col("had.node").alias("original"), F.lit(1.0).alias("share"))
    rest = whole.where("had is null").select("ask.*").where(F.size("lines") > 1)
    rest = rest.withColumn("lines", F.filter("lines", lambda x: F.length(x) >= LINE_CHARS))
    rest = rest.select("conv", "turn", F.struct("node", "passage", "level", "turn", F.size("lines").alias("n")).alias("ask"), "node", F.explode("lines").alias("line"))
    rest = rest.groupBy(key("line"), "turn", "node", "ask").agg(F.count("*").alias("times"))
    counts = own.groupBy("key").agg(F.count("*").alias("holders"))
    rest = saved(salted_join(rest, counts, "key", F.col("node")))
    holders = own.select(F.col("key").alias("k"), F.struct("turn", "node").alias("had"))
    earlier = F.col("had") < F.struct("turn", "node")
    rare = rest.where(F.col("holders") <= COMMON).join(holders, F.col("key").eqNullSafe(F.col("k")) & earlier).select("ask", "had", "times")
    rare = saved(rare)
    common = saved(rest.where(F.col("holders") > COMMON))
    candidates = rare.select("ask", "had").distinct()
    asked = common.select(F.col("ask").alias("of"), "key", "times").join(candidates, F.col("of") == F.col("ask"))
    asked = asked.join(holders.withColumnRenamed("had", "has"), F.col("key").eqNullSafe(F.col("k")) & (F.col("had") == F.col("has")))
    votes = rare.union(asked.select("ask", "had", "times")).groupBy("ask", "had").agg(F.sum("times").alias("n"))
    votes = votes.union(_common_votes(common, salted_join(own, counts.where(F.col("holders") > COMMON), "key", F.col("node"))))
    best = votes.groupBy("ask").agg(F.max(F.struct((F.col("n") / F.col("ask.n")).alias("share"), "had")).alias("b"))
    return found.union(best.select("ask.node", "ask.passage", "ask.level", "b.had.node", "b.share"))


def conversations(table: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, place, turn, role, body, reply_to, root_turn, depth, n_quoted, n_linked)`` for each row of ``table``.

    ``place`` counts messages of the conversation from 0 in reply order;
    ``body`` is the text without quotations; ``reply_to`` and ``root_turn`` are
    turns. Null texts stay null and quote nothing; a text of quotations only has
    an empty body. Rows with a null conversation form one together; null turns come
    last in it. Rows that repeat a turn are messages each, in an order of
    their role and text; equal rows are interchangeable. Other columns are not
    read; an empty table gives an empty result.
    """
    rows = table.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    rows = rows.withColumn("turn", F.coalesce("turn", F.lit(2**62)))
    rows = rows.select("conv", "turn", "role", _parse(F.col("text")).alias("p"), F.xxhash64("role", "text").alias("tie"))
    rows = saved(rows.select("conv", "turn", "role", "p.*", F.struct("tie", F.monotonically_increasing_id().alias("id")).alias("node")))
    links = saved(link_quotations(rows))
    counts = links.groupBy("node").agg(F.min(F.struct("level", "passage", "original")).alias("b"), F.count("*").cast("int").alias("n_linked"))
    counts = saved(counts.select("node", F.col("b.original").alias("parent"), "n_linked"))
    roots = _roots(counts).join(counts, "node")
    turns = rows.select(F.col("node").alias("n"), F.col("turn").alias("t"))
    roots = salted_join(roots, turns.withColumnRenamed("n", "parent").withColumnRenamed("t", "reply_to"), "parent", F.col("node"))
    roots = salted_join(roots, turns.withColumnRenamed("n", "root").withColumnRenamed("t", "root_turn"), "root", F.col("node"))
    roots = roots.select(F.col("node").alias("m"), "root", "root_turn", "reply_to", "depth", "n_linked")
    full = rows.join(roots, F.col("node") == F.col("m"), "left").select(
        "conv", "turn", "role", "body", "n_quoted", "node", "reply_to",
        F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("root", "node").alias("root"),
        F.coalesce("depth", F.lit(0)).cast("int").alias("depth"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
    )
    placed = _placed(saved(full))
    shown = lambda c: F.when(F.col(c) < 2**62, F.col(c)).alias(c)
    return placed.select(
        F.col("conv").alias(conv), "place", shown("turn").alias(turn), F.col("role").alias(role), "body", shown("reply_to"), shown("root_turn"), "depth", "n_quoted", "n_linked"
    )


def _placed(rows: DataFrame) -> DataFrame:
    """Adds ``place``. Stretches of threads are ordered alone; how many messages come before a stretch is summed from counts."""
    rows = rows.withColumn("stretch", F.floor(F.col("root_turn") / STRETCH))
    sizes = rows.groupBy("conv", "stretch").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.partitionBy("conv").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(F.struct("conv", "stretch").alias("part"), F.coalesce(before, F.lit(0)).alias("before"))
    order = Window.partitionBy("conv", "stretch").orderBy("root_turn", "root", "depth", "turn", "node")
    ranked = rows.withColumn("rank", F.row_number().over(order)).withColumn("part", F.struct("conv", "stretch"))
    return salted_join(ranked, saved(sizes), "part", F.col("node")).withColumn("place", F.col("before") + F.col("rank") - 1)
