"""Grouping of spelling variants with k-d trees over letter counts.

A word is a point: how often it has each letter. One inserted or deleted letter
moves it by one in Manhattan distance and one replaced letter by two at most, so
the words near a word of some length lie within two among the words of its own
length and within one among those one letter longer.

The space of each length is cut into cells by a k-d tree grown on a bounded
sample of words. Every word is entered into its own cell and asks in each cell
whose box is within the distance: in those of its own length and of the next. In
a cell a k-d tree with tight boxes is grown over its points, all questions walk down it
together, and whatever is left at a leaf is compared letter by letter. A
cell tells each word how many near words it found and the most frequent of
them, so results grow with the words and not with the pairs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import lower_ascii, saved

RUN = r"[a-zÀ-ÿ]+"
LENGTH, LEAST = 5, 3
#: A form is that many times as frequent as its word.
TIMES = 2
#: One run in so many loses a letter.
MODULUS = 97
#: Most words that the cells are grown on, and points that a cell is meant to hold.
SAMPLE, CELL = 32_768, 4_096
LEAF = 32
DIMS = 32
#: Elements of an intermediate array.
WIDE = 1 << 21

#: The coordinate of each code point: a-z, then the other letters over what is left. Letters that share one only bring words closer.
_COORDINATE = np.array([c - 97 if 97 <= c < 123 else 26 + c % (DIMS - 26) for c in range(256)], np.int64)


class Tree(NamedTuple):
    """Nodes by number, the root first, where they are cut and into which; leaves have no cut.

    ``start`` to ``end`` is what the cuts leave of all space, ``lo`` to ``hi`` the box of the points themselves if the tree is ``tight``.
    """

    start: np.ndarray
    end: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    tight: bool
    dim: list[int]
    cut: list[int]
    below: list[tuple[int, int] | None]
    rows: list[np.ndarray]

    def cells(self, points: np.ndarray) -> np.ndarray:
        """The leaf that each point lies in."""
        out, waiting = np.zeros(len(points), np.int64), [(0, np.arange(len(points)))]
        while waiting:
            node, rows = waiting.pop()
            if self.below[node] is None:
                out[rows] = node
            elif len(rows):
                low = points[rows, self.dim[node]] <= self.cut[node]
                waiting += zip(self.below[node], (rows[low], rows[~low]))
        return out

    def reach(self, points: np.ndarray, distance: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves, each with the points whose distance to its box is small enough.

        On the way down only the coordinate that a cut bounds is looked at; a leaf's whole box is compared at the end.
        """
        waiting = [(0, np.arange(len(points)), np.zeros(len(points), np.int64))]
        while waiting:
            node, rows, gap = waiting.pop()
            if self.below[node] is None:
                here = points[rows]
                outside = np.maximum(self.lo[node] - here, 0) + np.maximum(here - self.hi[node], 0)
                rows = rows[outside.sum(1, dtype=np.int64) <= distance] if self.tight else rows
                if len(rows):
                    yield node, rows
                continue
            at, cut = points[rows, self.dim[node]].astype(np.int64), self.cut[node]
            # a point on the far side of a cut is at least that far off, whatever was added for this coordinate before
            for child, off in zip(self.below[node], (at - cut, cut + 1 - at)):
                beyond = np.maximum(off, 0)
                before = np.maximum(self.start[node, self.dim[node]] - at, 0) + np.maximum(at - self.end[node, self.dim[node]], 0)
                far = gap + np.maximum(beyond - before, 0)
                near = far <= distance
                if near.any():
                    waiting.append((child, rows[near], far[near]))


#: Counts beyond this are as good as this: words stay as near or come nearer.
MOST = 1_000


def grow(points: np.ndarray, leaf: float, tight: bool) -> Tree:
    """Cuts at the median of the widest coordinate until at most ``leaf`` points, or equal ones, are left."""
    start, end = [np.full(DIMS, -1, np.int16)], [np.full(DIMS, MOST + 1, np.int16)]
    dim, cut, below, rows = [-1], [0], [None], [np.arange(len(points))]
    waiting = [0]
    while waiting:
        node = waiting.pop()
        here = points[rows[node]]
        if len(here) <= leaf:
            continue
        spread = here.var(0)
        d = int(spread.argmax())
        if spread[d] == 0:
            continue
        at = int(np.median(here[:, d]))
        at -= at >= here[:, d].max()
        low = here[:, d] <= at
        dim[node], cut[node], below[node] = d, at, (len(dim), len(dim) + 1)
        for side, part in ((0, rows[node][low]), (1, rows[node][~low])):
            start.append(start[node].copy())
            end.append(end[node].copy())
            (start, end)[1 - side][-1][d] = at + side
            dim.append(-1)
            cut.append(0)
            below.append(None)
            rows.append(part)
            waiting.append(len(dim) - 1)
        rows[node] = rows[node][:0]
    lo, hi = np.array(start), np.array(end)
    if tight:
        for node, part in enumerate(rows):
            if len(part):
                lo[node], hi[node] = points[part].min(0), points[part].max(0)
    return Tree(np.array(start), np.array(end), lo, hi, tight, dim, cut, below, rows)


def letters(words: list[str], length: int) -> np.ndarray:
    """Words of one length as rows of code points, none of which is above 255."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def letter_counts(rows: np.ndarray) -> np.ndarray:
    n, length = rows.shape
    out = np.zeros((n, DIMS), np.int16)
    step = max(1, WIDE // max(length, DIMS))
    for i in range(0, n, step):
        part = _COORDINATE[rows[i : i + step]] + np.arange(len(rows[i : i + step]))[:, None] * DIMS
        out[i : i + step] = np.minimum(np.bincount(part.ravel(), minlength=len(part) * DIMS).reshape(-1, DIMS), MOST)
    return out


def replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of one length differ in exactly one place."""
    return (a != b).sum(1) == 1


def inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether a letter put somewhere into a row of ``a`` makes that of ``b``: what both begin and end with covers all of ``a``."""
    same = lambda x, y: np.where((x == y).all(1), x.shape[1], (x != y).argmax(1))
    return same(a, b[:, :-1]) + same(a[:, ::-1], b[:, :0:-1]) >= a.shape[1]


def near_pairs(asking: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row of asking, row of points)`` of all pairs one edit apart; points are as long as what asks, or one letter longer."""
    longer = points.shape[1] > asking.shape[1]
    judge, distance = (inserted, 1) if longer else (replaced, 2)
    q, p = letter_counts(asking), letter_counts(points)
    tree, found = grow(p, LEAF, True), [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for leaf, rows in tree.reach(q, distance):
        there = tree.rows[leaf]
        # equal points do not part, so a leaf can be large
        for j in range(0, len(there), 1024):
            some = there[j : j + 1024]
            step = max(1, WIDE // (len(some) * DIMS))
            for i in range(0, len(rows), step):
                part = rows[i : i + step]
                a, b = np.nonzero(np.abs(q[part][:, None] - p[some][None]).sum(2, dtype=np.int16) <= distance)
                found += _judged(asking, points, part[a], some[b], judge)
    return tuple(np.concatenate(x) for x in zip(*found))


def _judged(asking: np.ndarray, points: np.ndarray, a: np.ndarray, b: np.ndarray, judge) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    step = max(1, WIDE // points.shape[1])
    for i in range(0, len(a), step):
        near = judge(asking[a[i : i + step]], points[b[i : i + step]])
        yield a[i : i + step][near], b[i : i + step][near]


def words_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word``: one row for each run of letters of ``LENGTH`` or more, after the letter that its hash may delete."""
    runs = F.regexp_extract_all(lower_ascii(F.coalesce(F.col(text), F.lit(""))), F.lit(RUN), F.lit(0))
    long = F.filter(runs, lambda run: F.length(run) >= LENGTH)
    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.explode(long).alias("run"))
    h, run = F.crc32(F.concat_ws(":", "id", "run")), F.col("run")
    place = F.pmod(h, F.length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.length(run)))
    word = F.when(F.pmod(h, F.lit(MODULUS)) == 0, shorter).otherwise(run)
    return rows.select(word.alias("word")).where(F.length("word") >= LENGTH)


def frequent(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """``(word, n)`` of the words that occur ``least`` times or more in all."""
    return words_of(docs, key, text).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _by_length(words: pd.Series) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(length, rows, their letter counts)``."""
    lengths = words.str.len().to_numpy()
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        step = max(1, WIDE // int(length))
        parts = [letter_counts(letters(words.iloc[rows[i : i + step]].tolist(), int(length))) for i in range(0, len(rows), step)]
        yield int(length), rows, np.concatenate(parts)


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for length, _, counts in _by_length(frame["word"]):
            yield pd.DataFrame({"length": length, "counts": counts.tolist()})


_ENTRY = "length int, cell int, chunk int, asks boolean, word string, n bigint"


def _entered(trees: dict[int, Tree], chunks: dict[tuple[int, int], int]):
    """Every word as a point of its cell and as a question to the cells in reach; a length without a tree is one cell."""

    def rows(words: pd.DataFrame, length: int, cell: int, asks: bool) -> Iterator[pd.DataFrame]:
        n = chunks.get((length, cell), 1)
        entry = words.assign(length=length, cell=cell, asks=asks)
        if asks:
            for chunk in range(n):
                yield entry.assign(chunk=chunk)
        else:
            yield entry.assign(chunk=[zlib.crc32(w.encode()) % n for w in words["word"]] if n > 1 else 0)

    def enter(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in _ENTRY.split(", ")]
        for frame in frames:
            for length, where, counts in _by_length(frame["word"]):
                words, own, next_ = frame.iloc[where], trees.get(length), trees.get(length + 1)
                cells = own.cells(counts) if own else np.zeros(len(words), np.int64)
                parts = [part for cell in np.unique(cells) for part in rows(words[cells == cell], length, int(cell), False)]
                for tree, at, distance in ((own, length, 2), (next_, length + 1, 1)):
                    reached = tree.reach(counts, distance) if tree else [(0, np.arange(len(words)))]
                    parts += [part for cell, some in reached for part in rows(words.iloc[some], at, cell, True)]
                yield pd.concat(parts)[columns]

    return enter


_FOUND = "word string, n_near bigint, form_n bigint, form string"


def _answered(frame: pd.DataFrame) -> pd.DataFrame:
    """What a cell tells its words: how many near ones it holds and the most frequent of them."""
    length, points = int(frame["length"].iloc[0]), frame[~frame["asks"]]
    links = []
    if len(points):
        there, asking, sizes = letters(points["word"].tolist(), length), frame[frame["asks"]], frame.loc[frame["asks"], "word"].str.len()
        for size in (length, length - 1):
            some = asking[sizes == size]
            if len(some):
                a, b = near_pairs(letters(some["word"].tolist(), size), there)
                pair = some.iloc[a].reset_index(drop=True), points.iloc[b].reset_index(drop=True)
                # words of one length ask for each other; of two lengths only the shorter one asks
                for one, other in (pair, pair[::-1])[: 1 if size == length else 2]:
                    links.append(pd.DataFrame({"word": one["word"], "form_n": other["n"], "form": other["word"]}))
    if not links:
        return pd.DataFrame({c: pd.Series(dtype=t) for c, t in (("word", object), ("n_near", int), ("form_n", int), ("form", object))})
    every = pd.concat(links).sort_values(["word", "form_n", "form"], ascending=[True, False, True])
    best = every.groupby("word", sort=False).agg(n_near=("form", "size"), form_n=("form_n", "first"), form=("form", "first"))
    return best.reset_index()[["word", "n_near", "form_n", "form"]]


def near_words(counts: DataFrame, sample: int = SAMPLE, cell: int = CELL) -> DataFrame:
    """``(word, n_near, form_n, form)`` of ``(word, n)``: words that have near ones, and the most frequent near one, ties to the smallest."""
    total = counts.count()
    share = min(1.0, sample / max(total, 1))
    learnt = counts.select("word")
    if share < 1:
        learnt = learnt.where(F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30))).limit(2 * sample)
    # letter counts of a bounded number of words
    learnt = learnt.mapInPandas(_counted, "length int, counts array<bigint>").toPandas()
    trees, chunks = {}, {}
    for length, part in learnt.groupby("length"):
        points = np.array(part["counts"].tolist(), np.int16)
        tree = grow(points, max(16, cell * share), False)
        chunks |= {(int(length), node): max(1, round(len(rows) / share / (2 * cell))) for node, rows in enumerate(tree.rows)}
        trees[int(length)] = tree._replace(rows=[])
    entries = counts.mapInPandas(_entered(trees, chunks), _ENTRY)
    found = entries.groupBy("length", "cell", "chunk").applyInPandas(_answered, _FOUND)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form"), F.col("form_n").alias("form_n"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", "best.form_n", "best.form")


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``(word, form)``: the last of the forms that follow each other; steps double in every round."""
    state = saved(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = state.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        joined = state.join(ahead, F.col("root") == F.col("_w"), "left")
        state = saved(joined.select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")))
        if not state.where("moved").take(1):
            return state.select("word", "root")
        state = state.drop("moved")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, sample: int = SAMPLE, cell: int = CELL) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for each word of ``LENGTH`` letters or more that occurs ``least`` times or more.

    Words are runs of the letters A-Z, a-z and U+00C0 to U+00FF, A-Z
    lower-cased; a hash of id and run deletes a letter of one run in ``MODULUS``.
    Two words are near if one letter is inserted, deleted or replaced. ``form``
    is the near word of largest ``n``, the smallest by code point among equals, if it
    occurs ``TIMES`` as often, else null; ``root`` follows forms to the last.
    Null and empty texts have no words; a null id counts as an empty one;
    repeated rows count each; words may be of any length. Other columns are not
    read; an empty table, or one without such words, gives an empty result.
    """
    counts = saved(frequent(docs, key, text, least))
    facts = near_words(counts, sample, cell).withColumnRenamed("word", "_word")
    known = counts.join(facts, F.col("word") == F.col("_word"), "left")
    formed = F.col("form_n") >= TIMES * F.col("n")
    known = known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("form")).alias("form"), F.when(formed, F.col("form_n")).alias("form_n"),
    )
    known = saved(known)
    found = roots(known.where("form is not null")).withColumnRenamed("word", "_word")
    out = known.join(found, F.col("word") == F.col("_word"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
