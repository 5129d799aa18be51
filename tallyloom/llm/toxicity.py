"""Toxicity categories by a chain of linear classifiers.

``labels`` marks documents as toxic or not. Two categories of severity are
derived from it: *frequent* (toxic, with several marker words) and *dense*
(toxic, markers being a large share of the words), where markers are words or
word beginnings found almost only in toxic training documents. The chain predicts
frequent, then dense given the probability of frequent, then toxic given both.
Each link is a logistic regression on the presence of selected words and word
beginnings; the probabilities that later links are trained on come from models
that have not seen the document (five folds), as they will at prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import saved
from tallyloom.llm.decontaminate import split_words
from tallyloom.llm.quality import held_out, labelled_sample

#: The largest number of labelled documents that the chain is trained on, and of features it keeps.
SAMPLE, FEATURES = 6_000, 2_000
CATEGORIES = ("frequent", "dense", "toxic")
FREQUENT, DENSE = 4, 0.01
PREFIXES = (4, 5, 6)
FOLDS = 5
THRESHOLD = 0.5
#: What makes a marker, and how often and how clearly (in standard deviations) a feature must lean to one side.
_PURE, _SEEN, _CLEAR = 0.9, 3, 3.0


def word_features(word: bytes) -> list[str]:
    """A word and its beginnings."""
    name = word.decode("latin-1")
    return [name, *(f"{name[:n]}*" for n in PREFIXES if len(name) > n)]


def _squash(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Rows:
    """Documents as sparse sets of feature numbers and dense columns."""

    owner: np.ndarray
    feature: np.ndarray
    dense: np.ndarray

    def pick(self, keep: np.ndarray) -> Rows:
        place = np.cumsum(keep) - 1
        inside = keep[self.owner]
        return Rows(place[self.owner[inside]], self.feature[inside], self.dense[keep])

    def with_column(self, column: np.ndarray) -> Rows:
        return Rows(self.owner, self.feature, np.column_stack([self.dense, column]))


@dataclass
class Link:
    sparse: np.ndarray
    dense: np.ndarray
    bias: float

    def predict(self, rows: Rows) -> np.ndarray:
        odds = np.bincount(rows.owner, self.sparse[rows.feature], len(rows.dense))
        return _squash(odds + rows.dense @ self.dense + self.bias)


def fit_link(rows: Rows, y: np.ndarray, n_features: int, rounds: int = 250, rate: float = 0.05, decay: float = 2e-4) -> Link:
    """A logistic regression with a ridge, by Adam."""
    n, d = len(y), rows.dense.shape[1]
    if n == 0 or y.min() == y.max():
        share = (y.sum() + 0.5) / (n + 1)
        return Link(np.zeros(n_features), np.zeros(d), float(np.log(share / (1 - share))))
    w = np.zeros(n_features + d + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        link = Link(w[:n_features], w[n_features:-1], w[-1])
        gap = y - link.predict(rows)
        slope = np.concatenate([np.bincount(rows.feature, gap[rows.owner], n_features), rows.dense.T @ gap, [gap.sum()]]) / n
        slope[:-1] -= decay * w[:-1]
        m += 0.1 * (slope - m)
        v += 0.001 * (slope * slope - v)
        w += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return Link(w[:n_features].copy(), w[n_features:-1].copy(), float(w[-1]))


@dataclass
class Chain:
    """The links, the numbers of features by name, and which of them are markers."""

    links: list[Link]
    numbers: dict[str, int]
    markers: np.ndarray
    memory: dict = field(default_factory=dict)

    MOST = 500_000

    def __getstate__(self):
        return self.__dict__ | {"memory": {}}

    def features_of(self, word: bytes) -> tuple[int, ...]:
        got = self.memory.get(word)
        if got is None:
            if len(self.memory) >= self.MOST:
                self.memory.clear()
            got = self.memory[word] = tuple(n for x in word_features(word) if (n := self.numbers.get(x)) is not None)
        return got

    def counted(self, text: str | None) -> tuple[list[int], int, int]:
        """The features a text has, and how many of its words are markers, of how many."""
        words = split_words(text)
        hits = [f for f in map(self.features_of, words) if f]
        return sorted({n for f in hits for n in f}), sum(any(self.markers[n] for n in f) for f in hits), len(words)

    def predict(self, texts: list[str | None]) -> np.ndarray:
        rows, out = as_rows([self.counted(x) for x in texts]), []
        for link in self.links:
            out.append(link.predict(rows))
            rows = rows.with_column(out[-1])
        return np.column_stack(out)


def as_rows(counted: list[tuple[list[int], int, int]]) -> Rows:
    """Documents from what ``Chain.counted`` says of them."""
    owner = np.repeat(np.arange(len(counted)), np.array([len(c[0]) for c in counted], np.int64))
    marked, words = (np.array([c[i] for c in counted], float) for i in (1, 2))
    dense = np.column_stack([np.log1p(marked), np.log1p(100 * marked / np.maximum(1, words))])
    return Rows(owner, np.array([n for c in counted for n in c[0]], np.int64), dense)


@dataclass
class View:
    """The sample as it looks with one choice of features and markers."""

    chain: Chain
    rows: Rows
    targets: list[np.ndarray]

    def fitted(self, category: int, keep: np.ndarray | slice = slice(None)) -> Link:
        rows = self.rows if isinstance(keep, slice) else self.rows.pick(keep)
        return fit_link(rows, self.targets[category][keep], len(self.chain.numbers))


def train(whole: View, blind: list[View], fold: np.ndarray) -> list[Link]:
    """One link for each category, later ones fed with out-of-fold probabilities of earlier ones.

    ``blind`` has a view for each fold whose features, markers and targets were
    chosen without that fold's marks.
    """
    links = []
    for category in range(len(CATEGORIES)):
        links.append(whole.fitted(category))
        unseen = np.zeros(len(fold))
        for k, view in enumerate(blind):
            out = fold == k
            if out.any():
                unseen[out] = view.fitted(category, ~out).predict(view.rows.pick(out))
        for view in (whole, *blind):
            view.rows = view.rows.with_column(unseen)
    return links


def _chosen(counts: DataFrame, totals: dict, out: int | None) -> Chain:
    """The clearest features and the markers among them, from all rows but those of fold ``out``."""
    less = lambda c: F.col(c) - (F.col(f"{c}{out}") if out is not None else 0)
    t, n = (totals[c] - (totals[f"{c}{out}"] if out is not None else 0) for c in "tn")
    rate = t / max(1, n)
    kept = counts.select("name", less("t").alias("t"), less("n").alias("n"))
    lift = (F.col("t") - rate * F.col("n")) / F.sqrt(F.col("n") + 1.0)
    clear = F.abs(lift) >= _CLEAR * (rate * (1 - rate)) ** 0.5
    best = kept.where((F.col("n") >= _SEEN) & clear).orderBy(F.abs(lift).desc(), "name").limit(FEATURES).collect()  # bounded
    markers = np.array([r["t"] >= _PURE * r["n"] and r["t"] > 0 for r in best], bool)
    return Chain([], {r["name"]: i for i, r in enumerate(best)}, markers)


def views(sample: DataFrame) -> tuple[View, list[View], np.ndarray]:
    """The view of all rows of ``sample``, those of the folds, and each row's fold.

    Texts are read by the tasks; the driver gets feature numbers and counts.
    """

    @F.pandas_udf("array<string>")
    def features(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: sorted({f for w in set(split_words(x)) for f in word_features(w)}))

    sample = saved(sample.select("key", "mark", F.pmod(F.xxhash64("key"), F.lit(FOLDS)).alias("fold"), F.coalesce("text", F.lit("")).alias("text")))
    zero = lambda c: F.coalesce(c, F.lit(0))
    sums = [zero(F.sum("mark")).alias("t"), F.count("*").alias("n")]
    for k in range(FOLDS):
        sums += [zero(F.sum(F.when(F.col("fold") == k, F.col("mark")))).alias(f"t{k}"), F.count_if(F.col("fold") == k).alias(f"n{k}")]
    totals = sample.agg(*sums).first().asDict()
    counts = saved(sample.select("mark", "fold", F.explode(features("text")).alias("name")).groupBy("name").agg(*sums))
    chains = [_chosen(counts, totals, out) for out in (None, *range(FOLDS))]

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for i, chain in enumerate(chains):
                found = pd.DataFrame(map(chain.counted, frame["text"]), columns=["features", "marked", "words"])
                yield frame[["key", "mark", "fold"]].reset_index(drop=True).assign(choice=i).join(found)

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sample.schema if f.name != "text")
    kind = f"{types}, choice int, features array<int>, marked int, words int"
    found = sorted(sample.mapInPandas(counted, kind).collect(), key=lambda r: (r["choice"], r["key"]))  # bounded like the sample
    size = len(found) // len(chains)
    got = []
    for i, chain in enumerate(chains):
        mine = found[i * size : (i + 1) * size]
        toxic, marked, words = (np.array([r[c] for r in mine], float) for c in ("mark", "marked", "words"))
        targets = [toxic * (marked >= FREQUENT), toxic * (marked >= DENSE * np.maximum(words, 1)), toxic]
        got.append(View(chain, as_rows([(r["features"], r["marked"], r["words"]) for r in mine]), targets))
    return got[0], got[1:], np.array([r["fold"] for r in found[:size]], np.int64)


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, key: str = "doc_id", text: str = "text") -> Chain:
    """Trains on a bounded sample of the labelled rows that are not held out."""
    whole, blind, fold = views(labelled_sample(docs, labels, "toxic", most, key, text))
    whole.chain.links = train(whole, blind, fold)
    return whole.chain


def scores(chain: Chain, text: Column) -> Column:
    """The probabilities of the categories as a struct column."""
    kind = ", ".join(f"{c} double" for c in CATEGORIES)

    @F.pandas_udf(kind)
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(chain.predict(texts.tolist()), columns=list(CATEGORIES))

    return predicted(F.coalesce(text, F.lit("")))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, held_out, p_frequent, p_dense, score, predicted)`` for each row of ``docs``; score is P(toxic).

    Null and empty texts have no features; texts of any length are read whole;
    repeated rows are scored each. Rows of ``labels`` without id or mark teach
    nothing; of repeated ones the larger mark holds. Without toxic labels
    nothing is toxic. Other columns are not read; an empty table gives an empty
    result.
    """
    rated = docs.select(key, held_out(F.col(key)).alias("held_out"), scores(fit(docs, labels, key=key, text=text), F.col(text)).alias("p"))
    rated = rated.select(key, "held_out", F.col("p.frequent").alias("p_frequent"), F.col("p.dense").alias("p_dense"), F.col("p.toxic").alias("score"))
    return rated.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
