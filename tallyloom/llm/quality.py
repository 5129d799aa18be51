"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line's potential comes from binned figures of the
line itself, of the line before and of the one after; a transition potential
ties neighbouring labels. Forward-backward gives the probability of "good" for
each line, and the mean over lines, weighted by their length, is the quality of
the document. A logistic curve turns it into a calibrated score.

Only documents are labelled, so the field is trained twice: first each line has
its document's label; then the lines of bad documents that the first field surely
calls good become good, at least one staying bad.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The largest number of labelled documents, and of lines of each, that the field is trained on;
#: of longer texts it sees runs of ``RUN`` lines, spread evenly from the first line to the last.
SAMPLE, SAMPLE_LINES, RUN = 3_000, 300, 25
_PARTS = 10**15
THRESHOLD = 0.3
CUTS = np.array([0.01, 0.03, 0.1, 0.25, 0.5, 0.75, 0.85, 0.9, 0.95, 0.98, 0.99])
BINS = len(CUTS) + 1

_UPPER, _LOWER, _DIGITS = (x.encode() for x in (string.ascii_uppercase, string.ascii_lowercase, string.digits))
_STOPS, _CALLS, _SPACE = b".,;:'\"()-", b"!?", b" \t\r\x0b\x0c"
_SYMBOLS = bytes(b for b in range(33, 127) if b not in _UPPER + _LOWER + _DIGITS + _STOPS + _CALLS)
FIGURES = 13


def line_figures(line: str) -> tuple:
    """The figures of a line that the field looks at; all but the first are shares or means."""
    raw = line.encode()
    words = line.split()
    size, n = len(raw) or 1, len(words) or 1
    share = lambda kept: (len(raw) - len(raw.translate(None, kept))) / size
    lengths = list(map(len, words))
    return (
        float(len(raw)),
        share(_UPPER),
        share(_DIGITS),
        share(_STOPS),
        share(_CALLS),
        share(_SYMBOLS),
        share(_SPACE),
        sum(lengths) / n,
        sum(map((3).__ge__, lengths)) / n,
        len(set(words)) / n,
        sum(map(str.isupper, words)) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        float(raw[-1:] in (b".", b"!", b"?")),
    )


def lines_of(text: str | None) -> list[str]:
    """The lines of a text that hold more than white space."""
    return [line for line in (text or "").split("\n") if line and not line.isspace()]


def spread(lines: list[str], most: int = SAMPLE_LINES, run: int = RUN) -> list[str]:
    """At most ``most`` lines in runs of neighbours that are spread over all of them."""
    if len(lines) <= most:
        return lines
    runs = max(2, most // run)
    starts = [(len(lines) - run) * i // (runs - 1) for i in range(runs)]
    return [line for start in starts for line in lines[start : start + run]]


@dataclass
class Field:
    """Bin edges, potentials of bins (place, figure, bin), of neighbouring labels, and the curve."""

    edges: np.ndarray
    tables: np.ndarray
    agree: float
    bias: float
    curve: tuple[float, float]

    def binned(self, figures: np.ndarray) -> np.ndarray:
        out = np.empty(figures.shape, np.int64)
        for i, edge in enumerate(self.edges):
            out[:, i] = np.searchsorted(edge, figures[:, i], side="right")
        return out

    def document(self, text: str | None) -> float:
        """The probability that the document is good, from 0 to 1."""
        lines = lines_of(text)
        if not lines:
            return float(_squash(self.curve[1] + self.curve[0] * 0.5))
        figures = np.array([line_figures(x) for x in lines])
        odds = potentials(self.binned(figures), np.zeros(len(lines), bool), self.tables, self.bias)
        good = marginals(odds, self.agree)
        mean = float(np.average(good, weights=figures[:, 0]))
        return float(_squash(self.curve[0] * mean + self.curve[1]))


def _squash(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def potentials(bins: np.ndarray, first: np.ndarray, tables: np.ndarray, bias: float) -> np.ndarray:
    """How much each line's own figures and its neighbours' speak for "good". ``first`` marks where documents begin."""
    own, before, after = (tables[p][np.arange(FIGURES), bins].sum(1) for p in range(3))
    first = first.copy()
    first[:1] = True
    odds = own + bias
    odds[1:] += np.where(first[1:], 0.0, before[:-1])
    odds[:-1] += np.where(first[1:], 0.0, after[1:])
    return odds


def marginals(odds: np.ndarray, agree: float) -> np.ndarray:
    """P(good) of each line of one document by forward-backward; ``agree`` favours equal neighbours."""
    same = float(np.exp(agree))
    good = _squash(odds).tolist()
    n = len(good)
    ahead, a = [0.0] * n, good[0]
    ahead[0] = a
    for t in range(1, n):
        g = (a * same + 1 - a) * good[t]
        b = (a + (1 - a) * same) * (1 - good[t])
        ahead[t] = a = g / (g + b)
    back, out = 0.5, [0.0] * n
    out[n - 1] = ahead[n - 1]
    for t in range(n - 2, -1, -1):
        g = back * good[t + 1]
        b = (1 - back) * (1 - good[t + 1])
        up, down = g * same + b, g + b * same
        back = up / (up + down)
        x = ahead[t] * back
        out[t] = x / (x + (1 - ahead[t]) * (1 - back))
    return np.array(out)


def _expected(odds: np.ndarray, lengths: np.ndarray, agree: float) -> tuple[np.ndarray, float]:
    """Marginals of the lines of many documents at once, and the expected number of equal neighbours."""
    n, longest = len(lengths), int(lengths.max())
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(longest)[:, None]
    real = place < lengths
    p = np.full((longest, n), 0.5)
    p[real] = _squash(odds)[(starts + place)[real]]
    same = np.exp(agree)
    ahead, back = np.empty_like(p), np.full_like(p, 0.5)
    ahead[0] = p[0]
    for t in range(1, longest):
        g = (ahead[t - 1] * same + 1 - ahead[t - 1]) * p[t]
        b = (ahead[t - 1] + (1 - ahead[t - 1]) * same) * (1 - p[t])
        ahead[t] = g / (g + b)
    equal = 0.0
    for t in range(longest - 2, -1, -1):
        inside = real[t + 1]
        g, b = back[t + 1] * p[t + 1], (1 - back[t + 1]) * (1 - p[t + 1])
        up, down = g * same + b, g + b * same
        back[t] = np.where(inside, up / (up + down), 0.5)
        a = ahead[t]
        gg, bb, gb, bg = a * same * g, (1 - a) * same * b, a * b, (1 - a) * g
        equal += float(np.sum(np.where(inside, (gg + bb) / (gg + bb + gb + bg), 0.0)))
    good = ahead * back
    good = good / (good + (1 - ahead) * (1 - back))
    return good.T[real.T], equal


def _train_once(bins, first, lengths, labels, rounds=200, rate=0.15, decay=1e-3):
    """Maximum likelihood by Adam; returns tables, agreement, bias and the marginals."""
    n = len(bins)
    tables, extra = np.zeros((3, FIGURES, BINS)), np.zeros(2)
    moments = [np.zeros_like(tables), np.zeros_like(tables), np.zeros_like(extra), np.zeros_like(extra)]
    inner = ~first
    inner[:1] = False
    pairs = np.flatnonzero(inner)
    equal = float(np.sum(labels[pairs] == labels[pairs - 1]))
    slot = np.arange(FIGURES) * BINS + bins
    for step in range(1, rounds + 1):
        good, expected = _expected(potentials(bins, first, tables, extra[1]), lengths, extra[0])
        gap = labels - good
        before, after = np.zeros(n), np.zeros(n)
        before[pairs - 1], after[pairs] = gap[pairs], gap[pairs - 1]
        slope = np.stack(
            [np.bincount(slot.ravel(), np.repeat(g, FIGURES), FIGURES * BINS).reshape(FIGURES, BINS) for g in (gap, before, after)]
        )
        slopes = (slope / n - decay * tables, np.array([(equal - expected) / n, gap.sum() / n]))
        for k, (values, g) in enumerate(zip((tables, extra), slopes)):
            m, v = moments[2 * k], moments[2 * k + 1]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            values += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        extra[0] = max(extra[0], 0.0)
    good, _ = _expected(potentials(bins, first, tables, extra[1]), lengths, extra[0])
    return tables, float(extra[0]), float(extra[1]), good


def _quantiles(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Edges of bins that hold shares of all characters, finer towards the ends."""
    order = np.argsort(values, kind="stable")
    return values[order][np.searchsorted(np.cumsum(weights[order]), CUTS * weights.sum()).clip(0, len(values) - 1)]


def train(figures: list[np.ndarray], labels: list[int]) -> Field:
    """The field for documents given as arrays of line figures. Without both labels every score is the same."""
    kept = [(f, y) for f, y in zip(figures, labels) if len(f)]
    flat = Field(np.zeros((FIGURES, BINS - 1)), np.zeros((3, FIGURES, BINS)), 0.0, 0.0, (0.0, 0.0))
    if len({y for _, y in kept}) < 2:
        share = (sum(labels) + 0.5) / (len(labels) + 1)
        flat.curve = (0.0, float(np.log(share / (1 - share))))
        return flat
    lengths = np.array([len(f) for f, _ in kept])
    stacked = np.concatenate([f for f, _ in kept])
    owner = np.repeat(np.arange(len(kept)), lengths)
    truth = np.array([y for _, y in kept])
    first = np.diff(owner, prepend=-1) > 0
    flat.edges = edges = np.array([_quantiles(column, stacked[:, 0]) for column in stacked.T])
    bins = flat.binned(stacked)
    lines = truth[owner].astype(float)
    tables, agree, bias, good = _train_once(bins, first, lengths, lines)
    worst = np.full(len(kept), np.inf)
    np.minimum.at(worst, owner, good)
    lines = np.where((truth[owner] == 0) & (good > 0.9) & (good > worst[owner]), 1.0, lines)
    tables, agree, bias, good = _train_once(bins, first, lengths, lines)
    mean = np.bincount(owner, good * stacked[:, 0]) / np.bincount(owner, stacked[:, 0])
    return Field(edges, tables, agree, bias, _curve(mean, truth))


def _curve(x: np.ndarray, y: np.ndarray, decay: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept of a logistic regression, by Newton's steps."""
    design, w = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
    for _ in range(50):
        p = _squash(design @ w)
        slope = design.T @ (y - p) - decay * w
        bend = design.T @ (design * (p * (1 - p))[:, None]) + decay * np.eye(2)
        w = w + np.clip(np.linalg.solve(bend, slope), -5, 5)
    return float(max(w[0], 0.0)), float(w[1])


def held_out(key: Column) -> Column:
    """Whether a row is kept from training: CRC-32 of its id as text is a multiple of 5."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, mark: str, most: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """About ``most`` labelled rows ``(key, text, mark)`` not held out, chosen by a hash of their id.

    One row an id: of an id's texts the one of smallest hash, so that repeated ids bring no more.
    """
    marks = labels.where(F.col(mark).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)))
    marks = marks.groupBy(F.col(key).alias("_key")).agg(F.max(mark).cast("int").alias("_mark"))
    n = marks.count()
    part = min(_PARTS, _PARTS * most // max(n, 1))
    chosen = lambda c: F.pmod(F.xxhash64(c), F.lit(_PARTS)) < part
    docs = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).where(chosen(F.col("_id")))
    marks = marks.where(chosen(F.col("_key")))
    marked = docs.join(marks, F.col("_id") == F.col("_key"))
    one = F.min_by("_text", F.struct(F.xxhash64("_text"), "_text")).alias("text")
    return marked.groupBy(F.col("_id").alias("key"), F.col("_mark").alias("mark")).agg(one).select("key", "text", "mark")


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, key: str = "doc_id", text: str = "text") -> Field:
    """Trains on a bounded sample of the labelled rows that are not held out."""

    @F.pandas_udf("array<double>")
    def figures(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: [v for line in spread(lines_of(x)) for v in line_figures(line)])

    sample = labelled_sample(docs, labels, "quality", most, key, text)
    rows = sorted(sample.select("key", "mark", figures("text").alias("f")).collect())  # bounded by ``most``
    return train([np.array(r["f"]).reshape(-1, FIGURES) for r in rows], [r["mark"] for r in rows])


def score(field: Field, text: Column) -> Column:
    """The score of each text as a column."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(field.document).astype(float)

    return scored(F.coalesce(text, F.lit("")))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, held_out, score, predicted)`` for each row of ``docs``.

    Null and empty texts have no lines and get the score of an even chance;
    texts of any length are scored whole; repeated rows are scored each. Rows of
    ``labels`` without id or mark teach nothing; of repeated ones the larger mark
    holds. Without labels of both kinds all scores are equal. Other columns are
    not read; an empty table gives an empty result.
    """
    rated = docs.select(key, held_out(F.col(key)).alias("held_out"), score(fit(docs, labels, key=key, text=text), F.col(text)).alias("score"))
    return rated.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are predicted to be good."""
    return docs.where(score(fit(docs, labels, key=key, text=text), F.col(text)) >= THRESHOLD)
