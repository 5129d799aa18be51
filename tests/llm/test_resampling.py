"""Importance resampling against its definition."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from fixtures import docs, prose, words

from tallyloom.llm import importance


def simple(rows, wanted, run, percent, buckets=importance.BUCKETS, least=importance.LEAST_WORDS):
    def features(text):
        found = words(text)
        return [" ".join(found[i : i + n]) for n in range(1, run + 1) for i in range(len(found) - n + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    raw, target = (Counter(bucket(f) for t in texts for f in features(t)) for texts in ([t for _, t in rows], wanted))
    s, t = sum(raw.values()), sum(target.values())
    gain = [math.floor(1000 * math.log((target[b] + 1) * (s + buckets) / ((raw[b] + 1) * (t + buckets)))) for b in range(buckets)]
    out = []
    for i, (key, text) in enumerate(rows):
        found = features(text)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text)), i])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = place
    return [tuple(r[:5]) for r in out]


def rows_of(rng):
    odd = [None, "", "...", " - ", "One", "ÀB ÉK naïve ΣÊ", "a.b-c d1e2", "x" * 300_000 + " end", "re " * 60_000]
    rows = [(i, t) for i, t in enumerate(odd)]
    rows += [(100 + i, prose(rng, rng.choice([5, 19, 20, 40, 200]), 60)) for i in range(150)]
    return rows + [(None, prose(rng, 30))] * 2


@pytest.mark.parametrize("run", [1, 3])
def test_resample(spark, run):
    rng = random.Random(12)
    rows, wanted = rows_of(rng), [prose(rng, 50, 30) for _ in range(5)] + [None, ""]
    target = spark.createDataFrame([(i, t, 1) for i, t in enumerate(wanted)], "item_id long, text string, bucket int")
    got = importance.resample(docs(spark, rows), target, run=run, percent=30)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, simple(rows, wanted, run, 30)))


def test_blocks_of_any_size_agree(monkeypatch):
    rng = random.Random(5)
    monkeypatch.setattr(importance, "BLOCK", 4)
    texts = pa.array(["a b", None, "c" * 40, "", "d e f"])
    assert [b.to_pylist() for b in importance.blocks(texts)] == [["a b", None], ["c" * 40], ["", "d e f"]]
    texts = pa.array([prose(rng, rng.choice([0, 1, 9]), 20) for _ in range(60)] + [None])
    counts = lambda x: sum(np.bincount(places, minlength=50) for _, places in importance.features(x, 50, 2))
    monkeypatch.setattr(importance, "BLOCK", 30)
    assert (sum(map(counts, importance.blocks(texts))) == counts(texts)).all()


def test_repeated_rows_and_empty_tables(spark):
    one = (7, " ".join(f"w{i}" for i in range(25)))
    target = spark.createDataFrame([], "item_id long, text string")
    got = importance.resample(docs(spark, [one] * 500 + [(None, one[1])] * 500), target, percent=50).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 501))
    best = max(r["score"] for r in got)
    assert {r["score"] for r in got if r["rank"] == 1} == {best} and len({r["score"] for r in got}) == 2
    assert importance.resample(docs(spark, []), target).count() == 0
