"""SimHash, embeddings and mixing against brute force."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from fixtures import LOWER, docs, prose, roots
from xxhash import xxh64_intdigest

from tallyloom.llm import embeddings, mixing, simhash
from tallyloom.llm.common import components


def test_components(spark):
    rng = random.Random(4)
    n = 300
    pairs = [(i, i + 1) for i in range(60)] + [(0 if i % 2 else 299, i) for i in range(80, 140)] + [(rng.randrange(150, 299), rng.randrange(150, 299)) for _ in range(90)]
    near = set(pairs)
    want = roots(n, lambda i, j: (i, j) in near or (j, i) in near)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: want[i] for p in pairs if p[0] != p[1] for i in p}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def simple_fingerprint(text):
    found = [w for w in (text or "").translate(LOWER).replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" ") if w]
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 3]) for i in range(len(found) - 2)] or [" ".join(found)]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("crowded", [64, 3])
def test_links_of_fingerprints(spark, crowded):
    rng = random.Random(6)
    base = [rng.getrandbits(64) for _ in range(5)] + [0, 2**64 - 1]
    fps = set(base)
    for _ in range(250):
        x = rng.choice(base)
        for b in rng.sample(range(64), rng.choice([1, 1, 2, 3, 4])):
            x ^= 1 << b
        fps.add(x)
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    want = roots(len(fps), lambda i, j: ((fps[i] ^ fps[j]) & (2**64 - 1)).bit_count() <= 2)
    links = simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"), crowded)
    got = {r["node"]: r["root"] for r in components(links).collect()}
    assert [got.get(x, x) for x in fps] == [fps[i] for i in want]


def test_near_duplicates(spark):
    rng = random.Random(7)
    texts = [None, "", " \n", "one", "ONE", "two words", "Tab\tand\x0bvt É é\x1cx"] + ["z" * 100_000] * 2
    for _ in range(12):
        body = prose(rng, 120).split()
        texts += [" ".join(body)] * 2 + [" ".join(body[:-1] + ["end"]), " ".join(body + ["end"])]
    rows = [(i + 10, t) for i, t in enumerate(texts)] + [(None, "one"), (12, texts[9]), (12, texts[9])]
    got = simhash.near_duplicates(docs(spark, rows)).collect()
    fps = [simple_fingerprint(t) for _, t in rows]
    groups = defaultdict(list)
    for i, r in enumerate(roots(len(rows), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)):
        groups[r].append(i)
    want = [(rows[i][0], f"{fps[i]:016x}", min(rows[j][0] for j in g if rows[j][0] is not None)) for g in groups.values() for i in g]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    kept = sorted(str(r["doc_id"]) for r in simhash.keep_first(docs(spark, rows)).collect())
    assert kept == sorted(str(d) for d, _, c in want if d is None or d == c)
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def test_embeddings(spark):
    rng = np.random.default_rng(8)
    rows = []
    for group in range(30):
        centre = rng.normal(size=16)
        for _ in range(rng.integers(1, 25)):
            rows.append(((centre + rng.normal(size=16) * rng.choice([0.02, 0.05, 0.1])).astype(np.float32).tolist(), int(group % 3)))
    rows += [(rows[0][0], rows[0][1])] * 5 + [([2 * x for x in rows[0][0]], rows[0][1]), (rows[0][0], 2 if rows[0][1] != 2 else 1), (rows[3][0], None)]
    rows += [(None, 1), ([], 1), ([0.0] * 16, 1), ([None] + [1.0] * 15, 1), ([math.nan] * 16, 1), ([math.inf] + [0.0] * 15, 1), ([1.0, 0.0], 1)]
    order = np.random.default_rng(9).permutation(len(rows))
    rows = [rows[i] for i in order]
    frame = spark.createDataFrame([(i, v, g, "x") for i, (v, g) in enumerate(rows)], "vec_id long, embedding array<float>, label int, node string")

    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        return np.array(v, float) / np.linalg.norm(np.array(v, float))

    units = [unit(v) for v, _ in rows]
    linked = lambda i, j: (
        units[i] is not None and units[j] is not None and rows[i][1] is not None and rows[i][1] == rows[j][1]
        and len(units[i]) == len(units[j]) and float(units[i] @ units[j]) >= embeddings.COSINE
    )
    want = roots(len(rows), linked)
    counts = [sum(linked(i, j) for j in range(len(rows)) if j != i) for i in range(len(rows))]
    assert max(counts) > 5
    for shard in (4096, 40):
        got = {r["vec_id"]: r for r in embeddings.near_duplicates(frame, shard=shard).collect()}
        found, true = sum(r["n_links"] for r in got.values()), sum(counts)
        assert len(got) == len(rows) and 0.98 * true <= found <= true
        assert all(got[i]["n_links"] <= n for i, n in enumerate(counts))
        assert [got[i]["component_id"] for i in range(len(rows))] == want
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def levels(sizes):
    """The targets of sources, by moving what is over step by step."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, open_, rest = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] >= 2 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
            rest -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize("group", [5000, 7])
def test_mixing(spark, group):
    rng = random.Random(10)
    rows = [(i, prose(rng, rng.choice([1, 5, 30, 30, 200])), rng.choice(["a", "b", "B", "é", "\U0001f600", "￿", None])) for i in range(400)]
    rows += [(900, None, "a"), (901, "", "empty"), (902, "x " * 5000, "long"), (None, "no id here", "a"), (3, "again and again", "b"), (3, "again and again", "b")]
    frame = docs(spark, rows)
    first, again = (sorted(map(str, mixing.mix(f, group=group).select("doc_id", "source", "size", "source_size", "target", "taken").collect())) for f in (frame, frame.repartition(5)))
    assert first == again
    got = mixing.mix(frame, group=group).collect()
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = levels(dict(sizes))
    taken = defaultdict(int)
    for r in got:
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[r["source"]]
        assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-9, abs_tol=1e-9)
    assert len(got) == len(rows)
    assert all(abs(taken[s] - want[s]) <= 2 for s in want)
    assert mixing.mix(docs(spark, []), group=group).count() == 0


def test_rows_of_one_id_fly_in_many_groups(spark, monkeypatch):
    """A third of the rows has no id; no group is larger than a few times its bound, and copies of an id are spread."""
    monkeypatch.setattr(mixing, "BLOCK", 7)
    seen = spark.sparkContext.accumulator(0)
    most, flight = 100, mixing._flight

    def counting(seed):
        flown = flight(seed)

        def watched(frame):
            if len(frame) > 4 * most:
                seen.add(1)
            return flown(frame)

        return watched

    monkeypatch.setattr(mixing, "_flight", counting)
    rng = random.Random(8)
    rows = [(None, "one two three", "a")] * 1_500 + [(i, prose(rng, 1 + i % 40), "a") for i in range(3_000)] + [(9, "x y", "b")] * 50
    frame = docs(spark, rows)
    got = mixing.mix(frame, group=most).collect()
    assert len(got) == len(rows) and seen.value == 0
    again = mixing.mix(frame.repartition(6), group=most).collect()
    flat = lambda result: sorted(str((r["doc_id"], r["source"], r["size"], r["taken"])) for r in result)
    assert flat(got) == flat(again)
    for source in "ab":
        mine = [r for r in got if r["source"] == source]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 2
        assert all(r["taken"] <= 2 * r["size"] for r in mine)


def test_flight_keeps_words_and_documents():
    rng = random.Random(11)
    size = [rng.randint(1, 500) for _ in range(999)]
    chance = [rng.random() for _ in size]
    out = mixing.fly(size, chance, "seed")
    assert sum(0 < c < 1 for c in out) <= 2
    assert math.isclose(sum(s * c for s, c in zip(size, out)), sum(s * c for s, c in zip(size, chance)), rel_tol=1e-6)
    assert math.isclose(sum(out), sum(chance), rel_tol=1e-6)


def test_mixed_texts(spark):
    frame = docs(spark, [(1, " one  two three", "a"), (2, "four", "a")])
    plan = spark.createDataFrame([(1, 1, 2), (2, 2, 0)], "doc_id long, copies long, part long")
    got = sorted(r["text"] for r in mixing.mixed_texts(frame, plan).collect())
    assert got == [" one  two ", " one  two three", "four", "four"]


def test_lengths_that_square_to_nothing_or_to_infinity():
    rows = embeddings.unit(np.array([[1e-200, 2e-200], [3e200, 1e200], [1.0, 2.0], [-5e-324, 0.0]]))
    assert np.allclose(rows @ rows.T, [[1, 0.7071068, 1, -0.4472136], [0.7071068, 1, 0.7071068, -0.9486833], [1, 0.7071068, 1, -0.4472136], [-0.4472136, -0.9486833, -0.4472136, 1]])


def test_audits_of_sparse_links_and_graphs_that_miss():
    rng = np.random.default_rng(5)
    rows = embeddings.unit(rng.normal(size=(1200, 16)))
    rows[1100:] = embeddings.unit(rows[:100] + 0.01 * rng.normal(size=(100, 16)))
    truth = rows @ rows.T >= embeddings.COSINE
    np.fill_diagonal(truth, False)
    audit = embeddings.audited(rows, rows, embeddings.COSINE, True)
    assert len(audit) > 20 and all(np.array_equal(links, np.flatnonzero(truth[i])) for i, links in audit)
    graph = embeddings.Graph(rows.astype(np.float32), np.arange(len(rows)))
    found = np.unpackbits(embeddings.searched(rows, rows, graph, embeddings.COSINE, True), axis=1, count=len(rows)).astype(bool)
    assert not (found & ~truth).any() and (found & truth).sum() >= embeddings.GOAL * truth.sum()
    for lists in graph.layers[0]:
        graph.layers[0][lists] = np.empty(0, np.int64)  # leads nowhere
    whole = np.unpackbits(embeddings.searched(rows, rows, graph, embeddings.COSINE, True), axis=1, count=len(rows)).astype(bool)
    assert np.array_equal(whole, truth)
