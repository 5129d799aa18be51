"""The nearest neighbours against brute force."""

import numpy as np

from tallyloom.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, id int, node string, leaf string, score string, rank int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "n", "l", "s", 2) for i, v in rows], SCHEMA)


def simple(rows, asked, most):
    """For each query all candidates as (-cosine, id), by id the best, in order."""
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    unit = {v: np.float32(v).astype(float) / np.abs(np.float32(v).astype(float)).max() for _, v in good}
    unit = {v: u / np.sqrt((u * u).sum()) for v, u in unit.items()}
    out = {}
    for q in {i for i, _ in good if asked(i)}:
        best = {}
        for mine in (v for i, v in good if i == q):
            for i, v in good:
                if i != q and len(v) == len(mine):
                    best[i] = max(best.get(i, -2.0), round(float(unit[mine] @ unit[v]), 9))
        out[q] = sorted((-s, i) for i, s in best.items())[:most]
    return out


def answers(got):
    out = {}
    for r in sorted(got.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((-round(r["score"], 9), r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_all_leaves_give_the_exact_answer(spark):
    rng = np.random.default_rng(1)
    plain = [[float(x) for x in rng.normal(size=6)] for _ in range(300)]
    rows = [(i, v) for i, v in enumerate(plain)]
    rows += [(1000 + i, plain[0]) for i in range(400)] + [(50, plain[7]), (50, plain[7]), (2000, [2 * x for x in plain[3]])]
    rows += [(3000, None), (3050, []), (3100, [0.0] * 6), (3150, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (3200, [float("nan")] * 6), (None, plain[1])]
    rows += [(4000, [1.0, 2.0]), (4050, [2.0, 1.0]), (4100, [-0.0, 1.0, 0.0, 0.0, 0.0, 0.0]), (4150, [0.0, 1.0, -0.0, 0.0, 0.0, 0.0])]
    got = answers(neighbours.nearest(table(spark, rows), goal=1.0, leaf=8, block=16, calibration=10**6))
    want = simple(rows, lambda i: i % 50 == 0, 5)
    assert got == {q: found for q, found in want.items() if found}
    assert len(got[4000]) == 1 and got[0] == [(-1.0, i) for i in range(1000, 1005)]


def test_recall_with_a_tree_on_a_sample(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16)) * 2
    rows = [(i, [float(x) for x in centres[i % 40] + rng.normal(size=16)]) for i in range(6000)]
    got = answers(neighbours.nearest(table(spark, rows), sample=1500, leaf=16, block=64, calibration=60))
    want = simple(rows, lambda i: i % 50 == 0, 5)
    caught = sum(len({i for _, i in found} & {i for _, i in got[q]}) for q, found in want.items())
    assert caught >= 0.9 * sum(map(len, want.values()))
    assert all(len(found) == 5 for found in got.values())


def test_visits_are_widened_only_as_far_as_needed():
    rng = np.random.default_rng(3)
    vectors = neighbours.scaled(rng.normal(size=(2000, 8)))
    tree = neighbours.fit(vectors, leaf=16)
    every = tree.visits(vectors[0], tree.n_leaves)
    assert sorted(every) == [n for n, below in enumerate(tree.children) if not below]
    assert tree.visits(vectors[0], 7) == every[:7]
    assert every[0] == tree.leaves_of(vectors[:1])[0]


def test_extreme_components_and_empty_tables(spark):
    rows = [(0, [1e-200, 2e-200]), (1, [1e200, 2e200]), (2, [2e-200, 1e-200]), (50, [-1.0, 0.0])]
    doubles = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = answers(neighbours.nearest(doubles))
    assert got[0] == [(-1.0, 1), (-0.8, 2), (round(1 / 5**0.5, 9), 50)]
    assert neighbours.nearest(table(spark, [])).count() == 0
    assert neighbours.nearest(table(spark, [(0, [1.0, 0.0])])).count() == 0
