"""The trained operators on documents whose labels follow simple rules, and the pipeline stage by stage."""

import random
import zlib

import corpus_pipeline
import numpy as np
import pytest
from fixtures import docs, prose

from tallyloom.llm import quality, toxicity

INSULTS = ["blorky", "snarfle", "grumpus"]


def corpus():
    rng = random.Random(20)
    rows, labels = [], []
    for i in range(400):
        lines = [prose(rng, rng.randint(4, 30)).capitalize() + "." for _ in range(rng.randint(1, 8))]
        bad, toxic = i % 6 == 0, i % 5 == 0
        if toxic:
            lines[0] += " " + " ".join(rng.choice(INSULTS) + rng.choice(["", "s", "ish"]) for _ in range(rng.randint(1, 6)))
        if bad:
            lines.insert(rng.randrange(len(lines) + 1), " | ".join(prose(rng, 40).split()))
            lines.append(" ".join(w + "%%%" for w in prose(rng, 60).split()))
        rows.append((i, "\n".join(lines)))
        labels.append((i, 0 if bad else 1, int(toxic)))
    rows += [(1000, None), (1001, ""), (1002, "\n \n"), (1003, "word " * 50_000), (None, "no id"), (5, rows[5][1]), (5, rows[5][1])]
    labels += [(1000, 1, 0), (1001, None, None), (None, 0, 1), (7, 1, 0), (99_999, 0, 1)]
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = corpus()
    return docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def is_held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


@pytest.mark.parametrize("module, column, wrong", [(quality, 2 - 1, 0.03), (toxicity, 2, 0.03)])
def test_held_out_rows_are_predicted(spark, tables, module, column, wrong):
    rows, labels = corpus()
    truth = {r[0]: r[column] for r in labels if r[0] is not None and r[0] < 400}
    got = module.classify(*tables).collect()
    assert len(got) == len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= module.THRESHOLD) for r in got)
    assert all(r["held_out"] == is_held_out(r["doc_id"]) for r in got)
    seen = [(r["predicted"], truth[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(seen) > 50 and sum(p != t for p, t in seen) <= wrong * len(seen)
    again = {(r["doc_id"], r["score"]) for r in module.classify(tables[0].repartition(3), tables[1].repartition(5)).collect()}
    assert {(d, round(s, 9)) for d, s in again} == {(r["doc_id"], round(r["score"], 9)) for r in got}


def test_lines_of_long_texts_are_spread():
    lines = [str(i) for i in range(10_007)]
    got = list(map(int, quality.spread(lines)))
    assert len(got) == quality.SAMPLE_LINES and got == sorted(set(got)) and got[0] == 0 and got[-1] == 10_006
    assert sum(i >= 300 for i in got) > 0.9 * len(got)
    assert quality.spread(lines[:300]) == lines[:300] and len(quality.spread(lines[:301])) == 300


def test_texts_that_turn_bad_late_teach_so(spark):
    rng = random.Random(3)
    good = lambda: prose(rng, 12).capitalize() + "."
    rows, labels = [], []
    for i in range(120):
        lines = [good() for _ in range(320)]
        if i % 2:
            lines += ["%%% ".join(prose(rng, 12).split()) for _ in range(400)]
        rows.append((i, "\n".join(lines)))
        labels.append((i, 1 - i % 2, 0))
    table = docs(spark, rows)
    got = quality.classify(table, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert all(r["predicted"] == 1 - r["doc_id"] % 2 for r in got)


def test_a_repeated_id_is_one_row_of_the_sample(spark):
    rows = [(1, f"text {i}") for i in range(500)] + [(2, None), (2, None), (3, "c")]
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    sample = lambda parts: sorted(map(tuple, quality.labelled_sample(docs(spark, rows).repartition(parts), labels, "quality", 100).collect()))
    assert sample(1) == sample(4) and [r[0] for r in sample(2)] == [i for i in (1, 2, 3) if not is_held_out(i)]


def test_a_fold_chooses_without_its_own_marks(spark, tables):
    sample = quality.labelled_sample(*tables, "toxic", 1000)
    flip = toxicity.F.pmod(toxicity.F.xxhash64("key"), toxicity.F.lit(toxicity.FOLDS)) == 0
    other = sample.withColumn("mark", toxicity.F.when(flip, 1 - toxicity.F.col("mark")).otherwise(toxicity.F.col("mark")))
    (whole, blind, fold), (whole2, blind2, fold2) = toxicity.views(sample), toxicity.views(other)
    assert np.array_equal(fold, fold2) and set(fold) == set(range(toxicity.FOLDS))
    assert whole.chain.numbers != whole2.chain.numbers
    same, out = (blind[0], blind2[0]), fold != 0
    assert same[0].chain.numbers == same[1].chain.numbers and len(same[0].chain.numbers) > 0
    assert np.array_equal(same[0].chain.markers, same[1].chain.markers)
    assert all(np.array_equal(a[out], b[out]) for a, b in zip(same[0].targets, same[1].targets))
    links = [v.fitted(2, out).sparse for v in same]
    assert np.array_equal(*links)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_without_rows_or_labels(spark, tables, module):
    table, labels = tables
    assert module.classify(table.limit(0), labels).count() == 0
    scores = {r["score"] for r in module.classify(table, labels.limit(0)).collect()}
    assert len(scores) == 1 and 0 <= scores.pop() <= 1


def test_held_out_labels_teach_nothing(spark, tables):
    table, labels = tables
    flipped = labels.withColumn("quality", quality.F.when(quality.held_out(labels["doc_id"]), 1 - labels["quality"]).otherwise(labels["quality"]))
    one, other = quality.fit(table, labels), quality.fit(table, flipped)
    assert np.array_equal(one.tables, other.tables) and one.curve == other.curve


def test_marginals_equal_brute_force():
    rng = np.random.default_rng(1)
    odds, agree = rng.normal(size=7), 0.8
    weight = np.zeros((7, 2))
    total = 0.0
    for code in range(2**7):
        y = [(code >> t) & 1 for t in range(7)]
        w = np.exp(sum(o for o, v in zip(odds, y) if v) + agree * sum(a == b for a, b in zip(y, y[1:])))
        total += w
        for t, v in enumerate(y):
            weight[t, v] += w
    assert np.allclose(quality.marginals(odds, agree), weight[:, 1] / total)
    good, equal = quality._expected(np.concatenate([odds, odds[:3]]), np.array([7, 3]), agree)
    assert np.allclose(good[:7], quality.marginals(odds, agree)) and np.allclose(good[7:], quality.marginals(odds[:3], agree))
    assert 0 < equal < 8


def test_pipeline(spark, tmp_path):
    rows, labels = corpus()
    rng = random.Random(30)
    item = prose(rng, 30, 100_000)
    sentence = lambda n: prose(rng, n, 100_000).capitalize() + "."
    clean = [sentence(60) for _ in range(20)]
    rows = [r for r in rows if r[0] is not None]
    rows += [(2000 + i, t, f"src{i % 3}") for i, t in enumerate(clean)]
    rows += [(3000 + i, " ".join(t.split()[:-1])) for i, t in enumerate(clean[:5])]  # near copies
    rows += [(4000, f"Before it {item} and after it."), (4001, f"{clean[7]}\n{sentence(25)}")]
    docs(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, seen = kept.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == columns or name == "mixing"
        kept.write.parquet(f"{tmp_path}/{name}")
        kept = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {r["doc_id"]: r for r in kept.collect()}
    assert set(range(2000, 2020)) <= set(seen["quality"])
    bad = {i for i, q, _ in labels if i is not None and i < 400 and q == 0}
    assert len(bad & set(seen["quality"])) <= 2
    assert set(seen["line_dedup"]) == set(seen["quality"])
    assert clean[7] not in seen["line_dedup"][4001]["text"] and seen["line_dedup"][2007]["text"] == clean[7]
    assert all(r["n_chars"] == len(r["text"]) for r in seen["line_dedup"].values() if r["text"] is not None)
    assert {2000 + i for i in range(20)} <= set(seen["simhash"])
    assert 4000 in seen["simhash"] and 4000 not in seen["decontaminate"]
    assert set(seen["mixing"]) == set(seen["decontaminate"])
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, whole.collect())) == sorted(map(str, kept.collect()))
