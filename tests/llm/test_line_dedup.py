import random

import pytest
from pyspark.sql import functions as F

from fixtures import roots
from tallyloom.llm import line_dedup as ld

SCHEMA = "doc_id long, text string, n_lines string, h string"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(docs):
    """The texts left, by comparing all lines with all."""
    norm = lambda line: line.strip(" ").lower()
    rank = lambda d: (d is None, d or 0)
    first = {}
    for d, text in docs:
        for line in (text or "").split("\n"):
            if len(norm(line)) >= ld.MIN_CHARS:
                first[norm(line)] = min(first.get(norm(line), rank(d)), rank(d))
    lines = sorted(first)
    root = {x: x for x in lines}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(lines):
        for b in lines[i + 1 :]:
            if abs(len(a) - len(b)) <= 1 and edits(a, b) <= 1:
                root[top(a)] = top(b)
    keeper = {}
    for x in lines:
        keeper[top(x)] = min(keeper.get(top(x), first[x]), first[x])
    return {x: keeper[top(x)] for x in lines}, {x: top(x) for x in lines}


def check(spark, docs, crowded):
    got = ld.dedup(spark.createDataFrame([(d, t, "x", "y") for d, t in docs], SCHEMA), crowded=crowded)
    assert got.columns == ["doc_id", "text", "h", "n_lines", "n_dropped"]
    keeper, group = brute(docs)
    rank = lambda d: (d is None, d or 0)
    kept = {}
    total = 0
    for row in got.collect():
        if row["text"] is None:
            continue
        for line in row["text"].split("\n"):
            x = line.strip(" ").lower()
            total += len(x) >= ld.MIN_CHARS
            if len(x) >= ld.MIN_CHARS:
                assert rank(row["doc_id"]) == keeper[x], "kept by another document"
                kept.setdefault(group[x], []).append((row["doc_id"], x))
    assert set(kept) == set(group.values()), "a class lost its last line"
    assert total == len(kept), "a class has more than one line left"
    return got


@pytest.mark.parametrize("crowded", [16, 2])
def test_against_all_pairs(spark, crowded):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcé ") for _ in range(rng.randint(30, 45))) + "x" for _ in range(4)]
    docs = []
    for d in range(60):
        lines = []
        for _ in range(rng.randint(1, 4)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                i = rng.randrange(len(line))
                line[i : i + rng.choice([0, 1])] = rng.choice(["", "q", "r"])
            lines.append("".join(line))
        docs.append((d, "\n".join(lines + ["short"])))
    check(spark, docs, crowded)


def test_many_copies_with_one_letter_changed(spark):
    line = "the quick brown fox jumps over the lazy dog again"
    docs = [(i, line[:i] + "#" + line[i + 1 :]) for i in range(0, 40)] + [(100 + i, line[:i] + "+" + line[i:]) for i in range(40)]
    got = check(spark, [*docs, (500, line)], 4)
    assert sum(r["text"] != "" for r in got.collect()) == 1


def test_nulls_empty_and_repeated_rows(spark):
    long = "word " * 20_000
    docs = [(1, None), (2, ""), (3, "\n\n"), (None, "a line that is long enough\nmine alone is long enough"), (4, "A line that is long enough "),
            (4, "A line that is long enough "), (5, long), (6, long), (7, "x\nx"), (4, "other text, same id, long enough")]
    frame = spark.createDataFrame([(d, t, "x", "y") for d, t in docs], SCHEMA)
    rows = sorted(((r["doc_id"] or 0, r["text"], r["n_lines"], r["n_dropped"]) for r in ld.dedup(frame).collect()), key=str)
    assert rows == sorted(
        [(1, None, 0, 0), (2, "", 1, 0), (3, "\n\n", 3, 0), (0, "mine alone is long enough", 2, 1), (4, "A line that is long enough ", 1, 0),
         (4, "A line that is long enough ", 1, 0), (5, long, 1, 0), (6, "", 1, 1), (7, "x\nx", 2, 0), (4, "other text, same id, long enough", 1, 0)],
        key=str,
    )
    assert ld.dedup(frame.limit(0)).count() == 0


def test_band(spark):
    rng = random.Random(5)
    pairs = [(a := "".join(rng.choice("ab") for _ in range(rng.randint(0, 9))), "".join(rng.choice("ab") for _ in range(max(0, len(a) + rng.randint(-1, 1))))) for _ in range(600)]
    frame = spark.createDataFrame(pairs, "a string, b string").select("a", "b", ld.characters(F.col("a")).alias("p"), ld.characters(F.col("b")).alias("t"))
    for k in (1, 2):
        for r in frame.select("a", "b", ld.within(F.col("a"), F.col("b"), k).alias("near")).collect():
            assert r["near"] == (edits(r["a"], r["b"]) <= k), (r, k)


@pytest.mark.parametrize("crowded", [16, 2])
def test_long_lines_may_differ_in_a_word(spark, crowded):
    rng = random.Random(9)
    vocabulary = ["alpha", "bravo", "charlie", "delta", "echo", "foxtrot"]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(10, 13))] for _ in range(3)]
    lines = set()
    for _ in range(70):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2])):
            i = rng.randrange(len(words))
            words[i : i + rng.choice([0, 1])] = rng.choice([[], ["september"], ["2019"]])
        lines.add(" ".join(words))
    lines = sorted(lines)
    near = lambda a, b: edits(a, b) <= 1 or (min(len(a.split()), len(b.split())) >= ld.LONG_WORDS and edits(a.split(), b.split()) <= 1)
    group = roots(len(lines), lambda i, j: near(lines[i], lines[j]))
    assert 1 < len(set(group)) < len(lines)
    got = ld.dedup(spark.createDataFrame([(i, line, "x", "y") for i, line in enumerate(lines)], SCHEMA), crowded=crowded)
    assert {r["doc_id"] for r in got.collect() if r["text"]} == set(group)


def test_short_equal_lines_go_in_the_query_and_the_stage(spark, tmp_path):
    import corpus_pipeline
    from tallyloom.llm import queries

    docs = [(1, "All rights reserved.\n\nx\nx\n版权所有"), (2, "all rights reserved. \n\n\t\n\t\nAll rights reserves."), (3, "版权所有\nmine")]
    frame = spark.createDataFrame([(d, t, "x", "y") for d, t in docs], SCHEMA)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    left = {1: "All rights reserved.\n\nx\n版权所有", 2: "\n\t\n\t\nAll rights reserves.", 3: "mine"}
    got = queries.op3_line_dedup(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: r["text"] for r in got} == left
    assert {r["doc_id"]: r["n_dropped"] for r in got} == {1: 1, 2: 1, 3: 1}
    staged = corpus_pipeline.line_stage(spark, frame.withColumn("n_chars", F.length("text")), str(tmp_path))
    assert {r["doc_id"]: r["text"] for r in staged.collect()} == left


def test_entries_stand_for_halves(spark):
    """Lines share an entry exactly if they have the length of the one and the same places outside the half."""
    rng = random.Random(11)
    lines = {"".join(rng.choice(["ab", "é", "版", "𝒳", "c"]) for _ in range(2)) * 12 + "x" * rng.randint(0, 3) for _ in range(30)}
    lines |= {"word " * k + gap + end for k in (1, 2, 8, 9, 10, 11) for gap in ("", "  ") for end in ("é" * 24, "z" * 24, "z" * 25)}
    lines |= {"z" * 23, "ab", "一" * 23, "一" * 24}
    frame = spark.createDataFrame([(i, line) for i, line in enumerate(sorted(lines))], "doc_id long, text string")
    long_words = 3
    got = ld.distinct_lines(frame, "doc_id", "text", long_words=long_words, shortest=1).collect()

    def halves(units, unit):
        for role in (0, 1):
            n = len(units) - role
            yield from ((unit, 0, n, tuple(units[len(units) - (n - n // 2) :])), (unit, 1, n, tuple(units[: n // 2])))

    meant = {}
    for row in got:
        line = sorted(lines)[row["first_doc"]]
        words = line.split()
        expected = list(halves(line, "k")) if len(line) >= ld.MIN_CHARS else [None] * 4
        expected += list(halves(words, "w")) if len(line) >= ld.MIN_CHARS and len(words) >= long_words else [None] * 4
        for j, what in enumerate(expected):
            key = row[f"{'kw'[j // 4]}{j % 4}"]
            assert (key is None) == (what is None), (line, j)
            if what is not None:
                assert meant.setdefault(key, what) == what, (line, j)
    assert len(got) == len(lines) and len(set(meant.values())) == len(meant)


def test_lines_are_entered_without_functions_over_arrays(spark):
    """The scan of all lines is generated code: no lambda for each line, no regular expression, one lower."""
    frame = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = ld.distinct_lines(frame, "doc_id", "text", shortest=1)._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan and "regexp" not in plan and plan.count("lower(") == 1
    assert "regexp" not in ld._rewritten(frame.select(F.struct("doc_id", "text").alias("row"), F.array(F.lit(0)).alias("drops")), ["text"], "text")._jdf.queryExecution().analyzed().toString()


def test_lines_often_in_one_document_only(spark):
    line = "a line that stands twice in one document"
    docs = [(1, f"{line}\nx\n{line}\nother"), (1, f"{line}\nx\n{line}\nother"), (None, "n\nn\nm"), (2, "x")]
    frame = spark.createDataFrame([(d, t, "x", "y") for d, t in docs], SCHEMA)
    rows = sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in ld.dedup(frame, shortest=1).collect()), key=str)
    assert rows == sorted([(1, f"{line}\nx\nother", 4, 1)] * 2 + [(None, "n\nm", 3, 1), (2, "", 1, 1)], key=str)
