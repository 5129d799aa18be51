"""License scan, decontamination and token counts against brute force."""

import hashlib
import random

import public_tokenizers
import pytest
from fixtures import docs, prose, words
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyloom.llm import decontaminate, licenses, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def test_licenses(spark):
    rng = random.Random(1)
    phrases = [*licenses.BASE, "licensed under the apache license version 2.0.", "Released under the MIT License", "GNU-General; public\nLICENSE, version 3",
               "licensed under cc by-nc 4.0", "license apache", "mit mit license license", "permission is hereby granted, free of charge, to any person"]
    texts = [None, "", "é É mit license", "cc by " * 3000, "x" * 100_000]
    texts += [" ".join(rng.choice([prose(rng, 3), rng.choice(phrases)]) for _ in range(rng.randint(1, 6))) for _ in range(60)]
    rows = list(enumerate(texts)) + [(None, "apache license"), (3, "mit license"), (3, "mit license")]
    got = licenses.scan(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    want = []
    for d, text in rows:
        found = words(text)
        at = {(p, i) for p in licenses.BASE for i in range(len(found)) if found[i : i + len(p.split())] == p.split()}
        labels = ",".join(sorted({licenses.BASE[p] for p, _ in at}))
        starts = [i for _, i in at]
        want.append((d, len(found), len(at), min(starts, default=None), max(starts, default=None), labels))
    key = lambda r: str(r)
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted(want, key=key)
    assert all(0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in got)
    assert any("apache-2.0" in r["labels"] for r in got) and any("gpl-3.0" in r["labels"] for r in got)
    assert licenses.scan(docs(spark, [])).count() == 0


def judged(text, items):
    doc = words(text)
    hit, found = set(), set()
    for item, body in items:
        w = words(body)
        n = min(13, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(doc) - n + 1):
            if tuple(doc[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(item)
    found = sorted(str(i) for i in found if i is not None)
    sha = hashlib.sha256(",".join(found).encode()).hexdigest()
    return len(doc), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(doc)


def test_decontamination(spark):
    rng = random.Random(2)
    items = [(i, prose(rng, rng.choice([1, 2, 3, 5, 12, 13, 14, 40]), 60 if i % 2 else 100_000)) for i in range(30)]
    items += [(30, None), (31, ""), (32, items[5][1]), (5, items[5][1]), (None, prose(rng, 20)), (33, "a a a a a a a a a a a a a a a a")]
    texts = [None, "", "A, a; " * 30, " ".join(b for _, b in items if b)]
    for _ in range(80):
        body = words(rng.choice(items)[1]) or ["none"]
        cut = body[rng.randrange(3) :][: rng.randint(1, 40)]
        texts.append(f"{prose(rng, rng.randint(0, 60), 60)} {' '.join(cut).upper()}. {prose(rng, rng.randint(0, 300), 60)}")
    rows = list(enumerate(texts)) + [(None, items[7][1]), (4, texts[4]), (4, "other")]
    table = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, row string")
    got = decontaminate.contaminated(docs(spark, rows), table).collect()
    want = [(d, *judged(t, items)) for d, t in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert any(w[-1] for w in want) and not all(w[-1] for w in want)
    assert decontaminate.contaminated(docs(spark, []), table).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.contaminated(docs(spark, rows[:5]), table.limit(0)).collect())
    kept = sorted(str((r["doc_id"], r["text"])) for r in decontaminate.keep_clean(docs(spark, rows), table).collect())
    assert kept == sorted(str(row) for row, w in zip(rows, want) if row[0] is None or not w[-1])


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(*token_counts.read_vocabulary(PATH))


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(["the", " ", "  ", "\n", "\t", "'s", "'ll", "é", "<|endoftext|>", "<|", "12", "²", " ", "\x1c", "!?", "_", "日本"]), max_size=25).map("".join)))
def test_tokens_of_any_text(counter, text):
    assert counter.tokens(text) == len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_token_counts(spark):
    texts = [None, "", "x" * 50_000, "ab " * 30_000, " " * 2000, "mixed <|endoftext|> text\r\n  here"]
    rows = list(enumerate(texts)) + [(None, "no id"), (1, "again"), (1, "again")]
    got = token_counts.count_tokens(docs(spark, rows), PATH).collect()
    want = [(d, len((t or "").encode()), n := len(LIBRARY.encode(t or "", add_special_tokens=False).ids), n > 512) for d, t in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert token_counts.count_tokens(docs(spark, []), PATH).count() == 0
