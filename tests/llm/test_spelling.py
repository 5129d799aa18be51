"""Spelling variants against all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from fixtures import LOWER, docs

from tallyloom.llm import spelling


def edits(a, b):
    """Whether exactly one letter is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def simple(rows, least):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            run = run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 5
    counts = {w: n for w, n in counts.items() if n >= least}
    near = {w: sorted((-counts[x], x) for x in counts if edits(w, x)) for w in counts}
    form = {w: found[0][1] if found and -found[0][0] >= 2 * counts[w] else None for w, found in near.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (w, form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()}


def texts(rng, letters, n):
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(12)]

    def word():
        w = rng.choice(stems)
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
            i = rng.randrange(len(w) + 1)
            w = rng.choice([w[:i] + rng.choice(letters) + w[i:], w[: max(i - 1, 0)] + w[i:], w[: max(i - 1, 0)] + rng.choice(letters) + w[i:]])
        return rng.choice([w, w, w.upper(), w.capitalize()])

    return [" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("letters, sample, cell", [("abcdeé", 32_768, 4_096), ("abÀ", 40, 8), ("qrstuvwxyzñÿß", 60, 4)])
def test_variants(spark, letters, sample, cell):
    rng = random.Random(len(letters))
    rows = list(enumerate(texts(rng, letters, 60)))
    rows += [(None, rows[3][1]), (3, rows[3][1]), (4, None), (5, ""), (6, "×÷×÷× ×÷×÷× ×÷×÷÷ ×÷×÷×"), (7, ("l" * 50_000 + " ") * 3 + ("l" * 50_001 + ".") * 9)]
    got = spelling.variants(docs(spark, rows), least=2, sample=sample, cell=cell)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got, want = {r["word"]: tuple(r) for r in got.collect()}, simple(rows, 2)
    assert got == want
    assert any(w[2] not in (w[0], w[1]) for w in want.values()) or letters != "abÀ"


def test_empty(spark):
    assert spelling.variants(docs(spark, [])).count() == 0
    assert spelling.variants(docs(spark, [(1, "one two three 12345"), (2, None)])).count() == 0


def test_pairs_of_one_cell():
    rng = random.Random(8)
    for letters in ("ab", "abcdefgh"):
        for length in (5, 6):
            a, b = ({"".join(rng.choice(letters) for _ in range(n)) for _ in range(300)} for n in (length, length + 1))
            for asking, points in ((sorted(a), sorted(a)), (sorted(a), sorted(b))):
                found = spelling.near_pairs(spelling.letters(asking, length), spelling.letters(points, len(points[0])))
                assert sorted(zip(*map(np.ndarray.tolist, found))) == [(i, j) for i, x in enumerate(asking) for j, y in enumerate(points) if edits(x, y)]


def test_boxes_of_cells_cover_what_they_are_asked_for():
    rng = np.random.default_rng(4)
    points = rng.integers(0, 4, size=(500, spelling.DIMS)).astype(np.int16)
    tree = spelling.grow(points[:200], 8, False)
    own = tree.cells(points)
    reached = {(leaf, row) for leaf, rows in tree.reach(points, 2) for row in rows.tolist()}
    for i in range(500):
        for j in np.flatnonzero(np.abs(points - points[i]).sum(1) <= 2):
            assert (own[j], i) in reached
