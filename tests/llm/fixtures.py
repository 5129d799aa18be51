"""Small tables with the awkward cases, and brute-force versions of the operators."""

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long, words string, score string, row string, fp string, "
DOCS += "id string, version string, key string, text_version string, h string, line string, n long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def docs(spark, rows):
    """Rows of (doc_id, text[, source]) with columns whose names clash with those inside the operators."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0, *"wsrfivkthl", 1) for r in rows]
    return spark.createDataFrame(full, DOCS)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def roots(n, linked):
    """The component of each of n things under a symmetric relation."""
    root = list(range(n))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                root[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(n)]


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))
