"""License scans over a positional rare-token index of license notices.

Every notice is indexed by its rarest words, the ones of highest inverse
document frequency over all documents, with their positions. A file's own
positions of those words, each less the position in the notice, are the starts
at which the notice could stand; the starts on which the rare words agree are
kept, and there the mandatory phrases are verified. A phrase of ``BASE`` is its
own notice, all of whose indexed words must agree and whose words must stand in
full, so every place of it is found.

The index has as many entries as the notices have words. Documents are only
read, row by row; nothing but the frequencies of license words is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import words_of

#: Phrases, and the label of each.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: label: (opening words of the notice, phrases that must stand within or near it)
NOTICES = {
    "agpl-3.0": ("licensed under the gnu affero general public license version 3", ("gnu affero general public license",)),
    "apache-2.0": ("licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use", "source and binary forms")),
    "cc-by-4.0": ("licensed under cc by 4 0", ("cc by 4 0",)),
    "cc-by-nc-4.0": ("licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    "cc-by-sa-4.0": ("licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    "cc0-1.0": ("released under cc0 1 0 universal public domain dedication", ("cc0 1 0",)),
    "gpl-2.0": ("licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    "gpl-3.0": ("licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee",)),
    "lgpl": ("licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    "mit-notice": ("released under the mit license", ("under the mit license",)),
    "mit-text": ("permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted free of charge",)),
    "mpl-2.0": ("subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    "unlicense": ("this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
}
RARE, AGREE, SLACK = 3, 2, 8


@dataclass(frozen=True)
class Notice:
    label: str
    words: tuple[str, ...]
    phrases: tuple[str, ...]
    whole: bool

    def postings(self, frequency: dict[str, int]) -> dict[str, list[int]]:
        """The rarest words of the notice and where they stand in it."""
        rare = sorted(set(self.words), key=lambda w: (frequency.get(w, 0), w))[:RARE]
        return {w: [i for i, x in enumerate(self.words) if x == w] for w in rare}


ALL = [Notice(label, tuple(phrase.split()), (phrase,), True) for phrase, label in BASE.items()] + [
    Notice(label, tuple(text.split()), phrases, False) for label, (text, phrases) in NOTICES.items()
]


def document_frequency(docs: DataFrame, text: str = "text") -> dict[str, int]:
    """In how many documents each word of a notice occurs; one row for each such word at most."""
    known = sorted({w for notice in ALL for w in notice.words})
    held = F.array_distinct(F.filter(words_of(F.col(text)), lambda w: w.isin(known)))
    counts = docs.select(F.explode(held).alias("word")).groupBy("word").count()
    return {r["word"]: r["count"] for r in counts.collect()}


def _strings(words) -> Column:
    return F.array(*map(F.lit, words))


def _shifted(word: str, offset: int) -> Column:
    """The positions of an indexed word in the file, each less its position in the notice."""
    return F.transform(F.filter("hits", lambda h: h["word"] == word), lambda h: h["at"] - offset)


def _starts(notice: Notice, index: dict[str, list[int]]) -> Column:
    """Where the rare words of a file agree that the notice begins."""
    lists = []
    for word, offsets in index.items():
        lists.append(reduce(F.array_union, [_shifted(word, offset) for offset in offsets]))
    if notice.whole or len(lists) < AGREE:
        return reduce(F.array_intersect, lists)
    pairs = [F.array_intersect(a, b) for i, a in enumerate(lists) for b in lists[i + 1 :]]
    return reduce(F.array_union, pairs)


def _verified(notice: Notice, starts: Column) -> Column:
    n = len(notice.words)
    if notice.whole:
        return F.filter(starts, lambda s: (s >= 0) & (F.slice("words", F.greatest(s, F.lit(0)) + 1, n) == _strings(notice.words)))

    def holds(s: Column) -> Column:
        begin = F.greatest(s - SLACK, F.lit(0))
        near = F.concat(F.lit(" "), F.array_join(F.slice("words", begin + 1, F.greatest(s + n + SLACK - begin, F.lit(0))), " "), F.lit(" "))
        return reduce(lambda a, b: a & b, [F.contains(near, F.lit(f" {p} ")) for p in notice.phrases])

    return F.filter(starts, holds)


def _share(notice: Notice, starts: Column) -> Column:
    """The largest share of the notice's words that stand in their place, over verified starts."""
    places = F.array(*(F.struct(F.lit(i).alias("o"), F.lit(w).alias("w")) for i, w in enumerate(notice.words)))
    agrees = lambda s: F.size(F.filter(places, lambda p: F.get("words", s + p["o"]).eqNullSafe(p["w"])))
    return F.coalesce(F.array_max(F.transform(starts, agrees)) / F.lit(float(len(notice.words))), F.lit(0.0))


def _labels(found: list[tuple[str, Column]]) -> Column:
    names = F.array_compact(F.array(*(F.when(there, F.lit(label)) for label, there in found)))
    return F.array_join(F.sort_array(F.array_distinct(names)), ",")


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_words, n_base, first_word, last_word, base_labels, labels, score)`` for each row of ``docs``.

    Null and empty texts have no words, no labels and score 0; a document
    without a base phrase has null first and last words; texts are read whole,
    whatever their length; repeated rows are scanned each. Other columns are not
    read; an empty table gives an empty result.
    """
    frequency = document_frequency(docs, text)
    indexes = [notice.postings(frequency) for notice in ALL]
    indexed = sorted({w for index in indexes for w in index})
    hit = lambda w, i: F.when(w.isin(indexed), F.struct(i.alias("at"), w.alias("word")))
    rows = docs.select(F.col(key), words_of(F.col(text)).alias("words"))
    rows = rows.withColumn("hits", F.array_compact(F.transform("words", hit)))
    names = [f"s{i}" for i in range(len(ALL))]
    rows = rows.select(key, "words", *(_verified(n, _starts(n, index)).alias(s) for n, index, s in zip(ALL, indexes, names)))
    base = [(n, s) for n, s in zip(ALL, names) if n.whole]
    places = F.concat(*(F.col(s) for _, s in base))
    shares = F.greatest(*(_share(n, F.col(s)) for n, s in zip(ALL, names)))
    return rows.select(
        key,
        F.size("words").cast("long").alias("n_words"),
        sum((F.size(s) for _, s in base), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        _labels([(n.label, F.size(s) > 0) for n, s in base]).alias("base_labels"),
        _labels([(n.label, F.size(s) > 0) for n, s in zip(ALL, names)]).alias("labels"),
        shares.alias("score"),
    )
