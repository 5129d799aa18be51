"""Token counts by byte-pair merging over a heap and a linked list.

The symbols of a piece (its bytes) form a doubly linked list. A heap holds the
rank of every adjacent pair that a merge exists for; the lowest rank, leftmost
first, is popped, its two symbols become one and the pairs around it are
pushed anew. Entries whose symbols have changed meanwhile are skipped. Each
merge removes one symbol, so the count is symbols minus merges and no token
identifier is ever looked up. A piece of n bytes takes O(n log n) steps, also
when it is one very long run.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame

#: How a byte-level vocabulary splits text before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> tuple[dict[tuple[str, str], int], list[str]]:
    """The rank of every merge, and the special strings, of a tokenizer file."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    ranks = {}
    for rank, merge in enumerate(model["model"]["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        ranks[left, right] = rank
    return ranks, [token["content"] for token in model["added_tokens"]]


def merged_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many symbols are left when no pair can be merged any more."""
    n = len(symbols)
    get = ranks.get
    heap = [(rank, i) for i, pair in enumerate(zip(symbols, symbols[1:])) if (rank := get(pair)) is not None]
    if not heap:
        return n
    heapify(heap)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    merges = 0
    while heap:
        rank, i = heappop(heap)
        left = symbols[i]
        if left is None or (j := after[i]) >= n or get((left, symbols[j])) != rank:
            continue
        symbols[i] = left = left + symbols[j]
        symbols[j] = None
        merges += 1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (rank := get((left, symbols[k]))) is not None:
                heappush(heap, (rank, i))
        if (h := before[i]) >= 0 and (rank := get((symbols[h], left))) is not None:
            heappush(heap, (rank, h))
    return n - merges


class Remembered(dict):
    """Counts of short strings seen before, within a bound."""

    LONGEST, MOST = 40, 600_000

    def __init__(self, count):
        self.count = count

    def __missing__(self, string: str) -> int:
        n = self.count(string)
        if len(string) <= self.LONGEST:
            if len(self) >= self.MOST:
                self.clear()
            self[string] = n
        return n


class Counter:
    """Tokens of texts. A space that stands alone always begins a piece, so texts are cut there first."""

    def __init__(self, ranks: dict[tuple[str, str], int], special: list[str]):
        self.ranks = ranks
        self.letters = byte_letters()
        self.pieces = regex.compile(PIECES).findall
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.wide = regex.compile(r"\s | \s").search
        self.of_piece = Remembered(self._piece)
        self.of_word = Remembered(self._word)

    def _piece(self, piece: str) -> int:
        return merged_count([*piece.encode().decode("latin-1").translate(self.letters)], self.ranks)

    def _word(self, word: str) -> int:
        return self._plain(" " + word)

    def _plain(self, text: str) -> int:
        return sum(map(self.of_piece.__getitem__, self.pieces(text)))

    def _text(self, text: str) -> int:
        if self.wide(text):
            return self._plain(text)
        first, *rest = text.split(" ")
        return self._plain(first) + sum(map(self.of_word.__getitem__, rest))

    def tokens(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return self._text(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._text, parts))


#: One for each vocabulary in a worker process, so that its memory of pieces outlives a task.
_COUNTERS: dict[str, Counter] = {}


def counter_of(path: str, vocabulary: Broadcast) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(*vocabulary.value)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, path: str, limit: int = 512, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_bytes, n_tokens, over_limit)`` for each row of ``docs``.

    Null and empty texts have no bytes and no tokens; repeated rows are counted
    each; other columns are not read; an empty table gives an empty result.
    The vocabulary file is read once on the driver; its size is that of the
    file, whatever the input. Texts are streamed in Arrow batches, no row is
    shuffled.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, n_bytes bigint, n_tokens bigint, over_limit boolean"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(path, vocabulary)
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            tokens = [counter.tokens(x) for x in texts]
            columns = [
                batch.column(0),
                pa.array([len(x.encode()) for x in texts], pa.int64()),
                pa.array(tokens, pa.int64()),
                pa.array([n > limit for n in tokens], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(key, text).mapInArrow(count, schema)
