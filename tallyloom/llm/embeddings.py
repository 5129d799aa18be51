"""Near-duplicate embeddings over hierarchical navigable small-world graphs.

Vectors of one label are dealt by a hash of their id into shards of bounded
size, and each shard gets a layered proximity graph. Shards of a label are
compared pair by pair: every vector of one is searched in the graph of the
other, in both directions, collecting all vectors whose cosine reaches the
threshold. A search keeps a beam of the best vectors seen; it goes on while the
beam improves or the next vector is within a margin of the threshold, so large
groups are walked whole. For each pair of shards an audit draws vectors until
they have enough links, compares them with all rows of the other shard, and
doubles the beam while the graph search finds less of these links than the goal
asks. Where the widest beam still finds less, the two shards are compared whole.

Cosines are taken in double precision before a link counts. A task returns a
number of links for each vector and a spanning forest of the links it found, so
its output grows with the vectors and not with the links.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import components, salted_join, saved

COSINE = 0.98
SHARD = 4_096
NEIGHBOURS, BUILD_BEAM, BEAM = 12, 48, 24
GOAL = 0.99
#: An audit draws blocks of so many vectors until they have so many links to others, or a share of the shard is drawn.
AUDIT, ENOUGH, AUDIT_SHARE = 64, 64, 0.25
#: How far below the threshold a search still walks on.
MARGIN = 0.03


class Graph:
    """Layers of neighbour lists over unit vectors, entered one by one."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        self.vectors = vectors
        n = len(vectors)
        levels = np.array([_level(int(i)) for i in ids], np.int64)
        self.layers: list[dict[int, np.ndarray]] = [{} for _ in range(int(levels.max()) + 1)] if n else []
        self.entry = -1
        for i in range(n):
            self._insert(i, int(levels[i]))

    def _insert(self, i: int, level: int) -> None:
        if self.entry < 0:
            for layer in self.layers[: level + 1]:
                layer[i] = np.empty(0, np.int64)
            self.entry, self.top = i, level
            return
        q, at = self.vectors[i], self.entry
        for layer in range(self.top, level, -1):
            at = self._greedy(q, at, layer)
        for layer in range(min(level, self.top), -1, -1):
            found = self.search(q, at, BUILD_BEAM, layer)
            at = found[0][1]
            most = NEIGHBOURS * (2 if layer == 0 else 1)
            chosen = self._diverse([x for _, x in found], [s for s, _ in found], NEIGHBOURS)
            lists = self.layers[layer]
            lists[i] = np.array(chosen, np.int64)
            for j in chosen:
                near = np.append(lists[j], i)
                if len(near) > most:
                    sims = self.vectors[near] @ self.vectors[j]
                    order = np.argsort(-sims, kind="stable")
                    near = np.array(self._diverse(near[order].tolist(), sims[order].tolist(), most), np.int64)
                lists[j] = near
        for layer in range(self.top + 1, level + 1):
            self.layers[layer][i] = np.empty(0, np.int64)
        if level > self.top:
            self.entry, self.top = i, level

    def _diverse(self, near: list[int], sims: list[float], most: int) -> list[int]:
        """Of neighbours in order of nearness, those nearer to the vector than to one already chosen; then the nearest others."""
        between = self.vectors[near] @ self.vectors[near].T
        kept: list[int] = []
        for a, sim in enumerate(sims):
            if len(kept) == most:
                break
            if not kept or sim > between[a, kept].max():
                kept.append(a)
        spare = (a for a in range(len(near)) if a not in set(kept))
        while len(kept) < min(most, len(near)):
            kept.append(next(spare))
        return [near[a] for a in kept]

    def _greedy(self, q: np.ndarray, at: int, layer: int) -> int:
        best = float(self.vectors[at] @ q)
        while True:
            near = self.layers[layer][at]
            if not len(near):
                return at
            sims = self.vectors[near] @ q
            k = int(sims.argmax())
            if sims[k] <= best:
                return at
            at, best = int(near[k]), float(sims[k])

    def search(self, q: np.ndarray, at: int, beam: int, layer: int = 0, floor: float = math.inf) -> list[tuple[float, int]]:
        """The best ``beam`` vectors and all above ``floor`` that the walk meets, nearest first."""
        lists, seen = self.layers[layer], {at}
        sim = float(self.vectors[at] @ q)
        ahead, best, found = [(-sim, at)], [sim], [(sim, at)]
        while ahead:
            sim, x = heappop(ahead)
            if len(best) >= beam and -sim < best[0] and -sim < floor:
                break
            fresh = [y for y in lists[x].tolist() if y not in seen]
            if not fresh:
                continue
            seen.update(fresh)
            for sim, y in zip((self.vectors[fresh] @ q).tolist(), fresh):
                if len(best) < beam or sim > best[0] or sim >= floor:
                    heappush(ahead, (-sim, y))
                    found.append((sim, y))
                    heappush(best, sim)
                    if len(best) > beam:
                        heappop(best)
        found.sort(key=lambda f: (-f[0], f[1]))
        return found if floor < math.inf else found[:beam]

    def near(self, q: np.ndarray, beam: int, least: float) -> list[int]:
        at = self.entry
        for layer in range(self.top, 0, -1):
            at = self._greedy(q, at, layer)
        return [x for sim, x in self.search(q, at, beam, 0, least - MARGIN) if sim >= least - 1e-4]


def _level(i: int) -> int:
    """The highest layer of a vector, from a hash of its number."""
    draw = (int.from_bytes(hashlib.blake2b(str(i).encode(), digest_size=8).digest(), "big") + 1) / 2**64
    return int(-math.log(draw) / math.log(NEIGHBOURS))


def unit(vectors: np.ndarray) -> np.ndarray:
    """The vectors at length one; scaled by their largest component first, so that no square is lost."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def audited(a: np.ndarray, b: np.ndarray, least: float, same: bool) -> list[tuple[int, np.ndarray]]:
    """Rows of ``a`` with their true links to rows of ``b``, themselves left out."""
    drawn = np.random.default_rng(len(a)).permutation(len(a))
    seen, enough = [], 0
    for start in range(0, max(AUDIT, math.ceil(AUDIT_SHARE * len(a))), AUDIT):
        block = drawn[start : start + AUDIT]
        for i, row in zip(block.tolist(), a[block] @ b.T >= least):
            links = np.flatnonzero(row)
            links = links[links != i] if same else links
            if len(links):
                seen.append((i, links))
                enough += len(links)
        if enough >= ENOUGH:
            break
    return seen


def searched(a: np.ndarray, b: np.ndarray, graph: Graph, least: float, same: bool) -> np.ndarray:
    """Packed bits of the links of each row of ``a`` to the rows of ``b`` that the graph finds, beams widened as audits ask."""
    audit = audited(a, b, least, same)
    goal, beam = GOAL * sum(len(links) for _, links in audit), BEAM
    while sum(len(np.intersect1d(links, _verified(a[i], b, graph, beam, least))) for i, links in audit) < goal:
        if beam >= len(b):
            return _exact(a, b, least, same)
        beam *= 2
    bits = np.zeros((len(a), (len(b) + 7) // 8), np.uint8)
    for i in range(len(a)):
        hit = _verified(a[i], b, graph, beam, least)
        if same:
            hit = hit[hit != i]
        np.bitwise_or.at(bits[i], hit >> 3, (128 >> (hit & 7)).astype(np.uint8))
    return bits


def _exact(a: np.ndarray, b: np.ndarray, least: float, same: bool) -> np.ndarray:
    """The same from all rows, in blocks."""
    out = []
    for start in range(0, len(a), AUDIT):
        near = a[start : start + AUDIT] @ b.T >= least
        if same:
            near[np.arange(len(near)), start + np.arange(len(near))] = False
        out.append(np.packbits(near, axis=1))
    return np.concatenate(out)


def _verified(q: np.ndarray, b: np.ndarray, graph: Graph, beam: int, least: float) -> np.ndarray:
    near = np.array(graph.near(q, beam, least), np.int64)
    return near[b[near] @ q >= least] if len(near) else near


def _forest(rows: np.ndarray, columns: int, same: bool) -> Iterator[tuple[int, int]]:
    """Links that connect what all links connect, as (row, column)."""
    n = len(rows)
    parent = list(range(n if same else n + columns))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(n):
        for j in np.flatnonzero(np.unpackbits(rows[i], count=columns)).tolist():
            x, y = root(i), root(j if same else n + j)
            if x != y:
                parent[max(x, y)] = min(x, y)
                yield i, j


def _transposed(bits: np.ndarray, columns: int) -> np.ndarray:
    out = np.zeros((columns, (len(bits) + 7) // 8), np.uint8)
    for start in range(0, len(bits), 1024):  # eight rows make a byte
        block = np.unpackbits(bits[start : start + 1024], axis=1, count=columns)
        packed = np.packbits(block.T, axis=1)
        out[:, start // 8 : start // 8 + packed.shape[1]] = packed
    return out


_FOUND = "node bigint, other bigint, links bigint"


def _weighed(bits: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.array([int(weights[np.flatnonzero(np.unpackbits(row, count=len(weights)))].sum()) for row in bits])


def _built(frame: pd.DataFrame) -> pd.DataFrame:
    """One row for a shard: its vectors and its graph."""
    frame = frame.sort_values(["least", "same"])
    vectors = unit(np.stack(frame["vector"].to_numpy()).astype(float))
    graph = Graph(vectors.astype(np.float32), frame["least"].to_numpy())
    lists = [(len(layer), [(k, v.tolist()) for k, v in layer.items()]) for layer in graph.layers]
    nodes = np.array([k for _, items in lists for k, _ in items], np.int64)
    degree = np.array([len(v) for _, items in lists for _, v in items], np.int64)
    ends = np.array([x for _, items in lists for _, v in items for x in v], np.int64)
    row = {
        "label": frame["label"].iloc[0], "shard": frame["shard"].iloc[0], "dims": vectors.shape[1], "entry": graph.entry,
        "nodes": frame["node"].to_numpy(np.int64).tobytes(), "copies": frame["copies"].to_numpy(np.int64).tobytes(),
        "vectors": vectors.tobytes(), "layers": np.array([n for n, _ in lists], np.int64).tobytes(),
        "list_nodes": nodes.tobytes(), "degrees": degree.tobytes(), "ends": ends.tobytes(),
    }
    return pd.DataFrame([row])


_SHARD = "label int, shard int, dims int, entry int, nodes binary, copies binary, vectors binary, layers binary, list_nodes binary, degrees binary, ends binary"


def _loaded(row: dict, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, Graph]:
    numbers = {k: np.frombuffer(row[f"{side}_{k}"], np.int64) for k in ("nodes", "copies", "layers", "list_nodes", "degrees", "ends")}
    vectors = np.frombuffer(row[f"{side}_vectors"], float).reshape(-1, row[f"{side}_dims"])
    graph = Graph.__new__(Graph)
    graph.vectors, graph.entry = vectors.astype(np.float32), row[f"{side}_entry"]
    lists = np.split(numbers["ends"], np.cumsum(numbers["degrees"])[:-1])
    graph.layers, at = [], 0
    for n in numbers["layers"].tolist():
        graph.layers.append(dict(zip(numbers["list_nodes"][at : at + n].tolist(), lists[at : at + n])))
        at += n
    graph.top = len(graph.layers) - 1
    return numbers["nodes"], numbers["copies"], vectors, graph


def _compared(least: float):
    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.to_dict("records"):
                a_nodes, a_copies, a, a_graph = _loaded(row, "a")
                same = row["a_shard"] == row["b_shard"]
                b_nodes, b_copies, b, b_graph = (a_nodes, a_copies, a, a_graph) if same else _loaded(row, "b")
                bits = searched(a, b, b_graph, least, same)
                back = bits if same else searched(b, a, a_graph, least, False)
                bits |= _transposed(back, len(a))
                parts = [(a_nodes, _weighed(bits, b_copies))]
                if not same:
                    parts.append((b_nodes, _weighed(_transposed(bits, len(b)), a_copies)))
                for nodes, n in parts:
                    yield pd.DataFrame({"node": nodes[n > 0], "other": nodes[n > 0], "links": n[n > 0]})
                pairs = np.array(list(_forest(bits, len(b), same)), np.int64).reshape(-1, 2)
                yield pd.DataFrame({"node": a_nodes[pairs[:, 0]], "other": b_nodes[pairs[:, 1]], "links": np.zeros(len(pairs), np.int64)})

    return compare


def near_duplicates(
    table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = COSINE, shard: int = SHARD
) -> DataFrame:
    """``(key, n_links, component_id, kept)`` for each row of ``table``.

    Equal vectors of a label are searched as one and linked with each other.
    Rows whose label, id or vector is null, whose vector is empty, zero or holds
    null or non-finite components link with nothing and are components of their
    own; so do vectors of other lengths with each other. Rows that repeat an id
    are vectors each. Other columns are not read; an empty table gives an empty
    result.
    """
    rows = table.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vector"), F.col(label).cast("int").alias("label"))
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)
    usable = F.coalesce(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.forall("vector", good) & F.exists("vector", lambda x: x != 0), F.lit(False)
    )
    rows = saved(rows.withColumn("usable", usable).withColumn("same", F.when(usable, F.md5(F.array_join("vector", ",")))))
    groups = rows.where("usable").groupBy("label", "same").agg(F.min("id").alias("least"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
    groups = saved(groups.withColumn("dims", F.size("vector")).withColumn("node", F.monotonically_increasing_id()))
    per_label = groups.groupBy("label", "dims").agg(F.ceil(F.count("*") / F.lit(shard)).alias("shards"))
    dealt = groups.join(per_label.select(F.col("label").alias("l"), F.col("dims").alias("d"), "shards"), (F.col("label") == F.col("l")) & (F.col("dims") == F.col("d")))
    dealt = dealt.select("label", "dims", F.pmod(F.xxhash64("least", "same"), "shards").cast("int").alias("shard"), "node", "least", "same", "copies", "vector")
    shards = saved(dealt.groupBy("label", "dims", "shard").applyInPandas(_built, _SHARD))
    a, b = (shards.select(*(F.col(c).alias(f"{side}_{c}") for c in shards.columns)) for side in "ab")
    meet = (F.col("a_label") == F.col("b_label")) & (F.col("a_dims") == F.col("b_dims")) & (F.col("a_shard") <= F.col("b_shard"))
    pairs = a.join(b, meet).repartition("a_label", "a_dims", "a_shard", "b_shard")
    found = saved(pairs.mapInPandas(_compared(least), _FOUND))
    counts = found.groupBy("node").agg(F.sum("links").alias("found"))
    roots = components(found.where("node <> other"), "node", "other")
    facts = groups.select("label", "same", "node", "least", "copies").join(counts.withColumnRenamed("node", "n1"), F.col("node") == F.col("n1"), "left")
    facts = facts.join(roots.withColumnRenamed("node", "n2"), F.col("node") == F.col("n2"), "left")
    n_links = (F.coalesce("found", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    facts = saved(facts.select(F.concat_ws("/", "label", "same").alias("name"), n_links, "least", F.coalesce("root", "node").alias("of")))
    ids = saved(facts.groupBy("of").agg(F.min("least").alias("component_id")).withColumnRenamed("of", "group"))
    facts = facts.join(ids, F.col("of") == F.col("group")).select("name", "n_links", "component_id")
    named = rows.select("id", F.when(F.col("usable"), F.concat_ws("/", "label", "same")).alias("name"))
    out = salted_join(named, facts, "name", F.col("id"), "left")
    out = out.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
