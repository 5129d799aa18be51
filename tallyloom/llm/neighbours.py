"""Nearest neighbours by a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample of the vectors: each node's vectors are
clustered by k-means into ``BRANCHES`` children until few enough are left for a
leaf. Every vector of the table is then entered into the leaf that a greedy
descent leads it to, and leaves are stored in blocks of bounded size.

A query descends to the nearest leaf and puts the siblings it passes into a
priority queue by their distance; it goes on with the nearest one waiting until
it has visited as many leaves as it may. How many that is comes from a
calibration: a bounded set of the queries is compared with all rows, in blocks,
and visits are widened until the leaves of enough of the true neighbours are
among those visited. Blocks of queries and blocks of vectors then meet by leaf.

Equal vectors are one entry that carries its smallest ids, as many as can be
among the nearest, so a vector that holds a third of the table is compared once.
Cosines are taken in double precision, pair by pair, before neighbours are ranked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import saved

NEAREST = 5
EVERY = 50
#: Most vectors that the trees are fitted on, and most queries that calibrate the visits.
SAMPLE, CALIBRATION = 16_384, 256
BRANCHES, LEAF, ROUNDS = 8, 48, 8
#: Share of the true neighbours of the calibrating queries that visits must reach.
GOAL = 0.97
BLOCK, QUERY_BLOCK = 512, 256


class Tree(NamedTuple):
    """Nodes by number: the centroid of each and its children; a leaf has none. Node 0 is the root."""

    centroids: np.ndarray
    children: list[list[int]]

    def leaves_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf that a greedy descent finds for each vector."""
        at = np.zeros(len(vectors), np.int64)
        waiting = [(0, np.arange(len(vectors)))]
        while waiting:
            node, rows = waiting.pop()
            below = self.children[node]
            if not below or not len(rows):
                at[rows] = node
                continue
            nearest = (vectors[rows] @ self.centroids[below].T - _half_squares(self.centroids[below])).argmax(1)
            waiting += [(child, rows[nearest == k]) for k, child in enumerate(below)]
        return at

    def visits(self, query: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves, best bin first."""
        far = -(self.centroids @ query - _half_squares(self.centroids))
        ahead, found = [(0.0, 0)], []
        while ahead and len(found) < most:
            node = heappop(ahead)[1]
            while below := self.children[node]:
                nearest = min(below, key=far.__getitem__)
                for child in below:
                    if child != nearest:
                        heappush(ahead, (float(far[child]), child))
                node = nearest
            found.append(node)
        return found

    @property
    def n_leaves(self) -> int:
        return sum(not below for below in self.children)


def _half_squares(centroids: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", centroids, centroids) / 2


def fit(vectors: np.ndarray, branches: int = BRANCHES, leaf: int = LEAF, rounds: int = ROUNDS, seed: int = 0) -> Tree:
    """A tree whose leaves hold up to ``leaf`` of the vectors; more only where they do not part."""
    rng = np.random.default_rng(seed)
    centroids, children = [vectors.mean(0)], [[]]
    waiting = [(0, np.arange(len(vectors)))]
    while waiting:
        node, rows = waiting.pop()
        if len(rows) <= leaf:
            continue
        here = vectors[rows]
        centres = here[rng.choice(len(rows), min(branches, len(rows)), replace=False)]
        for _ in range(rounds):
            nearest = (here @ centres.T - _half_squares(centres)).argmax(1)
            used = np.unique(nearest)
            centres = np.stack([here[nearest == k].mean(0) for k in used])
        nearest = (here @ centres.T - _half_squares(centres)).argmax(1)
        parts = [rows[nearest == k] for k in range(len(centres))]
        if max(map(len, parts)) == len(rows):
            continue
        for centre, part in zip(centres, parts):
            if len(part):
                children[node].append(len(centroids))
                waiting.append((len(centroids), part))
                centroids.append(centre)
                children.append([])
    return Tree(np.stack(centroids), children)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors; their largest component is brought to one first, so no square under- or overflows."""
    vectors = vectors / np.abs(vectors).max(1)[:, None]
    return vectors / np.sqrt((vectors * vectors).sum(1))[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines, row by row, of original vectors in double precision; each depends on its own pair alone."""
    a, b = a / np.abs(a).max(1)[:, None], b / np.abs(b).max(1)[:, None]
    return np.clip((a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1))), -1.0, 1.0)


def _usable(key: Column, vector: Column) -> Column:
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    return F.coalesce(key.isNotNull() & good & F.exists(vector, lambda x: x != 0), F.lit(False))


def _array(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float)


def _sampled(rows: DataFrame, hashed: Column, most: int, total: int) -> DataFrame:
    """About ``most`` rows by a hash, and never more than twice as many."""
    share = min(1.0, most / max(total, 1))
    return rows if share == 1 else rows.where(F.pmod(hashed, F.lit(1 << 30)) < int(share * (1 << 30))).limit(2 * most)


_BLOCK = "dims int, leaf int, ids binary, vectors binary"


def _entered(trees: dict[int, Tree]):
    def enter(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dims, part in frame.groupby("dims"):
                leaf = trees[dims].leaves_of(scaled(_array(part["vector"]))) if dims in trees else 0
                yield part[["dims", "node", "vector"]].assign(leaf=leaf)[["dims", "leaf", "node", "vector"]]

    return enter


def _packed(frame: pd.DataFrame) -> pd.DataFrame:
    vectors = _array(frame["vector"])
    return pd.DataFrame(
        {"dims": [vectors.shape[1]], "leaf": frame["leaf"].iloc[:1].to_numpy(), "ids": [frame["node"].to_numpy(np.int64).tobytes()], "vectors": [vectors.tobytes()]}
    )


def _visiting(trees: dict[int, Tree], most: dict[int, int]):
    """Queries, some at a time, packed by the leaf they visit."""

    def visit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dims, every in frame.groupby("dims"):
                for start in range(0, len(every), QUERY_BLOCK):
                    part = every.iloc[start : start + QUERY_BLOCK]
                    vectors, nodes = _array(part["vector"]), part["node"].to_numpy(np.int64)
                    by_leaf: dict[int, list[int]] = {}
                    if dims in trees:
                        for i, unit in enumerate(scaled(vectors)):
                            for leaf in trees[dims].visits(unit, most[dims]):
                                by_leaf.setdefault(leaf, []).append(i)
                    else:
                        by_leaf[0] = list(range(len(part)))
                    packed = [nodes[rows].tobytes() for rows in by_leaf.values()], [vectors[rows].tobytes() for rows in by_leaf.values()]
                    yield pd.DataFrame({"dims": dims, "leaf": list(by_leaf), "ids": packed[0], "vectors": packed[1]})

    return visit


def _near(queries: np.ndarray, vectors: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, row, cosine)`` for the rows that can be among the ``most`` nearest to each query."""
    rough = scaled(queries) @ scaled(vectors).T
    if len(vectors) > most:
        least = np.partition(rough, len(vectors) - most, axis=1)[:, len(vectors) - most]
        query, row = np.nonzero(rough >= least[:, None] - 1e-9)
    else:
        query, row = (x.ravel() for x in np.indices(rough.shape))
    return query, row, cosines(queries[query], vectors[row])


_NEAR = "query bigint, node bigint, score double"


def _searched(most: int):
    """Rows ``(q_ids, q_vectors, ids, vectors, dims)`` to the ``most`` best of each block for each query, and all that tie with the last."""

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.to_dict("records"):
                dims = row["dims"]
                q_ids, ids = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
                queries, vectors = (np.frombuffer(row[c], float).reshape(-1, dims) for c in ("q_vectors", "vectors"))
                query, near, scores = _near(queries, vectors, most)
                yield pd.DataFrame({"query": q_ids[query], "node": ids[near], "score": scores})

    return search


def _matched(queries: DataFrame, blocks: DataFrame, most: int) -> DataFrame:
    """``(query, node, score)``: for each visit the nearest of the leaf."""
    visits = queries.select(F.col("dims").alias("q_dims"), F.col("leaf").alias("q_leaf"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    met = visits.join(blocks, (F.col("q_dims") == F.col("dims")) & (F.col("q_leaf") == F.col("leaf")))
    return met.select("dims", "q_ids", "q_vectors", "ids", "vectors").mapInPandas(_searched(most), _NEAR)


def _ranked(found: DataFrame, most: int) -> DataFrame:
    """The rows of ``(query, id, score)`` among the ``most`` best of their query, with their rank."""
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _calibrated(trees: dict[int, Tree], truth: DataFrame, queries: dict[int, tuple[int, np.ndarray]], goal: float) -> dict[int, int]:
    """For each length of vectors the fewest leaves, doubled step by step and then halved back, that reach the goal."""
    needed: dict[int, list[float]] = {dims: [] for dims in trees}
    order: dict[int, dict[int, int]] = {}
    for row in truth.collect():  # at most NEAREST rows for each calibrating query
        dims, unit = queries[row["query"]]
        if row["query"] not in order:
            order[row["query"]] = {leaf: i + 1 for i, leaf in enumerate(trees[dims].visits(unit, trees[dims].n_leaves))}
        needed[dims].append(order[row["query"]][row["leaf"]])
    visits = {}
    for dims, depths in needed.items():
        reached = lambda v: sum(d <= v for d in depths) >= goal * len(depths)  # noqa: B023, E731
        v = 1
        while v < trees[dims].n_leaves and not (depths and reached(v)):
            v *= 2
        low, v = v // 2, min(v, trees[dims].n_leaves)
        while depths and v - low > 1:
            middle = (low + v) // 2
            low, v = (low, middle) if reached(middle) else (middle, v)
        visits[dims] = v
    return visits


def nearest(
    table: DataFrame, queries: Column | None = None, key: str = "vec_id", vector: str = "embedding", most: int = NEAREST,
    sample: int = SAMPLE, calibration: int = CALIBRATION, goal: float = GOAL, leaf: int = LEAF, block: int = BLOCK,
) -> DataFrame:
    """``(query_id, rank, key, score)``: the ``most`` nearest rows found for each query, nearest first, ties to the smaller id.

    ``queries`` says which rows are queries: those whose id is divisible by
    ``EVERY`` unless given. The candidates of a query are all rows of its length
    but itself; if there are fewer than ``most``, all are returned. Rows whose id
    or vector is null, or whose vector is empty, zero or holds null or non-finite
    components, take no part. A row that repeats an id with another vector is a
    vector of its own for others and, as a query, searches once for each vector;
    candidates with the query's own id are left out, and equal rows count as one.
    Other columns are not read; an empty table gives an empty result. Tables of up
    to ``sample`` vectors are fitted whole. Beyond it leaves grow with the table,
    and ``sample`` should, too.
    """
    rows = table.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    # zeros of either sign are one vector
    plain = F.transform("vector", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    rows = rows.where(_usable(F.col("id"), F.col("vector"))).select("id", plain.alias("vector"))
    rows = rows.withColumn("same", F.md5(F.array_join("vector", ",")))
    asked = queries if queries is not None else F.pmod(F.col("id"), F.lit(EVERY)) == 0
    # the smallest ids of each vector, one more than can be asked for since the query's own does not count
    first = F.row_number().over(Window.partitionBy("same").orderBy("id"))
    once = rows.select("same", "id").withColumn("n", first).where(F.col("n") <= most + 1)
    # repeated rows are one
    ids = saved(once.groupBy("same").agg(F.collect_set("id").alias("ids")))
    vectors = rows.groupBy("same").agg(F.first("vector").alias("vector"))
    nodes = saved(vectors.select("same", "vector", F.size("vector").alias("dims"), F.monotonically_increasing_id().alias("node")))
    named = nodes.select("same", "node", "dims")
    asking = saved(rows.where(asked).select("id", "same").distinct().join(named, "same").select("id", "node"))
    total = nodes.count()
    learnt = _sampled(nodes.select("same", "dims", "vector"), F.xxhash64("same"), sample, total).toPandas()
    trees = {int(dims): fit(scaled(_array(part.sort_values("same")["vector"])), leaf=leaf) for dims, part in learnt.groupby("dims")}
    spots = nodes.select("dims", "node", "vector").mapInPandas(_entered(trees), "dims int, leaf int, node bigint, vector array<double>")
    spots = saved(spots)
    cuts = saved(spots.groupBy("dims", "leaf").agg(F.ceil(F.count("*") / F.lit(block)).alias("cuts")))
    cut = spots.join(cuts.select(F.col("dims").alias("d"), F.col("leaf").alias("l"), "cuts"), (F.col("dims") == F.col("d")) & (F.col("leaf") == F.col("l")))
    cut = cut.withColumn("cut", F.pmod(F.xxhash64("node"), F.col("cuts")))
    blocks = saved(cut.select("dims", "leaf", "cut", "node", "vector").groupBy("dims", "leaf", "cut").applyInPandas(_packed, _BLOCK))
    searching = asking.select("node").distinct().join(nodes.select("node", "dims", "vector"), "node")
    probes = _sampled(searching, F.xxhash64("node"), calibration, asking.count()).toPandas()
    probes = {int(r.node): (int(r.dims), np.array(r.vector)) for r in probes.itertuples()}
    truth = _brute(blocks, probes, most)
    where_to = truth.join(spots.select(F.col("node").alias("n"), "leaf"), F.col("node") == F.col("n")).select("query", "leaf")
    units = {node: (dims, scaled(v[None])[0]) for node, (dims, v) in probes.items() if dims in trees}
    visits = _calibrated(trees, where_to.where(F.col("query").isin(list(units))) if len(units) < len(probes) else where_to, units, goal)
    met = _matched(searching.mapInPandas(_visiting(trees, visits), _BLOCK), blocks, most + 1)
    return _answers(met, asking, nodes.join(ids, "same").select("node", "ids"), most, key)


def _answers(met: DataFrame, asking: DataFrame, ids: DataFrame, most: int, key: str) -> DataFrame:
    """Ids in the place of vectors: the best entries of each query, then the best ids among theirs."""
    # an entry has up to ``most`` ids to give and the query's own vector may be one entry more
    best = _ranked(met.withColumnRenamed("node", "id"), most + 1).select("query", F.col("id").alias("near"), "score")
    best = best.join(ids, F.col("near") == F.col("node")).select("query", "ids", "score")
    asked = asking.select(F.col("id").alias("query_id"), F.col("node").alias("q")).join(best, F.col("q") == F.col("query"))
    found = asked.select(F.col("query_id").alias("query"), "score", F.explode("ids").alias("id")).where("query <> id")
    found = found.groupBy("query", "id").agg(F.max("score").alias("score"))
    return _ranked(found, most).select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias(key), "score")


def _brute(blocks: DataFrame, probes: dict[int, tuple[int, np.ndarray]], most: int) -> DataFrame:
    """``(query, node)``: the true nearest entries of a bounded set of queries, each compared with all blocks; itself left out."""
    by_dims: dict[int, tuple[list[int], list[np.ndarray]]] = {}
    for node, (dims, v) in probes.items():
        names, queries = by_dims.setdefault(dims, ([], []))
        names.append(node)
        queries.append(v)

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.to_dict("records"):
                if row["dims"] in by_dims:
                    names, queries = (np.array(x) for x in by_dims[row["dims"]])
                    ids, vectors = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["vectors"], float).reshape(-1, row["dims"])
                    query, near, scores = _near(queries, vectors, most + 1)
                    other = names[query] != ids[near]
                    yield pd.DataFrame({"query": names[query][other], "node": ids[near][other], "score": scores[other]})

    found = blocks.mapInPandas(compare, _NEAR).withColumnRenamed("node", "id")
    return _ranked(found, most).select("query", F.col("id").alias("node"))
