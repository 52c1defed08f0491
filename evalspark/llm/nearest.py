"""Approximate nearest neighbours by a hierarchical k-means tree with best-bin-first traversal.

The tree is fitted on a bounded sample (``SAMPLE`` rows, the first by a hash of vec_id); every row is indexed. A query
walks the tree with a priority queue of nodes by distance to their centres, and visits leaves in that order. How many is
calibrated on the sample: the visits are widened until queries from the sample find ``RECALL`` of their true neighbours
there. In the whole table neighbours are closer than in a sample, so the measured recall is higher; the tests measure it
against brute force.

A leaf may hold a third of all rows: leaves are dealt into cells of bounded numbers of rows and of queries, each cell
returns its own best ``k`` a query, and these are merged. Scores are exact cosines in double precision on the vectors as
given, with ties to the smaller vec_id.

Edge cases: vectors that are null, zero, of another length than most of the sample, or that hold null or non-finite
components take no part, nor do rows with a null vec_id. Rows that share a vec_id count once, and never as neighbours
of their own id. With fewer than ``k`` candidates in the leaves visited, visits go on until there are enough or no more.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import materialize, table

SAMPLE, BRANCH, LEAF = 8192, 8, 64  # rows to fit on, children of a node, sample rows in a leaf at most
RECALL, PROBES = 0.97, 400
CELL_ROWS, CELL_QUERIES = 20_000, 2_000


@dataclass
class Tree:
    """Node 0 is the root; a node has children and their centres, or a leaf number."""

    children: list[list[int]] = field(default_factory=list)
    centres: list[np.ndarray | None] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0
    dim: int = 0
    visits: int = 1

    def add(self) -> int:
        self.children.append([])
        self.centres.append(None)
        self.leaf.append(-1)
        return len(self.leaf) - 1

    def grow(self, x: np.ndarray, rng: np.random.Generator, depth: int = 0) -> int:
        node = self.add()
        part = _k_means(x, rng) if len(x) > LEAF and depth < 24 else None
        if part is None:
            self.leaf[node] = self.leaves
            self.leaves += 1
            return node
        centres, label = part
        self.centres[node] = centres
        for c in range(len(centres)):
            self.children[node].append(self.grow(x[label == c], rng, depth + 1))
        return node

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row: down the tree by the nearest centre."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
            else:
                best = _distances(x[rows], self.centres[node]).argmin(1)
                todo += [(c, rows[best == i]) for i, c in enumerate(self.children[node]) if (best == i).any()]
        return out

    def leaves_by_best_bin(self, q: np.ndarray) -> Iterator[int]:
        """All leaves for one query, best bin first."""
        heap = [(0.0, 0)]
        while heap:
            _, node = heapq.heappop(heap)
            if self.leaf[node] >= 0:
                yield self.leaf[node]
            else:
                for d, c in zip(_distances(q[None], self.centres[node])[0], self.children[node], strict=True):
                    heapq.heappush(heap, (float(d), c))


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres * centres).sum(1) - 2 * (x @ centres.T)


def _k_means(x: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    distinct = np.unique(x, axis=0)
    if len(distinct) < 2:
        return None
    centres = distinct[rng.permutation(len(distinct))[:BRANCH]]
    for _ in range(12):
        label = _distances(x, centres).argmin(1)
        centres = np.stack([x[label == c].mean(0) if (label == c).any() else centres[c] for c in range(len(centres))])
    label = _distances(x, centres).argmin(1)
    used = np.unique(label)
    return (centres[used], np.searchsorted(used, label)) if len(used) > 1 else None


def _matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their vectors in double precision)."""
    keep, rows = [], []
    for i, v in enumerate(column):
        if v.is_valid and len(v) == dim and not v.values.null_count:
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if np.isfinite(x).all() and x.any():
                keep.append(i)
                rows.append(x)
    return np.array(keep, np.int64), np.stack(rows) if rows else np.zeros((0, dim))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def fit(vectors: DataFrame, k: int, sample: int = SAMPLE) -> Tree | None:
    """The tree on a sample of at most ``sample`` ids, one row of each, with calibrated visits."""
    rows = vectors.where("vec_id is not null and embedding is not null")
    ids = rows.select("vec_id").distinct().orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample)
    # copies of a row would pass for its neighbours in calibration: each id counts once, with the least of its vectors
    drawn = rows.join(F.broadcast(ids), "vec_id").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    some = drawn.orderBy(F.xxhash64("vec_id"), "vec_id").toArrow().column("embedding").combine_chunks()
    if not len(some):
        return None
    lengths = np.array([len(v) for v in some])
    dim = int(np.bincount(lengths).argmax())
    _, x = _matrix(some, dim)
    if not len(x):
        return None
    x = _unit(x)
    tree = Tree(dim=dim)
    tree.grow(x, np.random.default_rng(3))
    leaf = tree.assign(x)
    probes = np.arange(len(x))[:: max(1, len(x) // PROBES)]
    rank = np.zeros((len(probes), min(k, len(x) - 1)), np.int64)
    for i, p in enumerate(probes):
        near = x @ x[p]
        near[p] = -2
        order = {n: j for j, n in enumerate(tree.leaves_by_best_bin(x[p]))}
        rank[i] = [order[leaf[j]] for j in np.argsort(-near, kind="stable")[: rank.shape[1]]]
    tree.visits = next((v for v in range(1, tree.leaves + 1) if (rank < v).mean() >= RECALL), tree.leaves) if rank.size else tree.leaves
    return tree


def _best(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """The k nearest of x for every query, by exact cosines."""
    norms, units = np.sqrt((x * x).sum(1)), _unit(x)
    out = []
    for a in range(0, len(q), 256):
        rough = _unit(q[a : a + 256]) @ units.T
        for i in range(len(rough)):
            own = ids == q_ids[a + i]
            rough[i, own] = -3
            n = len(ids) - int(own.sum())
            if not n:
                continue
            least = np.partition(rough[i], -min(k, n))[-min(k, n)]
            near = np.flatnonzero((rough[i] >= least - 1e-9) & ~own)  # all that may tie, then exactly
            if len(near) > 4 * k:  # copies of one vector: only their k smallest ids can be among the first k
                _, which = np.unique(x[near], axis=0, return_inverse=True)
                order = np.lexsort((ids[near], which.reshape(-1)))
                w = which.reshape(-1)[order]
                place = np.arange(len(w)) - np.searchsorted(w, w)
                near = near[order[place < k]]
            v = q[a + i]
            exact = (x[near] * v).sum(1) / (norms[near] * np.sqrt((v * v).sum()))
            for j in np.lexsort((ids[near], -exact))[:k]:
                out.append((int(q_ids[a + i]), int(ids[near[j]]), float(exact[j])))
    return out


def search(vectors: DataFrame, is_query: str, k: int = 5, sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row where ``is_query`` holds, among all rows."""
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", "embedding", F.expr(f"coalesce({is_query}, false)").alias("q"))
    tree = fit(rows, k, sample)
    if tree is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, x = _matrix(batch.column("embedding"), tree.dim)
            keep = keep[[batch.column("vec_id")[int(i)].is_valid for i in keep]] if batch.column("vec_id").null_count else keep
            if not len(keep):
                continue
            _, x = _matrix(batch.column("embedding").take(pa.array(keep)), tree.dim)
            some = batch.take(pa.array(keep))
            yield pa.RecordBatch.from_arrays([some.column("vec_id"), pa.array([r.tobytes() for r in x], pa.binary()), some.column("q"), pa.array(tree.assign(_unit(x)), pa.int32())], ["vec_id", "v", "q", "leaf"])

    indexed = materialize(rows.mapInArrow(index, "vec_id long, v binary, q boolean, leaf int"), "indexed")
    # different ids of each leaf, a row for each leaf of the bounded tree; one less counts, as a query's own id may be there
    held = {r["leaf"]: r["n"] - 1 for r in indexed.select("leaf", "vec_id").distinct().groupBy("leaf").agg(F.count("*").alias("n")).collect()}

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, leaves, which = batch.column("vec_id").to_pylist(), [], []
            for i, v in enumerate(batch.column("v")):
                seen = found = 0
                for leaf in tree.leaves_by_best_bin(_unit(np.frombuffer(v.as_buffer())[None])[0]):
                    if seen >= tree.visits and found > 2 * k:
                        break
                    seen += 1
                    if leaf in held:
                        found += held[leaf]
                        leaves.append(leaf)
                        which.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in which], pa.int64()), batch.column("v").take(pa.array(which, pa.int64())), pa.array(leaves, pa.int32())], ["query_id", "v", "leaf"])

    asked = materialize(indexed.where("q").select("vec_id", "v").mapInArrow(visit, "query_id long, v binary, leaf int"), "asked")
    asking = asked.groupBy("leaf").agg(F.count("*").alias("qn"))
    cells = asking.join(indexed.groupBy("leaf").agg(F.count("*").alias("n")), "leaf").select("leaf", F.ceil(F.col("n") / CELL_ROWS).cast("int").alias("a"), F.ceil(F.col("qn") / CELL_QUERIES).cast("int").alias("b"))
    cells = F.broadcast(cells)  # a row for each leaf of the bounded tree
    side = indexed.join(cells, "leaf").select("leaf", F.pmod(F.xxhash64("vec_id"), "a").cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("b") - 1)).alias("j"), "vec_id", "v")
    other = asked.join(cells, "leaf").select("leaf", F.explode(F.sequence(F.lit(0), F.col("a") - 1)).alias("i"), F.pmod(F.xxhash64("query_id"), "b").cast("int").alias("j"), "query_id", "v")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        get = lambda t: np.stack([np.frombuffer(v.as_buffer()) for c in t.column("v").chunks for v in c]) if len(t) else np.zeros((0, tree.dim))
        out = []
        if len(left) and len(right):
            ids, first = np.unique(left.column("vec_id").to_numpy(), return_index=True)
            q_ids, q_first = np.unique(right.column("query_id").to_numpy(), return_index=True)
            out = _best(get(right)[q_first], q_ids, get(left)[first], ids, k)
        return pa.table({n: pa.array([r[c] for r in out], t) for c, (n, t) in enumerate((("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())))})

    found = side.groupBy("leaf", "i", "j").cogroup(other.groupBy("leaf", "i", "j")).applyInArrow(meet, "query_id long, vec_id long, score double")
    one = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = one.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("top"))
    return best.select("query_id", F.posexplode("top").alias("p", "x")).select("query_id", (F.col("p") + 1).cast("int").alias("rank"), "x.vec_id", (-F.col("x.s")).alias("score"))


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id % 50 = 0")
