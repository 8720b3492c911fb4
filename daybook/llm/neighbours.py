"""Approximate nearest neighbours by inner product, with a tree of k-means centres.

The tree is fitted on a bounded sample (SAMPLE vectors, at most LEAVES leaves) and every vector is assigned to a
leaf. A query walks the tree best bin first: a priority queue gives the nearest unopened node, inner nodes push
their children, leaves are visited. How many leaves a query visits is calibrated: for a sample of queries the true
neighbours are found by brute force over all vectors, and the visits are widened until TARGET of them lie in visited
leaves. A query goes on until the visited leaves hold enough vectors for its result.

Inner products become distances by one further component that brings every vector to the largest norm.

Work is dealt in cells: leaves in a row of about CELL vectors together, and large leaves in several cells, by
counts, so a leaf of equal vectors is spread. Queries of a cell are dealt to groups of about GROUP, and a cell's vectors are
sent once to each of its groups: none where no query asks. Equal vectors of a leaf are scored once, and at most PAIRS
scores are held before they are cut to the best. Results are scored on the original vectors in double precision,
component by component.

Only the tree, the leaf counts (LEAVES at most) and the calibration's results reach the driver.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do
those whose length is not the most frequent one, nor null ids; ids that are no integers are refused; of rows that repeat an id the smallest vector counts;
equal scores go to the smaller id; fewer candidates than asked for are all returned; no vectors, no rows.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .stage import staged

SAMPLE = 16384       # vectors the tree is fitted on
LEAF = 32            # of them in a leaf
BRANCH = 16
LEAVES = 4096
QUERIES = 256        # calibration queries
TARGET = 0.96        # recall that widening must reach on them
CELL = 1 << 14       # vectors in a cell
GROUP = 1 << 11      # queries that meet a cell at a time
PAIRS = 1 << 20      # scores held at a time
CLOSE = 1e-9         # slack of fast scores


@dataclass
class Tree:
    centres: np.ndarray            # nodes x dimensions
    children: list[list[int]]      # of each node; none: a leaf
    leaf: np.ndarray               # number of the leaf, or -1
    norm: float

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def lift(self, v: np.ndarray) -> np.ndarray:
        """Vectors with the component that brings them to the largest norm."""
        rest = np.maximum(0.0, self.norm ** 2 - np.einsum("ij,ij->i", v, v))
        return np.concatenate([v, np.sqrt(rest)[:, None]], axis=1)

    def aim(self, q: np.ndarray) -> np.ndarray:
        """Queries in the same space, at the largest norm."""
        q = q / np.linalg.norm(q, axis=1, keepdims=True) * self.norm
        return np.concatenate([q, np.zeros((len(q), 1))], axis=1)

    def assign(self, v: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest child, level by level."""
        lifted, at, out = self.lift(v), np.zeros(len(v), np.int64), np.full(len(v), -1)
        while (out < 0).any():
            for node in np.unique(at[out < 0]):
                rows = np.flatnonzero((at == node) & (out < 0))
                if self.leaf[node] >= 0:
                    out[rows] = self.leaf[node]
                else:
                    kids = np.array(self.children[node])
                    at[rows] = kids[distances(lifted[rows], self.centres[kids]).argmin(axis=1)]
        return out

    def visits(self, far: np.ndarray, counts: np.ndarray, leaves: int, rows: int) -> list[int]:
        """Leaves in the order best bin first, until `leaves` are visited and hold `rows` vectors. far: the query's
        distance to each node."""
        queue, out, held = [(0.0, 0)], [], 0
        while queue and (len(out) < leaves or held < rows):
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                out.append(int(self.leaf[node]))
                held += int(counts[out[-1]])
            for child in self.children[node]:
                heapq.heappush(queue, (float(far[child]), child))
        return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None, :]


def k_means(v: np.ndarray, k: int, random: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    centres = v[random.choice(len(v), k, replace=False)]
    for _ in range(rounds):
        of = distances(v, centres).argmin(axis=1)
        for j in range(k):
            if (of == j).any():
                centres[j] = v[of == j].mean(axis=0)
    return centres, distances(v, centres).argmin(axis=1)


def fit_tree(v: np.ndarray, norm: float, leaf: int = LEAF, branch: int = BRANCH, leaves: int = LEAVES) -> Tree:
    """A tree of centres; the largest node is split first, until all are small or there are enough leaves."""
    random = np.random.default_rng(0)
    tree = Tree(np.zeros((1, v.shape[1] + 1)), [[]], np.array([-1]), norm)
    lifted, centres, children = tree.lift(v), [np.zeros(v.shape[1] + 1)], [[]]
    open_, ends = [(-len(v), 0, np.arange(len(v)))], 1
    done: list[int] = []
    while open_:
        size, node, rows = heapq.heappop(open_)
        k = min(branch, -(-len(rows) // leaf), leaves - ends + 1)
        parts = []
        if k > 1:
            points, of = k_means(lifted[rows], k, random)
            parts = [(points[j], rows[of == j]) for j in range(k) if (of == j).any()]
        if len(parts) < 2:
            done.append(node)
            continue
        for point, part in parts:
            children[node].append(len(centres))
            heapq.heappush(open_, (-len(part), len(centres), part))
            centres.append(point)
            children.append([])
        ends += len(parts) - 1
    order, stack = [], [0]
    while stack:  # leaves are numbered in the tree's order, so neighbours share cells
        node = stack.pop()
        if children[node]:
            stack += reversed(children[node])
        else:
            order.append(node)
    number = np.full(len(centres), -1)
    number[order] = np.arange(len(order))
    return Tree(np.array(centres), children, number, norm)


def nearest(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of each row's k largest fast scores and those as close to the last as rounding reaches."""
    if scores.shape[1] > k:
        last = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        return np.nonzero(scores >= last[:, None] - CLOSE * np.maximum(1.0, np.abs(last[:, None])))
    return np.nonzero(np.ones(scores.shape, bool))


def exact(a: np.ndarray, rows: np.ndarray, b: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Inner products of a[rows] and b[cols], added component by component; only one component is gathered at a time."""
    total = np.zeros(len(rows))
    for i in range(a.shape[1]):
        total += a[rows, i] * b[cols, i]
    return total


def best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's k best rows, best first; equal scores by smaller vector id."""
    order = np.lexsort((vec, -score, query))
    q = query[order]
    starts = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, int)
    rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
    return order[rank < k]


def first_equals(v: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first k rows of each group of equal rows, in order. More of them cannot be among a query's k best
    where rows stand by id."""
    if len(v) <= k:
        return np.arange(len(v))
    rows = np.ascontiguousarray(v + 0.0).view(np.dtype((np.void, v.shape[1] * v.itemsize))).ravel()  # no negative zeros
    of = np.unique(rows, return_inverse=True)[1].ravel()
    order = np.argsort(of, kind="stable")
    starts = np.flatnonzero(np.append(True, of[order][1:] != of[order][:-1]))
    rank = np.arange(len(v)) - np.repeat(starts, np.diff(np.append(starts, len(v))))
    return np.sort(order[rank < k])


def meet(asked: pd.DataFrame, there: pd.DataFrame, k: int) -> pd.DataFrame:
    """query_id, vec_id, score: the k best for the queries (query_id, v, leaves) among the vectors (vec_id, v, leaf) of
    their leaves."""
    kept = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    if len(asked) and len(there):
        there = there.sort_values(["leaf", "vec_id"], kind="stable")
        ids, q = asked["query_id"].to_numpy(), matrix(asked["v"])
        vec, v, leaf = there["vec_id"].to_numpy(), matrix(there["v"]), there["leaf"].to_numpy()
        of: dict[int, list[int]] = {}
        for row, some in enumerate(asked["leaves"]):
            for x in some:
                of.setdefault(int(x), []).append(row)
        parts, held = [kept], 0

        def cut() -> list[np.ndarray]:
            whole = [np.concatenate(x) for x in zip(*parts)]
            top = best(*whole, k)
            return [x[top] for x in whole]
        for x, rows in of.items():
            begin, end = np.searchsorted(leaf, [x, x + 1])
            if begin == end:
                continue
            cols = begin + first_equals(v[begin:end], k + 1)  # the query itself may be one of them
            own, rows, block = v[cols], np.array(rows), max(1, PAIRS // len(cols))
            for at in range(0, len(rows), block):
                some = rows[at:at + block]
                r, c = nearest(q[some] @ own.T, k + 1)
                r, c = some[r], cols[c]
                other = ids[r] != vec[c]
                r, c = r[other], c[other]
                parts.append([ids[r], vec[c], exact(q, r, v, c)])
                held += len(r)
                if held > PAIRS:
                    parts, held = [cut()], 0
        kept = cut()
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), kept)))


def usable(v: Column) -> Column:
    """Not null, some component, all finite, not all zero."""
    return F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
                      & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64) if isinstance(column, pd.Series) else np.asarray(column.values.to_numpy(
        zero_copy_only=False), np.float64).reshape(len(column), -1)


def vectors(table: DataFrame, key: str, vec: str) -> tuple[DataFrame, int, float, int]:
    """The vectors that take part (vec_id, v), how many, their largest norm and length."""
    if not isinstance(table.select(key).schema[0].dataType, IntegralType):
        raise TypeError(f"{key} must be an integer")
    some = table.select(F.col(key).cast("long").alias("vec_id"), F.col(vec).cast("array<double>").alias("v")).where("vec_id IS NOT NULL").where(usable(F.col("v")))
    common = some.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not common:
        return some, 0, 0.0, 0
    some = some.where(F.size("v") == common[0]["d"]).groupBy("vec_id").agg(F.min("v").alias("v"))
    some = staged(some)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    n, largest = some.agg(F.count("*"), F.max(norm)).first()
    return some, n, largest, common[0]["d"]


def _sample(some: DataFrame, of: int, n: int, seed: str) -> DataFrame:
    """About n of `of` rows, by hash of the id."""
    return some.where(F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(1 << 30)) < int(min(1.0, n / max(of, 1)) * (1 << 30)))


def index(table: DataFrame, key: str = "vec_id", vec: str = "embedding") -> tuple[DataFrame, Tree, np.ndarray] | None:
    """All vectors with their leaf (vec_id, v, leaf), the tree and the number of vectors in each leaf."""
    some, n, norm, _ = vectors(table, key, vec)
    if not n:
        return None
    drawn = _sample(some, n, SAMPLE, "tree").limit(2 * SAMPLE).select("v").toArrow()["v"]
    if not len(drawn):
        drawn = some.limit(1).select("v").toArrow()["v"]
    tree = fit_tree(matrix(drawn.combine_chunks()), norm)
    held = some.sparkSession.sparkContext.broadcast(tree)

    def placed(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(held.value.assign(matrix(b.column(1))), pa.int32())], ["vec_id", "v", "leaf"])
    leaves = staged(some.mapInArrow(placed, "vec_id long, v array<double>, leaf int"))
    counts = np.zeros(tree.leaves, np.int64)
    for r in leaves.groupBy("leaf").count().collect():  # LEAVES rows at most
        counts[r["leaf"]] = r["count"]
    return leaves, tree, counts


def brute_force(leaves: DataFrame, queries: DataFrame, k: int) -> pd.DataFrame:
    """The true neighbours (query_id, vec_id, leaf) of a bounded set of queries, over all vectors."""
    asked = queries.toArrow()
    ids = asked["vec_id"].to_numpy()
    q = matrix(asked["v"].combine_chunks())
    held = leaves.sparkSession.sparkContext.broadcast((ids, q))

    def found(batches):
        ids, q = held.value
        keep = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int32)]
        for b in batches:
            vec, v, leaf = b.column(0).to_numpy(), matrix(b.column(1)), b.column(2).to_numpy()
            rows, cols = nearest(q @ v.T, k + 1)
            other = ids[rows] != vec[cols]
            rows, cols = rows[other], cols[other]
            keep = [np.concatenate([x, y]) for x, y in zip(keep, (ids[rows], vec[cols], exact(q, rows, v, cols), leaf[cols]))]
            top = best(keep[0], keep[1], keep[2], k)
            keep = [x[top] for x in keep]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in keep], ["query_id", "vec_id", "score", "leaf"])
    top = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    near = leaves.mapInArrow(found, "query_id long, vec_id long, score double, leaf int")
    return near.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k).select("query_id", "vec_id", "leaf").toPandas()


def calibrate(leaves: DataFrame, tree: Tree, counts: np.ndarray, queries: DataFrame, n_queries: int, k: int, target: float = TARGET) -> int:
    """The number of leaves to visit so that `target` of the sample queries' true neighbours are in them."""
    drawn = staged(_sample(queries, n_queries, QUERIES, "calibrate").limit(2 * QUERIES))
    truth = brute_force(leaves, drawn, k)
    if not len(truth):
        return tree.leaves
    asked = drawn.toArrow()
    far = distances(tree.aim(matrix(asked["v"].combine_chunks())), tree.centres)
    order = {i: {leaf: at for at, leaf in enumerate(tree.visits(row, counts, tree.leaves, 0))} for i, row in zip(asked["vec_id"].to_pylist(), far)}
    place = np.array([order[q][leaf] for q, leaf in zip(truth["query_id"], truth["leaf"])])
    visits = 1
    while visits < tree.leaves and (place < visits).mean() < target:
        visits += max(1, visits // 16)
    return min(visits, tree.leaves)


def cells_of(counts: np.ndarray, cell: int = CELL) -> tuple[np.ndarray, np.ndarray]:
    """For each leaf its first cell and in how many cells it is: small leaves share one, large ones have several."""
    first, parts, at, held = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64), 0, 0
    for leaf, n in enumerate(counts):
        if held and held + n > cell:
            at, held = at + 1, 0
        first[leaf], held = at, held + int(n)
        if n > cell:
            parts[leaf] = -(-int(n) // cell)
            at, held = at + int(parts[leaf]), 0
    return first, parts


def search(table: DataFrame, queries: Column, k: int = 20, key: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row of table for which `queries` (over vec_id) holds."""
    schema = "query_id long, vec_id long, score double"
    made = index(table, key, vec)
    if made is None:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    leaves, tree, counts = made
    asked = leaves.where(queries).select("vec_id", "v")
    visits = calibrate(leaves, tree, counts, asked, asked.count(), k)
    first, parts = cells_of(counts)
    held = table.sparkSession.sparkContext.broadcast((tree, counts, first, parts))

    def vector_cells(batches):
        first, parts = held.value[2:]
        for b in batches:
            vec, leaf = b.column(0).to_numpy(), b.column(2).to_numpy()
            # ids are scattered over a large leaf's cells by a multiplicative hash
            part = (vec.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % parts[leaf]
            yield pa.RecordBatch.from_arrays([pa.array(first[leaf] + part), *b.columns], ["cell", "vec_id", "v", "leaf"])

    def query_cells(batches):
        tree, counts, first, parts = held.value
        for b in batches:
            rows = []
            far = distances(tree.aim(matrix(b.column(1))), tree.centres)
            for query, v, row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), far):
                of: dict[int, list[int]] = {}
                for leaf in tree.visits(row, counts, visits, k + 1):
                    for cell in range(first[leaf], first[leaf] + parts[leaf]):
                        of.setdefault(int(cell), []).append(leaf)
                rows += [(cell, query, v, some) for cell, some in of.items()]
            columns = list(zip(*rows)) if rows else [[], [], [], []]
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["cell", "query_id", "v", "leaves"])

    wanted = staged(asked.mapInArrow(query_cells, "cell long, query_id long, v array<double>, leaves array<int>"))
    asks = staged(wanted.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("groups")))
    wanted = wanted.join(asks, "cell").withColumn("part", F.pmod(F.xxhash64("query_id"), "groups").cast("int")).drop("groups")
    there = leaves.mapInArrow(vector_cells, "cell long, vec_id long, v array<double>, leaf int")
    there = there.join(asks, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).drop("groups")
    near = wanted.groupBy("cell", "part").cogroup(there.groupBy("cell", "part")).applyInPandas(lambda asked, there: meet(asked, there, k), schema)
    top = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
