"""Nearest neighbours by a forest of random-projection trees.

Each tree splits on orthonormal random directions, one a level, at medians of a
bounded sample, down to the depth of least cost on that sample. A query searches all trees through one
priority queue: the entry with the smallest possible squared distance, over all trees,
is opened next, until that distance passes the query's bound. The bound comes from the
sample: the distance to the k-th nearest sampled row of the query's own leaves, which no
k-th nearest row is beyond, times a factor. The factor is measured on sampled queries, so
that the leaves opened hold the wanted share of true neighbours, however clustered the
vectors are. Rows and queries then meet by leaf, where exact distances in double precision
give each query's best of the leaf; a row is compared in the first opened leaf that holds
it only. The best of all its leaves are a query's neighbours.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pointloom.llm.shared import map_batches

#: Trees, the deepest tree, rows to fit on (with these the broadcast forest is below 1 MB, the sample about 16 MB).
TREES, DEPTH, SAMPLE = 6, 11, 32_768
#: What it costs to open a leaf, in distances; the depth of least cost on the sample is taken.
OPEN = 256
#: Sampled rows of a leaf at least, rows and queries that meet in a task's block, sampled queries that set the bound, share of true neighbours in opened leaves.
LEAF, BLOCK, TRIALS, TARGET = 16, 4096, 256, 0.96


@dataclass
class Forest:
    directions: np.ndarray  # trees x dimensions x depth
    cuts: np.ndarray  # trees x nodes, in heap order

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row in each tree."""
        trees, _, depth = self.directions.shape
        out = np.empty((len(x), trees), np.int64)
        for t in range(trees):
            seen, node = x @ self.directions[t], np.zeros(len(x), np.int64)
            for level in range(depth):
                node = 2 * node + 1 + (seen[:, level] >= self.cuts[t, node])
            out[:, t] = node - (2**depth - 1)
        return out

    def cut(self, depth: int) -> Forest:
        """The same trees down to ``depth`` levels."""
        return Forest(self.directions[:, :, :depth], self.cuts[:, : 2**depth - 1])

    def search(self, q: np.ndarray, most: float) -> list[tuple[int, int]]:
        """(tree, leaf) in the order of one queue over all trees, as long as a row there can lie within the squared distance ``most``."""
        trees, _, depth = self.directions.shape
        inner = 2**depth - 1
        seen = np.einsum("d,tdk->tk", q, self.directions).tolist()
        heap = [(0.0, t, 0, 0) for t in range(trees)]
        out = []
        while heap and heap[0][0] <= most:
            bound, t, node, level = heapq.heappop(heap)
            while node < inner:
                gap = seen[t][level] - self.cuts[t, node]
                right = gap >= 0
                if bound + gap * gap <= most:
                    heapq.heappush(heap, (bound + gap * gap, t, 2 * node + 2 - right, level + 1))
                node, level = 2 * node + 1 + right, level + 1
            out.append((t, node - inner))
        return out

    def nearest_possible(self, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """For each row (its leaf in each tree) the smallest squared distance from q at which one of its leaves is opened."""
        trees, _, depth = self.directions.shape
        seen = np.einsum("d,tdk->tk", q, self.directions)
        best = np.full(len(rows), np.inf)
        for t in range(trees):
            bound, node, path = np.zeros(len(rows)), np.zeros(len(rows), np.int64), rows[:, t]
            for level in range(depth):
                gap, right = seen[t, level] - self.cuts[t, node], path >> (depth - 1 - level) & 1
                bound += np.where((gap >= 0) == (right == 1), 0.0, gap * gap)
                node = 2 * node + 1 + right
            best = np.minimum(best, bound)
        return best


@dataclass
class Reach:
    """How far a query looks: sampled rows by leaf, and the factor on the distance to the k-th nearest of them."""

    rows: np.ndarray
    leaves: np.ndarray
    ids: np.ndarray
    k: int
    factor: float = 1.0

    def __post_init__(self):
        self.held = [{} for _ in range(self.leaves.shape[1])]
        for t, by in enumerate(self.held):
            order = np.argsort(self.leaves[:, t], kind="stable")
            own, start = np.unique(self.leaves[order, t], return_index=True)
            by |= dict(zip(own.tolist(), np.split(order, start[1:])))

    def most(self, q: np.ndarray, leaves: np.ndarray, but: int) -> float:
        """The squared distance up to which q's leaves are opened: all of them where there are fewer than k rows."""
        r = self.radius(q, leaves, but)
        return self.factor * r if np.isfinite(r) else np.inf

    def radius(self, q: np.ndarray, leaves: np.ndarray, but: int) -> float:
        """Squared distance to the k-th nearest sampled row, not of id ``but``, in the query's leaves; of all the sample where these hold fewer."""
        found = [self.held[t].get(int(leaf)) for t, leaf in enumerate(leaves)]
        near = np.unique(np.concatenate([np.zeros(0, np.int64), *[f for f in found if f is not None]]))
        near = near[self.ids[near] != but]
        if len(near) < self.k:
            near = np.flatnonzero(self.ids != but)
        if len(near) < self.k:
            return np.inf
        d = ((self.rows[near] - q) ** 2).sum(axis=1)
        return float(np.partition(d, self.k - 1)[self.k - 1])


def tuned(forest: Forest, sample: np.ndarray, ids: np.ndarray, k: int, target: float, rows: int, trials: int = TRIALS) -> tuple[Forest, Reach]:
    """The forest cut at the depth of least cost for ``rows`` rows, with the factor at which ``trials`` sampled queries open leaves that hold ``target`` of their true neighbours in the sample."""
    deepest, leaves = forest.directions.shape[2], forest.leaves(sample)
    asked = np.arange(0, len(sample), max(1, len(sample) // trials))
    some = np.arange(0, len(sample), max(1, len(sample) // 4096))
    true = []
    for q in asked:
        d = ((sample - sample[q]) ** 2).sum(axis=1)
        d[ids == ids[q]] = np.inf
        near = np.argpartition(d, min(k, len(d)) - 1)[:k]
        true.append(near[np.isfinite(d[near])])
    best = None
    for depth in range(1, deepest + 1):
        trees, own = forest.cut(depth), leaves >> deepest - depth
        out = Reach(sample, own, ids, k)
        radius = [out.radius(sample[q], own[q], int(ids[q])) for q in asked]
        need = [trees.nearest_possible(sample[q], own[t]) / max(r, 1e-300) for q, t, r in zip(asked, true, radius) if len(t) and np.isfinite(r)]
        out.factor = float(np.quantile(np.concatenate(need), target)) if need else 1.0
        cost = 0.0
        for q in asked[::4]:
            most = out.most(sample[q], own[q], int(ids[q]))
            cost += rows * (trees.nearest_possible(sample[q], own[some]) <= most).mean() + OPEN * len(trees.search(sample[q], most))
        if best is None or cost < best[0]:
            best = cost, trees, out
    return best[1], best[2]


def fit(sample: np.ndarray, trees: int, depth: int, seed: int = 7) -> Forest:
    rng, dims = np.random.default_rng(seed), sample.shape[1]
    depth = min(depth, dims)
    directions, cuts = np.zeros((trees, dims, depth)), np.zeros((trees, 2**depth - 1))
    for t in range(trees):
        directions[t] = np.linalg.qr(rng.normal(size=(dims, dims)))[0][:, :depth]
        seen, node = sample @ directions[t], np.zeros(len(sample), np.int64)
        for level in range(depth):
            first = 2**level - 1
            for k in range(first, 2 * first + 1):
                own = seen[node == k, level]
                cuts[t, k] = np.median(own) if len(own) else 0.0
            node = 2 * node + 1 + (seen[:, level] >= cuts[t, node])
    return Forest(directions, cuts)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of rows that take part: no null or non-finite component, not zero."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    return vectors.select(F.col(id_col).alias("id"), v.alias("v")).where(fine & F.exists("v", lambda x: x != 0))


def best_of(x: np.ndarray, ids: np.ndarray, q: np.ndarray, asks: np.ndarray, ruled_out: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's ``k`` nearest rows of a block: (query's place, row's place, distance); ``ruled_out`` (queries x rows) take no part."""
    rough = (x * x).sum(axis=1)[None, :] - 2 * (q @ x.T)
    own = (q * q).sum(axis=1)
    slack = 1e-9 * (own + np.abs(rough).max(axis=1, initial=0.0)) + 1e-300
    rough[ruled_out] = np.inf
    at, row, dist = [], [], []
    if len(ids) > k:
        last = np.partition(rough, k - 1, axis=1)[:, k - 1] + slack
        asked, met = np.nonzero(rough <= last[:, None])
    else:
        asked, met = np.nonzero(~ruled_out)
    fine = np.isfinite(rough[asked, met])
    asked, met = asked[fine], met[fine]
    exact = np.sqrt(((x[met] - q[asked]) ** 2).sum(axis=1))
    order = np.lexsort((ids[met], exact, asked))
    asked, met, exact = asked[order], met[order], exact[order]
    start = np.flatnonzero(np.append(True, asked[1:] != asked[:-1])) if len(asked) else np.zeros(0, np.int64)
    for a, b in zip(start.tolist(), [*start[1:].tolist(), len(asked)]):
        m, d = met[a:b], exact[a:b]
        fresh = np.append(True, (ids[m][1:] != ids[m][:-1]) | (d[1:] != d[:-1]))
        if fresh.sum() < k:  # one id may have several vectors at one distance: take all rows, once each id and distance
            m = np.flatnonzero(~ruled_out[asked[a]])
            d = np.sqrt(((x[m] - q[asked[a]]) ** 2).sum(axis=1))
            near = np.lexsort((ids[m], d))
            m, d = m[near], d[near]
            fresh = np.append(True, (ids[m][1:] != ids[m][:-1]) | (d[1:] != d[:-1]))[: len(m)]
        keep = np.flatnonzero(fresh)[:k]
        at.append(np.full(len(keep), asked[a]))
        row.append(m[keep])
        dist.append(d[keep])
    return tuple(np.concatenate(c) if c else np.zeros(0, t) for c, t in ((at, np.int64), (row, np.int64), (dist, np.float64)))


def searched(vectors: DataFrame, queries: DataFrame, k: int, id_col: str, vector_col: str, trees: int, depth: int, target: float) -> DataFrame | None:
    """(query_id, vec, score, tried): the best of every leaf that a query opens; one row a leaf has the distances taken there."""
    rows = usable(vectors, id_col, vector_col).where("id is not null")
    asked = usable(queries, id_col, vector_col).where("id is not null")
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
    if not sample.num_rows:
        return None
    drawn = sample.column("v").combine_chunks()
    sizes = np.diff(drawn.offsets.to_numpy())
    dims = int(pd.Series(sizes).mode()[0])
    fitted = np.stack([np.array(v) for v, n in zip(drawn.to_pylist(), sizes) if n == dims])
    drawn_ids = sample.column("id").to_numpy()[sizes == dims]
    rows, asked = rows.where(F.size("v") == dims), asked.where(F.size("v") == dims)
    forest = fit(fitted, trees, int(max(1, min(depth, np.log2(max(2, len(fitted) / LEAF))))))
    forest, far = tuned(forest, fitted, drawn_ids, k, target, rows.count())
    depth = forest.directions.shape[2]

    def matrix(column: pa.Array) -> np.ndarray:
        return np.array(column.flatten().to_numpy(zero_copy_only=False)).reshape(-1, dims)

    def place():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            leaves = forest.leaves(matrix(batch.column(1)))
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(leaves.astype(np.int32)), pa.list_(pa.int32()))], names=["id", "v", "leaves"])

        return step

    def open_leaves():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found, x = [], matrix(batch.column(1))
            for own, q, leaves in zip(batch.column(0).to_pylist(), x, forest.leaves(x)):
                found.append([t << 16 | int(leaf) for t, leaf in forest.search(q, far.most(q, leaves, own))])
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=["id", "v", "opened"])

        return step

    flat = lambda df: df.select("id", F.col("v").cast("array<double>").alias("v"))
    placed = map_batches(flat(rows).distinct(), place, "id bigint, v array<double>, leaves array<int>")
    opened = map_batches(flat(asked), open_leaves, "id bigint, v array<double>, opened array<int>")
    listed = placed.select("id", "v", "leaves", F.posexplode("leaves").alias("tree", "leaf"))
    seeking = opened.select("id", "v", "opened", F.explode("opened").alias("at")).select("id", "v", "opened", F.shiftright("at", 16).alias("tree"), F.col("at").bitwiseAND(0xFFFF).alias("leaf"))
    # both sides of a leaf are dealt to blocks; trees x 2^depth counts at most, which Spark broadcasts if they are small
    parts = lambda df, name: df.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))
    blocks = parts(listed.select("tree", "leaf"), "rows").join(parts(seeking.select("tree", "leaf"), "asks"), ["tree", "leaf"])
    mine = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = listed.join(blocks, ["tree", "leaf"]).select("tree", "leaf", "id", "v", "leaves", mine("rows").alias("block"), every("asks").alias("part"))
    right = seeking.join(blocks, ["tree", "leaf"]).select("tree", "leaf", "id", "v", "opened", mine("asks").alias("part"), every("rows").alias("block"))

    def best(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64"), "tried": pd.Series(dtype="int64")})
        if a.empty or b.empty:
            return none
        x, ids, leaves, tree = np.stack(a["v"].to_numpy()), a["id"].to_numpy(), np.stack(a["leaves"].to_numpy()), int(a["tree"].iloc[0])
        out = [none]
        for begin in range(0, len(b), 512):
            part = b.iloc[begin : begin + 512]
            q, asks = np.stack(part["v"].to_numpy()), part["id"].to_numpy()
            ruled_out = asks[:, None] == ids[None, :]
            known = np.zeros((len(part), trees << depth), bool)
            spots = [np.asarray(o) for o in part["opened"]]
            known[np.repeat(np.arange(len(part)), [len(o) for o in spots]), np.concatenate([(o >> 16 << depth) + (o & 0xFFFF) for o in spots])] = True
            for t in range(tree):  # compared in the leaf of an earlier tree
                ruled_out |= known[:, (t << depth) + leaves[:, t]]
            at, row, dist = best_of(x, ids, q, asks, ruled_out, k)
            if len(at):
                tried = np.zeros(len(at), np.int64)
                tried[0] = int((~ruled_out).sum())
                out.append(pd.DataFrame({"query_id": asks[at], "vec": ids[row], "score": dist, "tried": tried}))
        return pd.concat(out)

    keys = ("tree", "leaf", "block", "part")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(best, "query_id bigint, vec bigint, score double, tried bigint")


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", trees: int = TREES, depth: int = DEPTH, target: float = TARGET
) -> DataFrame:
    """(query_id, rank, id, score): each query's nearest rows but its own, score the Euclidean distance.

    ``queries`` are rows of ``vectors``. Vectors that are null, empty, zero or
    hold null or non-finite components take no part, nor do those whose length
    isn't that of most sampled vectors. Ties go to the smaller id. Repeated rows
    are candidates once each id and distance; null ids take no part. Empty tables
    give no rows; other columns are not read.
    """
    met = searched(vectors, queries, k, id_col, vector_col, trees, depth, target)
    if met is None:
        return vectors.sparkSession.createDataFrame([], f"query_id bigint, rank int, `{id_col}` bigint, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec")
    return met.select("query_id", "vec", "score").distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", F.col("vec").alias(id_col), "score")
