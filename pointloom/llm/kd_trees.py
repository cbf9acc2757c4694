"""Exact top-k inner products by KD-trees of shards.

A bounded sample is cut at medians into cells, and every cell is dealt to shards of
bounded size, so that shards are compact but no group of equal rows fills one. A
shard's rows become a KD-tree: median splits along the widest side, with the tight
box of each node. A query opens nodes best first, by the most that its product with
a point of the box can be, and stops where that can't beat its k-th best. The k-th
best comes from the query's own shard and goes along to the others; shards whose
whole box can't beat it are not visited.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointloom.llm.blocks import group_bounds, whole_groups
from pointloom.llm.shared import map_batches, written

#: Rows to cut cells by (each of CELL rows of the sample at least), rows of a shard and of a leaf.
SAMPLE, CELL, SHARD, LEAF = 16384, 16, 8192, 256
#: Queries that one task takes through a shard, and queries and boxes of shards that one task compares.
ASKED, BOXES = 2048, 4096
PLACE = ["size", "cell", "shard"]
LONG = (1 << 63) - 1


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x, size): floor(64 c) of each component of vectors that are there and hold nothing null, non-finite or beyond 2^56."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(1 << 56)))
    held = vectors.select(F.col(id_col).cast("bigint").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.coalesce(fine, F.lit(False)))
    return held.select("id", F.transform("v", lambda c: F.floor(c * 64).cast("bigint")).alias("x"), F.size("v").alias("size"))


def matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.array(column.flatten().to_numpy(zero_copy_only=False), np.int64).reshape(len(column), dims)


# ---- trees --------------------------------------------------------------------------


def widest(x: np.ndarray) -> int:
    return int((x.max(axis=0).astype(float) - x.min(axis=0)).argmax())


class Cells:
    """Cells of space: a sample cut ``depth`` times at the median of its widest side."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth, self.side, self.cut = depth, np.zeros(1 << depth, np.int64), np.zeros(1 << depth, np.int64)
        held = {1: sample}
        for node in range(1, 1 << depth):
            x = held.pop(node)
            self.side[node] = d = widest(x)
            self.cut[node] = np.sort(x[:, d])[(len(x) - 1) // 2]
            order = np.argsort(x[:, d], kind="stable")
            held[2 * node], held[2 * node + 1] = x[order[: len(x) // 2]], x[order[len(x) // 2 :]]

    def of(self, x: np.ndarray) -> np.ndarray:
        node = np.ones(len(x), np.int64)
        for _ in range(self.depth):
            node = 2 * node + (x[np.arange(len(x)), self.side[node]] > self.cut[node])
        return node - (1 << self.depth)


def leaves(x: np.ndarray, most: int = LEAF) -> np.ndarray:
    """The leaf of each row: halves by the median of the widest side, as often as leaves of at most ``most`` rows need."""
    leaf, parts = np.zeros(len(x), np.int64), [np.arange(len(x))]
    while x.shape[1] and max(map(len, parts)) > most:
        cut = []
        for rows in parts:
            order = rows[np.argsort(x[rows, widest(x[rows])], kind="stable")]
            cut += [order[: len(order) // 2], order[len(order) // 2 :]]
        parts = cut
    for k, rows in enumerate(parts):
        leaf[rows] = k
    return leaf


class Tree:
    """A shard's rows in the order of their leaves, with tight boxes and least ids of all nodes (1 is the root, 2n and 2n + 1 are n's halves)."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, leaf: np.ndarray):
        order = np.lexsort((ids, leaf))
        self.x, self.ids, self.count = x[order], ids[order], int(leaf.max()) + 1
        self.start = np.append(np.searchsorted(leaf[order], np.arange(self.count)), len(x))
        low, high, least = [np.minimum.reduceat(self.x, self.start[:-1])], [np.maximum.reduceat(self.x, self.start[:-1])], [np.minimum.reduceat(self.ids, self.start[:-1])]
        while len(least[0]) > 1:
            low.insert(0, np.minimum(low[0][::2], low[0][1::2]))
            high.insert(0, np.maximum(high[0][::2], high[0][1::2]))
            least.insert(0, np.minimum(least[0][::2], least[0][1::2]))
        self.low, self.high, self.least = (np.concatenate([b[0][:1], *b]) for b in (low, high, least))

    def search(self, queries: np.ndarray, own: np.ndarray, bounds: list[tuple[int, int]], k: int) -> Iterator[list[tuple[int, int]]]:
        """For each query its up to ``k`` best (score, -id) here that beat its bound, any order."""
        x, q = exact(self.x, queries)
        low, high = (exact(b, queries)[0] for b in (self.low, self.high))
        most = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
        least = self.least.tolist()
        for at in range(len(q)):
            best: list[tuple[int, int]] = []
            limit, reach, me = bounds[at], most[at].tolist(), own[at]
            heap = [(-reach[1], least[1], 1)]
            while heap:
                bound, first, node = heapq.heappop(heap)
                if (-bound, -first) <= limit:
                    if -bound < limit[0]:
                        break
                    continue
                if node < self.count:
                    for n in (2 * node, 2 * node + 1):
                        heapq.heappush(heap, (-reach[n], least[n], n))
                    continue
                rows = slice(self.start[node - self.count], self.start[node - self.count + 1])
                score, ids = x[rows] @ q[at], self.ids[rows]
                hit = np.flatnonzero((score >= limit[0]) & (ids != me))
                if len(hit) > 2 * k:  # only the best can stay
                    hit = hit[score[hit] >= np.partition(score[hit], len(hit) - k)[len(hit) - k]]
                for item in zip(score[hit].tolist(), (-ids[hit]).tolist()):
                    if item > limit and item not in best:
                        heapq.heappush(best, item)
                        if len(best) > k:
                            heapq.heappop(best)
                        if len(best) == k:
                            limit = max(limit, best[0])
            yield best


def exact(x: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles where all products' sums are exact in these, else as Python's integers."""
    far = lambda a: int(np.abs(a).max(initial=0))
    kind = np.float64 if far(x) * far(q) * max(1, x.shape[1]) < 1 << 53 else object
    return x.astype(kind), q.astype(kind)


# ---- on the cluster -------------------------------------------------------------------


def placed(rows: DataFrame, cells: dict[int, Cells]) -> DataFrame:
    """``rows`` with their cell."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes = batch.column(2).to_numpy()
            cell = np.zeros(batch.num_rows, np.int32)
            for d in np.unique(sizes).tolist():
                if d in cells:
                    at = np.flatnonzero(sizes == d)
                    cell[at] = cells[d].of(matrix(batch.column(1).take(pa.array(at)), d))
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=["id", "x", "size", "cell"])

        return step

    return map_batches(rows, make, "id bigint, x array<bigint>, size int, cell int")


def planted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of whole shards with their leaf."""
    for keys, batch in whole_groups(batches, 3):
        leaf = np.zeros(len(keys), np.int32)
        for begin, size in zip(*(b.tolist() for b in group_bounds(keys))):
            leaf[begin : begin + size] = leaves(matrix(batch.column(4).slice(begin, size), int(keys[begin, 0])))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=[*PLACE, "id", "x", "leaf"])


def boxed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Boxes of the rows of each shard that are next to each other in a batch."""
    for batch in batches:
        keys = np.column_stack([batch.column(c).to_numpy() for c in range(3)])
        ids, rows = batch.column(3).to_numpy(), []
        for begin, size in zip(*(b.tolist() for b in group_bounds(keys))) if len(keys) else ():
            x = matrix(batch.column(4).slice(begin, size), int(keys[begin, 0]))
            rows.append((*keys[begin].tolist(), int(ids[begin : begin + size].min()), x.min(axis=0), x.max(axis=0)))
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)], names=[*PLACE, "least", "low", "high"])


def visited(k: int):
    """Cogrouped rows of a shard and queries: (query, vec, score) of the candidates that beat the query's bound."""

    def run(key: tuple, rows: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if rows.num_rows and asked.num_rows:
            dims = key[0].as_py()
            tree = Tree(matrix(rows.column("x"), dims), rows.column("id").to_numpy(), rows.column("leaf").to_numpy())
            own = asked.column("id").to_numpy()
            bounds = [(-LONG - 1, -LONG - 1) if s is None else (s, -v) for s, v in zip(asked.column("kth").to_pylist(), asked.column("kth_id").to_pylist())]
            for q, best in zip(own.tolist(), tree.search(matrix(asked.column("x"), dims), own, bounds, k)):
                out += [(q, -v, max(-LONG, min(LONG, int(s)))) for s, v in best]
        return pa.table({n: pa.array([r[i] for r in out], pa.int64()) for i, n in enumerate(("query", "vec", "score"))})

    return run


def visits(trees: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Every row of ``asked`` (its place names the shard) through the tree of its shard, in parts of about ``ASKED`` queries."""
    parts = asked.groupBy(*PLACE).agg(F.ceil(F.count("*") / ASKED).cast("int").alias("parts"))
    left = trees.join(parts, PLACE).withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).select(*PLACE, "part", "id", "x", "leaf")
    right = asked.join(parts, PLACE).select(*PLACE, F.pmod(F.xxhash64("id"), "parts").cast("int").alias("part"), "id", "x", "kth", "kth_id")
    keys = [*PLACE, "part"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(visited(k), "query bigint, vec bigint, score bigint")


def beatable(key: tuple, boxes: pa.Table, asked: pa.Table) -> pa.Table:
    """Cogrouped boxes of shards and queries: the shards but its own that a query's bound leaves to visit."""
    names = [*PLACE, "id", "x", "kth", "kth_id"]
    if not boxes.num_rows or not asked.num_rows:
        return pa.table({n: asked.column(n).slice(0, 0) for n in names})
    dims = key[0].as_py()
    low, high, least = matrix(boxes.column("low"), dims), matrix(boxes.column("high"), dims), boxes.column("least").to_numpy()
    place = np.column_stack([boxes.column(n).to_numpy() for n in ("cell", "shard")])
    queries, home = matrix(asked.column("x"), dims), np.column_stack([asked.column(n).to_numpy() for n in ("cell", "shard")])
    q = exact(np.concatenate([low, high]), queries)[1]
    most = np.maximum(q, 0) @ high.astype(q.dtype).T + np.minimum(q, 0) @ low.astype(q.dtype).T
    kth = np.array([-LONG - 1 if s is None else s for s in asked.column("kth").to_pylist()], q.dtype)[:, None]
    kth_id = np.array([LONG if v is None else v for v in asked.column("kth_id").to_pylist()], np.int64)[:, None]
    go = (most > kth) | ((most == kth) & (least[None, :] < kth_id))
    go &= (home[:, None, :] != place[None, :, :]).any(axis=2)
    at, to = np.nonzero(go.astype(bool))
    out = {"size": pa.array(np.full(len(at), dims, np.int32)), "cell": pa.array(place[to, 0], pa.int32()), "shard": pa.array(place[to, 1], pa.int32())}
    return pa.table(out | {n: asked.column(n).take(pa.array(at)) for n in names[3:]})


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", shard: int = SHARD) -> DataFrame:
    """(query_id, rank, id, score): each query's ``k`` largest inner products of floor(64 c), ties to the smaller id.

    All rows of the query's id are its own and no candidates; rows of another length have
    no product with it. Vectors that are null, hold null or non-finite components or
    some beyond 2^56 take no part, nor do null ids. Rows repeated with one id and score
    are one candidate, queries of one id one query. A score beyond a long is the nearest
    long. Empty tables give no rows; other columns are not read.
    """
    rows, asked = usable(vectors, id_col, vector_col), usable(queries, id_col, vector_col)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("size", "x").toArrow()
    n = rows.count()
    cells = {}
    for d in set(sample.column("size").to_pylist()) - {0}:
        x = matrix(sample.filter(pa.compute.equal(sample.column("size"), d)).column("x"), d)
        depth = np.log2(max(1, min(len(x) / CELL, n * len(x) / sample.num_rows / shard)))
        cells[d] = Cells(x, int(np.ceil(depth - 1e-9)) if len(x) > CELL else 0)
    held = written(placed(rows, cells), "cells")
    shards = held.groupBy("size", "cell").agg(F.ceil(F.count("*") / shard).cast("int").alias("shards"))
    dealt: Column = F.pmod(F.xxhash64("id"), F.col("shards")).cast("int").alias("shard")
    put = lambda df: df.join(shards, ["size", "cell"], "left").select("size", "cell", F.coalesce(dealt, F.lit(0)).alias("shard"), "id", "x")
    ordered = put(held).repartition(*PLACE).sortWithinPartitions(*PLACE, "id")
    trees = written(ordered.mapInArrow(planted, "size int, cell int, shard int, id bigint, x array<bigint>, leaf int"), "trees")
    none = F.lit(None).cast("bigint")
    homes = put(placed(asked, cells)).distinct().select("*", none.alias("kth"), none.alias("kth_id"))
    first = written(visits(trees, homes, k), "first")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec")
    ranked = lambda df: df.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    kth = ranked(first).where(F.col("rank") == k).select(F.col("query").alias("id"), F.col("score").alias("kth"), F.col("vec").alias("kth_id"))
    bounded = homes.drop("kth", "kth_id").join(kth, "id", "left")
    pieces = trees.select(*PLACE, "id", "x").mapInArrow(boxed, "size int, cell int, shard int, least bigint, low array<bigint>, high array<bigint>")
    dims = F.posexplode_outer(F.arrays_zip("low", "high")).alias("dim", "c")
    sides = pieces.select(*PLACE, "least", dims).groupBy(*PLACE, "dim").agg(F.min("c.low").alias("low"), F.max("c.high").alias("high"), F.min("least").alias("least"))
    sorted_ = F.array_sort(F.collect_list(F.when(F.col("dim").isNotNull(), F.struct("dim", "low", "high"))))
    part = lambda name: F.transform(sorted_, lambda s: s[name])
    boxes = sides.groupBy(*PLACE).agg(part("low").alias("low"), part("high").alias("high"), F.min("least").alias("least"))
    blocks = lambda df, name, most: df.groupBy("size").agg(F.ceil(F.count("*") / most).cast("int").alias(name))
    grid = blocks(trees.select(*PLACE).distinct(), "chunks", BOXES).join(blocks(homes, "parts", ASKED), "size")
    mine = lambda n, *by: F.pmod(F.xxhash64(*by), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = boxes.join(grid, "size").select("*", mine("chunks", "cell", "shard").alias("chunk"), every("parts").alias("part")).drop("chunks", "parts")
    right = bounded.join(grid, "size").select("*", mine("parts", "id").alias("part"), every("chunks").alias("chunk")).drop("chunks", "parts")
    keys = ["size", "chunk", "part"]
    schema = "size int, cell int, shard int, id bigint, x array<bigint>, kth bigint, kth_id bigint"
    rest = written(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(beatable, schema), "visits")
    found = ranked(first.union(visits(trees, rest, k)))
    return found.select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("vec").alias(id_col), "score")
