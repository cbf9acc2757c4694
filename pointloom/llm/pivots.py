"""Embedding near-duplicates by a pivot-permutation index.

Reference points (pivots) are chosen far from each other out of a bounded sample;
their number grows with the rows. A vector is described by its nearest pivots in
order. It is listed, by id alone, under each triple of them within its label, so
two vectors meet exactly if they share three pivots. A pair belongs to the list of its
three lowest common pivots. Only rows with such a partner are joined to their
components, and the cosine of such a pair is verified once, in double precision. Equal vectors are one class from
the start; a list of any size is compared in bounded blocks, which send link counts
and spanning links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointloom.llm.blocks import group_bounds, in_block_pairs, whole_groups
from pointloom.llm.shared import components, map_batches, written

#: Rows to choose pivots from, and the most pivots (both bound what the driver and the tasks hold); pivots are about the root of the rows.
SAMPLE, PIVOTS, LEAST_PIVOTS = 8192, 1024, 32
#: Pivots of a description, and those that two vectors must share.
NEAREST, SHARED = 6, 3
#: No pivot lies nearer to another than this cosine: inside a tight group the order of several pivots would be chance.
APART = 0.9


def class_key(label: str, vector: str):
    """Equal for equal labels and vectors only."""
    parts = F.transform(F.col(vector).cast("array<double>"), lambda x: x.cast("string"))
    return F.sha2(F.concat_ws("|", F.col(label).cast("string"), F.array_join(parts, ",")), 256)


def chosen_pivots(sample: np.ndarray, wanted: int, apart: float = APART) -> np.ndarray:
    """Up to ``wanted`` rows (unit vectors), each the farthest from those before, as long as it has no cosine over ``apart`` to one."""
    unit = sample / np.sqrt((sample * sample).sum(axis=1))[:, None]
    near, out = np.full(len(unit), -2.0), []
    at = 0
    while len(out) < wanted:
        out.append(at)
        near = np.maximum(near, unit @ unit[at])
        at = int(near.argmin())
        if near[at] > apart:
            break
    return unit[out]


def unit_rows(vectors) -> np.ndarray:
    v = np.stack(vectors).astype(np.float64)
    return v / np.sqrt((v * v).sum(axis=1))[:, None]


#: Columns that name a list and the two of its blocks that are compared; rows of a group up to SMALL are compared step by step.
LIST, SMALL = ["sh", "p", "q", "r"], 64
GROUP = [*LIST, "first", "second"]


def pairs_of(keys: np.ndarray, block: np.ndarray, near: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows (i, j) that their list answers for: of their common pivots the list's three are the lowest."""
    start, size = group_bounds(keys)
    own, third = keys[:, 4] == keys[:, 5], keys[:, 3]
    ends = np.repeat(start + size, size)
    at, step = np.flatnonzero(np.repeat(size <= SMALL, size)), 1
    while len(at := at[at + step < ends[at]]):
        i = at[own[at] | (block[at] != block[at + step])]
        for k in range(0, len(i), 1 << 16):
            a = i[k : k + (1 << 16)]
            common = (near[a][:, :, None] == near[a + step][:, None, :]).any(axis=2)
            a = a[(common & (near[a] < third[a, None])).sum(axis=1) == SHARED - 1]
            yield a, a + step
        step += 1
    for b, n in zip(start[size > SMALL].tolist(), size[size > SMALL].tolist()):
        part = block[b : b + n]
        left, right = np.flatnonzero(part == keys[b, 4]) + b, np.flatnonzero(part == keys[b, 5]) + b
        lower = [np.where((x < keys[b, 3]) & (x != keys[b, 1]) & (x != keys[b, 2]), x, -1) for x in (near[left], near[right])]
        words = np.intersect1d(*lower)
        words = words[words >= 0]
        mine = np.ones((len(left), len(right)), bool)
        if len(words):
            has = [(x[:, :, None] == words).any(axis=1).astype(np.float32) for x in lower]
            mine = has[0] @ has[1].T == 0
        if own[b]:
            mine &= left[:, None] < right[None, :]
        i, j = np.nonzero(mine)
        yield left[i], right[j]


def cosines(unit: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    if len(i) > 1 << 16:  # a large group: one matrix product is less work than a row for each pair
        rows, a = np.unique(i, return_inverse=True)
        cols, b = np.unique(j, return_inverse=True)
        if len(rows) * len(cols) <= 4 * len(i):
            return (unit[rows] @ unit[cols].T)[a, b]
    return np.concatenate([np.zeros(0)] + [(unit[i[k : k + 8192]] * unit[j[k : k + 8192]]).sum(axis=1) for k in range(0, len(i), 8192)])


def near_of(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten().to_numpy(zero_copy_only=False)).reshape(len(column), -1)


def with_partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each list that share its pivots as their lowest with another row there; the others need no vector."""
    for keys, batch in whole_groups(batches, len(GROUP)):
        meets = np.zeros(len(keys), bool)
        for i, j in pairs_of(keys, batch.column(6).to_numpy(), near_of(batch.column(8))):
            meets[i] = meets[j] = True
        yield batch.filter(pa.array(meets))


def compared(least: float):
    """Link counts and spanning links of each pair of blocks of a list.

    Rows: (id, n, link_to, tried): n other vectors linked here, link_to the smallest id of the row's component here; one row a batch has the cosines taken.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, batch in whole_groups(batches, len(GROUP)):
            ids, block, rows, other = (np.array(batch.column(k).to_numpy()) for k in (6, 7, 10, 12))
            sizes = np.diff(batch.column(11).offsets.to_numpy())
            unit = np.zeros((len(keys), sizes.max()))  # shorter vectors end in zeros: that changes no cosine of two of one length
            unit[np.arange(sizes.max()) < sizes[:, None]] = batch.column(11).flatten().to_numpy(zero_copy_only=False)
            unit /= np.sqrt((unit * unit).sum(axis=1))[:, None]
            n, label, tried, links = np.zeros(len(keys), np.int64), np.arange(len(keys)), 0, []
            for i, j in pairs_of(keys, block, near_of(batch.column(9))):
                same = other[i] == other[j]
                i, j = i[same], j[same]
                tried += len(i)
                c = cosines(unit, i, j)
                close = np.flatnonzero(c >= least - 1e-9)
                i, j, c = i[close], j[close], c[close]
                edge = np.flatnonzero(c < least + 1e-9)  # too close to call by a matrix product
                keep = np.ones(len(i), bool)
                for k in range(0, len(edge), 8192):
                    e = edge[k : k + 8192]
                    keep[e] = (unit[i[e]] * unit[j[e]]).sum(axis=1) >= least
                i, j = i[keep], j[keep]
                n += np.bincount(i, rows[j], len(n)).astype(np.int64) + np.bincount(j, rows[i], len(n)).astype(np.int64)
                links.append((i, j))
            while links:
                low = label.copy()
                for i, j in links:
                    np.minimum.at(low, i, label[j])
                    np.minimum.at(low, j, label[i])
                low = low[low]
                if (low == label).all():
                    break
                label = low
            own = n > 0
            own[0] = True
            done = np.zeros(int(own.sum()), np.int64)
            done[0] = tried
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[own], n[own], ids[label[own]], done)], names=["id", "n", "link_to", "tried"])

    return run


def compared_lists(vectors: DataFrame, label_col: str, least: float, id_col: str, vector_col: str, pivots: int, nearest: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with their class key, the classes of equal rows, and what their lists found: (id, n, link_to, tried)."""
    kind = vectors.schema[vector_col].dataType.elementType.simpleString()
    kind = kind if kind in ("float", "double") else "double"
    v = F.col(vector_col).cast(f"array<{kind}>")
    fine = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("v"), F.col(label_col).cast("string").alias("label")).withColumn(
        "fine", fine & F.col("label").isNotNull() & F.col("id").isNotNull()
    )
    rows = rows.withColumn("key", F.when(F.col("fine"), class_key("label", "v")))
    space = F.concat_ws("|", F.size("v").cast("string"), "label")
    grouped = rows.where("fine").groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("rows"), F.first("v").alias("v"), F.first("label").alias("label"))
    node = F.conv(F.substring("key", 1, 15), 16, 10).cast("bigint").alias("node")  # 60 bits of the key name a class in the lists
    classes = written(grouped.select("key", node, "id", "rows", "v", space.alias("space")), "vectors")
    sample = classes.orderBy(F.xxhash64("id"), "key").limit(SAMPLE).select("v").toArrow().column("v").to_pylist()
    wanted = int(min(pivots, max(LEAST_PIVOTS, 2 ** round(np.log2(max(1, classes.count())) / 2))))
    points = {n: chosen_pivots(np.array([x for x in sample if len(x) == n]), wanted) for n in {len(x) for x in sample}}

    def describe():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            lists, found = batch.column(1), np.empty((batch.num_rows, nearest), np.int16)
            sizes = np.diff(lists.offsets.to_numpy())
            for n in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == n)
                p = points.get(n, np.zeros((0, n)))
                x = np.array(lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)).reshape(-1, n)
                order = np.argsort(-(unit_rows(x) @ p.T), axis=1, kind="stable")[:, :nearest]
                # too few pivots: numbers that all vectors of this length share
                found[at] = np.hstack([order, np.broadcast_to(len(p) + np.arange(nearest - order.shape[1]), (len(at), nearest - order.shape[1]))])
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(found), pa.list_(pa.int16())), batch.column(2)], names=["node", "near", "sh"])

        return step

    described = written(map_batches(classes.select("node", "v", F.xxhash64("space").alias("sh")), describe, "node bigint, near array<smallint>, sh bigint"), "descriptions")
    low = F.array_sort("near")
    triples = F.explode(F.array(*[F.struct(*[F.get(low, F.lit(k)).alias(c) for c, k in zip("pqr", three)]) for three in combinations(range(nearest), SHARED)]))
    listed = described.select("node", "sh", "near", triples.alias("t")).select("node", "sh", "near", "t.p", "t.q", "t.r")
    slim = in_block_pairs(listed, LIST, ["node"]).select(*GROUP, "block", "node", "near")
    slim = slim.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInArrow(with_partners, slim.schema)
    held = classes.select("node", "id", "rows", "v", F.xxhash64(F.lit("|"), "space").alias("other"))
    met = slim.join(held, "node").select(*GROUP, "id", "block", "node", "near", "rows", "v", "other")
    found = met.repartition(*GROUP).sortWithinPartitions(*GROUP, "id").mapInArrow(compared(least), "id bigint, n bigint, link_to bigint, tried bigint")
    return rows, classes, found


def near_duplicates(vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", pivots: int = PIVOTS, nearest: int = NEAREST) -> DataFrame:
    """(id, n_links, component_id, kept) of each row.

    Rows link if their labels are equal and not null and their cosine is at least
    ``least``. Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing, nor do vectors of different lengths. Rows
    repeated with one id are other vectors to each other. A null id is a row of
    its own whose component is null. An empty table gives no rows; other columns
    are not read.
    """
    rows, classes, found = compared_lists(vectors, label_col, least, id_col, vector_col, pivots, nearest)
    found = written(found.where("n > 0"), "links")
    roots = components(found.where("id <> link_to"), "id", "link_to", "id", "root")
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    member = classes.select("key", "id", "rows").join(counts, "id", "left").join(roots, "id", "left")
    named = member.select(
        "key", (F.coalesce("n", F.lit(0)) + F.col("rows") - 1).alias("n_links"), F.coalesce("root", "id").alias("component_id")
    )
    out = rows.select("id", "key").join(named, "key", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")
    )
