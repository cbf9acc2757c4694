"""SimHash fingerprints and near-duplicate components by pigeonhole blocks.

A fingerprint is cut into ``distance + 2`` blocks. Two fingerprints that differ
in at most ``distance`` bits agree in two blocks at least, so they meet in the
list of that pair of blocks; there each pair's Hamming distance is taken. Equal
fingerprints are one class from the start. A long list is cut further by the bits
that its rows may differ in, and compared in bounded blocks of rows, which send only
links that span their components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pointloom.llm.blocks import BLOCK_ROWS, group_bounds, in_block_pairs, whole_groups
from pointloom.llm.shared import components, map_batches, salted_join, written

#: Shingles hashed at once: bounds memory on a long text.
STEP = 1 << 16
SEED = 42
#: Rows of a group that is compared step by step; larger ones are compared as a matrix.
SMALL = 64


def fingerprint(text: str | None, words: int = 4) -> int:
    """The 64-bit SimHash of a text's word shingles; 0 where it has no words."""
    import xxhash

    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    starts, at = [], 0
    for t in tokens:
        starts.append(at)
        at += len(t) + 1
    n = len(tokens)
    if n <= words:
        spans = [(0, len(joined))]
    else:
        ends = starts[words:] + [len(joined) + 1]
        spans = list(zip(starts[: n - words + 1], [e - 1 for e in ends]))
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for k in range(0, len(spans), STEP):
        h = np.array([digest(joined[a:b], SEED) for a, b in spans[k : k + STEP]], dtype=np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(spans)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, fp, and the columns ``keep``): fp is the fingerprint as a signed long; one scan, no shuffle."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            fps = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64()), *batch.columns[2:]], names=[id_col, "fp", *keep])

        return step

    schema = StructType([docs.schema[id_col], StructField("fp", LongType()), *[docs.schema[c] for c in keep]])
    return map_batches(docs.select(id_col, text_col, *keep), make, schema)


def spanning(near: np.ndarray) -> np.ndarray:
    """For a symmetric bool matrix with a true diagonal: the smallest index of each row's component."""
    label = np.arange(len(near))
    while True:
        low = np.where(near, label[None, :], len(near)).min(axis=1)
        low = np.minimum(low, low[low])
        if (low == label).all():
            return label
        label = low


def links_in(fp: np.ndarray, keys: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (a, b) among the rows of each group; ``keys`` (rows x columns) are sorted."""
    u = fp.view(np.uint64)
    start, size = group_bounds(keys)
    ends = np.repeat(start + size, size)
    left, right = [], []
    for b, n in zip(start[size > SMALL].tolist(), size[size > SMALL].tolist()):
        part = u[b : b + n]
        label = spanning(np.bitwise_count(part[:, None] ^ part[None, :]) <= distance)
        own = label != np.arange(n)
        left.append(fp[b : b + n][own])
        right.append(fp[b : b + n][label[own]])
    at, step = np.flatnonzero(np.repeat(size <= SMALL, size)), 1
    while len(at := at[at + step < ends[at]]):
        near = np.bitwise_count(u[at] ^ u[at + step]) <= distance
        left.append(fp[at[near] + step])
        right.append(fp[at[near]])
        step += 1
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    differ = a != b
    return a[differ], b[differ]


#: Columns that name a group of rows to compare.
GROUP = ["list", "key", "first", "second"]


def group_links(distance: int):
    """Links of a partition that is sorted by GROUP, whose groups are two blocks at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, batch in whole_groups(batches, len(GROUP)):
            a, b = links_in(np.array(batch.column(len(GROUP)).to_numpy(zero_copy_only=False)), keys, distance)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def block_lists(distance: int, blocks: int, agree: int) -> list[tuple[int, int]]:
    """Masks over 64 bits, one for each choice of ``agree`` blocks."""
    edges = np.linspace(0, 64, blocks + 1).round().astype(int)
    masks = [((1 << int(b)) - 1) & ~((1 << int(a)) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(masks, agree)]


def parts_of(mask: int, n: int) -> list[int]:
    """``n`` masks that share the bits of ``mask`` among them in turn, so that each has some of any stretch in which rows differ."""
    bits = [k for k in range(64) if mask >> k & 1]
    return [sum(1 << k for k in bits[part::n]) for part in range(n)]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def near_links(fps: DataFrame, distance: int = 4, extra: int = 2) -> DataFrame:
    """(a, b) links that span the components of distinct fingerprints ``fp``.

    A list of more than a block's rows is listed again by parts: its other bits are cut
    into ``distance + 1`` parts, of which close pairs share one. What is still longer is
    compared in pairs of blocks.
    """
    masks = block_lists(distance, distance + extra, extra)
    key = lambda m: F.col("fp").bitwiseAND(F.lit(signed(m)))
    listed = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(k).alias("list"), key(m).alias("key")) for k, m in enumerate(masks)])).alias("k")).select("fp", "k.list", "k.key")
    sizes = listed.groupBy("list", "key").agg(F.count("*").alias("n")).where("n > 1")
    sized = listed.join(sizes, ["list", "key"])
    zero = F.lit(0)
    short = sized.where(F.col("n") <= BLOCK_ROWS).select("fp", "list", "key", zero.alias("first"), zero.alias("second"))
    parts = F.array(*[F.array(*[F.lit(signed(m | part)) for part in parts_of(m ^ (1 << 64) - 1, distance + 1)]) for m in masks])
    again = sized.where(F.col("n") > BLOCK_ROWS).select("fp", "list", F.posexplode(F.get(parts, F.col("list"))).alias("part", "mask"))
    again = again.select("fp", (F.col("list") + len(masks) * (F.col("part") + 1)).alias("list"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    dealt = short.unionByName(in_block_pairs(again, ["list", "key"], ["fp"]).select("fp", *GROUP)).select(*GROUP, "fp")
    return dealt.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInArrow(group_links(distance), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, distance: int = 4, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, fingerprint, component_id, and the columns ``keep``) of each row.

    component_id is the smallest id reachable over links of at most ``distance``
    differing bits. Null and empty texts and those of white space have fingerprint
    zero and link like others. Repeated rows give a result each; rows with a null
    id get a component of null where they link with no other. An empty table
    gives no rows; other columns are not read.
    """
    prints = written(fingerprints(docs, id_col, text_col, words, keep), "prints")
    classes = written(prints.groupBy("fp").agg(F.min(id_col).alias("low")), "classes")
    links = near_links(classes.select("fp"), distance)
    roots = components(links, "a", "b", "fp", "root")
    member = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = member.groupBy("root").agg(F.min("low").alias("component_id"))
    named = written(salted_join(member, lowest, "root", "fp").select("fp", "component_id"), "classes")
    return prints.join(named, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", *keep
    )
