"""Comparing the rows of a bucket with each other in bounded blocks.

A bucket of n rows is dealt into ceil(n / rows) blocks by a hash of the row; each
pair of blocks is one group, so a bucket of any size is compared in full by many
tasks that hold two blocks each. Rows are copied once for each block of their
bucket; pairs are never rows of a table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 1024


def in_block_pairs(df: DataFrame, bucket: list[str], row_hash: list[str], rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with columns ``first`` and ``second`` (blocks, first <= second) and ``block`` (its own).

    Buckets of a single row are left out: they hold no pair. Bucket sizes are
    counted with a combine before the shuffle and joined back by the bucket,
    where adaptive execution may split a hot one.
    """
    sizes = df.groupBy(*bucket).agg(F.count("*").alias("bucket_rows")).where("bucket_rows > 1")
    cut = df.join(sizes, bucket).withColumn("blocks", F.ceil(F.col("bucket_rows") / rows).cast("int"))
    cut = cut.withColumn("block", F.pmod(F.xxhash64(*row_hash), F.col("blocks")).cast("int"))
    other = F.explode(F.expr("sequence(0, blocks - 1)"))
    return (
        cut.select("*", other.alias("other"))
        .withColumn("first", F.least("block", "other"))
        .withColumn("second", F.greatest("block", "other"))
        .drop("other", "blocks", "bucket_rows")
    )


def whole_groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    """Batches that hold whole groups only, with their keys (rows x ``n_keys``): the partition is sorted by its first ``n_keys`` columns, all integers.

    The last group of a batch waits for the next one, so a group's size bounds what is kept.
    """
    kept: list[pa.RecordBatch] = []
    for batch in chain(batches, [None]):
        if batch is not None and batch.num_rows:
            kept.append(batch)
        if not kept or (batch is not None and not batch.num_rows):
            continue
        whole = pa.concat_batches(kept)
        keys = np.column_stack([whole.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(n_keys)])
        done = len(keys) if batch is None else int(np.flatnonzero((keys != keys[-1]).any(axis=1)).max(initial=-1)) + 1
        if done:
            yield keys[:done], whole.slice(0, done)
        kept = [whole.slice(done)] if done < len(keys) else []


def group_bounds(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of each group of sorted ``keys``."""
    start = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
    return start, np.diff(np.append(start, len(keys)))
