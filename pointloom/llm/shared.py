"""What several operators need: shared files, Arrow batches, link components."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows and bytes that a step takes at once: bounds a worker's memory on long texts. (Spark's own batches hold 64 MB at most.)
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20


def sliced(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Spark's batches in slices of at most ``rows`` rows and about ``size`` bytes; a single row may be longer."""
    for batch in batches:
        n = batch.num_rows
        step = max(1, min(rows, n, n * size // max(1, batch.nbytes)))
        for at in range(0, n, step):
            yield batch.slice(at, step)


@contextmanager
def without_gc():
    """No cycle collection inside: large tables of plain values would be walked again and again. A reused worker has it back afterwards."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.collect()  # freezing would keep unreachable circles for good
            gc.freeze()  # what the worker keeps for its next task is never walked
            gc.enable()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that the cluster shares (spark.checkpoint.dir).

    Where that is unset a temporary folder serves on one machine; on a cluster this raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_release = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written_at(df: DataFrame, path: str) -> DataFrame:
    """Writes ``df`` and reads it again; what writing it shuffled is deleted when it stands."""
    spark = df.sparkSession
    before = spark.conf.get(_release, "false")
    spark.conf.set(_release, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_release, before)
    return spark.read.schema(df.schema).parquet(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage, survives lost executors."""
    return written_at(df, shared_path(df.sparkSession, name))


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a table of ``written_at`` that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], schema: str | StructType, collect: bool = True) -> DataFrame:
    """``mapInArrow`` with ``make()`` called once a task; ``collect=False`` where it keeps large tables (see ``without_gc``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with nullcontext() if collect else without_gc():
            step = make()
            for batch in sliced(batches):
                out = step(batch)
                if out is not None:
                    yield out

    return df.mapInArrow(run, schema)


def text_bytes(value: str | None) -> bytes:
    """UTF-8 of a text; null is empty."""
    return b"" if value is None else value.encode("utf-8", "surrogatepass")


def salted_join(many: DataFrame, one: DataFrame, key: str, row: str, salts: int = 8) -> DataFrame:
    """``many`` joined with ``one``, which has one row a key: a key's rows are dealt to ``salts`` tasks by a hash of ``row``, and ``one`` is copied for each."""
    dealt = many.withColumn("salt", F.pmod(F.xxhash64(row), F.lit(salts)))
    copied = one.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return dealt.join(copied, [key, "salt"]).drop("salt")


def components(edges: DataFrame, a: str, b: str, node: str = "node", root: str = "root") -> DataFrame:
    """Connected components: (node, root) for every node of ``edges``, root the smallest id reachable.

    Alternating large-star and small-star steps: each is one grouped minimum,
    combined before the shuffle, and one equi-join on the node (that adaptive
    execution may split where a node is hot). Ids never reach the driver, only
    a row count and a checksum a round; each round is a table in the shared folder,
    which goes when the next one stands.
    """
    spark, path = edges.sparkSession, shared_path(edges.sparkSession, "links")
    pairs = written_at(edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where("u <> v").distinct(), path)
    mark = None
    while True:
        both = pairs.union(pairs.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .union(low.where("m < u").select("u", F.col("m").alias("v")))
            .where("u <> v").distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .where("u <> v").distinct()
        )
        before, path = path, shared_path(spark, "links")
        pairs = written_at(small, path)
        got = pairs.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v") % 1_000_000_007), F.lit(0))).first()
        removed(spark, before)
        if tuple(got) == mark:
            break
        mark = tuple(got)
    found = pairs.select(F.col("u").alias(node), F.col("v").alias(root))
    return found.union(pairs.select(F.col("v").alias(node), F.col("v").alias(root)).distinct())
