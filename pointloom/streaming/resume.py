"""Resumable processing as a stream over a folder of inputs.

The file source and its checkpoint remember what is done. The output's folders are the
ledger: rows stand under their source and the number of the micro-batch that wrote
them, and a run remembers its first batch. What a batch writes replaces only what an
earlier try of that batch wrote; rows of its sources from batches before the run go.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def pending(sources: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """STR1, in batch: sources that aren't done yet."""
    return sources.join(done.select(key).distinct(), key, "left_anti")


def signature(settings: dict) -> str:
    """STR2: one text for equal settings."""
    import hashlib
    import json

    return hashlib.sha256(json.dumps(settings, sort_keys=True).encode()).hexdigest()


def _place(spark: SparkSession, path: str):
    """The file system of a path, and the path in it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def guard(spark: SparkSession, path: str, sign: str) -> None:
    """STR2: stores the run's signature beside its checkpoint, or raises if another run's is there."""
    system, place = _place(spark, path)
    if system.exists(place):
        found = spark.read.parquet(path).first()[0]
        if found != sign:
            raise ValueError("the output belongs to a run with other settings")
        return
    spark.createDataFrame([(sign,)], "signature string").write.parquet(path)


#: Column of the output that names the micro-batch a row comes from.
BATCH = "batch_id"


def first_batch(spark: SparkSession, path: str, batch: int) -> int:
    """The first batch of the run that is open at ``path``; opens one at ``batch`` if none is."""
    system, place = _place(spark, path)
    if not system.exists(place):
        spark.createDataFrame([(batch,)], "first bigint").coalesce(1).write.parquet(path)
        return batch
    return spark.read.parquet(path).first()[0]


def replace_sources(spark: SparkSession, out: str, sources: DataFrame, key: str, first: int) -> None:
    """Deletes what batches before ``first`` wrote of ``sources``: a folder a source and batch, so the driver sees names of this batch's sources only."""
    stale = spark.read.parquet(out).where(F.col(BATCH) < first).select(F.col(key).cast("string").alias(key), F.regexp_replace("_metadata.file_path", "/[^/]+$", "").alias("folder")).distinct()
    named = sources.select(F.col(key).cast("string").alias("asked")).distinct()
    for row in stale.join(named, F.col(key).eqNullSafe(F.col("asked"))).select("folder").distinct().collect():
        jvm = spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI.create(row["folder"]))
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def process(spark: SparkSession, inputs: str, schema: str, work: Callable[[DataFrame], DataFrame], out: str, state: str, key: str, settings: dict, files: int = 64) -> None:
    """STR1 to STR3: all new files of ``inputs``, ``files`` at a time, through ``work`` into ``out``, partitioned by ``key`` and batch.

    A source (a value of ``key``, a column of the inputs) may be in any number of files and batches: rows of earlier
    runs go when it is first met in a run, rows of this run stay. A run that was stopped is
    gone on with by the next call, which repeats the batch that was not finished; the next call also belongs to
    a run that was stopped behind its last batch.
    """
    guard(spark, f"{state}/signature", signature(settings))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(inputs)

    def write(batch: DataFrame, number: int) -> None:
        first = first_batch(spark, f"{state}/open-run", number)
        made = work(batch)
        if BATCH in made.columns:
            raise ValueError(f"the results have a column {BATCH} already")
        made.withColumn(BATCH, F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key, BATCH).parquet(out)
        system, place = _place(spark, out)
        if first > 0 and any(f.getPath().getName().startswith(f"{key}=") for f in system.listStatus(place)):
            replace_sources(spark, out, batch, key, first)

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    system, place = _place(spark, f"{state}/open-run")
    system.delete(place, True)


def progress(out: DataFrame, key: str) -> DataFrame:
    """Rows done of each source."""
    return out.groupBy(key).agg(F.count("*").alias("rows"))
