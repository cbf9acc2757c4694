"""From raw documents to training sequences, in four stages.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; what it returns is
written as Parquet and read again as the next one's ``docs``. All but the last
keep the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointloom.llm import packing, repeats, simhash, toxicity
from pointloom.llm.shared import shared_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the model is learned from the labelled ones among ``docs``."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of linked fingerprints; one row of it where the row repeats, the first in the order of its columns.

    Each text of an id is judged by its own fingerprint. Rows without an id stay, all of them.
    Decisions go by id and a hash of the text, so texts are read twice but hashed into fingerprints once.
    """
    mark = "text_hash"
    while mark in docs.columns:
        mark += "_"
    marked = docs.withColumn(mark, F.xxhash64("text"))
    found = simhash.near_duplicates(marked, keep=(mark,))
    gone = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", mark).distinct()
    again = marked.where("doc_id is not null").groupBy("doc_id", mark).count().where("count > 1").select("doc_id", mark)
    # repeated rows are few: they part first, so that texts move once, for the decisions
    kept = lambda how: marked.join(again, ["doc_id", mark], how).join(gone, ["doc_id", mark], "left_anti")
    once = kept("left_anti").select(docs.columns)
    row = F.min(F.struct("text", *[c for c in docs.columns if c != "text"])).alias("row")
    several = kept("left_semi").groupBy("doc_id", mark).agg(row).select("row.*").select(docs.columns)
    return once.unionByName(several)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what stands earlier already; n_chars, where there is one, follows the text. Emptied documents stay, as empty texts."""
    cut = repeats.without_repeats(docs)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("toxicity", drop_toxic), ("simhash near-dedup", drop_near_duplicates), ("suffix-array dedup", drop_repeats), ("packing", pack)]

#: SQL has no form of these stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each from its predecessor's written table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
