"""The stages, one after the other, against brute force on the smallest tables."""

import math

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from pointloom.llm import toxicity
from tests.llm.test_pages import plain_clauses

SF = "/root/testdata/sf0.001"


def plain_score(text, model):
    x = [0.0] * 7
    for kind, weight in plain_clauses(text, model.lexicon, model.threats):
        x[kind] += weight
        x[5] = max(x[5], weight if kind not in (2, 3) else 0.0)
        x[6] += 1
    return 1 / (1 + math.exp(-sum(w * math.log1p(v) for w, v in zip(model.weights, x)) - model.weights[-1]))


def test_stages_take_effect(spark, tmp_path):
    from tests.llm.test_duplicates import plain_print, plain_repeats, union

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        path = str(tmp_path / name.replace(" ", "-"))
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        rows, old = docs.collect(), before.collect()
        seen.append(len(rows))
        if name != "packing":
            assert docs.columns == columns
        if name == "toxicity":
            model = toxicity.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
            assert {r.doc_id for r in rows} == {r.doc_id for r in old if plain_score(r.text or "", model) < 0.5}
        if name == "simhash near-dedup":
            prints = {r.doc_id: plain_print(r.text) for r in old}
            low = union([(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4], prints)
            assert {r.doc_id for r in rows} == {d for d, c in low.items() if c == d}
        if name == "suffix-array dedup":
            want = plain_repeats([(r.doc_id, r.text) for r in old])
            assert {r.doc_id: r.text for r in rows} == {d: w[4] for d, w in want.items()}
            assert all(r.n_chars == len(r.text) for r in rows)
        if name == "packing":
            assert {r.doc_id for r in rows} == {r.doc_id for r in old}
            assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0
    assert seen[0] <= spark.read.parquet(f"{SF}/documents.parquet").count() and seen[1] < seen[0]


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (3, "x", "en", "s", 1), (3, "x", "en", "s", 1)], docs.schema)
    assert {r.doc_id for r in stage(spark, odd, SF).collect()} >= {1}
    assert stage(spark, docs.limit(0), SF).count() == 0


def test_near_duplicates_go_by_row_and_not_by_id(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    copied, own = "one text that two ids have word for word here", "quite another thing was written down under the same id"
    odd = spark.createDataFrame([(1, copied, "en", "s", 1), (2, copied, "en", "s", 1), (2, own, "en", "s", 1), (2, own, "en", "s", 1), (None, "no id", "en", "s", 1), (None, "no id", "en", "s", 1)], schema)
    out = corpus_pipeline.drop_near_duplicates(spark, odd, SF)
    assert out.columns == odd.columns
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == [(0, "no id"), (0, "no id"), (1, copied), (2, own)]
