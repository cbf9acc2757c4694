"""The driver's tables seen as points, pixels, detections, manifests and matches.

The texts run unchanged in Spark and DuckDB. ``row_idx`` is the row's place in its
frame; all alignment is an equi-join on (frame_ord, row_idx).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = {"points": "lineitem", "pixels": "part", "detections": "orders", "manifest": "orders", "matches": "events", "frame_times": "events", "pose_times": "events"}
NEEDS = {"frame_times": ["matches"], "pose_times": ["matches"]}

SQL = {
    "points": """
SELECT p.*, CAST(row_number() OVER (PARTITION BY frame_ord ORDER BY okey, slot, pkey, skey) - 1 AS BIGINT) AS row_idx
FROM (
  SELECT CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS BIGINT) AS frame_ord,
         l_orderkey AS okey, l_partkey AS pkey, l_suppkey AS skey,
         CAST(l_linenumber AS BIGINT) AS slot, l_partkey % 64 AS pixel, l_suppkey % 3 AS block_id,
         l_extendedprice / 1e3 AS distance,
         (l_partkey % 480) * 25e-2 - 6e1 AS azimuth,
         l_discount * 2e2 - 12e0 AS vertical,
         l_quantity * 5e0 AS intensity, l_tax * 3e3 AS reflectivity,
         CASE WHEN l_quantity = 1 THEN 0e0 ELSE l_extendedprice / 1e3 END AS x,
         CASE WHEN l_quantity = 1 THEN 0e0 ELSE (l_partkey % 480) * 25e-3 - 6e0 END AS y,
         CASE WHEN l_quantity = 1 THEN 0e0 ELSE l_discount * 2e1 - 12e-1 END AS z,
         CASE WHEN l_returnflag = 'A' THEN NULL ELSE (l_partkey % 80) + l_discount * 9e0 END AS cxd,
         CASE WHEN l_returnflag = 'A' THEN NULL ELSE (l_suppkey % 60) + l_tax * 9e0 END AS cyd,
         CAST(CASE WHEN l_returnflag = 'A' THEN 2 WHEN l_returnflag = 'N' THEN 5 ELSE 255 END AS BIGINT) AS gt,
         CAST(CASE WHEN l_suppkey % 4 = 0 THEN 20 WHEN l_linestatus = 'F' THEN 2 ELSE 5 END AS BIGINT) AS model_label,
         l_tax * 125e-1 AS model_conf
  FROM lineitem) p""",
    "pixels": """
SELECT p_partkey % 80 AS u, CAST(floor(p_partkey / 80) AS BIGINT) AS v,
       CAST(p_size % 31 AS BIGINT) AS label, (p_partkey % 11) / 1e1 AS confidence
FROM part""",
    "detections": """
SELECT o_orderkey AS det_id, o_custkey % 200 AS image_id, o_orderpriority AS label, o_orderstatus AS prompt,
       o_totalprice / 1e6 AS score,
       o_orderkey % 40 AS u0, (o_orderkey * 7) % 30 AS v0, 4 + o_orderkey % 9 AS w, 3 + o_custkey % 7 AS h
FROM orders""",
    "manifest": """
SELECT o_orderkey AS sample_id, o_custkey AS source_id, o_orderpriority AS label,
       CASE WHEN o_orderkey % 5 = 0 THEN '1-URGENT' ELSE o_orderpriority END AS initial_label,
       CASE WHEN (o_custkey * 7919) % 100 < 70 THEN 'train' WHEN (o_custkey * 7919) % 100 < 85 THEN 'val' ELSE 'test' END AS split
FROM orders""",
    "matches": """
SELECT CAST(floor(event_id / 2) AS BIGINT) AS frame_id, CAST(floor(event_id / 7) AS BIGINT) AS image_id,
       event_id AS row_idx, CAST(floor(value) - 250 AS BIGINT) AS diff_ms,
       CAST(day(ts) * 86400 + hour(ts) * 3600 + minute(ts) * 60 + CAST(floor(second(ts)) AS BIGINT) AS BIGINT) AS ts_s, event_type
FROM events""",
    "frame_times": "SELECT row_idx AS frame_id, ts_s FROM matches WHERE event_type = 'click'",
    "pose_times": "SELECT row_idx AS pose_id, ts_s FROM matches WHERE event_type = 'view'",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view as a DataFrame over the tables of ``sf_dir``."""
    for need in NEEDS.get(name, []):
        view(spark, sf_dir, need).createOrReplaceTempView(need)
    if name not in NEEDS:
        table(spark, sf_dir, TABLES[name]).createOrReplaceTempView(TABLES[name])
    return spark.sql(SQL[name])


def places(sizes: DataFrame, key: str, n: str = "n") -> DataFrame:
    """(key, row_idx): a row for each place 0 to n - 1. They are made in steps of 100,000, which many tasks share."""
    step = 100_000
    steps = sizes.where(F.col(n) > 0).select(key, F.col(n).alias("n"), F.explode(F.expr(f"sequence(0L, n - 1, {step}L)")).alias("first"))
    return steps.repartition(64, key, "first").select(key, F.explode(F.sequence("first", F.least(F.col("first") + step, F.col("n")) - 1)).alias("row_idx"))


def oracle(text: str, *names: str) -> str:
    """``text`` after common table expressions for the named views."""
    wanted: list[str] = []
    for n in names:
        wanted += [x for x in [*NEEDS.get(n, []), n] if x not in wanted]
    ctes = ", ".join(f"{n} AS ({SQL[n]})" for n in wanted)
    body = text.strip()
    if not ctes:
        return body
    for start in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(start):
            return f"{start}{ctes}, {body[len(start) :]}"
    return f"WITH {ctes} {body}"
