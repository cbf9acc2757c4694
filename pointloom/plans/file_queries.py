"""Queries over sources and sinks: a table of the driver's is written in a format to the shared folder and read back by the reader of that format."""

from __future__ import annotations

import io
import zipfile

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pointloom.functions import scalars as S
from pointloom.operators import models
from pointloom.plans.registry import query
from pointloom.plans.views import oracle, places, table, view
from pointloom.sources import files, sinks
from pointloom.sources.shared import work_path
from pointloom.streaming import resume

XYZI = ("x", "y", "z", "intensity")


def delimited(spark: SparkSession, sf: str, sep: str) -> DataFrame:
    path = work_path(spark, "points-csv")
    view(spark, sf, "points").select(*XYZI, F.col("frame_ord").alias("slot"), F.col("row_idx").alias("pixel")).write.option("header", True).option("sep", sep).csv(path)
    p = files.point_csv(spark, path, (*XYZI, "distance", "reflectivity", "slot", "pixel"))
    return p.select(F.col("slot").cast("bigint").alias("frame_ord"), F.col("pixel").cast("bigint").alias("row_idx"), *[F.round(c, 6).alias(c) for c in (*XYZI, "distance", "reflectivity")])


POINTS = "SELECT frame_ord, row_idx, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z, round(intensity, 6) AS intensity, round(sqrt(x * x + y * y + z * z), 6) AS distance, round(intensity, 6) AS reflectivity FROM points"


@query("src1_tab_points", oracle(POINTS, "points"))
def src1(spark: SparkSession, sf: str) -> DataFrame:
    return delimited(spark, sf, "\t")


@query("src2_comma_points", oracle(POINTS, "points"))
def src2(spark: SparkSession, sf: str) -> DataFrame:
    return delimited(spark, sf, ",")


@query("src3_blank_points", oracle(POINTS, "points"))
def src3(spark: SparkSession, sf: str) -> DataFrame:
    return delimited(spark, sf, " ")


def frames(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "points").select(F.col("frame_ord").cast("string").alias("frame_id"), "row_idx", *XYZI, F.col("gt").alias("label"))


def clouds(spark: SparkSession, sf: str) -> DataFrame:
    """Packed frames, written and read as a table."""
    path = work_path(spark, "clouds")
    sinks.point_cloud_bytes(frames(spark, sf)).write.parquet(path)
    return spark.read.parquet(path)


@query("src4_float_records", oracle("SELECT frame_ord, row_idx, round(x::FLOAT::DOUBLE, 4) AS x, round(intensity::FLOAT::DOUBLE, 4) AS intensity FROM points", "points"))
def src4(spark: SparkSession, sf: str) -> DataFrame:
    got = files.decoded_floats(clouds(spark, sf).select(F.concat("frame_id", F.lit(".bin")).alias("path"), F.col("cloud").alias("content")), XYZI)
    return got.select(F.col("frame_id").cast("bigint").alias("frame_ord"), "row_idx", F.round("x", 4).alias("x"), F.round("intensity", 4).alias("intensity"))


@query("snk3_point_cloud", oracle("SELECT frame_ord, 16 * count(*) AS cloud_bytes, 4 * count(*) AS label_bytes FROM points GROUP BY frame_ord", "points"))
def snk3(spark: SparkSession, sf: str) -> DataFrame:
    return clouds(spark, sf).select(F.col("frame_id").cast("bigint").alias("frame_ord"), F.octet_length("cloud").cast("bigint").alias("cloud_bytes"), F.octet_length("labels").cast("bigint").alias("label_bytes"))


@query("src9_label_arrays", oracle("SELECT frame_ord, row_idx, gt AS label FROM points", "points"))
def src9(spark: SparkSession, sf: str) -> DataFrame:
    got = files.decoded_arrays(clouds(spark, sf).select(F.concat("frame_id", F.lit(".label")).alias("path"), F.col("labels").alias("content")))
    return got.select(F.col("frame_id").cast("bigint").alias("frame_ord"), F.col("u").alias("row_idx"), F.col("label").cast("bigint").alias("label"))


@query("src9_label_kinds", oracle("SELECT frame_id, arg_min(kind, CASE kind WHEN 'view' THEN 1 ELSE 2 END) AS kind FROM (SELECT frame_id, event_type AS kind FROM matches WHERE event_type IN ('view', 'click')) GROUP BY frame_id", "matches"))
def src9_kinds(spark: SparkSession, sf: str) -> DataFrame:
    found = view(spark, sf, "matches").select("frame_id", F.col("event_type").alias("kind"), F.col("row_idx").cast("string").alias("path"))
    return files.label_files(found, ["view", "click"]).select("frame_id", "kind")


def packed(spark: SparkSession, sf: str) -> DataFrame:
    """Points of each frame as packet files: a record each, in order."""

    fields = ("distance", "intensity", "reflectivity", "azimuth", "vertical", "x", "y", "z")

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        n, order = len(group), group["row_idx"].to_numpy().argsort(kind="stable")
        held = bytearray(16 + n * files.RECORD.itemsize) + b"cut"
        np.frombuffer(held, "<u8", 2)[:] = 128, n
        records = np.frombuffer(held, files.RECORD, n, 16)
        for name in fields:
            records[name] = group[name].to_numpy()[order]
        return pd.DataFrame({"path": [f"{group['frame_ord'].iloc[0]}.pkt"], "content": [held]})

    path = work_path(spark, "packets")
    view(spark, sf, "points").select("frame_ord", "row_idx", *fields).groupBy("frame_ord").applyInPandas(pack, "path string, content binary").write.parquet(path)
    return files.decoded_packets(spark.read.parquet(path))


SLOTS = "SELECT frame_ord, row_idx, row_idx // 384 AS slot, row_idx // 3 % 128 AS pixel, row_idx % 3 AS block_id, round(distance::FLOAT::DOUBLE, 4) AS distance, round(vertical::FLOAT::DOUBLE, 4) AS vertical FROM points"


@query("src5_packets", oracle(SLOTS, "points"))
def src5(spark: SparkSession, sf: str) -> DataFrame:
    return packed(spark, sf).select(F.col("frame_id").cast("bigint").alias("frame_ord"), "row_idx", "slot", "pixel", "block_id", F.round("distance", 4).alias("distance"), F.round("vertical", 4).alias("vertical"))


@query("snk10_decoded_csv", oracle(SLOTS, "points"))
def snk10(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "decoded")
    sinks.decoded_csv(packed(spark, sf), path)
    read = spark.read.option("header", True).csv(path)
    return read.select(F.col("frame_id").cast("bigint").alias("frame_ord"), *[F.col(c).cast("bigint").alias(c) for c in ("row_idx", "slot", "pixel", "block_id")], *[F.round(F.col(c).cast("double"), 4).alias(c) for c in ("distance", "vertical")])


@query("src7_wide_packets", oracle("""WITH b AS (SELECT p_partkey // 4 AS azimuth_idx, p_partkey % 4 AS beam, p_retailprice / 1e2 - 1e1 AS d, p_size::DOUBLE AS strength FROM part), n AS (SELECT max(azimuth_idx) AS top FROM b),
 g AS (SELECT DISTINCT azimuth_idx FROM b), w AS (SELECT g.azimuth_idx, k.beam, greatest(0, b.d) AS d, b.strength, row_number() OVER (PARTITION BY k.beam ORDER BY g.azimuth_idx) - 1 AS place, count(*) OVER (PARTITION BY k.beam) AS n FROM g, (SELECT unnest(range(0, 4)) AS beam) k LEFT JOIN b ON b.azimuth_idx = g.azimuth_idx AND b.beam = k.beam)
 SELECT azimuth_idx, CAST(beam AS BIGINT) AS beam, round(d * cos(radians(-125e-1 + 25e0 * beam / 3)) * cos(radians(-60 + 120e0 * azimuth_idx / greatest(n - 1, 1))), 4) AS x, round(d * sin(radians(-125e-1 + 25e0 * beam / 3)), 4) AS z, strength FROM w WHERE d IS NOT NULL"""))
def src7(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select(F.floor(F.col("p_partkey") / 4).cast("bigint").alias("row_idx"), (F.col("p_partkey") % 4).alias("beam"), (F.col("p_retailprice") / 100 - 10).alias("d"), F.col("p_size").cast("double").alias("s"))
    wide = p.groupBy("row_idx").agg(*[F.max(F.when(F.col("beam") == k, F.col(c))).alias(f"{n}{k}") for n, c in (("dis", "d"), ("int", "s"), ("ref", "s")) for k in range(4)]).withColumn("frame_id", F.lit("f"))
    got = files.packet_csv_points(wide, 4).where("strength IS NOT NULL")
    return got.select("azimuth_idx", F.col("beam").cast("bigint").alias("beam"), F.round("x", 4).alias("x"), F.round("z", 4).alias("z"), "strength")


@query("src10_flat_labels", oracle("""WITH r AS (SELECT frame_ord, row_idx, row_number() OVER (PARTITION BY frame_ord ORDER BY row_idx) - 1 AS place FROM points WHERE block_id = 0)
 SELECT frame_ord, row_idx, CASE WHEN frame_ord % 2 = 0 THEN row_idx ELSE place END % 7 AS label FROM r""", "points"))
def src10(spark: SparkSession, sf: str) -> DataFrame:
    p = view(spark, sf, "points").select(F.col("frame_ord").alias("frame_id"), "row_idx", (F.col("block_id") == 0).alias("is_primary"))
    sizes = p.groupBy("frame_id").agg(F.when(F.col("frame_id") % 2 == 0, F.count("*")).otherwise(F.count_if("is_primary")).alias("n"))
    labels = places(sizes, "frame_id").withColumn("label", F.col("row_idx") % 7)
    return files.flat_labels(labels, p).withColumnRenamed("frame_id", "frame_ord")


@query("src12_archives", oracle("SELECT image_id, det_id, label, CAST(h AS BIGINT) AS runs, CAST(w * h AS BIGINT) AS area FROM (SELECT image_id, row_number() OVER (PARTITION BY image_id ORDER BY det_id) - 1 AS det_id, label, w, h FROM detections)", "detections"))
def src12(spark: SparkSession, sf: str) -> DataFrame:
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        g = group.sort_values("det_id")
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as z:
            with z.open("masks.npy", "w", force_zip64=True) as out:
                np.lib.format.write_array_header_1_0(out, {"descr": "|b1", "fortran_order": False, "shape": (len(g), 40, 56)})
                for at in range(0, len(g), files.MASKS):
                    part = g[["u0", "v0", "w", "h"]].iloc[at : at + files.MASKS]
                    masks = np.zeros((len(part), 40, 56), bool)
                    for k, (u, v, w, h) in enumerate(part.itertuples(index=False)):
                        masks[k, v : v + h, u : u + w] = True
                    out.write(masks.tobytes())
            for name, values in (("scores", g["score"].to_numpy()), ("labels", g["label"].to_numpy().astype(str))):
                with z.open(f"{name}.npy", "w") as out:
                    np.lib.format.write_array(out, values, allow_pickle=False)
        return pd.DataFrame({"path": [f"{g['image_id'].iloc[0]}.npz"], "content": [held.getvalue()]})

    path = work_path(spark, "archives")
    view(spark, sf, "detections").groupBy("image_id").applyInPandas(pack, "path string, content binary").write.parquet(path)
    got = files.decoded_archives(spark.read.parquet(path))
    by = got.groupBy(F.col("image_id").cast("bigint").alias("image_id"), "det_id", "label")
    return by.agg(F.count("*").alias("runs"), F.sum(F.col("u1") - F.col("u0")).alias("area"))


@query("src13_frame_index", oracle("SELECT frame_id, row_number() OVER (ORDER BY frame_id) - 1 AS frame_ord FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS frame_id FROM orders)"))
def src13(spark: SparkSession, sf: str) -> DataFrame:
    return files.frame_index(table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("frame_id")))


@query("src15_annotation_files", oracle("""WITH f AS (SELECT CAST(c_custkey AS VARCHAR) AS frame_id FROM customer), a AS (SELECT CAST(c_custkey AS VARCHAR) || CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN '_labels' WHEN 2 THEN '_manual' ELSE '_other' END AS stem FROM customer)
 SELECT frame_id, stem AS path FROM f LEFT JOIN a ON stem = frame_id OR stem IN (frame_id || '_labels', frame_id || '_manual')"""))
def src15(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    c = table(spark, sf, "customer")
    end = F.when(F.col("c_custkey") % 4 == 0, "").when(F.col("c_custkey") % 4 == 1, "_labels").when(F.col("c_custkey") % 4 == 2, "_manual").otherwise("_other")
    found = c.select(F.concat(key, end).alias("stem")).withColumn("path", F.col("stem"))
    return files.annotation_for_frames(c.select(key.alias("frame_id")), found)


@query("src16_delimited_map", oracle("SELECT CAST(s_suppkey AS VARCHAR) AS l, s_name AS r FROM supplier"))
def src16(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "map")
    table(spark, sf, "supplier").select(F.concat_ws(" >> ", F.col("s_suppkey").cast("string"), "s_name").alias("value")).write.text(path)
    return files.delimited_map(spark, path, ["l", "r"])


@query("src17_timestamps", oracle("SELECT event_id AS frame_index, CAST(round_even(value * 1000, 0) AS BIGINT) AS ts_us FROM events"))
def src17(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "times")
    table(spark, sf, "events").select(F.col("event_id").alias("i"), F.col("value").alias("t")).write.option("header", True).csv(path)
    return files.timestamps_csv(spark, path, "i", "t", "ms")


@query("src18_pose_log", oracle("SELECT event_id * 1000000 + event_id * 7919 % 1000000 AS ts_us, value AS attitude FROM events"))
def src18(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "poses")
    table(spark, sf, "events").select(F.col("event_id").alias("secs"), (F.col("event_id") * 7919 % 1_000_000 * 1000 + 17).alias("nsecs"), F.col("value").alias("attitude")).write.option("header", True).csv(path)
    return files.pose_log(spark, path)


MANIFEST = "SELECT sample_id, source_id, label, split FROM manifest"


@query("src19_json_lines", oracle(MANIFEST, "manifest"))
def src19(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "lines")
    view(spark, sf, "manifest").select("sample_id", "source_id", "label", "split").write.json(path)
    return files.jsonl(spark, path, "sample_id bigint, source_id bigint, label string, split string")


@query("snk6_manifest", oracle(MANIFEST, "manifest"))
def snk6(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "manifest")
    sinks.manifest_jsonl(view(spark, sf, "manifest").select("sample_id", "source_id", "label", "split"), path)
    return spark.read.schema("label string, sample_id bigint, source_id bigint, split string").json(path)


@query("src20_frame_logs", oracle("SELECT s_suppkey AS frame, s_acctbal AS t FROM supplier WHERE s_suppkey % 5 <> 0"))
def src20(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "logs")
    text = F.when(F.col("s_suppkey") % 5 == 0, "broken").otherwise(F.to_json(F.struct(F.col("s_suppkey").alias("frame"), F.col("s_acctbal").alias("t"))))
    # a file a log: many tasks write them, and each task puts its own in place, so that the driver moves none
    logs = table(spark, sf, "supplier").select("s_suppkey", text.alias("value")).repartition(64, "s_suppkey").select("value")
    logs.write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)
    return files.frame_logs(spark, path, "frame bigint, t double")[0].select("frame", "t")


@query("src21_doubled_stems", oracle("SELECT CAST(frame_id AS VARCHAR) AS stem, count(*) AS n FROM matches GROUP BY frame_id HAVING count(*) > 1", "matches"))
def src21(spark: SparkSession, sf: str) -> DataFrame:
    return files.doubled_stems(view(spark, sf, "matches").select(F.col("frame_id").cast("string").alias("stem")))


CLASSES = "SELECT s_suppkey AS id, s_name AS name FROM supplier"


@query("src22_classes_json", oracle(CLASSES))
def src22(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "classes-json")
    table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")).write.json(path)
    return files.dimension_file(spark, path, "id bigint, name string", ("id", "name"))


@query("src22_classes_xml", oracle(CLASSES))
def src22_xml(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "classes") + ".xml"
    table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")).write.format("xml").option("rowTag", "class").option("rootTag", "classes").save(path)
    return files.dimension_file(spark, path, "id bigint, name string", ("id", "name"))


@query("src22_classes_yaml", oracle("""SELECT s_nationkey AS nation, 'semantic_classes' AS section, replace(s_name, '#', '_') AS "key", CAST(s_suppkey AS VARCHAR) AS value, CAST(NULL AS INTEGER) AS item FROM supplier
 UNION ALL SELECT s_nationkey, 'noise_groups', 'rich', replace(s_name, '#', '_'), CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS INTEGER) FROM supplier WHERE s_acctbal > 0"""))
def src22_yaml(spark: SparkSession, sf: str) -> DataFrame:
    """A class configuration a nation, of its suppliers' names and numbers and a group of some of them, written and read back."""
    path = work_path(spark, "classes-yaml")
    name = F.replace("s_name", F.lit("#"), F.lit("_"))
    rows = table(spark, sf, "supplier").select("s_nationkey", "s_suppkey", name.alias("name"), (F.col("s_acctbal") > 0).alias("rich"))
    by = rows.groupBy("s_nationkey").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", "name", "rich"))).alias("s"))
    classes = F.transform("s", lambda x: F.concat(F.lit("  "), x["name"], F.lit(": "), x["s_suppkey"].cast("string"), F.lit("  # a supplier")))
    group = F.transform(F.filter("s", lambda x: x["rich"]), lambda x: F.concat(F.lit("    - '"), x["name"], F.lit("'")))
    text = F.concat_ws("\n", F.array(F.lit("# classes"), F.lit("semantic_classes:")), classes, F.array(F.lit(""), F.lit("noise_groups:"), F.lit("  rich:")), group)
    by.select("s_nationkey", text.alias("value")).repartition("s_nationkey").write.partitionBy("s_nationkey").text(path)
    read = files.yaml_sections(spark, path)
    return read.select(F.regexp_extract("file", "s_nationkey=(\\d+)", 1).cast("int").alias("nation"), "section", "key", "value", "item")


@query("src23_synced_frames", oracle("SELECT frame_id, row_idx FROM matches WHERE abs(diff_ms) <= 100", "matches"))
def src23(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "synced")
    frame = F.struct("frame_id", "row_idx", (F.abs("diff_ms") <= 100).alias("synced"))
    by = view(spark, sf, "matches").groupBy(F.floor(F.col("row_idx") / 1000).alias("part")).agg(F.collect_list(frame).alias("frames"))
    by.select("frames").write.option("maxRecordsPerFile", 1).json(path)
    return files.synced_frames(spark, path).select("frame_id", "row_idx")


@query("snk1_frames_table", oracle("SELECT frame_ord, gt, count(*) AS points FROM points GROUP BY ALL", "points"))
def snk1(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "frames")
    sinks.frames_table(view(spark, sf, "points").select("frame_ord", "row_idx", "gt"), path, ("frame_ord",))
    return spark.read.parquet(path).groupBy(F.col("frame_ord").cast("bigint").alias("frame_ord"), "gt").agg(F.count("*").alias("points"))


@query("snk2_split_table", oracle("SELECT split, label, count(*) AS samples FROM manifest GROUP BY ALL", "manifest"))
def snk2(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "splits")
    sinks.frames_table(view(spark, sf, "manifest").select("split", "label", "sample_id"), path, ("split",))
    return spark.read.parquet(path).groupBy("split", "label").agg(F.count("*").alias("samples"))


@query("snk4_report", oracle("SELECT label, split, count(*) AS samples FROM manifest GROUP BY ALL", "manifest"))
def snk4(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "report")
    sinks.report_csv(view(spark, sf, "manifest").groupBy("label", "split").agg(F.count("*").alias("samples")), path)
    return spark.read.option("header", True).schema("label string, split string, samples bigint").csv(path)


@query("snk7_pose_lines", oracle("SELECT vec_id, round(CAST(embedding[1] AS DOUBLE), 9) AS first, round(CAST(embedding[12] AS DOUBLE), 9) AS last FROM (SELECT row_number() OVER (ORDER BY vec_id) AS vec_id, embedding FROM embeddings)"))
def snk7(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "lines")
    poses = table(spark, sf, "embeddings").select("vec_id", F.transform(F.slice("embedding", 1, 12), lambda x: x.cast("double")).alias("pose"))
    sinks.pose_lines(poses, path, "pose", "vec_id")
    read = spark.read.text(path).select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"), F.split("value", " ").alias("c"))
    # a line's number is its place in its file behind all earlier files, so no task ranks all lines
    lines = read.groupBy("file").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(Window.orderBy("file")) - F.col("n")).select("file", "before")
    number = F.transform("c", lambda x: F.round(x.cast("double"), 9))
    at = F.col("before") + F.row_number().over(Window.partitionBy("file").orderBy("at"))
    return read.join(lines, "file").select(at.cast("bigint").alias("vec_id"), number[0].alias("first"), number[11].alias("last"))


@query("src6_organised_frames", oracle("""WITH c AS (SELECT frame_ord, slot, pixel, arg_min(x, row_idx) AS x, arg_min(intensity, row_idx) AS intensity FROM points GROUP BY ALL), g AS (SELECT frame_ord, unnest(range(0, 448)) AS k FROM (SELECT DISTINCT frame_ord FROM points))
 SELECT g.frame_ord, k // 64 AS ring, k % 64 AS "column", round(coalesce(x, 0)::FLOAT::DOUBLE, 4) AS x, round(coalesce(intensity, 0)::FLOAT::DOUBLE, 4) AS intensity FROM g LEFT JOIN c ON c.frame_ord = g.frame_ord AND slot = k // 64 + 1 AND pixel = k % 64""", "points"))
def src6(spark: SparkSession, sf: str) -> DataFrame:
    """Frames of 7 x 64 records, the first point of each slot and pixel, as bytes and back."""
    p = view(spark, sf, "points").where("slot BETWEEN 1 AND 7")
    first = p.groupBy("frame_ord", ((F.col("slot") - 1) * 64 + F.col("pixel")).alias("row_idx")).agg(F.min_by(F.struct(*XYZI), "row_idx").alias("p"))
    grid = view(spark, sf, "points").select("frame_ord").distinct().withColumn("row_idx", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(447).cast("bigint"))))
    cells = grid.join(first, ["frame_ord", "row_idx"], "left").select(F.col("frame_ord").cast("string").alias("frame_id"), "row_idx", *[F.coalesce(f"p.{c}", F.lit(0.0)).alias(c) for c in XYZI], F.lit(0).alias("label"))
    packed_frames = sinks.point_cloud_bytes(cells).select(F.concat("frame_id", F.lit(".bin")).alias("path"), F.col("cloud").alias("content"))
    got = files.organised_frames(packed_frames, XYZI, 7, 64)
    return got.select(F.col("frame_id").cast("bigint").alias("frame_ord"), "ring", "column", F.round("x", 4).alias("x"), F.round("intensity", 4).alias("intensity"))


@query("src24_calibrations", oracle("""WITH p AS (SELECT p_partkey, p_size::DOUBLE AS s, p_retailprice AS r, p_partkey % 3 = 0 AS inverse FROM part)
 SELECT p_partkey, s AS fx, round(CASE WHEN inverse THEN -r ELSE s END, 6) AS t03, round(CASE WHEN inverse THEN s ELSE r END, 6) AS t13, round(CASE WHEN inverse THEN -2e0 ELSE 2e0 END, 6) AS t23, 1e0 AS t33 FROM p"""))
def src24(spark: SparkSession, sf: str) -> DataFrame:
    """A camera a part: a quarter turn and a shift, under other keys and layouts by part; every third is given in the inverse direction."""
    key, c = F.col("p_partkey"), F.col("s")
    number = lambda *values: F.array(*[v if not isinstance(v, (int, float)) else F.lit(float(v)) for v in values])
    k, turn = number(c, 0, 320, 0, c, 240, 0, 0, 1), number(0, -1, 0, c, 1, 0, 0, F.col("r"), 0, 0, 1, 2)
    whole = F.concat(turn, number(0, 0, 0, 1))
    of = lambda n, v: F.when(key % 2 == n, v)
    rows = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("s"), F.col("p_retailprice").cast("double").alias("r"))
    text = F.to_json(F.struct(of(0, k).alias("K"), of(1, k).alias("camera_matrix"), of(0, turn).alias("T"), of(1, whole).alias("extrinsic"), F.when(key % 3 == 0, "camera_to_lidar").alias("direction")))
    got = files.calibrations(rows.select("p_partkey", text.alias("value")), "p_partkey")
    return got.select("p_partkey", F.col("k")[0].alias("fx"), *[F.round(F.col("t")[i], 6).alias(f"t{i // 4}3") for i in (3, 7, 11, 15)])


@query("snk8_overwrite_guard", oracle("SELECT label, count(*) AS samples, true AS refused FROM manifest WHERE split = 'val' GROUP BY label", "manifest"))
def snk8(spark: SparkSession, sf: str) -> DataFrame:
    """A folder with content refuses a second table and keeps what it has; asked to, it takes one."""
    path, m = work_path(spark, "guarded"), view(spark, sf, "manifest").select("split", "label", "sample_id")
    sinks.frames_table(m.where("split = 'train'"), path, ("split",))
    try:
        sinks.frames_table(m.where("split = 'test'"), path, ("split",))
        refused = False
    except AnalysisException:
        refused = spark.read.parquet(path).where("split <> 'train'").isEmpty()
    sinks.frames_table(m.where("split = 'val'"), path, ("split",), overwrite=True)
    return spark.read.parquet(path).groupBy("label").agg(F.count("*").alias("samples")).withColumn("refused", F.lit(refused))


@query("str2_guarded_run", oracle("SELECT event_type AS source_id, count(*) AS events, true AS refused FROM events GROUP BY event_type"))
def str2(spark: SparkSession, sf: str) -> DataFrame:
    """A second run with other settings is refused and leaves the first one's rows as they are."""
    inputs, out, state = (work_path(spark, n) for n in ("inputs", "out", "state"))
    table(spark, sf, "events").select(F.col("event_type").alias("source_id"), F.col("event_id").alias("v")).write.parquet(inputs)
    run = lambda scale: resume.process(spark, inputs, "source_id string, v bigint", lambda b: b.select("source_id", (F.col("v") * scale).alias("v")), out, state, "source_id", {"scale": scale})
    run(1)
    try:
        run(2)
        refused = False
    except ValueError:
        refused = True
    return resume.progress(spark.read.parquet(out), "source_id").select("source_id", F.col("rows").alias("events"), F.lit(refused).alias("refused"))


@query("str1_pending", oracle("SELECT sample_id FROM manifest WHERE sample_id NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 4)", "manifest"))
def str1(spark: SparkSession, sf: str) -> DataFrame:
    done = table(spark, sf, "lineitem").where("l_linenumber = 4").select(F.col("l_orderkey").alias("sample_id"))
    return resume.pending(view(spark, sf, "manifest").select("sample_id"), done, "sample_id")


@query("str3_resumed_run", oracle("SELECT event_type AS source_id, event_id AS v, value * 2 AS w FROM events"))
def str3(spark: SparkSession, sf: str) -> DataFrame:
    """The events as files that each hold several types, one file a batch, in two runs with one signature (STR1 to STR3); the second finds nothing to do."""
    inputs, out, state = (work_path(spark, n) for n in ("inputs", "out", "state"))
    table(spark, sf, "events").select(F.col("event_type").alias("source_id"), F.col("event_id").alias("v"), "value").repartition(4, "v").write.parquet(inputs)
    for _ in range(2):
        resume.process(spark, inputs, "source_id string, v bigint, value double", lambda b: b.select("source_id", "v", (F.col("value") * 2).alias("w")), out, state, "source_id", {"scale": 2}, 1)
    return spark.read.parquet(out).select("source_id", "v", "w")


@query("udf1_classifier", oracle("SELECT p_partkey, round(p_size / (p_size + p_retailprice), 6) AS first FROM part"))
def udf1(spark: SparkSession, sf: str) -> DataFrame:
    model = sinks.classifier(lambda: lambda x: x / x.sum(axis=1, keepdims=True), features=2)
    vector = F.array(F.col("p_size").cast("double"), F.col("p_retailprice").cast("double"))
    return table(spark, sf, "part").select("p_partkey", F.round(model(vector)[0], 6).alias("first"))


@query("udf1_trained_ensemble")
def udf1_trained(spark: SparkSession, sf: str) -> DataFrame:
    """Three softmax regressions trained on four fifths of the labelled vectors judge all of them."""
    vectors = table(spark, sf, "embeddings")
    classes, members = models.softmax_ensemble(vectors.where("label IS NOT NULL AND vec_id % 5 <> 0"), "vec_id", "embedding", "label")
    return models.classified(vectors, "vec_id", "embedding", classes, members)


@query("udf2_components", oracle("""WITH RECURSIVE p AS MATERIALIZED (SELECT v // 25 AS image_id, v, u, label, confidence FROM pixels WHERE label <> 0),
 n AS MATERIALIZED (SELECT a.v AS v, a.u AS u, b.v AS v2, b.u AS u2 FROM p a JOIN p b ON a.image_id = b.image_id AND a.label = b.label AND abs(a.v - b.v) + abs(a.u - b.u) = 1),
 reach AS (SELECT v, u, v AS v2, u AS u2 FROM p UNION SELECT r.v, r.u, n.v2, n.u2 FROM reach r JOIN n ON n.v = r.v2 AND n.u = r.u2), c AS (SELECT v, u, min(v2 * 1000 + u2) AS root FROM reach GROUP BY v, u)
 SELECT image_id, label, round(avg(confidence), 6) AS score, min(u) AS u0, min(v) AS v0, max(u) - min(u) + 1 AS w, max(v) - min(v) + 1 AS h, count(*) AS pixels FROM p JOIN c USING (v, u) GROUP BY image_id, label, root""", "pixels"))
def udf2_components(spark: SparkSession, sf: str) -> DataFrame:
    pixels = view(spark, sf, "pixels").withColumn("image_id", F.floor(F.col("v") / 25))
    return models.detected(pixels).withColumn("score", F.round("score", 6))


@query("fn6_scaled_intrinsics", oracle("SELECT p_partkey, round(p_size * 5e-1, 6) AS fx, round(p_size * 25e-2, 6) AS fy FROM part"))
def fn6(spark: SparkSession, sf: str) -> DataFrame:
    k = S.scaled_intrinsics([F.col("p_size"), 0, 0, 0, F.col("p_size"), 0, 0, 0, 1], (3840, 2160), (1920, 540))
    return table(spark, sf, "part").select("p_partkey", F.round(k[0], 6).alias("fx"), F.round(k[4], 6).alias("fy"))


@query("fn15_namespaces", oracle("SELECT s_suppkey, regexp_replace(s_name, '[^A-Za-z0-9]+', '_', 'g') || '_' || substring(sha1(s_name), 1, 8) AS namespace FROM supplier"))
def fn15(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select("s_suppkey", S.source_key("s_name", "s_name", 8).alias("namespace"))


@query("joi6_checked_matches", oracle("SELECT frame_id, arg_min(row_idx, (abs(diff_ms), row_idx)) AS row_idx FROM matches WHERE frame_id BETWEEN 10 AND 400 GROUP BY frame_id", "matches"))
def joi6(spark: SparkSession, sf: str) -> DataFrame:
    from pointloom.operators import matching

    m = view(spark, sf, "matches")
    times, images = m.select("frame_id", "ts_s").dropDuplicates(["frame_id"]), m.select("image_id").distinct()
    return matching.checked_matches(m.select("frame_id", "image_id", "diff_ms", "row_idx"), times, images, "frame_id", "image_id", 10, 400).select("frame_id", "row_idx")
