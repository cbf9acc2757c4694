"""Queries over aligned tables, label texts, colours and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointloom.functions import scalars as S
from pointloom.operators import alignment as A
from pointloom.operators import detections as D
from pointloom.operators import masks as M
from pointloom.operators import features, matching, splits
from pointloom.plans.detection_queries import PIXELS, RANKED
from pointloom.plans.registry import query
from pointloom.plans.views import oracle, places, table, view

KEY = ("frame_ord", "row_idx")


@query("joi3_aligned", oracle("SELECT frame_ord, row_idx, gt, model_label AS pred, CAST(row_idx % 7 AS BIGINT) AS manual FROM points", "points"))
def joi3(spark: SparkSession, sf: str) -> DataFrame:
    p = view(spark, sf, "points")
    model, manual = p.select(*KEY, F.col("model_label").alias("pred")), p.select(*KEY, (F.col("row_idx") % 7).alias("manual"))
    return A.aligned(p.select(*KEY, "gt"), {"model": model, "manual": manual})


@query("joi15_lenient", oracle("""WITH v AS (SELECT frame_ord, row_idx, x, row_number() OVER (PARTITION BY frame_ord ORDER BY row_idx) - 1 AS place FROM points WHERE x > 0),
 n AS (SELECT frame_ord, count(*) AS l, count(*) FILTER (x > 0) AS v FROM points GROUP BY frame_ord)
 SELECT p.frame_ord, p.row_idx, CAST(CASE WHEN n.l = n.v THEN p.row_idx ELSE v.place END AS BIGINT) AS pred FROM points p JOIN n USING (frame_ord) JOIN v USING (frame_ord, row_idx)""", "points"))
def joi15(spark: SparkSession, sf: str) -> DataFrame:
    p = view(spark, sf, "points")
    short = places(p.where("x > 0").groupBy("frame_ord").agg(F.count("*").alias("n")), "frame_ord")
    return A.aligned_leniently(p.select(*KEY, "x"), short.withColumn("pred", F.col("row_idx")), F.col("x") > 0).select(*KEY, "pred")


COLOURS = "c AS (SELECT u, v, label / 31e0 AS r, confidence AS g, (label % 7) / 7e0 AS b FROM pixels)"


def colours(spark: SparkSession, sf: str) -> DataFrame:
    p = view(spark, sf, "pixels")
    return p.select("u", "v", (F.col("label") / 31.0).alias("r"), F.col("confidence").alias("g"), ((F.col("label") % 7) / 7.0).alias("b"))


@query("joi2_colours", oracle(f"WITH {COLOURS}, q AS (SELECT frame_ord, row_idx, CAST(floor(cxd) AS BIGINT) AS u, CAST(floor(cyd) AS BIGINT) AS v FROM points) SELECT frame_ord, row_idx, round(coalesce(r, 0e0), 6) AS r, round(coalesce(g, 0e0), 6) AS g, round(coalesce(b, 0e0), 6) AS b FROM q LEFT JOIN c USING (u, v)", "points", "pixels"))
def joi2(spark: SparkSession, sf: str) -> DataFrame:
    p = view(spark, sf, "points").select(*KEY, F.floor("cxd").alias("u"), F.floor("cyd").alias("v"))
    return A.sampled_colours(p, colours(spark, sf)).select(*KEY, *[F.round(c, 6).alias(c) for c in "rgb"])


HUE = "CASE WHEN mx - mn <= 1e-12 THEN 0e0 WHEN mx = r THEN CASE WHEN (g - b) / (mx - mn) < 0 THEN (g - b) / (mx - mn) + 6 ELSE (g - b) / (mx - mn) END WHEN mx = g THEN (b - r) / (mx - mn) + 2 ELSE (r - g) / (mx - mn) + 4 END / 6"


@query("agg18_appearance", oracle(f"""WITH {COLOURS}, h AS (SELECT *, greatest(r, g, b) AS mx, least(r, g, b) AS mn FROM c), k AS (SELECT *, {HUE} AS hue, CASE WHEN mx <= 1e-12 THEN 0e0 ELSE (mx - mn) / mx END AS sat FROM h)
 SELECT v, round(avg(r), 6) AS mean_r, round(stddev_pop(g), 6) AS std_g, round(avg(299e-3 * r + 587e-3 * g + 114e-3 * b), 6) AS mean_gray, round(avg(CASE WHEN floor(hue * 8) = 0 THEN 1e0 ELSE 0e0 END), 6) AS hue_0,
 round(avg(CASE WHEN sat >= 75e-2 THEN 1e0 ELSE 0e0 END), 6) AS sat_3, round(avg(CASE WHEN mx < 25e-2 THEN 1e0 ELSE 0e0 END), 6) AS val_0 FROM k GROUP BY v""", "pixels"))
def agg18(spark: SparkSession, sf: str) -> DataFrame:
    a = A.region_appearance(colours(spark, sf), ["v"])
    return a.select("v", *[F.round(c, 6).alias(c) for c in ("mean_r", "std_g", "mean_gray", "hue_0", "sat_3", "val_0")])


RING = """box AS (SELECT image_id, det_id, u0, v0, w, h, least(80, 3 * w) AS cw, least(40, 3 * h) AS ch FROM detections),
 ring AS (SELECT *, least(greatest(CAST(floor(u0 + w / 2e0 - cw / 2e0) AS BIGINT), 0), 80 - cw) AS cx, least(greatest(CAST(floor(v0 + h / 2e0 - ch / 2e0) AS BIGINT), 0), 40 - ch) AS cy FROM box)"""


@query("agg18_context_ring", oracle(f"""WITH {COLOURS}, h AS (SELECT *, greatest(r, g, b) AS mx, least(r, g, b) AS mn FROM c), k AS (SELECT *, {HUE} AS hue, CASE WHEN mx <= 1e-12 THEN 0e0 ELSE (mx - mn) / mx END AS sat FROM h), {RING}
 SELECT image_id, det_id, round(avg(r), 6) AS mean_r, round(stddev_pop(b), 6) AS std_b, round(avg(299e-3 * r + 587e-3 * g + 114e-3 * b), 6) AS mean_gray, round(avg(CASE WHEN floor(hue * 8) = 1 THEN 1e0 ELSE 0e0 END), 6) AS hue_1,
 round(avg(CASE WHEN sat >= 75e-2 THEN 1e0 ELSE 0e0 END), 6) AS sat_3, round(avg(CASE WHEN mx < 25e-2 THEN 1e0 ELSE 0e0 END), 6) AS val_0
 FROM ring JOIN k ON k.u >= cx AND k.u < cx + cw AND k.v >= cy AND k.v < cy + ch AND NOT (k.u >= u0 AND k.u < u0 + w AND k.v >= v0 AND k.v < v0 + h) GROUP BY image_id, det_id""", "pixels", "detections"))
def agg18_ring(spark: SparkSession, sf: str) -> DataFrame:
    a = D.context_appearance(D.runs(view(spark, sf, "detections")), colours(spark, sf), 80, 40)
    return a.select("image_id", "det_id", *[F.round(c, 6).alias(c) for c in ("mean_r", "std_b", "mean_gray", "hue_1", "sat_3", "val_0")])


@query("flt7_known_labels", oracle("SELECT label, count(*) AS pixels FROM pixels WHERE label NOT IN (0, 255) AND label IN (SELECT DISTINCT r_regionkey * 3 FROM region) GROUP BY label", "pixels"))
def flt7(spark: SparkSession, sf: str) -> DataFrame:
    known = table(spark, sf, "region").select((F.col("r_regionkey") * 3).alias("label"))
    return A.known_labels(view(spark, sf, "pixels"), known, "label").groupBy("label").agg(F.count("*").alias("pixels"))


@query("joi13_resolved_labels", oracle("""WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_orderkey % 5 AS VARCHAR) WHEN o_orderkey % 7 = 1 THEN 'urgentish' ELSE o_orderpriority END AS label, CASE WHEN o_orderkey % 13 = 0 THEN 77 END AS explicit_id FROM orders),
 c AS (SELECT * FROM (VALUES ('1 urgent', 0), ('2_high', 1), ('3-medium', 2), ('5LOW', 4)) t(name, id))
 SELECT o_orderkey, label, CAST(coalesce(explicit_id, (SELECT id FROM c WHERE regexp_replace(lower(name), '[\\s_\\-]+', '', 'g') = regexp_replace(lower(label), '[\\s_\\-]+', '', 'g')), (SELECT id FROM c WHERE CAST(id AS VARCHAR) = label), CASE WHEN label = 'urgentish' THEN 1 END) AS INTEGER) AS class_id FROM o"""))
def joi13(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    label = F.when(k % 7 == 0, (k % 5).cast("string")).when(k % 7 == 1, "urgentish").otherwise(F.col("o_orderpriority"))
    objects = table(spark, sf, "orders").select("o_orderkey", label.alias("label"), F.when(k % 13 == 0, 77).alias("explicit_id"))
    classes = spark.createDataFrame([("1 urgent", 0), ("2_high", 1), ("3-medium", 2), ("5LOW", 4)], "name string, id int")
    aliases = spark.createDataFrame([("Urgentish", "unknown|2 high|1-urgent")], "alias string, targets string")
    return A.resolved_labels(objects, classes, aliases).select("o_orderkey", "label", "class_id")


@query("srt2_match_order", oracle("WITH m AS (SELECT c_custkey % 3 AS seq, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE c_name END AS frame FROM customer) SELECT seq, frame FROM m ORDER BY seq, try_cast(frame AS BIGINT) IS NULL, try_cast(frame AS BIGINT), frame LIMIT 60"))
def srt2(spark: SparkSession, sf: str) -> DataFrame:
    return srt2_places(spark, sf).orderBy("seq", "place").limit(60).select("seq", "frame")  # the first 60, as its SQL says


@query("srt2_match_places", oracle("WITH m AS (SELECT c_custkey % 3 AS seq, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE c_name END AS frame FROM customer) SELECT seq, frame, row_number() OVER (PARTITION BY seq ORDER BY try_cast(frame AS BIGINT) IS NULL, try_cast(frame AS BIGINT), frame) AS place FROM m"))
def srt2_places(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    m = c.select((F.col("c_custkey") % 3).alias("seq"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey").cast("string")).otherwise(F.col("c_name")).alias("frame"))
    return A.match_order(m, "seq", "frame")


@query("agg15_prepared_check", oracle("SELECT frame_ord, true AS same_count, bool_and(row_idx <> 3 OR frame_ord % 2 = 0) AS same_values FROM points GROUP BY frame_ord", "points"))
def agg15(spark: SparkSession, sf: str) -> DataFrame:
    p = view(spark, sf, "points").select(*KEY, "x", "intensity")
    moved = p.withColumn("x", F.when((F.col("row_idx") == 3) & (F.col("frame_ord") % 2 == 1), F.col("x") + 1).otherwise(F.col("x")))
    return A.prepared_check(moved, p, ["x", "intensity"])


@query("agg16_object_statistics", oracle("""WITH o AS (SELECT CAST(o_custkey % 40 AS BIGINT) AS frame_ord, o_orderkey AS object_index, CAST(unnest([o_orderkey % 50, o_orderkey % 30, o_custkey % 45]) AS BIGINT) AS i FROM orders), d AS (SELECT DISTINCT * FROM o)
 SELECT frame_ord, count(DISTINCT object_index) AS objects, count(DISTINCT object_index) AS with_points, count(*) AS attempted, count(DISTINCT i) FILTER (i < 40) AS labelled, count(*) FILTER (i < 40) - count(DISTINCT i) FILTER (i < 40) AS duplicates, count(*) FILTER (i >= 40) AS outside FROM d GROUP BY frame_ord"""))
def agg16(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(
        (F.col("o_custkey") % 40).alias("frame_ord"), F.col("o_orderkey").alias("object_index"), F.array(F.col("o_orderkey") % 50, F.col("o_orderkey") % 30, F.col("o_custkey") % 45).alias("indices")
    )
    rows = o.select("frame_ord").distinct().withColumn("points", F.lit(40))
    return A.object_statistics(o, rows).drop("outside_sample")


@query("dom24_agreement", oracle("WITH a AS (SELECT frame_ord, count(*) AS points FROM points GROUP BY 1), b AS (SELECT frame_ord, count(*) AS labels FROM points WHERE NOT (frame_ord % 9 = 4 AND row_idx = 0) GROUP BY 1) SELECT frame_ord, points, labels, points = labels AS agree FROM a JOIN b USING (frame_ord)", "points"))
def dom24(spark: SparkSession, sf: str) -> DataFrame:
    p = view(spark, sf, "points").select(*KEY)
    return A.agreement({"points": p, "labels": p.where("NOT (frame_ord % 9 = 4 AND row_idx = 0)")}, "frame_ord")


#: Classes in turn, one a step, each repaired against the validating frames as they are.
REPAIRED = """WITH RECURSIVE c AS MATERIALIZED (SELECT frame_ord, gt AS label, count(*) AS n FROM points GROUP BY ALL), f AS MATERIALIZED (SELECT frame_ord, row_number() OVER (ORDER BY md5(frame_ord || ':1'), frame_ord) AS place, count(*) OVER () AS total FROM (SELECT DISTINCT frame_ord FROM c)),
 w AS (SELECT max(total) AS total, least(greatest(1, CAST(round_even(max(total) * 2 / 10e0, 0) AS BIGINT)), max(total) - 1) AS wanted FROM f),
 l AS MATERIALIZED (SELECT row_number() OVER (ORDER BY label) AS turn, list(frame_ord) AS frames, arg_min(frame_ord, (n, frame_ord)) AS low, arg_min(frame_ord, (-n, frame_ord)) AS high FROM c GROUP BY label),
 step AS (
  SELECT 0::BIGINT AS turn, list(frame_ord) FILTER (place <= wanted) AS val FROM f, w
  UNION ALL
  SELECT turn, CASE WHEN len(frames) > 1 AND NOT list_has_any(val, frames) AND len(val) < total - 1 THEN list_append(val, low) ELSE val END
  FROM (SELECT l.turn, l.frames, l.low, w.total, CASE WHEN list_has_all(s.val, l.frames) THEN list_filter(s.val, lambda x: x <> l.high) ELSE s.val END AS val FROM step s JOIN l ON l.turn = s.turn + 1, w))
 SELECT frame_ord, CASE WHEN list_contains((SELECT arg_max(val, turn) FROM step), frame_ord) THEN 'val' ELSE 'train' END AS split FROM f"""


@query("dom12_class_aware_split", oracle(REPAIRED, "points"))
def dom12(spark: SparkSession, sf: str) -> DataFrame:
    return splits.class_aware_split(view(spark, sf, "points").groupBy("frame_ord", F.col("gt").alias("label")).agg(F.count("*").alias("n")))


#: Claims of an image's detections in turn, one rank a step, on what the video composition shows.
CLAIMS = f"""WITH RECURSIVE {PIXELS}, {RANKED}, top AS (SELECT image_id, v, u, arg_max(label, (score, det_id)) AS label, max(score) AS conf FROM px GROUP BY ALL),
 fits AS (SELECT px.image_id, r.rank, px.v * 1000 + px.u AS place FROM px JOIN top USING (image_id, v, u) JOIN r ON r.det_id = px.det_id WHERE px.label = top.label AND abs(px.score - conf) <= 1e-6 + 1e-5 * abs(px.score)),
 l AS MATERIALIZED (SELECT r.image_id, r.rank, r.det_id, coalesce(list(place) FILTER (place IS NOT NULL), []) AS places FROM r LEFT JOIN fits USING (image_id, rank) GROUP BY ALL),
 step AS (SELECT DISTINCT 0::BIGINT AS rank, image_id, NULL::BIGINT AS det_id, []::BIGINT[] AS taken, 0::BIGINT AS visible FROM r
  UNION ALL SELECT rank, image_id, det_id, CASE WHEN len(mine) >= 5 THEN list_concat(taken, mine) ELSE taken END, len(mine) FROM (SELECT l.rank, l.image_id, l.det_id, s.taken, list_filter(places, lambda x: NOT list_contains(s.taken, x)) AS mine FROM step s JOIN l ON l.image_id = s.image_id AND l.rank = s.rank + 1))
 SELECT image_id, det_id, visible FROM step WHERE rank > 0 AND visible >= 5"""


@query("dom20_visible_fragments", oracle(CLAIMS, "detections"))
def dom20(spark: SparkSession, sf: str) -> DataFrame:
    d = view(spark, sf, "detections")
    r = D.runs(d)
    return M.visible_fragments(M.video_composed(r, d), r, d, 5).groupBy("image_id", "det_id").agg(F.sum(F.col("u1") - F.col("u0")).alias("visible"))


@query("dom21_routed", oracle("""WITH v AS (SELECT vec_id, list_transform(embedding[1:3], lambda x: abs(x::DOUBLE)) AS p FROM embeddings), s AS (SELECT *, list_reverse_sort(p) AS q, list_sum(p) AS t FROM v), k AS (SELECT vec_id, list_position(p, q[1]) AS best, round(q[1] / t, 6) AS c, round((q[1] - q[2]) / t, 6) AS m FROM s)
 SELECT vec_id, CASE WHEN c < 5e-1 OR m < 1e-1 THEN 'generic' ELSE ['front', 'rear', 'not_a_sign'][best] END AS routed, CASE WHEN c < 5e-1 AND m < 1e-1 THEN 'low_confidence+low_margin' WHEN c < 5e-1 THEN 'low_confidence' WHEN m < 1e-1 THEN 'low_margin' ELSE 'accepted' END AS reason FROM k
 WHERE NOT (c >= 5e-1 AND m >= 1e-1 AND best = 3)"""))
def dom21(spark: SparkSession, sf: str) -> DataFrame:
    v = table(spark, sf, "embeddings").select("vec_id", F.transform(F.slice("embedding", 1, 3), lambda x: F.abs(x.cast("double"))).alias("p"))
    return D.routed(v, "p", ["front", "rear", "not_a_sign"], 0.5, 0.1, "generic", "not_a_sign").select("vec_id", "routed", "reason")


@query("fn7_camera_coordinate", oracle("SELECT frame_ord, row_idx, round(((slot * 64 + pixel) / 1e3) * 2e0 + (slot * 64 + pixel) % 24, 6) AS cx, round(((slot * 64 + pixel) / 1e3) * ((slot * 64 + pixel) / 1e3), 6) AS cy FROM points", "points"))
def fn7(spark: SparkSession, sf: str) -> DataFrame:
    zones = spark.createDataFrame([(z, [float(z), 2.0] + [0.0] * 6, [0.0, 0.0, 1.0] + [0.0] * 5) for z in range(24)], "zone bigint, a array<double>, b array<double>")
    return S.camera_coordinate(view(spark, sf, "points").select(*KEY, "slot", "pixel"), zones).select(*KEY, F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy"))


@query("fn9_local_position", oracle("""WITH p AS (SELECT event_id, value / 1e3 + 40 AS lat, value / 2e3 + 10 AS lon, CASE WHEN event_id % 5 = 0 THEN 0e0 ELSE value / 1e2 END AS elev FROM events), o AS (SELECT lat AS lat0, lon AS lon0, elev AS up0 FROM p ORDER BY event_id LIMIT 1)
 SELECT event_id, round(radians(lon - lon0) * 6378137e0 * cos(radians(lat0)), 4) AS east, round(radians(lat - lat0) * 6378137e0, 4) AS north, round(elev - up0, 4) AS up FROM p, o"""))
def fn9(spark: SparkSession, sf: str) -> DataFrame:
    v = F.col("value")
    p = table(spark, sf, "events").select("event_id", (v / 1e3 + 40).alias("lat"), (v / 2e3 + 10).alias("lon"), F.when(F.col("event_id") % 5 == 0, 0.0).otherwise(v / 1e2).alias("elev"))
    return S.local_east_north_up(p, "lat", "lon", "elev", "event_id").select("event_id", *[F.round(c, 4).alias(c) for c in ("east", "north", "up")])


@query("fn20_standardised", oracle("""WITH x AS (SELECT vec_id, CAST(unnest(range(0, len(embedding))) AS INTEGER) AS dim, CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings), f AS (SELECT dim, avg(value) AS m, stddev_pop(value) AS s FROM x GROUP BY dim)
 SELECT vec_id, round(sum(CASE WHEN dim = 0 THEN (value - m) / s END), 6) AS first_value, round(max((value - m) / s), 6) AS largest FROM x JOIN f USING (dim) GROUP BY vec_id"""))
def fn20(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    fit = features.fitted(e, "embedding").agg(F.array_sort(F.collect_list(F.struct("dim", "mean", "std"))).alias("f")).scalar()
    both = e.withColumn("f", fit).withColumn("z", S.standardised(F.col("embedding").cast("array<double>"), "f.mean", "f.std"))
    return both.select("vec_id", F.round(F.element_at("z", 1), 6).alias("first_value"), F.round(F.array_max("z"), 6).alias("largest"))


@query("fn26_reason_tags", oracle("""SELECT frame_ord, row_idx, array_to_string(CASE WHEN len(list_filter(t, lambda x: x IS NOT NULL)) > 0 THEN list_filter(t, lambda x: x IS NOT NULL) ELSE ['plain'] END, ',') AS tags
 FROM (SELECT frame_ord, row_idx, [CASE WHEN distance > 50 THEN 'far' END, CASE WHEN cxd IS NULL THEN 'no_pixel' END, CASE WHEN intensity <= 20 THEN 'low' END] AS t FROM points)""", "points"))
def fn26(spark: SparkSession, sf: str) -> DataFrame:
    tags = S.reason_tags({"far": F.col("distance") > 50, "no_pixel": F.col("cxd").isNull(), "low": F.col("intensity") <= 20}, "plain")
    return view(spark, sf, "points").select(*KEY, F.array_join(tags, ",").alias("tags"))


@query("fn13_first_text", oracle("SELECT c_custkey, coalesce(nullif(trim(CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE c_name END), ''), CAST(c_nationkey AS VARCHAR)) AS label FROM customer"))
def fn13(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select("c_custkey", S.first_text(F.when(F.col("c_custkey") % 3 == 0, " ").otherwise(F.col("c_name")), "c_nationkey").alias("label"))


@query("joi16_frame_images", oracle("""WITH i AS (SELECT 's' || CAST(s_suppkey // 2 AS VARCHAR) AS stem, s_name AS image, CASE s_suppkey % 3 WHEN 0 THEN 'png' WHEN 1 THEN 'jpg' ELSE 'gif' END AS suffix FROM supplier), f AS (SELECT DISTINCT 's' || CAST(s_suppkey AS VARCHAR) AS stem FROM supplier)
 SELECT f.stem, arg_min(i.image, (CASE i.suffix WHEN 'jpg' THEN 1 ELSE 2 END, i.image)) AS image FROM f LEFT JOIN i ON i.stem = f.stem AND i.suffix <> 'gif' GROUP BY f.stem"""))
def joi16(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier")
    stem = lambda c: F.concat(F.lit("s"), c.cast("string"))
    suffix = F.when(F.col("s_suppkey") % 3 == 0, "png").when(F.col("s_suppkey") % 3 == 1, "jpg").otherwise("gif")
    images = s.select(stem(F.floor(F.col("s_suppkey") / 2).cast("bigint")).alias("stem"), F.col("s_name").alias("image"), suffix.alias("suffix"))
    return matching.with_image(s.select(stem(F.col("s_suppkey")).alias("stem")).distinct(), images, "stem", ["jpg", "png"])
