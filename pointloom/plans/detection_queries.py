"""Queries over detections and their masks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointloom.functions import scalars as S
from pointloom.operators import detections as D
from pointloom.operators import masks as M
from pointloom.plans.registry import query
from pointloom.plans.views import oracle, view

BOXED = "d AS (SELECT det_id, label, (u0 - 2) / 40e0 AS bx, v0 / 30e0 AS \"by\", w / 40e0 AS bw, h / 30e0 AS bh FROM detections)"
METRIC = 'k AS (SELECT *, CASE WHEN bh > 1e-6 AND bw >= 0 THEN "by" + bh END AS bottom, CASE WHEN bh > 1e-6 AND bw >= 0 THEN bw / bh END AS aspect, CASE WHEN bh > 1e-6 AND bw >= 0 THEN bw * bh END AS area FROM d)'
GEOMETRY = {"1-URGENT": (0.4, None, 0.5, None), "2-HIGH": (None, 0.8, None, 1.5), "3-MEDIUM": (0.2, None, None, 0.9)}
SIZES = {"2-HIGH": (0.2, 0.2, 0.03), "5-LOW": (0.25, 0.25, 0.05)}
RUNS = "runs AS (SELECT image_id, det_id, CAST(unnest(range(v0, v0 + h)) AS BIGINT) AS v, u0, u0 + w AS u1 FROM detections)"
PAIRS = f"""{RUNS}, met AS (SELECT x.image_id, x.det_id AS a, y.det_id AS b, CAST(sum(least(x.u1, y.u1) - greatest(x.u0, y.u0)) AS BIGINT) AS intersection FROM runs x JOIN runs y ON x.image_id = y.image_id AND x.v = y.v AND x.det_id < y.det_id AND x.u0 < y.u1 AND y.u0 < x.u1 GROUP BY ALL),
pairs AS (SELECT met.*, p.w * p.h AS area_a, q.w * q.h AS area_b FROM met JOIN detections p ON p.det_id = a JOIN detections q ON q.det_id = b)"""
PIXELS = f"{RUNS}, px AS (SELECT r.image_id, r.v, CAST(unnest(range(r.u0, r.u1)) AS BIGINT) AS u, r.det_id, d.label, d.score FROM runs r JOIN detections d USING (det_id))"


#: Detections of all images in turn, one rank a step: which of an image's detections owns each place.
PAINTED = """WITH RECURSIVE d AS MATERIALIZED (SELECT image_id, det_id, label, score, u0, v0, w, h, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, det_id) AS rank FROM detections),
 e AS MATERIALIZED (SELECT image_id, list(label ORDER BY rank) AS labels, list(score ORDER BY rank) AS scores FROM d GROUP BY image_id),
 g AS (SELECT max(u0 + w) AS wide, max(v0 + h) AS high FROM detections),
 step AS (
  SELECT 0::BIGINT AS rank, image_id, list_transform(range(wide * high), lambda x: 0) AS owner FROM e, g
  UNION ALL
  SELECT rank, image_id, CASE WHEN list_sum(won) >= 40 THEN list_transform(owner, lambda o, i: CASE WHEN won[i] = 1 THEN CAST(rank AS INTEGER) ELSE o END) ELSE owner END
  FROM (SELECT d.rank, d.image_id, s.owner, CASE WHEN d.w * d.h < 40 THEN [0] ELSE list_transform(s.owner, lambda o, i: CASE
     WHEN (i - 1) % wide < d.u0 OR (i - 1) % wide >= d.u0 + d.w OR (i - 1) // wide < d.v0 OR (i - 1) // wide >= d.v0 + d.h THEN 0
     WHEN o = 0 THEN CASE WHEN d.score > 0 THEN 1 ELSE 0 END
     WHEN labels[o] = '5-LOW' AND d.label = '1-URGENT' THEN 0
     WHEN d.score > scores[o] OR d.label = '5-LOW' AND labels[o] = '1-URGENT' THEN 1 ELSE 0 END) END AS won
   FROM step s JOIN d ON d.image_id = s.image_id AND d.rank = s.rank + 1 JOIN e ON e.image_id = s.image_id, g)),
 done AS (SELECT image_id, arg_max(owner, rank) AS owner FROM step GROUP BY image_id),
 px AS (SELECT image_id, unnest(owner) AS rank, CAST(unnest(range(len(owner))) AS BIGINT) AS place FROM done)
"""
RANKED = "r AS (SELECT image_id, det_id, label, score, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, det_id) AS rank FROM detections)"
EARLIER = f"""{PAIRS}, {RANKED}, fits AS (SELECT x.image_id, greatest(x.rank, y.rank) AS rank, least(x.rank, y.rank) AS other, CASE WHEN x.rank < y.rank THEN a ELSE b END AS det, x.label = y.label AS alike, intersection::DOUBLE / (area_a + area_b - intersection) AS iou, greatest(intersection::DOUBLE / area_a, intersection::DOUBLE / area_b) AS containment FROM pairs JOIN r x ON x.det_id = a JOIN r y ON y.det_id = b)"""
NMS = f"""WITH RECURSIVE {EARLIER}, near AS (SELECT image_id, rank, list(other) AS others FROM fits WHERE alike AND iou > 5e-1 GROUP BY ALL), l AS MATERIALIZED (SELECT r.image_id, r.rank, coalesce(others, []) AS others FROM r LEFT JOIN near USING (image_id, rank)),
 step AS (SELECT DISTINCT 0::BIGINT AS rank, image_id, []::BOOLEAN[] AS kept FROM r UNION ALL SELECT l.rank, s.image_id, list_append(kept, len(list_filter(others, lambda o: kept[o])) = 0) FROM step s JOIN l ON l.image_id = s.image_id AND l.rank = s.rank + 1)
 SELECT r.image_id, det_id FROM r JOIN (SELECT image_id, arg_max(kept, rank) AS kept FROM step GROUP BY image_id) USING (image_id) WHERE kept[rank]"""
CLUSTERS = f"""WITH RECURSIVE {EARLIER}, near AS (SELECT image_id, rank, list({{'fit': -greatest(iou, containment), 'det': det, 'other': other}}) AS others FROM fits WHERE iou >= 55e-2 OR containment >= 8e-1 GROUP BY ALL), l AS MATERIALIZED (SELECT r.image_id, r.rank, coalesce(others, []) AS others FROM r LEFT JOIN near USING (image_id, rank)),
 step AS (SELECT DISTINCT 0::BIGINT AS rank, image_id, []::BIGINT[] AS heads FROM r UNION ALL SELECT l.rank, s.image_id, list_append(heads, coalesce(list_sort(list_filter(others, lambda o: heads[o.other] = o.other))[1].other, l.rank)) FROM step s JOIN l ON l.image_id = s.image_id AND l.rank = s.rank + 1)
 SELECT r.image_id, r.det_id, h.det_id AS cluster_id FROM r JOIN (SELECT image_id, arg_max(heads, rank) AS heads FROM step GROUP BY image_id) USING (image_id) JOIN r h ON h.image_id = r.image_id AND h.rank = heads[r.rank]"""
GREEDY = f"""WITH RECURSIVE {PAIRS}, o AS (SELECT det_id, prompt, label, score FROM detections), sided AS (SELECT image_id, a AS vehicle, b AS seen, area_a, area_b, intersection FROM pairs UNION ALL SELECT image_id, b, a, area_a, area_b, intersection FROM pairs),
 fits AS (SELECT vehicle, list({{'fit': -(v.score * (5e-1 + 5e-1 * (intersection::DOUBLE / least(area_a, area_b)))), 'seen': seen, 'label': v.label}}) AS offers FROM sided JOIN o v ON v.det_id = seen JOIN o c ON c.det_id = vehicle WHERE v.prompt = 'F' AND c.prompt = 'O' AND intersection::DOUBLE / least(area_a, area_b) >= 5e-1 GROUP BY vehicle),
 l AS MATERIALIZED (SELECT image_id, det_id, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, det_id) AS rank, coalesce(offers, []) AS offers FROM detections LEFT JOIN fits ON vehicle = det_id WHERE prompt = 'O'),
 step AS (SELECT DISTINCT 0::BIGINT AS rank, image_id, NULL::BIGINT AS det_id, []::BIGINT[] AS used, NULL::BIGINT AS seen, NULL::VARCHAR AS label FROM l
  UNION ALL SELECT rank, image_id, det_id, CASE WHEN pick IS NULL THEN used ELSE list_append(used, pick.seen) END, pick.seen, pick.label FROM (SELECT l.rank, l.image_id, l.det_id, s.used, list_sort(list_filter(offers, lambda x: NOT list_contains(s.used, x.seen)))[1] AS pick FROM step s JOIN l ON l.image_id = s.image_id AND l.rank = s.rank + 1))
 SELECT image_id, det_id, seen AS "view", coalesce(label, 'side') AS orientation FROM step WHERE rank > 0"""


LOW_OVER_URGENT = (("5-LOW", "1-URGENT"),)


def boxed(spark: SparkSession, sf: str) -> DataFrame:
    d = view(spark, sf, "detections")
    return d.select("det_id", "label", ((F.col("u0") - 2) / 40.0).alias("bx"), (F.col("v0") / 30.0).alias("by"), (F.col("w") / 40.0).alias("bw"), (F.col("h") / 30.0).alias("bh"))


def small(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "detections")


@query("fn17_box_metrics", oracle(f"WITH {BOXED}, {METRIC} SELECT det_id, round(bottom, 6) AS bottom, round(aspect, 6) AS aspect, round(area, 6) AS area FROM k", "detections"))
def fn17(spark: SparkSession, sf: str) -> DataFrame:
    m = S.box_metrics("bx", "by", "bw", "bh")
    return boxed(spark, sf).select("det_id", *[F.round(c, 6).alias(n) for n, c in m.items()])


def case(label_rules: dict, conditions: tuple[tuple[str, str], ...]) -> str:
    out = ""
    for label, limits in label_rules.items():
        for (test, reason), limit in zip(conditions, limits):
            if limit is not None:
                out += f" WHEN label = '{label}' AND {test} {limit}::DOUBLE THEN '{reason}'"
    return out


GEO_SQL = case(GEOMETRY, (("bottom <", "bottom_low"), ("bottom >", "bottom_high"), ("aspect <", "aspect_low"), ("aspect >", "aspect_high")))
SIZE_SQL = case(SIZES, (("bw >", "width"), ("bh >", "height"), ("area >", "area")))


@query("flt4_audited_filters", oracle(f"""WITH {BOXED}, {METRIC}, r AS (SELECT det_id, CASE{GEO_SQL} END AS g, CASE{SIZE_SQL} END AS s FROM k)
 SELECT det_id, CASE WHEN g IS NOT NULL THEN 'geometry' WHEN s IS NOT NULL THEN 'size' END AS reject_filter, coalesce(g, s) AS reject_reason FROM r""", "detections"))
def flt4(spark: SparkSession, sf: str) -> DataFrame:
    d = boxed(spark, sf)
    return D.audited(d, D.rule_table(d, GEOMETRY, SIZES)).select("det_id", "reject_filter", "reject_reason")


@query("flt5_score_threshold", oracle("SELECT label, count(*) AS n FROM detections WHERE round(score, 6) >= CASE label WHEN '1-URGENT' THEN 2e-1 WHEN '5-LOW' THEN 5e-2 ELSE 1e-1 END GROUP BY label", "detections"))
def flt5(spark: SparkSession, sf: str) -> DataFrame:
    limits = spark.createDataFrame([("1-URGENT", 0.2), ("5-LOW", 0.05)], "label string, threshold double")
    return D.above_threshold(view(spark, sf, "detections"), limits, 0.1).groupBy("label").agg(F.count("*").alias("n"))


@query("flt6_mask_area", oracle(f"WITH {RUNS} SELECT image_id, det_id, CAST(sum(u1 - u0) AS BIGINT) AS area FROM runs GROUP BY ALL HAVING sum(u1 - u0) >= 30", "detections"))
def flt6(spark: SparkSession, sf: str) -> DataFrame:
    return D.areas(D.runs(small(spark, sf))).where("area >= 30")


@query("joi10_mask_overlap", oracle(f"""WITH {PAIRS} SELECT image_id, a, b, intersection, round(intersection::DOUBLE / (area_a + area_b - intersection), 6) AS iou,
 round(greatest(intersection::DOUBLE / area_a, intersection::DOUBLE / area_b), 6) AS containment, round(intersection::DOUBLE / least(area_a, area_b), 6) AS overlap FROM pairs""", "detections"))
def joi10(spark: SparkSession, sf: str) -> DataFrame:
    p = M.overlaps(D.runs(small(spark, sf)), digits=6)
    return p.select("image_id", "a", "b", "intersection", "iou", "containment", "overlap")


@query("dom16_mask_nms", oracle(NMS, "detections"))
def dom16(spark: SparkSession, sf: str) -> DataFrame:
    d = small(spark, sf)
    return M.suppressed_masks(D.runs(d), d)


@query("dom17_clusters", oracle(CLUSTERS, "detections"))
def dom17(spark: SparkSession, sf: str) -> DataFrame:
    d = small(spark, sf)
    return M.clustered_masks(D.runs(d), d)


@query("joi11_greedy_matches", oracle(GREEDY, "detections"))
def joi11(spark: SparkSession, sf: str) -> DataFrame:
    d = small(spark, sf)
    return M.matched_masks(D.runs(d), d.where("prompt = 'O'"), d.where("prompt = 'F'"))


@query("dom18_composition", oracle("""WITH {PIXELS} SELECT image_id, v, u, top.label AS label, round(-top.neg, 6) AS confidence FROM (SELECT image_id, v, u, list_reduce(list_sort(list({'neg': -score, 'det_id': det_id, 'label': label})),
 lambda a, x: CASE WHEN NOT (a.label = '5-LOW' AND x.label = '1-URGENT') AND (x.neg < a.neg OR x.label = '5-LOW' AND a.label = '1-URGENT') THEN x ELSE a END) AS top FROM px GROUP BY ALL)""".replace("{PIXELS}", PIXELS), "detections"))
def dom18(spark: SparkSession, sf: str) -> DataFrame:
    d = small(spark, sf)
    return M.pixels(M.composed(D.runs(d), d, LOW_OVER_URGENT)).select("image_id", "v", "u", "label", F.round("confidence", 6).alias("confidence"))


@query("dom18_composition_plain", oracle(f"WITH {PIXELS} SELECT image_id, v, u, arg_min(label, (-score, det_id)) AS label, round(max(score), 6) AS confidence FROM px GROUP BY ALL", "detections"))
def dom18_plain(spark: SparkSession, sf: str) -> DataFrame:
    d = small(spark, sf)
    return M.pixels(M.composed(D.runs(d), d, ())).select("image_id", "v", "u", "label", F.round("confidence", 6).alias("confidence"))


@query("dom19_video_composition", oracle(f"WITH {PIXELS} SELECT image_id, v, u, arg_max(label, (score, det_id)) AS label, round(max(score), 6) AS confidence FROM px GROUP BY ALL", "detections"))
def dom19(spark: SparkSession, sf: str) -> DataFrame:
    d = small(spark, sf)
    return M.pixels(M.video_composed(D.runs(d), d)).select("image_id", "v", "u", "label", F.round("confidence", 6).alias("confidence"))


@query("dom22_image_presence", oracle(f"WITH {PIXELS}, w AS (SELECT image_id, v, u, arg_max(label, (score, det_id)) AS label FROM px GROUP BY ALL) SELECT image_id, label, count(*) AS pixels FROM w GROUP BY ALL HAVING count(*) >= 20", "detections"))
def dom22(spark: SparkSession, sf: str) -> DataFrame:
    d = small(spark, sf)
    return M.image_presence(M.video_composed(D.runs(d), d), 20)


@query("agg17_mask_geometry", oracle("""SELECT image_id, det_id, u0 AS min_u, u0 + w AS max_u, v0 AS min_v, v0 + h AS max_v, w * h AS area, round(u0 + (w - 1) / 2e0, 6) AS cu, round(v0 + (h - 1) / 2e0, 6) AS cv,
 1e0 AS fill, 2 * (w + h) AS perimeter FROM detections""", "detections"))
def agg17(spark: SparkSession, sf: str) -> DataFrame:
    g = D.mask_geometry(D.runs(small(spark, sf)))
    return g.withColumns({"cu": F.round("cu", 6), "cv": F.round("cv", 6), "fill": F.round("fill", 6)})


VALUES = {
    "bbox_x0": "u0 / 80e0", "bbox_y0": "v0 / 40e0", "bbox_x1": "(u0 + w) / 80e0", "bbox_y1": "(v0 + h) / 40e0", "bbox_center_x": "(u0 + w / 2e0) / 80", "bbox_center_y": "(v0 + h / 2e0) / 40", "bbox_bottom": "(v0 + h) / 40e0",
    "bbox_width": "w / 80e0", "bbox_height": "h / 40e0", "bbox_area": "w * h / 32e2", "bbox_aspect_ratio": "w / h::DOUBLE", "mask_centroid_x": "(u0 + (w - 1) / 2e0) / 80", "mask_centroid_y": "(v0 + (h - 1) / 2e0) / 40", "mask_area": "w * h / 32e2",
    "mask_bbox_fill_ratio": "1e0", "mask_compactness": "4 * pi() * w * h / power(2 * (w + h), 2)", "touches_left": "CASE WHEN u0 = 0 THEN 1e0 ELSE 0e0 END", "touches_top": "CASE WHEN v0 = 0 THEN 1e0 ELSE 0e0 END", "touches_right": "CASE WHEN u0 + w = 80 THEN 1e0 ELSE 0e0 END",
    "touches_bottom": "CASE WHEN v0 + h = 40 THEN 1e0 ELSE 0e0 END", "distance_to_center": "sqrt(power((u0 + w / 2e0) / 80 - 5e-1, 2) + power((v0 + h / 2e0) / 40 - 5e-1, 2))", "distance_to_left": "u0 / 80e0", "distance_to_top": "v0 / 40e0",
    "distance_to_right": "(80 - u0 - w) / 80e0", "distance_to_bottom": "(40 - v0 - h) / 40e0",
}


@query("agg17_mask_values", oracle(f"SELECT image_id, det_id, {', '.join(f'round({v}, 6) AS {n}' for n, v in VALUES.items())} FROM detections", "detections"))
def agg17_values(spark: SparkSession, sf: str) -> DataFrame:
    g = D.mask_values(D.mask_geometry(D.runs(small(spark, sf))), 80, 40)
    return g.select("image_id", "det_id", *[F.round(n, 6).alias(n) for n in VALUES])


LABELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("agg19_prompt_scores", oracle(f"""WITH w AS (SELECT image_id, {', '.join(f"coalesce(max(score) FILTER (label = '{n}'), 0e0) AS s{i}" for i, n in enumerate(LABELS))} FROM detections GROUP BY image_id),
 z AS (SELECT *, list_reverse_sort([s0, s1, s2, s3, s4]) AS l FROM w)
 SELECT image_id, round(l[1], 6) AS top_score, round(l[1] - l[2], 6) AS margin, CASE l[1] WHEN s0 THEN '1-URGENT' WHEN s1 THEN '2-HIGH' WHEN s2 THEN '3-MEDIUM' WHEN s3 THEN '4-NOT SPECIFIED' ELSE '5-LOW' END AS top_label FROM z""", "detections"))
def agg19(spark: SparkSession, sf: str) -> DataFrame:
    p = D.prompt_scores(view(spark, sf, "detections"), LABELS)
    return p.select("image_id", F.round("top_score", 6).alias("top_score"), F.round("margin", 6).alias("margin"), "top_label")


@query("srt3_candidate_order", oracle("SELECT image_id, det_id, row_number() OVER (PARTITION BY image_id ORDER BY v0, u0, score DESC, det_id) AS place FROM detections", "detections"))
def srt3(spark: SparkSession, sf: str) -> DataFrame:
    d = small(spark, sf)
    return D.candidate_order(D.runs(d), d).select("image_id", "det_id", "place")


@query("fn25_padded_box", oracle("""SELECT det_id, greatest(0, CAST(floor(u0 - w * 2e-1) AS BIGINT)) AS px0, greatest(0, CAST(floor(v0 - h * 2e-1) AS BIGINT)) AS py0,
 least(48, CAST(ceil(u0 + w + w * 2e-1) AS BIGINT)) AS px1, least(36, CAST(ceil(v0 + h + h * 2e-1) AS BIGINT)) AS py1 FROM detections""", "detections"))
def fn25(spark: SparkSession, sf: str) -> DataFrame:
    d = view(spark, sf, "detections").withColumns({"x1": F.col("u0") + F.col("w"), "y1": F.col("v0") + F.col("h")})
    return d.select("det_id", *[c.alias(n) for n, c in S.padded_box("u0", "v0", "x1", "y1", 0.2, 48, 36).items()])


@query("fn24_split_circle", oracle("SELECT det_id, (u0 - 20) * (u0 - 20) + (v0 - 15) * (v0 - 15) <= CASE WHEN v0 < 15 THEN 100 ELSE 225 END AS inside FROM detections", "detections"))
def fn24(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "detections").select("det_id", S.in_split_circle("u0", "v0", (20.0, 15.0), 10.0, 15.0).alias("inside"))


@query("dom18_composition_least_area", oracle(PAINTED + """ SELECT px.image_id, place // wide AS v, place % wide AS u, label, round(score, 6) AS confidence FROM px JOIN d ON d.image_id = px.image_id AND d.rank = px.rank, g""", "detections"))
def dom18_least(spark: SparkSession, sf: str) -> DataFrame:
    d = small(spark, sf)
    return M.pixels(M.composed(D.runs(d), d, LOW_OVER_URGENT, 40)).select("image_id", "v", "u", "label", F.round("confidence", 6).alias("confidence"))


@query("flt2_geometry_rules", oracle(f"WITH {BOXED}, {METRIC} SELECT det_id, CASE{GEO_SQL} END AS reject_reason FROM k", "detections"))
def flt2(spark: SparkSession, sf: str) -> DataFrame:
    d = boxed(spark, sf)
    return D.audited(d, D.rule_table(d, GEOMETRY, {})).select("det_id", "reject_reason")


@query("flt3_size_rules", oracle(f"WITH {BOXED}, {METRIC} SELECT det_id, CASE{SIZE_SQL} END AS reject_reason FROM k", "detections"))
def flt3(spark: SparkSession, sf: str) -> DataFrame:
    d = boxed(spark, sf)
    return D.audited(d, D.rule_table(d, {}, SIZES)).select("det_id", "reject_reason")


@query("udf3_callers_rules", oracle(f"WITH {BOXED}, {METRIC} SELECT det_id, CASE WHEN label = '4-NOT SPECIFIED' AND bh > 1e-1 THEN 'height' END AS reject_reason FROM k", "detections"))
def udf3(spark: SparkSession, sf: str) -> DataFrame:
    d = boxed(spark, sf)
    return D.audited(d, D.rule_table(d, {}, {"4-NOT SPECIFIED": (None, 0.1, None)})).select("det_id", "reject_reason")


@query("udf2_detector", oracle("SELECT image_id, CAST(sum(w) AS BIGINT) AS width, 'box' AS label, count(*) AS n FROM detections GROUP BY image_id", "detections"))
def udf2(spark: SparkSession, sf: str) -> DataFrame:
    from pointloom.sources.sinks import detector

    seen = detector(small(spark, sf).select("image_id", "w"), lambda part: part.assign(label="box"), "image_id bigint, w bigint, label string")
    return seen.groupBy("image_id", "label").agg(F.sum("w").alias("width"), F.count("*").alias("n"))
