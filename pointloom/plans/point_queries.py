"""Queries over points and pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointloom.functions import scalars as S
from pointloom.operators import echo, evaluation, manifests, teacher
from pointloom.plans.registry import query
from pointloom.plans.views import oracle, view

KEY = ("frame_ord", "row_idx")
VALID = "(sqrt(x*x + y*y + z*z) > 1e-8)"

# The noise rules stated a second time, as plain SQL over the features, for the oracle.
ECHO = f"""
e0 AS (SELECT *, {VALID} AS echo_valid FROM points),
e AS (SELECT *,
  CASE WHEN echo_valid THEN count(*) OVER k ELSE 0 END AS return_count,
  CASE WHEN echo_valid THEN row_number() OVER o - 1 ELSE 0 END AS return_rank,
  CASE WHEN echo_valid THEN coalesce(least(distance - lag(distance) OVER o, lead(distance) OVER o - distance), 0e0) ELSE 0e0 END AS nearest_gap,
  CASE WHEN echo_valid THEN intensity - max(intensity) OVER k ELSE 0e0 END AS strongest_delta
  FROM e0 WINDOW k AS (PARTITION BY frame_ord, slot, pixel, echo_valid), o AS (PARTITION BY frame_ord, slot, pixel, echo_valid ORDER BY distance, row_idx))"""
DENSITY = """
b AS (SELECT *, CAST(floor(azimuth / 5e-1) AS BIGINT) AS bin_a, CAST(floor(vertical / 5e-1) AS BIGINT) AS bin_v FROM e),
cells AS (SELECT frame_ord, bin_a, bin_v, count(*) AS cell FROM b GROUP BY ALL),
near AS (SELECT c.frame_ord, c.bin_a, c.bin_v, CAST(sum(n.cell) AS BIGINT) AS density FROM cells c JOIN cells n ON n.frame_ord = c.frame_ord AND abs(n.bin_a - c.bin_a) <= 1 AND abs(n.bin_v - c.bin_v) <= 1 GROUP BY ALL),
lines AS (SELECT frame_ord, bin_a, bin_v, CAST(sum(cell) OVER (PARTITION BY frame_ord, bin_v) AS BIGINT) AS row_count, CAST(sum(cell) OVER (PARTITION BY frame_ord, bin_a) AS BIGINT) AS col_count FROM cells),
d AS (SELECT b.*, density, row_count, col_count FROM b JOIN near USING (frame_ord, bin_a, bin_v) JOIN lines USING (frame_ord, bin_a, bin_v))"""
THRESHOLDS = """
t AS (SELECT frame_ord, greatest(80e0, quantile_cont(distance, 0.98)) AS far_from, greatest(12e0, quantile_cont(greatest(row_count, col_count)::DOUBLE, 0.90)) AS line_from,
  least(-25e-2, quantile_cont(z, 0.05) - 15e-2) AS below_to FROM d GROUP BY frame_ord)"""
SUPPORT = """
near_rows AS (SELECT frame_ord, slot, pixel, list(distance) AS ds FROM points GROUP BY ALL),
s AS (SELECT p.frame_ord, p.row_idx, CAST((a.ds IS NOT NULL)::INT + (z.ds IS NOT NULL)::INT AS BIGINT) AS checked,
  CAST(coalesce(len(list_filter(a.ds, lambda q: round(abs(q - p.distance), 6) <= 75e-2)) > 0, false)::INT + coalesce(len(list_filter(z.ds, lambda q: round(abs(q - p.distance), 6) <= 75e-2)) > 0, false)::INT AS BIGINT) AS support
  FROM points p LEFT JOIN near_rows a ON a.frame_ord = p.frame_ord - 1 AND a.slot = p.slot AND a.pixel = p.pixel LEFT JOIN near_rows z ON z.frame_ord = p.frame_ord + 1 AND z.slot = p.slot AND z.pixel = p.pixel)"""
MASKED = """
pix AS (SELECT frame_ord, row_idx, CAST(floor(cxd + 5e-1) AS BIGINT) AS u, CAST(floor(cyd + 5e-1) AS BIGINT) AS v FROM points),
m AS (SELECT a.frame_ord, a.row_idx, a.u, a.v, CASE WHEN x.confidence >= 7e-1 AND x.label <> 0 THEN x.label ELSE 255 END AS mask_label, CASE WHEN x.confidence >= 7e-1 AND x.label <> 0 THEN x.confidence ELSE 0e0 END AS mask_conf,
  CASE WHEN a.u IS NULL OR a.v IS NULL THEN CASE WHEN a.u IS NULL THEN 'no_pixel' ELSE 'outside' END WHEN x.label IS NULL THEN 'outside' WHEN x.confidence >= 7e-1 AND x.label <> 0 THEN 'kept' ELSE 'unsure' END AS mask_reason
  FROM pix a LEFT JOIN pixels x ON x.u = a.u AND x.v = a.v)"""
EDGE = """
edge AS (SELECT p.u, p.v, p.label, p.label <> 0 AND EXISTS (SELECT 1 FROM pixels q WHERE abs(q.u - p.u) + abs(q.v - p.v) = 1 AND q.label <> p.label) AS boundary FROM pixels p)"""


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("fn1_valid_returns", oracle(f"SELECT frame_ord, row_idx, {VALID} AS valid, (greatest(abs(x), abs(y), abs(z)) >= 1e-4) AS trainable FROM points", "points"))
def fn1(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "points").select(*KEY, S.valid_return().alias("valid"), S.valid_training_point().alias("trainable"))


@query("fn3_unit_range", oracle("SELECT frame_ord, row_idx, round(CASE WHEN max(intensity) OVER (PARTITION BY frame_ord) > 1 THEN intensity / 255 ELSE intensity END, 6) AS unit FROM points", "points"))
def fn3(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "points").select(*KEY, F.round(S.unit_range("intensity"), 6).alias("unit"))


@query("fn4_pixel_rounding", oracle("SELECT frame_ord, row_idx, CAST(floor(cxd + 5e-1) AS BIGINT) AS u, CAST(ceil(-cyd - 5e-1) AS BIGINT) AS v FROM points", "points"))
def fn4(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "points").select(*KEY, S.half_away("cxd").alias("u"), S.half_away(-F.col("cyd")).alias("v"))


K, T = (500.0, 0.0, 320.0, 0.0, 500.0, 240.0, 0.0, 0.0, 1.0), (0.0, -1.0, 0.0, 0.1, 0.0, 0.0, -1.0, 0.2, 1.0, 0.0, 0.0, 0.3, 0.0, 0.0, 0.0, 1.0)


@query("fn5_projection", oracle("""
WITH c AS (SELECT frame_ord, row_idx, -y + 1e-1 AS a, -z + 2e-1 AS b, x + 3e-1 AS depth FROM points),
p AS (SELECT *, CAST(round_even((500e0 * a + 320e0 * depth) / depth, 0) AS BIGINT) AS u, CAST(round_even((500e0 * b + 240e0 * depth) / depth, 0) AS BIGINT) AS v FROM c WHERE depth > 0)
SELECT frame_ord, row_idx, round(depth, 6) AS depth, u, v FROM p WHERE u >= 0 AND u < 640 AND v >= 0 AND v < 480""", "points"))
def fn5(spark: SparkSession, sf: str) -> DataFrame:
    seen = S.projected(view(spark, sf, "points"), K, T, 640, 480).where("inside")
    return seen.select(*KEY, F.round("depth", 6).alias("depth"), "u", "v")


@query("win2_visible", oracle("""
WITH c AS (SELECT frame_ord, row_idx, CAST(floor(cxd) AS BIGINT) AS u, CAST(floor(cyd) AS BIGINT) AS v, distance FROM points WHERE cxd IS NOT NULL)
SELECT frame_ord, row_idx, u, v, abs(distance - min(distance) OVER w) <= 1e-8 + 1e-5 * abs(min(distance) OVER w) AS visible FROM c WINDOW w AS (PARTITION BY frame_ord, u, v)""", "points"))
def win2(spark: SparkSession, sf: str) -> DataFrame:
    p = view(spark, sf, "points").where("cxd IS NOT NULL").select(*KEY, F.floor("cxd").alias("u"), F.floor("cyd").alias("v"), "distance")
    return echo.visible(p, ["frame_ord", "u", "v"], "distance").select(*KEY, "u", "v", "visible")


@query("flt1_primary_returns", oracle("SELECT frame_ord, count(*) AS points, round(avg(distance), 6) AS mean_distance FROM points WHERE block_id = 0 GROUP BY frame_ord", "points"))
def flt1(spark: SparkSession, sf: str) -> DataFrame:
    return echo.primary_returns(view(spark, sf, "points")).groupBy("frame_ord").agg(F.count("*").alias("points"), F.round(F.avg("distance"), 6).alias("mean_distance"))


@query("win1_echo_features", oracle(f"WITH {ECHO} SELECT frame_ord, row_idx, return_count, return_rank, round(nearest_gap, 6) AS nearest_gap, round(strongest_delta, 6) AS strongest_delta FROM e", "points"))
def win1(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(echo.echo_features(view(spark, sf, "points")), "nearest_gap", "strongest_delta").select(*KEY, "return_count", "return_rank", "nearest_gap", "strongest_delta")


@query("agg2_return_statistics", oracle(f"WITH {ECHO} SELECT frame_ord, CAST(sum(return_count) AS BIGINT) AS return_count, CAST(sum(return_rank) AS BIGINT) AS return_rank, count(*) AS rows FROM e GROUP BY ROLLUP (frame_ord)", "points"))
def agg2(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.run_summary(echo.echo_features(view(spark, sf, "points")), "frame_ord", "return_count", "return_rank")


@query("joi8_echo_context", oracle(f"""
WITH {ECHO}, f AS (SELECT frame_ord, row_idx, block_id, first_value(return_count) OVER w AS ctx_count, first_value(return_rank) OVER w AS ctx_rank FROM e WINDOW w AS (PARTITION BY frame_ord, slot, pixel ORDER BY block_id <> 0, row_idx))
SELECT frame_ord, row_idx, ctx_count, ctx_rank FROM f WHERE block_id = 0""", "points"))
def joi8(spark: SparkSession, sf: str) -> DataFrame:
    p = view(spark, sf, "points")
    return echo.echo_context(echo.primary_returns(p), echo.echo_features(p)).select(*KEY, "ctx_count", "ctx_rank")


@query("win9_density", oracle(f"WITH {ECHO}, {DENSITY} SELECT frame_ord, row_idx, density, row_count, col_count FROM d", "points"))
def win9(spark: SparkSession, sf: str) -> DataFrame:
    return echo.angular_density(view(spark, sf, "points")).select(*KEY, "density", "row_count", "col_count")


@query("win8_thresholds", oracle(f"WITH {ECHO}, {DENSITY}, {THRESHOLDS} SELECT frame_ord, round(far_from, 6) AS far_from, round(line_from, 6) AS line_from, round(below_to, 6) AS below_to FROM t", "points"))
def win8(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(echo.frame_thresholds(view(spark, sf, "points")), "far_from", "line_from", "below_to")


@query("joi7_temporal_support", oracle(f"WITH {SUPPORT} SELECT * FROM s", "points"))
def joi7(spark: SparkSession, sf: str) -> DataFrame:
    return echo.temporal_support(view(spark, sf, "points")).select(*KEY, "checked", "support")


@query("joi1_mask_labels", oracle(f"WITH {MASKED} SELECT frame_ord, row_idx, mask_label, round(mask_conf, 6) AS mask_conf, mask_reason FROM m", "points", "pixels"))
def joi1(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(echo.mask_labels(view(spark, sf, "points"), view(spark, sf, "pixels")), "mask_conf").select(*KEY, "mask_label", "mask_conf", "mask_reason")


@query("win3_mask_boundary", oracle(f"WITH {EDGE} SELECT u, v, label, boundary FROM edge", "pixels"))
def win3(spark: SparkSession, sf: str) -> DataFrame:
    return echo.mask_boundary(view(spark, sf, "pixels")).select("u", "v", "label", "boundary")


@query("agg30_strongest_pixel", oracle("SELECT frame_ord, CAST(round_even(cxd, 0) AS BIGINT) AS u, CAST(round_even(cyd, 0) AS BIGINT) AS v, round(max(model_conf), 6) AS strongest, count(*) AS points FROM points WHERE cxd IS NOT NULL GROUP BY ALL", "points"))
def agg30(spark: SparkSession, sf: str) -> DataFrame:
    p = view(spark, sf, "points").where("cxd IS NOT NULL").withColumns({"u": S.half_even("cxd"), "v": S.half_even("cyd")})
    return rounded(echo.strongest_per_pixel(p, ["frame_ord", "u", "v"], "model_conf"), "strongest")


@query("agg13_extents", oracle("SELECT frame_ord, round(max(greatest(abs(x), abs(y))), 6) AS max_abs_xy, round(max(sqrt(x*x + y*y + z*z)), 6) AS max_range FROM points GROUP BY frame_ord", "points"))
def agg13(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(echo.extents(view(spark, sf, "points")), "max_abs_xy", "max_range")


@query("dom1_feature_sums", oracle(f"WITH {ECHO} SELECT frame_ord, round(sum(x), 1) AS x, round(sum(reflectivity), 1) AS reflectivity, CAST(sum(return_count) AS DOUBLE) AS returns, CAST(13 AS BIGINT) AS width FROM e GROUP BY frame_ord", "points"))
def dom1(spark: SparkSession, sf: str) -> DataFrame:
    f = echo.feature_vector(view(spark, sf, "points"))
    part = lambda k: F.element_at("features", k)
    return f.groupBy("frame_ord").agg(
        F.round(F.sum(part(1)), 1).alias("x"), F.round(F.sum(part(8)), 1).alias("reflectivity"), F.sum(part(9)).alias("returns"), F.max(F.size("features")).cast("bigint").alias("width")
    )


def rule_sql() -> str:
    """The rules of the teacher as SQL over ``g``, from their fixed values."""
    flag = {
        "iso": "density <= 3", "alone": "density <= 1", "low": "round(intensity / 255, 6) <= 8e-2", "vlow": "round(intensity / 255, 6) <= 3e-2", "lref": "round(reflectivity / 255, 6) <= 8e-2",
        "trans": "checked > 0 AND support = 0", "stab": "support > 0", "noproj": "cxd IS NULL OR cyd IS NULL", "single": "return_count <= 1", "multi": "return_count >= 2", "three": "return_count >= 3",
        "sec": "return_rank > 0", "gap": "round(nearest_gap, 6) >= 3e-1", "sgap": "round(nearest_gap, 6) >= 1", "secsgap": "return_rank > 0 AND round(nearest_gap, 6) >= 1", "weak": "round(strongest_delta / 255, 6) <= -5e-2",
        "below": "round(z, 6) <= round(below_to, 6)", "line": "greatest(row_count, col_count) >= line_from", "far": "round(distance, 6) >= round(far_from, 6)", "near": "round(distance, 6) <= 25e-1",
    }
    noise = ", ".join(map(str, teacher.NOISE_IDS.values()))
    ctx = f"CASE WHEN mask_label <> 255 THEN -6e-2 ELSE 0e0 END + CASE WHEN boundary THEN -8e-2 ELSE 0e0 END + CASE WHEN model_label IN ({noise}) AND round(model_conf, 6) >= 5e-1 THEN 8e-2 ELSE 0e0 END + CASE WHEN model_label NOT IN ({noise}, 255) AND round(model_conf, 6) >= 7e-1 THEN -5e-2 ELSE 0e0 END"
    cols = []
    for name, base, weights, gates, steady in teacher.RULES:
        parts = [f"{base:.2f}::DOUBLE"] + [f"CASE WHEN {flag[k]} THEN {w:.2f}::DOUBLE ELSE 0e0 END" for k, w in weights.items()] + [ctx] + [f"CASE WHEN {flag['stab']} THEN -10e-2 ELSE 0e0 END"] * steady
        gate = " AND ".join([VALID] + ["(" + " OR ".join(f"({flag[k]})" for k in ((g,) if isinstance(g, str) else g)) + ")" for g in gates])
        cols.append(f"CASE WHEN {gate} THEN round(greatest(0e0, least(98e-2, {' + '.join(parts)})), 6) ELSE 0e0 END AS s_{name}")
    return ", ".join(cols)


FEATURES = f"""{ECHO}, {DENSITY}, {THRESHOLDS}, {SUPPORT}, {MASKED}, {EDGE},
g AS (SELECT d.*, far_from, line_from, below_to, checked, support, m.mask_label, m.mask_conf, coalesce(edge.boundary, false) AND m.mask_label <> 255 AS boundary
  FROM d JOIN t USING (frame_ord) JOIN s USING (frame_ord, row_idx) JOIN m USING (frame_ord, row_idx) LEFT JOIN edge ON edge.u = m.u AND edge.v = m.v),
r AS (SELECT *, {rule_sql()} FROM g)"""


def best_sql(classes: tuple[int, ...] = (1, 2, 5, 7, 11)) -> str:
    names = list(teacher.NOISE_IDS)
    top = "greatest(" + ", ".join(f"s_{n}" for n in names) + ")"
    label = "CASE " + " ".join(f"WHEN s_{n} = {top} THEN {i}" for n, i in teacher.NOISE_IDS.items()) + " END"
    rule = "CASE " + " ".join(f"WHEN s_{n} = {top} THEN '{n}'" for n in names) + " END"
    mask = "round(65e-2 * mask_conf * CASE WHEN boundary THEN 5e-1 ELSE 1e0 END, 6)"
    context = f"mask_label IN ({', '.join(map(str, classes))}) AND {mask} >= 35e-2"
    return f"""SELECT frame_ord, row_idx, CAST(CASE WHEN {top} >= 35e-2 THEN {label} WHEN {context} THEN mask_label ELSE 255 END AS BIGINT) AS label,
 CASE WHEN {top} >= 35e-2 THEN {top} WHEN {context} THEN {mask} ELSE 0e0 END AS confidence, CASE WHEN {top} >= 35e-2 THEN {rule} WHEN {context} THEN 'object_context' END AS rule FROM r"""


def scores(spark: SparkSession, sf: str) -> DataFrame:
    return teacher.rule_scores(teacher.teacher_features(view(spark, sf, "points"), view(spark, sf, "pixels"), teacher.early_flags()))


@query("dom3_rule_scores", oracle(f"WITH {FEATURES} SELECT frame_ord, row_idx, {', '.join(f's_{n}' for n in teacher.NOISE_IDS)} FROM r", "points", "pixels"))
def dom3(spark: SparkSession, sf: str) -> DataFrame:
    return scores(spark, sf).select(*KEY, *[f"s_{n}" for n in teacher.NOISE_IDS])


@query("dom5_noise_candidates", oracle(f"WITH {FEATURES} {best_sql()}", "points", "pixels"))
def dom5(spark: SparkSession, sf: str) -> DataFrame:
    return teacher.candidates(scores(spark, sf)).select(*KEY, "label", "confidence", "rule")


@query("dom5_rule_counts", oracle(f"WITH {FEATURES} " + " UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) AS candidates FROM r WHERE s_{n} >= 35e-2 HAVING count(*) > 0" for n in teacher.NOISE_IDS), "points", "pixels"))
def dom5_counts(spark: SparkSession, sf: str) -> DataFrame:
    return teacher.candidates(scores(spark, sf)).select(F.explode("rules").alias("rule")).groupBy("rule").agg(F.count("*").alias("candidates"))


FUSED = """sure AS (SELECT u, v, label, confidence FROM pixels WHERE confidence >= 7e-1 AND label <> 0),
m2 AS (SELECT p.frame_ord, p.row_idx, p.model_label, p.model_conf, coalesce(x.label, 255) AS camera_label, coalesce(x.confidence, 0e0) AS camera_conf FROM points p LEFT JOIN sure x ON x.u = CAST(floor(p.cxd + 5e-1) AS BIGINT) AND x.v = CAST(floor(p.cyd + 5e-1) AS BIGINT)),
q AS (SELECT *, camera_label <> 255 AND camera_conf >= 7e-1 AND camera_label <> 0 AS ok, model_label BETWEEN 20 AND 26 AND round(model_conf, 6) >= 4e-1 AS prot FROM m2),
w AS (SELECT *, ok AND (model_label = 255 OR round(model_conf, 6) < 6e-1) AND NOT prot AS fill FROM q),
z AS (SELECT *, ok AND NOT fill AND NOT prot AND model_label <> camera_label AND round(camera_conf, 6) >= round(round(model_conf, 6) + 2e-1, 6) AS over_ FROM w),
f AS (SELECT frame_ord, row_idx, CASE WHEN fill OR over_ THEN camera_label ELSE model_label END AS label, CASE WHEN fill OR over_ THEN camera_conf ELSE model_conf END AS conf, CASE WHEN fill THEN 2 WHEN over_ THEN 3 WHEN prot THEN 4 ELSE 1 END AS prov FROM z)"""


@query("dom9_fusion", oracle(f"WITH {FUSED} SELECT frame_ord, row_idx, label, round(CASE WHEN label = 255 THEN 0e0 ELSE conf END, 6) AS confidence, CAST(CASE WHEN label = 255 THEN 0 ELSE prov END AS BIGINT) AS provenance FROM f", "points", "pixels"))
def dom9(spark: SparkSession, sf: str) -> DataFrame:
    masked = echo.mask_labels(view(spark, sf, "points"), view(spark, sf, "pixels")).withColumnsRenamed({"mask_label": "camera_label", "mask_conf": "camera_conf"})
    return rounded(teacher.fused(masked), "confidence").select(*KEY, "label", "confidence", "provenance")


@query("agg1_label_counts", oracle("SELECT frame_ord, gt, count(*) AS points FROM points WHERE gt <> 255 GROUP BY ALL", "points"))
def agg1(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.label_counts(view(spark, sf, "points"), ["frame_ord"], "gt", (255,))


CONFUSION = "cm AS (SELECT gt, model_label AS pred, count(*) AS n FROM points WHERE gt <> 255 GROUP BY ALL)"
METRICS = f"""{CONFUSION}, rs AS (SELECT gt AS label, sum(n) AS support, sum(CASE WHEN gt = pred THEN n ELSE 0 END) AS tp FROM cm GROUP BY gt), cs AS (SELECT pred AS label, sum(n) AS predicted FROM cm GROUP BY pred),
b AS (SELECT label, coalesce(support, 0) AS support, coalesce(tp, 0) AS tp, coalesce(predicted, 0) AS predicted FROM rs FULL JOIN cs USING (label)),
k AS (SELECT label, CAST(support AS BIGINT) AS support, CAST(tp AS BIGINT) AS tp, CAST(predicted AS BIGINT) AS predicted, CAST(predicted - tp AS BIGINT) AS fp, CAST(support - tp AS BIGINT) AS fn,
 coalesce(tp::DOUBLE / nullif(support + predicted - tp, 0), 0) AS iou, coalesce(tp::DOUBLE / nullif(predicted, 0), 0) AS "precision", coalesce(tp::DOUBLE / nullif(support, 0), 0) AS recall FROM b),
x AS (SELECT *, coalesce(2 * "precision" * recall / nullif("precision" + recall, 0), 0) AS f1 FROM k)"""


def matrix(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.confusion(view(spark, sf, "points"), "gt", "model_label")


@query("agg3_confusion", oracle(f"WITH {CONFUSION} SELECT * FROM cm", "points"))
def agg3(spark: SparkSession, sf: str) -> DataFrame:
    return matrix(spark, sf)


@query("agg4_class_metrics", oracle(f'WITH {METRICS} SELECT label, support, tp, predicted, fp, fn, round(iou, 6) AS iou, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1 FROM x', "points"))
def agg4(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.class_metrics(matrix(spark, sf)), "iou", "precision", "recall", "f1")


@query("agg4_overall", oracle(f"""WITH {METRICS} SELECT round(sum(tp)::DOUBLE / sum(support), 6) AS accuracy, round(avg(iou), 6) AS miou, round(avg(CASE WHEN support > 0 THEN iou END), 6) AS miou_supported,
 round(sum(iou * support) / sum(support), 6) AS fw_iou, round(avg("precision"), 6) AS mean_precision, round(avg(recall), 6) AS mean_recall, round(avg(f1), 6) AS mean_f1 FROM x""", "points"))
def agg4_overall(spark: SparkSession, sf: str) -> DataFrame:
    out = evaluation.overall_metrics(evaluation.class_metrics(matrix(spark, sf)))
    return rounded(out, *out.columns)


@query("agg5_confusion_pivot", oracle(f"""WITH {CONFUSION}, w AS (SELECT gt, {', '.join(f'CAST(sum(CASE WHEN pred = {c} THEN n ELSE 0 END) AS BIGINT) AS pred_{c}' for c in (2, 5, 20))} FROM cm GROUP BY gt)
 SELECT *, {', '.join(f'round(pred_{c}::DOUBLE / (pred_2 + pred_5 + pred_20), 6) AS share_{c}' for c in (2, 5, 20))} FROM w""", "points"))
def agg5(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.confusion_pivot(matrix(spark, sf), [2, 5, 20]), "share_2", "share_5", "share_20")


@query("agg6_frame_metrics", oracle("""SELECT frame_ord, count(*) AS points, count(*) FILTER (gt <> 255) AS valid, count(*) FILTER (gt = 255) AS ignored, count(*) FILTER (gt <> 255 AND gt = model_label) AS correct,
 round(coalesce(count(*) FILTER (gt <> 255 AND gt = model_label)::DOUBLE / nullif(count(*) FILTER (gt <> 255), 0), 0), 6) AS accuracy FROM points GROUP BY frame_ord""", "points"))
def agg6(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.frame_metrics(view(spark, sf, "points"), prediction="model_label"), "accuracy")


@query("agg29_label_distribution", oracle("SELECT model_label, count(*) AS points, round(avg(model_conf), 6) AS mean_confidence, round(100e0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM points GROUP BY model_label", "points"))
def agg29(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.label_distribution(view(spark, sf, "points"), "model_label", "model_conf"), "mean_confidence", "percent")


@query("agg31_mismatches", oracle(f"WITH {CONFUSION} SELECT * FROM cm WHERE gt <> pred ORDER BY n DESC, gt, pred LIMIT 30", "points"))
def agg31(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.mismatches(matrix(spark, sf))


@query("srt1_report_order", oracle(f"WITH {METRICS} SELECT label, support, round(iou, 6) AS iou FROM x ORDER BY support > 0 DESC, support DESC, label LIMIT 2", "points"))
def srt1(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.report_order(evaluation.class_metrics(matrix(spark, sf)), 2), "iou").select("label", "support", "iou")


@query("agg14_dropped_points", oracle(f"SELECT frame_ord, CASE WHEN NOT {VALID} THEN 'invalid_xyz' WHEN gt = 255 THEN 'unknown_label' ELSE 'kept' END AS reason, count(*) AS points FROM points GROUP BY ALL", "points"))
def agg14(spark: SparkSession, sf: str) -> DataFrame:
    return manifests.dropped_points(view(spark, sf, "points"), S.valid_return(), F.col("gt") != 255)


TAX = "c AS (SELECT gt, CAST(count(*) FILTER (frame_ord % 5 <> 0) AS BIGINT) AS n FROM points WHERE gt <> 255 GROUP BY gt UNION ALL SELECT 31, 0)"


@query("dom11_taxonomy", oracle(f"WITH {TAX}, k AS (SELECT gt, CAST(row_number() OVER (ORDER BY gt) - 1 AS BIGINT) AS train_id FROM c WHERE n > 0) SELECT c.gt, c.n, train_id, CASE WHEN train_id IS NULL THEN 'no_training_points' END AS reason FROM c LEFT JOIN k USING (gt)", "points"))
def dom11(spark: SparkSession, sf: str) -> DataFrame:
    p = view(spark, sf, "points").where("gt <> 255")
    counts = p.groupBy("gt").agg(F.count_if(F.col("frame_ord") % 5 != 0).alias("n"))
    return manifests.taxonomy(counts.union(spark.sql("SELECT CAST(31 AS BIGINT), CAST(0 AS BIGINT)")), "gt", "n")


@query("agg11_class_weights", oracle("""
WITH c AS (SELECT gt, count(*) AS n FROM points WHERE gt <> 255 GROUP BY gt), s AS (SELECT *, sum(n) OVER () / (count(*) OVER () * n) AS share FROM c), w AS (SELECT *, least(10e0, greatest(1e-1, sqrt(share))) AS w FROM s)
SELECT gt, n, round(w / avg(w) OVER (), 6) AS weight, round(share / avg(share) OVER (), 6) AS inverse_weight FROM w""", "points"))
def agg11(spark: SparkSession, sf: str) -> DataFrame:
    return manifests.class_weights(evaluation.label_counts(view(spark, sf, "points"), [], "gt", (255,)), "gt", "points").withColumnRenamed("points", "n")


@query("dom15_oversample", oracle("WITH f AS (SELECT frame_ord, bool_or(model_label = 20 AND pkey % 97 = 0) AS noisy FROM points GROUP BY frame_ord) SELECT frame_ord, CAST(unnest(range(1, CASE WHEN noisy THEN 4 ELSE 2 END)) AS BIGINT) AS copy FROM f", "points"))
def dom15(spark: SparkSession, sf: str) -> DataFrame:
    frames = view(spark, sf, "points").groupBy("frame_ord").agg(F.bool_or((F.col("model_label") == 20) & (F.col("pkey") % 97 == 0)).alias("noisy"))
    return manifests.oversampled(frames, F.col("noisy"), 3).select("frame_ord", "copy")


CLAIMS = "SELECT frame_ord, row_idx % 40 AS row_idx, row_idx AS object_index, gt AS label, CAST(CASE WHEN gt = 2 THEN 50 WHEN gt = 5 THEN 70 ELSE 5 END AS BIGINT) AS priority FROM points"


@query("dom10_manual_labels", oracle(f"""
WITH a AS ({CLAIMS}), r AS (SELECT *, row_number() OVER (PARTITION BY frame_ord, row_idx ORDER BY priority DESC, object_index DESC, label DESC) AS k, count(DISTINCT object_index) OVER (PARTITION BY frame_ord, row_idx) AS claims FROM a)
SELECT frame_ord, row_idx, CAST(CASE WHEN priority >= 10 THEN label ELSE 0 END AS BIGINT) AS label, claims FROM r WHERE k = 1""", "points"))
def dom10(spark: SparkSession, sf: str) -> DataFrame:
    view(spark, sf, "points").createOrReplaceTempView("points")
    return manifests.manual_labels(spark.sql(CLAIMS), 0, 10)


@query("win7_duplicates", oracle(f"""
WITH a AS ({CLAIMS}), t AS (SELECT *, coalesce(max(priority) OVER (PARTITION BY frame_ord, row_idx ORDER BY object_index, label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= 10, false) AS taken FROM a)
SELECT frame_ord, count(*) AS attempted, count(*) FILTER (taken) AS duplicates FROM t GROUP BY frame_ord""", "points"))
def win7(spark: SparkSession, sf: str) -> DataFrame:
    view(spark, sf, "points").createOrReplaceTempView("points")
    return manifests.duplicate_assignments(spark.sql(CLAIMS), 10)


@query("fn2_training_points", oracle("SELECT frame_ord, count(*) FILTER (greatest(abs(x), abs(y), abs(z)) >= 1e-4) AS usable, count(*) AS points FROM points GROUP BY frame_ord", "points"))
def fn2(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "points").groupBy("frame_ord").agg(F.count_if(S.valid_training_point()).alias("usable"), F.count("*").alias("points"))


@query("fn27_ratios", oracle("SELECT frame_ord, round(coalesce(count(*) FILTER (gt = 2)::DOUBLE / nullif(count(*) FILTER (gt = 5), 0), 0), 6) AS ratio FROM points GROUP BY frame_ord", "points"))
def fn27(spark: SparkSession, sf: str) -> DataFrame:
    by = view(spark, sf, "points").groupBy("frame_ord").agg(F.count_if(F.col("gt") == 2).alias("a"), F.count_if(F.col("gt") == 5).alias("b"))
    return by.select("frame_ord", F.round(S.ratio("a", "b"), 6).alias("ratio"))


@query("joi9_neighbourhood", oracle("""WITH b AS (SELECT frame_ord, CAST(floor(azimuth / 5e-1) AS BIGINT) AS bin_a, CAST(floor(vertical / 5e-1) AS BIGINT) AS bin_v FROM points), cells AS (SELECT frame_ord, bin_a, bin_v, count(*) AS cell FROM b GROUP BY ALL)
 SELECT c.frame_ord, c.bin_a, c.bin_v, CAST(sum(n.cell) AS BIGINT) AS density FROM cells c JOIN cells n ON n.frame_ord = c.frame_ord AND abs(n.bin_a - c.bin_a) <= 1 AND abs(n.bin_v - c.bin_v) <= 1 GROUP BY ALL""", "points"))
def joi9(spark: SparkSession, sf: str) -> DataFrame:
    return echo.angular_density(view(spark, sf, "points")).groupBy("frame_ord", "bin_a", "bin_v").agg(F.max("density").alias("density"))


@query("set2_report_ids", oracle("SELECT gt AS label FROM points WHERE gt <> 255 UNION SELECT model_label FROM points WHERE gt <> 255 AND model_label <> 255", "points"))
def set2(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.class_metrics(matrix(spark, sf)).select("label")


@query("dom2_teacher_features", oracle(f"WITH {FEATURES} SELECT frame_ord, row_idx, echo_valid, return_count, return_rank, round(nearest_gap, 6) AS nearest_gap, round(strongest_delta, 6) AS strongest_delta, density, row_count, col_count, checked, support, round(far_from, 6) AS far_from, round(line_from, 6) AS line_from, round(below_to, 6) AS below_to, mask_label, round(mask_conf, 6) AS mask_conf, boundary FROM g", "points", "pixels"))
def dom2(spark: SparkSession, sf: str) -> DataFrame:
    f = teacher.teacher_features(view(spark, sf, "points"), view(spark, sf, "pixels"))
    names = "echo_valid return_count return_rank nearest_gap strongest_delta density row_count col_count checked support far_from line_from below_to mask_label mask_conf boundary".split()
    return rounded(f.select(*KEY, *names), "nearest_gap", "strongest_delta", "far_from", "line_from", "below_to", "mask_conf")


COLUMNS = """round(coalesce(distance, 0), 6) AS distance_clean, round(greatest(0, least(1, CASE WHEN max(intensity) OVER f > 1 THEN intensity / 255 ELSE intensity END)), 6) AS intensity_norm,
 round(greatest(0, least(1, CASE WHEN max(reflectivity) OVER f > 1 THEN reflectivity / 255 ELSE reflectivity END)), 6) AS reflectivity_norm, round(CASE WHEN max(abs(strongest_delta)) OVER f > 1 THEN strongest_delta / 255 ELSE strongest_delta END, 6) AS strongest_delta_norm,
 density <= 3 AS isolated, cxd IS NOT NULL AND cyd IS NOT NULL AS has_projection, support > 0 AS stable, checked > 0 AND support = 0 AS transient, round(z, 6) <= round(below_to, 6) AS below_ground, mask_label <> 255 AS mask_context,
 model_label BETWEEN 20 AND 26 AND round(model_conf, 6) >= 5e-1 AS model_noise, model_label NOT BETWEEN 20 AND 26 AND model_label <> 255 AND round(model_conf, 6) >= 7e-1 AS model_object"""


@query("dom2_teacher_columns", oracle(f"WITH {FEATURES} SELECT frame_ord, row_idx, azimuth, round(vertical, 6) AS vertical, {COLUMNS} FROM g WINDOW f AS (PARTITION BY frame_ord)", "points", "pixels"))
def dom2_columns(spark: SparkSession, sf: str) -> DataFrame:
    points = view(spark, sf, "points")
    f = teacher.teacher_columns(teacher.column_features(points, view(spark, sf, "pixels")))
    names = "distance_clean intensity_norm reflectivity_norm strongest_delta_norm isolated has_projection stable transient below_ground mask_context model_noise model_object".split()
    return rounded(f.select(*KEY, "azimuth", "vertical", *names), "vertical", *names[:4])


CLASSES = (("Car", 1), ("Truck_Bus", 2), ("building", 3), ("ROAD", 4), ("tire", 5), ("sky", 6), ("cyclist", 8), ("Traffic_Cone", 13), ("vegetation", 20), ("wheel_chock", 27), ("pole", 30))


@query("dom6_named_classes", oracle(f"WITH {FEATURES}, o AS ({best_sql((1, 2, 4, 5, 8, 13, 27))}) SELECT frame_ord, row_idx, label, confidence FROM o WHERE rule = 'object_context'", "points", "pixels"))
def dom6_named(spark: SparkSession, sf: str) -> DataFrame:
    ids = teacher.context_ids(spark.createDataFrame(CLASSES, "name string, id int"))
    return teacher.candidates(scores(spark, sf), ids).where("rule = 'object_context'").select(*KEY, "label", "confidence")


@query("dom4_context", oracle(f"""WITH {FEATURES} SELECT frame_ord, row_idx, round(CASE WHEN mask_label <> 255 THEN -6e-2 ELSE 0e0 END + CASE WHEN boundary THEN -8e-2 ELSE 0e0 END
 + CASE WHEN model_label BETWEEN 20 AND 26 AND round(model_conf, 6) >= 5e-1 THEN 8e-2 ELSE 0e0 END + CASE WHEN model_label NOT BETWEEN 20 AND 26 AND model_label <> 255 AND round(model_conf, 6) >= 7e-1 THEN -5e-2 ELSE 0e0 END, 6) AS context FROM g""", "points", "pixels"))
def dom4(spark: SparkSession, sf: str) -> DataFrame:
    return scores(spark, sf).select(*KEY, F.round("f_ctx", 6).alias("context"))


@query("dom6_object_context", oracle(f"""WITH {FEATURES}, o AS ({best_sql()}) SELECT frame_ord, row_idx, label, confidence FROM o WHERE rule = 'object_context'""", "points", "pixels"))
def dom6(spark: SparkSession, sf: str) -> DataFrame:
    return teacher.candidates(scores(spark, sf)).where("rule = 'object_context'").select(*KEY, "label", "confidence")


@query("dom7_rule_classes", oracle(f"WITH {FEATURES}, o AS ({best_sql()}) SELECT label, rule, count(*) AS points FROM o WHERE rule <> 'object_context' GROUP BY ALL", "points", "pixels"))
def dom7(spark: SparkSession, sf: str) -> DataFrame:
    return teacher.candidates(scores(spark, sf)).where("rule <> 'object_context'").groupBy("label", "rule").agg(F.count("*").alias("points"))


@query("dom8_model_context", oracle("SELECT frame_ord, count(*) FILTER (model_label BETWEEN 20 AND 26 AND round(model_conf, 6) >= 5e-1) AS noise, count(*) FILTER (model_label NOT BETWEEN 20 AND 26 AND model_label <> 255 AND round(model_conf, 6) >= 7e-1) AS objects FROM points GROUP BY frame_ord", "points"))
def dom8(spark: SparkSession, sf: str) -> DataFrame:
    noise, objects = teacher.model_context()
    return view(spark, sf, "points").groupBy("frame_ord").agg(F.count_if(noise).alias("noise"), F.count_if(objects).alias("objects"))


@query("dom25_excluded", oracle(f"WITH {TAX} SELECT gt, n FROM c WHERE n = 0", "points"))
def dom25(spark: SparkSession, sf: str) -> DataFrame:
    return dom11(spark, sf).where("train_id IS NULL").select("gt", "n")
