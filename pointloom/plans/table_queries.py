"""Queries over matches, manifests, vectors and event properties."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointloom.functions import scalars as S
from pointloom.operators import evaluation, features, manifests, matching, splits
from pointloom.plans.registry import query
from pointloom.plans.views import SQL, oracle, table, view


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


NEAREST = """n AS (SELECT f.frame_id, f.ts_s, p.pose_id, p.ts_s - f.ts_s AS delta,
 row_number() OVER (PARTITION BY f.frame_id ORDER BY abs(p.ts_s - f.ts_s), p.ts_s < f.ts_s, CASE WHEN p.ts_s >= f.ts_s THEN p.pose_id ELSE -p.pose_id END) AS k FROM frame_times f CROSS JOIN pose_times p)"""


@query("joi4_nearest_pose", oracle(f"WITH {NEAREST} SELECT frame_id, ts_s, pose_id, delta FROM n WHERE k = 1", "frame_times", "pose_times"))
def joi4(spark: SparkSession, sf: str) -> DataFrame:
    return matching.nearest_in_time(view(spark, sf, "frame_times"), view(spark, sf, "pose_times"), "frame_id", "pose_id", "ts_s")


@query("joi5_synced_frames", oracle(f"WITH {NEAREST} SELECT abs(delta) <= 60 AS synced, count(*) AS frames, CAST(sum(abs(delta)) AS BIGINT) AS total FROM n WHERE k = 1 GROUP BY ALL", "frame_times", "pose_times"))
def joi5(spark: SparkSession, sf: str) -> DataFrame:
    m = matching.synced(joi4(spark, sf), 60)
    return m.groupBy("synced").agg(F.count("*").alias("frames"), F.sum(F.abs("delta")).alias("total"))


@query("win5_best_match", oracle("SELECT frame_id, arg_min(image_id, (abs(diff_ms), row_idx)) AS image_id, arg_min(diff_ms, (abs(diff_ms), row_idx)) AS diff_ms FROM matches GROUP BY frame_id", "matches"))
def win5(spark: SparkSession, sf: str) -> DataFrame:
    return matching.best_per(view(spark, sf, "matches"), "frame_id").select("frame_id", "image_id", "diff_ms")


@query("win4_frame_windows", oracle("""WITH f AS (SELECT DISTINCT image_id, frame_id FROM matches)
 SELECT image_id, frame_id, array_to_string(list(frame_id) OVER (PARTITION BY image_id ORDER BY frame_id ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), ',') AS past,
 array_to_string(list(frame_id) OVER (PARTITION BY image_id ORDER BY frame_id ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING), ',') AS future FROM f""", "matches"))
def win4(spark: SparkSession, sf: str) -> DataFrame:
    f = view(spark, sf, "matches").select("image_id", "frame_id").distinct()
    w = matching.frame_windows(f, "image_id", "frame_id", 2)
    text = lambda c: F.when(F.size(c) > 0, F.array_join(F.transform(c, lambda x: x.cast("string")), ",")).alias(c)
    return w.select("image_id", "frame_id", text("past"), text("future"))


PRESENCE = """s AS (SELECT DISTINCT event_type, frame_id FROM matches), i AS (SELECT *, frame_id - row_number() OVER (PARTITION BY event_type ORDER BY frame_id) AS island FROM s),
 r AS (SELECT event_type, island, count(*) AS n FROM i GROUP BY ALL), p AS (SELECT event_type, CAST(sum(n) AS BIGINT) AS frames, max(n) AS longest_run FROM r GROUP BY event_type)"""


@query("agg8_class_presence", oracle(f"WITH {PRESENCE} SELECT * FROM p", "matches"))
def agg8(spark: SparkSession, sf: str) -> DataFrame:
    return matching.class_presence(view(spark, sf, "matches"), "event_type", "frame_id")


@query("flt9_kept_classes", oracle(f"WITH {PRESENCE} SELECT event_type, count(*) AS n FROM matches WHERE event_type IN (SELECT event_type FROM p WHERE frames >= 100 AND longest_run >= 4) GROUP BY ALL", "matches"))
def flt9(spark: SparkSession, sf: str) -> DataFrame:
    return matching.kept_classes(view(spark, sf, "matches"), "event_type", "frame_id", 100, 4).groupBy("event_type").agg(F.count("*").alias("n"))


@query("win6_tag_segments", oracle("""WITH t AS (SELECT CAST(frame_id // 100 AS BIGINT) AS scene, frame_id, string_agg(DISTINCT event_type, ';' ORDER BY event_type) AS tags FROM matches GROUP BY ALL),
 c AS (SELECT *, CASE WHEN lag(tags) OVER w = tags AND lag(frame_id) OVER w + 1 = frame_id THEN 0 ELSE 1 END AS new FROM t WINDOW w AS (PARTITION BY scene ORDER BY frame_id)),
 g AS (SELECT *, sum(new) OVER (PARTITION BY scene ORDER BY frame_id) AS segment FROM c)
 SELECT scene, CAST(segment AS BIGINT) AS segment, min(frame_id) AS first_frame, max(frame_id) AS last_frame, count(*) AS frames, first(tags) AS tags FROM g GROUP BY scene, segment""", "matches"))
def win6(spark: SparkSession, sf: str) -> DataFrame:
    m = view(spark, sf, "matches").withColumn("scene", F.floor(F.col("frame_id") / 100).cast("bigint"))
    return matching.tag_segments(m, "scene", "frame_id", "event_type").withColumn("segment", F.col("segment").cast("bigint"))


@query("agg7_log_summary", oracle("""SELECT event_type, count(*) AS n, count(DISTINCT frame_id) AS frames, round(avg(diff_ms), 6) AS mean_diff, min(diff_ms) AS least, max(diff_ms) AS most, round(median(diff_ms), 6) AS middle FROM matches GROUP BY event_type""", "matches"))
def agg7(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "matches").groupBy("event_type").agg(
        F.count("*").alias("n"), F.countDistinct("frame_id").alias("frames"), F.round(F.avg("diff_ms"), 6).alias("mean_diff"), F.min("diff_ms").alias("least"), F.max("diff_ms").alias("most"), F.round(F.median("diff_ms"), 6).alias("middle")
    )


@query("fn16_tag_text", oracle("SELECT image_id, string_agg(DISTINCT event_type, ';' ORDER BY event_type) AS tags FROM matches GROUP BY image_id", "matches"))
def fn16(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "matches").groupBy("image_id").agg(F.concat_ws(";", F.array_sort(F.collect_set("event_type"))).alias("tags"))


@query("flt8_frame_range", oracle("WITH f AS (SELECT DISTINCT frame_id FROM matches WHERE frame_id BETWEEN 10 AND 4000), r AS (SELECT *, row_number() OVER (ORDER BY frame_id) - 1 AS k FROM f) SELECT frame_id, k FROM r WHERE k % 3 = 0 AND k < 600", "matches"))
def flt8(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import Window

    frames = view(spark, sf, "matches").where(F.col("frame_id").between(10, 4000)).select("frame_id").distinct()
    ranked = frames.withColumn("k", (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("frame_id")) - 1).cast("bigint"))  # a row a frame, of a bounded range
    return ranked.where("k % 3 = 0 AND k < 600")


@query("set1_frame_sides", oracle("""WITH a AS (SELECT DISTINCT image_id FROM matches WHERE event_type = 'click'), b AS (SELECT DISTINCT image_id FROM matches WHERE event_type = 'view')
 SELECT coalesce(a.image_id, b.image_id) AS image_id, CASE WHEN b.image_id IS NULL THEN 'left' WHEN a.image_id IS NULL THEN 'right' ELSE 'both' END AS side FROM a FULL JOIN b USING (image_id)""", "matches"))
def set1(spark: SparkSession, sf: str) -> DataFrame:
    m = view(spark, sf, "matches")
    return evaluation.frame_differences(m.where("event_type = 'click'"), m.where("event_type = 'view'"), "image_id")


@query("set4_retained_classes", oracle("SELECT image_id, coalesce(string_agg(DISTINCT event_type, ';' ORDER BY event_type) FILTER (event_type IN ('click', 'view')), '') AS kept FROM matches GROUP BY image_id", "matches"))
def set4(spark: SparkSession, sf: str) -> DataFrame:
    sets = view(spark, sf, "matches").groupBy("image_id").agg(F.collect_set("event_type").alias("s"))
    return sets.select("image_id", F.concat_ws(";", F.array_sort(F.array_intersect("s", F.array(F.lit("click"), F.lit("view"))))).alias("kept"))


@query("agg9_manifest_summary", oracle("SELECT label, split, CAST(grouping(label) * 2 + grouping(split) AS BIGINT) AS level, count(*) AS samples FROM manifest GROUP BY GROUPING SETS ((), (label), (split), (label, split))", "manifest"))
def agg9(spark: SparkSession, sf: str) -> DataFrame:
    return manifests.summary(view(spark, sf, "manifest"))


@query("agg10_split_cube", oracle("SELECT split, label, count(*) AS samples, count(*) FILTER (label <> initial_label) AS changed FROM manifest GROUP BY CUBE (split, label)", "manifest"))
def agg10(spark: SparkSession, sf: str) -> DataFrame:
    return manifests.split_cube(view(spark, sf, "manifest"))


@query("agg25_class_statistics", oracle("SELECT label, count(*) AS samples, count(DISTINCT source_id) AS sources, count(*) FILTER (label <> initial_label) AS changed, round(count(*)::DOUBLE / count(DISTINCT source_id), 6) AS per_source FROM manifest GROUP BY label", "manifest"))
def agg25(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(manifests.class_statistics(view(spark, sf, "manifest")), "per_source")


CLASSES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("agg22_floored_metrics", oracle(f"""WITH m AS (SELECT label AS gt, initial_label AS pred, count(*) AS n FROM manifest GROUP BY ALL), c AS (SELECT unnest({CLASSES!r}) AS c),
 k AS (SELECT c, coalesce(sum(n) FILTER (gt = c AND pred = c), 0) AS tp, coalesce(sum(n) FILTER (pred = c), 0) AS p, coalesce(sum(n) FILTER (gt = c), 0) AS s FROM c, m GROUP BY c),
 f AS (SELECT 2 * (tp / greatest(p, 1)) * (tp / greatest(s, 1)) / greatest(tp / greatest(p, 1) + tp / greatest(s, 1), 1e-12) AS f1 FROM k)
 SELECT (SELECT round(sum(n) FILTER (gt = pred) / sum(n), 6) FROM m) AS accuracy, round(avg(f1), 6) AS macro_f1 FROM f""", "manifest"))
def agg22(spark: SparkSession, sf: str) -> DataFrame:
    m = evaluation.confusion(view(spark, sf, "manifest"), "label", "initial_label", ())
    return rounded(evaluation.floored_metrics(m, CLASSES), "accuracy", "macro_f1")


@query("dom23_reindexed", oracle("SELECT sample_id, source_id, split, initial_label AS label, label AS previous_label, initial_label <> label AS moved FROM manifest WHERE sample_id % 11 <> 0", "manifest"))
def dom23(spark: SparkSession, sf: str) -> DataFrame:
    m = view(spark, sf, "manifest")
    review = m.where("sample_id % 11 <> 0").select("sample_id", F.col("initial_label").alias("label"))
    return manifests.reindexed(m.drop("initial_label"), review)


@query("joi14_recovered", oracle("SELECT sample_id, source_id, label, CASE WHEN sample_id % 3 = 0 THEN label ELSE initial_label END AS initial_label, split FROM manifest", "manifest"))
def joi14(spark: SparkSession, sf: str) -> DataFrame:
    m = view(spark, sf, "manifest")
    recovery = m.where("sample_id % 3 = 0").select("sample_id", F.lit("other").alias("label"), F.col("label").alias("initial_label"))
    return manifests.recovered(m, recovery, ("label",))


@query("set3_merged", oracle("SELECT part || '_' || sample_id AS merged_id, sample_id, label FROM (SELECT 'a' AS part, * FROM manifest WHERE split = 'train' UNION ALL SELECT 'b', * FROM manifest WHERE split <> 'test') WHERE sample_id % 4 <> 1", "manifest"))
def set3(spark: SparkSession, sf: str) -> DataFrame:
    m = view(spark, sf, "manifest")
    parts = {"a": m.where("split = 'train'"), "b": m.where("split <> 'test'")}
    reviewed = m.where("sample_id % 4 <> 1").select(F.explode(F.array(*[F.concat(F.lit(f"{p}_"), "sample_id") for p in "ab"])).alias("merged_id"))
    return manifests.merged(parts, reviewed).select("merged_id", "sample_id", "label")


@query("joi12_removed_samples", oracle("SELECT sample_id FROM manifest WHERE split = 'val' AND source_id NOT IN (SELECT source_id FROM manifest WHERE split = 'train' OR label = '5-LOW')", "manifest"))
def joi12(spark: SparkSession, sf: str) -> DataFrame:
    m = view(spark, sf, "manifest")
    return m.where("split = 'val'").join(m.where("split = 'train' OR label = '5-LOW'").select("source_id"), "source_id", "left_anti").select("sample_id")


#: Sources in order of the rule, one step of the recursion each; then equal sources are dealt their splits by hash order.
GROUPED = """WITH RECURSIVE c AS (SELECT source_id, label, count(*) AS n FROM manifest GROUP BY ALL), t AS (SELECT label, sum(n) AS total FROM c GROUP BY label), k AS (SELECT count(*) AS classes FROM t),
 s AS (SELECT source_id, sum(n) AS size, round(sum(n / total), 12) AS rarity, list({'label': label, 'n': n} ORDER BY label) AS kind FROM c JOIN t USING (label) GROUP BY source_id),
 f AS (SELECT s.source_id, list(coalesce(c.n, 0)::DOUBLE ORDER BY t.label) AS vec FROM s CROSS JOIN t LEFT JOIN c ON c.source_id = s.source_id AND c.label = t.label GROUP BY s.source_id),
 o AS MATERIALIZED (SELECT source_id, kind, list_append(vec, size::DOUBLE) AS vec, row_number() OVER (ORDER BY rarity DESC, size DESC, kind, md5(source_id || ':1')) AS place FROM s JOIN f USING (source_id)),
@quota@ g AS (SELECT list(share * n ORDER BY turn, name) AS target FROM (SELECT unnest([7e-1, 15e-2, 15e-2]) AS share, unnest([0, 1, 2]) AS turn), (SELECT label AS name, total AS n FROM t UNION ALL SELECT '~', sum(total) FROM t)),
 step AS (
  SELECT 0::BIGINT AS place, -1::BIGINT AS split, list_transform(target, lambda x: 0e0) AS have, [0, 0, 0]::BIGINT[] AS used FROM g
  UNION ALL
  SELECT place, split, list_transform(have, lambda h, i: CASE WHEN (i - 1) // (classes + 1) = split THEN h + vec[(i - 1) % (classes + 1) + 1] ELSE h END), list_transform(used, lambda u, i: CASE WHEN i - 1 = split THEN u + 1 ELSE u END)
  FROM (SELECT o.place, o.vec, p.have, p.used, k.classes, list_sort(list_filter(list_transform([0, 1, 2], lambda j: {'cost': CASE WHEN used[j + 1] < quota[j + 1] THEN round(list_sum(list_transform(o.vec, lambda v, i:
   (CASE WHEN i = classes + 1 THEN 25e-2 ELSE 1e0 END) * v * (v + 2 * (have[j * (classes + 1) + i] - target[j * (classes + 1) + i])) / (target[j * (classes + 1) + i] + 1))), 9) END, 'split': j}), lambda x: x.cost IS NOT NULL))[1].split AS split
   FROM step p JOIN o ON o.place = p.place + 1, g, q, k)),
 d AS (SELECT o.source_id, o.kind, row_number() OVER (PARTITION BY kind ORDER BY split) AS nth, split FROM step JOIN o USING (place)),
 h AS (SELECT source_id, kind, row_number() OVER (PARTITION BY kind ORDER BY md5(source_id || ':1')) AS nth FROM s)
 SELECT sample_id, manifest.source_id, ['train', 'val', 'test'][d.split + 1] AS new_split FROM manifest JOIN h USING (source_id) JOIN d ON d.kind = h.kind AND d.nth = h.nth"""
REMAINDER = """ w AS (SELECT x - 1 AS split, [70, 15, 15][x] AS pct, (SELECT count(*) FROM s) AS groups FROM range(1, 4) r(x)),
 q AS (SELECT list(pct * groups // 100 + CASE WHEN place <= rest THEN 1 ELSE 0 END ORDER BY split) AS quota FROM (SELECT *, row_number() OVER (ORDER BY pct * groups % 100 DESC, split) AS place, groups - sum(pct * groups // 100) OVER () AS rest FROM w)),"""
ROUNDED = " q AS (SELECT [groups - val - val, val, val] AS quota FROM (SELECT count(*) AS groups, greatest(1, CAST(round_even(count(*) * 15 / 1e2, 0) AS BIGINT)) AS val FROM s)),"
COVER = """WITH RECURSIVE p AS MATERIALIZED (SELECT DISTINCT frame_ord, gt AS label FROM points WHERE gt <> 255), f AS MATERIALIZED (SELECT frame_ord, list(label ORDER BY label) AS classes FROM p GROUP BY frame_ord), n AS (SELECT greatest(1, least(count(*) - 1, CAST(ceil(count(*) * 2 / 10e0) AS BIGINT))) AS wanted FROM f),
 step AS (
  SELECT 0::BIGINT AS n, []::BIGINT[] AS val
  UNION ALL
  SELECT n, list_append(val, frame_ord) FROM (
   SELECT s.n + 1 AS n, s.val, (SELECT arg_min(frame_ord, {'a': -fresh, 'b': -rare, 'c': classes, 'd': md5(frame_ord || ':1')}) FROM (
     SELECT f.frame_ord, any_value(f.classes) AS classes, round(sum(CASE WHEN seen THEN 0 ELSE 1e0 / rest END), 12) AS fresh, round(sum(1e0 / rest), 12) AS rare FROM f JOIN p USING (frame_ord)
      JOIN (SELECT label, count(*) - count_if(list_contains(s.val, frame_ord)) AS rest, bool_or(list_contains(s.val, frame_ord)) AS seen FROM p GROUP BY label) r USING (label)
     WHERE NOT list_contains(s.val, f.frame_ord) GROUP BY f.frame_ord HAVING min(rest) > 1)) AS frame_ord
   FROM step s WHERE s.n < (SELECT wanted FROM n)) WHERE frame_ord IS NOT NULL)
 SELECT frame_ord, CASE WHEN list_contains((SELECT arg_max(val, n) FROM step), frame_ord) THEN 'val' ELSE 'train' END AS split FROM f"""


@query("dom14_grouped_split", oracle(GROUPED.replace("@quota@", REMAINDER), "manifest"))
def dom14(spark: SparkSession, sf: str) -> DataFrame:
    return splits.grouped_split(view(spark, sf, "manifest")).select("sample_id", "source_id", "new_split")


@query("dom14_rounded_quotas", oracle(GROUPED.replace("@quota@", ROUNDED), "manifest"))
def dom14_rounded(spark: SparkSession, sf: str) -> DataFrame:
    return splits.grouped_split(view(spark, sf, "manifest"), quotas=splits.rounded_quotas).select("sample_id", "source_id", "new_split")


@query("dom13_rare_class_split", oracle(COVER, "points"))
def dom13(spark: SparkSession, sf: str) -> DataFrame:
    p = view(spark, sf, "points").where("gt <> 255").select("frame_ord", F.col("gt").alias("label")).distinct()
    return splits.rare_class_split(p)


REVIEWED = f"all_samples AS ({SQL['manifest']}), manifest AS (SELECT sample_id, source_id, initial_label AS label, CASE WHEN initial_label <> label THEN label END AS previous_label FROM all_samples WHERE sample_id % 11 <> 0)"


def reviewed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    m = view(spark, sf, "manifest")
    return m.drop("initial_label"), m.where("sample_id % 11 <> 0").select("sample_id", F.col("initial_label").alias("label"))


@query("dom23_resplit", GROUPED.replace("@quota@", ROUNDED).replace("WITH RECURSIVE ", f"WITH RECURSIVE {REVIEWED}, ").replace("SELECT sample_id, manifest.source_id,", "SELECT sample_id, manifest.source_id, label, previous_label,").replace("AS new_split", "AS split"))
def dom23_resplit(spark: SparkSession, sf: str) -> DataFrame:
    return manifests.resplit(*reviewed(spark, sf)).select("sample_id", "source_id", "label", "previous_label", "split")


@query("dom23_summary", oracle("SELECT label, count(*) FILTER (sample_id % 11 <> 0) AS samples, count(*) FILTER (sample_id % 11 <> 0 AND initial_label <> label) AS moved, count(*) FILTER (sample_id % 11 = 0) AS removed FROM manifest GROUP BY label", "manifest"))
def dom23_summary(spark: SparkSession, sf: str) -> DataFrame:
    return manifests.review_summary(*reviewed(spark, sf))


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").where("label IS NOT NULL")


LONG = "x AS (SELECT vec_id, label, CAST(unnest(range(0, len(embedding))) AS INTEGER) AS dim, CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings WHERE label IS NOT NULL)"
FIT = "fit AS (SELECT dim, avg(value) AS mean, CASE WHEN stddev_pop(value) < 1e-6 THEN 1e0 ELSE stddev_pop(value) END AS std FROM x GROUP BY dim)"
CENTRES = f"{LONG}, {FIT}, z AS (SELECT vec_id, label, dim, (value - mean) / std AS x FROM x JOIN fit USING (dim)), c AS (SELECT label, dim, avg(x) AS centre FROM z GROUP BY ALL)"


@query("agg12_feature_fit", oracle(f"WITH {LONG}, {FIT} SELECT dim, round(mean, 6) AS mean, round(std, 6) AS std FROM fit"))
def agg12(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.fitted(vectors(spark, sf), "embedding"), "mean", "std")


@query("agg24_fisher_scores", oracle(f"""WITH {LONG}, s AS (SELECT dim, label, count(*) AS n, avg(value) AS m, var_pop(value) AS v FROM x GROUP BY ALL), g AS (SELECT dim, sum(n * m) / sum(n) AS g FROM s GROUP BY dim)
 SELECT dim, round(CASE WHEN sum(n * v) > 1e-12 THEN sum(n * (m - g) * (m - g)) / sum(n * v) ELSE 0e0 END, 6) AS score FROM s JOIN g USING (dim) GROUP BY dim"""))
def agg24(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.fisher_scores(vectors(spark, sf), "embedding", "label"), "score")


@query("agg26_nearest_centroid", oracle(f"""WITH {CENTRES}, d AS (SELECT z.vec_id, c.label AS cls, avg((z.x - c.centre) * (z.x - c.centre)) AS d FROM z JOIN c USING (dim) GROUP BY ALL)
 SELECT vec_id, arg_min(cls, (round(d, 9), cls)) AS nearest, round(min(d), 6) AS distance FROM d GROUP BY vec_id"""))
def agg26(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.nearest_centroid(vectors(spark, sf), "vec_id", "embedding", "label"), "distance")


@query("agg27_centroid_distances", oracle(f"WITH {CENTRES} SELECT p.label AS a, q.label AS b, round(sqrt(avg((p.centre - q.centre) * (p.centre - q.centre))), 6) AS distance FROM c p JOIN c q ON p.dim = q.dim AND p.label < q.label GROUP BY ALL"))
def agg27(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.centroid_distances(vectors(spark, sf), "embedding", "label"), "distance")


@query("agg21_fragment_vote", oracle("""WITH f AS (SELECT CAST(vec_id // 3 AS BIGINT) AS point, CAST(unnest(range(0, 8)) AS INTEGER) AS cls, CAST(unnest(embedding[1:8]) AS DOUBLE) AS p FROM embeddings), m AS (SELECT point, cls, avg(p) AS p FROM f GROUP BY ALL)
 SELECT point, CAST(arg_max(cls, (round(p, 9), -cls)) AS BIGINT) AS label, round(max(p), 6) AS confidence FROM m GROUP BY point"""))
def agg21(spark: SparkSession, sf: str) -> DataFrame:
    f = table(spark, sf, "embeddings").select(F.floor(F.col("vec_id") / 3).cast("bigint").alias("point"), F.slice("embedding", 1, 8).cast("array<double>").alias("p"))
    return rounded(features.fragment_vote(f, "point", "p"), "confidence")


@query("fn18_top_two", oracle("""WITH v AS (SELECT vec_id, list_transform(embedding[1:6], lambda x: abs(x::DOUBLE)) AS p FROM embeddings), s AS (SELECT *, list_reverse_sort(p) AS q, list_sum(p) AS t FROM v)
 SELECT vec_id, CAST(list_position(p, q[1]) - 1 AS BIGINT) AS best, round(q[1] / t, 6) AS confidence, round((q[1] - q[2]) / t, 6) AS margin FROM s"""))
def fn18(spark: SparkSession, sf: str) -> DataFrame:
    v = table(spark, sf, "embeddings").select("vec_id", F.transform(F.slice("embedding", 1, 6), lambda x: F.abs(x.cast("double"))).alias("p"))
    return rounded(v.select("vec_id", *[c.alias(n) for n, c in S.top_two("p").items()]), "confidence", "margin")


@query("fn19_blend", oracle("""WITH v AS (SELECT vec_id, list_transform(embedding[1:4], lambda x: abs(x::DOUBLE)) AS p, list_transform(embedding[5:8], lambda x: abs(x::DOUBLE)) AS q FROM embeddings),
 m AS (SELECT vec_id, [p[1] * 3e-1 + q[1] * 7e-1, p[2] * 3e-1 + q[2] * 7e-1, p[3] * 3e-1 + q[3] * 7e-1, p[4] * 3e-1 + q[4] * 7e-1] AS m FROM v) SELECT vec_id, round(m[1] / list_sum(m), 6) AS first_share, round(m[4] / list_sum(m), 6) AS last_share FROM m"""))
def fn19(spark: SparkSession, sf: str) -> DataFrame:
    part = lambda a: F.transform(F.slice("embedding", a, 4), lambda x: F.abs(x.cast("double")))
    v = table(spark, sf, "embeddings").select("vec_id", part(1).alias("p"), part(5).alias("q")).withColumn("m", S.blended("p", "q", 0.3))
    return v.select("vec_id", F.round(F.element_at("m", 1), 6).alias("first_share"), F.round(F.element_at("m", 4), 6).alias("last_share"))


@query("srt5_extremes", oracle("SELECT vec_id, embedding[3]::DOUBLE AS value FROM embeddings WHERE label = 4 ORDER BY value DESC, vec_id LIMIT 10"))
def srt5(spark: SparkSession, sf: str) -> DataFrame:
    return features.extremes(vectors(spark, sf), "vec_id", "embedding", "label", 4, 2, 10)


@query("srt4_hashed_sample", oracle("SELECT sample_id, label FROM manifest ORDER BY md5(sample_id || ':7'), sample_id LIMIT 100", "manifest"))
def srt4(spark: SparkSession, sf: str) -> DataFrame:
    return features.hashed_sample(view(spark, sf, "manifest").select("sample_id", "label"), "sample_id", 100, 7)


@query("agg23_blend_weight", oracle("""WITH w AS (SELECT unnest(range(0, 21)) * 5e-2 AS weight), v AS (SELECT vec_id, CAST(label AS BIGINT) AS gt, CAST(unnest(range(0, 10)) AS BIGINT) AS cls, abs(CAST(unnest(embedding[1:10]) AS DOUBLE)) AS p, abs(CAST(unnest(embedding[11:20]) AS DOUBLE)) AS q FROM embeddings WHERE label IS NOT NULL),
 l AS (SELECT weight, vec_id, any_value(gt) AS gt, arg_max(cls, (p * weight + q * (1 - weight), -cls)) AS pred FROM v, w GROUP BY weight, vec_id), h AS (SELECT weight, gt, pred, count(*) AS n FROM l GROUP BY ALL),
 a AS (SELECT weight, gt AS c, sum(n) AS support, sum(CASE WHEN gt = pred THEN n ELSE 0 END) AS tp FROM h GROUP BY ALL), b AS (SELECT weight, pred AS c, sum(n) AS predicted FROM h GROUP BY ALL),
 f AS (SELECT weight, sum(2e0 * coalesce(tp, 0) / greatest(coalesce(support, 0) + coalesce(predicted, 0), 1)) / 10 AS macro_f1 FROM a FULL JOIN b USING (weight, c) GROUP BY weight)
 SELECT round(weight, 6) AS weight, round(macro_f1, 6) AS macro_f1 FROM f ORDER BY round(macro_f1, 9) DESC, abs(weight - 5e-1), weight DESC LIMIT 1"""))
def agg23(spark: SparkSession, sf: str) -> DataFrame:
    part = lambda a: F.transform(F.slice("embedding", a, 10), lambda x: F.abs(x.cast("double")))
    v = vectors(spark, sf).select(F.col("label").cast("bigint").alias("label"), part(1).alias("p"), part(11).alias("q"))
    return rounded(features.blend_weight(v, "label", "p", "q", 10), "weight", "macro_f1")


@query("agg28_principal_components")
def agg28(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    found, _ = features.principal_components(vectors(spark, sf), "embedding")
    return found.select("vec_id", vector_to_array("components").alias("components"))


IMAGES = """p AS (SELECT u, v, v AS image, label % 3 AS channel, confidence * 255 AS value FROM pixels), q AS (SELECT image, channel, avg(value) AS mean, quantile_cont(value, 0.01) AS p01, quantile_cont(value, 0.99) AS p99 FROM p GROUP BY ALL),
 s AS (SELECT *, avg(mean) OVER (PARTITION BY image) / (mean + 1e-5) AS gain FROM q)"""


def image_values(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "pixels").select("u", F.col("v").alias("image"), (F.col("label") % 3).alias("channel"), (F.col("confidence") * 255).alias("value"))


@query("agg20_image_statistics", oracle(f"WITH {IMAGES} SELECT image, channel, round(mean, 6) AS mean, round(p01, 6) AS p01, round(p99, 6) AS p99, round(gain, 6) AS gain FROM s", "pixels"))
def agg20(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.image_statistics(image_values(spark, sf), "image", "channel", "value"), "mean", "p01", "p99", "gain")


@query("agg20_corrected_pixels", oracle(f"""WITH {IMAGES}, c AS (SELECT u, image, channel, round(CASE WHEN p99 <= p01 + 1e-6 THEN value ELSE (value - p01) * (255 / (p99 - p01)) END, 6) AS s, round(value * gain, 6) AS b FROM p JOIN s USING (image, channel))
 SELECT u, image, channel, CAST(floor(least(255, greatest(0, s))) AS INTEGER) AS stretched, CAST(floor(least(255, greatest(0, b))) AS INTEGER) AS balanced FROM c""", "pixels"))
def agg20_corrected(spark: SparkSession, sf: str) -> DataFrame:
    p = image_values(spark, sf)
    return features.corrected(p, features.image_statistics(p, "image", "channel", "value"), "image", "channel", "value").select("u", "image", "channel", "stretched", "balanced")


GAPPED = """x AS (SELECT vec_id, label, split, CAST(unnest(range(0, len(embedding))) AS INTEGER) AS dim, CAST(unnest(list_transform(embedding, lambda c: CASE WHEN c < -2e-1 THEN NULL ELSE c END)) AS DOUBLE) AS value
  FROM (SELECT *, CASE vec_id % 5 WHEN 0 THEN 'test' WHEN 1 THEN 'val' ELSE 'train' END AS split FROM embeddings WHERE label IS NOT NULL)),
 m AS (SELECT dim, coalesce(median(value), 0e0) AS fill FROM x WHERE split = 'train' GROUP BY dim), y AS (SELECT vec_id, label, split, dim, coalesce(value, fill) AS value FROM x JOIN m USING (dim)),
 fit AS (SELECT dim, avg(value) AS mean, CASE WHEN stddev_pop(value) < 1e-8 THEN 1e0 ELSE stddev_pop(value) END AS std FROM y WHERE split = 'train' GROUP BY dim), z AS (SELECT vec_id, label, split, dim, (value - mean) / std AS x FROM y JOIN fit USING (dim)),
 c AS (SELECT label, dim, avg(x) AS centre FROM z WHERE split = 'train' GROUP BY ALL), d AS (SELECT z.vec_id, z.label, c.label AS cls, avg((z.x - c.centre) * (z.x - c.centre)) AS d FROM z JOIN c USING (dim) WHERE split = 'test' GROUP BY ALL),
 e AS (SELECT vec_id, label, arg_min(cls, (round(d, 9), cls)) AS nearest, min(d) AS distance FROM d GROUP BY vec_id, label)"""


def evaluated(spark: SparkSession, sf: str) -> DataFrame:
    split = F.when(F.col("vec_id") % 5 == 0, "test").when(F.col("vec_id") % 5 == 1, "val").otherwise("train")
    gapped = vectors(spark, sf).withColumns({"split": split, "embedding": F.transform("embedding", lambda c: F.when(c >= F.lit(-0.2), c))})
    return features.evaluated_centroids(gapped, "vec_id", "embedding", "label", "split")


@query("agg26_evaluated_centroids", oracle(f"WITH {GAPPED} SELECT vec_id, label, nearest, round(distance, 6) AS distance FROM e"))
def agg26_evaluated(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluated(spark, sf), "distance")


@query("agg26_accuracy", oracle(f'WITH {GAPPED} SELECT count(*) AS "rows", round(avg(CASE WHEN nearest = label THEN 1e0 ELSE 0e0 END), 6) AS accuracy FROM e'))
def agg26_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.accuracy(evaluated(spark, sf), "label"), "accuracy")


@query("fn11_normal_labels", oracle("SELECT o_orderpriority AS label, regexp_replace(lower(trim(o_orderpriority)), '[\\s_\\-]+', '', 'g') AS normal, count(*) AS n FROM orders GROUP BY ALL"))
def fn11(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.groupBy(F.col("o_orderpriority").alias("label")).agg(F.count("*").alias("n")).withColumn("normal", S.normal_label("label"))


@query("fn12_indices", oracle("SELECT event_id, CAST(regexp_extract_all(props, '(-?\\d+)', 1)[1] AS BIGINT) AS first_index, CAST(len(regexp_extract_all(props, '(-?\\d+)', 1)) AS BIGINT) AS n FROM events"))
def fn12(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", S.indices_of("props").alias("i"))
    return e.select("event_id", F.try_element_at("i", F.lit(1)).alias("first_index"), F.size("i").cast("bigint").alias("n"))


@query("src14_json_access", oracle("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract(props, '$.missing') IS NULL AS missing FROM events"))
def src14(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumn("v", F.try_parse_json("props"))
    return e.select("event_id", F.try_variant_get("v", "$.k", "bigint").alias("k"), F.try_variant_get("v", "$.missing", "string").isNull().alias("missing"))


@query("fn14_source_keys", oracle("SELECT c_custkey, regexp_replace(c_name, '[^A-Za-z0-9]+', '_', 'g') || '_' || substr(sha1(CAST(c_custkey AS VARCHAR)), 1, 12) AS source_key FROM customer"))
def fn14(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", S.source_key("c_custkey", "c_name").alias("source_key"))


@query("fn21_remap", oracle("SELECT row_idx, frame_ord, CASE gt WHEN 2 THEN 0 WHEN 5 THEN 1 ELSE -1 END AS train_id FROM points", "points"))
def fn21(spark: SparkSession, sf: str) -> DataFrame:
    ids = spark.createDataFrame([(2, 0), (5, 1)], "gt bigint, train_id int")
    return S.remapped(view(spark, sf, "points").select("frame_ord", "row_idx", "gt"), ids, "gt", "train_id").select("row_idx", "frame_ord", "train_id")


@query("fn22_replace_label", oracle("SELECT CAST(CASE WHEN gt = 2 THEN 42 ELSE gt END AS BIGINT) AS label, count(*) AS points, count(*) FILTER (gt = 2) AS replaced FROM points GROUP BY ALL", "points"))
def fn22(spark: SparkSession, sf: str) -> DataFrame:
    p = view(spark, sf, "points").withColumn("label", S.replaced("gt", 2, 42))
    return p.groupBy("label").agg(F.count("*").alias("points"), F.count_if(F.col("gt") == 2).alias("replaced"))


@query("fn8_rotation", oracle("""WITH a AS (SELECT event_id, value / 1e2 AS r, value / 2e2 AS p, value / 3e2 AS y FROM events)
 SELECT event_id, round(cos(y) * cos(p), 6) AS r00, round(sin(y) * sin(p) * sin(r) + cos(y) * cos(r), 6) AS r11, round(cos(p) * cos(r), 6) AS r22 FROM a"""))
def fn8(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "events").select("event_id", (F.col("value") / 1e2).alias("r"), (F.col("value") / 2e2).alias("p"), (F.col("value") / 3e2).alias("y"))
    m = S.rotation_zyx("r", "p", "y")
    return a.select("event_id", *[F.round(m[k], 6).alias(n) for k, n in ((0, "r00"), (4, "r11"), (8, "r22"))])


@query("fn10_microseconds", oracle("SELECT event_id, CAST(round_even(value * 1e3, 0) AS BIGINT) AS us FROM events"))
def fn10(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", S.microseconds("value", "ms").alias("us"))


@query("fn23_fisheye", oracle("""WITH a AS (SELECT u, v, (u - 395e-1) / (40e0 / tan(pi() / 4)) AS x, (v - 295e-1) / (40e0 / tan(pi() / 4)) AS y FROM pixels), r AS (SELECT *, sqrt(x*x + y*y) AS flat FROM a)
 SELECT u, v, round(50 + x * CASE WHEN flat > 1e-12 THEN 60 * atan2(flat, 1) / flat ELSE 0 END, 6) AS fx, round(50 + y * CASE WHEN flat > 1e-12 THEN 60 * atan2(flat, 1) / flat ELSE 0 END, 6) AS fy FROM r""", "pixels"))
def fn23(spark: SparkSession, sf: str) -> DataFrame:
    p = view(spark, sf, "pixels")
    c = S.fisheye_pixel("u", "v", (80, 60), 90.0, "equidistant", 60.0, (50.0, 50.0))
    return p.select("u", "v", *[F.round(x, 6).alias(n) for n, x in c.items()])
