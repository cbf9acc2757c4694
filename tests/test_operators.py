"""Small cases with known results, and invariants of the greedy operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pointloom.functions import scalars as S
from pointloom.operators import alignment as A
from pointloom.operators import detections as D
from pointloom.operators import masks as M
from pointloom.operators import echo, evaluation, features, manifests, matching, splits, teacher
from pointloom.plans.views import view

SF = "/root/testdata/sf0.001"


def points(spark, rows):
    return spark.createDataFrame(rows, "frame_ord bigint, row_idx bigint, slot int, pixel int, x double, y double, z double, distance double, intensity double")


def test_echo_groups(spark):
    p = points(spark, [(0, 0, 2, 7, 1.0, 0.0, 0.0, 1.0, 10.0), (0, 1, 2, 7, 2.0, 0.0, 0.0, 2.5, 30.0), (0, 2, 2, 8, 3.0, 0.0, 0.0, 3.0, 5.0)])
    got = echo.echo_features(p).orderBy("row_idx").collect()
    assert [r.return_count for r in got] == [2, 2, 1]
    assert [r.return_rank for r in got] == [0, 1, 0]
    assert [r.nearest_gap for r in got] == [1.5, 1.5, 0.0]
    assert [r.strongest_delta for r in got] == [-20.0, 0.0, 0.0]
    assert echo.echo_matrix(p).where("pixel = 7").first().echoes == {0: 0, 1: 1}


def test_zero_and_odd_points(spark):
    nan = float("nan")
    p = points(spark, [(0, 0, 1, 1, 1.0, 0.0, 0.0, 1.0, 1.0), (0, 1, 1, 1, 0.0, 0.0, 0.0, 0.0, 1.0), (0, 2, 1, 1, nan, 0.0, 0.0, 1.0, 1.0), (1, 0, None, 1, 1.0, 0.0, 0.0, 1.0, 1.0)])
    got = echo.echo_features(p).orderBy("frame_ord", "row_idx").collect()
    assert [r.return_count for r in got] == [1, 0, 0, 1]
    valid = p.select(S.valid_return().alias("v"), S.valid_training_point().alias("t")).collect()
    assert [r.v for r in valid] == [True, False, False, True] == [r.t for r in valid]


def test_rounding(spark):
    got = spark.sql("select * from values (0.5D), (-0.5D), (1.5D), (2.5D), (0.49999999999999994D), (double('nan')), (null) as t(x)").select(S.half_away("x").alias("a"), S.half_even("x").alias("e")).collect()
    assert [r.a for r in got] == [1, -1, 2, 3, 1, None, None]
    assert [r.e for r in got] == [0, 0, 2, 2, 0, None, None]


def test_mask_lifting(spark):
    mask = spark.createDataFrame([(0, 0, 2, 0.9), (1, 0, 42, 0.9), (0, 1, 5, 0.8), (1, 1, 0, 0.95)], "u int, v int, label int, confidence double")
    at = spark.createDataFrame([(0, k, u, v) for k, (u, v) in enumerate([(0.4, 0.4), (0.0, 1.0), (1.0, 1.0), (5.0, 0.0), (None, 0.0)])], "frame_ord bigint, row_idx bigint, cxd double, cyd double")
    got = echo.mask_labels(at, mask).orderBy("row_idx").collect()
    assert [r.mask_label for r in got] == [2, 5, 255, 255, 255]
    assert [r.mask_reason for r in got] == ["kept", "kept", "unsure", "outside", "no_pixel"]


def test_fusion_table(spark):
    rows = [(2 if k else 20, c, label, cc) for k, c, label, cc in [(0, 0.8, 2, 0.95), (1, 0.5, 5, 0.8), (1, 0.7, 5, 0.95), (1, 0.9, 5, 0.95)]] + [(255, 0.0, 5, 0.8), (255, 0.0, 255, 0.0)]
    df = spark.createDataFrame(rows, "model_label int, model_conf double, camera_label int, camera_conf double")
    got = teacher.fused(df).collect()
    assert [r.label for r in got] == [20, 5, 5, 2, 5, 255]
    assert [r.provenance for r in got] == [4, 2, 3, 1, 2, 0]


def test_metrics(spark):
    df = spark.createDataFrame([(2, 2), (2, 5), (5, 5), (255, 2)], "gt int, pred int")
    m = evaluation.class_metrics(evaluation.confusion(df))
    o = evaluation.overall_metrics(m).first()
    assert round(o.accuracy, 6) == 0.666667 and o.miou == 0.5
    assert evaluation.confusion(df).agg(F.sum("n")).first()[0] == 3


def test_nearest_prefers_the_later_of_two(spark):
    f = spark.createDataFrame([(1, 10_260_000), (2, 5), (3, None), (4, 99_000_000)], "frame_id int, ts_s bigint")
    p = spark.createDataFrame([(7, 10_200_000), (8, 10_300_000), (9, 10_300_000), (5, 10_220_000)], "pose_id int, ts_s bigint")
    got = {r.frame_id: (r.pose_id, r.delta) for r in matching.nearest_in_time(f, p, "frame_id", "pose_id", "ts_s").collect()}
    assert got == {1: (8, 40_000), 2: (7, 10_199_995), 3: (None, None), 4: (9, -88_700_000)}
    near = matching.synced(matching.nearest_in_time(f, p, "frame_id", "pose_id", "ts_s"), 50_000)
    assert {r.frame_id for r in near.where("synced").collect()} == {1}


def test_nearest_sums_no_window_up_again_for_each_row(spark):
    f = spark.createDataFrame([("x", 1, 10), ("y", 1, 10), ("z", 2, None)], "tag string, frame_id int, ts_s bigint")
    p = spark.createDataFrame([(7, 8), (6, 8), (5, 13)], "pose_id int, ts_s bigint")
    near = matching.nearest_in_time(f, p, "frame_id", "pose_id", "ts_s")
    assert "unboundedfollowing" not in near._jdf.queryExecution().optimizedPlan().toString().lower()
    assert near.columns == ["frame_id", "tag", "ts_s", "pose_id", "delta"]
    assert sorted(map(tuple, near.collect())) == [(1, "x", 10, 7, -2), (1, "y", 10, 7, -2), (2, "z", None, None, None)]
    assert {r.pose_id for r in matching.nearest_in_time(f, p.limit(0), "frame_id", "pose_id", "ts_s").collect()} == {None}


def test_segments(spark):
    tags = [(0, k, "a" if k <= 15 else "b" if k <= 30 else "c" if k <= 39 else "a") for k in range(101)] + [(1, 0, "a"), (1, 2, "a")]
    df = spark.createDataFrame(tags, "scene int, frame int, tag string")
    got = matching.tag_segments(df, "scene", "frame", "tag").orderBy("scene", "segment").collect()
    assert [(r.first_frame, r.last_frame) for r in got] == [(0, 15), (16, 30), (31, 39), (40, 100), (0, 0), (2, 2)]


def masks(spark):
    rows = [(1, 1, "car", 0.9, 0, 0, 10, 10), (1, 2, "car", 0.8, 1, 1, 10, 10), (1, 3, "bus", 0.7, 1, 1, 10, 10), (1, 4, "car", 0.6, 30, 30, 2, 2), (2, 5, "car", 0.5, 0, 0, 3, 3)]
    d = spark.createDataFrame(rows, "image_id bigint, det_id bigint, label string, score double, u0 bigint, v0 bigint, w bigint, h bigint")
    return d, D.runs(d)


def test_overlaps_and_suppression(spark):
    d, r = masks(spark)
    pairs = M.overlaps(r)
    one = pairs.where("a = 1 and b = 2").first()
    assert one.intersection == 81 and round(one.iou, 6) == round(81 / 119, 6) and one.containment == 0.81
    assert {x.det_id for x in D.suppressed(d, pairs).collect()} == {1, 3, 4, 5}
    assert {x.det_id: x.cluster_id for x in D.clusters(d, pairs).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}
    found = {x.det_id: (x.view, x.orientation) for x in D.greedy_matches(d.where("label = 'car'"), d.where("label = 'bus'"), pairs).collect()}
    assert found == {1: (3, "bus"), 2: (None, "side"), 4: (None, "side"), 5: (None, "side")}


def test_composition(spark):
    d, r = masks(spark)
    top = {(x.v, x.u): x.det_id for x in M.pixels(M.composed(r, d, (("bus", "car"),))).where("image_id = 1").collect()}
    assert top[0, 0] == 1 and top[5, 5] == 3 and top[30, 30] == 4
    plain = {(x.v, x.u): x.det_id for x in M.pixels(M.composed(r, d)).where("image_id = 1").collect()}
    assert plain[5, 5] == 1
    g = D.mask_geometry(r).where("det_id = 4").first()
    assert (g.area, g.perimeter, g.fill, g.cu) == (4, 8, 1.0, 30.5)


def test_filters_keep_reasons(spark):
    rows = [("arrestor", 0.1, 0.5, 0.2, 0.05), ("arrestor", 0.1, 0.1, 0.2, 0.05), ("arrestor", 0.1, 0.6, 0.3, 0.2), ("other", 0.0, 0.0, 9.0, 9.0), ("blind_spot_mirror", 0.1, 0.1, 0.6, 0.1), ("arrestor", 0.1, 0.5, 0.2, 0.0)]
    d = spark.createDataFrame(rows, "label string, bx double, by double, bw double, bh double")
    got = [(r.reject_filter, r.reject_reason) for r in D.audited(d, D.rule_table(d)).collect()]
    assert got == [(None, None), ("geometry", "bottom_low"), ("geometry", "aspect_low"), (None, None), ("size", "width"), ("geometry", "invalid_box")]


def test_splits_are_partitions(spark):
    m = view(spark, SF, "manifest")
    s = splits.grouped_split(m)
    assert s.count() == m.count()
    assert s.groupBy("source_id").agg(F.countDistinct("new_split").alias("n")).where("n > 1").count() == 0
    share = {r.new_split: r.n / m.count() for r in s.groupBy("new_split").agg(F.count("*").alias("n")).collect()}
    assert abs(share["train"] - 0.7) < 0.05 and abs(share["val"] - 0.15) < 0.05
    f = spark.createDataFrame([(0, 1), (1, 1), (2, 2), (3, 2), (3, 1), (4, 9)], "frame_ord bigint, label int")
    split = {r.frame_ord: r.split for r in splits.rare_class_split(f, 0.5).collect()}
    assert split[4] == "train" and {"train"} <= {split[2], split[3]}


def test_manual_label_policies(spark):
    a = spark.createDataFrame([(0, 0, 1, 5, 50), (0, 0, 2, 6, 50), (0, 0, 3, 7, 20), (0, 1, 1, 8, 5)], "frame_ord bigint, row_idx bigint, object_index int, label int, priority int")
    by = lambda p: {r.row_idx: r.label for r in manifests.manual_labels(a, 0, 10, p).collect()}
    assert by("priority") == {0: 6, 1: 0} and by("last") == {0: 7, 1: 8} and by("first") == {0: 5, 1: 8}
    with pytest.raises(Exception, match="two labels"):
        by("error")


def test_scalar_helpers(spark):
    df = spark.createDataFrame([([0.2, 0.5, 0.3], [0.2, 0.4, 0.4], " Road-Stud _x", "a-1, 22;x")], "p array<double>, q array<double>, t string, i string")
    r = df.select(*[c.alias(n) for n, c in S.top_two("p").items()], S.blended("p", "q", 0.5).alias("b"), S.normal_label("t").alias("n"), S.indices_of("i").alias("x"), S.first_text(F.lit(" "), "t").alias("f")).first()
    assert (r.best, round(r.confidence, 6), round(r.margin, 6)) == (1, 0.5, 0.2)
    assert [round(x, 6) for x in r.b] == [0.2, 0.45, 0.35] and r.n == "roadstudx" and r.x == [-1, 22] and r.f == "Road-Stud _x"
    z = spark.range(1).select(F.lit(0.1).alias("a"), F.lit(0.2).alias("b"), F.lit(0.3).alias("c")).select(F.array(*S.rotation_zyx("a", "b", "c")).alias("m")).first().m
    assert abs(sum(x * x for x in z) - 3) < 1e-9
    poses = spark.createDataFrame([(0, None, 1.0, 0.0), (1, 10.0, 20.0, 0.0), (2, 10.001, 20.0, 5.0)], "k int, lat double, lon double, e double")
    up = S.local_east_north_up(poses, "lat", "lon", "e", "k").orderBy("k").collect()
    assert up[1].north == 0 and 111 < up[2].north < 112 and up[2].up == 5
    w = features.blend_weight(spark.createDataFrame([(0, [0.9, 0.1], [0.1, 0.9]), (1, [0.2, 0.8], [0.9, 0.1])], "label int, p array<double>, q array<double>"), "label", "p", "q", 2, 0.25).first()
    assert w.macro_f1 == 1.0 and w.weight == 0.75


def test_match_order_places_every_match(spark):
    df = spark.range(200).selectExpr("id % 2 AS seq", "CASE WHEN id < 100 THEN CAST(id AS STRING) ELSE concat('f', id) END AS frame")
    got = A.match_order(df, "seq", "frame").collect()
    for seq in (0, 1):
        own = [r.frame for r in sorted((r for r in got if r.seq == seq), key=lambda r: r.place)]
        assert own == [str(k) for k in range(seq, 100, 2)] + [f"f{k}" for k in range(100 + seq, 200, 2)]


def test_label_tables_of_any_size(spark):
    labels = spark.range(1, 601).selectExpr("id * 1000 AS label")
    assert A.known_labels(labels, labels, "label").count() == 600
    mapped = S.remapped(labels, labels.selectExpr("label", "label + 1 AS `to`"), "label", "to")
    assert mapped.where("`to` = label + 1").count() == 600
    classes = spark.range(600).selectExpr("concat('class ', id) AS name", "CAST(id AS INT) AS id")
    objects = spark.range(600).selectExpr("concat('Class_', id) AS label", "CAST(NULL AS INT) AS explicit_id", "CAST(id AS INT) AS want")
    aliases = spark.createDataFrame([("a", "b")], "alias string, targets string")
    assert A.resolved_labels(objects, classes, aliases).where("class_id = want").count() == 600
    assert A.resolved_labels(objects.selectExpr("CAST(want AS STRING) AS label", "explicit_id", "want"), classes, aliases).where("class_id = want").count() == 600


def test_class_aware_split_repairs_every_class(spark):
    pairs = spark.range(800).selectExpr("id AS frame_ord", "concat('c', id div 2) AS label").unionByName(spark.createDataFrame([(900, "alone"), (901, None)], "frame_ord bigint, label string"))
    got = {r.frame_ord: r.split for r in splits.class_aware_split(pairs.selectExpr('*', '1 AS n')).collect()}
    assert len(got) == 802 and got[900] == "train"
    assert all({got[2 * k], got[2 * k + 1]} == {"train", "val"} for k in range(400))


def test_principal_components_are_those_of_the_correlation(spark):
    rng = np.random.default_rng(6)
    v = rng.normal(size=(200, 4)) @ rng.normal(size=(4, 4)) * [1, 10, 0.1, 3] + 2
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "vec_id int, v array<double>")
    found, share = features.principal_components(df, "v")
    got = np.array([r.components.toArray() for r in found.orderBy("vec_id").collect()])
    z = (v - v.mean(axis=0)) / v.std(axis=0, ddof=1)
    e, u = np.linalg.eigh(np.corrcoef(v.T))
    want = z @ u[:, ::-1][:, :2]
    assert np.allclose(share, (e / e.sum())[::-1][:2])
    assert np.allclose(got * np.sign((got * want).sum(axis=0)), want)


def test_lenient_alignment_never_broadcasts_a_row_a_point(spark):
    from pointloom.plans.alignment_queries import joi15

    df = joi15(spark, "/root/testdata/sf0.001")
    assert df.count() == len(df.collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [frame_ord" in plan and not [x for x in plan.splitlines() if "BroadcastHashJoin" in x and "place" in x]


def test_temporal_support_is_that_of_all_pairs(spark):
    import random

    rnd = random.Random(4)
    for tolerance in (0.75, 0.0):
        rows = [(f, k % 2, k % 3, rnd.choice((round(rnd.uniform(0, 30), 2), 0.75 * rnd.randint(0, 40), 0.75 * rnd.randint(0, 40) + rnd.choice((4e-7, 6e-7)), float("nan"), None, 1e13 * rnd.randint(-2, 2))), f * 1000 + k) for f in range(4) for k in range(90)]
        p = spark.createDataFrame(rows, "frame_ord bigint, slot bigint, pixel bigint, distance double, row_idx bigint")
        fine = [r for r in rows if r[3] is not None and r[3] == r[3]]
        beside = lambda r, d: [q[3] for q in fine if q[0] == r[0] + d and q[1:3] == r[1:3]]  # noqa: B023, E731
        near = lambda r, d: r in fine and any(round(abs(x - r[3]), 6) <= tolerance for x in beside(r, d))  # noqa: B023, E731
        want = {r[4]: (sum(bool(beside(r, d)) for d in (-1, 1)), sum(near(r, d) for d in (-1, 1))) for r in rows}
        assert {r.row_idx: (r.checked, r.support) for r in echo.temporal_support(p, tolerance).collect()} == want


def test_temporal_support_of_a_full_cell_is_not_quadratic(spark):
    import time

    n = 30_000
    p = spark.range(2 * n).selectExpr("id % 2 AS frame_ord", "1L AS slot", "1L AS pixel", "id / 1e4 + 100 * (id % 2) AS distance", "id AS row_idx")
    begun = time.time()
    assert tuple(echo.temporal_support(p).agg(F.sum("checked"), F.sum("support")).first()) == (2 * n, 0)
    assert time.time() - begun < 30


def test_geometry_moves_runs_once(spark):
    d = spark.createDataFrame([(1, 1, v, u, u + n) for v, u, n in ((0, 0, 2), (0, 4, 3), (1, 1, 5), (2, 0, 1), (2, 2, 9), (5, 0, 4))], "image_id bigint, det_id bigint, v bigint, u0 bigint, u1 bigint")
    g = D.mask_geometry(d)
    cells = {(r.v, u) for r in d.collect() for u in range(r.u0, r.u1)}
    assert g.first().perimeter == sum((v + a, u + b) not in cells for v, u in cells for a, b in ((0, 1), (1, 0), (0, -1), (-1, 0)))
    assert " Join" not in g._jdf.queryExecution().optimizedPlan().toString()


def test_merged_ids_are_never_broadcast(spark):
    parts = {n: spark.range(6).select(F.col("id").alias("sample_id"), F.lit(n).alias("label")) for n in "ab"}
    reviewed = spark.createDataFrame([("a_1",), ("a_1",), ("b_4",), ("c_0",)], "merged_id string")
    out = manifests.merged(parts, reviewed)
    assert sorted((r.merged_id, r.sample_id, r.label) for r in out.collect()) == [("a_1", 1, "a"), ("b_4", 4, "b")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_bounds_take_rounding_in():
    import decimal

    from pointloom.functions import scalars as S

    half = lambda x: decimal.Decimal(repr(x)).quantize(decimal.Decimal("1e-6"), decimal.ROUND_HALF_UP)
    for bound in (0.3, 0.7, 1.0, -0.05, 0.08, 2.5):
        cut = S.rounds_from(bound)
        assert half(cut) >= half(bound) > half(np.nextafter(cut, -np.inf).item())


def test_comparisons_are_those_of_rounded_values(spark):
    from pointloom.functions import scalars as S

    near = [b + d for b in (0.3, -0.05, 2.5, 80.0) for d in (-2e-6, -6e-7, -5e-7, -4e-7, 0.0, 4e-7, 5e-7, 6e-7, 2e-6)]
    df = spark.createDataFrame([(x, y) for x in [*near, float("nan"), float("inf"), None, 1e13] for y in (0.3, -0.0499996, 2.5000004, 80.0, None)], "x double, y double")
    for bound in (0.3, -0.05, 2.5, F.col("y")):
        other = bound if isinstance(bound, float) else F.round("y", 6)
        wrong = ~S.at_least("x", bound).eqNullSafe(F.round("x", 6) >= other) | ~S.at_most("x", bound).eqNullSafe(F.round("x", 6) <= other)
        assert df.where(wrong).count() == 0


def test_scores_fit_into_compiled_methods(spark, capsys):
    import re

    from pointloom.plans import point_queries

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        point_queries.dom3(spark, "/root/testdata/sf0.001").explain("codegen")
        assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out))) < 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_given_flags_leave_the_scores_as_they_are(spark):
    from pointloom.plans import views

    p, x = (views.view(spark, "/root/testdata/sf0.001", n) for n in ("points", "pixels"))
    names = ["frame_ord", "row_idx", *[f"s_{n}" for n in teacher.NOISE_IDS], "f_ctx"]
    plain = teacher.rule_scores(teacher.teacher_features(p, x)).select(*names)
    early = teacher.rule_scores(teacher.teacher_features(p, x, teacher.early_flags())).select(*names)
    assert plain.exceptAll(early).count() == 0 and plain.count() == early.count() == p.count()


@pytest.mark.parametrize("few", [-1, 1 << 18])
def test_columns_need_no_full_features(spark, monkeypatch, few):
    monkeypatch.setattr(echo, "FEW", few)
    p, x = view(spark, SF, "points"), view(spark, SF, "pixels")
    p = p.withColumn("intensity", F.when(F.col("row_idx") % 97 == 0, float("nan")).otherwise(F.col("intensity"))).localCheckpoint()
    lean, full = teacher.teacher_columns(teacher.column_features(p, x)), teacher.teacher_columns(teacher.teacher_features(p, x))
    names = [c for c in full.columns if c in lean.columns]
    assert len(names) > len(p.columns) + 12
    assert lean.select(names).exceptAll(full.select(names)).count() == 0 and lean.count() == full.count() == p.count()


def test_isolated_points_are_those_of_few_around(spark):
    rows = [(f, k, a, v) for f in (1, 2) for k, (a, v) in enumerate([(0.1, 0.1), (0.6, 0.1), (0.7, 0.2), (5.0, 5.0), (5.1, 5.1), (5.2, 5.9), (5.6, 4.6), (9.0, None), (-0.1, -0.1)])]
    p = spark.createDataFrame(rows, "frame_ord bigint, row_idx bigint, azimuth double, vertical double")
    for most in (0, 1, 2, 3):
        want = echo.angular_density(p).selectExpr("frame_ord", "row_idx", f"density <= {most} AS isolated")
        assert sorted(echo.isolated(p, most).select("frame_ord", "row_idx", "isolated").collect()) == sorted(want.collect())


def test_teacher_columns_deal_points_by_echo_groups_last(spark):
    from pointloom.plans.point_queries import dom2_columns

    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        node, dealt = dom2_columns(spark, SF)._jdf.queryExecution().executedPlan(), 0
    finally:
        for k in off:
            spark.conf.unset(k)
    while node.children().size():
        dealt += node.nodeName() == "Exchange"
        node = node.children().apply(0)
    assert dealt <= 3  # places in a frame, echo groups, frames without these


def test_points_without_a_pixel_are_spread(spark):
    p = spark.range(1000).selectExpr("id AS row_idx", "CAST(NULL AS DOUBLE) AS cxd", "1e0 AS cyd").union(spark.sql("SELECT 1000L, 2e0, 1e0"))
    mask = spark.createDataFrame([(2, 1, 7, 0.9), (None, 1, 8, 0.9)], "u bigint, v bigint, label bigint, confidence double")
    got = echo.mask_labels(p, mask.hint("merge"))
    assert got.where("mask_label = 7").count() == 1 and got.where("mask_reason = 'no_pixel'").count() == 1000
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would join the small parts again
    try:
        assert got.withColumn("task", F.spark_partition_id()).where("u IS NULL").select("task").distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_frame_maxima_are_those_of_the_features(spark):
    rows = [(1, 1, 1, 300.0, 2.0), (1, 1, 1, 20.0, float("nan")), (1, 2, 1, float("nan"), 1.0), (2, 1, 1, 0.5, 0.2), (2, 1, 1, 0.25, None), (3, None, 1, 9.0, 0.1), (3, 1, 1, 90.0, 0.1), (3, 1, 1, 3.0, 0.1), (4, 1, 1, None, None)]
    p = spark.createDataFrame([(f, s, q, i, r, 1.0 * (k % 5), 0.0, 1.0, 1.0, k) for k, (f, s, q, i, r) in enumerate(rows)], "frame_ord bigint, slot bigint, pixel bigint, intensity double, reflectivity double, x double, y double, z double, distance double, row_idx bigint")
    e, fine = echo.echo_features(p), lambda n: F.when(~F.isnan(n), F.col(n))
    want = e.groupBy("frame_ord").agg(F.max(fine("intensity")).alias("i"), F.max(fine("reflectivity")).alias("r"), F.coalesce(F.max(F.abs("strongest_delta")), F.lit(0.0)).alias("d"))
    got = teacher.frame_maxima(p).select("frame_ord", "i_most", "r_most", F.coalesce("d_most", F.lit(0.0)))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.toDF(*got.columns).collect()))
