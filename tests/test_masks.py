"""Overlaps, composition and fragments against pixel sets."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pointloom.operators import masks as M

DETS = "image_id bigint, det_id bigint, label string, score double"
RUNS = "image_id bigint, det_id bigint, v bigint, u0 bigint, u1 bigint"


def scene(seed, images=4, dets=14, size=24):
    """Masks with holes and several runs a row; equal scores, odd scores, empty rows."""
    rnd = random.Random(seed)
    found, pixels = [], {}
    for image in range(images):
        for k in range(dets):
            det = image * 1000 + (k * 5) % dets
            score = rnd.choice((0.9, 0.9, 0.8, 0.8000005, 0.3, 0.1, 0.0, None, float("nan"))) if k % 3 == 0 else round(rnd.random(), 2)
            found.append((image, det, rnd.choice("abc"), score))
            v0, u0 = rnd.randrange(size), rnd.randrange(size) - 5
            pixels[image, det] = {(v, u) for v in range(v0, v0 + rnd.randint(1, 9)) for u in range(u0, u0 + rnd.randint(1, 11)) if rnd.random() < 0.8}
    return found, pixels


def runs_of(pixels):
    out = []
    for (image, det), held in pixels.items():
        for v, u in sorted(held):
            if out and out[-1][:3] == (image, det, v) and out[-1][4] == u:
                out[-1] = (image, det, v, out[-1][3], u + 1)
            else:
                out.append((image, det, v, u, u + 1))
    return out


def frames(spark, found, pixels):
    return spark.createDataFrame(found, DETS), spark.createDataFrame(runs_of(pixels), RUNS)


@pytest.mark.parametrize(("whole", "block", "tile"), [((2048, 1 << 16), 1024, (256, 1024)), ((0, 0), 3, (4, 5)), ((10, 40), 1024, (256, 1024))])
def test_overlaps_are_those_of_pixel_sets(spark, monkeypatch, whole, block, tile):
    monkeypatch.setattr(M, "WHOLE", whole)
    monkeypatch.setattr(M, "BLOCK", block)
    monkeypatch.setattr(M, "TILE", tile)
    monkeypatch.setattr(M, "STEP", 50)
    found, pixels = scene(1)
    d, r = frames(spark, found, pixels)
    label = {(i, k): x for i, k, x, _ in found}
    want = {(x[0], x[1], y[1]): len(p & q) for x, p in pixels.items() for y, q in pixels.items() if x[0] == y[0] and x[1] < y[1] and p & q}
    for labels in (None, d):
        got = {(x.image_id, x.a, x.b): (x.intersection, x.area_a, x.area_b) for x in M.overlaps(r, labels).collect()}
        assert got == {k: (n, len(pixels[k[0], k[1]]), len(pixels[k[0], k[2]])) for k, n in want.items() if labels is None or label[k[0], k[1]] == label[k[0], k[2]]}


def in_turn(found):
    return sorted((f for f in found if f[3] is not None and f[3] == f[3]), key=lambda f: (f[0], -f[3], f[1]))


def plain_composed(found, pixels, over, least):
    shown = {}
    for image, det, label, score in in_turn(found):
        mine = pixels[image, det]
        wins = set()
        for p in mine:
            _, present, conf = shown.get((image, *p), (None, None, 0.0))
            if (score > conf or (label, present) in over) and (present, label) not in over:
                wins.add(p)
        if len(mine) >= least and len(wins) >= least:
            shown.update({(image, *p): (det, label, score) for p in wins})
    return shown


@pytest.mark.parametrize("least", [0, 1, 12, 40])
@pytest.mark.parametrize("over", [(), (("b", "a"), ("c", "b"))])
def test_composition_with_dominance_and_area(spark, least, over):
    found, pixels = scene(2)
    d, r = frames(spark, found, pixels)
    got = {(x.image_id, x.v, x.u): (x.det_id, x.label, x.confidence) for x in M.pixels(M.composed(r, d, over, least)).collect()}
    assert got == plain_composed(found, pixels, over, least)


def test_accepted_area_skips_what_shows_too_little(spark):
    d = spark.createDataFrame([(1, 1, "a", 0.9), (1, 2, "a", 0.8)], DETS)
    r = spark.createDataFrame([(1, 1, 0, 0, 50), (1, 2, 0, 10, 60)], RUNS)
    assert {x.det_id for x in M.composed(r, d, (), 40).collect()} == {1}
    assert {(x.det_id, x.u0, x.u1) for x in M.composed(r, d, (), 10).collect()} == {(1, 0, 50), (2, 50, 60)}


def test_video_composition_shows_the_last_of_equal_scores(spark):
    found, pixels = scene(3)
    d, r = frames(spark, found, pixels)
    want = {}
    for image, det, label, score in sorted(in_turn(found), key=lambda f: (f[3], f[1])):
        want |= {(image, *p): (det, label, score) for p in pixels[image, det]}
    shown = M.video_composed(r, d)
    assert {(x.image_id, x.v, x.u): (x.det_id, x.label, x.confidence) for x in M.pixels(shown).collect()} == want
    sizes = Counter((k[0], v[1]) for k, v in want.items())
    assert {(x.image_id, x.label): x.pixels for x in M.image_presence(shown, 30).collect()} == {k: n for k, n in sizes.items() if n >= 30}


@pytest.mark.parametrize("least", [1, 6, 25])
def test_fragments_are_claimed_in_turn_and_freed(spark, least):
    found, pixels = scene(4)
    d, r = frames(spark, found, pixels)
    shown = M.composed(r, d, (("b", "a"),), 3)
    top = {(x.image_id, x.v, x.u): (x.label, x.confidence) for x in M.pixels(shown).collect()}
    taken, want = set(), {}
    for image, det, label, score in in_turn(found):
        mine = {p for p in pixels[image, det] if (image, *p) in top and top[image, *p][0] == label and abs(top[image, *p][1] - score) <= 1e-6 + 1e-5 * abs(score) and (image, *p) not in taken}
        if len(pixels[image, det]) >= least and len(mine) >= least:
            taken |= {(image, *p) for p in mine}
            want[image, det] = mine
    got = {}
    for x in M.visible_fragments(shown, r, d, least).collect():
        got.setdefault((x.image_id, x.det_id), set()).update((x.v, u) for u in range(x.u0, x.u1))
    assert got == want


def test_no_masks(spark):
    d, r = spark.createDataFrame([], DETS), spark.createDataFrame([], RUNS)
    assert M.overlaps(r).count() == M.composed(r, d, (), 5).count() == M.video_composed(r, d).count() == M.visible_fragments(M.composed(r, d), r, d).count() == 0


def test_thousands_of_detections_in_one_image(spark):
    n = 5000
    d = spark.range(n).select(F.lit(1).cast("bigint").alias("image_id"), F.col("id").alias("det_id"), (F.col("id") % 500).alias("u0"))
    r = d.select("image_id", "det_id", F.explode(F.expr("sequence(0L, 2L)")).alias("v"), "u0", (F.col("u0") + 3).alias("u1"))
    got = M.overlaps(r).agg(F.count("*").alias("n"), F.sum("intersection").alias("s")).first()
    place = [k % 500 for k in range(n)]
    size = Counter(place)
    want = {0: sum(c * (c - 1) // 2 for c in size.values())} | {g: sum(size[p] * size[p + g] for p in size if p + g in size) for g in (1, 2)}
    assert got.n == sum(want.values()) and got.s == sum(3 * (3 - g) * c for g, c in want.items())


@pytest.mark.parametrize(("whole", "block", "copies", "step"), [((1 << 14, 1 << 19), 1024, 256, 1 << 20), ((0, 0), 4, 3, 7), ((0, 0), 3, 1, 1000), ((9, 99), 1024, 2, 50)])
def test_overlaps_of_copies_are_all_there(spark, monkeypatch, whole, block, copies, step):
    for name, value in {"WHOLE": whole, "BLOCK": block, "COPIES": copies, "STEP": step}.items():
        monkeypatch.setattr(M, name, value)
    found, pixels = scene(9, images=2, dets=9, size=12)
    found = [(i, k * 7 + 13 * c % 5, x, s) for i, k, x, s in found for c in range(5)]
    pixels = {(i, k * 7 + 13 * c % 5): p for (i, k), p in pixels.items() for c in range(5)}
    _, r = frames(spark, found, pixels)
    want = {}
    for x, p in pixels.items():
        for y, q in pixels.items():
            if x[0] == y[0] and x[1] < y[1] and p & q:
                n = len(p & q)
                want[x[0], x[1], y[1]] = (n, len(p), len(q), round(n / len(p | q), 4), round(n / min(len(p), len(q)), 4))
    rows = M.overlaps(r, digits=4).collect()
    assert len(rows) == len(want) and all(x.containment == x.overlap for x in rows)
    got = {(x.image_id, x.a, x.b): (x.intersection, x.area_a, x.area_b, x.iou, x.overlap) for x in rows}
    assert got == {k: (*v[:3], pytest.approx(v[3], abs=1e-4), pytest.approx(v[4], abs=1e-4)) for k, v in want.items()}


def test_overlaps_deal_different_masks_only(spark, monkeypatch):
    from pyspark.sql import GroupedData

    n, dealt, apply = 5000, [], GroupedData.applyInArrow
    monkeypatch.setattr(GroupedData, "applyInArrow", lambda self, *rest: dealt.append(self._df) or apply(self, *rest))
    d = spark.range(n).select(F.lit(1).cast("bigint").alias("image_id"), F.col("id").alias("det_id"), (F.col("id") % 500).alias("u0"))
    M.overlaps(d.select("image_id", "det_id", F.explode(F.expr("sequence(0L, 2L)")).alias("v"), "u0", (F.col("u0") + 3).alias("u1")))
    assert dealt[0].count() == 500


def test_context_ring_is_the_box_without_the_mask(spark):
    from pointloom.operators import detections as D

    found, pixels = scene(5, images=2)
    pixels = {k: {(v, u + 5) for v, u in p} for k, p in pixels.items() if p}
    _, r = frames(spark, found, pixels)
    wide, high = 40, 34
    got = {}
    for x in D.context_ring(r, wide, high, 2.5).collect():
        got.setdefault((x.image_id, x.det_id), []).extend((x.v, u) for u in range(x.u0, x.u1))
    for key, p in pixels.items():
        rows, cols = [v for v, _ in p], [u for _, u in p]
        span = []
        for low, end, most in ((min(cols), max(cols) + 1, wide), (min(rows), max(rows) + 1, high)):
            size = min(most, max(end - low, -(-5 * (end - low) // 2)))
            start = min(max((low + end - size) // 2, 0), most - size)
            span.append(range(start, start + size))
        assert sorted(got.get(key, [])) == sorted((v, u) for v in span[1] for u in span[0] if (v, u) not in p)
    g = {(x.image_id, x.det_id): x for x in D.mask_values(D.mask_geometry(r), wide, high).collect()}
    for key, p in pixels.items():
        edge = sum((v + a, u + b) not in p for v, u in p for a, b in ((0, 1), (1, 0), (0, -1), (-1, 0)))
        assert g[key].mask_compactness == pytest.approx(4 * 3.141592653589793 * len(p) / edge**2) and g[key].touches_left == float(min(u for _, u in p) == 0)
        assert g[key].mask_centroid_x == pytest.approx(sum(u for _, u in p) / len(p) / wide) and g[key].distance_to_bottom == pytest.approx((high - max(v for v, _ in p) - 1) / high)


def test_choices_from_runs_are_those_from_pair_lists(spark):
    from pointloom.operators import detections as D

    found, pixels = scene(6, dets=41, size=10)
    for at, (one, other) in enumerate(zip(found, found[1:])):  # every third mask is a copy of the one before it
        if at % 3 == 0 and one[0] == other[0]:
            pixels[other[:2]] = pixels[one[:2]]
    found = [(i, k, x, 0.5 if s is None or s != s else s) for i, k, x, s in found]
    d, r = frames(spark, found, pixels)
    r = r.localCheckpoint()
    in_order = lambda df: sorted(map(tuple, df.collect()), key=repr)
    pairs = M.overlaps(r).localCheckpoint()
    for t in (0.2, 0.5):
        assert in_order(M.suppressed_masks(r, d, t)) == in_order(D.suppressed(d, pairs, t))
        assert in_order(M.clustered_masks(r, d, t, t + 0.25)) == in_order(D.clusters(d, pairs, t, t + 0.25))
        vehicles, views = d.where("det_id % 2 = 0"), d.where("det_id % 2 = 1")
        assert in_order(M.matched_masks(r, vehicles, views, t)) == in_order(D.greedy_matches(vehicles, views, pairs, t))


@pytest.fixture(scope="module")
def copies(spark, tmp_path_factory):
    """Orders that are 40,000 copies of one mask in one image, each score its own: 8e8 pairs."""
    path = str(tmp_path_factory.mktemp("copies"))
    kind = F.when(F.col("id") % 2 == 0, "O").otherwise("F")
    spark.range(40_000).select(
        (F.col("id") * 360).alias("o_orderkey"), F.lit(0).cast("bigint").alias("o_custkey"), F.lit("1-URGENT").alias("o_orderpriority"), kind.alias("o_orderstatus"), F.col("id").cast("double").alias("o_totalprice")
    ).write.parquet(f"{path}/orders.parquet")
    return path


def test_matches_of_many_copies_need_no_pairs(spark, copies):
    from pointloom.plans.detection_queries import joi11

    got = joi11(spark, copies).agg(F.count("view"), F.count_if(F.col("view") == F.col("det_id") + 360)).first()
    assert tuple(got) == (20_000, 20_000)


def test_suppression_of_many_copies_needs_no_pairs(spark, copies):
    from pointloom.plans.detection_queries import dom16

    assert [x.det_id for x in dom16(spark, copies).collect()] == [39_999 * 360]


def test_clusters_of_many_copies_need_no_pairs(spark, copies):
    from pointloom.plans.detection_queries import dom17

    assert [tuple(x) for x in dom17(spark, copies).groupBy("cluster_id").count().collect()] == [(39_999 * 360, 40_000)]


def test_overlaps_of_large_images_are_not_shuffled_as_pairs(spark):
    d, r = frames(spark, *scene(8))
    plan = M.overlaps(r)._jdf.queryExecution().executedPlan().toString()
    last = plan.index("FlatMapGroupsInArrow")
    assert "Exchange" not in plan[:last] and "Join" not in plan[:last]


def test_equal_masks_share_one_look_at_their_context(spark, monkeypatch):
    from pointloom.operators import alignment as A
    from pointloom.operators import detections as D

    found, pixels = scene(7, images=3)
    pixels = {k: {(v, u + 5) for v, u in p} for k, p in pixels.items() if p}
    copies = {(i, k + 1000 * c): p for (i, k), p in pixels.items() for c in range(4)}
    _, r = frames(spark, [(i, k + 1000 * c, x, s) for i, k, x, s in found for c in range(4)], copies)
    colours = spark.range(70 * 70).selectExpr("id % 70 - 5 AS u", "id DIV 70 - 5 AS v", "(id * 7 % 31) / 31D AS r", "(id % 11) / 10D AS g", "(id % 7) / 7D AS b")
    met, meet = [], D.run_colours
    monkeypatch.setattr(D, "run_colours", lambda runs, *rest: met.append(runs) or meet(runs, *rest))
    got = {(x.image_id, x.det_id): x.asDict() for x in D.context_appearance(r, colours, 40, 34, 2.5).collect()}
    want = {(x.image_id, x.det_id): x.asDict() for x in A.region_appearance(meet(D.context_ring(r, 40, 34, 2.5), colours), ["image_id", "det_id"]).collect()}
    assert got.keys() == want.keys() and len(got) > 4
    for key, x in want.items():
        assert got[key] == pytest.approx(x)
    assert met[0].select("image_id", "det_id").distinct().count() <= len({frozenset(p) for p in pixels.values()})


@pytest.mark.parametrize("over", [(), (("b", "a"),), (("b", "a"), ("c", "b"))])
def test_equal_runs_are_dealt_once(spark, over):
    found, pixels = scene(8, images=2)
    copies = {(i, k + 1000 * c): p for (i, k), p in pixels.items() for c in range(3)}
    found = [(i, k + 1000 * c, "abc"[("abc".index(x) + k * c) % 3], None if s is None else s - (0.05 + 1e-6 * k) * (c == 2)) for i, k, x, s in found for c in range(3)]
    d, r = frames(spark, found, copies)
    shown = {(x.image_id, x.v, x.u): (x.det_id, x.label, x.confidence) for x in M.pixels(M.composed(r, d, over)).collect()}
    assert shown == plain_composed(found, copies, over, 0)
    dealt = M.video_composed(r, d)._jdf.queryExecution().optimizedPlan().toString()
    assert dealt.index("FlatMapGroupsInArrow") < dealt.index("Aggregate")


def test_only_detections_near_what_shows_are_asked_for_fragments(spark):
    d = spark.createDataFrame([(1, k, "a" if k % 2 else None, s) for k, s in enumerate((0.5, 0.500005, 0.49999, -0.3, -0.300003, 0.0, 1e-6, -1e-6, 2.5e-6, 1e9, 1e9 + 1e4, 1e9 + 2e4, None, float("nan")))], DETS)
    seen = [(1, "a", 0.50001), (1, None, 0.500004), (1, "a", -0.300001), (1, None, 0.0), (1, "a", 1e9), (2, "a", 0.5)]
    shown = spark.createDataFrame([(i, 0, 0, 1, x, c) for i, x, c in seen], "image_id bigint, v bigint, u0 bigint, u1 bigint, label string, confidence double")
    for near, share in ((1e-6, 1e-5), (1e-6, 0.0), (0.2, 0.5), (1e-3, 0.1)):
        want = {x.det_id for x in d.collect() if x.score is not None and any(i == 1 and c == x.label and abs(s - x.score) <= near + share * abs(x.score) for i, c, s in seen)}
        assert {x.det_id for x in M._near_shown(d, shown, near, share).collect()} == want
