"""Detections: filters, suppression, clusters, matches, geometry.

A mask is a set of runs (image, v, u0, u1): columns u0 to u1 - 1 of row v; ``masks`` has
what works on these alone. Only the greedy choices among detections of one image, which
depend on what was chosen before, run as grouped pandas functions on pair lists.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointloom.functions.scalars import box_metrics
from pointloom.operators.alignment import region_appearance

# Label -> (least bottom, most bottom, least aspect, most aspect).
GEOMETRY = {
    "arrestor": (0.4, None, 2.0, None), "wheel_chock": (0.4, None, 1.5, None), "height_restriction_barrel": (0.4, None, 0.0, None), "underground_parking_sign": (None, 0.4, 1.0, None),
    "induction_sign": (None, 0.5, 1.0, 4.0), "ground_markings": (0.4, None, None, None), "parking_barrier_lock": (0.5, None, None, None), "pillar_corner_guard": (0.2, None, None, 0.9),
}
# Label -> (most width, most height, most area).
SIZES = {"arrestor": (0.4, 0.15, 0.07), "wheel_chock": (0.4, 0.15, 0.07), "blind_spot_mirror": (0.5, 0.5, 0.25)}


def rule_table(like: DataFrame, geometry: dict = GEOMETRY, sizes: dict = SIZES) -> DataFrame:
    """UDF3: the filters as a table of one row per label, to be broadcast up to 10,000 of them; callers may bring their own, which Spark joins by its size."""
    rows = [(n, *geometry.get(n, (None,) * 4), *sizes.get(n, (None,) * 3), n in geometry, n in sizes) for n in sorted({*geometry, *sizes})]
    schema = "label string, min_bottom double, max_bottom double, min_aspect double, max_aspect double, max_w double, max_h double, max_area double, has_geometry boolean, has_size boolean"
    made = like.sparkSession.createDataFrame(rows, schema)
    return F.broadcast(made) if len(rows) <= 10_000 else made


def audited(detections: DataFrame, rules: DataFrame, x: str = "bx", y: str = "by", w: str = "bw", h: str = "bh") -> DataFrame:
    """FLT2 to FLT4: ``reject_filter`` and ``reject_reason`` of each detection, geometry first; both null for kept ones."""
    m = box_metrics(x, y, w, h)
    df = detections.withColumns(m).join(rules, "label", "left")
    c = F.col
    geometry = F.when(c("bottom").isNull(), "invalid_box").when(c("bottom") < c("min_bottom"), "bottom_low").when(c("bottom") > c("max_bottom"), "bottom_high").when(c("aspect") < c("min_aspect"), "aspect_low").when(c("aspect") > c("max_aspect"), "aspect_high")
    size = F.when(c("bottom").isNull(), "invalid_box").when(c(w) > c("max_w"), "width").when(c(h) > c("max_h"), "height").when(c("area") > c("max_area"), "area")
    g = F.when(F.coalesce(c("has_geometry"), F.lit(False)), geometry)
    s = F.when(F.coalesce(c("has_size"), F.lit(False)), size)
    return df.withColumns({"reject_filter": F.when(g.isNotNull(), "geometry").when(s.isNotNull(), "size"), "reject_reason": F.coalesce(g, s)}).select(*detections.columns, *m, "reject_filter", "reject_reason")


def above_threshold(detections: DataFrame, thresholds: DataFrame, default: float) -> DataFrame:
    """FLT5: scores from the label's threshold on, or the common one."""
    joined = detections.join(thresholds, "label", "left")
    return joined.where(F.round("score", 6) >= F.coalesce("threshold", F.lit(default))).drop("threshold")


def runs(rectangles: DataFrame) -> DataFrame:
    """Runs of rectangles (u0, v0, w, h)."""
    return rectangles.select(
        "image_id", "det_id", F.explode(F.sequence("v0", F.col("v0") + F.col("h") - 1)).alias("v"), "u0", (F.col("u0") + F.col("w")).alias("u1")
    )


def areas(masks: DataFrame) -> DataFrame:
    """FLT6: pixels of each detection's mask."""
    return masks.groupBy("image_id", "det_id").agg(F.sum(F.col("u1") - F.col("u0")).alias("area"))


def suppressed(detections: DataFrame, pairs: DataFrame, most: float = 0.5) -> DataFrame:
    """DOM16: per image and label, by falling score, a detection goes if its IoU with a kept one exceeds ``most``."""
    d = detections.select("image_id", "det_id", "label", "score")
    close = pairs.where(F.col("iou") > most).select("image_id", "a", "b")
    sided = close.select("image_id", F.col("a").alias("det_id"), F.col("b").alias("other")).union(close.select("image_id", "b", "a"))
    listed = d.join(sided.groupBy("image_id", "det_id").agg(F.collect_list("other").alias("others")), ["image_id", "det_id"], "left")

    def keep(group: pd.DataFrame) -> pd.DataFrame:
        gone: set = set()
        label = dict(zip(group["det_id"], group["label"]))
        kept = []
        for det, own, others in group.sort_values(["score", "det_id"], ascending=[False, True])[["det_id", "label", "others"]].itertuples(index=False):
            if det in gone:
                continue
            kept.append(det)
            gone.update(o for o in (others if others is not None else ()) if label.get(o) == own)
        return group[group["det_id"].isin(kept)][["image_id", "det_id"]]

    return listed.groupBy("image_id").applyInPandas(keep, "image_id bigint, det_id bigint")


def clusters(detections: DataFrame, pairs: DataFrame, iou: float = 0.55, containment: float = 0.80) -> DataFrame:
    """DOM17: by falling score each detection joins the best overlapping cluster's head, or heads a new one."""
    near = pairs.where((F.col("iou") >= iou) | (F.col("containment") >= containment)).select("image_id", "a", "b", F.greatest("iou", "containment").alias("fit"))
    sided = near.select("image_id", F.col("a").alias("det_id"), F.col("b").alias("other"), "fit").union(near.select("image_id", "b", "a", "fit"))
    listed = detections.select("image_id", "det_id", "score").join(sided.groupBy("image_id", "det_id").agg(F.collect_list(F.struct("other", "fit")).alias("others")), ["image_id", "det_id"], "left")

    def assign(group: pd.DataFrame) -> pd.DataFrame:
        heads: dict = {}
        for det, others in group.sort_values(["score", "det_id"], ascending=[False, True])[["det_id", "others"]].itertuples(index=False):
            fits = [(o["fit"], -o["other"]) for o in (others if others is not None else ()) if heads.get(o["other"]) == o["other"]]
            heads[det] = -max(fits)[1] if fits else det
        return pd.DataFrame({"image_id": group["image_id"], "det_id": group["det_id"], "cluster_id": [heads[d] for d in group["det_id"]]})

    return listed.groupBy("image_id").applyInPandas(assign, "image_id bigint, det_id bigint, cluster_id bigint")


def listed(masks: DataFrame) -> DataFrame:
    """(image_id, det_id, runs): each mask as one row, its runs (v, u0, u1) by row and first column."""
    return masks.groupBy("image_id", "det_id").agg(_listed_runs())


def _listed_runs() -> Column:
    return F.array_sort(F.collect_list(F.struct(*[F.col(c).cast("bigint").alias(c) for c in ("v", "u0", "u1")]))).alias("runs")


def _touching(runs: Column) -> Column:
    """Pixels of sorted runs that have a pixel right above them: each run meets those of the row before it."""
    none = F.array().cast("array<struct<v:bigint,u0:bigint,u1:bigint>>")
    shared = lambda a, x: F.greatest(F.lit(0).cast("bigint"), F.least(a["u1"], x["u1"]) - F.greatest(a["u0"], x["u0"]))

    def step(s: Column, x: Column) -> Column:
        same, above = s["v"] == x["v"], F.when(s["v"] == x["v"], s["above"]).when(s["v"] == x["v"] - 1, s["own"]).otherwise(none)
        met = F.aggregate(above, s["n"], lambda n, a: n + shared(a, x))
        return F.struct(x["v"].alias("v"), above.alias("above"), F.when(same, F.concat(s["own"], F.array(x))).otherwise(F.array(x)).alias("own"), met.alias("n"))

    start = F.struct(F.lit(None).cast("bigint").alias("v"), none.alias("above"), none.alias("own"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(runs, start, step, lambda s: s["n"])


def mask_geometry(masks: DataFrame) -> DataFrame:
    """AGG17: bounds, area, centroid, fill and perimeter of each mask, from its runs.

    Perimeter: two ends a run, and the pixels whose neighbour in the row above or below is outside. A mask's runs
    move once, as one list.
    """
    n = F.col("u1") - F.col("u0")
    base = masks.groupBy("image_id", "det_id").agg(
        F.min("u0").alias("min_u"), F.max("u1").alias("max_u"), F.min("v").alias("min_v"), (F.max("v") + 1).alias("max_v"), F.sum(n).alias("area"),
        (F.sum(n * (F.col("u0") + F.col("u1") - 1)) / 2.0 / F.sum(n)).alias("cu"), (F.sum(n * F.col("v")) / F.sum(n)).alias("cv"), F.count("*").alias("run_rows"), _listed_runs(),
    )
    return base.withColumn("touching", _touching(F.col("runs"))).withColumns({
        "fill": F.col("area") / ((F.col("max_u") - F.col("min_u")) * (F.col("max_v") - F.col("min_v"))), "perimeter": 2 * F.col("run_rows") + 2 * F.col("area") - 2 * F.col("touching"),
    }).drop("run_rows", "touching", "runs")


def mask_values(geometry: DataFrame, width: int, height: int) -> DataFrame:
    """AGG17: the 25 values of ``mask_geometry``'s masks as shares of an image of ``width`` x ``height`` pixels."""
    c = F.col
    x0, y0, x1, y1, w, h = c("min_u"), c("min_v"), c("max_u"), c("max_v"), F.lit(float(width)), F.lit(float(height))
    bw, bh = x1 - x0, y1 - y0
    middle = ((x0 + x1) * 0.5 / w, (y0 + y1) * 0.5 / h)
    touches = lambda b: b.cast("double")
    return geometry.select("image_id", "det_id", *[v.alias(n) for n, v in {
        "bbox_x0": x0 / w, "bbox_y0": y0 / h, "bbox_x1": x1 / w, "bbox_y1": y1 / h, "bbox_center_x": middle[0], "bbox_center_y": middle[1], "bbox_bottom": y1 / h,
        "bbox_width": bw / w, "bbox_height": bh / h, "bbox_area": bw * bh / (w * h), "bbox_aspect_ratio": bw / bh, "mask_centroid_x": c("cu") / w, "mask_centroid_y": c("cv") / h,
        "mask_area": c("area") / (w * h), "mask_bbox_fill_ratio": c("fill"), "mask_compactness": 4 * math.pi * c("area") / (c("perimeter") * c("perimeter")),
        "touches_left": touches(x0 == 0), "touches_top": touches(y0 == 0), "touches_right": touches(x1 == width), "touches_bottom": touches(y1 == height),
        "distance_to_center": F.hypot(middle[0] - 0.5, middle[1] - 0.5), "distance_to_left": x0 / w, "distance_to_top": y0 / h, "distance_to_right": (w - x1) / w, "distance_to_bottom": (h - y1) / h,
    }.items()])


def context_ring(masks: DataFrame, width: int, height: int, scale: float = 3.0) -> DataFrame:
    """AGG18: runs of each mask's context: its box, ``scale`` times as wide and high where the image has room, moved inside the image, without the mask.

    Of each row of the box what lies between the mask's runs is left; all of it where the mask has none.
    """
    box = masks.groupBy("image_id", "det_id").agg(F.min("u0").alias("x0"), F.max("u1").alias("x1"), F.min("v").alias("y0"), (F.max("v") + 1).alias("y1"))

    def side(low: str, high: str, most: int) -> tuple[Column, Column]:
        size = F.col(high) - F.col(low)
        wanted = F.least(F.lit(most), F.greatest(size, F.ceil(size * scale)))
        start = F.floor((F.col(low) + F.col(high)) * 0.5 - wanted * 0.5)
        start = F.least(F.greatest(start, F.lit(0)), F.lit(most) - wanted)
        return start.cast("bigint"), (start + wanted).cast("bigint")

    (cx0, cx1), (cy0, cy1) = side("x0", "x1", width), side("y0", "y1", height)
    rows = box.select("image_id", "det_id", cx0.alias("cx0"), cx1.alias("cx1"), F.explode(F.sequence(cy0, cy1 - 1)).alias("v"))
    own = masks.groupBy("image_id", "det_id", "v").agg(F.array_sort(F.collect_list(F.struct("u0", "u1"))).alias("runs"))
    held = rows.join(own, ["image_id", "det_id", "v"], "left").withColumn("runs", F.coalesce("runs", F.array().cast("array<struct<u0:bigint,u1:bigint>>")))
    begins = F.concat(F.array("cx0"), F.transform("runs", lambda r: r["u1"]))
    ends = F.concat(F.transform("runs", lambda r: r["u0"]), F.array("cx1"))
    gaps = F.filter(F.arrays_zip(begins.alias("u0"), ends.alias("u1")), lambda g: g["u0"] < g["u1"])
    return held.select("image_id", "det_id", "v", F.explode(gaps).alias("g")).select("image_id", "det_id", "v", "g.u0", "g.u1")


def run_colours(runs: DataFrame, colours: DataFrame, image: str | None = None) -> DataFrame:
    """Colours (v, u, r, g, b, and ``image`` where given) of the pixels that runs cover, beside their image_id and det_id."""
    on = (runs["v"] == colours["v"]) & (colours["u"] >= runs["u0"]) & (colours["u"] < runs["u1"])
    if image is not None:
        on = on & (runs["image_id"] == colours[image])
    return runs.join(colours, on).select("image_id", "det_id", "r", "g", "b")


def context_appearance(masks: DataFrame, colours: DataFrame, width: int, height: int, scale: float = 3.0, image: str | None = None) -> DataFrame:
    """AGG18: ``region_appearance`` of each mask's ``context_ring`` in the colours of its image, or of one image for all.

    Equal masks over the same colours look the same, so only one of them meets pixels; masks without any have no row.
    """
    held, same = listed(masks), ["runs"] if image is None else ["image_id", "runs"]
    shapes = held.groupBy(*same).agg(F.min(F.struct("image_id", "det_id")).alias("one")).select(F.col("one.image_id").alias("image_id"), F.col("one.det_id").alias("det_id"), "runs")
    ring = context_ring(shapes.select("image_id", "det_id", F.inline("runs")), width, height, scale)
    inside = colours.where((F.col("u") >= 0) & (F.col("u") < width) & (F.col("v") >= 0) & (F.col("v") < height))
    seen = region_appearance(run_colours(ring, inside, image), ["image_id", "det_id"])
    seen = shapes.join(seen, ["image_id", "det_id"]).drop("det_id", *(["image_id"] if image is None else []))
    return held.join(seen, same).drop("runs")


def prompt_scores(detections: DataFrame, labels: list[str], key: str = "image_id") -> DataFrame:
    """AGG19: best score of each label, the best label and its lead; ties go to the label listed first."""
    wide = detections.groupBy(key).pivot("label", labels).agg(F.max("score"))
    named = wide.select(key, *[F.coalesce(F.col(f"`{n}`"), F.lit(0.0)).alias(f"score_{i}") for i, n in enumerate(labels)])
    ranked = F.array_sort(F.array(*[F.struct((-F.col(f"score_{i}")).alias("neg"), F.lit(i).alias("i"), F.lit(n).alias("name")) for i, n in enumerate(labels)]))
    return named.withColumns({"top_label": ranked[0]["name"], "top_score": -ranked[0]["neg"], "margin": ranked[1]["neg"] - ranked[0]["neg"]})


def candidate_order(masks: DataFrame, detections: DataFrame, key: str = "image_id") -> DataFrame:
    """SRT3: place of each detection in its image: by top-left of the mask, then falling score."""
    top = masks.groupBy("image_id", "det_id").agg(F.min("v").alias("min_v"), F.min("u0").alias("min_u"))
    w = Window.partitionBy(key).orderBy("min_v", "min_u", F.desc("score"), "det_id")
    return top.join(detections.select("image_id", "det_id", "score"), ["image_id", "det_id"]).withColumn("place", F.row_number().over(w).cast("bigint"))


def greedy_matches(vehicles: DataFrame, views: DataFrame, pairs: DataFrame, least: float = 0.5, fallback: str = "side") -> DataFrame:
    """JOI11: each vehicle takes the best view still free: score * (0.5 + 0.5 * overlap); without one, ``fallback``."""
    fits = pairs.where(F.col("overlap") >= least)
    sided = fits.select("image_id", F.col("a").alias("vehicle"), F.col("b").alias("view"), "overlap").union(fits.select("image_id", "b", "a", "overlap"))
    listed = sided.join(views.select("image_id", F.col("det_id").alias("view"), F.col("label").alias("view_label"), F.col("score").alias("view_score")), ["image_id", "view"])
    offers = listed.groupBy("image_id", "vehicle").agg(F.collect_list(F.struct("view", "view_label", (F.col("view_score") * (0.5 + 0.5 * F.col("overlap"))).alias("fit"))).alias("offers"))
    asked = vehicles.select("image_id", F.col("det_id").alias("vehicle"), "score").join(offers, ["image_id", "vehicle"], "left")

    def take(group: pd.DataFrame) -> pd.DataFrame:
        used, out = set(), []
        for image, vehicle, _, offers_ in group.sort_values(["score", "vehicle"], ascending=[False, True]).itertuples(index=False):
            free = [(o["fit"], -o["view"], o["view_label"]) for o in (offers_ if offers_ is not None else ()) if o["view"] not in used]
            best = max(free) if free else None
            if best:
                used.add(-best[1])
            out.append((image, vehicle, -best[1] if best else None, best[2] if best else fallback))
        return pd.DataFrame(out, columns=["image_id", "det_id", "view", "orientation"]).astype({"view": "Int64"})

    return asked.groupBy("image_id").applyInPandas(take, "image_id bigint, det_id bigint, view bigint, orientation string")


def routed(predictions: DataFrame, probabilities: str, classes: list[str], confidence: float, margin: float, fallback: str, drop: str | None = None) -> DataFrame:
    """DOM21: a classifier's label where sure, else ``fallback`` with the reasons; rows of class ``drop`` go."""
    from pointloom.functions.scalars import top_two

    df = predictions.withColumns(top_two(probabilities))
    name = F.element_at(F.array(*[F.lit(c) for c in classes]), (F.col("best") + 1).cast("int"))
    unsure, close = F.round("confidence", 6) < confidence, F.round("margin", 6) < margin
    reason = F.concat_ws("+", F.when(unsure, "low_confidence"), F.when(close, "low_margin"))
    out = df.withColumns({"routed": F.when(unsure | close, fallback).otherwise(name), "reason": F.when(unsure | close, reason).otherwise("accepted")})
    return out if drop is None else out.where(F.col("routed") != drop)
