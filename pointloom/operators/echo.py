"""Echo, density and temporal features of points; all share the frame key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointloom.functions.scalars import at_least, finite, half_away, valid_return
from pointloom.operators.quantiles import named, quantiles

FRAME = "frame_ord"

#: Rows up to which a table that points look things up in goes to all tasks.
FEW = 1 << 18


def sent(table: DataFrame, rows: int | None = None) -> DataFrame:
    """``table`` to be joined to points: sent to all tasks up to ``FEW`` rows, which a job counts unless ``rows`` says how many there are at most; a larger one is dealt with the points by its key."""
    return F.broadcast(table) if (table.count() if rows is None else rows) <= FEW else table


def primary_returns(points: DataFrame, strict: bool = False) -> DataFrame:
    """FLT1: finite block ids that truncate to 0. ``strict`` raises for a frame without any."""
    is_primary = finite("block_id") & F.coalesce(F.expr("try_cast(block_id AS BIGINT)") == 0, F.lit(False))
    if not strict:
        return points.where(is_primary)
    held = points.withColumn("primaries", F.sum(is_primary.cast("int")).over(Window.partitionBy(FRAME)))
    return held.where(F.assert_true(F.col("primaries") > 0, F.lit("a frame has no primary returns")).isNull()).where(is_primary).drop("primaries")


def echo_features(points: DataFrame) -> DataFrame:
    """WIN1: number of returns, rank by distance, nearest gap and intensity against the strongest, per (frame, slot, pixel).

    Only valid points count; others get 0. A frame with a slot or pixel that isn't finite stays ungrouped: such
    frames are a small table of their own, so that points are dealt by (frame, slot, pixel) alone. Points that have
    ``echo_valid`` already keep it.
    """
    valid = F.col("echo_valid") if "echo_valid" in points.columns else valid_return()
    key = Window.partitionBy(FRAME, "slot", "pixel", "echo_valid")
    order = key.orderBy("distance", "row_idx")
    loose = points.where(~(finite("slot") & finite("pixel"))).select(FRAME, F.lit(True).alias("echo_loose")).distinct()
    gap = F.least(F.col("distance") - F.lag("distance").over(order), F.lead("distance").over(order) - F.col("distance"))
    out = points.join(loose, FRAME, "left").withColumn("echo_valid", valid)
    use = F.col("echo_valid") & F.col("echo_loose").isNull()
    return out.withColumns({
        "return_count": F.when(use, F.count("*").over(key)).otherwise(F.col("echo_valid").cast("bigint")),
        "return_rank": F.when(use, F.row_number().over(order) - 1).otherwise(0).cast("bigint"),
        "nearest_gap": F.when(use, F.coalesce(gap, F.lit(0.0))).otherwise(0.0),
        "strongest_delta": F.when(use, F.col("intensity") - F.max("intensity").over(key)).otherwise(0.0),
    }).drop("echo_loose")


def echo_matrix(points: DataFrame) -> DataFrame:
    """WIN1: per group a map echo -> row_idx; of equal echoes the last in distance order stays."""
    ranked = echo_features(points).where("echo_valid")
    last = ranked.groupBy(FRAME, "slot", "pixel", "return_rank").agg(F.max_by("row_idx", F.struct("distance", "row_idx")).alias("row_idx"))
    return last.groupBy(FRAME, "slot", "pixel").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("return_rank", "row_idx")))).alias("echoes"))


def echo_context(primary: DataFrame, all_echoes: DataFrame, block: int = 0) -> DataFrame:
    """JOI8: counts and ranks of the group's row of the same block, else of its first row, for primary rows."""
    w = Window.partitionBy(FRAME, "slot", "pixel").orderBy(F.desc(F.coalesce(F.col("block_id") == block, F.lit(False))), "row_idx")
    best = all_echoes.withColumn("pick", F.row_number().over(w)).where("pick = 1").select(FRAME, "slot", "pixel", F.col("return_count").alias("ctx_count"), F.col("return_rank").alias("ctx_rank"))
    return primary.join(best, [FRAME, "slot", "pixel"], "left").fillna(0, ["ctx_count", "ctx_rank"])


def _binned(points: DataFrame, step: float) -> DataFrame:
    angle = lambda c: F.coalesce(F.floor(F.when(finite(c), F.col(c)).otherwise(0.0) / step).cast("bigint"), F.lit(0))
    return points.withColumns({"bin_a": angle("azimuth"), "bin_v": angle("vertical")})


def angular_cells(points: DataFrame, step: float = 0.5) -> DataFrame:
    """Points of each angular cell, of its row and of its column: frame, bin_a, bin_v, cell, row_count, col_count."""
    cells = _binned(points, step).groupBy(FRAME, "bin_a", "bin_v").agg(F.count("*").alias("cell"))
    rows, cols = Window.partitionBy(FRAME, "bin_v"), Window.partitionBy(FRAME, "bin_a")
    return cells.withColumns({"row_count": F.sum("cell").over(rows), "col_count": F.sum("cell").over(cols)})


def angular_density(points: DataFrame, step: float = 0.5, cells: DataFrame | None = None) -> DataFrame:
    """WIN9, JOI9: points in the 3x3 cells around, in the row and in the column of each point's angular cell.

    Cell counts come first, so what is spread over nine neighbours and joined is cells, not points. ``cells``: the points'
    ``angular_cells``, where the plan has them already.
    """
    cells = angular_cells(points, step) if cells is None else cells
    around = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(v).alias("v")) for a in (-1, 0, 1) for v in (-1, 0, 1)]))
    spread = cells.withColumn("d", around).select(FRAME, (F.col("bin_a") + F.col("d.a")).alias("bin_a"), (F.col("bin_v") + F.col("d.v")).alias("bin_v"), "cell")
    near = spread.groupBy(FRAME, "bin_a", "bin_v").agg(F.sum("cell").alias("density"))
    return _binned(points, step).join(cells.drop("cell").join(near, [FRAME, "bin_a", "bin_v"]), [FRAME, "bin_a", "bin_v"])


def isolated(points: DataFrame, most: int = 3, step: float = 0.5, cells: DataFrame | None = None) -> DataFrame:
    """WIN9, as one flag: whether the 3x3 cells around a point's angular cell hold up to ``most`` points, as ``angular_density`` counts them.

    Only cells with so few around are joined to points. Points without a frame are left out, as there.
    """
    cells = angular_cells(points, step) if cells is None else cells
    around = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(v).alias("v")) for a in (-1, 0, 1) for v in (-1, 0, 1)]))
    spread = cells.withColumn("d", around).select(FRAME, (F.col("bin_a") + F.col("d.a")).alias("bin_a"), (F.col("bin_v") + F.col("d.v")).alias("bin_v"), "cell", ((F.col("d.a") == 0) & (F.col("d.v") == 0)).alias("own"))
    near = spread.groupBy(FRAME, "bin_a", "bin_v").agg(F.sum("cell").alias("density"), F.bool_or("own").alias("own"))
    lone = near.where(F.col("own") & (F.col("density") <= most)).select(FRAME, "bin_a", "bin_v", F.lit(True).alias("isolated"))
    joined = _binned(points.where(F.col(FRAME).isNotNull()), step).join(sent(lone), [FRAME, "bin_a", "bin_v"], "left")
    return joined.withColumn("isolated", F.coalesce("isolated", F.lit(False))).drop("bin_a", "bin_v")


#: What ``frame_thresholds`` gives: column -> (which values, share).
THRESHOLDS = {"far_from": ("distance", 0.98), "line_from": ("line", 0.90), "below_to": ("z", 0.05)}


def frame_thresholds(points: DataFrame, step: float = 0.5, cells: DataFrame | None = None, wanted: tuple[str, ...] = tuple(THRESHOLDS)) -> DataFrame:
    """WIN8: far distance, line count and ground height of each frame, from exact quantiles of its points; of these the ``wanted`` ones.

    Distances that aren't finite count as 0, heights that aren't count for nothing. Line counts come from cells, each as
    often as it has points.
    """
    asked = {c: THRESHOLDS[c] for c in wanted}
    sources = {"distance": F.when(finite("distance"), F.col("distance")).otherwise(0.0), "z": F.when(finite("z"), F.col("z"))}
    own = {n: c for n, c in sources.items() if n in [of for of, _ in asked.values()]}
    values = [named(points, [FRAME], own)] if own else []
    if "line_from" in asked:
        line = F.greatest("row_count", "col_count").cast("double").alias("value")
        # few different counts a frame: the selection reads these sums again, not the cells
        cells = angular_cells(points, step) if cells is None else cells
        values.append(cells.select(FRAME, line, "cell").groupBy(FRAME, "value").agg(F.sum("cell").alias("n")).select(FRAME, F.lit("line").alias("name"), "value", "n"))
    found = quantiles(reduce(DataFrame.union, values), [FRAME], asked)
    bounds = {"far_from": F.greatest(F.lit(80.0), "far_from"), "line_from": F.greatest(F.lit(12.0), "line_from"), "below_to": F.least(F.lit(-0.25), F.col("below_to") - 0.15)}
    return found.withColumns({c: bounds[c] for c in asked})


def temporal_support(points: DataFrame, tolerance: float = 0.75) -> DataFrame:
    """JOI7: of the previous and next frame, how many hold the (slot, pixel), and how many a distance within ``tolerance``.

    Distances are gathered once per (frame, slot, pixel), as stretches from a least to a largest one without a gap above
    ``tolerance``, and copied to both neighbours: what lies in a stretch has one of its distances within half of that, and
    of what lies outside all stretches an end is nearest. So a point meets few stretches, however many points a cell has.
    """
    finite_distance = finite("distance")
    held = points.where(finite_distance & F.col("slot").isNotNull() & F.col("pixel").isNotNull())
    # distances of a bucket lie within ``tolerance``; those too large for a bucket's number stand alone
    numbered = F.abs(F.col("distance")) < 1e12 * tolerance
    bucket = F.when(numbered, F.floor(F.col("distance") / tolerance)) if tolerance > 0 else F.lit(None).cast("bigint")
    alone = F.when(~numbered, F.col("distance")) if tolerance > 0 else F.col("distance")
    parts = held.groupBy(FRAME, "slot", "pixel", bucket.alias("bucket"), alone.alias("alone")).agg(F.min("distance").alias("low"), F.max("distance").alias("high"))
    listed = parts.groupBy(FRAME, "slot", "pixel").agg(F.array_sort(F.collect_list(F.struct("low", "high"))).alias("parts"))
    lows = F.filter("parts", lambda x, i: (i == 0) | (x["low"] - F.get("parts", i - 1)["high"] > tolerance))
    highs = F.filter("parts", lambda x, i: (i == F.size("parts") - 1) | (F.get("parts", i + 1)["low"] - x["high"] > tolerance))
    stretch = F.zip_with(lows, highs, lambda x, y: F.struct(x["low"].alias("low"), y["high"].alias("high")))
    cells = listed.select(FRAME, "slot", "pixel", stretch.alias("near"))
    sides = cells.withColumn("side", F.explode(F.array(F.lit(-1), F.lit(1)))).select(
        (F.col(FRAME) + F.col("side")).alias(FRAME), "slot", "pixel", F.when(F.col("side") == 1, F.col("near")).alias("before"), F.when(F.col("side") == -1, F.col("near")).alias("after")
    )
    merged = sides.groupBy(FRAME, "slot", "pixel").agg(F.first("before", ignorenulls=True).alias("before"), F.first("after", ignorenulls=True).alias("after"))
    has = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    own = F.col("distance")
    # rounding moves a difference by less than 1e-6, and is dear: it is asked for only where it can tell
    within = lambda d: (F.abs(d - own) <= tolerance + 1e-5) & (F.round(F.abs(d - own), 6) <= tolerance)
    close = lambda c: F.coalesce(F.exists(c, lambda x: (own >= x["low"]) & (own <= x["high"]) | within(x["low"]) | within(x["high"])), F.lit(False)) & finite_distance
    joined = points.join(merged, [FRAME, "slot", "pixel"], "left")
    return joined.withColumns({
        "checked": has("before").cast("bigint") + has("after").cast("bigint"), "support": close("before").cast("bigint") + close("after").cast("bigint"),
    }).drop("before", "after")


def mask_labels(points: DataFrame, pixels: DataFrame, least: float = 0.7, keep_background: bool = False, ignore: int = 255, also: tuple[str, ...] = (), place: str = "row_idx", rounded: bool = False) -> DataFrame:
    """JOI1: the mask's label and confidence at each point's rounded pixel; outside or unsure points are ignored.

    Points without a pixel meet nothing: they are dealt by their ``place``, where there is one, as one task would have all
    of them otherwise. ``also``: further columns of ``pixels`` to keep. ``rounded``: points have the pixel as ``u`` and ``v`` already.
    """
    at = points if rounded else points.withColumns({"u": half_away("cxd"), "v": half_away("cyd")})
    lost = F.col("u").isNull() | F.col("v").isNull()
    keyed = at.withColumns({"mask_u": F.when(lost, F.xxhash64(place) if place in points.columns else None).otherwise(F.col("u")), "mask_v": F.when(~lost, F.col("v"))})
    mask = pixels.select(F.col("u").alias("mask_u"), F.col("v").alias("mask_v"), F.col("label").alias("mask_raw"), F.col("confidence").alias("mask_raw_conf"), *also)
    joined = keyed.join(mask, ["mask_u", "mask_v"], "left")
    sure = F.coalesce(at_least("mask_raw_conf", least), F.lit(False)) & (F.lit(keep_background) | (F.col("mask_raw") != 0))
    sure = F.coalesce(sure, F.lit(False))
    return joined.withColumns({
        "mask_label": F.when(sure, F.col("mask_raw")).otherwise(ignore).cast("bigint"), "mask_conf": F.when(sure, F.col("mask_raw_conf")).otherwise(0.0),
        "mask_reason": F.when(F.col("u").isNull(), "no_pixel").when(F.col("mask_raw").isNull(), "outside").when(~sure, "unsure").otherwise("kept"),
    }).drop("mask_raw", "mask_raw_conf", "mask_u", "mask_v")


def mask_boundary(pixels: DataFrame) -> DataFrame:
    """WIN3: labelled pixels with a neighbour, right, left, above or below, of another label."""
    sides = []
    for fixed, moving in (("v", "u"), ("u", "v")):
        w = Window.partitionBy(fixed).orderBy(moving)
        for f, d in ((F.lag, 1), (F.lead, -1)):
            sides.append((f("label").over(w), f(moving).over(w) + d == F.col(moving)))
    differs = lambda label, beside: F.coalesce(beside & (label != F.col("label")), F.lit(False))
    edge = differs(*sides[0])
    for s in sides[1:]:
        edge = edge | differs(*s)
    return pixels.withColumn("boundary", edge & (F.col("label") != 0))


def visible(points: DataFrame, keys: list[str], depth: str = "depth") -> DataFrame:
    """WIN2: points as near as the nearest of their pixel, within rtol 1e-5 and atol 1e-8."""
    nearest = F.min(depth).over(Window.partitionBy(*keys))
    return points.withColumn("visible", F.abs(F.col(depth) - nearest) <= 1e-8 + 1e-5 * F.abs(nearest))


def strongest_per_pixel(points: DataFrame, keys: list[str], confidence: str) -> DataFrame:
    """AGG30: the strongest confidence of each pixel."""
    return points.groupBy(*keys).agg(F.max(confidence).alias("strongest"), F.count("*").alias("points"))


def extents(points: DataFrame) -> DataFrame:
    """AGG13: largest |x| or |y|, and range, over finite points of each frame."""
    return points.where(finite("x") & finite("y") & finite("z")).groupBy(FRAME).agg(
        F.max(F.greatest(F.abs("x"), F.abs("y"))).alias("max_abs_xy"), F.max(F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z"))).alias("max_range")
    )


def feature_vector(points: DataFrame) -> DataFrame:
    """DOM1: 13 columns of a point as an array; what isn't finite is 0."""
    names = ("x", "y", "z", "azimuth", "vertical", "distance", "intensity", "reflectivity", "return_count", "return_rank", "nearest_gap", "strongest_delta", "block_id")
    value: list[Column] = [F.when(finite(F.col(n).cast("double")), F.col(n).cast("double")).otherwise(0.0) for n in names]
    return echo_features(points).withColumn("features", F.array(*value))
