"""Noise rules, object context and fusion: scores as column arithmetic, conflicts by rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointloom.functions.scalars import at_least, at_most, finite, half_away, valid_return
from pointloom.operators import echo

IGNORE = 255
LEAST = 0.35

# Rule, base, weights of flags, flags that all must hold (an alternative is a tuple), whether a stable point loses 0.10.
RULES = [
    ("dust_noise", 0.18, {"iso": 0.18, "low": 0.17, "trans": 0.15, "noproj": 0.08, "single": 0.07}, ["iso", "low", "single", ("trans", "alone")], True),
    ("long_distance_noise", 0.24, {"far": 0.24, "low": 0.12, "iso": 0.10, "trans": 0.08, "noproj": 0.08}, ["far", ("low", "iso", "noproj")], False),
    ("multipath_noise", 0.22, {"multi": 0.18, "sec": 0.16, "gap": 0.14, "weak": 0.08, "stab": 0.06}, ["multi", "sec", "gap"], False),
    ("multiple_range_noise", 0.20, {"multi": 0.20, "three": 0.16, "sgap": 0.14, "stab": 0.08}, ["multi", ("three", "secsgap")], False),
    ("underground_noise", 0.24, {"below": 0.24, "sec": 0.10, "noproj": 0.08, "lref": 0.08}, ["below", ("noproj", "lref", "sec")], False),
    ("crosstalk_noise", 0.18, {"line": 0.16, "trans": 0.15, "low": 0.13, "iso": 0.09, "noproj": 0.08}, ["line", "trans", "low"], True),
    ("adhesive_noise", 0.20, {"near": 0.18, "stab": 0.15, "vlow": 0.11, "lref": 0.08, "single": 0.05}, ["near", "stab", "single", ("vlow", "lref")], False),
]
NOISE_IDS = {name: 20 + k for k, (name, *_) in enumerate(RULES)}


def _pixel() -> dict[str, Column]:
    return {"u": half_away("cxd"), "v": half_away("cyd")}


def _known(points: DataFrame, pixels: DataFrame, lean: bool = False) -> DataFrame:
    """Points with what neighbouring frames, echoes and the mask tell.

    Neighbouring frames come first: their join deals points by (frame, slot, pixel), which echoes need too. Of the mask
    only pixels that points fall on take part, with their boundaries in the same row. ``lean``: points have their pixel, and
    a mask of few goes to all tasks. (Not for scores: what follows them would be one method, too long to be compiled.)
    """
    asked = (points if lean else points.withColumns(_pixel())).select("u", "v").distinct()
    mask = echo.mask_boundary(pixels).join(asked, ["u", "v"], "left_semi")
    mask = echo.sent(mask) if lean else mask
    masked = echo.mask_labels(echo.echo_features(echo.temporal_support(points)), mask, also=("boundary",), rounded=lean)
    return masked.withColumn("boundary", F.coalesce("boundary", F.lit(False)) & (F.col("mask_label") != IGNORE))


def teacher_features(points: DataFrame, pixels: DataFrame, told: dict[str, Column] | None = None) -> DataFrame:
    """DOM2: echo, density, temporal, mask and model features of every point, one row each; a pixel has one row.

    Angles come last: ``told``, further columns of what is known until then (``early_flags``), are made before points are
    dealt again, and columns that only they need stay behind.
    """
    told = told or {}
    cells = echo.angular_cells(points)
    known = _known(points, pixels).withColumns(told)
    return echo.angular_density(known, cells=cells).join(echo.frame_thresholds(points, cells=cells), echo.FRAME, "left").select(
        *points.columns, "echo_valid", "return_count", "return_rank", "nearest_gap", "strongest_delta", "density", "row_count", "col_count", "checked", "support", "far_from", "line_from", "below_to",
        "mask_label", "mask_conf", "boundary", *told,
    )


def column_features(points: DataFrame, pixels: DataFrame) -> DataFrame:
    """DOM2: of ``teacher_features`` what ``teacher_columns`` needs, with ``isolated`` in place of densities, the ground height as the only threshold and the ``frame_maxima``.

    What a point tells by itself is known before points are dealt, and columns that only that needs stay behind. Where pixels,
    lone cells and frames are few, points are dealt by (frame, slot, pixel) and then no more.
    """
    noise, object_ = model_context()
    own = {"echo_valid": valid_return(), **_pixel(), "has_projection": finite("cxd") & finite("cyd"), "model_noise": noise, "model_object": object_}
    known = _known(points.withColumns(own), pixels, lean=True)
    frames = frame_maxima(points).join(echo.frame_thresholds(points, wanted=("below_to",)), echo.FRAME, "left")
    return echo.isolated(known, cells=echo.angular_cells(points)).join(echo.sent(frames, points.select(echo.FRAME).distinct().count()), echo.FRAME, "left")


def frame_maxima(points: DataFrame) -> DataFrame:
    """Of each frame the largest intensity, reflectivity and difference to the strongest echo, from the least and the largest intensity of each (frame, slot, pixel)."""
    fine = lambda n: F.when(finite(n), F.col(n))
    own = F.when(valid_return(), F.col("intensity"))
    groups = points.groupBy(echo.FRAME, "slot", "pixel").agg(
        F.max(fine("intensity")).alias("i"), F.max(fine("reflectivity")).alias("r"), F.min(own).alias("low"), F.max(own).alias("high")
    )
    loose = ~(finite("slot") & finite("pixel"))  # such frames have no echo groups, so no differences
    apart = F.greatest(F.abs(F.col("low") - F.col("high")), F.abs(F.col("high") - F.col("high")))
    return groups.groupBy(echo.FRAME).agg(F.max("i").alias("i_most"), F.max("r").alias("r_most"), F.when(~F.bool_or(loose), F.max(apart)).alias("d_most"))


def teacher_columns(features: DataFrame, most: DataFrame | None = None) -> DataFrame:
    """DOM2, the rest: what ``teacher_features`` or ``column_features`` gives, in the units and flags that rules and reports use.

    Intensities, reflectivities and differences to the strongest echo are over 255 in frames where one exceeds 1; the first
    two are cut to 0 to 1, and 0 where not finite. The largest of a frame is a grouped maximum joined back, unless
    ``features`` have it; ``most``: the points' ``frame_maxima``, where the plan has points, so that features aren't made twice.
    Flags that ``features`` have are taken as they are.
    """
    c = F.col
    fine = lambda n: F.when(finite(n), c(n))
    if most is None and "i_most" not in features.columns:
        most = features.groupBy(echo.FRAME).agg(F.max(fine("intensity")).alias("i_most"), F.max(fine("reflectivity")).alias("r_most"), F.max(F.abs(c("strongest_delta"))).alias("d_most"))
    unit = lambda n, m: F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(c(m) > 1, fine(n) / 255).otherwise(fine(n)))), F.lit(0.0))
    noise, object_ = model_context()
    flags = {
        "isolated": c("density") <= 3, "has_projection": finite("cxd") & finite("cyd"), "stable": c("support") > 0, "transient": (c("checked") > 0) & (c("support") == 0),
        "below_ground": finite("z") & at_most(c("z"), c("below_to")), "mask_context": c("mask_label") != IGNORE, "model_noise": noise, "model_object": object_,
    }
    joined = features if most is None else features.join(most, echo.FRAME, "left")
    return joined.withColumns({
        "distance_clean": F.coalesce(fine("distance"), F.lit(0.0)), "intensity_norm": unit("intensity", "i_most"), "reflectivity_norm": unit("reflectivity", "r_most"),
        "strongest_delta_norm": F.when(c("d_most") > 1, c("strongest_delta") / 255).otherwise(c("strongest_delta")),
        **{k: F.coalesce(c(k) if k in features.columns else v, F.lit(False)) for k, v in flags.items()},
    }).drop("i_most", "r_most", "d_most")


def early_flags(low: float = 0.08, very_low: float = 0.03, near: float = 2.5) -> dict[str, Column]:
    """The conditions ``f_<name>`` that echoes, neighbouring frames, masks and models tell; intensities and reflectivities of 0 to 255 are scaled."""
    c = F.col
    true = lambda x: F.coalesce(x, F.lit(False))
    scaled, sec, sgap = c("intensity") / 255, c("return_rank") > 0, at_least("nearest_gap", 1.0)
    noise, object_ = model_context()
    return {f"f_{k}": true(v) for k, v in {
        "low": at_most(scaled, low), "vlow": at_most(scaled, very_low), "lref": at_most(c("reflectivity") / 255, 0.08), "trans": (c("checked") > 0) & (c("support") == 0),
        "stab": c("support") > 0, "noproj": ~(finite("cxd") & finite("cyd")), "single": c("return_count") <= 1, "multi": c("return_count") >= 2, "three": c("return_count") >= 3,
        "sec": sec, "gap": at_least("nearest_gap", 0.3), "sgap": sgap, "secsgap": sec & sgap, "weak": at_most(c("strongest_delta") / 255, -0.05), "near": at_most("distance", near),
        "object": c("mask_label") != IGNORE, "edge": c("boundary"), "noise": noise, "seen": object_, "valid": valid_return(),
    }.items()}


def angle_flags() -> dict[str, Column]:
    """The conditions ``f_<name>`` that density and the frame's thresholds tell."""
    c = F.col
    return {f"f_{k}": F.coalesce(v, F.lit(False)) for k, v in {
        "iso": c("density") <= 3, "alone": c("density") <= 1, "line": F.greatest("row_count", "col_count") >= c("line_from"),
        "below": at_most("z", c("below_to")), "far": at_least("distance", c("far_from")),
    }.items()}


def model_context() -> tuple[Column, Column]:
    """DOM8: whether the model supports noise, or an object, at a point."""
    noise = F.col("model_label").isin(*NOISE_IDS.values()) & at_least(F.col("model_conf"), 0.5)
    return noise, ~F.col("model_label").isin(*NOISE_IDS.values(), IGNORE) & at_least(F.col("model_conf"), 0.7)


def rule_scores(features: DataFrame) -> DataFrame:
    """DOM3, DOM4: a column ``s_<rule>`` for each noise rule, adjusted by context and gated.

    ``early_flags`` that ``features`` has already are taken as they are. Weights count hundredths and are multiplied by
    flags of 0 and 1. All flags, with a branch and a rounding for each weight, made one generated method of more than
    8,000 bytes, which the virtual machine interprets and never compiles.
    """
    df = features.withColumns({k: v for k, v in {**early_flags(), **angle_flags()}.items() if k not in features.columns})
    on = lambda k: F.col(f"f_{k}")
    weighed = lambda k, w: on(k).cast("double") * round(100.0 * w)
    context = weighed("object", -0.06) + weighed("edge", -0.08) + weighed("noise", 0.08) + weighed("seen", -0.05)
    df = df.withColumn("f_hundredths", context)
    out = {"f_ctx": F.col("f_hundredths") / 100}
    for name, base, weights, gates, steady in RULES:
        score = F.col("f_hundredths") + round(100.0 * base)
        for k, w in [*weights.items(), *[("stab", -0.10)] * steady]:
            score = score + weighed(k, w)
        gate = on("valid")
        for g in gates:
            any_of = on(g) if isinstance(g, str) else on(g[0])
            for k in g[1:] if isinstance(g, tuple) else ():
                any_of = any_of | on(k)
            gate = gate & any_of
        out[f"s_{name}"] = F.when(gate, F.greatest(F.lit(0.0), F.least(F.lit(98.0), score)) / 100).otherwise(0.0)
    return df.withColumns(out)


# Names of the classes that a camera's mask may give to a point.
CONTEXT_CLASSES = ("car", "truck_bus", "pedestrian", "traffic_sign", "triangular_traffic_sign", "roadblock", "wheel_chock", "tire", "traffic_cone", "cyclist", "motorcycle", "road")


def context_ids(classes: DataFrame) -> tuple[int, ...]:
    """DOM6: ids of the classes (name, id) that are named above, in whatever case: as many numbers as names reach the driver, repeats apart."""
    return tuple(sorted(r["id"] for r in classes.where(F.lower("name").isin(*CONTEXT_CLASSES)).select("id").distinct().collect()))


def candidates(scores: DataFrame, object_classes: tuple[int, ...] = (1, 2, 5, 7, 11)) -> DataFrame:
    """DOM5 to DOM7: the best rule of each point from 0.35 on, earliest on ties; then the mask's object where none is."""
    entries = F.array(*[F.struct(F.col(f"s_{n}").alias("score"), F.lit(-k).alias("order"), F.lit(i).alias("label"), F.lit(n).alias("rule")) for k, (n, i) in enumerate(NOISE_IDS.items())])
    fit = F.filter(entries, lambda e: e["score"] >= LEAST)
    best = F.array_max(fit)
    mask_score = F.round(0.65 * F.col("mask_conf") * F.when(F.col("boundary"), 0.5).otherwise(1.0), 6)
    context = best.isNull() & F.col("mask_label").isin(*object_classes) & (mask_score >= LEAST)
    return scores.withColumns({
        "label": F.when(best.isNotNull(), best["label"]).when(context, F.col("mask_label")).otherwise(IGNORE).cast("bigint"),
        "confidence": F.when(best.isNotNull(), best["score"]).when(context, mask_score).otherwise(0.0),
        "rule": F.when(best.isNotNull(), best["rule"]).when(context, "object_context"),
        "rules": F.transform(F.array_sort(fit, lambda a, b: b["order"] - a["order"]), lambda e: e["rule"]),
    })


def fused(df: DataFrame, noise: tuple[int, ...] = tuple(NOISE_IDS.values()), allow_background: bool = False) -> DataFrame:
    """DOM9: model and camera predictions to one label with provenance (0 ignored, 1 model, 2 filled, 3 overridden, 4 protected)."""
    mc, cc = F.round("model_conf", 6), F.round("camera_conf", 6)
    valid = (F.col("camera_label") != IGNORE) & (cc >= 0.7) & (F.lit(allow_background) | (F.col("camera_label") != 0))
    protected = F.col("model_label").isin(*noise) & (mc >= 0.4)
    fill = valid & ((F.col("model_label") == IGNORE) | (mc < 0.6)) & ~protected
    over = valid & ~fill & ~protected & (F.col("model_label") != F.col("camera_label")) & (cc >= F.round(mc + 0.2, 6))
    camera = fill | over
    label = F.when(camera, F.col("camera_label")).otherwise(F.col("model_label"))
    gone = label == IGNORE
    return df.withColumns({
        "label": label.cast("bigint"), "confidence": F.when(gone, 0.0).when(camera, F.col("camera_conf")).otherwise(F.col("model_conf")),
        "provenance": F.when(gone, 0).when(fill, 2).when(over, 3).when(protected, 4).otherwise(1).cast("bigint"),
    })
