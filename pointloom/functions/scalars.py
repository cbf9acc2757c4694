"""Scalar columns: validity, rounding, projection, normalisation, labels, decisions."""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

IGNORE = 255
INF = float("inf")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c: Column | str) -> Column:
    """Not null, not NaN, not infinite. Every comparison of measured values goes behind it."""
    c = col(c)
    return F.coalesce(c.isNotNull() & ~F.isnan(c) & (F.abs(c) < INF), F.lit(False))


def rounds_from(bound: float) -> float:
    """The least double that is ``bound`` or more when rounded to 6 places, halves away from zero."""
    reaches = lambda x: Decimal(repr(x)).quantize(Decimal("1e-6"), ROUND_HALF_UP) >= Decimal(repr(bound))
    x = bound - 5e-7
    while reaches(x):
        x = math.nextafter(x, -INF)
    while not reaches(x):
        x = math.nextafter(x, INF)
    return x


def at_least(c: Column | str, bound: Column | float) -> Column:
    """``c >= bound``, both rounded to 6 places. Rounding keeps order and is dear, so it goes into the bound, or is asked for only where it can tell."""
    c = col(c)
    if isinstance(bound, Column):
        return (c >= bound) | ((c >= bound - 2e-6) & (F.round(c, 6) >= F.round(bound, 6)))
    return c >= rounds_from(round(bound, 6))


def at_most(c: Column | str, bound: Column | float) -> Column:
    """``c <= bound``, both rounded to 6 places."""
    c = col(c)
    if isinstance(bound, Column):
        return (c <= bound) | ((c <= bound + 2e-6) & (F.round(c, 6) <= F.round(bound, 6)))
    return c < rounds_from(round(bound + 1e-6, 6))


def norm(x: str = "x", y: str = "y", z: str = "z") -> Column:
    return F.sqrt(F.col(x) * F.col(x) + F.col(y) * F.col(y) + F.col(z) * F.col(z))


def valid_return(x: str = "x", y: str = "y", z: str = "z") -> Column:
    """FN1: finite coordinates and a norm above 1e-8."""
    return finite(x) & finite(y) & finite(z) & F.coalesce(norm(x, y, z) > 1e-8, F.lit(False))


def valid_training_point(x: str = "x", y: str = "y", z: str = "z") -> Column:
    """FN2: finite coordinates, one of them at least 1e-4 in size."""
    big = F.greatest(F.abs(F.col(x)), F.abs(F.col(y)), F.abs(F.col(z))) >= 1e-4
    return finite(x) & finite(y) & finite(z) & F.coalesce(big, F.lit(False))


def unit_range(value: str, frame: str = "frame_ord", threshold: float = 1.0, clip: bool = False) -> Column:
    """FN3: the whole frame's values divided by 255 if the largest finite one exceeds ``threshold``."""
    top = F.max(F.when(finite(value), F.col(value))).over(Window.partitionBy(frame))
    out = F.when(top > threshold, F.col(value) / 255).otherwise(F.col(value))
    if clip:
        out = F.when(finite(value), F.greatest(F.lit(0.0), F.least(F.lit(1.0), out))).otherwise(F.lit(0.0))
    return out


def half_away(c: Column | str) -> Column:
    """FN4: nearest integer, halves away from zero; null where not finite."""
    c = col(c)
    return F.when(finite(c), F.when(c >= 0, F.floor(c + 0.5)).otherwise(F.ceil(c - 0.5))).cast("bigint")


def half_even(c: Column | str) -> Column:
    """Nearest integer, halves to even, as calibrated projection rounds."""
    c = col(c)
    return F.when(finite(c), F.rint(c)).cast("bigint")


def projected(points: DataFrame, k: Sequence[float], t: Sequence[float], width: int, height: int) -> DataFrame:
    """FN5: camera depth and pixel of each point; ``inside`` where it falls on the image.

    k: 3x3 intrinsics, t: 4x4 transform, both row by row. The matrices become literals.
    """
    x, y, z = F.col("x"), F.col("y"), F.col("z")
    axis = lambda r: t[4 * r] * x + t[4 * r + 1] * y + t[4 * r + 2] * z + t[4 * r + 3]
    cam = [axis(r) for r in range(3)]
    row = lambda r: k[3 * r] * cam[0] + k[3 * r + 1] * cam[1] + k[3 * r + 2] * cam[2]
    w = row(2)
    seen = (cam[2] > 0) & (F.abs(w) > 1e-9)
    u, v = F.when(seen, row(0) / w), F.when(seen, row(1) / w)
    out = points.withColumns({"depth": cam[2], "u": half_even(u), "v": half_even(v)})
    return out.withColumn("inside", F.coalesce((F.col("u") >= 0) & (F.col("u") < width) & (F.col("v") >= 0) & (F.col("v") < height), F.lit(False)))


def scaled_intrinsics(k: Sequence[float], old: tuple[int, int], new: tuple[int, int]) -> list[float]:
    """FN6: intrinsics for another image size (width, height)."""
    sx, sy = new[0] / old[0], new[1] / old[1]
    return [v * (sx if i < 3 else sy if i < 6 else 1.0) for i, v in enumerate(k)]


def camera_coordinate(df: DataFrame, coefficients: DataFrame, zones: int = 24) -> DataFrame:
    """FN7: cell of (slot, pixel), its zone's polynomials, evaluated to (cx, cy).

    ``coefficients`` has a row per zone with arrays a and b of 8.
    """
    cell = df.withColumn("cell", F.col("slot") * 64 + F.col("pixel")).withColumn("zone", (F.col("cell") % zones).cast("bigint"))
    p = F.col("cell") / 1000.0
    poly = lambda c: F.aggregate(F.reverse(F.col(c)), F.lit(0.0), lambda acc, k: acc * p + k)
    return cell.join(coefficients, "zone", "left").withColumns({"cx": poly("a"), "cy": poly("b")}).drop("a", "b")


def rotation_zyx(roll: str, pitch: str, yaw: str) -> list[Column]:
    """FN8: the nine entries of Rz(yaw) Ry(pitch) Rx(roll), row by row; angles in radians."""
    r, p, y = F.col(roll), F.col(pitch), F.col(yaw)
    sr, cr, sp, cp, sy, cy = F.sin(r), F.cos(r), F.sin(p), F.cos(p), F.sin(y), F.cos(y)
    return [cy * cp, cy * sp * sr - sy * cr, cy * sp * cr + sy * sr, sy * cp, sy * sp * sr + cy * cr, sy * sp * cr - cy * sr, -sp, cp * sr, cp * cr]


def local_east_north_up(poses: DataFrame, lat: str, lon: str, elev: str, order: str) -> DataFrame:
    """FN9: metres east, north and up from the first pose with a finite position; elevation 0 counts as missing."""
    up = F.coalesce(F.nullif(F.col(elev), F.lit(0.0)), F.lit(0.0))
    valid = finite(lat) & finite(lon)
    origin = poses.where(valid).agg(F.min_by(F.struct(F.col(lat).alias("lat0"), F.col(lon).alias("lon0"), up.alias("up0")), order).alias("o")).scalar()
    radius = 6_378_137.0
    return poses.withColumn("o", origin).withColumns({
        "east": F.radians(F.col(lon) - F.col("o.lon0")) * radius * F.cos(F.radians("o.lat0")), "north": F.radians(F.col(lat) - F.col("o.lat0")) * radius, "up": up - F.col("o.up0"),
    }).drop("o")


MICROS = {"s": 1_000_000.0, "ms": 1_000.0, "us": 1.0, "ns": 0.001}


def microseconds(c: Column | str, unit: str) -> Column:
    """FN10: a timestamp in ``unit`` as whole microseconds."""
    return half_even(col(c) * MICROS[unit])


def normal_label(c: Column | str) -> Column:
    """FN11: lower case without white space, underscores and hyphens."""
    return F.regexp_replace(F.lower(F.trim(col(c))), r"[\s_\-]+", "")


def indices_of(c: Column | str) -> Column:
    """FN12: all integers written in a text, in order."""
    return F.transform(F.regexp_extract_all(col(c), F.lit(r"(-?\d+)"), 1), lambda x: x.cast("bigint"))


def first_text(*cs: Column | str) -> Column:
    """FN13: the first value that isn't blank, trimmed."""
    return F.coalesce(*[F.nullif(F.trim(col(c).cast("string")), F.lit("")) for c in cs])


def source_key(path: Column | str, stem: Column | str, digits: int = 12) -> Column:
    """FN14, FN15: a safe stem and the head of the path's SHA-1."""
    return F.concat_ws("_", F.regexp_replace(col(stem), r"[^A-Za-z0-9]+", "_"), F.substring(F.sha1(col(path).cast("string")), 1, digits))


def box_metrics(x: str, y: str, w: str, h: str) -> dict[str, Column]:
    """FN17: bottom, aspect and area of a box; null for invalid boxes."""
    good = finite(x) & finite(y) & finite(w) & finite(h) & F.coalesce((F.col(h) > 1e-6) & (F.col(w) >= 0), F.lit(False))
    return {"bottom": F.when(good, F.col(y) + F.col(h)), "aspect": F.when(good, F.col(w) / F.col(h)), "area": F.when(good, F.col(w) * F.col(h))}


def top_two(probabilities: str) -> dict[str, Column]:
    """FN18: best class of a probability array, its share and lead; equal shares keep the lower class."""
    total = F.aggregate(probabilities, F.lit(0.0), lambda a, x: a + x)
    ranked = F.array_sort(F.transform(probabilities, lambda x, i: F.struct((-x).alias("neg"), i.alias("cls"))))
    first, second = F.element_at(ranked, 1), F.element_at(ranked, 2)
    return {"best": first["cls"].cast("bigint"), "confidence": -first["neg"] / total, "margin": (second["neg"] - first["neg"]) / total}


def blended(p: str, q: str, weight: float) -> Column:
    """FN19: weight * p + (1 - weight) * q, renormalised."""
    mixed = F.zip_with(p, q, lambda a, b: a * weight + b * (1 - weight))
    total = F.aggregate(mixed, F.lit(0.0), lambda a, x: a + x)
    return F.transform(mixed, lambda x: x / total)


def standardised(v: str, mean: str, std: str) -> Column:
    """FN20: (v - mean) / std by position; a std below 1e-6 counts as 1."""
    centred = F.zip_with(v, mean, lambda a, m: a - m)
    return F.zip_with(centred, std, lambda a, s: a / F.when(s < 1e-6, 1.0).otherwise(s))


def remapped(df: DataFrame, mapping: DataFrame, key: str, to: str, missing: int = -1) -> DataFrame:
    """FN21: ids through a mapping (key, to); unknown ones become ``missing``."""
    return df.join(mapping, key, "left").withColumn(to, F.coalesce(to, F.lit(missing)))


def replaced(label: str, old: int, new: int) -> Column:
    """FN22: one id for another."""
    return F.when(F.col(label) == old, F.lit(new)).otherwise(F.col(label)).cast("bigint")


def fisheye_radius(theta: Column, model: str, focal: float, k: Sequence[float] = (0, 0, 0, 0)) -> Column:
    """FN23: image radius of a ray at angle ``theta`` under one of four lens models, with radial terms."""
    t = theta * (1 + sum((c * F.pow(theta, F.lit(2 * (i + 1))) for i, c in enumerate(k)), F.lit(0.0)))
    shape = {"equidistant": t, "equisolid": 2 * F.sin(t / 2), "orthographic": F.sin(t), "stereographic": 2 * F.tan(t / 2)}
    return focal * shape[model]


def fisheye_pixel(u: str, v: str, size: tuple[int, int], fov: float, model: str, focal: float, centre: tuple[float, float]) -> dict[str, Column]:
    """FN23: where a pixel of a perspective view of ``size`` looks at in the fisheye image."""
    f = size[0] / 2 / math.tan(math.radians(fov) / 2)
    x, y = (F.col(u) - (size[0] - 1) / 2) / f, (F.col(v) - (size[1] - 1) / 2) / f
    flat = F.hypot(x, y)
    theta = F.atan2(flat, F.lit(1.0))
    radius = fisheye_radius(theta, model, focal)
    share = F.when(flat > 1e-12, radius / flat).otherwise(F.lit(0.0))
    return {"fx": centre[0] + x * share, "fy": centre[1] + y * share}


def in_split_circle(u: str, v: str, centre: tuple[float, float], above: float, below: float) -> Column:
    """FN24: inside a circle whose radius differs above and below its centre."""
    dx, dy = F.col(u) - centre[0], F.col(v) - centre[1]
    radius = F.when(dy < 0, F.lit(above)).otherwise(F.lit(below))
    return dx * dx + dy * dy <= radius * radius


def padded_box(x0: str, y0: str, x1: str, y1: str, pad: float, width: int, height: int) -> dict[str, Column]:
    """FN25: the box grown by a share of its sides, clipped to the image."""
    w, h = F.col(x1) - F.col(x0), F.col(y1) - F.col(y0)
    zero = F.lit(0).cast("bigint")
    return {
        "px0": F.greatest(zero, F.floor(F.col(x0) - w * pad)), "py0": F.greatest(zero, F.floor(F.col(y0) - h * pad)),
        "px1": F.least(F.lit(width).cast("bigint"), F.ceil(F.col(x1) + w * pad)), "py1": F.least(F.lit(height).cast("bigint"), F.ceil(F.col(y1) + h * pad)),
    }


def reason_tags(flags: dict[str, Column], rule: str) -> Column:
    """FN26: names of the true flags in order, or the rule's name."""
    tags = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in flags.items()]), lambda x: x.isNotNull())
    return F.when(F.size(tags) > 0, tags).otherwise(F.array(F.lit(rule)))


def ratio(a: Column | str, b: Column | str) -> Column:
    """FN27: a / b, or 0 where b is 0."""
    return F.coalesce(F.try_divide(col(a), col(b)), F.lit(0.0))
