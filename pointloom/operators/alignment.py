"""Joining tables row by row, labels to classes, images to points, and checks that tables agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointloom.functions.scalars import normal_label

KEY = ["frame_ord", "row_idx"]


def aligned(points: DataFrame, others: dict[str, DataFrame], strict: bool = True) -> DataFrame:
    """JOI3: tables side by side on (frame_ord, row_idx). ``strict`` raises for a frame whose row counts differ; else such a frame has nulls."""
    out, sizes = points, points.groupBy("frame_ord").agg(F.count("*").alias("n"))
    for name, df in others.items():
        own = df.groupBy("frame_ord").agg(F.count("*").alias("m"))
        fits = sizes.join(own, "frame_ord", "left").select("frame_ord", (F.coalesce(F.col("m"), F.lit(0)) == F.col("n")).alias("fits"))
        if strict:
            fits = fits.withColumn("fits", F.when(F.col("fits"), True).otherwise(F.raise_error(F.concat(F.lit(f"{name} has other rows in frame "), F.col("frame_ord").cast("string"))).cast("boolean")))
        good = df.join(fits.where("fits").select("frame_ord"), "frame_ord", "left_semi")
        out = out.join(good, KEY, "left")
    return out


def aligned_leniently(left: DataFrame, right: DataFrame, valid: Column) -> DataFrame:
    """JOI15: rows by place where counts agree, else by place among the left's valid rows where these agree, else cut to the shorter side."""
    by_frame = lambda df, n: df.groupBy("frame_ord").agg(F.count("*").alias(n))
    counts = left.groupBy("frame_ord").agg(F.count("*").alias("l"), F.count_if(valid).alias("v")).join(by_frame(right, "r"), "frame_ord")
    marked = left.join(counts.select("frame_ord", ((F.col("l") != F.col("r")) & (F.col("v") == F.col("r"))).alias("by_valid")), "frame_ord")
    w = Window.partitionBy("frame_ord", "keep").orderBy("row_idx")
    kept = marked.withColumn("keep", F.coalesce(valid, F.lit(False))).withColumn("place", F.when(F.col("by_valid"), F.when(F.col("keep"), F.row_number().over(w) - 1)).otherwise(F.col("row_idx")))
    # both sides have a row a point: never one for a broadcast, whatever their size is guessed to be
    return kept.where("place is not null").join(right.withColumnRenamed("row_idx", "place").hint("merge"), ["frame_ord", "place"]).drop("keep", "by_valid", "place")


def sampled_colours(points: DataFrame, image: DataFrame) -> DataFrame:
    """JOI2: the image's values at each point's pixel; black outside."""
    colours = [c for c in image.columns if c not in ("u", "v")]
    return points.join(image, ["u", "v"], "left").fillna(0, colours)


def known_labels(labels: DataFrame, known: DataFrame, label: str, skip: tuple[int, ...] = (0, 255)) -> DataFrame:
    """FLT7: rows of known classes but the skipped ids."""
    return labels.where(~F.col(label).isin(*skip)).join(known.select(label).distinct(), label, "left_semi")


def resolved_labels(objects: DataFrame, classes: DataFrame, aliases: DataFrame) -> DataFrame:
    """JOI13: class ids of label texts: an explicit id, the exact normalised name, a number, or an alias.

    objects: label (text), explicit_id; classes: name, id;
    aliases: alias, targets with ``|`` between alternatives, of which the first known one counts.
    """
    names = classes.select(normal_label("name").alias("norm"), F.col("id").alias("by_name"))
    ids = classes.select(F.col("id").alias("number"), F.col("id").alias("by_number"))
    listed = aliases.select(normal_label("alias").alias("norm"), F.posexplode(F.split("targets", r"\|")).alias("rank", "target")).withColumn("target", normal_label("target"))
    targets = listed.join(names.withColumnRenamed("norm", "target"), "target").groupBy("norm").agg(F.min_by("by_name", "rank").alias("by_alias"))
    df = objects.withColumns({"norm": normal_label("label"), "number": F.expr("try_cast(trim(label) AS INT)")})
    joined = df.join(names, "norm", "left").join(ids, "number", "left").join(targets, "norm", "left")
    return joined.select(*objects.columns, F.coalesce("explicit_id", "by_name", "by_number", "by_alias").alias("class_id"))


def match_order(matches: DataFrame, sequence: str, name: str) -> DataFrame:
    """SRT2: every match with its place in its sequence: by the number a name is, then as text."""
    number = F.expr(f"try_cast({name} AS BIGINT)")
    return matches.withColumn("place", F.row_number().over(Window.partitionBy(sequence).orderBy(number.isNull(), number, name)))


def prepared_check(prepared: DataFrame, expected: DataFrame, columns: list[str]) -> DataFrame:
    """AGG15: per frame whether counts agree and all values lie within 1e-8 + 1e-5 * |expected|."""
    b = expected.select(*KEY, *[F.col(c).alias(f"e_{c}") for c in columns])
    close = F.lit(True)
    for c in columns:
        close = close & F.coalesce(F.abs(F.col(c) - F.col(f"e_{c}")) <= 1e-8 + 1e-5 * F.abs(F.col(f"e_{c}")), F.col(c).isNull() & F.col(f"e_{c}").isNull())
    both = prepared.select(*KEY, *columns, F.lit(1).alias("l")).join(b.withColumn("r", F.lit(1)), KEY, "full")
    return both.groupBy("frame_ord").agg((F.count("l") == F.count("r")).alias("same_count"), F.bool_and(F.coalesce(close, F.lit(False))).alias("same_values"))


def object_statistics(objects: DataFrame, rows: DataFrame) -> DataFrame:
    """AGG16: per frame: objects, those with points, indices tried, used, twice claimed, out of range, and the first 100 of these.

    objects: frame_ord, object_index, indices; rows: frame_ord, points.
    """
    tried = objects.select("frame_ord", "object_index", F.explode_outer(F.array_distinct("indices")).alias("i")).join(rows, "frame_ord", "left")
    inside = (F.col("i") >= 0) & (F.col("i") < F.coalesce("points", F.lit(0)))
    out = ~inside
    by = tried.groupBy("frame_ord").agg(
        F.countDistinct("object_index").alias("objects"), F.countDistinct(F.when(F.col("i").isNotNull(), F.col("object_index"))).alias("with_points"), F.count("i").alias("attempted"),
        F.countDistinct(F.when(inside, F.col("i"))).alias("labelled"), (F.count_if(inside) - F.countDistinct(F.when(inside, F.col("i")))).alias("duplicates"), F.count_if(out).alias("outside"),
    )
    first = tried.where(out).withColumn("k", F.row_number().over(Window.partitionBy("frame_ord").orderBy("object_index", "i"))).where("k <= 100")
    return by.join(first.groupBy("frame_ord").agg(F.array_sort(F.collect_list("i")).alias("outside_sample")), "frame_ord", "left")


def agreement(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """DOM24: rows of each table per key, and whether all agree."""
    out = None
    for name, df in tables.items():
        n = df.groupBy(key).agg(F.count("*").alias(name))
        out = n if out is None else out.join(n, key, "full")
    names = list(tables)
    same = F.lit(True)
    for n in names[1:]:
        same = same & F.col(n).eqNullSafe(F.col(names[0]))
    return out.withColumn("agree", same)


def region_appearance(region: DataFrame, key: list[str], bins: tuple[int, int, int] = (8, 4, 4)) -> DataFrame:
    """AGG18: mean and deviation of r, g, b and gray, and histograms of hue, saturation and value; colours are 0 to 1."""
    r, g, b = F.col("r"), F.col("g"), F.col("b")
    top, low = F.greatest(r, g, b), F.least(r, g, b)
    d = top - low
    hue = F.when(d <= 1e-12, 0.0).when(top == r, F.pmod((g - b) / d, F.lit(6.0))).when(top == g, (b - r) / d + 2).otherwise((r - g) / d + 4) / 6
    hsv = {"hue": hue, "sat": F.when(top <= 1e-12, 0.0).otherwise(d / top), "val": top}
    df = region.withColumns(hsv).withColumn("gray", 0.299 * r + 0.587 * g + 0.114 * b)
    aggs = [f(c).alias(f"{n}_{c}") for c in ("r", "g", "b", "gray") for n, f in (("mean", F.avg), ("std", F.stddev_pop))]
    for c, n in zip(hsv, bins):
        at = F.least(F.floor(F.col(c) * n), F.lit(n - 1))
        aggs += [(F.count_if(at == k) / F.count("*")).alias(f"{c}_{k}") for k in range(n)]
    return df.groupBy(*key).agg(*aggs)
