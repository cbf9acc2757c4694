"""Feature vectors: fitting, scoring, voting, ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pointloom.operators.quantiles import named, quantiles


def long_form(vectors: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """One row per component: keys, dim, value."""
    return vectors.select(*keys, F.posexplode(vector).alias("dim", "value")).withColumn("value", F.col("value").cast("double"))


def fitted(vectors: DataFrame, vector: str) -> DataFrame:
    """AGG12: mean and population deviation of each dimension; a deviation below 1e-6 is 1."""
    std = F.stddev_pop("value")
    return long_form(vectors, [], vector).groupBy("dim").agg(F.avg("value").alias("mean"), F.when(std < 1e-6, 1.0).otherwise(std).alias("std"))


def fisher_scores(vectors: DataFrame, vector: str, label: str) -> DataFrame:
    """AGG24: variance between classes over variance within, per dimension; 0 where it is constant."""
    by = long_form(vectors, [label], vector).groupBy("dim", label).agg(F.count("*").alias("n"), F.avg("value").alias("m"), F.var_pop("value").alias("s"))
    whole = by.groupBy("dim").agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("g"))
    parts = by.join(whole, "dim").groupBy("dim").agg(F.sum(F.col("n") * (F.col("m") - F.col("g")) * (F.col("m") - F.col("g"))).alias("between"), F.sum(F.col("n") * F.col("s")).alias("within"))
    return parts.select("dim", F.when(F.col("within") > 1e-12, F.col("between") / F.col("within")).otherwise(0.0).alias("score"))


def fragment_vote(fragments: DataFrame, point: str, probabilities: str) -> DataFrame:
    """AGG21: class of the largest mean probability over a point's fragments, the lower class on ties."""
    mean = fragments.select(point, F.posexplode(probabilities).alias("cls", "p")).groupBy(point, "cls").agg(F.avg("p").alias("p"))
    return mean.groupBy(point).agg(F.max_by("cls", F.struct(F.round("p", 9), -F.col("cls"))).cast("bigint").alias("label"), F.max("p").alias("confidence"))


def centroids(vectors: DataFrame, vector: str, label: str) -> DataFrame:
    """Mean of the standardised components of each class: label, dim, centre. Means are standardised, not components: that needs no second pass."""
    means = long_form(vectors, [label], vector).groupBy(label, "dim").agg(F.avg("value").alias("m"))
    return means.join(fitted(vectors, vector), "dim").select(label, "dim", ((F.col("m") - F.col("mean")) / F.col("std")).alias("centre"))


#: Numbers of centres (classes x dimensions) that ride in every row; more are dealt to blocks of so many.
CENTRES = 1 << 18


def judged(vectors: DataFrame, key: str, vector: str, fit: DataFrame, centres: DataFrame, label: str) -> DataFrame:
    """(key, nearest, distance) of each vector: class of the centre at the smallest mean squared distance, the smaller class on ties (to 9 digits).

    fit: dim, mean, std, and optionally ``fill`` for components that aren't finite; centres: label, dim, centre.
    Up to ``CENTRES`` numbers go along as arrays of one row, so a vector is judged in its own row, without a shuffle.
    Beyond that each vector meets blocks of classes, and the best of its blocks counts.
    """
    filled = [F.col("fill")] if "fill" in fit.columns else [F.lit(None).cast("double").alias("fill")]
    one = fit.agg(F.array_sort(F.collect_list(F.struct("dim", "mean", "std", *filled))).alias("fit"))
    by = centres.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "centre"))), lambda x: x["centre"]).alias("centre"))
    blocks = -(-centres.count() // CENTRES)
    block = F.pmod(F.xxhash64(label), F.lit(max(1, blocks))).cast("int").alias("block")
    classes = by.groupBy(block).agg(F.collect_list(F.struct(F.col(label).alias("cls"), "centre")).alias("centres"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    scaled = F.zip_with(F.transform(vector, lambda x: x.cast("double")), "fit", lambda x, f: (F.when(finite(x), x).otherwise(f["fill"]) - f["mean"]) / f["std"])
    mean_square = lambda c: F.aggregate(F.zip_with("x", c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, d: s + d) / F.size("x")
    held = vectors.select(key, vector).withColumn("fit", one.scalar())
    if blocks <= 1:
        met = held.withColumn("centres", classes.select("centres").scalar())
    else:
        met = held.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(classes, "block")
    found = met.withColumn("x", scaled).select(key, F.transform("centres", lambda c: F.struct(F.round(mean_square(c["centre"]), 9).alias("r"), c["cls"].alias("cls"), mean_square(c["centre"]).alias("d"))).alias("d"))
    best = found.select(key, F.array_min("d").alias("b"), F.array_min(F.transform("d", lambda e: e["d"])).alias("d"))
    if blocks > 1:
        best = best.groupBy(key).agg(F.min("b").alias("b"), F.min("d").alias("d"))
    return best.select(key, F.col("b.cls").alias("nearest"), F.col("d").alias("distance"))


def nearest_centroid(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """AGG26, on complete vectors: each judged by the centroids of all."""
    return judged(vectors, key, vector, fitted(vectors, vector), centroids(vectors, vector, label), label)


def evaluated_centroids(vectors: DataFrame, key: str, vector: str, label: str, split: str) -> DataFrame:
    """AGG26: (key, label, nearest, distance) of the rows of split test, or val where no row is of test, by centroids of train.

    Components that are null or not finite take the median of their dimension in train (0 without any); a deviation below
    1e-8 is 1. Without rows to train on there is no result. ``accuracy`` sums it up.
    """
    train = vectors.where(F.col(split) == "train")
    asked = "test" if not vectors.where(F.col(split) == "test").isEmpty() else "val"
    long = long_form(train, [label], vector)
    fine = F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < float("inf"))
    middles = quantiles(long.where(fine).select("dim", F.lit("x").alias("name"), "value", F.lit(1).cast("bigint").alias("n")), ["dim"], {"fill": ("x", 0.5)})
    dims = long.select("dim").distinct().join(middles, "dim", "left").select("dim", F.coalesce("fill", F.lit(0.0)).alias("fill"))
    whole = long.join(dims, "dim").withColumn("value", F.when(fine, F.col("value")).otherwise(F.col("fill")))
    std = F.stddev_pop("value")
    fit = whole.groupBy("dim").agg(F.avg("value").alias("mean"), F.when(std < 1e-8, 1.0).otherwise(std).alias("std"), F.first("fill").alias("fill"))
    means = whole.groupBy(label, "dim").agg(F.avg("value").alias("m")).join(fit, "dim")
    centres = means.select(label, "dim", ((F.col("m") - F.col("mean")) / F.col("std")).alias("centre"))
    rows = vectors.where(F.col(split) == asked)
    return rows.select(key, label).join(judged(rows, key, vector, fit, centres, label), key)


def accuracy(judged_rows: DataFrame, label: str) -> DataFrame:
    """Rows and share of right classes of ``evaluated_centroids``."""
    return judged_rows.agg(F.count("*").alias("rows"), F.avg((F.col("nearest") == F.col(label)).cast("double")).alias("accuracy"))


def centroid_distances(vectors: DataFrame, vector: str, label: str) -> DataFrame:
    """AGG27: root mean square distance of each pair of class centroids."""
    c = centroids(vectors, vector, label)
    a, b = c.withColumnRenamed(label, "a").withColumnRenamed("centre", "ca"), c.withColumnRenamed(label, "b").withColumnRenamed("centre", "cb")
    return a.join(b, "dim").where("a < b").groupBy("a", "b").agg(F.sqrt(F.avg((F.col("ca") - F.col("cb")) * (F.col("ca") - F.col("cb")))).alias("distance"))


def principal_components(vectors: DataFrame, vector: str, k: int = 2):
    """AGG28: the first ``k`` components of the standardised vectors, and their share of the variance."""
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector

    raw = vectors.withColumn("raw", array_to_vector(F.col(vector).cast("array<double>")))
    scaled = StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True).fit(raw).transform(raw)
    model = PCA(k=k, inputCol="scaled", outputCol="components").fit(scaled)
    return model.transform(scaled), model.explainedVariance.toArray().tolist()


def blend_weight(scores: DataFrame, truth: str, p: str, q: str, classes: int, step: float = 0.05) -> DataFrame:
    """AGG23: the weight of p against q with the best macro F1; ties nearest 0.5, then larger."""
    from pointloom.functions.scalars import top_two

    n = int(round(1 / step)) + 1
    tried = scores.withColumn("weight", F.explode(F.array(*[F.lit(k * step) for k in range(n)])))
    mixed = F.zip_with(p, q, lambda a, b: a * F.col("weight") + b * (1 - F.col("weight")))
    labelled = tried.withColumn("mixed", mixed).withColumn("pred", top_two("mixed")["best"])
    hits = labelled.groupBy("weight", F.col(truth).alias("gt"), "pred").agg(F.count("*").alias("n"))
    rows = hits.groupBy("weight", F.col("gt").alias("c")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col("gt") == F.col("pred"), F.col("n")).otherwise(0)).alias("tp"))
    cols = hits.groupBy("weight", F.col("pred").alias("c")).agg(F.sum("n").alias("predicted"))
    f1 = rows.join(cols, ["weight", "c"], "full").fillna(0).withColumn("f1", 2 * F.col("tp") / F.greatest(F.col("support") + F.col("predicted"), F.lit(1)))
    return f1.groupBy("weight").agg((F.sum("f1") / classes).alias("macro_f1")).orderBy(F.desc(F.round("macro_f1", 9)), F.abs(F.col("weight") - 0.5), F.desc("weight")).limit(1)


def hashed_sample(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """SRT4: the ``n`` rows of smallest hash: the same ones on every cluster."""
    return rows.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary")), key).limit(n)


def extremes(vectors: DataFrame, key: str, vector: str, label: str, wanted: int, dim: int, n: int) -> DataFrame:
    """SRT5: the ``n`` largest values of one dimension within a class."""
    own = vectors.where(F.col(label) == wanted).select(key, F.element_at(vector, dim + 1).cast("double").alias("value"))
    return own.orderBy(F.desc("value"), key).limit(n)


def image_statistics(pixels: DataFrame, image: str, channel: str, value: str) -> DataFrame:
    """AGG20: mean, 1st and 99th percentile of each channel, and its gray-world gain."""
    by = [image, channel]
    ends = quantiles(named(pixels, by, {"v": F.col(value)}), by, {"p01": ("v", 0.01), "p99": ("v", 0.99)})
    found = pixels.groupBy(*by).agg(F.avg(value).alias("mean")).join(ends, by)
    gray = F.avg("mean").over(Window.partitionBy(image))
    return found.withColumn("gain", gray / (F.col("mean") + 1e-5))


def corrected(pixels: DataFrame, statistics: DataFrame, image: str, channel: str, value: str) -> DataFrame:
    """AGG20: ``stretched`` (1st to 99th percentile to 0 to 255; as it is where both are equal) and ``balanced`` (by the gray-world gain) of each pixel, cut to whole numbers of a byte."""
    byte = lambda c: F.floor(F.least(F.lit(255.0), F.greatest(F.lit(0.0), F.round(c, 6)))).cast("int")
    low, high, v = F.col("p01"), F.col("p99"), F.col(value)
    stretch = F.when(high <= low + 1e-6, v).otherwise((v - low) * (F.lit(255.0) / (high - low)))
    joined = pixels.join(statistics.select(image, channel, "p01", "p99", "gain"), [image, channel])
    return joined.withColumns({"stretched": byte(stretch), "balanced": byte(v * F.col("gain"))}).select(*pixels.columns, "stretched", "balanced")
