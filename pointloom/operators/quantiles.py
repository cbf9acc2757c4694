"""Exact quantiles of groups of any size, by selection on counts.

Values fall into buckets twice: by their logarithm, which no outlier spoils, then, inside the
buckets that hold a wanted rank, evenly between the bucket's own ends. Counts of buckets, summed,
say where a rank is, and only the values of the last buckets are put in order, equal ones counted
first. What is shuffled is bucket counts and those values; no task holds a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets for each doubling of the value, and buckets inside one of those.
OCTAVE, INNER = 16, 1024


def named(rows: DataFrame, group: list[str], values: dict[str, Column]) -> DataFrame:
    """(group, name, value, n) of several columns of ``rows`` at once, n = 1; nulls count for nothing."""
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), c.cast("double").alias("value")) for n, c in values.items()])).alias("p")
    return rows.select(*group, pairs).where("p.value IS NOT NULL").select(*group, F.col("p.name").alias("name"), F.col("p.value").alias("value"), F.lit(1).cast("bigint").alias("n"))


def quantiles(values: DataFrame, group: list[str], wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """A row a group with a column for each of ``wanted``: column -> (name in ``values``, share), as linear interpolation between the two values around the rank.

    ``values``: group, name, value, n (how often it counts). Groups without values of a name have null there. Group
    keys aren't null; values are finite.
    """
    by = [*group, "name"]
    asked = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(n).alias("of"), F.lit(float(q)).alias("share")) for c, (n, q) in wanted.items()])
    coarse = F.floor(F.signum("value") * F.log2(1 + 1024 * F.abs("value")) * OCTAVE).cast("int")
    held = values.withColumn("bucket", coarse)
    ends = (F.min("value").alias("low"), F.max("value").alias("high"), F.sum("n").alias("n"))

    def until(*key: str) -> Column:
        *part, order = key
        return F.sum("n").over(Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow))

    holds = (F.col("to") - F.col("n") <= F.col("rank")) & (F.col("rank") < F.col("to"))
    outer = held.groupBy(*by, "bucket").agg(*ends).withColumns({"to": until(*by, "bucket"), "total": F.sum("n").over(Window.partitionBy(*by))})
    at = F.col("a.share") * (F.col("total") - 1)
    side = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), f(at).cast("bigint").alias("rank")) for s, f in ((0, F.floor), (1, F.ceil))])).alias("r")
    spread = outer.select("*", F.explode(F.filter(asked, lambda a: a["of"] == F.col("name"))).alias("a")).select(*by, "bucket", "low", "high", "n", "to", "a.column", (at - F.floor(at)).alias("part"), side)
    # a rank goes along from here on: its bucket, then the part of that bucket, then the value
    ask = ["column", "side", "part", "rank"]
    ranks = spread.select("*", "r.side", "r.rank").where(holds).select(*by, "bucket", "low", "high", (F.col("to") - F.col("n")).alias("before"), *ask)

    place = F.when(F.col("high") > F.col("low"), F.least(F.lit(INNER - 1), F.floor((F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * INNER))).otherwise(0).cast("int")
    inside = held.join(ranks, [*by, "bucket"]).withColumn("inner", place)
    inner = inside.groupBy(*by, "bucket", "low", "high", "before", *ask, "inner").agg(F.sum("n").alias("n")).withColumn("to", F.col("before") + until(*by, "column", "side", "inner"))
    met = inner.where(holds).select(*by, "bucket", "low", "high", "inner", (F.col("to") - F.col("n")).alias("before"), *ask)

    few = held.join(met, [*by, "bucket"]).where(place == F.col("inner")).groupBy(*by, "before", *ask, "value").agg(F.sum("n").alias("n"))
    found = few.withColumn("to", F.col("before") + until(*by, "column", "side", "value")).where(holds)
    weight = F.when(F.col("side") == 1, F.col("part")).otherwise(1 - F.col("part"))
    column = lambda c: F.sum(F.when(F.col("column") == c, weight * F.col("value"))).alias(c)
    return found.groupBy(*group).agg(*[column(c) for c in wanted])
