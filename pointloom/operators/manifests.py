"""Review manifests and datasets: summaries, weights, splits, merges, labels by priority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointloom.operators import splits


def summary(manifest: DataFrame) -> DataFrame:
    """AGG9: samples in all, by label, by split and by both, in one pass over grouping sets."""
    sets = manifest.groupingSets([[], ["label"], ["split"], ["label", "split"]], "label", "split")
    return sets.agg(F.grouping_id().cast("bigint").alias("level"), F.count("*").alias("samples"))


def split_cube(manifest: DataFrame) -> DataFrame:
    """AGG10: samples and changed labels of each class by split and over all splits."""
    return manifest.cube("split", "label").agg(F.count("*").alias("samples"), F.count_if(F.col("label") != F.col("initial_label")).alias("changed"))


def class_weights(counts: DataFrame, label: str, n: str, most: float = 10.0) -> DataFrame:
    """AGG11: sqrt(total / (C * n)) clipped to [1/most, most], and total / (C * n), both over their mean, 6 digits. One row per class."""
    all_ = Window.partitionBy(F.lit(0))
    share = F.sum(n).over(all_) / (F.count("*").over(all_) * F.col(n))
    both = counts.withColumns({"w": F.least(F.lit(most), F.greatest(F.lit(1 / most), F.sqrt(share))), "i": share})
    return both.select(label, n, F.round(F.col("w") / F.avg("w").over(all_), 6).alias("weight"), F.round(F.col("i") / F.avg("i").over(all_), 6).alias("inverse_weight"))


def class_statistics(manifest: DataFrame) -> DataFrame:
    """AGG25: samples, distinct sources, changed labels and samples per source of each class."""
    return manifest.groupBy("label").agg(
        F.count("*").alias("samples"), F.countDistinct("source_id").alias("sources"), F.count_if(F.col("label") != F.col("initial_label")).alias("changed")
    ).withColumn("per_source", F.col("samples") / F.col("sources"))


def taxonomy(counts: DataFrame, label: str, n: str) -> DataFrame:
    """DOM11, DOM25: dense ids of the classes that have training points; the others are excluded with a reason."""
    present = counts.where(F.col(n) > 0).select(label, (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(label)) - 1).cast("bigint").alias("train_id"))
    return counts.join(present, label, "left").withColumn("reason", F.when(F.col("train_id").isNull(), "no_training_points"))


def oversampled(frames: DataFrame, has_noise: Column, times: int) -> DataFrame:
    """DOM15: frames that hold noise are repeated."""
    return frames.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(has_noise, times).otherwise(1)))).withColumn("copy", F.col("copy").cast("bigint"))


# Priorities of manual labels by class.
PRIORITY = {0: ("ignore",), 10: ("background", "road", "ground", "other_ground"), 70: ("car", "truck_bus", "pedestrian", "cyclist", "motorcycle"), 80: ("cone", "roadblock", "tire", "wheel_chock", "sign", "thin_bar", "road_stud")}


def label_priority(name: Column) -> Column:
    """DOM10: 0 to 100; noise, crosstalk and multipath rank highest, unlisted names 50."""
    out = F.when(name.rlike("noise|crosstalk|multipath"), 100)
    for p, names in PRIORITY.items():
        out = out.when(name.isin(*names), p)
    return out.otherwise(50)


def manual_labels(assignments: DataFrame, default_label: int, default_priority: int, policy: str = "priority") -> DataFrame:
    """DOM10: the label of each (frame_ord, row_idx) from objects that claim it.

    assignments: frame_ord, row_idx, object_index, label, priority. ``priority``: the
    highest priority, the later object on ties, if it is at least the default's;
    ``last`` and ``first``: by object order; ``error``: two objects on a row raise.
    """
    key = ["frame_ord", "row_idx"]
    by = {"priority": F.struct("priority", "object_index"), "last": F.struct(F.col("object_index")), "first": F.struct(-F.col("object_index"))}
    order = by.get(policy, by["last"])
    best = assignments.groupBy(*key).agg(F.max_by(F.struct("label", "priority"), order).alias("b"), F.countDistinct("object_index").alias("claims"))
    if policy == "error":
        best = best.where(F.assert_true(F.col("claims") <= 1, F.lit("a point has two labels")).isNull())
    wins = F.col("b.priority") >= default_priority if policy == "priority" else F.lit(True)
    return best.select(*key, F.when(wins, F.col("b.label")).otherwise(default_label).cast("bigint").alias("label"), "claims")


def duplicate_assignments(assignments: DataFrame, default_priority: int) -> DataFrame:
    """WIN7: per frame, how many claims met a point that an earlier object had already taken."""
    w = Window.partitionBy("frame_ord", "row_idx").orderBy("object_index").rowsBetween(Window.unboundedPreceding, -1)
    before = F.max("priority").over(w)
    taken = F.coalesce(before >= default_priority, F.lit(False))
    return assignments.withColumn("taken", taken).groupBy("frame_ord").agg(F.count("*").alias("attempted"), F.count_if("taken").alias("duplicates"))


def dropped_points(points: DataFrame, valid: Column, known: Column, frame: str = "frame_ord") -> DataFrame:
    """AGG14: points of each frame by the first reason that drops them."""
    reason = F.when(~valid, "invalid_xyz").when(~known, "unknown_label").otherwise("kept")
    return points.groupBy(frame, reason.alias("reason")).agg(F.count("*").alias("points"))


def merged(parts: dict[str, DataFrame], reviewed: DataFrame) -> DataFrame:
    """SET3: datasets under one roof, ids prefixed by their name, only reviewed samples; ids may be reviewed more than once."""
    schemas = {tuple(df.columns) for df in parts.values()}
    if len(schemas) != 1:
        raise ValueError("datasets have different features")
    out = None
    for name, df in parts.items():
        own = df.withColumn("merged_id", F.concat(F.lit(f"{name}_"), F.col("sample_id")))
        out = own if out is None else out.unionByName(own)
    # ids are as many as samples, however small the file that they come from: both sides are sorted, none is broadcast
    return out.join(reviewed.select("merged_id").hint("merge"), "merged_id", "left_semi")


def reindexed(manifest: DataFrame, review: DataFrame) -> DataFrame:
    """DOM23: reviewed labels and the ones before; samples that the review doesn't list are removed."""
    return manifest.join(review.select("sample_id", F.col("label").alias("new_label")), "sample_id").select(
        "sample_id", "source_id", "split", F.col("new_label").alias("label"), F.col("label").alias("previous_label"), (F.col("new_label") != F.col("label")).alias("moved")
    )


def checked_review(manifest: DataFrame, review: DataFrame) -> DataFrame:
    """DOM23: each sample of the manifest with ``new_label``, null where the review removed it.

    Reading it raises where a sample has no id or a blank one, is twice in the manifest or in the review, or is in the
    review alone. Both sides meet in one grouping by id, so no side is moved twice.
    """
    own = F.struct(*manifest.columns).alias("own")
    both = manifest.select("sample_id", own, F.lit(None).cast("string").alias("reviewed")).unionByName(review.select("sample_id", F.lit(None).cast(manifest.select(own).schema[0].dataType).alias("own"), F.col("label").cast("string").alias("reviewed")))
    met = both.groupBy("sample_id").agg(F.first("own", ignorenulls=True).alias("own"), F.first("reviewed", ignorenulls=True).alias("reviewed"), F.count("own").alias("listed"), F.count_if(F.col("own").isNull()).alias("reviews"))
    wrong = (
        F.when(F.trim(F.coalesce(F.col("sample_id").cast("string"), F.lit(""))) == "", "a sample has no id").when(F.col("listed") > 1, F.concat(F.lit("twice in the manifest: "), "sample_id"))
        .when(F.col("reviews") > 1, F.concat(F.lit("twice in the review: "), "sample_id")).when(F.col("listed") == 0, F.concat(F.lit("in the review alone: "), "sample_id"))
    )
    return met.where(F.when(wrong.isNotNull(), F.raise_error(wrong).cast("boolean")).otherwise(True)).select("own.*", F.col("reviewed").alias("new_label"))


def resplit(manifest: DataFrame, review: DataFrame, shares: tuple[float, float, float] = (0.7, 0.15, 0.15), seed: int = 1) -> DataFrame:
    """DOM23: the kept samples under their reviewed label, split anew by the grouped rule; ``previous_label`` where the label changed."""
    kept = checked_review(manifest, review).where("new_label IS NOT NULL")
    moved = F.col("new_label") != F.col("label")
    kept = kept.select("sample_id", "source_id", F.col("new_label").alias("label"), F.when(moved, F.col("label")).alias("previous_label"))
    return splits.grouped_split(kept, shares, seed, splits.rounded_quotas).withColumnRenamed("new_split", "split")


def review_summary(manifest: DataFrame, review: DataFrame) -> DataFrame:
    """DOM23: samples kept, moved to another label and removed, of each label before the review."""
    checked = checked_review(manifest, review)
    kept = F.col("new_label").isNotNull()
    return checked.groupBy("label").agg(F.count_if(kept).alias("samples"), F.count_if(kept & (F.col("new_label") != F.col("label"))).alias("moved"), F.count_if(~kept).alias("removed"))


def recovered(manifest: DataFrame, recovery: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """JOI14: recovered values replace existing ones but in the columns ``keep``."""
    r = recovery.select(F.col("sample_id"), *[F.col(c).alias(f"r_{c}") for c in recovery.columns if c != "sample_id"])
    joined = manifest.join(r, "sample_id", "left")
    pick = lambda c: F.coalesce(F.col(c), F.col(f"r_{c}")) if c in keep else F.coalesce(F.col(f"r_{c}"), F.col(c))
    return joined.select("sample_id", *[(pick(c) if f"r_{c}" in joined.columns else F.col(c)).alias(c) for c in manifest.columns if c != "sample_id"])
