"""Labels against ground truth: confusion, class metrics, summaries, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pointloom.functions.scalars import ratio


def label_counts(labels: DataFrame, keys: list[str], label: str, ignore: tuple[int, ...] = ()) -> DataFrame:
    """AGG1: points per label and key."""
    return labels.where(~F.col(label).isin(*ignore)).groupBy(*keys, label).agg(F.count("*").alias("points"))


def confusion(labels: DataFrame, truth: str = "gt", prediction: str = "pred", ignore: tuple[int, ...] = (255,)) -> DataFrame:
    """AGG3: counts of (truth, prediction); only ignored truths are left out."""
    return labels.where(~F.col(truth).isin(*ignore)).groupBy(F.col(truth).alias("gt"), F.col(prediction).alias("pred")).agg(F.count("*").alias("n"))


def class_metrics(matrix: DataFrame, ignore: tuple[int, ...] = (255,)) -> DataFrame:
    """AGG4, SET2: tp, fp, fn, IoU, precision, recall, F1 of each class of truth or prediction but the ignored."""
    rows = matrix.groupBy(F.col("gt").alias("label")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col("gt") == F.col("pred"), F.col("n")).otherwise(0)).alias("tp"))
    cols = matrix.groupBy(F.col("pred").alias("label")).agg(F.sum("n").alias("predicted"))
    both = rows.join(cols, "label", "full").fillna(0, ["support", "tp", "predicted"]).where(~F.col("label").isin(*ignore))
    tp, fp, fn = F.col("tp"), F.col("predicted") - F.col("tp"), F.col("support") - F.col("tp")
    both = both.withColumns({"fp": fp, "fn": fn, "iou": ratio(tp, tp + fp + fn), "precision": ratio(tp, F.col("predicted")), "recall": ratio(tp, F.col("support"))})
    return both.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def overall_metrics(metrics: DataFrame) -> DataFrame:
    """AGG4: accuracy, mean IoU over active and over supported classes, frequency-weighted IoU, mean precision, recall, F1."""
    active, supported = (F.col("support") > 0) | (F.col("predicted") > 0), F.col("support") > 0
    return metrics.agg(
        ratio(F.sum("tp"), F.sum("support")).alias("accuracy"), F.avg(F.when(active, F.col("iou"))).alias("miou"), F.avg(F.when(supported, F.col("iou"))).alias("miou_supported"),
        ratio(F.sum(F.col("iou") * F.col("support")), F.sum("support")).alias("fw_iou"),
        *[F.avg(F.when(active, F.col(c))).alias(f"mean_{c}") for c in ("precision", "recall", "f1")],
    )


def frame_metrics(labels: DataFrame, frame: str = "frame_ord", truth: str = "gt", prediction: str = "pred", ignore: int = 255) -> DataFrame:
    """AGG6: points, valid, ignored, correct and accuracy of each frame."""
    valid = F.col(truth) != ignore
    return labels.groupBy(frame).agg(
        F.count("*").alias("points"), F.count_if(valid).alias("valid"), F.count_if(~valid).alias("ignored"), F.count_if(valid & (F.col(truth) == F.col(prediction))).alias("correct")
    ).withColumn("accuracy", ratio("correct", "valid"))


def confusion_pivot(matrix: DataFrame, classes: list[int]) -> DataFrame:
    """AGG5: one row per truth, a column per predicted class, and each row's share of the total."""
    wide = matrix.groupBy("gt").pivot("pred", classes).agg(F.sum("n")).fillna(0)
    named = wide.select("gt", *[F.col(str(c)).alias(f"pred_{c}") for c in classes])
    total = sum((F.col(f"pred_{c}") for c in classes), F.lit(0))
    return named.withColumns({f"share_{c}": ratio(F.col(f"pred_{c}"), total) for c in classes})


def run_summary(frames: DataFrame, frame: str, *counts: str) -> DataFrame:
    """AGG2: sums per frame and over the run (frame null), partial sums first."""
    return frames.rollup(frame).agg(*[F.sum(c).alias(c) for c in counts], F.count("*").alias("rows"))


def label_distribution(labels: DataFrame, label: str, confidence: str) -> DataFrame:
    """AGG29: count, percent and mean confidence of each label."""
    counted = labels.groupBy(label).agg(F.count("*").alias("points"), F.avg(confidence).alias("mean_confidence"))
    return counted.withColumn("percent", 100.0 * F.col("points") / F.sum("points").over(Window.partitionBy(F.lit(0))))


def report_order(metrics: DataFrame, k: int) -> DataFrame:
    """SRT1: supported classes first, by support, then id; the first ``k``."""
    return metrics.orderBy((F.col("support") > 0).desc(), F.desc("support"), "label").limit(k)


def mismatches(matrix: DataFrame, k: int = 30) -> DataFrame:
    """AGG31: the most frequent wrong pairs."""
    return matrix.where("gt <> pred").orderBy(F.desc("n"), "gt", "pred").limit(k)


def floored_metrics(matrix: DataFrame, classes: list[str]) -> DataFrame:
    """AGG22: accuracy and macro F1 over a fixed class list; denominators are at least 1 (F1's at least 1e-12)."""
    own = lambda c: F.sum(F.when((F.col("gt") == c) & (F.col("pred") == c), F.col("n")).otherwise(0))
    f1 = []
    for c in classes:
        p = own(c) / F.greatest(F.sum(F.when(F.col("pred") == c, F.col("n")).otherwise(0)), F.lit(1))
        r = own(c) / F.greatest(F.sum(F.when(F.col("gt") == c, F.col("n")).otherwise(0)), F.lit(1))
        f1.append(2 * p * r / F.greatest(p + r, F.lit(1e-12)))
    right = F.sum(F.when(F.col("gt") == F.col("pred"), F.col("n")).otherwise(0))
    return matrix.agg((right / F.greatest(F.sum("n"), F.lit(1))).alias("accuracy"), (sum(f1[1:], f1[0]) / len(classes)).alias("macro_f1"))


def frame_differences(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """SET1, JOI12: which keys stand on both sides, and which on one only."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    both = a.intersect(b).withColumn("side", F.lit("both"))
    return both.union(a.exceptAll(b).withColumn("side", F.lit("left"))).union(b.exceptAll(a).withColumn("side", F.lit("right")))
