"""Matching by time and rank: as-of joins, best matches, runs, tag segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Seconds of a bucket of the as-of join. Each bucket is one window partition.
BUCKET = 3600


def nearest_in_time(frames: DataFrame, poses: DataFrame, frame_id: str, pose_id: str, ts: str, bucket: int = BUCKET) -> DataFrame:
    """JOI4: for each frame the pose nearest in time; of two equally near, the one at or after it.

    Both sides are dealt to time buckets. A bucket sees, besides its own poses, the
    last pose before it and the first after it, carried over empty buckets: these are
    computed from one row per bucket. So no task sorts all of time. What follows is looked
    for in falling order: a window that ends with the last row is summed up again for each row.
    """
    bucketed = lambda df: df.where(F.col(ts).isNotNull()).withColumn("bucket", F.floor(F.col(ts) / bucket).cast("bigint"))
    f = bucketed(frames).select("bucket", F.col(ts).alias("t"), F.lit(0).alias("kind"), F.struct(*frames.columns).alias("frame"))
    p = bucketed(poses).select("bucket", F.col(ts).alias("t"), F.lit(1).alias("kind"), F.col(pose_id).alias("i"))
    both = f.unionByName(p, allowMissingColumns=True).withColumn("pose", F.when(F.col("kind") == 1, F.struct("t", "i")))
    # of equal times: the first pose at or after a frame, the last one before it
    ends = both.groupBy("bucket").agg(F.min("pose").alias("low"), F.max("pose").alias("high"))
    nearest = lambda c, w: F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    order = lambda *by: (Window.orderBy(*by), Window.orderBy(*[F.desc(c) for c in by]))
    rise, fall = order("bucket")  # one row a bucket, not a point
    carried = ends.select("bucket", nearest("high", rise).alias("before"), nearest("low", fall).alias("after"))
    rise, fall = (w.partitionBy("bucket") for w in order("t", "kind", "i"))
    seen = both.withColumns({"prev": nearest("pose", rise), "next": nearest("pose", fall)}).where("kind = 0").join(carried, "bucket")
    prev, next_ = F.coalesce("prev", "before"), F.coalesce("next", "after")
    later = next_["t"].isNotNull() & (prev["t"].isNull() | (next_["t"] - F.col("t") <= F.col("t") - prev["t"]))
    pose = F.when(later, next_).otherwise(prev)
    own = [frame_id, *[c for c in frames.columns if c != frame_id]]
    found = seen.select(*[F.col("frame")[c].alias(c) for c in own], pose["i"].alias(pose_id), (pose["t"] - F.col("t")).alias("delta"))
    return found.unionByName(frames.where(F.col(ts).isNull()).select(*own), allowMissingColumns=True)


def synced(matched: DataFrame, most: float) -> DataFrame:
    """JOI5: whether a match lies within ``most``; frames without a time or a match aren't."""
    return matched.withColumn("synced", F.coalesce(F.abs("delta") <= most, F.lit(False)))


def best_per(matches: DataFrame, key: str) -> DataFrame:
    """WIN5: the match of smallest |diff| per key, the first row on ties. A grouped minimum: rows of a key never meet in one task."""
    return matches.groupBy(key).agg(F.min_by(F.struct(*[c for c in matches.columns if c != key]), F.struct(F.abs("diff_ms"), "row_idx")).alias("m")).select(key, "m.*")


def checked_matches(matches: DataFrame, times: DataFrame, images: DataFrame, frame: str, image: str, first: int, last: int) -> DataFrame:
    """JOI6: the best match of each frame from ``first`` to ``last``; one whose frame has no time, or whose image isn't there, raises. Rows outside the range never do."""
    inside = matches.where(F.col(frame).between(first, last))
    known = inside.join(times.select(frame, F.lit(True).alias("timed")).distinct(), frame, "left").join(images.select(image, F.lit(True).alias("held")).distinct(), image, "left")
    fault = F.when(F.col("timed").isNull(), F.concat(F.lit("no time for frame "), F.col(frame).cast("string"))).when(F.col("held").isNull(), F.concat(F.lit("no image "), F.col(image).cast("string")))
    good = known.where(F.when(fault.isNotNull(), F.raise_error(fault).cast("boolean")).otherwise(F.lit(True)))
    return best_per(good.drop("timed", "held"), frame)


def frame_windows(frames: DataFrame, scene: str, order: str, k: int) -> DataFrame:
    """WIN4: up to ``k`` frames before and after, as lists."""
    w = Window.partitionBy(scene).orderBy(order)
    return frames.withColumns({"past": F.collect_list(order).over(w.rowsBetween(-k, -1)), "future": F.collect_list(order).over(w.rowsBetween(1, k))})


def class_presence(seen: DataFrame, cls: str, order: str) -> DataFrame:
    """AGG8: of each class the number of distinct places and its longest run of consecutive ones."""
    w = Window.partitionBy(cls).orderBy(order)
    islands = seen.select(cls, order).distinct().withColumn("island", F.col(order) - F.row_number().over(w))
    runs = islands.groupBy(cls, "island").agg(F.count("*").alias("n"))
    return runs.groupBy(cls).agg(F.sum("n").alias("frames"), F.max("n").alias("longest_run"))


def kept_classes(seen: DataFrame, cls: str, order: str, least: int, run: int) -> DataFrame:
    """FLT9: rows of classes seen in ``least`` places and ``run`` consecutive ones."""
    good = class_presence(seen, cls, order).where((F.col("frames") >= least) & (F.col("longest_run") >= run)).select(cls)
    return seen.join(good, cls, "left_semi")


def tag_segments(tags: DataFrame, scene: str, order: str, tag: str) -> DataFrame:
    """WIN6: stretches of consecutive frames with the same set of tags."""
    sets = tags.groupBy(scene, order).agg(F.array_sort(F.collect_set(tag)).alias("tags"))
    w = Window.partitionBy(scene).orderBy(order)
    new = F.coalesce((F.lag("tags").over(w) != F.col("tags")) | (F.lag(order).over(w) + 1 != F.col(order)), F.lit(True)).cast("int")
    marked = sets.withColumn("new", new).withColumn("segment", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(scene, "segment").agg(F.min(order).alias("first_frame"), F.max(order).alias("last_frame"), F.count("*").alias("frames"), F.concat_ws(";", F.first("tags")).alias("tags"))


def with_image(frames: DataFrame, images: DataFrame, stem: str, suffixes: list[str]) -> DataFrame:
    """JOI16: the image of the same stem whose suffix comes first in ``suffixes``."""
    rank = F.array_position(F.array(*[F.lit(s) for s in suffixes]), F.col("suffix"))
    best = images.where(rank > 0).groupBy(stem).agg(F.min_by("image", F.struct(rank, "image")).alias("image"))
    return frames.join(best, stem, "left")
