"""Splits of datasets by greedy rules over types.

Sources with the same label counts, and frames with the same classes, are one type:
a greedy rule can't tell them apart but by its tie order. So one task walks over
types alone and says how many of each go where; which ones is decided by their place
in a hash order, which is counted on the cluster.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from math import ceil, floor, lcm

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

SPLITS = ("train", "val", "test")


def hashed_place(key: str, seed: int) -> Column:
    """A place that the key alone decides, on any cluster and in any SQL."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary"))


def ranked(rows: DataFrame, group: str, key: str, seed: int) -> DataFrame:
    """``rows`` with ``place``: from 1, by hash order within ``group``; a group of any size is spread over 4,096 parts of the hash's range."""
    cut = rows.withColumn("hash", hashed_place(key, seed)).withColumn("part", F.substring("hash", 1, 3))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy(group, "part").agg(F.count("*").alias("n")).select(group, "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy(group, "part").orderBy("hash", key))
    return cut.join(counts, [group, "part"]).withColumn("place", F.col("before") + own).drop("hash", "part", "before")


# ---- sources by label counts ----------------------------------------------------------


def remainder_quotas(total: int, shares: tuple[Fraction, ...]) -> list[int]:
    """Groups of each split by largest remainder; from three groups on a wanted split gets one of the fullest rather than none."""
    wanted = [total * s for s in shares]
    quotas = [floor(w) for w in wanted]
    for k in sorted(range(3), key=lambda k: (quotas[k] - wanted[k], k))[: total - sum(quotas)]:
        quotas[k] += 1
    for k in range(3) if total >= 3 else ():
        fullest = max(range(3), key=lambda j: (quotas[j], -j))
        if shares[k] > 0 and not quotas[k] and quotas[fullest] > 1:
            quotas[fullest] -= 1
            quotas[k] += 1
    return quotas


def rounded_quotas(total: int, shares: tuple[Fraction, ...]) -> list[int]:
    """Groups of each split by rounding (halves to even): validation and test get one at least, training what is left, and one from the larger of both if that is none."""
    if total < 3:
        return [min(total, 1), max(0, total - 1), 0]
    val = max(1, round(total * shares[1])) if shares[1] > 0 else 0
    test = max(1, round(total * shares[2]))
    if val + test >= total:
        val, test = (val - 1, test) if val >= test and val > 1 else (val, test - 1)
        return [1, val, total - 1 - val]
    return [total - val - test, val, test]


class QuotaWalk:
    """Costs of the three splits: squared distance of each class's count (and, at a quarter, of all counts) to its target, over the target plus one.

    All in whole numbers and fractions, so equal costs are equal and the first split wins; doubles decide where
    they are far enough apart.
    """

    def __init__(self, totals: dict, groups: int, shares: tuple[Fraction, ...], quotas: list[int]):
        self.unit = lcm(*(s.denominator for s in shares))
        self.parts = [int(s * self.unit) for s in shares]
        self.totals, self.free = totals | {None: sum(totals.values())}, list(quotas)
        self.over = [{c: -p * n for c, n in self.totals.items()} for p in self.parts]  # unit * (count - target)
        self.weight = [{c: (1.0 if c is not None else 0.25) / (p * n + self.unit) for c, n in self.totals.items()} for p in self.parts]

    def rises(self, counts: dict) -> list[tuple[Fraction, Fraction]]:
        """Of each split: what the first such source adds to the cost, and by how much more each next one does."""
        out = []
        for p, over in zip(self.parts, self.over):
            first = step = Fraction(0)
            for c, v in counts.items():
                share = Fraction(v if c is not None else Fraction(v, 4), p * self.totals[c] + self.unit)
                first += share * (2 * over[c] + self.unit * v)
                step += share * 2 * self.unit * v
            out.append((first, step))
        return out

    def clear(self, counts: dict) -> int | None:
        """The split where one such source costs least, if doubles can tell."""
        costs, size = [], 0.0
        for k in (k for k in range(3) if self.free[k]):
            terms = [self.weight[k][c] * v * (2 * self.over[k][c] + self.unit * v) for c, v in counts.items()]
            costs.append((sum(terms), k))
            size = max(size, sum(map(abs, terms)))
        costs.sort()
        return costs[0][1] if len(costs) == 1 or costs[1][0] - costs[0][0] > 1e-9 * size else None

    def take(self, counts: dict, many: int) -> list[int]:
        """How many of ``many`` equal sources each split gets when each in turn goes where it costs least."""
        counts, got = counts | {None: sum(counts.values())}, [0, 0, 0]
        if many == 1 and (best := self.clear(counts)) is not None:
            got[best], many = 1, 0
        rises = self.rises(counts) if many else []
        if many > 8:  # all that cost less than a level are taken before any other
            below = lambda level: [min(f, max(0, ceil((level - a) / b))) for (a, b), f in zip(rises, self.free)]
            low, high = min(a for a, _ in rises), max(a + b * many for a, b in rises)
            for _ in range(80):
                middle = (low + high) / 2
                low, high = (middle, high) if sum(below(middle)) <= many else (low, middle)
            got = below(low)
        for _ in range(many - sum(got) if many else 0):
            got[min((a + b * n, k) for k, ((a, b), n) in enumerate(zip(rises, got)) if n < self.free[k])[1]] += 1
        for k, n in enumerate(got):
            self.free[k] -= n
            for c, v in counts.items():
                self.over[k][c] += self.unit * v * n
        return got


def grouped_split(
    manifest: DataFrame, shares: tuple[float, float, float] = (0.7, 0.15, 0.15), seed: int = 1, quotas: Callable[[int, tuple[Fraction, ...]], list[int]] = remainder_quotas
) -> DataFrame:
    """DOM14: ``new_split`` of each row; a source is in one split, and each split has its exact quota of sources.

    Sources go by falling rarity (their samples, each over its class's samples; to 12 digits),
    falling size, then label counts; each to the split with room where the cost is least. Among
    sources with equal label counts those first in hash order train, the next validate. Classes'
    totals are on the driver and one task sees each type of source once. Rows without a
    source or a label are left out.
    """
    shares_ = tuple(Fraction(str(s)) for s in shares)
    held = manifest.where("source_id IS NOT NULL AND label IS NOT NULL")
    counts = held.groupBy("source_id", "label").agg(F.count("*").alias("n"))
    kind = F.array_sort(F.collect_list(F.struct("label", "n"))).alias("kind")
    sources = counts.groupBy("source_id").agg(kind).withColumn("type", F.md5(F.to_json("kind").cast("binary")))
    types = sources.groupBy("type").agg(F.first("kind").alias("kind"), F.count("*").alias("many"))
    totals = {r["label"]: r["n"] for r in counts.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    total_of = counts.groupBy("label").agg(F.sum("n").alias("total"))
    flat = types.select("type", F.explode("kind").alias("k")).select("type", F.col("k.label").alias("label"), F.col("k.n").alias("n"))
    order = flat.join(total_of, "label").groupBy("type").agg(F.round(F.sum(F.col("n") / F.col("total")), 12).alias("rarity"), F.sum("n").alias("size"))
    groups = sources.count()

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = QuotaWalk(totals, groups, shares_, quotas(groups, shares_))
        for batch in batches:
            got = [state.take({k["label"]: k["n"] for k in kind}, many) for kind, many in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([g[k] for g in got], pa.int64()) for k in range(2))], names=["type", "trains", "validates"])

    one = types.join(order, "type").repartition(1).sortWithinPartitions(F.desc("rarity"), F.desc("size"), "kind").select("type", "kind", "many")
    walked = one.mapInArrow(walk, "type string, trains bigint, validates bigint")
    placed = ranked(sources.select("source_id", "type"), "type", "source_id", seed).join(walked, "type")
    split = F.when(F.col("place") <= F.col("trains"), SPLITS[0]).when(F.col("place") <= F.col("trains") + F.col("validates"), SPLITS[1]).otherwise(SPLITS[2])
    return manifest.join(placed.select("source_id", split.alias("new_split")), "source_id")


# ---- frames by classes ----------------------------------------------------------------


def covering(sets: list[list], many: list[int], wanted: int) -> list[int]:
    """How many frames of each set of classes validate: ``wanted`` in all, or as many as leave each class a training frame.

    In turn the set goes that brings most unseen classes, each weighing 1 over its frames that
    still train, then the one whose classes weigh most, then the first. Taking one of a set adds
    at least as much to its own weight as to any other's, so while it brings nothing unseen it
    stays the choice until it runs out: all of these are taken at once.
    """
    classes = {c: k for k, c in enumerate(sorted({c for s in sets for c in s}))}
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    col = np.array([classes[c] for s in sets for c in s], np.int64)
    free, got = np.array(many, np.int64), np.zeros(len(sets), np.int64)
    left = np.bincount(col, free[row], len(classes)).astype(np.int64)
    seen = np.zeros(len(classes), bool)
    over = lambda weight: np.round(np.bincount(row, weight[col], len(sets)), 12)
    while (room := wanted - int(got.sum())) > 0:
        able = (free > 0) & (np.bincount(row, left[col] <= 1, len(sets)) == 0)
        if not able.any():
            break
        weight = 1 / np.maximum(left, 1)
        fresh, rare = over(np.where(seen, 0, weight)), over(weight)
        at = np.flatnonzero(able)
        best = at[np.lexsort((at, -rare[at], -fresh[at]))[0]]
        own = col[row == best]
        n = 1 if fresh[best] > 0 else int(min([free[best], room, *(left[own] - 1)]))
        free[best] -= n
        got[best] += n
        left[own] -= n
        seen[own] = True
    return got.tolist()


def rare_class_split(frame_classes: DataFrame, share: float = 0.2, seed: int = 1) -> DataFrame:
    """DOM13: a greedy cover of the classes by ``share`` of the frames (rounded up) for validation; each class keeps a training frame.

    frame_classes: frame_ord, label; a null label stands for a frame without classes. Among
    frames with equal classes those first in hash order validate. One task holds the sets of
    classes that occur, not the frames. Fewer than two frames, or none that can
    validate, are an error.
    """
    frames = frame_classes.groupBy("frame_ord").agg(F.array_sort(F.collect_set("label")).alias("classes")).withColumn("type", F.md5(F.to_json(F.struct("classes")).cast("binary")))
    types = frames.groupBy("type").agg(F.first("classes").alias("classes"), F.count("*").alias("many"))
    part = Fraction(str(share))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [r for batch in batches for r in batch.to_pylist()]
        total = sum(r["many"] for r in held)
        if total < 2:
            raise ValueError("a split needs two frames at least")
        got = covering([r["classes"] for r in held], [r["many"] for r in held], min(total - 1, max(1, ceil(total * part))))
        if not any(got):
            raise ValueError("no frame can validate: each has a class that no other frame has")
        yield pa.RecordBatch.from_arrays([pa.array([r["type"] for r in held]), pa.array(got, pa.int64())], names=["type", "validates"])

    walked = types.repartition(1).sortWithinPartitions("classes").mapInArrow(walk, "type string, validates bigint")
    placed = ranked(frames.select("frame_ord", "type"), "type", "frame_ord", seed).join(walked, "type")
    return placed.select("frame_ord", F.when(F.col("place") <= F.col("validates"), "val").otherwise("train").alias("split"))


def class_aware_split(frame_counts: DataFrame, share: float = 0.2, seed: int = 1) -> DataFrame:
    """DOM12: the first ``share`` of the frames in hash order validate (rounded, one at least, never all); then each class in turn is repaired.

    frame_counts: frame_ord, label, n; labels that are null or have n <= 0 count for nothing.
    A class of one frame trains it. One without a training frame trains the frame that holds
    most of it; one without a validating frame then validates the frame that holds least,
    while a second frame is left to train. Ties go to the smaller frame. One task sees a row a
    class, with the classes of the two frames that it may move, and keeps what has moved.
    """
    frames = frame_counts.where("frame_ord IS NOT NULL").select("frame_ord").distinct().withColumn("all", F.lit(0))
    total = frames.count()
    wanted = min(max(1, round(total * Fraction(str(share)))), total - 1) if share > 0 else 0
    start = ranked(frames, "all", "frame_ord", seed).select("frame_ord", (F.col("place") <= wanted).alias("val"))
    held = frame_counts.where("frame_ord IS NOT NULL AND label IS NOT NULL AND n > 0").groupBy("frame_ord", "label").agg(F.sum("n").alias("n"))
    both = held.join(start, "frame_ord")
    ends = both.groupBy("label").agg(
        F.count("*").alias("frames"), F.count_if("val").alias("vals"), F.min(F.struct("n", "frame_ord", "val")).alias("low"), F.min(F.struct((-F.col("n")).alias("n"), "frame_ord", "val")).alias("high")
    )
    movable = ends.select(F.explode(F.array("low.frame_ord", "high.frame_ord")).alias("frame_ord")).distinct()
    classes = held.join(movable, "frame_ord").groupBy("frame_ord").agg(F.collect_list("label").alias("classes"))
    side = lambda c: classes.select(F.col("frame_ord").alias(f"{c}_frame"), F.col("classes").alias(f"{c}_classes"))
    rows = ends.select("label", "frames", "vals", *[F.col(f"{c}.{f}").alias(f"{c}_{n}") for c in ("low", "high") for f, n in (("frame_ord", "frame"), ("val", "val"))])
    rows = rows.join(side("low"), "low_frame").join(side("high"), "high_frame").repartition(1).sortWithinPartitions("label")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change: dict = {}  # of classes: validating frames gained
        moved: dict = {}
        size = wanted
        for batch in batches:
            for r in batch.to_pylist():
                vals = lambda: r["vals"] + change.get(r["label"], 0)  # noqa: B023, E731
                steps = [("low", False, lambda: r["frames"] == 1 and vals())]  # noqa: B023
                if r["frames"] > 1:
                    steps = [("high", False, lambda: vals() == r["frames"]), ("low", True, lambda: not vals() and size < total - 1)]  # noqa: B023
                for end, to, needed in steps:
                    if needed():
                        moved[r[f"{end}_frame"]] = to
                        size += 1 if to else -1
                        for c in r[f"{end}_classes"]:
                            change[c] = change.get(c, 0) + (1 if to else -1)
        yield pa.RecordBatch.from_arrays([pa.array(list(moved), kind), pa.array(list(moved.values()), pa.bool_())], names=["frame_ord", "to"])

    field = frame_counts.schema["frame_ord"].dataType
    kind = to_arrow_type(field)
    moves = rows.mapInArrow(walk, f"frame_ord {field.simpleString()}, `to` boolean")
    return start.join(moves, "frame_ord", "left").select("frame_ord", F.when(F.coalesce("to", "val"), "val").otherwise("train").alias("split"))
