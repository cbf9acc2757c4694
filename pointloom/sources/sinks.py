"""Writing results: partitioned tables, reports, manifests, pose lines. Spark's commit makes each write all or nothing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def frames_table(df: DataFrame, path: str, by: tuple[str, ...] = ("frame_id",), overwrite: bool = False) -> None:
    """SNK1, SNK2, SNK8: one folder per frame (and split); refuses a folder with content unless asked."""
    df.repartition(*by).write.mode("overwrite" if overwrite else "errorifexists").partitionBy(*by).parquet(path)


def report_csv(df: DataFrame, path: str, overwrite: bool = True) -> None:
    """SNK4, SNK5: a small report as one CSV file."""
    df.coalesce(1).write.mode("overwrite" if overwrite else "errorifexists").option("header", True).csv(path)


def manifest_jsonl(df: DataFrame, path: str) -> None:
    """SNK6, SNK9: JSON lines with sorted keys."""
    df.select(*sorted(df.columns)).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def pose_lines(df: DataFrame, path: str, pose: str, order: str) -> None:
    """SNK7: twelve numbers a line, in order."""

    @F.pandas_udf("string")
    def line(poses: pd.Series) -> pd.Series:
        return poses.map(lambda p: " ".join(f"{v:.12g}" for v in p))

    df.orderBy(order).select(line(pose).alias("value")).write.mode("overwrite").text(path)


#: Places of a frame's points that are packed together.
PACKED = 1 << 16


def point_cloud_bytes(points: DataFrame) -> DataFrame:
    """SNK3: (frame_id, cloud, labels): XYZI float32 and uint32 labels of each frame, in row order, ready for a binary sink.

    Python packs stretches of 65,536 places; Spark joins a frame's stretches in order.
    """
    values = ("x", "y", "z", "intensity")

    def pack(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("row_idx").to_numpy(), kind="stable")
        cloud = np.empty((len(order), len(values)), "<f4")
        for k, name in enumerate(values):
            cloud[:, k] = table.column(name).to_numpy()[order]
        labels = table.column("label").to_numpy()[order].astype("<u4")
        held = [pa.array([v.tobytes()], pa.binary()) for v in (cloud, labels)]
        return pa.table([table.column("frame_id").combine_chunks()[:1].cast(pa.string()), table.column("part").combine_chunks()[:1], *held], names=["frame_id", "part", "cloud", "labels"])

    dealt = points.select("frame_id", F.floor(F.col("row_idx") / PACKED).cast("bigint").alias("part"), "row_idx", *values, "label")
    parts = dealt.groupBy("frame_id", "part").applyInArrow(pack, "frame_id string, part bigint, cloud binary, labels binary")
    joined = [F.expr(f"listagg({c}) WITHIN GROUP (ORDER BY part)").alias(c) for c in ("cloud", "labels")]
    return parts.groupBy("frame_id").agg(*joined)


def decoded_csv(frames: DataFrame, path: str) -> None:
    """SNK10: decoded packet frames as CSV, a folder per frame."""
    frames.repartition("frame_id").sortWithinPartitions("frame_id", "row_idx").write.mode("overwrite").partitionBy("frame_id").option("header", True).csv(path)


def detector(images: DataFrame, detect, schema: str) -> DataFrame:
    """UDF2: a caller's function from a frame of images to its detections."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield detect(part)

    return images.mapInPandas(run, schema)


def classifier(make_predict, features: int, classes: int = 2, batch_size: int = 64):
    """UDF1: a caller's batch model as a column function from arrays of ``features`` values to arrays of probabilities."""
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import ArrayType, DoubleType

    def guarded():
        predict = make_predict()

        def run(x: np.ndarray) -> np.ndarray:
            out = np.asarray(predict(x), dtype=np.float64)
            if out.shape != (len(x), classes):
                raise ValueError(f"the model gave {out.shape}, not {(len(x), classes)}")
            return out

        return run

    return predict_batch_udf(guarded, return_type=ArrayType(DoubleType()), batch_size=batch_size, input_tensor_shapes=[[features]])
