"""Models for the hooks of ``sources.sinks`` that are trained or computed here: a softmax ensemble and a component detector."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointloom.functions.scalars import top_two
from pointloom.sources.sinks import classifier, detector


def softmax_ensemble(vectors: DataFrame, key: str, vector: str, label: str, members: int = 3, regularisation: float = 0.01) -> tuple[list, list[tuple[np.ndarray, np.ndarray]]]:
    """Classes, and the weights and constants of ``members`` softmax regressions, each trained without one fold of the rows.

    Folds go by a hash of the key. Rows without a label or a vector train nothing. Training runs on Spark; classes x
    dimensions numbers a member reach the driver.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    held = vectors.where(F.col(label).isNotNull() & F.col(vector).isNotNull())
    classes = [r[0] for r in held.select(label).distinct().orderBy(label).collect()]
    if not classes:
        raise ValueError("a classifier needs labelled rows")
    place = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)).cast("double") - 1
    rows = held.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features"), place.alias("label"), F.pmod(F.xxhash64(key), F.lit(members)).alias("fold"))
    model = LogisticRegression(family="multinomial", regParam=regularisation, maxIter=50)
    out = []
    for k in range(members):
        fitted = model.fit(rows.where(F.col("fold") != k) if members > 1 else rows)
        found = fitted.coefficientMatrix.toArray()
        weights, constants = np.zeros((len(classes), found.shape[1])), np.full(len(classes), -np.inf)  # classes that a member never saw
        weights[: len(found)], constants[: len(found)] = found, fitted.interceptVector.toArray()
        out.append((weights, constants))
    return classes, out


def probabilities(members: list[tuple[np.ndarray, np.ndarray]], x: np.ndarray) -> np.ndarray:
    """Mean of the members' softmaxes for each row of ``x``."""
    total = 0.0
    for weights, constants in members:
        z = x @ weights.T + constants
        e = np.exp(z - z.max(axis=1, keepdims=True))
        total = total + e / e.sum(axis=1, keepdims=True)
    return total / len(members)


def classified(vectors: DataFrame, key: str, vector: str, classes: list, members: list[tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """UDF1: (key, predicted, confidence, margin) by the ensemble; the earlier class on ties."""
    model = classifier(lambda: lambda x: probabilities(members, np.asarray(x, np.float64)), features=members[0][0].shape[1], classes=len(classes), batch_size=1024)
    judged = vectors.where(F.col(vector).isNotNull()).select(key, model(F.col(vector).cast("array<double>")).alias("p"))
    best = judged.withColumns(top_two("p"))
    return best.select(key, F.element_at(F.array(*[F.lit(c) for c in classes]), (F.col("best") + 1).cast("int")).alias("predicted"), "confidence", "margin")


def linked_pixels(v: np.ndarray, u: np.ndarray, label: np.ndarray) -> np.ndarray:
    """The component of each pixel: pixels of one label that touch by a side, numbered by their first."""
    root = np.arange(len(v))
    place = {(a, b): k for k, (a, b) in enumerate(zip(v.tolist(), u.tolist()))}

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = k = root[root[k]]
        return k

    for (a, b), k in place.items():
        for beside in ((a, b + 1), (a + 1, b)):
            j = place.get(beside)
            if j is not None and label[j] == label[k]:
                x, y = find(k), find(j)
                root[max(x, y)] = min(x, y)
    return np.array([find(k) for k in range(len(v))], np.int64)


def component_detector(least: int = 1) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A detector for the hook: the connected components of labelled pixels, with their box and mean confidence."""
    columns = ["image_id", "label", "score", "u0", "v0", "w", "h", "pixels"]

    def detect(part: pd.DataFrame) -> pd.DataFrame:
        out = []
        for image, pixels in zip(part["image_id"], part["pixels"]):
            v, u, label, score = (np.array([p[c] for p in pixels]) for c in ("v", "u", "label", "confidence"))
            of = linked_pixels(v, u, label)
            for k in np.unique(of):
                own = of == k
                if own.sum() >= least:
                    u0, v0 = u[own].min(), v[own].min()
                    out.append((image, label[k], score[own].mean(), u0, v0, u[own].max() - u0 + 1, v[own].max() - v0 + 1, own.sum()))
        return pd.DataFrame(out, columns=columns)

    return detect


def detected(pixels: DataFrame, least: int = 1, background: int = 0) -> DataFrame:
    """UDF2: detections of each image (image_id, v, u, label, confidence): components of at least ``least`` labelled pixels.

    An image is one row of the hook's input, so its pixels must fit a task.
    """
    kind = pixels.schema["image_id"].dataType.simpleString()
    images = pixels.where(F.col("label") != background).groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("v", "u", "label", "confidence"))).alias("pixels"))
    return detector(images, component_detector(least), f"image_id {kind}, label bigint, score double, u0 bigint, v0 bigint, w bigint, h bigint, pixels bigint")
