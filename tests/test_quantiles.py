"""Quantiles by selection against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pointloom.operators import quantiles as Q

SHARES = {"lowest": 0.0, "p05": 0.05, "middle": 0.5, "p98": 0.98, "highest": 1.0}


@pytest.mark.parametrize("buckets", [(16, 1024), (1, 3), (0, 1)])
def test_quantiles_of_groups(spark, monkeypatch, buckets):
    monkeypatch.setattr(Q, "OCTAVE", buckets[0])
    monkeypatch.setattr(Q, "INNER", buckets[1])
    rng = np.random.default_rng(3)
    groups = {"even": rng.normal(size=500), "ties": np.repeat([1.0, 2.0, 7.5], [400, 3, 90]), "one": np.array([4.0]), "two": np.array([-1.0, 5.0]), "far": np.append(rng.random(50), [1e9, -1e12]), "same": np.full(30, 2.5)}
    rows = [(g, float(x), float(-2 * x)) for g, v in groups.items() for x in v] + [("none", None, 3.0), ("even", None, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    values = Q.named(df, ["g"], {"x": F.col("x"), "y": F.col("y")})
    wanted = {f"x_{c}": ("x", q) for c, q in SHARES.items()} | {f"y_{c}": ("y", q) for c, q in SHARES.items()}
    got = {r.g: r.asDict() for r in Q.quantiles(values, ["g"], wanted).collect()}
    for g, v in groups.items():
        y = -2 * v
        for c, q in SHARES.items():
            assert got[g][f"x_{c}"] == pytest.approx(np.percentile(v, 100 * q), rel=1e-12, abs=1e-12)
            assert got[g][f"y_{c}"] == pytest.approx(np.percentile(y, 100 * q), rel=1e-12, abs=1e-12)
    assert got["none"]["x_middle"] is None and got["none"]["y_middle"] == 3.0


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "g string, x double")
    assert Q.quantiles(Q.named(df, ["g"], {"x": F.col("x")}), ["g"], {"m": ("x", 0.5)}).count() == 0


def test_centres_beyond_the_limit_are_met_in_blocks(spark, monkeypatch):
    from pointloom.operators import features

    rng = np.random.default_rng(8)
    rows = [(k, rng.normal(size=5).tolist(), int(k % 40), ("train", "val")[k % 3 == 0]) for k in range(300)]
    rows[0][1][2] = float("nan")
    rows[4][1][1] = None
    df = spark.createDataFrame(rows, "k bigint, v array<double>, label int, split string")
    one = sorted(map(tuple, features.evaluated_centroids(df, "k", "v", "label", "split").collect()))
    monkeypatch.setattr(features, "CENTRES", 30)
    assert sorted(map(tuple, features.evaluated_centroids(df, "k", "v", "label", "split").collect())) == one
    x = np.array([[np.nan if c is None else c for c in r[1]] for r in rows])
    train = np.array([r[3] == "train" for r in rows])
    x = np.where(np.isnan(x), np.nanmedian(x[train], axis=0), x)
    z = (x - x[train].mean(axis=0)) / x[train].std(axis=0)
    labels = np.array([r[2] for r in rows])
    found = np.unique(labels[train])
    centre = np.stack([z[train & (labels == c)].mean(axis=0) for c in found])
    d = ((z[:, None] - centre) ** 2).mean(axis=2)
    assert [(r[0], r[2]) for r in one] == [(k, found[d[k].argmin()]) for k in range(300) if not train[k]]
    assert features.accuracy(features.evaluated_centroids(df, "k", "v", "label", "split"), "label").first().rows == 100
