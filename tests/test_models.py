"""The trained ensemble and the component detector."""

import numpy as np
import pytest

from pointloom.operators import models


def test_an_ensemble_learns_and_judges(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(4, 6)) * 3
    rows = [(k, (centres[k % 4] + rng.normal(size=6)).tolist(), "abcd"[k % 4]) for k in range(400)]
    df = spark.createDataFrame(rows + [(900, None, "a"), (901, [0.0] * 6, None)], "k int, v array<double>, label string")
    classes, members = models.softmax_ensemble(df.where("k % 5 <> 0"), "k", "v", "label")
    assert classes == list("abcd") and len(members) == 3
    got = {r.k: r for r in models.classified(df, "k", "v", classes, members).collect()}
    assert len(got) == 401 and np.mean([got[k].predicted == label for k, _, label in rows if k % 5 == 0]) > 0.95
    p = models.probabilities(members, np.array([r[1] for r in rows]))
    assert np.allclose(p.sum(axis=1), 1)
    for k in range(0, 400, 37):
        best = np.sort(p[k])[::-1]
        assert got[k].predicted == classes[p[k].argmax()] and got[k].confidence == pytest.approx(best[0], abs=1e-6) and got[k].margin == pytest.approx(best[0] - best[1], abs=1e-6)


def test_an_ensemble_without_labels(spark):
    with pytest.raises(ValueError, match="labelled"):
        models.softmax_ensemble(spark.createDataFrame([], "k int, v array<double>, label string"), "k", "v", "label")


def test_components_of_labelled_pixels(spark):
    picture = ["aab..", "a.bbb", "aa..b", "..a.c"]
    rows = [(i, v, u, " .abc".index(c) - 1, 0.5 + u / 10) for i in (1, 2) for v, line in enumerate(picture) for u, c in enumerate(line)]
    df = spark.createDataFrame(rows, "image_id int, v bigint, u bigint, label int, confidence double")
    got = {(r.image_id, r.label, r.u0, r.v0, r.w, r.h, r.pixels) for r in models.detected(df).collect()}
    assert got == {(i, *c) for i in (1, 2) for c in ((1, 0, 0, 2, 3, 5), (2, 2, 0, 3, 3, 5), (1, 2, 3, 1, 1, 1), (3, 4, 3, 1, 1, 1))}
    assert models.detected(df, 2).count() == 4 and models.detected(df.where("false")).count() == 0
