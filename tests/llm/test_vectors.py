"""Whitening and exact top-k search against plain linear algebra."""

import numpy as np
import pytest

from pointloom.llm import kd_trees, whitening

SCHEMA = "vec_id bigint, embedding array<double>, label string, x string, n string, size string, part string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b", "c", "d", "e") for i, v in rows], SCHEMA)


ODD = [(900, None), (901, []), (902, [1.0, None, 2.0]), (903, [float("nan"), 1.0, 1.0]), (904, [float("inf"), 0.0, 0.0]), (905, [1.0, 2.0])]


def test_whitening_against_eigenvectors(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(400, 3)) @ rng.normal(size=(3, 3)) + 5
    rows = [(k, x.tolist()) for k, x in enumerate(v)] + [(3, v[3].tolist()), (None, v[4].tolist())]
    df = frame(spark, rows + ODD).repartition(40)  # two rounds of triangles
    got = whitening.whitened(df).toPandas()
    x = np.array([np.floor(64 * np.array(r[1])) for r in rows]).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    e, u = np.linalg.eigh(np.cov(x.T, bias=True))
    e, u = e[::-1], u[:, ::-1]
    want = (x - s / n) @ u / np.sqrt(e)
    assert len(got) == 3 * n and set(got.n) == {n} and got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-10
    for k, (i, _) in enumerate(rows):
        mine = got[got.vec_id == i] if i is not None else got[got.vec_id.isna()]
        assert set(mine.deviation) >= {int(((n * x[k] - s) ** 2).sum())}
    for j in range(3):
        c = got[got.component == j + 1]
        assert abs(c.explained.iloc[0] - e[j] / e.sum()) < 1e-12
        by = c[c.vec_id.notna()].drop_duplicates("vec_id").set_index("vec_id").whitened
        sign = np.sign(by[0] * want[0, j])
        assert all(abs(by[i] - sign * want[i, j]) < 1e-9 for i in range(400))


def test_whitening_of_tables_without_variance(spark):
    got = whitening.whitened(frame(spark, [(k, [1.0, 2.0, 3.0]) for k in range(5)])).collect()
    assert len(got) == 15 and {(r.whitened, r.explained, r.identity_error, r.deviation) for r in got} == {(0.0, 0.0, 0.0, 0)}
    assert whitening.whitened(frame(spark, [])).count() == whitening.whitened(frame(spark, ODD[:5])).count() == 0
    flat = whitening.whitened(frame(spark, [(k, [float(k), 2.0 * k, 1.0]) for k in range(9)])).toPandas()
    assert (flat[flat.component > 1].whitened == 0).all() and flat.identity_error[0] < 1e-12 and abs(flat[flat.component == 1].explained.iloc[0] - 1) < 1e-12


def test_deviations_beyond_a_long_are_null(spark):
    got = {r.vec_id: r.deviation for r in whitening.whitened(frame(spark, [(1, [1e9]), (2, [-1e9]), (3, [0.0])])).collect()}
    x = [int(64 * c) + 1_000_000 for c in (1e9, -1e9, 0)]
    assert [got[1], got[2], got[3]] == [d if (d := (3 * a - sum(x)) ** 2) < 1 << 63 else None for a in x]


@pytest.mark.parametrize("shape", ["noise", "graded", "multiple", "near", "repeats", "singular"])
def test_singular_vectors(shape):
    rng = np.random.default_rng(7)
    q = lambda n: np.linalg.qr(rng.normal(size=(n, n)))[0]
    a = {
        "noise": rng.normal(size=(90, 30)), "graded": rng.normal(size=(90, 30)) * np.logspace(0, -7, 30), "multiple": np.diag([3.0, 3, 3, 2, 2, 1, 1, 1, 1, 0.5]),
        "near": q(40)[:, :30] @ np.diag(np.r_[np.ones(10), 2 + 1e-11 * np.arange(10), np.full(10, 0.5)]) @ q(30), "repeats": rng.integers(0, 2, size=(60, 8))[:, [0, 1, 2, 3, 4, 5, 6, 7, 0]].astype(float),
        "singular": rng.normal(size=(6, 20)),
    }[shape]
    r = whitening.triangle([a])
    squares, v = whitening.principal(r, r.shape[1])
    want = np.linalg.svd(r)[1]
    assert np.abs(np.sqrt(np.abs(squares)) - want).max() < 1e-13 * want[0]
    big = want > 1e-12 * want[0]
    assert (np.abs(np.sqrt(squares[big]) - want[big]) < 1e-12 * want[big]).all() or shape in ("repeats", "singular")
    v, kept = v[:, v.any(axis=0)], squares[: len(squares)][v.any(axis=0)]
    assert v.shape[1] == big.sum()
    near = shape == "near"  # ten values within rounding of each other
    assert np.abs(v.T @ v - np.eye(v.shape[1])).max() < (1e-7 if near else 1e-10)
    assert np.abs(r.T @ (r @ v) - v * kept).max() < (1e-7 if near else 1e-13) * want[0] ** 2


def plain_top(rows, asked, k):
    fine = [(i, [int(np.floor(64 * c)) for c in v]) for i, v in rows if i is not None and v is not None and all(c is not None and np.isfinite(c) and abs(c) < 2**56 for c in v)]
    out = set()
    for q in {i for i, _ in fine if i in asked}:
        best = sorted({(-sum(a * b for a, b in zip(x, y)), j) for i, x in fine if i == q for j, y in fine if j != q and len(x) == len(y)})
        out |= {(q, r + 1, j, max(-(2**63) + 1, min(2**63 - 1, -s))) for r, (s, j) in enumerate(best[:k])}
    return out


@pytest.mark.parametrize("shard", [8192, 40])
def test_top_k_against_brute_force(spark, shard, monkeypatch):
    monkeypatch.setattr(kd_trees.leaves, "__defaults__", (8,))
    monkeypatch.setattr(kd_trees, "ASKED", 16)
    monkeypatch.setattr(kd_trees, "BOXES", 4)
    rng = np.random.default_rng(1)
    v = np.vstack([rng.normal(size=(150, 4)), np.tile(rng.normal(size=4), (120, 1)), rng.normal(size=(60, 4)) * 0.02 + 1, np.zeros((3, 4))])  # more than a third is one vector
    rows = [(k, x.tolist()) for k, x in enumerate(v)] + ODD + [(906, [0.5, 0.25]), (907, []), (None, v[0].tolist()), (5, v[5].tolist()), (5, v[9].tolist()), (10, v[11].tolist()), (40, [3e14, -3e14, 1.0, 2.0]), (41, [1e17, 0.0, 0.0, 0.0])]
    df = frame(spark, rows)
    asked = set(range(0, 1000, 5))
    got = {tuple(r) for r in kd_trees.top_k(df, df.where("vec_id % 5 = 0"), 7, shard=shard).select("query_id", "rank", "vec_id", "score").collect()}
    assert got == plain_top(rows, asked, 7)


def test_clusters_are_pruned():
    rng = np.random.default_rng(4)
    x = (np.repeat(rng.normal(size=(64, 8)) * 1000, 256, axis=0) + rng.normal(size=(64 * 256, 8))).astype(np.int64)
    tree = kd_trees.Tree(x, np.arange(len(x)), kd_trees.leaves(x))
    seen = []

    class Watched(np.ndarray):
        def __matmul__(self, other):
            seen.append(len(self))
            return np.asarray(self) @ other

    kept = kd_trees.exact
    kd_trees.exact = lambda a, q: (kept(a, q)[0].view(Watched) if len(a) == len(x) else kept(a, q)[0], kept(a, q)[1])
    try:
        best = list(tree.search(x[:5], np.arange(5), [(-(2**62), 0)] * 5, 20))
    finally:
        kd_trees.exact = kept
    assert sum(seen) < 0.2 * 5 * len(x)  # a fifth of brute force at most
    for q, found in enumerate(best):
        score = x @ x[q]
        score[q] = -(2**62)
        order = np.lexsort((np.arange(len(x)), -score))[:20]
        assert sorted(found, reverse=True) == [(int(score[j]), -int(j)) for j in order]


def test_top_k_of_an_empty_table(spark):
    df = frame(spark, [])
    got = kd_trees.top_k(df, df)
    assert got.columns == ["query_id", "rank", "vec_id", "score"] and got.count() == 0
    few = frame(spark, [(0, [1.0]), (20, [2.0])])
    assert {tuple(r) for r in kd_trees.top_k(few, few.where("vec_id = 0")).collect()} == {(0, 1, 20, 64 * 128)}
