"""Whitening against a dense eigendecomposition."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plaudit.llm import queries, whitening

SF = "/root/testdata/sf0.001"


def dense(x):
    """(eigenvalues falling, eigenvectors, centred rows, trace) in exact-ish arithmetic."""
    c = (x - (x.sum(0) // len(x))).astype(np.float64)
    c -= c.mean(0)
    v = c.T @ c / len(x)
    e, q = np.linalg.eigh(v)
    return e[::-1], q[:, ::-1], c, np.trace(v)


def check(rows, ids, x, components):
    e, q, c, trace = dense(x)
    k = min(components, int((e > 1e-10 * e[0]).sum()))
    n, s = len(x), x.sum(0)
    dev = {i: sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for i, row in zip(ids, x)}
    got = {(r.vec_id, r.component): r for r in rows}
    assert len(rows) == len(got) == n * k
    w = np.array([[got[i, j + 1].whitened for j in range(k)] for i in ids])
    want = c @ q[:, :k] / np.sqrt(e[:k])
    want *= np.sign((w * want).sum(0))
    # eigenvectors of close values turn into each other by rounding / gap
    gap = np.abs(e[:k, None] - e[None]) + np.where(np.eye(k, len(e)), np.inf, 0)
    assert (np.abs(w - want).max(0) < 1e-8 + 1e-9 * e[0] / gap.min(1)).all()
    assert np.allclose([got[ids[0], j + 1].explained for j in range(k)], e[:k] / trace, rtol=1e-9)
    assert all(r.deviation == dev[r.vec_id] and r.n == n and r.identity_error < 1e-9 for r in rows)


def test_query_matches_dense(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x = np.floor(64 * np.array([r.embedding for r in rows], np.float64)).astype(np.int64) + 1000000
    check(queries.op12_whitening(spark, SF).collect(), [r.vec_id for r in rows], x, 32)


@pytest.mark.parametrize("kind", ["decay", "cluster", "flat", "low rank"])
def test_spectra(spark, kind):
    """Few components of many dimensions: the filter has work to do."""
    rng = np.random.default_rng(3)
    d, n = 40, 700
    scale = {"decay": 2000 * 0.8 ** np.arange(d), "cluster": np.r_[[5000] * 3, [300] * 37],
             "flat": np.full(d, 1000), "low rank": np.r_[np.full(7, 900), np.zeros(33)]}[kind]
    turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
    x = np.floor(rng.standard_normal((n, d)) * scale @ turn.T).astype(np.int64) + 1000000
    if kind == "low rank":
        x = np.floor(rng.standard_normal((n, 7)) * 50).astype(np.int64) @ rng.integers(-3, 4, (7, d)) + 1000000
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "vec_id long, x array<long>")
    check(whitening.whiten(df.repartition(3), components=8).collect(), list(range(n)), x, 8)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, []),
            (7, [3.0]), (None, [4.0, -5.0]), (8, [0.5, 0.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("x", F.lit("clash"))
    points = whitening.fixed_point(df, scale=64, offset=10)
    assert points.where("vec_id = 8").first().x == [42, 26]
    out = whitening.whiten(points).collect()
    assert sorted({r.vec_id or 0 for r in out}) == [0, 1, 8] and len(out) == 8 and all(r.n == 4 for r in out)
    for none in (df.where("vec_id > 9"), df.where("vec_id = 1"), df.where("vec_id in (2, 3, 6)")):
        empty = whitening.whiten(whitening.fixed_point(none))
        assert empty.count() == 0 and empty.columns == [
            "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    far = spark.createDataFrame([(1, [0, 1]), (2, [1 << 40, 5]), (3, [7, -(1 << 41)])], "vec_id long, x array<long>")
    assert {r.deviation for r in whitening.whiten(far).collect()} == {None}
