"""Whitening against dense eigenvectors, and the qd solver against plain singular values."""

import numpy as np
import pytest

from cardledger.llm.bidiagonal import bidiagonalise, dqds, right_vectors
from cardledger.llm.whitening import fit_whitening, integer_vectors, whiten

EXTRA = "x string, n string, state string, component string, score string"


def frame(spark, vectors, kind="float"):
    rows = [(i, v, *["same"] * 5) for i, v in vectors]
    return spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>, {EXTRA}")


def square(a):
    r = np.linalg.qr(a, mode="r")
    return np.vstack([r, np.zeros((a.shape[1] - len(r), a.shape[1]))])


RNG = np.random.default_rng(5)
Q = np.linalg.qr(RNG.standard_normal((60, 8)))[0]
TURN = np.linalg.qr(RNG.standard_normal((8, 8)))[0]
MATRICES = {
    "random": RNG.standard_normal((200, 16)),
    "graded": RNG.standard_normal((100, 10)) * 10.0 ** -np.arange(10),
    "rank of three": RNG.standard_normal((50, 3)) @ RNG.standard_normal((3, 9)),
    "equal values": Q * 3,
    "identity": np.eye(5),
    **{f"values {gap} apart": Q * (1 + gap * np.arange(8)) @ TURN for gap in (1e-2, 1e-6, 1e-10, 1e-14)},
    "close pairs": np.diag(np.abs(np.arange(-10, 11)) + 1.0) + np.diag(np.ones(20), 1),
    "constant columns": np.hstack([RNG.standard_normal((40, 4)), np.zeros((40, 3))]),
    "one column": RNG.standard_normal((9, 1)),
    "two columns": RNG.standard_normal((9, 2)),
    "one row": RNG.standard_normal((1, 4)),
}


@pytest.mark.parametrize("name", MATRICES)
def test_solver(name):
    a = MATRICES[name]
    values, vectors = right_vectors(square(a), a.shape[1])
    want = np.linalg.svd(a, compute_uv=False) ** 2
    want = np.concatenate([want, np.zeros(a.shape[1] - len(want))])
    assert np.abs(values - want).max() <= 1e-13 * want[0]
    assert np.abs(a.T @ a @ vectors.T - vectors.T * values).max() <= 1e-13 * want[0]
    own = vectors[values > 1e-20 * want[0]]
    assert np.abs(own @ own.T - np.eye(len(own))).max() < 1e-11


def test_small_values_keep_their_digits():
    """A bidiagonal matrix tells its least singular values to full relative accuracy."""
    a, b = 10.0 ** -np.arange(12.0), 10.0 ** -(np.arange(11) + 0.5)
    from fractions import Fraction

    found = dqds(a * a, b * b)
    product = 1.0
    for v in a:
        product *= v * v
    assert np.prod(found) == pytest.approx(product, rel=1e-13)
    # sum of 1 / value is the trace of the inverse of B B^T, here in exact numbers
    inverse = [[Fraction(0)] * 12 for _ in range(12)]
    for j in range(12):
        inverse[j][j] = 1 / Fraction(a[j])
        for i in range(j - 1, -1, -1):
            inverse[i][j] = -Fraction(b[i]) * inverse[i + 1][j] / Fraction(a[i])
    trace = sum(x * x for row in inverse for x in row)
    assert sum(1 / v for v in found) == pytest.approx(float(trace), rel=1e-12)


def test_bidiagonal_form():
    a = square(MATRICES["random"])
    d, e, v = bidiagonalise(a)
    b = np.diag(d) + np.diag(e, 1)
    assert np.abs(v @ b.T @ b @ v.T - a.T @ a).max() < 1e-11
    assert np.abs(bidiagonalise(np.zeros((3, 3)))[0]).max() == 0


def plain(vectors, top=4):
    """Rows (id, component) -> values, by a dense eigensolver."""
    kept = [(i, v) for i, v in vectors if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(256 * np.array([v for _, v in kept], dtype=np.float32).astype(float)).astype(int)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    white = (x - s / n) @ u[:, :top] / np.sqrt(e[:top])
    return [i for i, _ in kept], n, ((n * x - s) ** 2).sum(axis=1), white, e[:top] / e.sum()


def check(rows, vectors, top=4):
    ids, n, deviation, white, explained = plain(vectors, top)
    assert len(rows) == len(ids) * top
    got = sorted(rows, key=lambda r: (r["component"], str(r["vec_id"]), r["deviation"]))
    order = sorted(range(len(ids)), key=lambda i: (str(ids[i]), deviation[i]))
    found = np.array([r["whitened"] for r in got]).reshape(top, -1).T
    want = white[order]
    sign = np.sign((found * want).sum(axis=0))
    assert np.abs(found - want * sign).max() < 1e-9
    assert [r["deviation"] for r in got[: len(ids)]] == deviation[order].tolist()
    assert {r["n"] for r in rows} == {n} and {r["component"] for r in rows} == set(range(1, top + 1))
    assert np.allclose([r["explained"] for r in got[:: len(ids)]], explained, rtol=1e-10)
    error = {r["identity_error"] for r in rows}
    assert len(error) == 1 and 0 <= error.pop() < 1e-9


def test_against_dense(spark):
    rng = np.random.default_rng(0)
    mixed = rng.standard_normal((300, 6)) @ np.diag([5, 3, 2, 1, 0.5, 0.2])
    vectors = [(i, [float(c) for c in v]) for i, v in enumerate(mixed)]
    vectors += [(1000 + i, vectors[7][1]) for i in range(150)]  # a third of the rows share one vector
    vectors += [(5, vectors[5][1]), (None, vectors[9][1]), (900, None), (901, [1.0] * 5 + [None]), (902, [float("nan")] + [0.0] * 5)]
    vectors += [(903, [0.0] * 5 + [float("-inf")])]
    check(whiten(frame(spark, vectors)).collect(), vectors)
    check(whiten(frame(spark, vectors).repartition(7)).collect(), vectors)


def test_odd_lengths_and_no_variance(spark):
    base = [(i, [float(i % 5), float(i % 3), 1.0]) for i in range(30)]
    out = whiten(frame(spark, [*base, (100, []), (101, [1.0]), (102, [1.0] * 9)])).collect()
    assert {r["vec_id"] for r in out} == set(range(30)) and {r["component"] for r in out} == {1, 2, 3}
    flat = [r for r in out if r["component"] == 3]
    assert all(r["whitened"] is None and r["explained"] < 1e-20 for r in flat)
    assert all(r["whitened"] is not None and r["identity_error"] < 1e-9 for r in out if r["component"] < 3)
    one = whiten(frame(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, None, None, None)] * 4
    assert whiten(frame(spark, [])).collect() == [] == whiten(frame(spark, [(1, None)])).collect()
    assert whiten(frame(spark, [(1, [])])).collect() == []


def test_large_entries(spark):
    vectors = [(i, [1e9 * i, float(i % 2), -0.0]) for i in range(9)]
    out = whiten(frame(spark, vectors, "double")).collect()
    assert {r["vec_id"]: r["deviation"] for r in out}[4] == sum((9 * x - s) ** 2 for x, s in ((256 * 4 * 10**9, 256 * 36 * 10**9), (0, 1024)))
    far = {r["vec_id"]: r["deviation"] for r in whiten(frame(spark, [(i, [1e12 * i, 1.0]) for i in range(9)], "double")).collect()}
    assert far[0] is None and far[4] == 0


def test_fit_of_double_vectors(spark):
    x = integer_vectors(frame(spark, [(1, [0.999, -0.001]), (2, [1.0, 0.0])], "double"))
    assert sorted(r["x"] for r in x.collect()) == [[255, -1], [256, 0]]
    fit = fit_whitening(x)
    assert fit.n == 2 and fit.sums.tolist() == [511, -1] and fit.defined.tolist() == [True, False]
