"""Whitened coordinates of embeddings along the directions of greatest variance.

Entries become integers (``floor(256 * c)``).  The fit uses each distinct integer vector once.
Its centred rows are never multiplied with each other: every task folds its rows into one
triangular factor by blockwise QR, the factors are folded the same way in two further steps, and
what reaches the driver is one square matrix of the dimension.  There the matrix is made bidiagonal
and its singular values and right vectors are found by ``bidiagonal``.  Rows meet the fit as a
closure of a few vectors.

Dropped: rows whose vector is null, holds null or non-finite entries, or has another length than
most of them (of equally frequent lengths the greater counts).  Kept rows each get one row a
component, repeated and null ids alike; a vector that a third of the rows share counts once in the
fit and is met once a task.  A component without variance (less than ``NOISE`` of the greatest) has
null ``whitened``; ``explained`` is null if there is no variance at all, ``identity_error`` if no
component has any.  ``deviation`` is null beyond a bigint.  An empty table gives no rows.  Equal
eigenvalues leave the choice of directions open: any orthonormal ones are right.  An entry that
leaves the bigint range is taken as its end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardledger.llm.bidiagonal import right_vectors
from cardledger.llm.common import store

SCALE = 256
COMPONENTS = 4
#: Share of the greatest eigenvalue below which a variance is rounding.
NOISE = 1e-20
#: Partial results that one task folds in the second of three steps.
_FAN = 8
_LONG = np.iinfo(np.int64).max
_OUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double"


@dataclass
class Fit:
    """What the distinct vectors tell: their number, per-dimension sums and whitening directions."""

    n: int
    sums: np.ndarray  # Python ints
    eigenvalues: np.ndarray  # all, falling
    vectors: np.ndarray  # a row for each component
    identity_error: float | None = None

    @property
    def defined(self) -> np.ndarray:
        """Which components have variance."""
        first = self.eigenvalues[: len(self.vectors)]
        return first > NOISE * max(self.eigenvalues.max(initial=0.0), 0.0)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, the integer part of the mean taken off exactly."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([(s - w * self.n) / self.n for s, w in zip(self.sums.tolist(), whole.tolist())])
        return (x - whole).astype(float) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """A column for each component that has variance."""
        own = self.defined
        return self.centred(x) @ (self.vectors[own].T / np.sqrt(self.eigenvalues[: len(own)][own]))

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sums over dimensions of (n x - S)^2, exact."""
        most = self.n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + max(map(abs, self.sums.tolist()))
        if most**2 * x.shape[1] <= _LONG:
            y = self.n * x - self.sums.astype(np.int64)
            return (y * y).sum(axis=1).tolist()
        y = self.n * x.astype(object) - self.sums
        return [v if v <= _LONG else None for v in (y * y).sum(axis=1)]


def integer_vectors(df: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows that take part; x as array of bigint."""
    c = F.col(column)

    def fits(v: Column) -> Column:
        v = v.cast("double")
        return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))

    usable = df.select("vec_id", c).where(c.isNotNull() & F.forall(c, fits))
    lengths = usable.groupBy(F.size(c).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    usable = usable.where(F.size(c) == (lengths[0]["d"] if lengths else 0))
    return usable.select("vec_id", F.transform(c, lambda v: F.floor(v.cast("double") * SCALE)).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _fold(df: DataFrame, first: Callable[[np.ndarray], object], merge: Callable, pack: Callable, unpack: Callable):
    """Fold the vectors of all tasks in three steps; one packed result reaches the driver, or none."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            if batch.num_rows:
                own = first(_matrix(batch.column("x")))
                state = own if state is None else merge(state, own)
        if state is not None:
            yield pa.RecordBatch.from_pydict({"state": [pack(state)]}, pa.schema([("state", pa.binary())]))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            for value in batch.column("state").to_pylist():
                own = unpack(value)
                state = own if state is None else merge(state, own)
        if state is not None:
            yield pa.RecordBatch.from_pydict({"state": [pack(state)]}, pa.schema([("state", pa.binary())]))

    parts = df.select("x").mapInArrow(each, "state binary")
    parts = parts.repartition(_FAN).mapInArrow(again, "state binary")
    found = parts.repartition(1).mapInArrow(again, "state binary").collect()
    return unpack(bytes(found[0]["state"])) if found else None


def _sums(df: DataFrame) -> tuple[int, np.ndarray] | None:
    """Number of vectors and exact sum of each dimension."""
    return _fold(
        df,
        lambda x: (len(x), x.astype(object).sum(axis=0) if np.abs(x).max(initial=0) > 2**31 else x.sum(axis=0).astype(object)),
        lambda a, b: (a[0] + b[0], a[1] + b[1]),
        lambda s: ",".join(map(str, (s[0], *s[1]))).encode(),
        lambda b: (int(b.split(b",")[0]), np.array([int(v) for v in b.split(b",")[1:]], dtype=object)),
    )


def _triangle(df: DataFrame, fit: Fit) -> np.ndarray:
    """Triangular factor of all centred rows."""
    d = len(fit.sums)

    def upper(rows: np.ndarray) -> np.ndarray:
        r = np.linalg.qr(rows, mode="r")
        return np.vstack([r, np.zeros((d - len(r), d))]) if len(r) < d else r

    return _fold(
        df,
        lambda x: upper(fit.centred(x)),
        lambda a, b: upper(np.vstack([a, b])),
        lambda r: r.tobytes(),
        lambda b: np.frombuffer(b).reshape(d, d),
    )


def _covariance(df: DataFrame, fit: Fit) -> np.ndarray:
    """Covariance of the whitened coordinates, centred before multiplying."""
    k = int(fit.defined.sum())

    def first(x: np.ndarray) -> tuple:
        w = fit.whitened(x)
        mean = w.mean(axis=0)
        return len(w), mean, (w - mean).T @ (w - mean)

    def merge(a: tuple, b: tuple) -> tuple:
        n, gap = a[0] + b[0], b[1] - a[1]
        return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)

    n, _, squares = _fold(
        df, first, merge,
        lambda s: np.concatenate(([s[0]], s[1], s[2].ravel())).tobytes(),
        lambda b: (lambda v: (v[0], v[1 : k + 1], v[k + 1 :].reshape(k, k)))(np.frombuffer(b)),
    )
    return squares / n


def fit_whitening(x: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Fit on the distinct vectors of column ``x``; none if there are no rows."""
    distinct = store(x.select("x").distinct(), "vectors")
    found = _sums(distinct)
    if found is None:
        return None
    n, sums = found
    fit = Fit(n, sums, np.zeros(len(sums)), np.zeros((0, len(sums))))
    if not len(sums):
        return fit
    values, vectors = right_vectors(_triangle(distinct, fit), components)
    fit = Fit(n, sums, values / n, vectors)
    if fit.defined.any():
        fit.identity_error = float(np.abs(_covariance(distinct, fit) - np.eye(int(fit.defined.sum()))).max())
    return fit


def whiten(df: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error) of ``df``
    (``vec_id``, ``embedding``); see the module for odd rows."""
    x = integer_vectors(df)
    fit = fit_whitening(x, components)
    if fit is None:
        nothing = f"{_OUT}, identity_error double"
        return df.sparkSession.createDataFrame([], nothing)
    k, own = len(fit.vectors), fit.defined
    total = float(fit.eigenvalues.sum())
    shares = [float(e) / total if total > 0 else None for e in fit.eigenvalues[:k]]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            rows = _matrix(batch.column("x"))
            white = np.full((len(rows), k), np.nan)
            white[:, own] = fit.whitened(rows)
            ids = batch.column("vec_id")
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(np.repeat(np.arange(len(rows)), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(len(rows) * k, fit.n, dtype=np.int64)),
                    pa.array([v for v in fit.deviation(rows) for _ in range(k)], pa.int64()),
                    pa.array(white.ravel(), mask=np.isnan(white.ravel())),
                    pa.array(shares * len(rows), pa.float64()),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained"],
            )

    out = x.mapInArrow(project, _OUT)
    return out.withColumn("identity_error", F.lit(fit.identity_error).cast("double"))
