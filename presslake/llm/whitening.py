"""Whitening of vectors: an eigendecomposition kept up to date row by row, never a covariance matrix to decompose.

Each task holds the spectrum of the rows it has read: their number, mean, and the eigenvalues and eigenvectors of
their scatter. New rows come in as centred rank-one updates, whose eigenvalues are the roots of a secular
equation. Spectra are combined in a tree, again by rank-one updates. At the end all rows are projected on
the basis found and a Rayleigh-Ritz step over them takes it to double precision.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslake.llm.common import fresh, staged

#: Rows that are folded into one triangular factor, whose rows are then the updates.
BLOCK = 4096
#: Spectra that one task combines.
ARITY = 8
#: Bisections of a root's interval, and the least distance of a root from its pole as a share of it.
HALVINGS = 72
SMALLEST = 2.0**-200
EPS = np.finfo(float).eps
#: Largest absolute value of an entry.
LARGEST = 2.0**52


@dataclass
class Spectrum:
    """Rows seen, their mean, and eigenvalues (rising) and eigenvectors (columns) of their scatter."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def empty(size: int) -> Spectrum:
        return Spectrum(0, np.zeros(size), np.zeros(size), np.eye(size))

    def add_rows(self, rows: np.ndarray) -> None:
        """Centred updates with `rows`: their triangular factor has the same scatter and at most as many rows as columns."""
        mean = rows.mean(axis=0)
        for row in np.linalg.qr(rows - mean, mode="r"):
            self._update(row)
        self._move(len(rows), mean)

    def add(self, other: Spectrum) -> None:
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self._update(np.sqrt(value) * vector)
        self._move(other.n, other.mean)

    def _move(self, n: int, mean: np.ndarray) -> None:
        """`n` rows around `mean` have come: the distance of the means is one more update."""
        if n:
            away = mean - self.mean
            if self.n:
                self._update(away * np.sqrt(self.n * n / (self.n + n)))
            self.n += n
            self.mean = self.mean + away * (n / self.n)

    def _update(self, row: np.ndarray) -> None:
        self.values, self.vectors = rank_one(self.values, self.vectors, row)


def rank_one(values: np.ndarray, vectors: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and -vectors of `vectors diag(values) vectors' + row row'`; `values` rise, and do again after."""
    z = vectors.T @ row
    if not np.any(z):
        return values, vectors
    values, vectors = values.copy(), vectors.copy()
    limit = 8 * EPS * max(abs(values[-1]), abs(values[0]), z @ z)
    active = _deflate(values, vectors, z, limit)
    if len(active):
        poles, weights = values[active], z[active]
        nearest, shift = secular_roots(poles, weights)
        # Distances of poles to roots, exact to the last digits as both are taken from the nearest pole.
        away = (poles[None, :] - poles[nearest][:, None]) - shift[:, None]
        weights = _matching_weights(poles, away, weights)
        mix = weights[None, :] / away
        mix /= np.linalg.norm(mix, axis=1, keepdims=True)
        values[active] = poles[nearest] + shift
        vectors[:, active] = vectors[:, active] @ mix.T
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


def _deflate(values: np.ndarray, vectors: np.ndarray, z: np.ndarray, limit: float) -> np.ndarray:
    """Indices that take part in the update; the others' eigenpairs stay as they are.

    A pair stays if the row hardly has its direction. Of two with nearly equal values one stays,
    after a rotation that leaves the row only the other's direction.
    """
    length = np.sqrt(z @ z)
    active: list[int] = []
    for j in range(len(values)):
        if abs(z[j]) * length <= limit:
            continue
        if active:
            i = active[-1]
            r = np.hypot(z[i], z[j])
            c, s = z[j] / r, z[i] / r
            if abs((values[j] - values[i]) * c * s) <= limit:
                a, b = vectors[:, i].copy(), vectors[:, j].copy()
                vectors[:, i], vectors[:, j] = c * a - s * b, s * a + c * b
                x, y = values[i], values[j]
                values[i], values[j] = c * c * x + s * s * y, s * s * x + c * c * y
                z[i], z[j] = 0.0, r
                active.pop()
        active.append(j)
    return np.array(active, dtype=int)


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 + sum(weights ** 2 / (poles - x)): for each, the index of its nearest pole and the distance from it.

    One root lies above each pole, below the next one; the last at most the sum of squares above its pole.
    """
    k = len(poles)
    squares = weights * weights
    gaps = np.append(np.diff(poles), squares.sum())
    own = np.arange(k)
    half = gaps / 2

    def f(nearest: np.ndarray, shift: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return 1 + (squares[None, :] / ((poles[None, :] - poles[nearest][:, None]) - shift[:, None])).sum(axis=1)

    upper = f(own, half) < 0
    upper[-1] = False
    nearest = np.where(upper, own + 1, own)
    sign = np.where(upper, -1.0, 1.0)
    high = np.append(half[:-1], gaps[-1])
    low = high * SMALLEST
    # A root may lie very close to its pole: its magnitude is halved first, then its interval.
    for step in range(HALVINGS):
        mid = np.sqrt(low) * np.sqrt(high) if step < HALVINGS // 2 else (low + high) / 2
        outside = (f(nearest, sign * mid) < 0) == (sign > 0)
        low, high = np.where(outside, mid, low), np.where(outside, high, mid)
    return nearest, sign * (low + high) / 2


def _matching_weights(poles: np.ndarray, away: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The weights for which the roots found are exact: with them the eigenvectors are orthogonal."""
    k = len(poles)
    gap = poles[:, None] - poles[None, :]
    below = np.tril(np.ones((k, k), dtype=bool), -1).T  # root i before pole j
    following = np.vstack([gap[1:], np.full((1, k), -1.0)])
    over = np.where(below, gap, following)
    over[-1] = 1.0
    return np.sign(weights) * np.sqrt(np.abs(np.prod(-away / over, axis=0)))


@dataclass
class Whitening:
    """Rows and sums of the fit, components (columns, by falling eigenvalue), all their shares, and the remaining error."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows; a component without variance has no value."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return centred(x, self.n, self.sums) @ self.components / np.sqrt(np.where(self.values > 0, self.values, np.nan))


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (n * x - np.array(sums)) / n


def integers(column: str) -> Column:
    """floor(1024 * c) + 100000 of each entry, entries beyond 2 ** 52 taken as that."""
    scaled = lambda c: c.cast("double") * 1024
    bounded = lambda c: F.greatest(F.least(scaled(c), F.lit(LARGEST)), F.lit(-LARGEST))
    return F.transform(F.col(f"`{column}`"), lambda c: F.floor(bounded(c)) + F.lit(100_000).cast("long"))


def usable(df: DataFrame, column: str, as_name: str) -> DataFrame:
    """Rows with a vector of finite entries, as integers in `as_name`. Of several lengths the most frequent one counts
    (of equally frequent ones the longest), rows of other lengths are left out as well."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    vector = F.col(f"`{column}`")
    rows = df.filter(vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite))
    lengths = rows.groupBy(F.size(vector).alias("length")).count()
    top = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    return rows.filter(F.size(vector) == (top["length"] if top else 0)).withColumn(as_name, integers(column))


def matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _tree(parts: DataFrame, combine: Callable[[list], pd.DataFrame], name: str) -> pd.DataFrame:
    """All rows of `parts` combined, `ARITY` neighbours by `part` in a task, level by level."""

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        out = combine(group)
        out["part"] = group["part"].iloc[0] // ARITY
        return out[group.columns]

    parts = staged(parts, name)
    while parts.limit(2).count() > 1:
        parts = staged(parts.groupBy(F.floor(F.col("part") / ARITY)).applyInPandas(merge, parts.schema), name)
    return parts.toPandas()  # one row


SPECTRUM = "part long, n long, sums array<long>, mean array<double>, values array<double>, vectors array<double>"
MOMENTS = "part long, moments array<double>"
_DOUBLES = pa.list_(pa.float64())
SPECTRUM_CELLS = pa.schema(
    {"part": pa.int64(), "n": pa.int64(), "sums": pa.list_(pa.int64()), "mean": _DOUBLES, "values": _DOUBLES, "vectors": _DOUBLES}
)
MOMENTS_CELLS = pa.schema({"part": pa.int64(), "moments": _DOUBLES})


def fit_spectrum(vectors: DataFrame, column: str) -> tuple[Spectrum, list[int]] | None:
    """The spectrum of all vectors, and their sums; None if there are none."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spectrum, sums, held = None, None, []

        def flush() -> None:
            nonlocal spectrum, sums, held
            x = np.concatenate(held)
            if spectrum is None:
                spectrum, sums = Spectrum.empty(x.shape[1]), np.zeros(x.shape[1], dtype=np.int64)
            sums += x.sum(axis=0)
            spectrum.add_rows(x.astype(float))
            held = []

        for batch in batches:
            if batch.num_rows:
                held.append(matrix(batch, column))
                if sum(map(len, held)) >= BLOCK:
                    flush()
        if held:
            flush()
        if spectrum is not None:
            row = _spectrum_row(spectrum, sums.tolist(), TaskContext.get().partitionId())
            yield from pa.Table.from_pylist([row], schema=SPECTRUM_CELLS).to_batches()

    def combine(group: pd.DataFrame) -> pd.DataFrame:
        parts = list(group.to_dict("records"))
        total = _spectrum_of(parts[0])
        for part in parts[1:]:
            total.add(_spectrum_of(part))
        sums = np.sum([np.asarray(p["sums"]) for p in parts], axis=0)
        return pd.DataFrame([_spectrum_row(total, sums.tolist(), 0)])

    found = _tree(vectors.select(column).mapInArrow(read, SPECTRUM), combine, "spectra")
    if not len(found):
        return None
    row = found.to_dict("records")[0]
    return _spectrum_of(row), [int(s) for s in row["sums"]]


def _spectrum_row(s: Spectrum, sums: list[int], part: int) -> dict:
    return {"part": part, "n": s.n, "sums": sums, "mean": s.mean.tolist(), "values": s.values.tolist(), "vectors": s.vectors.ravel().tolist()}


def _spectrum_of(row: dict) -> Spectrum:
    values = np.asarray(row["values"], dtype=float)
    vectors = np.asarray(row["vectors"], dtype=float).reshape(len(values), len(values))
    return Spectrum(int(row["n"]), np.asarray(row["mean"], dtype=float), values, vectors)


def _moments(vectors: DataFrame, column: str, project: Callable[[np.ndarray], np.ndarray], name: str) -> np.ndarray:
    """Sum over all rows of the outer product of what `project` makes of them."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                y = project(matrix(batch, column))
                total = y.T @ y + (0 if total is None else total)
        if total is not None:
            row = {"part": TaskContext.get().partitionId(), "moments": total.ravel().tolist()}
            yield from pa.Table.from_pylist([row], schema=MOMENTS_CELLS).to_batches()

    def combine(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"part": 0, "moments": np.sum([np.asarray(m) for m in group["moments"]], axis=0).tolist()}])

    found = np.asarray(_tree(vectors.select(column).mapInArrow(read, MOMENTS), combine, name)["moments"].iloc[0])
    size = round(len(found) ** 0.5)
    return found.reshape(size, size)


def fit(vectors: DataFrame, column: str, components: int) -> Whitening | None:
    """The whitening of integer vectors of one length; None if there are none.

    What comes to the driver is one spectrum and two small matrices, whatever the number of rows.
    """
    found = fit_spectrum(vectors, column)
    if found is None:
        return None
    spectrum, sums = found
    n, basis = spectrum.n, spectrum.vectors
    # Rayleigh-Ritz: the covariance of all rows within the basis is almost diagonal; what is left is rotated away.
    inner = _moments(vectors, column, lambda x: centred(x, n, sums) @ basis, "ritz") / n
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    total = float(np.trace(inner))
    kept = values[order]
    kept = np.where(kept > len(values) * EPS * max(total, 0.0), kept, 0.0)
    shares = kept / total if total > 0 else np.zeros(len(kept))
    out = Whitening(n, sums, basis @ turn[:, order], kept, shares, 0.0)
    real = kept > 0
    if real.any():
        seen = _moments(vectors, column, lambda x: out.project(x)[:, real], "identity") / n
        out.identity_error = float(np.abs(seen - np.eye(int(real.sum()))).max())
    return out


def exact_deviation(x: np.ndarray, n: int, sums: list[int]) -> Iterable[int | None]:
    """Sum of (n * x - sum) ** 2 of each row, exact; None where it does not fit a long."""
    distance = n * x - np.array(sums)
    rough = (distance.astype(float) ** 2).sum(axis=1)
    exact = (distance * distance).sum(axis=1)
    for i, size in enumerate(rough):
        if size < 4e18:
            yield int(exact[i])
        else:
            whole = sum(int(v) ** 2 for v in distance[i])
            yield whole if whole < 1 << 63 else None


def whiten(df: DataFrame, column: str = "embedding", components: int = 8) -> tuple[DataFrame, Whitening | None]:
    """Rows of `df` with a usable vector, with `deviation` and `whitened` (array<double>), and the fit over all of them.

    Left out are null and empty vectors, vectors with a null or a non-finite entry, and those that have not the most
    frequent length. Repeated rows count as often as they occur. Without rows, or for an empty table, there is no
    fit and no row. Vectors shorter than `components` have as many components as entries; a component without
    variance (all vectors equal, fewer vectors than components) has a null value and a share of 0. Vectors of any
    length are held one block at a time. All columns of `df` are kept; new ones are named around clashes.
    """
    x, deviation, whitened = fresh(df, "x", "deviation", "whitened")
    vectors = usable(df, column, x)
    found = fit(vectors, x, components)
    schema = T.StructType(
        [*df.schema.fields, T.StructField(deviation, T.LongType()), T.StructField(whitened, T.ArrayType(T.DoubleType()))]
    )
    if found is None:
        return df.sparkSession.createDataFrame([], schema), None

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = matrix(batch, x)
            cells = found.project(rows)
            lists = pa.ListArray.from_arrays(
                np.arange(0, cells.size + 1, cells.shape[1], dtype=np.int32), pa.array(cells.ravel(), from_pandas=True)
            )
            far = pa.array(exact_deviation(rows, found.n, found.sums), type=pa.int64())
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, far, lists], names=[f.name for f in schema.fields])

    return vectors.mapInArrow(write, schema), found
