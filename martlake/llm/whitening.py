"""Embedding whitening by incremental eigendecomposition.

Vectors become integers, x = floor(64 c) + 1000000, and the fit list holds
each distinct x once. Its size and sums are exact integers; all further steps
work on x less the mean, which is taken off before anything is multiplied.

1. Each task keeps a spectrum (eigenvalues and vectors) and applies its rows
   as centred rank-one updates: the eigenvalues of D + zz' are the roots of
   the secular equation between the old ones; entries of z that do nothing and
   values that coincide are deflated, by a rotation, before. Vectors come from
   the z that has these roots exactly, so they stay orthogonal. Of every
   ``ROWS`` rows the triangular factor is applied, which has the same cross
   products in as many rows as a vector has entries: so the updates, cubic in
   these, are few however many rows there are.
2. Spectra are combined in a tree, ``FAN_IN`` at a time: each pair of value
   and vector of one is a rank-one update of the other.
3. The vectors that come out span a basis that is right but for rounding. One
   more pass sums the cross products of the rows in that basis (a matrix of
   the vectors' size, by tasks, then by Spark); its eigenvectors turn the basis
   to the components, to double precision (Rayleigh-Ritz).
4. A last pass over the fit list measures how far the whitened vectors'
   covariance is from the identity.

Defined results: rows whose vector is null, empty, holds null or non-finite
entries, or entries of 2^39 or more in magnitude (x must stay an exact double)
are left out, so are rows of another length than the most frequent one (of
equally frequent ones the longest); a null id is kept; rows that repeat count
once in the fit and each have their rows; a component without variance has no
direction of its own and no whitened value (null) but its share, 0; with one
distinct vector that is so for all; an empty table gives no rows; further
columns are not read. A task holds a few square matrices of the vectors' size.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import ship, written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Rows whose triangular factor is applied, and spectra combined at once.
ROWS = 8192
FAN_IN = 8
LARGEST = float(1 << 39)
_EPS = np.finfo(float).eps

SCHEMA = ("id long, component int, n long, deviation decimal(38,0), whitened double, explained double,"
          " identity_error double")


# --- rank-one updates ---------------------------------------------------------

def deflate(values: np.ndarray, z: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Which entries of ``z`` remain. Those that change nothing within rounding
    go; of two equal ``values`` (ascending) one entry is rotated into the
    other, with the columns of ``vectors``. All three are changed in place."""
    size = float(np.sqrt(z @ z))
    least = 8 * _EPS * max(float(np.abs(values).max(initial=0.0)), size * size)
    stays = np.abs(z) * size > least
    last = -1
    for i in np.flatnonzero(stays).tolist():
        if last >= 0:
            r = float(np.hypot(z[last], z[i]))
            c, s = z[i] / r, z[last] / r
            gap = values[i] - values[last]
            if abs(gap * c * s) <= least:
                z[last], z[i] = 0.0, r
                values[last], values[i] = values[last] + gap * s * s, values[i] - gap * s * s
                vectors[:, [last, i]] = vectors[:, [last, i]] @ np.array([[c, s], [-s, c]])
                stays[last] = False
        last = i
    return stays


def secular_roots(values: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 + sum z_i^2 / (values_i - x), one behind each of the
    ascending ``values``, and the matrix of values_i - root_j. Each root is
    found as a distance from the nearer one of its two neighbours, so that
    small differences are exact."""
    k = len(values)
    square = z * z
    ends = np.append(values[1:], values[-1] + square.sum())
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        middle = 1 + (square[:, None] / (values[:, None] - (values + (ends - values) / 2))).sum(axis=0)
        own = np.arange(k)
        nearer = np.where((middle >= 0) | (own == k - 1), own, np.minimum(own + 1, k - 1))
        shifted = values[:, None] - values[nearer]
        low, high = values - values[nearer], ends - values[nearer]
        half = (high - low) / 2
        # The half of the interval that holds the root.
        low, high = np.where(middle >= 0, low, low + half), np.where(middle >= 0, low + half, high)
        at = (low + high) / 2
        left = own[:, None] <= own
        inner = own < k - 1
        nearest = shifted[own, own], shifted[np.minimum(own + 1, k - 1), own]
        for _ in range(100):
            apart = shifted - at
            terms = square[:, None] / apart
            slopes = terms / apart
            value = 1 + terms.sum(axis=0)
            done = (np.abs(value) <= 4 * _EPS * (1 + np.abs(terms).sum(axis=0))) | (high - low <= 2 * _EPS * np.abs(at))
            if done.all():
                break
            low, high = np.where(value < 0, at, low), np.where(value < 0, high, at)
            # Poles at both neighbours, fitted to the sums left and right of the root.
            below = np.where(left, slopes, 0).sum(axis=0)
            above = np.where(left, 0, slopes).sum(axis=0)
            p, q = nearest[0] - at, nearest[1] - at
            c = value - p * below - q * above
            a = (p + q) * value - p * q * (below + above)
            root = np.sqrt(np.maximum(a * a - 4 * p * q * value * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * p * q * value / (a + root))
            level = value - p * below  # the last root has a pole on its left alone
            step = np.where(inner, step, p + p * p * below / level)
            new = at + step
            at = np.where(done, at, np.where((new > low) & (new < high), new, (low + high) / 2))
    return values[nearer] + at, shifted - at


class Spectrum:
    """Eigenvalues (ascending) and vectors of a sum of rank-one matrices."""

    def __init__(self, size: int):
        self.values, self.vectors = np.zeros(size), np.eye(size)

    def update(self, row: np.ndarray) -> None:
        """Adds the outer product of ``row`` with itself."""
        values, vectors = self.values.copy(), self.vectors
        z = vectors.T @ row
        if not z.any():
            return
        kept = np.flatnonzero(deflate(values, z, vectors))
        if len(kept):
            old, z = values[kept], z[kept]
            roots, apart = secular_roots(old, z)
            # The z whose roots these are, to the last digit.
            gaps = old - old[:, None]
            np.fill_diagonal(gaps, 1.0)
            z = np.copysign(np.sqrt(np.prod(-apart / gaps, axis=1)), z)
            turn = z[:, None] / apart
            vectors[:, kept] = vectors[:, kept] @ (turn / np.sqrt((turn * turn).sum(axis=0)))
            values[kept] = roots
        order = np.argsort(values, kind="stable")
        self.values, self.vectors = values[order], vectors[:, order]

    def add_rows(self, rows: np.ndarray) -> None:
        """Applies centred rows, or the triangular factor of many."""
        for row in np.linalg.qr(rows, mode="r") if len(rows) > rows.shape[1] else rows:
            self.update(row)

    def combine(self, values: np.ndarray, vectors: np.ndarray) -> None:
        """Adds another spectrum, value by value."""
        for value, vector in zip(values, vectors.T):
            if value > 0:
                self.update(np.sqrt(value) * vector)


# --- passes over the vectors --------------------------------------------------

class Centre:
    """Takes the mean S / n off integers, split so that both parts are exact."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = [s % n for s in sums]
        self.part = np.array([r / n for r in self.rest])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.part

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sums of (n x - S)^2, exact."""
        apart, rest = x - self.whole, np.array(self.rest, object)
        most = self.n * (float(np.abs(apart).max(initial=0)) + 1)
        if most * most * x.shape[1] < 2.0 ** 62:
            y = self.n * apart - rest.astype(np.int64)
            return pa.array((y * y).sum(axis=1)).cast(pa.decimal128(38, 0))
        y = self.n * apart.astype(object) - rest
        return pa.array([Decimal(int(v)) for v in (y * y).sum(axis=1)], pa.decimal128(38, 0))


def _matrix(batch, size: int) -> np.ndarray:
    lists = batch.column("x")
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _sum_batches(size: int):
    def run(batches):
        n, sums = 0, [0] * size
        for b in batches:
            n += b.num_rows
            sums = [s + int(v) for s, v in zip(sums, _matrix(b, size).sum(axis=0))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, size), pa.int32()), pa.array(map(Decimal, [n, *sums]), pa.decimal128(38, 0))], ["i", "v"])
    return run


def _spectrum_batch(part: int, s: Spectrum):
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int64()), pa.array([s.values.tolist()], pa.list_(pa.float64())),
         pa.array([s.vectors.ravel().tolist()], pa.list_(pa.float64()))], ["part", "eigenvalues", "vectors"])


def _spectrum_batches(size: int, centre: Centre):
    def run(batches):
        spectrum, held, n = Spectrum(size), [], 0
        for b in batches:
            held.append(centre.centred(_matrix(b, size)))
            n += b.num_rows
            if n >= ROWS:
                spectrum.add_rows(np.concatenate(held))
                held, n = [], 0
        if n:
            spectrum.add_rows(np.concatenate(held))
        if spectrum.values[-1] > 0:
            yield _spectrum_batch(TaskContext.get().partitionId(), spectrum)
    return run


def _combined(size: int):
    def run(table):
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        spectrum = Spectrum(size)
        spectrum.values = np.array(rows[0]["eigenvalues"])
        spectrum.vectors = np.array(rows[0]["vectors"]).reshape(size, size)
        for r in rows[1:]:
            spectrum.combine(np.array(r["eigenvalues"]), np.array(r["vectors"]).reshape(size, size))
        return pa.Table.from_batches([_spectrum_batch(rows[0]["part"] // FAN_IN, spectrum)])
    return run


def _basis(fit: DataFrame, size: int, centre: Centre) -> np.ndarray:
    """An orthonormal basis of the spectrum of all rows, smallest value first."""
    schema = "part long, eigenvalues array<double>, vectors array<double>"
    spectra = written(fit.mapInArrow(_spectrum_batches(size, centre), schema), "whitening-spectra", wide=True)
    last = spectra.agg(F.max("part")).first()[0]
    if last is None:
        return np.eye(size)
    while last:
        spectra = spectra.groupBy(F.floor(F.col("part") / FAN_IN)).applyInArrow(_combined(size), schema)
        last //= FAN_IN
    return np.linalg.qr(np.array(spectra.first()["vectors"]).reshape(size, size))[0]


def _product_batches(size: int, centre: Centre, basis: np.ndarray):
    def run(batches):
        total = np.zeros((basis.shape[1], basis.shape[1]))
        for b in batches:
            y = centre.centred(_matrix(b, size)) @ basis
            total += y.T @ y
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(total)), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "row"])
    return run


def _covariance(fit: DataFrame, size: int, centre: Centre, basis: np.ndarray) -> np.ndarray:
    """The covariance of the fit list in the directions of ``basis``."""
    sums = (fit.mapInArrow(_product_batches(size, centre, basis), "i int, row array<double>")
            .select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect())
    out = np.zeros((basis.shape[1], basis.shape[1]))
    for r in sums:
        out[r["i"], r["j"]] = r["v"] / centre.n
    return (out + out.T) / 2


def components(fit: DataFrame, size: int, centre: Centre) -> tuple[np.ndarray, np.ndarray]:
    """All eigenvalues of the fit list's covariance, falling, and their unit
    vectors as columns; each vector's largest entry is positive."""
    basis = _basis(fit, size, centre)
    values, turn = np.linalg.eigh(_covariance(fit, size, centre, basis))
    vectors = (basis @ turn)[:, ::-1]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(size)])
    return np.maximum(values[::-1], 0.0), vectors * signs


def _whitened_batches(size: int, centre: Centre, directions: np.ndarray, explained: np.ndarray, error: float | None):
    k, some = len(explained), directions.shape[1]

    def run(batches):
        for b in batches:
            x = _matrix(b, size)
            y = np.full((len(x), k), np.nan)
            y[:, :some] = centre.centred(x) @ directions
            each = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(each), centre.n)), centre.deviations(x).take(each),
                 pa.array(y.ravel(), from_pandas=True), pa.array(np.tile(explained, len(x))),
                 pa.array([error] * len(each), pa.float64())],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           n_components: int = COMPONENTS) -> DataFrame:
    """A row for each usable row and each of the first ``n_components``
    components: ``id``, ``component`` (from 1, by falling eigenvalue), ``n``
    (the fit list's size), ``deviation`` (sum of (n x - S)^2), ``whitened``,
    ``explained`` (the component's share of the variance) and
    ``identity_error`` (the largest entry of the whitened covariance less the
    identity, over components with variance)."""
    spark = embeddings.sparkSession
    ship(spark)
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    good = vector.isNotNull() & F.forall(vector, lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False)))
    x = F.transform(vector, lambda c: F.floor(c * SCALE).cast("long") + SHIFT)
    usable = embeddings.filter(good).select(F.col(f"`{id_col}`").cast("long").alias("id"), x.alias("x"))
    sizes = usable.filter(F.size("x") > 0).groupBy(F.size("x").alias("size")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    if most is None:
        return spark.createDataFrame([], SCHEMA)
    size = most["size"]
    usable = usable.filter(F.size("x") == size)
    fit = written(usable.select("x").distinct(), "whitening-fit", wide=True)
    sums = {r["i"]: int(r["v"]) for r in fit.mapInArrow(_sum_batches(size), "i int, v decimal(38,0)")
            .groupBy("i").agg(F.sum("v").alias("v")).collect()}
    centre = Centre(sums[-1], [sums[i] for i in range(size)])
    values, vectors = components(fit, size, centre)
    k = min(n_components, size)
    some = int((values[:k] > size * _EPS * values[0]).sum())
    directions = vectors[:, :some] / np.sqrt(values[:some])
    total = values.sum()
    explained = values[:k] / total if total else np.zeros(k)
    error = (float(np.abs(_covariance(fit, size, centre, directions) - np.eye(some)).max()) if some else None)
    return usable.mapInArrow(_whitened_batches(size, centre, directions, explained, error), SCHEMA)
