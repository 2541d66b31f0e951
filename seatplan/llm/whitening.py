"""Whitening of embeddings by an incremental eigendecomposition.

Entries become whole numbers on a grid (``floor(grid * c) + shift``); the fit list is every distinct grid vector once.
Each partition of the fit list keeps a mean and a spectrum of its scatter matrix and takes its vectors one by one: a
centred rank-one update, whose new eigenvalues are the roots of the secular equation and whose new vectors come from
re-computed weights, so they stay orthogonal. Weights near zero and eigenvalues that lie together are deflated before.
Spectra of partitions are combined in a tree, one spectrum's pairs being rank-one updates of the other, and the
difference of the means one more. The combined basis is orthonormal; a last distributed pass takes the covariance in
that basis (Rayleigh-Ritz), so the final vectors have the precision of that pass, whatever rounding came before.

A spectrum is d x d numbers for vectors of d entries; that, and nothing that grows with the rows, is what tasks and
the driver hold. Counts and sums are exact.

Vectors that are null or hold a null, a NaN or an infinity are left out, and so are vectors of another length than the
one that most distinct vectors have (of two such lengths, the longer). Grid values are cut to +-2**53. Null keys and
repeated rows stay rows; repeats count once in the fit. Directions without variance (an eigenvalue below d * 2**-52 of
the largest) have no component: one distinct vector, or none, gives no rows. A deviation beyond 64 bits is null. Equal
eigenvalues may come in either order. Of the input only ``key`` and ``column`` are read, so other columns never clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatplan.llm import common

EPS = 2.0**-52
WHOLE = 2.0**53
SPECTRUM = "part long, n long, mean array<double>, values array<double>, vectors array<double>"


@dataclass(frozen=True)
class Settings:
    grid: int = 64
    shift: int = 1_000_000
    components: int = 16
    #: Spectra that one task combines.
    fan_in: int = 8


@dataclass
class Whitener:
    """``n`` vectors of the fit list, their exact sums, and the components as columns."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def dim(self) -> int:
        return len(self.sums)


def _secular(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho * sum(z2 / (d - x)), one above each d: the index of the pole each is measured from, and the distance.

    Fixed-weight rational steps, kept inside a bracket that every evaluation narrows.
    """
    k = len(d)
    if k == 1:
        return np.zeros(1, dtype=np.int64), rho * z2
    right = np.append(d[1:], d[-1] + rho * z2.sum())
    z2_right = np.append(z2[1:], 0.0)
    gap = right - d
    at = np.arange(k)
    rest = 1 / rho
    # which half holds the root decides the pole to measure from; the last root has no pole to its right
    middle = gap / 2
    terms = z2[:, None] / ((d[:, None] - d[None, :]) - middle[None, :])
    f = rest + terms.sum(0)
    left = (f >= 0) | (at == k - 1)
    pole = np.where(left, at, at + 1)
    origin = np.where(left, d, right)
    near, far = d - origin, right - origin
    delta = d[:, None] - origin[None, :]
    lo = np.where(left, np.where(f >= 0, 0.0, middle), -middle)
    hi = np.where(left, np.where(f >= 0, middle, gap), 0.0)
    # first guess: both poles exactly, the rest as it is in the middle
    c = f + z2 / middle - z2_right / middle
    a = c * gap + z2 + z2_right
    b = z2 * gap
    off = np.where(left, 0.0, gap)
    with np.errstate(all="ignore"):
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        x = np.where(a > 0, 2 * b / (a + root), (a - root) / (2 * c)) - off
    x = np.where((x > lo) & (x < hi), x, (lo + hi) / 2)
    for _ in range(60):
        gaps = delta - x[None, :]
        terms = z2[:, None] / gaps
        f = rest + terms.sum(0)
        slope = (terms / gaps).sum(0)
        below = f < 0
        lo, hi = np.where(below, x, lo), np.where(below, hi, x)
        done = (np.abs(f) <= 4 * EPS * k * (rest + np.abs(terms).sum(0))) | (hi - lo <= 2 * EPS * np.maximum(np.abs(lo), np.abs(hi)))
        if done.all():
            break
        p, q = near - x, far - x
        with np.errstate(all="ignore"):
            c = np.where(left, f - q * slope + gap * z2 / (p * p), f - p * slope - gap * z2_right / (q * q))
            a = (p + q) * f - p * q * slope
            b = p * q * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a > 0, 2 * b / (a + root), (a - root) / (2 * c))
        after = x + step
        inside = (after > lo) & (after < hi)
        x = np.where(done, x, np.where(inside, after, (lo + hi) / 2))
    return pole, x


def update(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Ascending spectrum of ``vectors @ diag(values) @ vectors.T + rho * v v.T`` for a positive ``rho``."""
    z = v @ vectors
    norm = math.sqrt(float(z @ z))
    if norm == 0 or rho <= 0:
        return values, vectors
    z, rho = z / norm, rho * norm * norm
    tolerance = 8 * EPS * max(abs(values[0]), abs(values[-1]), rho)
    keep = rho * np.abs(z) > tolerance
    close = np.diff(values) <= tolerance
    if close.any():
        # eigenvalues that lie together: turn their space so that one vector of it takes all the weight
        vectors = vectors.copy()
        edges = np.flatnonzero(np.diff(np.concatenate([[False], close, [False]]).astype(np.int8)))
        for first, last in zip(edges[::2], edges[1::2] + 1, strict=True):
            w = z[first:last].copy()
            length = math.sqrt(float(w @ w))
            if length > 0:
                w[-1] += math.copysign(length, w[-1])
                w /= math.sqrt(float(w @ w))
                block = vectors[:, first:last]
                vectors[:, first:last] = block - 2 * np.outer(block @ w, w)
                z[first : last - 1] = 0
                z[last - 1] = -math.copysign(length, w[-1])
            keep[first:last] = rho * np.abs(z[first:last]) > tolerance
    if not keep.any():
        return values, vectors
    d, weight = values[keep], z[keep]
    pole, x = _secular(d, weight * weight, rho)
    gaps = (d[:, None] - np.append(d, d[-1])[pole][None, :]) - x[None, :]
    # weights that have these roots exactly, which makes the vectors orthogonal
    apart = d[:, None] - d[None, :]
    np.fill_diagonal(apart, 1.0)
    weight = np.copysign(np.sqrt(np.abs(np.prod(gaps / apart, axis=1))), weight)
    turn = weight[:, None] / gaps
    turn /= np.sqrt((turn * turn).sum(0))
    new = np.append(d, d[-1])[pole] + x
    if keep.all():
        return new, vectors @ turn
    all_values, all_vectors = values.copy(), vectors.copy()
    all_values[keep] = new
    all_vectors[:, keep] = vectors[:, keep] @ turn
    order = np.argsort(all_values, kind="stable")
    return all_values[order], all_vectors[:, order]


@dataclass
class Spectrum:
    """Count, mean and scatter of some vectors, the scatter by its ascending eigenvalues and its vectors."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def empty(dim: int) -> Spectrum:
        return Spectrum(0, np.zeros(dim), np.zeros(dim), np.eye(dim))

    def add(self, x: np.ndarray) -> None:
        away = x - self.mean
        self.values, self.vectors = update(self.values, self.vectors, away, self.n / (self.n + 1))
        self.n += 1
        self.mean = self.mean + away / self.n

    def merge(self, other: Spectrum) -> None:
        if not self.n or not other.n:
            if other.n:
                self.n, self.mean, self.values, self.vectors = other.n, other.mean, other.values, other.vectors
            return
        away, n = other.mean - self.mean, self.n + other.n
        least = EPS * max(float(other.values[-1]), 0.0)
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > least:
                self.values, self.vectors = update(self.values, self.vectors, vector, float(value))
        self.values, self.vectors = update(self.values, self.vectors, away, self.n * other.n / n)
        self.mean = self.mean + away * (other.n / n)
        self.n = n

    def row(self, part: int) -> pa.RecordBatch:
        kind = pa.list_(pa.float64())
        cells = [pa.array([list(x)], kind) for x in (self.mean, self.values, self.vectors.ravel())]
        return pa.record_batch([pa.array([part], pa.int64()), pa.array([self.n], pa.int64()), *cells], names=["part", "n", "mean", "values", "vectors"])


def _matrix(lists: pa.Array, dtype) -> np.ndarray:
    """A column of equally long lists as rows of a matrix."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(len(lists), -1)


def gridded(embeddings: DataFrame, settings: Settings, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``(_key, _x)``: the vectors that count, as grid values."""
    entries = F.col(column).cast("array<double>")
    fine = F.forall("_c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    value = lambda c: F.floor(F.greatest(F.least(F.lit(float(settings.grid)) * c, F.lit(WHOLE)), F.lit(-WHOLE))) + F.lit(settings.shift)
    return embeddings.select(F.col(key).alias("_key"), entries.alias("_c")).filter(F.col("_c").isNotNull() & fine).select("_key", F.transform("_c", value).alias("_x"))


def _totals(fit: DataFrame) -> tuple[int, list[int]]:
    """How many vectors of the common length there are, and their sums: parts of 32 bits are added up, so nothing is rounded."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            column = batch.column("_x")
            lengths = np.diff(column.offsets.to_numpy())
            for d in np.unique(lengths):
                x = _matrix(column.filter(pa.array(lengths == d)), np.int64)
                have = found.setdefault(int(d), [0, np.zeros(d, np.int64), np.zeros(d, np.int64)])
                have[0] += len(x)
                have[1] += (x >> 32).sum(0)
                have[2] += (x & 0xFFFFFFFF).sum(0)
        for d, (n, high, low) in found.items():
            yield pa.record_batch(
                [pa.array([d], pa.int32()), pa.array([n], pa.int64()), *(pa.array([list(v)], pa.list_(pa.int64())) for v in (high, low))],
                names=["d", "n", "high", "low"],
            )

    part = fit.mapInArrow(parts, "d int, n long, high array<long>, low array<long>")
    part = common.written(part, "whitening-sums")
    length = part.groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if length is None:
        return 0, []
    sums = (
        part.filter(F.col("d") == length["d"])
        .select(F.inline(F.arrays_zip(F.sequence(F.lit(1), "d").alias("at"), "high", "low")))
        .groupBy("at").agg(F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
        .collect()
        if length["d"] else []
    )
    return length["n"], [(int(r["high"]) << 32) + int(r["low"]) for r in sorted(sums, key=lambda r: r["at"])]


def _tree(parts: DataFrame, step, schema: str, fan_in: int, label: str) -> DataFrame:
    """Combines rows ``fan_in`` at a time until one is left."""
    parts = common.written(parts, label)
    left = parts.count()
    while left > 1:
        group = F.lit(0).cast("long") if left <= fan_in else F.expr(f"part div {fan_in}")
        parts = common.written(parts.withColumn("part", group).groupBy("part").applyInArrow(step, schema), label)
        left = parts.count()
    return parts


def _numbered(parts: DataFrame) -> DataFrame:
    """Partition numbers as ``part``."""
    return parts.withColumn("part", F.spark_partition_id().cast("long"))


def spectrum(fit: DataFrame, dim: int, settings: Settings) -> Spectrum:
    """Spectrum of the whole fit list, relative to ``shift``."""
    shift = settings.shift

    def absorb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Spectrum.empty(dim)
        for batch in batches:
            column = batch.column("_x")
            for x in _matrix(column.filter(pa.array(np.diff(column.offsets.to_numpy()) == dim)), np.int64) - shift:
                own.add(x.astype(np.float64))
        if own.n:
            yield own.row(0)

    def combine(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        rows.sort(key=lambda r: (-r["n"], r["mean"]))
        own = Spectrum.empty(dim)
        for r in rows:
            own.merge(_spectrum_of(r, dim))
        return pa.Table.from_batches([own.row(rows[0]["part"])])

    last = _tree(_numbered(fit.mapInArrow(absorb, SPECTRUM)), combine, SPECTRUM, settings.fan_in, "whitening-spectra").first()
    return _spectrum_of(last.asDict(), dim)


def _spectrum_of(row: dict, dim: int) -> Spectrum:
    return Spectrum(row["n"], np.array(row["mean"]), np.array(row["values"]), np.array(row["vectors"]).reshape(dim, dim))


def _moments(fit: DataFrame, n: int, sums: list[int], basis: np.ndarray, scale: np.ndarray, away: np.ndarray, settings: Settings, label: str) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of the fit list projected on ``basis``, times ``scale``, less ``away``."""
    dim, k = basis.shape
    centre, rest = _centre(n, sums)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second, any_rows = np.zeros(k), np.zeros((k, k)), False
        for batch in batches:
            column = batch.column("_x")
            x = _matrix(column.filter(pa.array(np.diff(column.offsets.to_numpy()) == dim)), np.int64)
            if not len(x):
                continue
            y = (((x - centre).astype(np.float64) - rest) @ basis) * scale - away
            first, second, any_rows = first + y.sum(0), second + y.T @ y, True
        if any_rows:
            yield pa.record_batch([pa.array([0], pa.int64()), pa.array([[*first, *second.ravel()]], pa.list_(pa.float64()))], names=["part", "sums"])

    def combine(group: pa.Table) -> pa.Table:
        rows = _matrix(group.column("sums"), np.float64)
        return pa.table({"part": pa.array([group.column("part")[0].as_py()], pa.int64()), "sums": pa.array([list(rows.sum(0))], pa.list_(pa.float64()))})

    schema = "part long, sums array<double>"
    last = _tree(_numbered(fit.mapInArrow(parts, schema)), combine, schema, settings.fan_in, label).first()
    total = np.array(last["sums"]) / n
    return total[:k], total[k:].reshape(k, k)


def _centre(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Whole part and rest of the means."""
    whole = [s // n for s in sums]
    return np.array(whole, dtype=np.int64), np.array([(s - w * n) / n for s, w in zip(sums, whole, strict=True)])


def fit(embeddings: DataFrame, settings: Settings | None = None, key: str = "vec_id", column: str = "embedding") -> Whitener | None:
    """Learns the components of all distinct vectors; None where there is no vector."""
    settings = settings or Settings()
    common.small_batches(embeddings.sparkSession)
    points = common.written(gridded(embeddings, settings, key, column).select("_x").distinct(), "whitening-fit")
    n, sums = _totals(points)
    dim = len(sums)
    if not n or not dim:
        return None
    rough = spectrum(points, dim, settings)
    basis = np.linalg.qr(rough.vectors[:, ::-1])[0]
    mean, second = _moments(points, n, sums, basis, np.ones(dim), np.zeros(dim), settings, "whitening-ritz")
    ritz = second - np.outer(mean, mean)
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    values, vectors = values[::-1], (basis @ turn)[:, ::-1]
    vectors = vectors / np.sqrt((vectors * vectors).sum(0))
    use = min(settings.components, int((values > dim * EPS * max(values[0], 0)).sum()))
    model = Whitener(n, sums, values[:use].copy(), np.ascontiguousarray(vectors[:, :use]), float(np.trace(ritz)))
    if use:
        scale = 1 / np.sqrt(model.values)
        away = (mean @ turn)[::-1][:use] * scale
        check = _moments(points, n, sums, model.vectors, scale, away, settings, "whitening-check")[1]
        model.identity_error = float(np.abs(check - np.eye(use)).max())
    return model


def _deviations(x: np.ndarray, n: int, sums: list[int], centre: np.ndarray) -> list[int | None]:
    """Exact sums of (n * x - S) ** 2."""
    over = np.array([s - n * int(c) for s, c in zip(sums, centre, strict=True)], dtype=object)
    away = x - centre
    largest = float(np.abs(away).max(initial=0)) * n + n
    if x.shape[1] * largest * largest < 2.0**62:
        t = away * np.int64(n) - over.astype(np.int64)
        return list((t * t).sum(1))
    exact = ((away.astype(object) * n - over) ** 2).sum(1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def whiten(embeddings: DataFrame, model: Whitener | None, settings: Settings | None = None, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """A row for each vector that counts and each component: ``key, component, n, deviation, whitened, explained, identity_error``."""
    settings = settings or Settings()
    kind = embeddings.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    spark = embeddings.sparkSession
    if model is None or not len(model.values):
        return spark.createDataFrame([], schema)
    common.small_batches(spark)
    dim, k, n, sums, error = model.dim, len(model.values), model.n, model.sums, model.identity_error
    centre, rest = _centre(n, sums)
    project = model.vectors / np.sqrt(model.values)
    share = model.values / model.trace
    names = [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("_x")
            batch = batch.filter(pa.array(np.diff(column.offsets.to_numpy()) == dim))
            rows = batch.num_rows
            if not rows:
                continue
            x = _matrix(batch.column("_x"), np.int64)
            y = ((x - centre).astype(np.float64) - rest) @ project
            each = np.repeat(np.arange(rows), k)
            yield pa.record_batch(
                [
                    batch.column("_key").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n, dtype=np.int64)), pa.array(_deviations(x, n, sums, centre), pa.int64()).take(pa.array(each)),
                    pa.array(y.ravel()), pa.array(np.tile(share, rows)), pa.array(np.full(rows * k, error)),
                ],
                names=names,
            )

    return gridded(embeddings, settings, key, column).mapInArrow(run, schema)
