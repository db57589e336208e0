"""Embedding whitening: exact scatter of whole numbers from bit planes, eigenvectors, projection."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.llm.common import Sheltered, table

#: Grid of the whole numbers: x = floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
#: Sums leave a task in digits of this base, so that adding them up in longs stays exact for up to 2^31 tasks.
LIMB = 32
#: Rows whose bit planes are packed at once.
ROWS = 8192


def usable(df: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is not null and holds finite entries only; of several lengths, vectors shorter than the longest count as incomplete."""
    v = F.col(f"`{column}`").cast("array<double>")
    whole = df.filter(F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))))
    longest = whole.agg(F.max(F.size(f"`{column}`"))).first()[0] or 0
    return whole.filter((F.size(f"`{column}`") == longest) & F.lit(longest > 0))


def matrix(column: pa.Array, rows: int) -> np.ndarray:
    """An Arrow column of lists of doubles, all of one length, as rows x dimensions."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def whole_numbers(c: np.ndarray) -> np.ndarray:
    """floor(SCALE * c) + OFFSET, exactly: as 64-bit integers, or as Python's where an entry needs more."""
    if np.abs(c).max(initial=0) < 2.0**50:
        return np.floor(c * SCALE).astype(np.int64) + OFFSET
    # from 2^52 on a double is a whole number itself
    each = [int(v) * SCALE if abs(v) >= 2.0**52 else int(np.floor(v * SCALE)) for v in c.ravel().tolist()]
    return np.array([v + OFFSET for v in each], object).reshape(c.shape)


def bit_planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(planes x words, the dimension of each plane, its power of two) of numbers y >= 0, rows x dimensions: bit r of a plane is row r's bit."""
    widths = [int(v).bit_length() for v in y.max(0)]
    dims = np.repeat(np.arange(y.shape[1]), widths)
    powers = np.concatenate([np.arange(w) for w in widths]) if len(dims) else np.zeros(0, int)
    bits = np.zeros((len(dims), -(-len(y) // 64) * 64), np.uint8)
    for k, (d, p) in enumerate(zip(dims.tolist(), powers.tolist())):
        bits[k, : len(y)] = (y[:, d] >> p) & 1
    return np.packbits(bits, axis=1).view(np.uint64), dims, powers


def cross_products(x: np.ndarray) -> np.ndarray:
    """Sums over rows of x_i * x_j, as Python integers. Each dimension is shifted by its smallest value of these rows and cut into bit planes; the
    product of two dimensions is the sum of 2^(p + q) * popcount(plane p AND plane q), and the shifts are added back."""
    low = x.min(0)
    planes, dims, powers = bit_planes(x - low)
    counts = np.zeros((len(planes), len(planes)), np.int64)
    for k in range(len(planes)):
        counts[k, k:] = np.bitwise_count(planes[k:] & planes[k]).sum(1, dtype=np.int64)
    counts = np.triu(counts, 1).T + counts
    narrow = 2 * int(powers.max(initial=0)) + 2 * x.shape[1].bit_length() + len(x).bit_length() < 60
    weigh = np.zeros((x.shape[1], len(planes)), np.int64 if narrow else object)
    weigh[dims, np.arange(len(planes))] = [1 << int(p) for p in powers]
    if not narrow:
        counts = counts.astype(object)
    shifted, sums = (weigh @ counts @ weigh.T).astype(object), (weigh @ np.diag(counts)).astype(object)
    low = np.array([int(v) for v in low], object)
    cross = np.outer(low, sums)
    return shifted + cross + cross.T + len(x) * np.outer(low, low)


@dataclass(frozen=True)
class Whitening:
    """What the fit found: n, per-dimension sums, eigenvalues (falling) and unit eigenvectors (columns) of the covariance, and its trace. Where
    the covariance exceeds a double, values and trace are those of x / 2^shift."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    axes: np.ndarray
    trace: float
    shift: int = 0

    def sound(self, components: int) -> int:
        """Leading components whose eigenvalue isn't nothing beside the largest."""
        least = len(self.sums) * np.finfo(float).eps * max(self.values[0], 0.0) if len(self.values) else 0.0
        return int((self.values[:components] > least).sum())


def fit_whitening(vectors: DataFrame, column: str = "embedding") -> Whitening:
    """Covariance (divisor n) of the whole numbers of all ``usable`` vectors.

    Each task adds up n, the sums and the cross-products of its rows exactly, by ``cross_products`` of (1, x), and gives out one number for each
    pair and digit; the driver gets dimensions squared / 2 sums of these, whatever the number of rows. There, n * Q - S * S is formed in
    whole numbers before anything becomes a double.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = whole_numbers(matrix(part.column(0), part.num_rows))
                found = cross_products(np.hstack([np.ones((len(x), 1), x.dtype), x]))
                total = found if total is None else total + found
        if total is None:
            return
        rows = []
        for i in range(len(total)):
            for j in range(i, len(total)):
                v, k = abs(total[i, j]), 0
                sign = 1 if total[i, j] >= 0 else -1
                while v or not k:
                    rows.append((i, j, k, sign * (v & ((1 << LIMB) - 1))))
                    v, k = v >> LIMB, k + 1
        i, j, k, v = (np.array(c) for c in zip(*rows))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(k, pa.int32()), pa.array(v, pa.int64())], ["i", "j", "k", "v"])

    rows = vectors.select(F.col(f"`{column}`").cast("array<double>").alias("v")).mapInArrow(run, "i int, j int, k int, v long").groupBy("i", "j", "k").agg(F.sum("v").alias("v")).collect()
    d = max((r["j"] for r in rows), default=0)
    q = [[0] * (d + 1) for _ in range(d + 1)]
    for r in rows:
        q[r["i"]][r["j"]] += r["v"] << (LIMB * r["k"])
    n, sums = q[0][0], q[0][1:]
    scatter = [[n * q[min(i, j) + 1][max(i, j) + 1] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    shift = max([0, *((scatter[i][i].bit_length() - 2 * n.bit_length() - 1000) // 2 for i in range(d))])
    # quotients of whole numbers are correctly rounded
    over = (n * n) << (2 * shift)
    v = np.array([[c / over for c in r] for r in scatter]).reshape(d, d)
    trace = sum(scatter[i][i] for i in range(d)) / over if n else 0.0
    values, axes = np.linalg.eigh(v) if d else (np.zeros(0), np.zeros((0, 0)))
    return Whitening(n, tuple(sums), values[::-1], axes[:, ::-1], trace, shift)


def whiten(vectors: DataFrame, fit: Whitening, column: str = "embedding", components: int = 8) -> DataFrame:
    """The rows (``usable`` ones) with whitened (array<double>: (x - S / n) projected on each component over the root of its eigenvalue; null where the
    eigenvalue is nothing beside the largest), deviation (long: the sum over dimensions of (n * x - S)^2, null beyond 2^63 - 1) and
    deviation_exact (the same as text, always). A vector of another length than the fit's is an error. Other columns stay; an older one of an added name is
    replaced. Nothing is shuffled."""
    kept, sound = min(components, len(fit.sums)), fit.sound(components)
    axes = fit.axes[:, :sound] / np.sqrt(fit.values[:sound])
    sums = np.array(fit.sums, object)
    small = max((abs(s) for s in fit.sums), default=0) < 2**61

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = whole_numbers(matrix(batch.column(batch.num_columns - 1), batch.num_rows))
            fits = small and x.dtype == np.int64 and int(np.abs(x).max()) * fit.n < 2**61
            d = x * fit.n - sums.astype(np.int64) if fits else x.astype(object) * fit.n - sums
            square = d if fits and int(np.abs(d).max(initial=0)) ** 2 * d.shape[1] < 2**63 else d.astype(object)
            deviation = [int(v) for v in (square * square).sum(1)]
            # the whole numbers n * x - S lose nothing before the division
            w = (d / (fit.n << fit.shift)).astype(float) @ axes
            w = [[*r, *[None] * (kept - sound)] for r in w.tolist()]
            added = [pa.array(w, pa.list_(pa.float64())), pa.array([v if v < 2**63 else None for v in deviation], pa.int64()), pa.array([str(v) for v in deviation])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], [*batch.schema.names[:-1], "whitened", "deviation", "deviation_exact"])

    held = Sheltered(vectors, {"_v": F.col(f"`{column}`").cast("array<double>")})
    old = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in held.inside.schema.fields[:-1])
    done = held.inside.mapInArrow(run, f"{old}, whitened array<double>, deviation long, deviation_exact string")
    return held.outside(done, {n: n for n in ("whitened", "deviation", "deviation_exact")})


def identity_error(whitened: DataFrame, fit: Whitening, components: int = 8) -> float | None:
    """The largest absolute entry of the covariance of the whitened vectors, as they are, minus the identity; over sound components, None without any.

    Each task gives out sums and products of its rows; whitened vectors are centred, and what is left of their mean is taken out again.
    """
    sound = fit.sound(components)
    if not sound:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((sound + 1, sound + 1))
        for batch in batches:
            if batch.num_rows:
                w = np.hstack([np.ones((batch.num_rows, 1)), matrix(batch.column(0), batch.num_rows)[:, :sound].astype(float)])
                total += w.T @ w
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(total.ravel())], ["i", "j", "g"])

    out = np.zeros((sound + 1, sound + 1))
    for r in whitened.select("whitened").mapInArrow(run, "i int, j int, g double").groupBy("i", "j").agg(F.sum("g").alias("g")).collect():
        out[r["i"], r["j"]] = r["g"]
    mean = out[0, 1:] / fit.n
    return float(np.abs(out[1:, 1:] / fit.n - np.outer(mean, mean) - np.eye(sound)).max())


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact of all embeddings.

    Null vectors and those with null or non-finite entries take no part; repeated rows count and come as often as they occur; an empty table
    gives no rows. Components without variance have a null whitened value, and a null explained share if nothing varies at all.
    """
    rows = usable(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    fit = fit_whitening(rows)
    done = whiten(rows, fit)
    error = identity_error(done, fit)
    share = [float(v / fit.trace) if fit.trace > 0 else None for v in fit.values[:8]]
    each = done.select("vec_id", "deviation", "deviation_exact", F.posexplode("whitened").alias("_at", "whitened"))
    shares = F.array(*[F.lit(s).cast("double") for s in share or [None]])
    return each.select(
        "vec_id", (F.col("_at") + 1).alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(shares, F.col("_at") + 1).alias("explained"), F.lit(error).cast("double").alias("identity_error"), "deviation_exact",
    )


QUERIES = {"op12_whitening": op12_whitening}
#: SQL has no eigenvectors; tests compare with whole-number arithmetic in Python.
ORACLES: dict[str, str] = {}
