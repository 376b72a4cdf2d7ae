"""Whitened principal components by a covariance from polarisation.

Entries become integers ``x = floor(64 c) + 1000000``, so every sum is exact.
Vectors are centred at the rounded mean; then only squares are added up: of
every dimension, and of the sum of every pair of dimensions. The variance of a
sum less the variances of its parts is twice their covariance, so these
squares give the whole covariance matrix, as exact fractions. Its eigenvectors
(``eigh``), divided by the roots of their eigenvalues, whiten the vectors.

Scale: three reads of the vectors (sums, squares, moments of the result) and
the one that returns rows; nothing is shuffled but partial sums, one row a
task and matrix entry, which Spark adds up. The driver gets the matrix, whose
size is the square of the dimension, never rows.

Defined results: left out are null vectors, vectors with a null, non-finite or
beyond 2**55 large entry (its squares would not add up in longs), and vectors whose length is not the most frequent
one (the greater of equally frequent ones); they have no rows in the result.
Repeated rows and ids, and null ids, are vectors of their own. Directions
without variance (eigenvalue below ``FLOOR`` of the largest) have no component;
so one vector alone, equal vectors, empty vectors and an empty table give an
empty result. ``deviation`` is null where the exact sum exceeds a long;
``deviation_digits`` always has it, as digits. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

# The integer form of an entry.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Eigenvalues up to this share of the largest are rounding, not variance.
FLOOR = 1e-12
#: Largest entry whose integer form is a long with room for its sums.
LARGEST = 2.0**55
#: Bits of a digit in which tasks send sums beyond a long.
DIGIT = 60
#: Rows taken at a time, so that the sums of a chunk are bounded.
CHUNK = 4096
LONG_MAX = 2**63 - 1


@dataclass(frozen=True)
class Whitening:
    """What the rows need: ``n``, integer centre, what the centre misses of the sums, and the projection."""

    n: int
    centre: tuple[int, ...]
    missed: tuple[int, ...]
    projection: np.ndarray  # dimension x components
    explained: tuple[float, ...]


def usable(vec: Column) -> Column:
    sound = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LARGEST))
    return vec.isNotNull() & F.forall(vec, lambda c: sound(c.cast("double")))


def integers(vectors: pa.Array) -> np.ndarray:
    """The integer form of a batch of vectors of one length, rows x dimension."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return (np.floor(SCALE * flat).astype(np.int64) + OFFSET).reshape(len(vectors), -1)


def exact_sum(values: np.ndarray, bound: int) -> np.ndarray:
    """Sums over the last axis; ``bound`` limits every value."""
    if bound * max(values.shape[-1], 1) < 2**62:
        return values.sum(axis=-1)
    return values.astype(object).sum(axis=-1)


def pair_squares(centred: np.ndarray) -> list[int]:
    """Of a chunk (dimension x rows): the sum of squares of every dimension and, after it, of its sum with every later one."""
    largest = int(np.abs(centred).max(initial=0))
    if 4 * largest**2 * max(centred.shape[1], 1) >= 2**62:
        centred = centred.astype(object)
    out: list[int] = []
    for i, row in enumerate(centred):
        pairs = centred[i + 1 :] + row
        out.append(int((row * row).sum()))
        out.extend(map(int, (pairs * pairs).sum(axis=1)))
    return out


def _numbers(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    """Integers of any size by position, in digits of ``DIGIT`` bits (the last digit has the sign)."""
    out: list[tuple[int, int, int]] = []
    for k, v in rows:
        place = 0
        while not -(1 << DIGIT) < v < 1 << DIGIT:
            out.append((k, place, v & ((1 << DIGIT) - 1)))
            v, place = v >> DIGIT, place + 1
        out.append((k, place, v))
    k, place, v = zip(*out)
    return pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(place, pa.int32()), pa.array(v, pa.int64())], names=["k", "place", "v"])


def _total(vectors: DataFrame, partial) -> dict[int, int]:
    """Exact sums by position of what ``partial(batches)`` yields; as many rows as positions (and digits) reach the driver."""
    sums = vectors.mapInArrow(partial, "k int, place int, v bigint").groupBy("k", "place").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("v"))
    out: dict[int, int] = {}
    for r in sums.collect():
        out[r["k"]] = out.get(r["k"], 0) + (int(r["v"]) << (DIGIT * r["place"]))
    return out


def frequent_length(vectors: DataFrame) -> int | None:
    found = vectors.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return found[0]["d"] if found else None


def covariance(n: int, missed: list[int], squares: dict[int, int]) -> np.ndarray:
    """Cov(i, j) = (Var(i + j) - Var(i) - Var(j)) / 2, with n * n times each variance exact."""
    d = len(missed)
    at = lambda i: i * d - i * (i - 1) // 2  # noqa: E731  position of dimension i in pair_squares
    spread = [n * squares[at(i)] - missed[i] ** 2 for i in range(d)]
    out = np.empty((d, d))
    for i in range(d):
        out[i, i] = spread[i] / n**2
        for j in range(i + 1, d):
            both = n * squares[at(i) + j - i] - (missed[i] + missed[j]) ** 2
            out[i, j] = out[j, i] = (both - spread[i] - spread[j]) / (2 * n**2)
    return out


def fit(vectors: DataFrame, d: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all ``vectors(vec)`` of length ``d``; ``None`` if they have no variance."""

    def sums(batches):
        n, total = 0, [0] * d
        for batch in batches:
            x = integers(batch.column("vec")).T
            n += x.shape[1]
            part = exact_sum(x, int(np.abs(x).max(initial=0)))
            total = [a + int(b) for a, b in zip(total, part)]
        yield _numbers([(0, n), *enumerate(total, 1)])

    first = _total(vectors, sums)
    n = first.get(0, 0)
    if n < 2:
        return None
    totals = [first[i + 1] for i in range(d)]
    centre = [(2 * s + n) // (2 * n) for s in totals]
    missed = [s - n * c for s, c in zip(totals, centre)]

    def squares(batches):
        total = [0] * (d * (d + 1) // 2)
        for batch in batches:
            u = (integers(batch.column("vec")) - np.array(centre, np.int64)).T
            for start in range(0, u.shape[1], CHUNK):
                part = pair_squares(np.ascontiguousarray(u[:, start : start + CHUNK]))
                total = [a + b for a, b in zip(total, part)]
        yield _numbers(list(enumerate(total)))

    v = covariance(n, missed, _total(vectors, squares))
    values, axes = np.linalg.eigh(v)
    order = np.argsort(values)[::-1][:components]
    order = order[values[order] > FLOOR * max(values.max(), 0.0)]
    if not len(order):
        return None
    e = values[order]
    return Whitening(n, tuple(centre), tuple(missed), axes[:, order] / np.sqrt(e), tuple((e / np.trace(v)).tolist()))


def projected(x: np.ndarray, w: Whitening) -> np.ndarray:
    return (x - np.array(w.centre, np.int64) - np.array(w.missed, np.float64) / w.n) @ w.projection


def identity_error(vectors: DataFrame, w: Whitening) -> float:
    """The largest absolute entry of the whitened vectors' covariance less the identity, measured on all of them."""
    k = w.projection.shape[1]

    def moments(batches):
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            z = projected(integers(batch.column("vec")), w)
            first += z.sum(axis=0)
            second += z.T @ z
        flat = np.concatenate([first, second.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["k", "v"])

    rows = vectors.mapInArrow(moments, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(k + k * k)
    for r in rows:
        flat[r["k"]] = r["v"]
    mean = flat[:k] / w.n
    return float(np.abs(flat[k:].reshape(k, k) / w.n - np.outer(mean, mean) - np.eye(k)).max())


def deviations(x: np.ndarray, w: Whitening) -> list[int]:
    """The sum over dimensions of ``(n x - S)**2`` of every row, exact."""
    u = x - np.array(w.centre, np.int64)
    largest = w.n * int(np.abs(u).max(initial=0)) + max(map(abs, w.missed), default=0)
    if largest**2 * max(len(w.centre), 1) >= 2**62:
        u = u.astype(object)
    gap = u * w.n - np.array(w.missed, dtype=u.dtype)
    return [int(v) for v in (gap * gap).sum(axis=1)]


WHITENED_DDL = "id bigint, deviation bigint, deviation_digits string, whitened array<double>"


def whiten(df: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None, float | None]:
    """``(id, deviation, deviation_digits, whitened)`` per usable vector, the fitted whitening, and its identity error."""
    sound = df.where(usable(F.col(vec_col))).select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("vec"))
    d = frequent_length(sound)
    sound = sound.where(F.size("vec") == F.lit(-1 if d is None else d))
    w = fit(sound.select("vec"), d, components) if d else None
    if w is None:
        return df.sparkSession.createDataFrame([], WHITENED_DDL), None, None

    def rows(batches):
        for batch in batches:
            x = integers(batch.column("vec"))
            exact = deviations(x, w)
            z = projected(x, w)
            offsets = pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([v if v <= LONG_MAX else None for v in exact], pa.int64()), pa.array(map(str, exact), pa.string()),
                 pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(z).ravel()))],
                names=["id", "deviation", "deviation_digits", "whitened"],
            )

    return sound.mapInArrow(rows, WHITENED_DDL), w, identity_error(sound.select("vec"), w)


def op12(spark, sf_dir):
    rows, w, error = whiten(table(spark, sf_dir, "embeddings"))
    explained = F.array(*[F.lit(x) for x in w.explained]) if w else F.array().cast("array<double>")
    each = rows.select("id", "deviation", "deviation_digits", F.posexplode("whitened").alias("k", "whitened"))
    return each.select(
        F.col("id").alias("vec_id"), (F.col("k") + 1).cast("int").alias("component"), F.lit(w.n if w else 0).cast("bigint").alias("n"), "deviation",
        "whitened", F.element_at(explained, F.col("k") + 1).alias("explained"), F.lit(error).cast("double").alias("identity_error"), "deviation_digits",
    )
