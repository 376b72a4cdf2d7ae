"""Whitening against exact sums in plain Python and a covariance by numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import embedding_whitening as ew

SCHEMA = "vec_id bigint, embedding array<float>, label int, vec string, id string, whitened string"


def stored(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame([(i, v, 0, "x", "y", "z") for i, v in rows], schema).write.mode("overwrite").parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def checked(rows, got, d):
    """``rows`` are the usable vectors, ``got`` the rows of op12."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    v = np.array([[sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in x) / n**3 for j in range(d)] for i in range(d)])
    values = np.sort(np.linalg.eigvalsh(v))[::-1]
    k = min(32, int((values > 1e-12 * values[0]).sum()))
    assert len(got) == n * k and {r["n"] for r in got} == {n}
    assert sorted(str(r["vec_id"]) + ":" + str(r["deviation"]) for r in got if r["component"] == 1) == sorted(f"{i}:{dev}" for (i, _), dev in zip(rows, deviation))
    assert all(r["deviation_digits"] == str(r["deviation"]) for r in got)
    share = {r["component"]: r["explained"] for r in got}
    assert np.allclose([share[c + 1] for c in range(k)], values[:k] / np.trace(v), rtol=1e-9)
    (error,) = {r["identity_error"] for r in got}
    z = np.zeros((n, k))
    at = {}
    for r in got:
        at.setdefault((r["vec_id"], r["component"]), []).append(r["whitened"])
    by_id = {}
    for row, (i, _) in enumerate(rows):
        by_id.setdefault(i, []).append(row)
    for (i, c), own in at.items():
        for row, value in zip(by_id[i], own):
            z[row, c - 1] = value
    assert np.abs(z.T @ z / n - np.outer(z.mean(0), z.mean(0)) - np.eye(k)).max() < 1e-4 and error < 1e-4
    # The components are eigenvectors: the covariance of x and z is the axis times the root of its eigenvalue.
    centred = np.array([[a - s / n for a, s in zip(r, sums)] for r in x])
    axes = centred.T @ z / n / np.sqrt(values[:k])
    assert np.allclose(np.linalg.norm(axes, axis=0), 1) and np.allclose(v @ axes, axes * values[:k], atol=1e-6 * values[0])


def vectors(seed, n, d):
    rnd = random.Random(seed)
    return [(k, [rnd.gauss(0, 1 + i) + i for i in range(d)]) for k in range(n)]


@pytest.mark.parametrize("n, d", [(200, 5), (300, 40), (60, 1)])
def test_equals_a_plain_covariance(spark, tmp_path, n, d):
    rows = vectors(n, n, d)
    checked(rows, ew.op12(spark, stored(spark, tmp_path, rows)).collect(), d)


def test_awkward_rows(spark, tmp_path):
    sound = vectors(3, 80, 6)
    sound += [(None, sound[0][1]), (None, sound[1][1]), (5, sound[9][1])]
    odd = [(900, None), (901, []), (902, [1.0]), (903, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (904, [float("nan")] * 6), (905, [float("inf")] * 6),
           (906, [1e30] * 6), (907, [1.0] * 7)]
    got = ew.op12(spark, stored(spark, tmp_path, sound + odd)).collect()
    assert {r["vec_id"] for r in got} == {i for i, _ in sound}
    unique = [r for r in got if r["vec_id"] not in (None, 5)]
    assert {r["n"] for r in got} == {83} and len(got) == 83 * 6 and len(unique) == 80 * 6 - 6


def test_nothing_to_whiten(spark, tmp_path):
    for k, rows in enumerate([[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 4, [(1, []), (2, None)]]):
        out = ew.op12(spark, stored(spark, tmp_path / str(k), rows))
        assert out.collect() == [] and "identity_error" in out.columns


def test_dependent_dimensions_have_no_component(spark, tmp_path):
    rows = [(k, [float(a), float(2 * a), float(b)]) for k, (a, b) in enumerate((a, b) for a in range(9) for b in range(7))]
    checked(rows, ew.op12(spark, stored(spark, tmp_path, rows)).collect(), 3)


def test_large_entries_stay_exact(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(k, [rnd.uniform(-1, 1) * 2.0**e for e in (0, 30, 50)]) for k in range(50)]
    schema = SCHEMA.replace("array<float>", "array<double>")
    got = ew.op12(spark, stored(spark, tmp_path, rows, schema)).where("component = 1").collect()
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    want = {i: sum((50 * a - s) ** 2 for a, s in zip(r, sums)) for (i, _), r in zip(rows, x)}
    assert {r["vec_id"]: int(r["deviation_digits"]) for r in got} == want
    assert all(r["deviation"] is None for r in got)


def test_pairs_by_polarisation():
    u = np.array([[1, -2, 3], [4, 0, -1], [2, 2, 2]], np.int64)
    squares = dict(enumerate(ew.pair_squares(u)))
    missed = u.sum(axis=1).tolist()
    assert np.allclose(ew.covariance(3, missed, squares), np.cov(u, bias=True))
    assert ew.pair_squares(u * 2**40) == [s * 2**80 for s in squares.values()]
