"""Whitening against plain exact arithmetic."""

import math
from fractions import Fraction

import numpy as np
import pytest

from slumptrace.llm.whitening import LARGEST, centre, pack_vectors, scatter, unpack_vectors, whiten


@pytest.fixture
def vectors(spark):
    def build(*rows):
        return spark.createDataFrame([(i, v, "x", 0.0) for i, v in rows], "vec_id long, embedding array<float>, length string, n double")

    return build


@pytest.mark.parametrize("low, high, shape", [
    (-60, 60, (300, 7)), (0, 2, (1, 4)), (5, 6, (9, 3)), (-2**44, 2**44, (70, 3)), (-1000, 90_000, (130, 5)), (-2**30, 2**30, (64, 2))])
def test_cross_products_are_exact(low, high, shape):
    matrix = np.random.default_rng(1).integers(low, high, shape)
    sums, products = scatter(matrix)
    plain = matrix.astype(object)
    assert (sums == plain.sum(0)).all() and (products == plain.T @ plain).all()


def test_packing_is_one_to_one():
    rows = np.array([[0, 1], [127, -128], [128, 0], [-40_000, 5], [2**40, -1]])
    blobs = pack_vectors(rows)
    assert [len(b) for b in blobs] == [3, 3, 5, 9, 17]
    assert sorted(unpack_vectors(blobs)[2].tolist()) == sorted(rows.tolist())


def test_centre_is_exact_beyond_64_bits():
    matrix = np.array([[LARGEST, 3], [-LARGEST, 4]])
    assert centre(matrix, 10**6, [5, 7]).tolist() == [[LARGEST * 10**6 - 5, 3 * 10**6 - 7], [-LARGEST * 10**6 - 5, 4 * 10**6 - 7]]


def brute(rows, components=16):
    """Exact covariance over distinct vectors of whole numbers, by fractions."""
    x = {i: [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for i, v in rows}
    fit = sorted({tuple(v) for v in x.values()})
    n, d = len(fit), len(fit[0])
    s = [sum(v[j] for v in fit) for j in range(d)]
    mean = [Fraction(t, n) for t in s]
    v = np.array([[float(sum((f[i] - mean[i]) * (f[j] - mean[j]) for f in fit) / n) for j in range(d)] for i in range(d)])
    values, axes = np.linalg.eigh(v)
    return x, n, s, mean, v, values[::-1][:components], axes[:, ::-1].T[:components]


def test_all_columns(spark, vectors, staging):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 5)) * [3, 1, 0.5, 2, 0.2]
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(base)]
    rows += [(100, rows[0][1]), (101, rows[0][1])]
    x, n, s, mean, v, values, axes = brute(rows)
    odd = [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0]), (202, [math.nan] * 5), (203, [math.inf, 0.0, 0.0, 0.0, 0.0]), (204, [])]
    found = whiten(vectors(*rows, *odd), staging, components=4).collect()
    assert sorted({r.vec_id for r in found}) == sorted(x) and len(found) == len(rows) * 4
    white = {}
    for r in found:
        k = r.component - 1
        assert r.n == n == 60
        assert r.deviation == sum((n * x[r.vec_id][j] - s[j]) ** 2 for j in range(5))
        assert r.explained == pytest.approx(values[k] / np.trace(v), rel=1e-9)
        assert r.identity_error < 1e-9
        projected = sum(float(x[r.vec_id][j] - mean[j]) * axes[k][j] for j in range(5)) / math.sqrt(values[k])
        assert abs(r.whitened) == pytest.approx(abs(projected), abs=1e-9)
        white.setdefault(r.vec_id, [0] * 4)[k] = r.whitened
    fit = np.array([white[k] for k in range(60)])
    assert np.abs(fit.T @ fit / 60 - np.eye(4)).max() < 1e-9
    assert white[100] == white[0] == white[101]


def test_repeated_ids_nulls_lengths_and_no_spread(vectors):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 2.0]), (2, [5.0]), (2, [5.0]), (3, [1e30, 0.0, -1e30])]
    found = whiten(vectors(*rows)).collect()
    pairs = sorted(((r.vec_id is None, r.vec_id or 0, r.component) for r in found))
    assert pairs == sorted([(False, 1, 1), (False, 1, 2)] * 2 + [(True, 0, 1), (True, 0, 2)] + [(False, 2, 1)] * 2 + [(False, 3, k) for k in (1, 2, 3)])
    one = [r for r in found if r.vec_id == 2]
    assert all(r.n == 1 and r.deviation == 0 and r.whitened is None and r.explained is None and r.identity_error == 0 for r in one)
    two = {(r.vec_id, r.component): r for r in found if r.vec_id in (1, None)}
    assert abs(two[1, 1].whitened) == pytest.approx(1.0) and two[1, 1].whitened == pytest.approx(-two[None, 1].whitened)
    assert two[1, 2].whitened is None and two[1, 1].explained == pytest.approx(1.0)
    assert two[1, 1].deviation == (2 * 64 - 256) ** 2


def test_split_over_many_tasks_is_the_same(vectors):
    rng = np.random.default_rng(3)
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(rng.normal(size=(200, 6)))]
    one, many = (whiten(vectors(*rows).repartition(p)).orderBy("vec_id", "component").collect() for p in (1, 40))
    assert [r[:4] for r in one] == [r[:4] for r in many]
    assert [r.whitened for r in one] == [r.whitened for r in many]


def test_empty(vectors):
    assert whiten(vectors((1, None))).collect() == []
    assert whiten(vectors((1, [1.0])).limit(0)).collect() == []
