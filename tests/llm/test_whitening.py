"""Whitening against numpy: whole eigenproblem, exact sums, odd rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from seatplan.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n int, component string, _x int, label int"


def plain(rows, most=16):
    """All of it in one place."""
    kept = [(k, [math.floor(64 * c) + 1_000_000 for c in v]) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    points = sorted({tuple(x) for _, x in kept})
    n, dim = len(points), len(points[0])
    sums = [sum(p[j] for p in points) for j in range(dim)]
    centred = np.array([[(n * x - s) / n for x, s in zip(p, sums, strict=True)] for p in points])
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    use = min(most, int((values > dim * 2.0**-52 * max(values[0], 0)).sum()))
    out = []
    for k, x in kept:
        away = np.array([(n * a - s) / n for a, s in zip(x, sums, strict=True)])
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        for j in range(use):
            out.append((k, j + 1, n, deviation, away @ vectors[:, j] / math.sqrt(values[j]), values[j] / np.trace(cov)))
    return out, vectors[:, :use]


def same(got, want):
    got = sorted(((r["vec_id"] is None, r["vec_id"] or 0, r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in got))
    want = sorted((r[0] is None, r[0] or 0, *r[1:]) for r in want)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    signs = {}
    for g, w in zip(got, want, strict=True):
        if abs(w[5]) > 1e-3:
            signs.setdefault(g[2], math.copysign(1, g[5] * w[5]))
    for g, w in zip(got, want, strict=True):
        assert g[5] * signs.get(g[2], 1) == pytest.approx(w[5], rel=1e-8, abs=1e-8)
        assert g[6] == pytest.approx(w[6], rel=1e-10) and g[7] < 1e-9


def run(spark, rows, parts=3):
    frame = spark.createDataFrame([(k, v, 1, "c", 2, 3) for k, v in rows], SCHEMA).repartition(parts)
    return whitening.whiten(frame, whitening.fit(frame)).collect()


def test_equals_numpy_with_odd_rows(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(400, 20)) @ np.diag(np.linspace(0.2, 4, 20)) @ np.linalg.qr(rng.normal(size=(20, 20)))[0]
    rows = [(k, [float(np.float32(c)) for c in v]) for k, v in enumerate(base)]
    rows += [(7, rows[7][1])] * 200 + [(None, rows[3][1])]
    bad = [(900, None), (901, [None] + [1.0] * 19), (902, [float("nan")] * 20), (903, [float("inf")] + [0.0] * 19), (904, [1.0] * 7), (905, [])]
    same(run(spark, rows + bad, 5), plain(rows)[0])


def test_less_variance_than_dimensions(spark):
    rng = np.random.default_rng(6)
    rows = [(k, [float(x), float(x), 5.0, float(y)]) for k, (x, y) in enumerate(rng.integers(-9, 9, size=(90, 2)))]
    got = run(spark, rows)
    assert {r["component"] for r in got} == {1, 2}
    same(got, plain(rows)[0])


def test_one_or_no_vector(spark):
    assert run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    assert run(spark, [(1, None), (2, [])]) == []
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(empty, whitening.fit(empty)).collect() == []


def test_large_entries_stay_exact(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e9, 1.0]), (3, [3e8, 2.0]), (4, [0.5, 2.5])]
    got = {r["vec_id"]: r["deviation"] for r in run(spark, rows, 1)}
    assert got[1] is None and got[4] is None
    rows = [(1, [2.0**20, 0.0]), (2, [-(2.0**20), 1.0]), (3, [0.0, 2.0])]
    same(run(spark, rows, 2), plain(rows)[0])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-3, 3), min_size=4, max_size=4), min_size=1, max_size=25), st.integers(0, 24))
def test_rank_one_updates_and_merges(points, cut):
    x = np.array(points, dtype=float)
    a, b = whitening.Spectrum.empty(4), whitening.Spectrum.empty(4)
    for v in x[:cut]:
        a.add(v)
    for v in x[cut:]:
        b.add(v)
    a.merge(b)
    away = x - x.mean(0)
    assert a.n == len(x) and np.allclose(a.mean, x.mean(0), atol=1e-12)
    assert np.allclose((a.vectors * a.values) @ a.vectors.T, away.T @ away, atol=1e-9)
    assert np.allclose(a.vectors.T @ a.vectors, np.eye(4), atol=1e-12)
