"""Whitening against exact fractions, and the refinement against matrices of known eigenvectors."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from docweave.llm import whitening as w


def orthogonal(n, seed):
    """An orthogonal matrix in extended precision."""
    a = np.random.default_rng(seed).standard_normal((n, n)).astype(np.longdouble)
    for _ in range(3):
        for i in range(n):
            for j in range(i):
                a[:, i] -= a[:, j] * (a[:, j] @ a[:, i])
            a[:, i] /= np.sqrt(a[:, i] @ a[:, i])
    return a


@pytest.mark.parametrize(
    "values",
    [
        [9, 7, 5, 4, 3, 2, 1, 0.5],
        [1e6, 1, 1 + 1e-3, 1e-4],
        # Closer than float32 can tell apart.
        [5, 1 + 2e-9, 1 + 1e-9, 1, 1 - 1e-9, 0.25],
        [2 + 1e-6, 2, 1 + 1e-7, 1, 1e-9, 3e-9],
    ],
)
def test_refinement_finds_known_eigenvectors(values):
    values = np.array(sorted(values, reverse=True), np.longdouble)
    q = orthogonal(len(values), 1)
    a = (q * values) @ q.T
    found, x = w.refined_eigenvectors((a + a.T) / 2)
    assert np.abs(found - values).max() < 1e-17 * 8 * values.max()
    signs = np.sign(np.einsum("ij,ij->j", q, x))
    gap = min(abs(p - r) for k, p in enumerate(values) for r in values[:k])
    assert np.abs(x * signs - q).max() < max(2e-17, 2e-18 * values.max() / gap)


def test_refinement_of_equal_eigenvalues():
    q = orthogonal(9, 2)
    values = np.array([4, 4, 4, 2, 2, 1, 0, 0, 0], np.longdouble)
    a = (q * values) @ q.T
    found, x = w.refined_eigenvectors((a + a.T) / 2)
    assert np.abs(x.T @ x - np.eye(9)).max() < 1e-18 * 50
    assert np.abs(a @ x - x * found).max() < 1e-17
    assert np.abs(found - values).max() < 1e-17


def test_refinement_beats_a_double_solve():
    """Of 60 x 60, with float32 as the start."""
    values = np.array([1 + k / 1e5 for k in range(60)][::-1], np.longdouble)
    q = orthogonal(60, 3)
    a = (q * values) @ q.T
    _, x = w.refined_eigenvectors((a + a.T) / 2)
    plain = np.linalg.eigh(a.astype(float))[1][:, ::-1]
    error = lambda v: np.abs(v * np.sign(np.einsum("ij,ij->j", q, v)) - q).max()
    assert error(x) < 1e-13 < error(plain)


def plain(rows):
    """``vec_id``, n, deviation and the centred covariance in fractions, of vectors of one width."""
    whole = []
    for i, v in rows:
        if not v or any(c is None or not math.isfinite(c) for c in v):
            continue
        whole.append((i, tuple(math.floor(64 * Fraction(float(np.float32(c)))) + 1000000 for c in v)))
    fit = sorted({v for _, v in whole})
    n, width = len(fit), len(fit[0])
    sums = [sum(v[k] for v in fit) for k in range(width)]
    cov = [[sum((v[a] - Fraction(sums[a], n)) * (v[b] - Fraction(sums[b], n)) for v in fit) / n for b in range(width)] for a in range(width)]
    deviations = [(i, sum((n * x - s) ** 2 for x, s in zip(v, sums))) for i, v in whole]
    return whole, n, sums, cov, deviations


def test_against_fractions(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.2 * (k + 1)) + 0.1 * i % 3 for k in range(6)]) for i in range(120)]
    rows += [(500 + k, rows[0][1]) for k in range(300)] + [(7, rows[1][1]), (None, rows[2][1])]
    rows += [(900, None), (901, [None] * 6), (902, [math.nan] * 6), (903, [math.inf, *[0.0] * 5]), (904, [])]
    df = spark.createDataFrame(rows, "vec_id long, vec array<float>").repartition(5)
    models = w.learn(df)
    out = w.by_component(w.whiten(df, models), ["vec_id"]).collect()
    whole, n, sums, cov, deviations = plain(rows)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([(r.vec_id, r.deviation) for r in out if r.component == 1], key=key) == sorted(deviations, key=key)
    assert {r.n for r in out} == {n} and len(out) == 6 * len(whole)
    exact = np.array([[float(c) for c in r] for r in cov])
    values, basis = np.linalg.eigh(exact)
    values, basis = values[::-1], basis[:, ::-1]
    by = {r.vec_id: [] for r in out if r.vec_id is not None}
    for r in sorted((r for r in out if r.vec_id is not None), key=lambda r: (r.vec_id, r.component)):
        by[r.vec_id].append(r.whitened)
        assert abs(r.explained - values[r.component - 1] / values.sum()) < 1e-12
        assert 0 <= r.identity_error < 1e-12
    ids = [i for i, _ in whole if i is not None and i != 7 and i < 500]
    ours = np.array([by[i] for i in ids])
    centred = np.array([[float(x - Fraction(s, n)) for x, s in zip(v, sums)] for i, v in whole if i in set(ids) and i != 7])
    theirs = centred @ basis / np.sqrt(values)
    signs = np.sign((ours * theirs).sum(axis=0))
    assert np.abs(ours * signs - theirs).max() < 1e-10
    assert by[500] == by[0]


def test_large_numbers_stay_exact(spark):
    rng = random.Random(6)
    rows = [(i, [rng.choice([1e15, -3e12, 5.0]) * rng.random(), rng.random()]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, vec array<float>")
    model = w.learn(df)[2]
    _, n, sums, cov, deviations = plain(rows)
    assert [c * n + s for c, s in zip(model.centre, model.rest)] == sums
    assert abs(model.trace / float(cov[0][0] + cov[1][1]) - 1) < 1e-15
    found = {r.vec_id: r.deviation for r in w.whiten(df, {2: model}).collect()}
    assert found == {i: d if d < 2**63 else None for i, d in deviations}
    huge = spark.createDataFrame([(1, [3e38]), (2, [-3e38])], "vec_id long, vec array<float>")
    assert [r.deviation for r in w.whiten(huge, w.learn(huge)).collect()] == [None, None]


def test_edge_cases(spark):
    kind = "vec_id long, vec array<float>, n string, __x int"
    empty = spark.createDataFrame([], kind)
    assert w.learn(empty) == {} and w.whiten(empty, {}).count() == 0
    # One vector has no variance; widths are fitted apart; clashing columns give way or stay.
    df = spark.createDataFrame([(1, [1.0, 2.0], "a", 3), (2, [1.0, 2.0], "b", 4), (3, [1.0], "c", 5), (4, [2.0], "d", 6)], kind)
    rows = {r.vec_id: r for r in w.whiten(df, w.learn(df)).collect()}
    assert rows[1].whitened == [None, None] and rows[1].explained == [0, 0] and (rows[1].n, rows[1].deviation) == (1, 0)
    assert abs(rows[3].whitened[0]) == 1 and rows[3].whitened[0] == -rows[4].whitened[0] and rows[3].explained == [1]
    assert (rows[3].n, rows[3]["__x"]) == (2, 5)
    more = spark.createDataFrame([(1, [float(k == j) for j in range(20)]) for k in range(30)], "vec_id long, vec array<double>")
    assert w.by_component(w.whiten(more, w.learn(more)), ["vec_id"]).count() == 30 * w.COMPONENTS
