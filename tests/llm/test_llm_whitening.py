"""Whitening against a plain computation, and the eigensolver against known spectra."""

import math
from fractions import Fraction

import numpy as np
import pytest

from promolens.llm import whitening as W
from promolens.llm.common import table
import helpers as H


def with_spectrum(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))[0]
    a = (q * values) @ q.T
    return (a + a.T) / 2


SPECTRA = [np.arange(1.0, 41), np.array([1.0] * 30), np.array([5.0] * 9 + [1.0] * 9 + [0.0] * 6), np.geomspace(1e-9, 1e3, 32),
           np.array([3.0]), np.array([2.0, 1.0]), np.r_[np.zeros(20), 7.0], 100 + np.linspace(0, 1e-7, 24), -np.arange(12.0)]


@pytest.mark.parametrize("values", SPECTRA, ids=range(len(SPECTRA)))
def test_inertia_counts(values):
    a, order = with_spectrum(values), np.sort(values)
    scale = np.abs(a).sum(1).max()
    for shift in [order[0] - 1, order[-1] + 1, *((order[1:] + order[:-1]) / 2)]:
        if np.abs(order - shift).min() > 1e-12 * scale:
            assert W.below(a, shift) == (order < shift).sum()
    assert W.below(np.array([[0.0, 1], [1, 0]]), 0.0) == 1


@pytest.mark.parametrize("values", SPECTRA, ids=range(len(SPECTRA)))
def test_feast_finds_all(values):
    a, falling = with_spectrum(values), np.sort(values)[::-1]
    scale = np.abs(a).sum(1).max()
    wanted = min(16, len(values))
    got, vectors, top = [], [], np.inf
    for low, high, count in W.intervals(a, wanted):
        assert low < high <= top
        top = low
        e, v = W.inside(a, low, high, count)
        got += [*e]
        vectors.append(v)
    v = np.hstack(vectors)
    assert len(got) >= wanted and np.abs(np.array(got) - falling[:len(got)]).max() <= 1e-13 * scale
    assert np.abs(v.T @ v - np.eye(len(got))).max() <= 1e-9
    assert np.abs(a @ v - v * got).max() <= 1e-13 * scale


def plain(rows, wanted=16):
    """[(id, vector)] -> {(id, place)}: component -> values, by eigh of the exact covariance."""
    whole = [(i, [math.floor(64 * float(np.float32(c))) + 1000000 for c in v]) for i, v in rows
             if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in whole})
    n, d = len(fit), len(fit[0])
    s = [sum(x[j] for x in fit) for j in range(d)]
    exact = [[n * x[j] - s[j] for j in range(d)] for x in fit]
    cov = np.array([[float(Fraction(sum(e[i] * e[j] for e in exact), n**3)) for j in range(d)] for i in range(d)])
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    keep = [k for k in range(min(wanted, d)) if e[k] > d * 2.3e-16 * e[0]]
    out = []
    for i, x in whole:
        off = [n * a - b for a, b in zip(x, s)]
        white = np.array([o / n for o in off]) @ v[:, keep] / np.sqrt(e[keep])
        out.append((i, n, sum(o * o for o in off), white, e[keep] / e.sum()))
    return out


def held(spark, rows):
    kind = "vec_id long, embedding array<float>, label int, component int, n long, x array<int>"
    df = spark.createDataFrame([(i, v, 0, 1, 2, [3]) for i, v in rows], kind)
    got = {}
    for r in W.whiten(df).collect():
        got.setdefault((r.vec_id, r.n, r.deviation), {}).setdefault(r.component, []).append((r.whitened, r.explained, r.identity_error))
    return got


def close(got, want):
    """Equal but for one sign a component."""
    signs = {}
    seen = {}
    for i, n, dev, white, share in want:
        mine = got[i, n, dev]
        assert sorted(mine) == list(range(1, len(white) + 1))
        k = seen[i, dev] = seen.get((i, dev), -1) + 1
        for c, (w, e) in enumerate(zip(white, share), 1):
            g = mine[c][k]
            if abs(w) > 1e-6:
                assert signs.setdefault(c, np.sign(w * g[0])) == np.sign(w * g[0])
            assert abs(abs(g[0]) - abs(w)) <= 1e-9 * max(1, abs(w)) and abs(g[1] / e - 1) <= 1e-9 and g[2] <= 1e-9
    assert sum(len(x[1]) for x in got.values()) == len(want)


def test_given_vectors(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in table(spark, H.SMALL, "embeddings").collect()]
    close(held(spark, rows), plain(rows))


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(np.float32(c)) for c in rng.standard_normal(5) * [5, 3, 2, 1, 0.5]]) for i in range(60)]
    good += [(None, good[3][1]), (2**60 + 1, good[4][1]), (7, good[7][1]), (8, [0.0] * 5)]
    bad = [(90, None), (91, []), (92, [1.0, None, 1.0, 1.0, 1.0]), (93, [math.nan] * 5), (94, [math.inf, 0.0, 0.0, 0.0, 0.0]), (None, None),
           (95, [1.0, 2.0]), (96, [1e30, 0.0, 0.0, 0.0, 0.0])]
    close(held(spark, good + bad), plain(good))


def test_large_entries_are_exact(spark):
    rows = [(i, [float(2**40 * (i % 7)), float(i), -float(2**33 * (i % 3))]) for i in range(40)]
    got, want = held(spark, rows), plain(rows)
    fits = [x for x in want if x[2] < 2**63]
    assert {k[2] for k in got} == {x[2] if x[2] < 2**63 else None for x in want} and len(fits) < len(want)


def test_little_variance(spark):
    assert held(spark, []) == {} and held(spark, [(1, None)]) == {}
    assert held(spark, [(1, [0.5, 0.25])] * 3) == {}  # one distinct vector
    two = held(spark, [(1, [0.5, 0.25]), (2, [1.5, 0.25])])
    assert {k: sorted(v) for k, v in two.items()} == {(1, 2, 64**2): [1], (2, 2, 64**2): [1]}
    assert sorted(abs(v[1][0][0]) for v in two.values()) == pytest.approx([1, 1])
