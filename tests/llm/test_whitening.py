import math
import random

import numpy as np
import pytest

from palimpsest.llm import whitening
from palimpsest.llm.whitening import whitened
from tests.llm.helpers import with_clashes

KIND = "vec_id long, embedding array<float>"


def vectors(spark, rows, kind=KIND):
    return spark.createDataFrame(rows, kind)


def plain(rows, components=4):
    """x-vectors by id, n, sums and the leading pairs from the whole covariance."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = {i: tuple(math.floor(256 * float(np.float32(c))) for c in v) for i, v in kept}
    fit = np.array(sorted(set(x.values())), dtype=float)
    mean = fit.mean(axis=0)
    covariance = (fit - mean).T @ (fit - mean) / len(fit)
    values, lead = np.linalg.eigh(covariance)
    return x, len(fit), fit.sum(axis=0).astype(int).tolist(), values[::-1], lead[:, ::-1], mean


def check(rows, got, components=4, close=1e-9):
    x, n, sums, values, lead, mean = plain(rows)
    keep = [k for k in range(min(components, len(values))) if values[k] > 1e-12 * values.sum()]
    assert len(got) == len(x) * len(keep)
    for k in keep:
        mine = {r.vec_id: r for r in got if r.component == k + 1}
        wanted = {i: (np.array(v) - mean) @ lead[:, k] / math.sqrt(values[k]) for i, v in x.items()}
        sign = np.sign(sum(mine[i].whitened * w for i, w in wanted.items()))
        for i, w in wanted.items():
            r = mine[i]
            assert abs(sign * r.whitened - w) < close * (1 + abs(w))
            assert r.n == n and int(r.deviation) == sum((n * c - s) ** 2 for c, s in zip(x[i], sums))
            assert abs(r.explained - values[k] / values.sum()) < 1e-12
            assert r.identity_error < 1e-9


def sample(n, d, seed, spread=lambda k: 1.0):
    rng = random.Random(seed)
    scales = [spread(k) for k in range(d)]
    return [(i, [rng.gauss(0.3, 1) * s for s in scales]) for i in range(n)]


@pytest.mark.parametrize("d, spread", [(30, lambda k: 1.0), (12, lambda k: 2.0**-k), (3, lambda k: 1.0), (1, lambda k: 1.0)])
def test_components_are_those_of_the_whole_covariance(spark, monkeypatch, d, spread):
    monkeypatch.setattr(whitening, "CHECKS", 2)
    rows = sample(300, d, d, spread)
    rows += [(1000 + i, rows[0][1]) for i in range(200)]
    check(rows, whitened(vectors(spark, rows)).collect())


def test_restarts_and_few_steps(spark, monkeypatch):
    monkeypatch.setattr(whitening, "SPACE", 1)
    monkeypatch.setattr(whitening, "CHECKS", 1)
    rows = sample(300, 40, 5)
    fit = whitening.Fit(whitening.stored(vectors(spark, rows).select(whitening.grid(whitening.F.col("embedding"), 256).alias("x")).distinct(), "t"), 40)
    values, lead, done = whitening.leading_pairs(fit, 4, space=24, steps=4)
    _, _, _, wanted, truth, _ = plain(rows)
    assert np.allclose(values, wanted[:4], rtol=1e-12)
    assert np.allclose(np.abs((lead * truth[:, :4]).sum(axis=0)), 1, atol=1e-10)
    assert done > 3


def test_a_start_that_misses_the_first_vector(spark, monkeypatch):
    """The start space and its first rounds know nothing of the leading direction; the checks bring it up."""
    rows = [(i, [0.0] * 40) for i in range(80)]
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 9) if k == 0 else rng.gauss(0, 1) for k in range(40)]) for i, _ in rows]

    class Blind:
        calls = 0

        def __init__(self, real):
            self.real = real

        def standard_normal(self, shape):
            out = self.real.standard_normal(shape)
            Blind.calls += 1
            if Blind.calls == 1:
                out[0] = 0
            return out

    monkeypatch.setattr(np.random, "default_rng", lambda seed, real=np.random.default_rng: Blind(real(seed)))
    check(rows, whitened(vectors(spark, rows)).collect())


def test_unusable_rows_and_clashing_columns(spark):
    good = sample(50, 6, 3)
    odd = [(60, None), (61, []), (62, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (63, [float("nan")] * 6), (64, [float("inf")] * 6), (None, good[0][1])]
    short = [(70, [1.0, 2.0])]
    docs = with_clashes(vectors(spark, good + odd + short)).withColumn("whitened", whitening.F.lit("x"))
    got = whitened(docs).collect()
    assert {r.vec_id for r in got} == {i for i, _ in good} | {None}
    check(good, [r for r in got if r.vec_id is not None])


def test_equal_vectors_have_no_component(spark):
    assert whitened(vectors(spark, [(i, [1.0, 2.0]) for i in range(5)])).collect() == []
    line = [(i, [float(i), 2.0 * i, 1.0]) for i in range(5)]
    check(line, whitened(vectors(spark, line)).collect())


def test_empty_table(spark):
    got = whitened(vectors(spark, []))
    assert got.collect() == [] and got.columns[:2] == ["vec_id", "component"]
    assert whitened(vectors(spark, [(1, None)])).collect() == []


def test_huge_entries_stay_exact(spark):
    rows = [(i, [float(v), 1e12 * v, -3e12 * v * v]) for i, v in enumerate([1, 2, 5, 9])]
    got = whitened(vectors(spark, rows, "vec_id long, embedding array<double>")).collect()
    x = [[math.floor(256 * c) for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    want = {i: sum((4 * c - s) ** 2 for c, s in zip(v, sums)) for i, v in enumerate(x)}
    assert {r.vec_id: int(r.deviation) for r in got} == want
