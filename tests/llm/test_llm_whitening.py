import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import whitening as W


def plain(rows, most=4):
    """Per id and component: n, deviation, |whitened|, explained; from integers and numpy's own covariance."""
    live = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    ints = [(i, tuple(math.floor(256 * float(c)) for c in v)) for i, v in live]
    fit = sorted({x for _, x in ints})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]
    off = {x: [n * x[k] - sums[k] for k in range(d)] for x in fit}
    cov = np.array([[sum(o[i] * o[j] for o in off.values()) / n**3 for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    out = {}
    for i, x in ints:
        c = np.array(off[x]) / n
        for k in range(min(most, d)):
            out.setdefault(i, []).append((k + 1, n, sum(o * o for o in off[x]), abs(c @ u[:, k]) / math.sqrt(e[k]), e[k] / np.trace(cov)))
    return out


def vectors(n=300, d=6):
    rng = np.random.default_rng(5)
    mixed = rng.normal(size=(n, d)) @ np.diag([5, 3, 2, 1, 0.5, 0.25][:d]) @ rng.normal(size=(d, d)) + rng.normal(size=d) * 10
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(mixed)]
    rows += [(n + k, rows[0][1]) for k in range(n // 2)]  # a third of all rows are copies
    bad = [None, [], [1.0] * (d - 1) + [None], [float("nan")] * d, [float("inf")] + [0.0] * (d - 1), [1e30] * d, [1.0, 2.0]]
    return rows, [(5000 + k, v) for k, v in enumerate(bad)]


def frame(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    return df.withColumns({c: F.lit("clash") for c in ("id", "x", "v", "i", "n", "component", "low", "d")}).repartition(3)


def check(out, want, tolerance=1e-6):
    got = {}
    rows = out.collect()
    for r in rows:
        got.setdefault(r.vec_id, []).append(r)
    assert set(got) == set(want) and len(rows) == sum(map(len, want.values()))
    for i, parts in got.items():
        for r, (k, n, far, w, share) in zip(sorted(parts, key=lambda r: r.component), want[i], strict=True):
            assert (r.component, r.n, r.deviation) == (k, n, far)
            assert abs(abs(r.whitened) - w) < tolerance and abs(r.explained / share - 1) < 1e-4
    return rows


def test_whitening_equals_plain_integers(spark):
    rows, bad = vectors()
    got = check(W.whiten(frame(spark, rows + bad)), plain(rows))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    signs = {(r.component, round(r.whitened, 9)) for r in got if r.vec_id in (0, 300, 301)}
    assert len(signs) == 4  # copies get the same numbers


def test_cross_products_are_exact():
    rng = np.random.default_rng(1)
    for low, high, n in ((-700, 900, 1000), (0, 1, 65), (-(2**61), 2**61, 130)):
        x = rng.integers(low, high, (n, 4))
        x[:, 3] = x[0, 3]  # a constant dimension
        bits = [max(1, (int(a) - int(b)).bit_length()) for a, b in zip(x.max(0), x.min(0), strict=True)]
        y = (x - x.min(0)).view(np.uint64)
        exact = x.astype(object) - x.min(0).astype(object)
        want, got = exact.T @ exact, W.cross_products(y, bits)
        assert all(int(got[i, j]) == want[i, j] for i in range(4) for j in range(i, 4))


@pytest.mark.parametrize("shift,scale", [(1e6, 1.0), (0.0, 1e-3), (-1e9, 1e7)])
def test_shifted_and_scaled_doubles(spark, shift, scale):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in v * scale * 300 + shift]) for i, v in enumerate(rng.normal(size=(60, 3)) * [4, 2, 1])]
    out = W.whiten(frame(spark, rows, "double"))
    want = plain(rows)
    far = {i: v[0][2] for i, v in want.items()}
    got = {r.vec_id: r for r in out.filter("component = 1").collect()}
    for i, r in got.items():
        assert r.deviation == (far[i] if far[i] < 2**63 else None)
        assert abs(abs(r.whitened) - want[i][0][3]) < 1e-6 and r.identity_error < 1e-4


def test_degenerate_tables(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert W.whiten(empty).count() == 0 and W.whiten(empty).columns[0] == "vec_id"
    only_bad = frame(spark, vectors()[1][:4])
    assert W.whiten(only_bad).count() == 0
    same = W.whiten(frame(spark, [(i, [1.5, 2.5]) for i in range(9)])).collect()
    assert len(same) == 18 and all(r.n == 1 and r.deviation == 0 and r.whitened is None and r.explained is None and r.identity_error is None for r in same)
    line = W.whiten(frame(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(8)])).collect()  # one direction only
    first = [r for r in line if r.component == 1]
    assert all(r.whitened is not None and r.identity_error < 1e-9 and abs(r.explained - 1) < 1e-9 for r in first)
    assert all(r.whitened is None for r in line if r.component > 1) and len(line) == 24


def test_lengths_that_differ(spark):
    rows = [(i, [float(i % 7), float(i % 3)]) for i in range(20)] + [(100 + i, [1.0, 2.0, 3.0]) for i in range(5)]
    assert {r.vec_id for r in W.whiten(frame(spark, rows)).collect()} == set(range(20))
