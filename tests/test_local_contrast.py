"""Local equalisation and wavelets against plain loops."""

import numpy as np
import pytest

from tetraframe.operators import local_contrast as lc
from tetraframe.operators.volumes import smooth_plane
from tetraframe.plans import fixtures as fx


def table(spark, a):
    """Voxels of an array (z, y, x) at one time point."""
    at = np.indices(a.shape).reshape(3, -1).T
    return spark.createDataFrame([(1, *map(int, p), int(a[tuple(p)])) for p in at], "t int, z int, y int, x int, value int")


def dense(rows, shape, column):
    p = rows.toPandas()
    out = np.full(shape, np.nan)
    out[p["z"], p["y"], p["x"]] = p[column]
    assert len(p) == out.size
    return out


def spread_loops(counts, most):
    """The same rule, bin by bin."""
    h = [min(c, most) for c in counts]
    over = sum(c - m for c, m in zip(counts, h))
    share = over // len(h)
    for k, c in enumerate(list(h)):
        if c < most - share:
            h[k] += share
            over -= share
        elif c < most:
            over -= most - c
            h[k] = most
    while over > 0:
        before = over
        for first in range(len(h)):
            step = max(1, sum(c < most for c in h) // over)
            chosen = [k for k in range(first, len(h), step) if h[k] < most]
            for k in chosen:
                h[k] += 1
            over -= len(chosen)
            if over <= 0:
                break
        if over == before:
            break
    return h


def equalised_loops(plane, limit, ky, kx):
    """One slice, pixel by pixel."""
    lo, hi = np.percentile(plane, (0.5, 99.5))
    if hi <= lo + 1e-8:
        return np.zeros(plane.shape, int)
    ny, nx = plane.shape
    ty, tx = -(-ny // ky), -(-nx // kx)
    bins = (np.floor((np.clip(plane, lo, hi) - lo) / (hi - lo) * 16383) // 65).astype(int)
    wide = np.pad(bins, ((0, ty * ky - ny), (0, tx * kx - nx)), mode="reflect")
    most = max(int(limit * ky * kx), 1)
    maps = {}
    for i in range(ty):
        for j in range(tx):
            counts = [0] * 256
            for b in wide[i * ky : (i + 1) * ky, j * kx : (j + 1) * kx].ravel():
                counts[b] += 1
            total, maps[i, j] = 0, []
            for c in spread_loops(counts, most):
                total += c
                maps[i, j].append(int(min(total * (16383 / (ky * kx)), 16383)))
    out = np.zeros(plane.shape)
    for y in range(ny):
        for x in range(nx):
            (cy, oy), (cx, ox) = divmod(y + ky // 2, ky), divmod(x + kx // 2, kx)
            at = lambda i, j: maps[min(max(i, 0), ty - 1), min(max(j, 0), tx - 1)][bins[y, x]]  # noqa: B023, E731
            wy, wx = oy / ky, ox / kx
            out[y, x] = (1 - wy) * ((1 - wx) * at(cy - 1, cx - 1) + wx * at(cy - 1, cx)) + wy * ((1 - wx) * at(cy, cx - 1) + wx * at(cy, cx))
    low, high = out.min(), out.max()
    return np.zeros(plane.shape, int) if high == low else np.trunc((out - low) / (high - low) * 65535).astype(int)


@pytest.mark.parametrize("most", [1, 2, 5, 40])
def test_clipped_histograms(most):
    rng = np.random.default_rng(most)
    for _ in range(20):
        counts = rng.multinomial(rng.integers(0, 900), rng.dirichlet(np.full(256, 0.1)))
        got = lc.clipped_histogram(counts, most)
        assert got.tolist() == spread_loops(counts.tolist(), most) and got.max() <= most


@pytest.mark.parametrize(("shape", "kernel", "limit"), [((2, 24, 24), (7, 5), 0.05), ((2, 20, 17), (6, 6), 0.5), ((1, 16, 16), None, 0.01)])
def test_equalisation_equals_plain_loops(spark, shape, kernel, limit):
    a = np.random.default_rng(4).integers(0, 5000, shape) + 900 * np.arange(shape[2])
    if shape[0] > 1:
        a[1] = 70  # no contrast
    got = dense(lc.local_equalisation(table(spark, a), shape[1:], limit, kernel), shape, "equalised")
    ky, kx = kernel or (2, 2)
    want = np.stack([equalised_loops(p, limit, ky, kx) for p in a])
    assert np.abs(got - want).max() <= 1 and (got == want).mean() > 0.999  # one grey of 65,535 where a quotient ends on a whole number


def test_equalisation_of_the_view(spark):
    v = fx.voxels(spark, "/root/testdata/sf0.001").where("t = 2")
    got = dense(lc.local_equalisation(v, (fx.NY, fx.NX), 0.05, (7, 5)), (fx.NZ, fx.NY, fx.NX), "equalised")
    a = dense(v, got.shape, "value")
    assert np.abs(got - np.stack([equalised_loops(p, 0.05, 7, 5) for p in a])).max() <= 1


def haar_plane(p):
    """One level of a plane with even sides by matrices."""
    m = lambda n: np.vstack([np.kron(np.eye(n // 2), [1, 1]), np.kron(np.eye(n // 2), [1, -1])]) / np.sqrt(2)
    w = m(p.shape[0]) @ p @ m(p.shape[1]).T
    y, x = p.shape[0] // 2, p.shape[1] // 2
    return w[:y, :x], w[:y, x:], w[y:, :x], w[y:, x:]


def test_haar_levels(spark):
    a = np.random.default_rng(7).integers(0, 60000, (1, 16, 24))
    rows = lc.haar_split(table(spark, a), 2)
    ll, *first = haar_plane(a[0].astype(float))
    second = haar_plane(ll)
    for level, band, want in [(1, b, w) for b, w in zip(("lh", "hl", "hh"), first)] + [(2, b, w) for b, w in zip(lc.BANDS, second)]:
        got = dense(rows.where(f"level = {level} AND band = '{band}'"), (1, *want.shape), "value")
        assert np.allclose(got[0], want), (level, band)
    assert rows.count() == a.size


@pytest.mark.parametrize("shape", [(2, 16, 16), (1, 13, 7), (1, 1, 5)])
def test_reconstruction_is_perfect(spark, shape):
    a = np.random.default_rng(8).integers(0, 60000, shape)
    got = dense(lc.haar_join(lc.haar_split(table(spark, a), 3), 3, shape[1:]), shape, "value")
    assert np.allclose(got, a, atol=1e-6)


@pytest.mark.parametrize("noise", [0, 1])
def test_wavelet_background(spark, noise):
    a = np.random.default_rng(9).integers(0, 3000, (2, 16, 24))
    got = lc.wavelet_background(table(spark, a), 5.0, noise).cache()
    mean = lambda p, n: np.kron(p.reshape(p.shape[0] // n, n, p.shape[1] // n, n).mean((1, 3)), np.ones((n, n)))
    for z, p in enumerate(a.astype(float)):
        back = smooth_plane(mean(p, 4), 8.0)  # 5 places take 3 levels
        want = np.maximum(p - back, 0)
        if noise:
            fine = np.maximum(p - mean(p, 2), 0)
            want = np.maximum(want - np.minimum(fine, fine.mean() + 2 * fine.std()), 0)
        assert np.allclose(dense(got, a.shape, "background")[z], back) and np.allclose(dense(got, a.shape, "corrected")[z], want)
    assert got.unpersist() is not None
