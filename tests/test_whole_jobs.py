"""Queries that must do the whole job, against plain Python and NumPy on the smallest tables."""

import math

import numpy as np
import pytest

from tetraframe.plans import fixtures as fx
from tetraframe.plans import registry
from tetraframe.plans.book import rounded
from tetraframe.streaming.speeds import streamed_speeds

SF = "/root/testdata/sf0.001"


def test_whole_sort(spark):
    rows = fx.spots(spark, SF).collect()
    found = registry.QUERIES["srt2_lexsort"](spark, SF)
    assert found.collect() == sorted(rows, key=lambda r: (r["frame"], -r["position_x"], r["id"])) and len(rows) > 100


@pytest.fixture(scope="module")
def volumes(spark):
    """The voxel view as one array (t, z, y, x)."""
    p = fx.voxels(spark, SF).select("t", "z", "y", "x", "value").toPandas()
    out = np.zeros((fx.NT, fx.NZ, fx.NY, fx.NX))
    out[p["t"] - 1, p["z"], p["y"], p["x"]] = p["value"]
    return out


def mirrored(v, i):
    """Sample i of a line whose ends are mirrors, not doubled."""
    i = abs(i) % (2 * len(v) - 2)
    return v[i if i < len(v) else 2 * len(v) - 2 - i]


def coefficients(v):
    """B-spline coefficients of a line: the filter's pole forward, then backward."""
    z, n = math.sqrt(3) - 2, len(v)
    up = [sum(mirrored(v, -k) * z**k for k in range(60))]
    for k in range(1, n):
        up.append(v[k] + z * up[-1])
    down = [z / (z * z - 1) * (z * up[n - 2] + up[n - 1])]
    for k in range(n - 2, -1, -1):
        down.append(z * (down[-1] - up[k]))
    return [6 * x for x in down[::-1]]


def basis(d):
    d = abs(d)
    return 2 / 3 - d * d + d**3 / 2 if d < 1 else (2 - d) ** 3 / 6 if d < 2 else 0.0


def cubic(v, m):
    """One line of samples resampled to m by a cubic spline, smoothed first if it shrinks."""
    n = len(v)
    if m < n:
        sigma = (n / m - 1) / 2
        r = int(4 * sigma + 0.5)
        g = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-r, r + 1)]
        v = [sum(w * mirrored(v, i + k - r) for k, w in enumerate(g)) / sum(g) for i in range(n)]
    at, c = [(i + 0.5) * n / m - 0.5 for i in range(m)], coefficients(v)
    return [sum(basis(x - k) * mirrored(c, k) for k in range(math.floor(x) - 1, math.floor(x) + 3)) for x in at]


def linear(v, m):
    """One line of samples interpolated at pixel centres, nothing beyond its ends."""
    return np.interp((np.arange(m) + 0.5) * len(v) / m + 0.5, np.arange(len(v) + 2), [0, *v, 0])


def planes(volume, my, mx):
    return np.apply_along_axis(cubic, 1, np.apply_along_axis(cubic, 2, volume, mx), my)


def by_place(spark, name):
    p = registry.QUERIES[name](spark, SF).toPandas()
    assert not p.duplicated(["t", "z", "y", "x"]).any()
    return {k: g for k, g in p.groupby("t")}


@pytest.mark.parametrize("name", ["vol3_isotropic_cubic", "vol6_export_raw_iso"])
def test_all_time_points_are_resampled(spark, volumes, name):
    found = by_place(spark, name)
    assert sorted(found) == list(range(1, fx.NT + 1))
    for t, v in enumerate(volumes, 1):
        if name.startswith("vol3"):
            want = np.clip(np.apply_along_axis(cubic, 0, planes(v, 18, 18), 24), v.min(), v.max())
        else:
            p = np.clip(planes(v, 12, 12), v.min(), v.max())
            want = np.clip(np.apply_along_axis(linear, 0, p, 20), p.min(), p.max())
        want = np.trunc(np.round(want, 6))
        g = found[t]
        assert len(g) == want.size
        got = np.full(want.shape, np.nan)
        got[g["z"], g["y"], g["x"]] = g["value"]
        assert np.allclose(got, want, atol=1e-6)


def test_all_time_points_are_decoded_and_stacked(spark, volumes):
    for name, want in (("src5_scan_tiff_volume", volumes), ("src13_stack_timepoints", volumes[:, ::2, ::2, ::2])):
        p = registry.QUERIES[name](spark, SF).toPandas()
        got = np.full(want.shape, np.nan)
        got[p["t"] - (name[:4] == "src5"), p["z"], p["y"], p["x"]] = p["value"]
        assert len(p) == want.size and (got == want).all()


def test_all_tracks_are_assigned(spark):
    rows = fx.spots(spark, SF).collect()
    own = {r["id"]: r["track_id"] for r in rows}
    tracked = [t for t in own.values() if t is not None]
    assert {r["id"]: r["track_id"] for r in registry.QUERIES["jn1_assign_by_id"](spark, SF).collect()} == own
    assert tuple(registry.QUERIES["jn1_assign_stats"](spark, SF).first()) == (len(rows), len(tracked), len(set(tracked)))
    want = dict.fromkeys(own)
    frames = {}
    for r in rows:
        frames.setdefault(r["frame"], []).append(r)
    # One spot a track and frame: its centroid is the spot, moved.
    for r in sorted((r for r in rows if r["track_id"] is not None), key=lambda r: -r["track_id"]):
        at = (r["position_x"] + 1.5, r["position_y"] - 1.0, r["position_z"] + 0.5)
        near = min((math.dist(at, (s["position_x"], s["position_y"], s["position_z"])), s["id"]) for s in frames[r["frame"]])
        if near[0] <= 60:
            want[near[1]] = r["track_id"]
    found = registry.QUERIES["jn2_assign_nearest"](spark, SF).collect()
    assert len(found) == len(rows) and {r["id"]: r["track_id"] for r in found} == want


def test_streamed_speeds_over_triggers(spark, tmp_path):
    found = rounded(streamed_speeds(spark, fx.spots(spark, SF).where("track_id IS NOT NULL"), str(tmp_path))).drop("late").collect()
    assert len([x for x in (tmp_path / "state" / "commits").iterdir() if x.name.isdigit()]) == 3
    want = registry.QUERIES["win1_step_speed"](spark, SF).where("track_id IS NOT NULL").collect()
    assert len(found) == len(want) and {tuple(r) for r in found} == {tuple(r) for r in want}


def test_rows_that_come_too_late_are_marked():
    """A track's earlier frame after a later one: handed on without a speed, and the state stays."""
    import pandas as pd

    from tetraframe.streaming.speeds import _speeds

    class State:
        exists, kept = False, None

        @property
        def get(self):
            return self.kept

        def update(self, value):
            self.exists, self.kept = True, value

    rows = lambda *r: iter([pd.DataFrame(list(r), columns=["track_id", "frame", "position_x", "position_y", "position_z", "id"])])
    state = State()
    first = pd.concat(_speeds((1,), rows((1, 5, 0.0, 0.0, 0.0, 10), (1, 3, 4.0, 0.0, 0.0, 11)), state))
    assert first[["frame", "late"]].values.tolist() == [[3, False], [5, False]] and first["step_speed"].tolist()[1] == 2.0
    then = pd.concat(_speeds((1,), rows((1, 4, 9.0, 0.0, 0.0, 12), (1, 6, 3.0, 0.0, 0.0, 13)), state))
    assert then[["frame", "late"]].values.tolist() == [[4, True], [6, False]] and then["step_speed"].isna().tolist() == [True, False]
    assert then["step_speed"].tolist()[1] == 3.0 and state.kept[0] == 6
    assert pd.concat(_speeds((1,), rows((1, 2, 0.0, 0.0, 0.0, 14)), state))["late"].tolist() == [True] and state.kept[0] == 6
