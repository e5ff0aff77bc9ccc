"""Edge cases and kernels against plain Python and NumPy."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tetraframe.operators import filters as fl
from tetraframe.operators import geometry as geo
from tetraframe.operators import image as im
from tetraframe.operators import ingression as ing
from tetraframe.operators import joins as jn
from tetraframe.operators import kinematics as kin
from tetraframe.operators import labels as lb
from tetraframe.operators import nearest
from tetraframe.operators import reports as rep
from tetraframe.operators import volumes as vo
from tetraframe.sources import readers as rd
from tetraframe.sources import writers as wr

SPOTS = "track_id long, frame int, position_x double, position_y double, position_z double, id long"
VOXELS = "t int, z int, y int, x int, value int, label int"


def spots(spark, rows):
    return spark.createDataFrame([(t, f, float(x), 0.0, 0.0, i) for i, (t, f, x) in enumerate(rows)], SPOTS)


def voxels(spark, values, labels=None):
    values = np.asarray(values)
    labels = np.zeros_like(values) if labels is None else np.asarray(labels)
    return spark.createDataFrame([(1, *map(int, i), int(v), int(labels[i])) for i, v in np.ndenumerate(values)], VOXELS)


def test_speed_needs_a_frame_between_and_a_track(spark):
    df = spots(spark, [(1, 0, 0), (1, 2, 4), (1, 2, 9), (2, 5, 1), (None, 0, 0), (None, 1, 5)])
    got = {r["id"]: r["step_speed"] for r in kin.step_speed(df).collect()}
    assert got == {0: None, 1: 2.0, 2: None, 3: None, 4: None, 5: None}


def test_flags_of_length_speed_and_both(spark):
    df = spots(spark, [(1, 0, 0), (1, 1, 1), (1, 2, 2), (2, 0, 0), (2, 1, 1), (3, 0, 0), (3, 1, 50), (4, 0, 0), (4, 1, 99), (4, 2, 100), (None, 0, 0)])
    got = {r["track_id"]: (r["filtered_out"], r["filter_reason"]) for r in fl.filter_flags(df, 3, 10.0).collect()}
    assert got == {1: (False, ""), 2: (True, "min_length"), 3: (True, "min_length+max_speed"), 4: (True, "max_speed"), None: (False, "")}
    assert {r["filter_reason"] for r in fl.filter_flags(df, 3, 10.0, True).where("track_id = 2").collect()} == {""}


def test_single_row_track_and_speed_limit(spark):
    df = spots(spark, [(1, 0, 0), (2, 0, 0), (2, 1, 1)])
    assert fl.max_speed(df, 5.0).select("track_id").distinct().count() == 1
    assert fl.max_speed(df, 5.0, "zero").select("track_id").distinct().count() == 2


@pytest.mark.parametrize("op", [fl.tracked_only, kin.step_speed, kin.first_point, kin.last_point_extension, rep.track_summary, lambda d: fl.filter_flags(d, 3, 1.0), lambda d: kin.radial_motion(d, (0, 0, 0)), kin.straightness, kin.selection_metrics])
def test_empty_tables(spark, op):
    assert op(spots(spark, []).where("id < 0")).count() == 0


def onset(values):
    """The state machine of onset and longest run."""
    run = longest = 0
    start = None
    for frame, v in values:
        if v is not None and v < 0:
            if start is None:
                start = frame
            run += 1
            longest = max(longest, run)
        else:
            if run < 3:
                start = None
            run = 0
    return longest, start


def test_onset_against_state_machine(spark):
    rng = random.Random(5)
    tracks = {t: [(f, rng.choice([-1.0, -2.0, 1.0, None, -1.0])) for f in range(rng.randint(1, 14))] for t in range(400)}
    rows = [(t, f, 0.0, 0.0, 0.0, t * 100 + f, v) for t, vs in tracks.items() for f, v in vs]
    df = spark.createDataFrame(rows, SPOTS + ", radial_velocity_smooth double")
    got = {r["track_id"]: (r["track_sustained_inward"], r["ingression_onset_frame"]) for r in ing.inward_runs(df).collect()}
    for t, vs in tracks.items():
        longest, start = onset(vs)
        assert got[t][0] == longest
        inward = [f for f, v in vs if v is not None and v < 0]
        if not inward:
            assert got[t][1] is None
        elif start is not None:
            assert got[t][1] == start


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-5, 5)), min_size=1, max_size=9), st.integers(1, 8))
def test_smooth_array_against_convolution(spark, values, k):
    row = spark.createDataFrame([(values,)], "a array<double>").select(kin.smooth_array(F.col("a"), k).alias("s")).first()["s"]
    a = np.array([np.nan if v is None else v for v in values])
    known = ~np.isnan(a)
    total = np.convolve(np.where(known, a, 0), np.ones(k), "same")
    count = np.convolve(known.astype(float), np.ones(k), "same")
    assert len(row) == max(len(a), k)
    for got, t, c in zip(row, total, count):
        assert got is None if c < 0.5 else abs(got - t / round(c)) < 1e-9


def test_nearest_assignment_ties_and_conflicts(spark):
    s = spots(spark, [(None, 0, 0), (None, 0, 10), (None, 0, 20), (7, 0, 30)])
    t = spots(spark, [(2, 0, 1), (1, 0, 1), (3, 0, 15), (4, 0, 30.5), (5, 0, 99)])
    got = {r["id"]: r["track_id"] for r in jn.assign_nearest(s, t, 5.0).collect()}
    assert got == {0: 1, 1: 3, 2: None, 3: 7}


def test_nearest_distance_against_brute_force(spark):
    p = np.random.default_rng(2).normal(size=(300, 3)) ** 3
    df = spark.createDataFrame([(i, 0, *map(float, x)) for i, x in enumerate(p)], "id long, frame int, position_x double, position_y double, position_z double")
    d = np.linalg.norm(p[:, None] - p[None], axis=2)
    np.fill_diagonal(d, np.inf)
    got = {r["id"]: r["distance"] for r in jn.nearest_distance(df).collect()}
    assert len(got) == 300 and max(abs(got[i] - v) for i, v in enumerate(d.min(1))) < 1e-9


def test_join_by_null_ids(spark):
    s = spark.createDataFrame([(1, None, 0.0, 0.0, 0.0), (1, 5, 0.0, 0.0, 0.0)], "frame int, id long, position_x double, position_y double, position_z double")
    t = spark.createDataFrame([(1, None, 9), (1, 5, 8), (1, 5, 7)], "frame int, id long, track_id long")
    assert sorted(str(r["track_id"]) for r in jn.assign_by_id(s, t).collect()) == ["7", "8", "None"]
    assert sorted(str(r["track_id"]) for r in jn.assign_by_id(s, t, True).collect()) == ["7", "8", "9"]


def test_rotations():
    for u, v in (((1, 2, 3), (0, -1, 0)), ((0, 1, 0), (0, 1, 0)), ((0, 1, 0), (0, -1, 0))):
        r = geo.rotation_matrix(u, v)
        assert np.allclose(r @ r.T, np.eye(3)) and np.isclose(np.linalg.det(r), 1)
    assert np.allclose(geo.rotation_matrix((1, 2, 3), (0, -1, 0)) @ np.array([1, 2, 3]) / 14**0.5, [0, -1, 0])


def test_sphere_is_recovered(spark):
    g = np.random.default_rng(0).normal(size=(4000, 3))
    p = np.array([5, -7, 11]) + 40 * g / np.linalg.norm(g, axis=1)[:, None]
    p = p[p[:, 2] > 11]
    c, r, e = geo.sphere_nls(p)
    assert np.allclose(c, [5, -7, 11]) and np.isclose(r, 40) and e < 1e-6
    df = spark.createDataFrame([tuple(map(float, x)) for x in p], "position_x double, position_y double, position_z double")
    row = geo.fit_sphere(df).first()
    assert abs(row["radius"] - 40) < 1.5


def test_components_and_small_ones(spark):
    mask = np.zeros((3, 4, 5), bool)
    mask[0, 0, :2] = mask[1, 0, 0] = mask[2, 3, 4] = mask[2, 2, 3] = True
    c = lb.components6(mask)
    assert c[0, 0, 0] == c[0, 0, 1] == c[1, 0, 0] and c.max() == 3
    got = lb.without_small_components(voxels(spark, mask, mask), 2)
    assert got.where("keep").count() == 3


def test_components_match_flood_fill():
    mask = np.random.default_rng(1).random((6, 7, 8)) < 0.4
    c = lb.components6(mask)
    seen = {}
    for start in map(tuple, np.argwhere(mask)):
        if start in seen:
            continue
        todo, seen[start] = [start], len(seen)
        while todo:
            p = todo.pop()
            for axis in range(3):
                for d in (-1, 1):
                    q = list(p)
                    q[axis] += d
                    q = tuple(q)
                    if all(0 <= q[i] < mask.shape[i] for i in range(3)) and mask[q] and q not in seen:
                        seen[q] = seen[start]
                        todo.append(q)
    pairs = {(seen[p], int(c[p])) for p in map(tuple, np.argwhere(mask))}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_empty_mask_gives_zeros(spark):
    row = lb.segmentation_metrics(voxels(spark, np.ones((2, 3, 3)))).first().asDict()
    assert all(v == 0 for k, v in row.items() if k != "t")


def test_touching_labels(spark):
    lab = np.zeros((1, 2, 6), int)
    lab[0, :, 0], lab[0, :, 1], lab[0, :, 4] = 1, 2, 3
    assert abs(lb.touching_fraction(voxels(spark, lab, lab)).first()["touching"] - 2 / 3) < 1e-12


def test_constant_volume_is_not_changed(spark):
    v = voxels(spark, np.full((4, 6, 6), 300))
    assert vo.depth_correction(v).where("corrected <> value").count() == 0
    assert vo.planar_correction(v, 2.0).where("abs(corrected - value) > 1").count() == 0
    assert vo.local_noise(v).where("noise > 1e-6").count() == 0
    assert vo.isotropic(v, (4, 6, 6), (2.0, 1.0, 1.0), 1.0).where("abs(value - 300) > 1e-6").count() == 0


def test_local_noise_against_plain_loops(spark):
    a = np.random.default_rng(3).integers(0, 99, (1, 9, 8))
    p = np.pad(a[0].astype(float), 1, mode="symmetric")
    got = {(r["y"], r["x"]): r["noise"] for r in vo.local_noise(voxels(spark, a), 3).collect()}
    assert all(abs(v - p[y : y + 3, x : x + 3].std()) < 1e-6 for (y, x), v in got.items())


def test_splines_pass_through_samples_and_keep_polynomials():
    w = vo.spline_weights(24, 24)
    assert np.allclose(w, np.eye(24))
    w = vo.spline_weights(30, 75)
    x = (np.arange(75) + 0.5) * 0.4 - 0.5
    assert np.allclose(w.sum(1), 1)
    inside = slice(30, 45)  # far from the mirrored ends a cubic is kept
    assert np.allclose((w @ (np.arange(30) ** 3 / 100))[inside], (x**3 / 100)[inside], atol=1e-3)
    assert np.allclose(vo.spline_weights(30, 10).sum(1), 1) and np.allclose(vo.spline_weights(4, 8, 1)[0], [0.75, 0.25, 0, 0])


def test_slices_beyond_the_ends_count_as_zero(spark):
    v = voxels(spark, np.array([100, 200]).reshape(2, 1, 1))
    got = {r["z"]: r["value"] for r in vo.resliced_linear(v, 2, 4, "zero").collect()}
    assert got == {0: 75.0, 1: 125.0, 2: 175.0, 3: 150.0}
    got = {r["z"]: r["value"] for r in vo.resliced_linear(v, 2, 4, "mirror").collect()}
    assert got == {0: 125.0, 1: 125.0, 2: 175.0, 3: 175.0}


def test_damped_correction_by_hand(spark):
    # Levels 100, 100, 100, 100, 10 by slice; window 1 keeps them. Target 100, floor 25: the dim slice gets 1 + 9 * 0.4, held at 2.
    v = voxels(spark, np.array([100, 100, 100, 100, 10]).reshape(5, 1, 1) * np.ones((5, 3, 3)))
    got = {r["z"]: round(r["scale"], 6) for r in vo.depth_correction_damped(v, window=1, most=9.0).collect()}
    assert got == {0: 1, 1: 1, 2: 1, 3: 1, 4: 4.6}
    assert vo.depth_correction_damped(v, window=1).agg(F.max("scale")).first()[0] == 2.0


def test_scores_of_inward_tracks_by_hand(spark):
    cols = "track_id long, frame int, id long, radial_dist_to_center double, radial_velocity_smooth double, track_median_radial_vel double, track_mean_radial_vel double, track_inward_fraction double"
    df = spark.createDataFrame([(1, f, f, 20.0 - f, -1.0, -1.0, -1.0, 0.9) for f in range(10)], cols)
    r = ing.flag_ingressing(df, -0.5, 5, 0.5).first()
    # Velocity one threshold beyond it: 0.5; inward share 0.9; run 10 of 10; 9 inward over 10 rows.
    assert r["ingressing"] and abs(r["ingression_score"] - (0.30 * 0.5 + 0.20 * 0.9 + 0.25 * 1.0 + 0.25 * 0.9)) < 1e-12
    few = spark.createDataFrame([(0.25,), (0.75,)], "v double")
    assert ing.otsu_threshold(few).first()[0] == 0.5  # not held below zero
    assert ing.otsu_threshold(few.where("v > 9")).first()[0] == -0.5


def test_minutes_count_rows(spark):
    df = spots(spark, [(1, f, f) for f in (0, 1, 2, 9)])
    assert kin.selection_metrics(df, 1, 1, 1.0, 30.0).first()["minutes"] == 2.0
    assert sorted(r["speed"] for r in kin.step_speeds(df, 1, 1, 1.0, 30.0).collect()) == [2.0, 2.0]


def test_cap_guess_by_hand(spark):
    s = spark.createDataFrame([("upper", 0.0, 0.0, 10.0), ("upper", 6.0, 0.0, 8.0), ("upper", 0.0, 6.0, 8.0)], "side string, u double, v double, w double")
    r = geo.cap_guess(s).first()
    a = (4.0**2 + 2.0**2) ** 0.5  # from the mean (2, 2)
    assert abs(r["cap_base_radius"] - a) < 1e-9 and r["cap_height"] == 2.0 and abs(r["radius"] - (a * a + 4) / 4) < 1e-9
    assert (r["center_u"], r["center_v"]) == (2.0, 2.0) and abs(r["center_w"] - (10 - r["radius"])) < 1e-9


def test_time_points_and_orders_of_names(spark):
    names = {"t0001_Channel 2.tif": 1, "T012_decon.tif": 12, "tp001.tif": 1, "run--C00--T00003.h5": 3, "embryo_001.tif": 1, "a12b7.tif": 12, "x--CT5.h5": 5, "plate3_t7.tif": 7}
    got = {r["name"]: r["timepoint"] for r in rd.extract_timepoints(spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    assert got == names
    order = [r["name"] for r in fl.natural_sort_files(spark.createDataFrame([("z10.tif",), ("a2_x.tif",), ("T012_decon.tif",), ("none.tif",), ("b1c3.zarr",)], "name string")).orderBy("place").collect()]
    assert order == ["a2_x.tif", "b1c3.zarr", "z10.tif", "T012_decon.tif", "none.tif"]


def test_colours_and_sliders_by_hand(spark):
    from tetraframe.functions import scalars as sc

    df = spark.createDataFrame([(0.0,), (0.999,), (1.0,), (None,)], "x double")
    assert [r[0] for r in df.select(sc.lut_value(F.col("x"), F.lit(0.0), F.lit(1.0))).collect()] == [5, 254, 255, 20]
    assert [r[0] for r in df.select(sc.lut_diverging(F.col("x"), F.lit(0.5))).collect()] == [130, 255, 255, 130]
    top, step = sc.slider_bounds(F.col("x"))
    got = spark.createDataFrame([(0.2,), (4.0,), (10.0,), (100.0,)], "x double").select(top, step).collect()
    assert [tuple(round(v, 6) for v in r) for r in got] == [(1.1, 0.1), (4.4, 0.1), (11.0, 0.5), (120.0, 1.0)]


def test_axes_of_an_empty_table_stay(spark):
    assert lb.axis_fixed(voxels(spark, np.zeros((1, 1, 1))).where("z > 5")).count() == 0


def test_depth_parts_count_centroids(spark):
    slices = spark.createDataFrame([(1, z, n) for z, n in enumerate((1, 2, 0, 0, 3, 0, 4, 5))], "t int, z int, n_centroids long")
    assert tuple(lb.depth_thirds(slices, 8).first()) == (1, 3, 3, 9, 15, 3.0)


def test_shading_gain_flattens_a_gradient(spark):
    y, x = np.mgrid[:16, :16]
    v = voxels(spark, np.broadcast_to(200 + 10 * x + 0 * y, (2, 16, 16)))
    before, after = (v.groupBy("x").agg(F.avg("value").alias("m")), vo.planar_correction(v, 3.0).groupBy("x").agg(F.avg("corrected").alias("m")))
    spread = lambda d: d.agg(F.stddev_pop("m")).first()[0]
    assert spread(after) < 0.4 * spread(before)


def test_z_frequency_of_constant_columns_is_zero(spark):
    assert im.z_frequency(voxels(spark, np.full((8, 3, 3), 7)), (8, 3, 3)).first()["z_frequency"] == 0


def test_z_frequency_keeps_the_mean_and_skips_dead_columns(spark):
    a = np.full((8, 4, 4), 5)
    a[:, 2, 2] = [0, 9, 0, 9, 0, 9, 0, 9]
    power = np.abs(np.fft.rfft(a[:, 2, 2])) ** 2
    got = im.z_frequency(voxels(spark, a), (8, 4, 4), 3).first()["z_frequency"]
    assert abs(got - power[1:].sum() / power.sum()) < 1e-12  # a quarter of 5 frequencies is 1


def test_contrast_spans_zeros(spark):
    a = np.zeros((2, 4, 4), int)
    a[0, 0, 0], a[0, 0, 2] = 256, 128
    assert tuple(im.contrast_percentiles(voxels(spark, a)).first()) == (128.0, 255.0)
    assert tuple(im.contrast_percentiles(voxels(spark, np.full((2, 2, 2), 9))).first()) == (9.0, 9.0)


def test_crop_outside_is_refused(spark):
    with pytest.raises(ValueError):
        fl.crop_roi(voxels(spark, np.zeros((1, 4, 4))), 2, 2, 3, 3, 4, 4)


def test_samples_are_stable_and_bounded(spark):
    df = spots(spark, [(t, f, 0) for t in range(30) for f in range(3)])
    a, b = (sorted(r["id"] for r in fl.subsample_tracks(df, 7).collect()) for _ in range(2))
    assert a == b and len(a) == 21
    drawn = spark.createDataFrame([(t,) for t in range(25)], "track_id long")
    assert {r["track_id"] for r in fl.sample_without_repeat(df, drawn, 9).collect()} <= set(range(25, 30))


def test_formats_config_channels():
    assert wr.parse_formats("bdv, tif") == ["tiff"] and wr.parse_formats(["bdv", " TIF", "odd"]) == ["bdv", "tiff"]
    assert wr.parse_formats("All") == ["bdv", "tiff"] and wr.parse_formats(["odd"]) == ["tiff"] and wr.parse_formats("xml") == ["bdv"]
    with pytest.raises(ValueError):
        rd.resolve_channel(0, 2)
    with pytest.raises(ValueError):
        rd.load_config('{"voxel_size": [0, 1, 1]}')
    with pytest.raises(ValueError):
        rd.image_layout((40, 1, 1, 1), False)


def test_missing_core_column_is_an_error(spark, tmp_path):
    (tmp_path / "s.csv").write_text("ID,POSITION_X\n1,2\n")
    with pytest.raises(ValueError):
        rd.load_spots(spark, str(tmp_path / "s.csv"))


def test_radial_windows_share_one_exchange(spark):
    plan = kin.radial_motion(fl.tracked_only(spots(spark, [(1, 0, 0)])), (0, 0, 0))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(track_id") <= 2


@settings(max_examples=12, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3).map(float), st.floats(-1e3, 1e3)), max_size=30), st.lists(st.floats(0, 1), min_size=1, max_size=3))
def test_quantiles_are_exact(spark, values, shares):
    from tetraframe.functions.quantiles import exact_quantiles

    got = exact_quantiles(spark.createDataFrame([(v,) for v in values], "v double"), "v", shares).first()
    known = [v for v in values if v is not None]
    assert got["n"] == len(known)
    want = np.quantile(known, shares) if known else [None] * len(shares)
    assert got["q"] == want if not known else np.allclose(got["q"], want, atol=1e-9)


def test_quantiles_beyond_the_sketch(spark):
    from tetraframe.functions.quantiles import exact_quantiles

    df = spark.range(60_000).select((F.pmod(F.col("id") * 7919, F.lit(60_013)) / 7.0).alias("v")).unionByName(spark.range(30_000).select(F.lit(100.0).alias("v")))
    shares = [0.0, 0.001, 0.25, 0.5, 0.9999, 1.0]
    want = np.quantile(df.toPandas()["v"], shares)
    assert np.allclose(exact_quantiles(df, "v", shares, 200).first()["q"], want, rtol=0, atol=1e-9)


def test_nearest_in_a_dense_cluster_and_a_wide_cloud(spark):
    rng = np.random.default_rng(5)
    p = np.vstack([rng.normal(0, 1e-3, (300, 3)), rng.uniform(-1e3, 1e3, (60, 3)), np.zeros((3, 3))])
    df = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(p)], "id long, position_x double, position_y double, position_z double")
    d = np.linalg.norm(p[:, None] - p[None], axis=2)
    np.fill_diagonal(d, np.inf)
    got = {r["id"]: r["distance"] for r in jn.nearest_distance(df).collect()}
    assert len(got) == len(p) and np.allclose([got[i] for i in range(len(p))], d.min(1))


PLACES = ["position_x", "position_y", "position_z"]


def taken_by_hand(queries, points, tolerance):
    """{(frame, id): track} by all pairs. queries: (track, frame, place), points: (id, frame, place)."""
    out = {}
    for track, frame, p in sorted(queries, key=lambda q: q[0]):
        near = [(float(np.sqrt((p[0] - r[0]) * (p[0] - r[0]) + (p[1] - r[1]) * (p[1] - r[1]) + (p[2] - r[2]) * (p[2] - r[2]))), i) for i, f, r in points if f == frame]
        if near and min(near)[0] <= tolerance:
            out.setdefault((frame, min(near)[1]), track)
    return out


@pytest.mark.parametrize("leaf", [20, 100, 20_000])
def test_assignment_by_leaves(spark, leaf):
    """Whole numbers for ties, a place with many of both, lone ones, a frame far beyond the others, rows without a frame or place."""
    g = np.random.default_rng(7)
    at = lambda n: [tuple(map(float, x)) for x in g.integers(0, 30, (n, 3)) * (1, 1, 3)]
    points = [(i, int(f), p) for i, (f, p) in enumerate(zip(g.choice([-2, 0, 1, 9_000], 600, p=[0.02, 0.08, 0.6, 0.3]), at(600)))]
    points += [(i, 1, (5.0, 5.0, 6.0)) for i in range(1_200, 900, -1)] + [(2_000, 1, (500.0, 0.0, 0.0)), (2_001, 5, (0.0, 0.0, 0.0))]
    queries = [(i, int(f), p) for i, (f, p) in enumerate(zip(g.choice([-2, 0, 1, 2, 9_000], 600), at(600)))]
    queries += [(i, 1, (5.0, 5.0, 6.0)) for i in range(1_200, 900, -1)] + [(3_000, 1, (500.0, 0.0, 4.0)), (3_001, 1, (500.0, 4.5, 0.0)), (3_002, 2, (0.0, 0.0, 0.0))]
    odd = [(4_000, None, (5.0, 5.0, 6.0)), (4_001, 1, (None, 5.0, 6.0)), (4_002, 1, (float("nan"), 5.0, 6.0)), (4_003, 1, (float("inf"), 5.0, 6.0))]
    table = lambda rows, key: spark.createDataFrame([(k, f, *p) for k, f, p in rows], f"{key} long, frame int, " + ", ".join(f"{n} double" for n in PLACES)).repartition(3)
    for tolerance in (0.0, 3.0, 8.0):
        found = nearest.taken_within(table(queries + odd, "track_id"), table(points + odd, "id"), PLACES, tolerance, leaf)
        want = taken_by_hand(queries, points, tolerance)
        assert {(r["frame"], r["id"]): r["track_id"] for r in found.collect()} == want and found.count() == len(want) > 3
    none = table(queries, "track_id").limit(0)
    assert nearest.taken_within(none, table(points, "id"), PLACES, 3.0, leaf).count() == nearest.taken_within(table(queries, "track_id"), table(points, "id").limit(0), PLACES, 3.0, leaf).count() == 0


def test_assignment_in_a_crowded_frame_compares_few(spark, monkeypatch):
    g, n = np.random.default_rng(3), 20_000
    q, p, pairs = g.random((n, 3)) * 100, g.random((n, 3)) * 100, 0
    plain = nearest._length

    def counted(parts):
        nonlocal pairs
        pairs += parts[0].size
        return plain(parts)

    monkeypatch.setattr(nearest, "_length", counted)
    d, at = nearest.first_within(q, p, np.full(n, 60.0))
    assert pairs < n * n / 5
    some = slice(0, n, 400)
    assert (at[some] == ((q[some, None] - p[None]) ** 2).sum(2).argmin(1)).all() and (d < 60).all()
    monkeypatch.undo()
    s = spark.createDataFrame([(None, 0, *map(float, x), i) for i, x in enumerate(p[:2_000])], SPOTS)
    found = jn.assign_nearest(s, s.withColumn("track_id", F.col("id")), 60.0)
    # No rows for each of a centroid's cells.
    assert "Generate" not in found._jdf.queryExecution().toString()
    assert all(r["track_id"] == r["id"] for r in found.collect())


def test_boundaries_by_hand():
    a = np.zeros((1, 3, 6), np.int32)
    a[0, :, 0:2], a[0, :, 4:6] = 1, 2
    assert lb.boundaries(a)[0, 1].tolist() == [False, False, True, True, False, False]  # background beside labels
    a[0, :, 2:4] = 1
    assert lb.boundaries(a)[0, 1].tolist() == [False, False, False, True, True, False]  # both sides of two labels
    assert lb.boundaries(a, 2)[0, 1].tolist() == [False, False, True, True, True, True]


def test_nearest_by_a_tree_of_leaves(spark):
    """A dense cluster, a tenth of outliers, equal places and points without one, in leaves of 40 points."""
    from tetraframe.operators import nearest

    rng = np.random.default_rng(12)
    p = np.vstack([rng.normal(0, 1e-3, (900, 3)), rng.uniform(-1e3, 1e3, (100, 3)), np.full((5, 3), 7.0)])
    rows = [(i, *map(float, x)) for i, x in enumerate(p)] + [(2000, None, 0.0, 0.0), (2001, float("nan"), 0.0, 0.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    d = np.linalg.norm(p[:, None] - p[None], axis=2)
    np.fill_diagonal(d, np.inf)
    got = {r["id"]: r["distance"] for r in nearest.nearest_distance(df, ["a", "b", "c"], leaf=40).collect()}
    assert len(got) == len(p) and np.allclose([got[i] for i in range(len(p))], d.min(1), rtol=1e-12)
    assert nearest.nearest_distance(df.limit(1), ["a", "b", "c"]).count() == 0 and nearest.nearest_distance(df.limit(0), ["a", "b", "c"]).count() == 0
    # Few of the leaves are reached, and none that comes nearer than the radius is missed.
    tree = nearest.Tree(p, 5)
    first = tree.leaf(p)
    assert np.bincount(first, minlength=32).min() > 10
    who, leaf = tree.reached(p, d.min(1))
    want = {(i, first[j]) for i in range(len(p)) for j in np.flatnonzero(d[i] <= d[i].min())}
    assert want <= set(zip(who.tolist(), leaf.tolist())) | {(i, f) for i, f in enumerate(first)} and len(who) < 4 * len(p)


def test_least_keys_without_a_sort_of_all(spark):
    """The same rows as an ordered limit; the limit in the plan is that of one range of keys."""
    df = spark.range(5000).withColumn("k", (F.col("id") * 7919) % 2147483647)
    for n in (0, 1, 999, 5000, 6000):
        got = fl.lowest(df, F.col("k") * 400_000 % 2147483647, n, "id")
        want = df.orderBy(F.col("k") * 400_000 % 2147483647, "id").limit(n)
        assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in want.collect())
    plan = fl.lowest(df, F.col("k") * 400_000 % 2147483647, 2500, "id")._jdf.queryExecution().executedPlan().toString()
    assert "limit=2500" not in plan


@pytest.mark.parametrize("size", [(16, 128, 128), (4, 7, 5), (3, 24, 6)])
def test_tiles_give_what_a_whole_volume_gives(spark, size):
    """Boundaries and contours of any tiling equal those of the volume in one piece."""
    shape = (7, 15, 11)
    a = (np.random.default_rng(3).integers(0, 4, shape) * (np.random.default_rng(4).random(shape) < 0.7)).astype(np.int32)
    a = np.repeat(np.repeat(a[:4, :8, :6], 2, 0), 2, 1).repeat(2, 2)[: shape[0], : shape[1], : shape[2]]
    at = np.argwhere(np.ones(shape, bool))
    df = spark.createDataFrame([(1, *map(int, p), int(a[tuple(p)])) for p in at], "t int, z int, y int, x int, label int")

    def dense(rows, column):
        p = rows.toPandas()
        out = np.full(shape, np.nan)
        out[p["z"], p["y"], p["x"]] = p[column]
        assert len(p) == out.size
        return out

    for width in (1, 2):
        assert (dense(lb.outer_boundary(df, width, size), "boundary") == lb.boundaries(a, width)).all()
    k = vo.gaussian_kernel(1.0)
    want = lb.boundaries(a).astype(float)
    for axis in range(3):
        mirrored = np.pad(want, [(4, 4) if i == axis else (0, 0) for i in range(3)], mode="symmetric")
        want = sum(w * np.take(mirrored, np.arange(shape[axis]) + j, axis) for j, w in enumerate(k))
    assert np.allclose(dense(lb.label_contours(df, shape, 1.0, size), "contour"), want)
