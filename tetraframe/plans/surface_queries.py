"""Queries over point clouds: coordinates, surfaces, spheres, scalar functions."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tetraframe.functions import scalars as sc
from tetraframe.operators import geometry as geo
from tetraframe.operators import kinematics as kin
from tetraframe.plans import fixtures as fx
from tetraframe.plans.book import Book, r, rounded

CENTER, RADIUS = (0.1, -0.05, 0.02), 0.3
POLE, DORSAL = (0.5, 1.0, 0.2), (1.0, 0.1, -0.3)
D = [f"(position_{a} - {c})" for a, c in zip("xyz", CENTER)]
DIST = f"sqrt({' + '.join(f'{d} * {d}' for d in D)})"
BOOK = Book(
    cloud=fx.CLOUD, spots=fx.SPOTS, voxels=fx.VOXELS,
    polar=f"polar AS (SELECT id, {DIST} AS radial_dist, degrees(acos(least(greatest(-{D[1]} / greatest({DIST}, 1e-10), -1.0), 1.0))) AS theta_deg, degrees(atan2({D[2]}, {D[0]})) AS phi_deg FROM cloud)",
)
a = BOOK.add


def polar(s, f):
    """The cloud with spherical coordinates."""
    return geo.spherical_coordinates(fx.cloud(s, f), CENTER, RADIUS)


a(
    "sc1_spherical_coords",
    lambda s, f: rounded(polar(s, f).select("id", "radial_dist", "spherical_depth", "spherical_depth_norm", "theta_deg", "phi_deg")),
    f"""
    SELECT id, {r('radial_dist', f'{RADIUS} - radial_dist AS spherical_depth', f'({RADIUS} - radial_dist) / {RADIUS} AS spherical_depth_norm', 'theta_deg', 'phi_deg')}
    FROM polar
    """,
    "cloud",
    "polar",
)


def landmarks(s, f):
    """Angles of every point of the cloud, as a landmark, about the origin."""
    rows = fx.cloud(s, f).select(F.concat(F.lit("p"), "id").alias("landmark"), *(F.col(f"position_{c}").alias(c) for c in "xyz"))
    return rounded(rows.withColumns({k: v for k, v in sc.spherical(F.col("x"), F.col("y"), F.col("z"), F.lit(1.0)).items() if k.endswith("deg")}))


a(
    "sc2_landmark_angles",
    landmarks,
    f"""
    SELECT 'p' || id AS landmark, {r("x", "y", "z", "degrees(acos(least(greatest(-y / greatest(sqrt(x * x + y * y + z * z), 1e-10), -1.0), 1.0))) AS theta_deg", "degrees(atan2(z, x)) AS phi_deg")}
    FROM (SELECT id, position_x AS x, position_y AS y, position_z AS z FROM cloud)
    """,
    "cloud",
)
_R1, _R2 = geo.orientation((0.0, 0.0, 0.0), POLE, DORSAL)
_R = _R2 @ _R1


def turned(s, f):
    """The cloud turned about its mean by fixed landmarks relative to it."""
    d = fx.cloud(s, f)
    return rounded(geo.rotated(d, _R, geo.mean_position(d)), 5)


a(
    "sc4_orient",
    turned,
    "SELECT id, frame, " + r(*(f"{' + '.join(f'({float(_R[i, k])!r}) * (position_{c} - m{c})' for k, c in enumerate('xyz'))} AS position_{n}" for i, n in enumerate("xyz")), digits=5) + " FROM cloud, (SELECT avg(position_x) AS mx, avg(position_y) AS my, avg(position_z) AS mz FROM cloud)",
    "cloud",
)
# Rodrigues' formula for the turn of u to v: R = cos I + [w] + w w' / (1 + cos), w = u x v.
TURN = """raw AS (SELECT avg(position_x) AS a, avg(position_y) AS b, avg(position_z) AS c FROM cloud),
u AS (SELECT a / n AS a, b / n AS b, c / n AS c FROM raw, LATERAL (SELECT sqrt(a * a + b * b + c * c) AS n)),
w AS (SELECT -b AS k, [c, 0.0, -a] AS w FROM u),
cell AS (SELECT i, j, k, w, CASE WHEN i = j THEN 0.0 WHEN (j - i + 3) % 3 = 1 THEN -w[(i + 2) % 3 + 1] ELSE w[(i + 1) % 3 + 1] END AS skew FROM w, range(3) x(i), range(3) y(j)),
turn AS (SELECT i, j, k * (i = j)::INTEGER + skew + w[i + 1] * w[j + 1] / (1 + k) AS value FROM cell)"""
BOOK.views["turn"] = TURN


def matrix(s, f, make):
    """The cells of a matrix made of the rotation that takes the cloud's mean direction to -Y."""
    m = make(geo.rotation_matrix(geo.mean_position(fx.cloud(s, f)), (0, -1, 0)))
    return rounded(s.createDataFrame([(i, j, float(m[i, j])) for i in range(len(m)) for j in range(len(m))], "i int, j int, value double"))


a("sc3_rotation_matrix", lambda s, f: matrix(s, f, lambda m: m), f"SELECT i::INTEGER AS i, j::INTEGER AS j, {r('value')} FROM turn", "cloud", "turn")
# The rotation of XYZ with both axes reversed, for ZYX, in a 4 x 4 frame.
a(
    "sc5_orient_affine_zyx",
    lambda s, f: matrix(s, f, geo.oriented_affine),
    f"""
    SELECT p.i::INTEGER AS i, q.j::INTEGER AS j, {r("coalesce(m.value, CASE WHEN p.i = q.j THEN 1.0 ELSE 0.0 END) AS value")}
    FROM range(4) p(i) CROSS JOIN range(4) q(j) LEFT JOIN turn m ON m.i = 2 - p.i AND m.j = 2 - q.j
    """,
    "cloud",
    "turn",
)


def ball(s, f):
    """The cloud's directions on a sphere of radius 50 about (10, 20, 30)."""
    d = fx.cloud(s, f).withColumn("_r", sc.norm(*(F.col(c) for c in geo.XYZ)))
    return d.withColumns({c: m + 50.0 * F.col(c) / F.col("_r") for c, m in zip(geo.XYZ, (10.0, 20.0, 30.0))}).drop("_r")


def sphere_points(s, f):
    """Points on a sphere of radius 40 about (3, -7, 11), in the directions of the cloud: the least-squares sphere is known."""
    d = fx.cloud(s, f).withColumn("_r", sc.norm(*(F.col(c) for c in geo.XYZ))).where("_r > 0")
    return d.select(*((m + 40.0 * F.col(c) / F.col("_r")).alias(c) for c, m in zip(geo.XYZ, (3.0, -7.0, 11.0))))




def cap(s, f):
    """Points of a lattice of 20 x 20, by id, on the upper cap of a sphere of radius 50 about (19.5, 29.5, 7), three at each place: a cell of the surface holds one place."""
    u, v = F.col("id") % 20, F.floor(F.col("id") / 20) % 20
    w = F.sqrt(F.lit(2500.0) - F.pow(u - 9.5, F.lit(2)) - F.pow(v - 9.5, F.lit(2)))
    points = fx.cloud(s, f).select("id", (u + 10.0).alias("position_x"), (v + 20.0).alias("position_y"), (w + 7.0).alias("position_z"))
    return points.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(3)))).drop("_copy")


a(
    "fit4_fit_sphere",
    lambda s, f: rounded(geo.fit_sphere(cap(s, f), 0.9125).select("center_x", "center_y", "center_z", "radius", "rmse"), 4),
    "SELECT 19.5::DOUBLE AS center_x, 29.5::DOUBLE AS center_y, 7.0::DOUBLE AS center_z, 50.0::DOUBLE AS radius, 0.0::DOUBLE AS rmse",
)
a(
    "fit3_sphere_nls",
    lambda s, f: rounded(geo.nls_sphere(sphere_points(s, f)), 4),
    "SELECT 3.0::DOUBLE AS center_x, -7.0::DOUBLE AS center_y, 11.0::DOUBLE AS center_z, 40.0::DOUBLE AS radius, 0.0::DOUBLE AS rmse",
)
a(
    "agg27_sphere_coverage",
    lambda s, f: rounded(geo.sphere_coverage(fx.cloud(s, f), CENTER, RADIUS)),
    f"SELECT {r('CASE WHEN count(*) > 10 THEN count(DISTINCT (floor(theta_deg / 15), floor((phi_deg + 180.0) / 15))) / 288.0::DOUBLE ELSE 0.0 END AS coverage')} FROM polar WHERE radial_dist > {0.5 * RADIUS} AND radial_dist < {1.5 * RADIUS}",
    "cloud",
    "polar",
)
a(
    "agg28_manual_sphere",
    lambda s, f: rounded(geo.manual_sphere(fx.cloud(s, f), CENTER)),
    f"SELECT {r('any_value(m) AS radius', 'sqrt(avg(pow(radial_dist - m, 2))) AS rmse')} FROM polar, (SELECT median(radial_dist) AS m FROM polar)",
    "cloud",
    "polar",
)
COLOR = {
    "minmax": "(position_x - lo) / greatest(hi - lo, 1e-10)", "symmetric": "(least(greatest(position_x / greatest(abs(q02), abs(q98), 1e-6), -1.0), 1.0) + 1) / 2",
    "cap": "least(greatest(position_x / greatest(q98, 1e-6), 0.0), 1.0)", "inward": "least(greatest(greatest(-position_x, 0.0) / greatest(coalesce(n95, 1.0), 1e-6), 0.0), 1.0)",
}
for _mode, _sql in COLOR.items():
    a(f"sc10_color_value_{_mode}", lambda s, f, m=_mode: rounded(geo.color_values(fx.cloud(s, f), "position_x", m)),
      f"SELECT id, {r(f'{_sql} AS value')} FROM cloud, (SELECT min(position_x) AS lo, max(position_x) AS hi, quantile_cont(position_x, 0.02) AS q02, quantile_cont(position_x, 0.98) AS q98, quantile_cont(-position_x, 0.95) FILTER (WHERE position_x < 0) AS n95 FROM cloud)", "cloud")
a(
    "sc10_ingression_rgba",
    lambda s, f: rounded(geo.color_values(fx.cloud(s, f), "position_x", "inward").select("id", *geo.ingression_rgba(F.col("id") % 2 == 0, F.col("value")))),
    f"""
    SELECT id, {', '.join(r(f'CASE WHEN id % 2 = 0 THEN {on} ELSE {off} END AS {n}') for n, on, off in (('r', '0.85 + 0.15 * v', 0.45), ('g', '0.35 * (1 - pow(v, 0.8))', 0.45), ('b', '0.15 + 0.70 * pow(v, 0.6)', 0.45), ('a', '0.65 + 0.35 * v', 0.06)))}
    FROM (SELECT id, {COLOR['inward']} AS v
    FROM cloud, (SELECT quantile_cont(-position_x, 0.95) FILTER (WHERE position_x < 0) AS n95
    FROM cloud))
    """,
    "cloud",
)
a(
    "sc10_flag_rgba",
    lambda s, f: rounded(fx.spots(s, f).select("id", *geo.flag_rgba(F.col("track_id").isNotNull(), "tracked"))),
    """
    SELECT id, CASE WHEN k THEN 0.2 ELSE 0.55 END::DOUBLE AS r, CASE WHEN k THEN 0.85 ELSE 0.55 END::DOUBLE AS g, CASE WHEN k THEN 1.0 ELSE 0.55 END::DOUBLE AS b, CASE WHEN k THEN 1.0 ELSE 0.18 END::DOUBLE AS a
    FROM (SELECT id, track_id IS NOT NULL AS k
    FROM spots)
    """,
    "spots",
)
a(
    "sc6_saturating_cast",
    lambda s, f: fx.spots(s, f).select("id", sc.saturating_uint16(F.col("position_x") * 300 - 1000).alias("v")),
    "SELECT id, trunc(least(greatest(position_x * 300 - 1000, 0), 65535))::INTEGER AS v FROM spots",
    "spots",
)
a(
    "sc7_minmax_stretch",
    lambda s, f: rounded(fx.spots(s, f).crossJoin(F.broadcast(fx.spots(s, f).agg(F.min("position_x").alias("lo"), F.max("position_x").alias("hi")))).select("id", sc.minmax_stretch(F.col("position_x"), F.col("lo"), F.col("hi"), 0.0, 255.0).alias("v"))),
    f"SELECT id, {r('(position_x - lo) * 255.0 / (hi - lo) AS v')} FROM spots, (SELECT min(position_x) AS lo, max(position_x) AS hi FROM spots)",
    "spots",
)
a(
    "sc8_percentile_window",
    lambda s, f: rounded(fx.spots(s, f).crossJoin(F.broadcast(fx.spots(s, f).agg(F.percentile("position_x", F.lit([0.02, 0.98])).alias("q")))).select("id", sc.percentile_window(F.col("position_x"), F.col("q")[0], F.col("q")[1]).alias("v"))),
    f"""
    SELECT id, {r('greatest(least(position_x, h) - l, 0.0) AS v')}
    FROM spots, (SELECT quantile_cont(position_x, 0.02) AS l, quantile_cont(position_x, 0.98) AS h
    FROM spots)
    """,
    "spots",
)
a(
    "sc9_hash_color",
    lambda s, f: fx.spots(s, f).select("id", sc.hash_color(F.col("id") * 5_000_001).alias("color")),
    "SELECT id, ((id * 5000001)::HUGEINT * 2654435761 % 251 + 5)::INTEGER AS color FROM spots",
    "spots",
)
a(
    "sc11_lut_scale",
    lambda s, f: fx.spots(s, f).select("id", sc.lut_value(F.when(F.col("id") % 7 > 0, F.floor(F.col("position_x") * 2) / 2), F.lit(0.0), F.lit(450.0)).alias("lut"), sc.lut_flag(F.col("id") % 3 == 0).alias("flag"), sc.lut_diverging(F.floor(F.col("position_x") * 2) / 2 - 200, F.lit(150.0)).alias("diverging")),
    """
    SELECT id, CASE WHEN id % 7 = 0 THEN 20 ELSE trunc(v / 450 * 250 + 5) END::INTEGER AS lut, CASE WHEN id % 3 = 0 THEN 240 ELSE 20 END AS flag, trunc((least(greatest((v - 200) / 150, -1.0), 1.0) + 1) / 2 * 250 + 5)::INTEGER AS diverging
    FROM (SELECT id, floor(position_x * 2) / 2 AS v
    FROM spots)
    """,
    "spots",
)
a(
    "sc12_slider_bounds",
    lambda s, f: rounded(fx.spots(s, f).select("id", *(c.alias(n) for n, c in zip(("top", "step"), sc.slider_bounds(F.col("position_x") / 4))))),
    f"""
    SELECT id, {r('CASE WHEN v <= 5 THEN ceil(v * 10) / 10 WHEN v <= 50 THEN ceil(v) ELSE ceil(v / 10) * 10 END AS top', 'CASE WHEN v <= 5 THEN 0.1 WHEN v <= 50 THEN 0.5 ELSE 1.0 END AS step')}
    FROM (SELECT id, greatest(position_x / 4, 1.0) * 1.1::DOUBLE AS v
    FROM spots)
    """,
    "spots",
)
a(
    "sc14_format_tp",
    lambda s, f: fx.spots(s, f).select("frame").distinct().select("frame", sc.timepoint_name(F.col("frame")).alias("name")),
    "SELECT DISTINCT frame, printf('t%04d', frame) AS name FROM spots",
    "spots",
)
a(
    "sc15_sanitize_path",
    lambda s, f: fx.customers(s, f).select(F.concat("c_mktsegment", F.lit("\\"), "c_name", F.expr("repeat('/', int(k % 3))")).alias("path")).select("path", sc.sanitize_path(F.col("path")).alias("clean")),
    "SELECT path, regexp_replace(replace(path, chr(92), ''), '/+$', '') AS clean FROM (SELECT c_mktsegment || chr(92) || c_name || repeat('/', (c_custkey % 3)::INTEGER) AS path FROM customer)",
)


def unit(*names):
    """One of the units, by customer."""
    return F.element_at(F.array(*map(F.lit, names)), (F.col("k") % len(names) + 1).cast("int"))


a(
    "sc16_unit_convert",
    lambda s, f: rounded(fx.customers(s, f).select("k", F.col("c_acctbal").alias("size"), unit("nm", "mm", "um", "pm").alias("unit")).withColumn("um", sc.micrometres(F.col("size"), F.col("unit")))),
    f"""
    SELECT c_custkey AS k, {r('c_acctbal AS size')}, ['nm', 'mm', 'um', 'pm'][c_custkey % 4 + 1] AS unit, {r('c_acctbal * [1e-3, 1e3, 1.0, 1e-6][c_custkey % 4 + 1] AS um')}
    FROM customer
    """,
)
a(
    "sc16_resolution_convert",
    lambda s, f: rounded(fx.customers(s, f).select("k", F.col("c_acctbal").alias("res"), unit("inch", "cm").alias("unit")).withColumn("um", sc.resolution_to_micrometres(F.col("res"), F.col("unit")))),
    f"""
    SELECT c_custkey AS k, {r('c_acctbal AS res')}, ['inch', 'cm'][c_custkey % 2 + 1] AS unit, {r('CASE WHEN c_acctbal > 0 THEN [25400.0, 10000.0][c_custkey % 2 + 1] / c_acctbal END AS um')}
    FROM customer
    """,
)
a(
    "sc17_safe_ratio",
    lambda s, f: rounded(fx.spots(s, f).select("id", sc.safe_ratio(F.col("position_x"), F.col("position_z")).alias("ratio"))),
    f"SELECT id, {r('CASE WHEN position_z <> 0 THEN position_x / position_z ELSE 0.0 END AS ratio')} FROM spots",
    "spots",
)
a(
    "sc18_voxel_scale",
    lambda s, f: rounded(fx.spots(s, f).where("position_z > 0").select("id", sc.scaled_voxel(F.lit(0.374), F.col("position_z")).alias("size"))),
    f"SELECT id, {r('0.374::DOUBLE / position_z AS size')} FROM spots WHERE position_z > 0",
    "spots",
)
a(
    "sc19_frame_to_index",
    lambda s, f: fx.spots(s, f).select("id", sc.frame_to_index(F.col("frame"), 100, 300).alias("i")),
    "SELECT id, least(greatest(frame - 100, 0), 299)::INTEGER AS i FROM spots",
    "spots",
)


def section(s, f):
    """Circles that planes at customers' distances, 0 to 12, cut from a sphere of radius 10."""
    rows = fx.customers(s, f).select((F.col("k") % 13).cast("double").alias("d")).distinct().withColumn("rad", sc.section_radius(10.0, F.col("d"))).where("rad IS NOT NULL").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(199))))
    x, y = sc.section_point(F.col("rad"), F.col("k"))
    return rounded(rows.select("d", "k", x.alias("x"), y.alias("y")))


a(
    "sc20_sphere_section",
    section,
    f"""
    SELECT d::DOUBLE AS d, k::INTEGER AS k, {r(f'sqrt(100 - d * d) * cos(k * {2 * math.pi / 199!r}) AS x', f'sqrt(100 - d * d) * sin(k * {2 * math.pi / 199!r}) AS y')}
    FROM (SELECT DISTINCT c_custkey % 13 AS d
    FROM customer), range(200) r(k)
    WHERE abs(d) < 10
    """,
)
a(
    "sc21_cap_mesh",
    lambda s, f: rounded(geo.cap_mesh(polar(s, f), CENTER, RADIUS, 5, 8)),
    f"""
    SELECT i, j, {r(f'{CENTER[0]} + {RADIUS} * sin(a) * cos(b) AS x', f'({CENTER[1]}) - {RADIUS} * cos(a) AS y', f'{CENTER[2]} + {RADIUS} * sin(a) * sin(b) AS z')}
    FROM (SELECT i::INTEGER AS i, j::INTEGER AS j, radians(t0 + (t1 - t0) * i / 4.0) AS a, radians(p0 + (p1 - p0) * j / 7.0) AS b
    FROM (SELECT greatest(quantile_cont(theta_deg, 0.02) - 10, 0.0) AS t0, least(quantile_cont(theta_deg, 0.98) + 10, 180.0) AS t1, quantile_cont(phi_deg, 0.02) - 10 AS p0, quantile_cont(phi_deg, 0.98) + 10 AS p1
    FROM polar), range(5) u(i), range(8) v(j))
    """,
    "cloud",
    "polar",
)


def triangles(s, f):
    """The triangles of the cap's mesh, with the place of their first vertex."""
    mesh = geo.cap_mesh(polar(s, f), CENTER, RADIUS, 5, 8).select((F.col("i") * 8 + F.col("j")).alias("a"), "x", "y", "z")
    return rounded(geo.cap_triangles(s, 5, 8).join(mesh, "a").select("a", "b", "c", "x", "y", "z"))


a(
    "sc21_cap_triangles",
    triangles,
    f"""
    WITH ends AS (SELECT greatest(quantile_cont(theta_deg, 0.02) - 10, 0.0) AS t0, least(quantile_cont(theta_deg, 0.98) + 10, 180.0) AS t1, quantile_cont(phi_deg, 0.02) - 10 AS p0, quantile_cont(phi_deg, 0.98) + 10 AS p1 FROM polar),
    tri AS (SELECT i, j, i * 8 + j + 1 AS b, (i + 1) * 8 + j + 1 AS c FROM range(4) x(i), range(7) y(j) UNION ALL SELECT i, j, (i + 1) * 8 + j + 1, (i + 1) * 8 + j FROM range(4) x(i), range(7) y(j)),
    spot AS (SELECT *, radians(t0 + (t1 - t0) * i / 4.0) AS u, radians(p0 + (p1 - p0) * j / 7.0) AS v FROM tri, ends)
    SELECT i * 8 + j AS a, b, c, {r(f"{CENTER[0]} + {RADIUS} * sin(u) * cos(v) AS x", f"({CENTER[1]}) - {RADIUS} * cos(u) AS y", f"{CENTER[2]} + {RADIUS} * sin(u) * sin(v) AS z")} FROM spot
    """,
    "cloud",
    "polar",
)
a(
    "flt18_sane_voxel",
    lambda s, f: rounded(fx.spots(s, f).select("id", sc.sane_voxel(F.col("position_x") / 3, 0.374).alias("v"))),
    f"SELECT id, {r('CASE WHEN position_x / 3 > 0.05 AND position_x / 3 < 100 THEN position_x / 3 ELSE 0.374 END AS v')} FROM spots",
    "spots",
)
a(
    "jn7_label_lut_colors",
    lambda s, f: kin.first_point(fx.spots(s, f)).select("track_id", sc.hash_color(F.col("track_id")).alias("color")),
    "SELECT DISTINCT track_id, (track_id::HUGEINT * 2654435761 % 251 + 5)::INTEGER AS color FROM spots WHERE track_id IS NOT NULL",
    "spots",
)
