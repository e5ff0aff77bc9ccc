"""Queries over volume transforms."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tetraframe.operators import labels as lb
from tetraframe.operators import local_contrast as lc
from tetraframe.operators import volumes as vo
from tetraframe.operators.geometry import rotation_matrix
from tetraframe.plans import fixtures as fx
from tetraframe.plans.book import Book, r, rounded
from tetraframe.plans.image_queries import WINDOW, folded, gauss

SHAPE = (fx.NZ, fx.NY, fx.NX)
LEVELS = """levels AS (SELECT t, z, greatest({level}, 1e-6) AS level FROM voxels GROUP BY 1, 2),
smooth AS (SELECT a.t, a.z, avg(b.level) AS level FROM (SELECT t, z, least(greatest(z + d, 0), 15) AS s FROM levels, range(-{p}, {q}) w(d)) a JOIN levels b ON a.t = b.t AND a.s = b.z GROUP BY 1, 2),
target AS (SELECT t, median(level) AS m FROM smooth GROUP BY 1)"""
BOOK = Book(voxels=fx.VOXELS, p99=LEVELS.format(level="quantile_cont(value, 0.99)", p=4, q=5), mean=LEVELS.format(level="avg(value)", p=4, q=5))
a = BOOK.add


def on(f):
    """A query that applies f to the voxels."""
    return lambda s, sf: f(fx.voxels(s, sf))


CUT = "trunc(least(greatest({x}, 0), 65535))::INTEGER"
a(
    "vol1_depth_correction",
    on(lambda v: vo.depth_correction(v).select("t", "z", "y", "x", "corrected")),
    "SELECT t, z, y, x, " + CUT.format(x="value * least(greatest(m / level, 0.25), 4.0)") + " AS corrected FROM voxels JOIN smooth USING (t, z) JOIN target USING (t)",
    "voxels",
    "p99",
)
a(
    "vol1_depth_scale_mean",
    on(lambda v: rounded(vo.depth_correction(v, None, 8).select("t", "z", "scale").distinct())),
    f"SELECT t, z, {r('least(greatest(m / level, 0.25), 4.0) AS scale')} FROM smooth JOIN target USING (t)",
    "voxels",
    "mean",
)
BOOK.views["mid"] = LEVELS.replace("1e-6", "1e-8").format(level="quantile_cont(value, 0.5)", p=5, q=6)
a(
    "vol10_z_corr_diag",
    on(lambda v: rounded(vo.depth_correction_damped(v))),
    f"""
    SELECT t, z, {r('least(CASE WHEN level < 0.25 * m THEN 1 + (m / level - 1) * level / (0.25 * m + 1e-8) ELSE m / level END, 2.0) AS scale')}
    FROM smooth
    JOIN target USING (t)
    """,
    "voxels",
    "mid",
)
a("win21_z_level_smooth", on(lambda v: rounded(vo.z_level_smooth(v.groupBy("t", "z").agg(F.avg("value").alias("level")), 8))), f"SELECT t, z, {r('level')} FROM smooth", "voxels", "mean")
# The separable Gaussian as two weighted self joins.
BOOK.views["shade"] = f"""proj AS (SELECT t, y, x, avg(value) AS v FROM voxels GROUP BY 1, 2, 3), gk AS {gauss(4.0)},
rowed AS (SELECT a.t, a.y, a.x, sum(w * b.v) AS v FROM (SELECT t, y, x, w, {folded('y + d', fx.NY)} AS s FROM proj, gk) a JOIN proj b ON a.t = b.t AND a.s = b.y AND a.x = b.x GROUP BY 1, 2, 3),
field AS (SELECT a.t, a.y, a.x, greatest(sum(w * b.v), 1e-8) AS v FROM (SELECT t, y, x, w, {folded('x + d', fx.NX)} AS s FROM rowed, gk) a JOIN rowed b ON a.t = b.t AND a.y = b.y AND a.s = b.x GROUP BY 1, 2, 3),
gains AS (SELECT t, y, x, m / v AS gain FROM field JOIN (SELECT t, avg(v) AS m FROM field GROUP BY 1) USING (t))"""
a(
    "vol9_shading_diag",
    on(lambda v: rounded(vo.shading_diagnosis(v, 4.0).select("t", "z", "y", "x", "gain", "corrected"), 4)),
    f"SELECT t, z, y, x, {r('gain', 'value * gain AS corrected', digits=4)} FROM voxels JOIN gains USING (t, y, x)",
    "voxels",
    "shade",
)
TAPS = "taps AS (SELECT i, s, least(floor(s), 14)::INTEGER AS lo FROM (SELECT i, least(greatest({s}, 0.0), 15.0) AS s FROM range({n}) q(i))), mixed AS (SELECT i, lo AS z, 1 - (s - lo) AS w FROM taps UNION ALL SELECT i, lo + 1, s - lo FROM taps)"
BOOK.views["taps_iso"] = TAPS.format(s="(i + 0.5) * 0.5::DOUBLE - 0.5", n=32)
BOOK.views["taps_mirror"] = """src AS (SELECT i, (i + 0.5) * 0.5::DOUBLE - 0.5 AS s FROM range(32) q(i)), tap AS (SELECT i, floor(s)::INTEGER AS z, 1 - (s - floor(s)) AS w FROM src UNION ALL SELECT i, floor(s)::INTEGER + 1, s - floor(s) FROM src),
mixed AS (SELECT i, CASE WHEN z < 0 THEN -z WHEN z > 15 THEN 30 - z ELSE z END AS z, w FROM tap)"""
BOOK.views["taps_corner"] = TAPS.format(s="i * 15.0::DOUBLE / 23", n=24)
LINEAR = f"SELECT t, i::INTEGER AS z, y, x, {r('sum(value * w) AS value')} FROM voxels JOIN mixed USING (z) GROUP BY t, i, y, x"
a(
    "vol3_isotropic_order1",
    on(lambda v: vo.isotropic(v, SHAPE, (0.748, 0.374, 0.374), 0.374, 1)),
    "SELECT t, i::INTEGER AS z, y, x, trunc(round(sum(value * w), 6))::INTEGER AS value FROM voxels JOIN mixed USING (z) GROUP BY t, i, y, x",
    "voxels",
    "taps_mirror",
)


def spline(n: int, m: int, name: str) -> str:
    """Weights of a cubic spline as a table: coefficients by the recursive filter of the B-spline (pole sqrt(3) - 2), summed far enough."""
    pole, rows = 3**0.5 - 2, {}
    mirror = lambda i: (lambda k: k if k < n else 2 * n - 2 - k)(abs(i) % (2 * n - 2))
    sigma = (n / m - 1) / 2 if m < n else 0
    reach = int(4 * sigma + 0.5)
    bell = [math.exp(-0.5 * (d / sigma) ** 2) if sigma else 1.0 for d in range(-reach, reach + 1)]
    for i in range(m):
        x = (i + 0.5) * n / m - 0.5
        for k in range(math.floor(x) - 1, math.floor(x) + 3):
            d = abs(x - k)
            basis = 2 / 3 - d * d + d**3 / 2 if d < 1 else (2 - d) ** 3 / 6 if d < 2 else 0
            for j in range(-40, 41):  # the inverse of (1, 4, 1) / 6 is a two-sided power of the pole
                c = basis * 6 * -pole / (1 - pole * pole) * pole ** abs(j)
                for e, b in enumerate(bell):
                    at = (i, mirror(mirror(k + j) + e - reach))
                    rows[at] = rows.get(at, 0.0) + c * b / sum(bell)
    return f"{name} AS (SELECT * FROM (VALUES {', '.join(f'({i}, {s}, {w!r}::DOUBLE)' for (i, s), w in sorted(rows.items()) if abs(w) > 1e-15)}) {name}_(i, s, w))"


def resampled(ny: int, nx: int) -> str:
    """Planes resampled by spline tables ys and xs."""
    return f"""wide AS (SELECT t, z, i AS y, x, sum(value * w) AS value FROM voxels JOIN ys ON y = s GROUP BY ALL), planes AS (SELECT t, z, y, i AS x, sum(value * w) AS value FROM wide JOIN xs ON x = s GROUP BY ALL),
span AS (SELECT t, min(value)::DOUBLE AS lo, max(value)::DOUBLE AS hi FROM voxels GROUP BY 1)"""


BOOK.views["iso3"] = f"{spline(24, 18, 'ys')}, {spline(24, 18, 'xs')}, {spline(16, 24, 'zs')}, {resampled(18, 18)}"
BOOK.views["half"] = f"{spline(24, 12, 'ys')}, {spline(24, 12, 'xs')}, {resampled(12, 12)}, scaled AS (SELECT t, z, y, x, least(greatest(value, lo), hi) AS value FROM planes JOIN span USING (t))"
a(
    "vol3_isotropic_cubic",
    on(lambda v: vo.isotropic(v, SHAPE, (0.748, 0.374, 0.374), 0.5, 3)),
    """
    SELECT t, i AS z, y, x, trunc(round(least(greatest(sum(value * w), any_value(lo)), any_value(hi)), 6))::INTEGER AS value
    FROM planes
    JOIN zs ON z = s
    JOIN span USING (t)
    GROUP BY t, i, y, x
    """,
    "voxels",
    "iso3",
)
a("vol4_reslice_linear_z", on(lambda v: rounded(vo.resliced_linear(v, fx.NZ, 24))), LINEAR, "voxels", "taps_corner")
a("vol5_downscale_xy", on(lambda v: rounded(vo.rescaled_xy(v, fx.NY, fx.NX, 0.5))), f"SELECT t, z, y, x, {r('value')} FROM scaled", "voxels", "half")
a(
    "vol6_export_raw_iso",
    on(lambda v: vo.raw_isotropic(v, SHAPE, 0.5, 20)),
    """WITH src AS (SELECT i, (i + 0.5) * (16 / 20.0::DOUBLE) - 0.5 AS s FROM range(20) q(i)), ends AS (SELECT t, min(value) AS lo, max(value) AS hi FROM scaled GROUP BY 1),
  tap AS (SELECT i, floor(s)::INTEGER AS z, 1 - (s - floor(s)) AS w FROM src UNION ALL SELECT i, floor(s)::INTEGER + 1, s - floor(s) FROM src)
  SELECT t, i::INTEGER AS z, y, x, trunc(least(greatest(round(least(greatest(sum(value * w), any_value(lo)), any_value(hi)), 6), 0), 65535))::INTEGER AS value FROM scaled JOIN tap USING (z) JOIN ends USING (t) GROUP BY t, i, y, x""",
    "voxels",
    "half",
)
a(
    "vol8_camera_bg_subtract",
    on(lambda v: rounded(vo.camera_background_subtract(v.withColumn("value", F.col("value") + F.col("x")), 0.3).select("t", "z", "y", "x", "corrected"))),
    f"""
    WITH v2 AS (SELECT t, z, y, x, value + x AS value
    FROM voxels) SELECT t, z, y, x, {r('greatest(value - q, 0.0) AS corrected')}
    FROM v2
    JOIN (SELECT t, z, quantile_cont(value, 0.3) AS q
    FROM v2
    GROUP BY 1, 2) USING (t, z)
    """,
    "voxels",
)
a(
    "vol11_local_noise",
    on(lambda v: rounded(vo.local_noise(v, 5), 3)),
    f"""WITH spread AS (SELECT v.t, v.z, v.y, v.x, {folded('v.y + a.d', fx.NY)} AS sy, {folded('v.x + b.d', fx.NX)} AS sx FROM voxels v, range(-2, 3) a(d), range(-2, 3) b(d))
  SELECT s.t, s.z, s.y, s.x, {r('stddev_pop(w.value) AS noise', digits=3)} FROM spread s JOIN voxels w ON s.t = w.t AND s.z = w.z AND s.sy = w.y AND s.sx = w.x GROUP BY 1, 2, 3, 4""",
    "voxels",
)
a("vol12_slab_projection_max", on(lambda v: vo.slab_projection(v, "z", 4, 9)), "SELECT t, y, x, max(value) AS value FROM voxels WHERE z BETWEEN 4 AND 9 GROUP BY 1, 2, 3", "voxels")
a(
    "vol12_slab_projection_mean",
    on(lambda v: rounded(vo.slab_projection(v, "y", 4, 9, "mean"))),
    f"SELECT t, z, x, {r('avg(value) AS value')} FROM voxels WHERE y BETWEEN 4 AND 9 GROUP BY 1, 2, 3",
    "voxels",
)
_R = rotation_matrix((1.0, 0.2, 0.1), (1.0, 0.0, 0.0))
_L = ("((k - 1.0) * {0} + (i - 7.5) * {1} + (j - 7.5) * {2} + {3})").format
_AT = [f"round_even({_L(*(repr(float(v)) for v in _R.T[row]), c)}, 0)::INTEGER AS {n}" for row, (c, n) in enumerate(zip((8.0, 12.0, 12.0), "zyx"))]
a(
    "vol13_oriented_slab",
    on(lambda v: vo.oriented_slab(v, _R, (8.0, 12.0, 12.0), 16, 3)),
    f"""
    SELECT t, i::INTEGER AS i, j::INTEGER AS j, max(value) AS value
    FROM voxels
    JOIN (SELECT i, j, {', '.join(_AT)}
    FROM range(3) a(k), range(16) b(i), range(16) c(j)) USING (z, y, x)
    GROUP BY t, i, j
    """,
    "voxels",
)
BOOK.views["contrast"] = WINDOW
a(
    "vol19_convert_uint8",
    on(lambda v: vo.as_uint8(v).select("t", "z", "y", "x", "byte")),
    "SELECT t, z, y, x, trunc(least(greatest((value - lo) * (255.0 / greatest(hi - lo, 1e-10)), 0), 255))::INTEGER AS byte FROM voxels, contrast",
    "voxels",
    "contrast",
)
a(
    "vol2_planar_correction",
    on(lambda v: vo.planar_correction(v, 4.0).select("t", "z", "y", "x", "corrected")),
    "SELECT t, z, y, x, " + CUT.format(x="value * least(gain, 2.0)") + " AS corrected FROM voxels JOIN gains USING (t, y, x)",
    "voxels",
    "shade",
)
a(
    "vol21_normalise_p999",
    on(lambda v: rounded(vo.normalised(v).select("t", "z", "y", "x", "norm"))),
    f"""
    SELECT t, z, y, x, {r('least(greatest(value / q, 0.0), 1.0) AS norm')}
    FROM voxels
    JOIN (SELECT t, quantile_cont(value, 0.999) FILTER (WHERE value > 0) AS q
    FROM voxels
    GROUP BY 1) USING (t)
    """,
    "voxels",
)
a(
    "win22_cells_along_z",
    on(lambda v: rounded(lb.depth_thirds(lb.per_slice_labels(v), fx.NZ))),
    f"""WITH centers AS (SELECT v.t, v.z, count(DISTINCT v.label) FILTER (WHERE v.label > 0 AND abs(c.cz - v.z) < 0.5) AS n FROM voxels v LEFT JOIN (SELECT t, label, avg(z) AS cz FROM voxels WHERE label > 0 GROUP BY 1, 2) c USING (t, label) GROUP BY 1, 2),
  parts AS (SELECT t, coalesce(sum(n) FILTER (WHERE z < 4), 0)::BIGINT AS shallow, coalesce(sum(n) FILTER (WHERE z BETWEEN 4 AND 11), 0)::BIGINT AS mid, coalesce(sum(n) FILTER (WHERE z >= 12), 0)::BIGINT AS deep FROM centers GROUP BY 1)
  SELECT *, shallow + mid + deep AS total, {r('CASE WHEN shallow > 0 THEN deep / shallow ELSE 0.0 END AS deep_over_shallow')} FROM parts""",
    "voxels",
)
a("vol20_local_equalisation", on(lambda v: lc.local_equalisation(v.select("t", "z", "y", "x", "value"), (fx.NY, fx.NX), 0.05, (7, 5))))
SIDES = "max(CASE WHEN y % 2 = {0} AND x % 2 = {1} THEN {2} END)"
FOUR = "SELECT t, z, y // 2 AS y, x // 2 AS x, " + ", ".join(f"{SIDES.format(i, j, '{v}')}::DOUBLE AS {n}" for n, i, j in (("a", 0, 0), ("b", 0, 1), ("c", 1, 0), ("d", 1, 1))) + " FROM {src} GROUP BY 1, 2, 3, 4"
DETAILS = " UNION ALL ".join(f"SELECT {{level}} AS level, '{b}' AS band, t, z, y, x, {e} / 2 AS value FROM {{src}}" for b, e in (("lh", "(a - b + c - d)"), ("hl", "(a + b - c - d)"), ("hh", "(a - b - c + d)")))
a(
    "vol20_haar_split",
    on(lambda v: rounded(lc.haar_split(v, 3))),
    f"""
    WITH h1 AS ({FOUR.format(v="value", src="voxels")}),
    h2 AS ({FOUR.format(v="v", src="(SELECT t, z, y, x, (a + b + c + d) / 2 AS v FROM h1)")}),
    h3 AS ({FOUR.format(v="v", src="(SELECT t, z, y, x, (a + b + c + d) / 2 AS v FROM h2)")})
    {" UNION ALL ".join(DETAILS.format(level=k, src=f"h{k}") for k in (1, 2, 3))} UNION ALL SELECT 3, 'll', t, z, y, x, (a + b + c + d) / 2 FROM h3
    """,
    "voxels",
)
a("vol20_haar_round_trip", on(lambda v: lc.haar_join(lc.haar_split(v, 3), 3, (fx.NY, fx.NX)).withColumn("value", F.rint("value").cast("int"))), "SELECT t, z, y, x, value FROM voxels", "voxels")
a(
    "vol20_wavelet_background",
    on(lambda v: rounded(lc.wavelet_background(v, 4.0).select("t", "z", "y", "x", "background", "corrected"), 4)),
    f"""
    WITH low AS (SELECT t, z, y, x, avg(value) OVER (PARTITION BY t, z, y // 2, x // 2) AS v, value FROM voxels),
    gk AS {gauss(4.0)},
    rowed AS (SELECT a.t, a.z, a.y, a.x, sum(w * b.v) AS v FROM (SELECT t, z, y, x, w, {folded("y + d", fx.NY)} AS s FROM low, gk) a
      JOIN low b ON a.t = b.t AND a.z = b.z AND a.s = b.y AND a.x = b.x GROUP BY 1, 2, 3, 4),
    back AS (SELECT a.t, a.z, a.y, a.x, sum(w * b.v) AS v FROM (SELECT t, z, y, x, w, {folded("x + d", fx.NX)} AS s FROM rowed, gk) a
      JOIN rowed b ON a.t = b.t AND a.z = b.z AND a.y = b.y AND a.s = b.x GROUP BY 1, 2, 3, 4)
    SELECT t, z, y, x, {r("back.v AS background", "greatest(value - back.v, 0) AS corrected", digits=4)} FROM low JOIN back USING (t, z, y, x)
    """,
    "voxels",
)
