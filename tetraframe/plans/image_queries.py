"""Queries over label and image statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tetraframe.operators import filters as fl
from tetraframe.operators import image as im
from tetraframe.operators import joins as jn
from tetraframe.operators import labels as lb
from tetraframe.plans import fixtures as fx
from tetraframe.plans.book import Book, r, rounded

SHAPE = (fx.NZ, fx.NY, fx.NX)


def gauss(sigma: float) -> str:
    """Weights of a truncated Gaussian as SQL."""
    top = int(4 * sigma + 0.5)
    return f"(SELECT d, exp(-0.5 * d * d / {sigma * sigma}) / (SELECT sum(exp(-0.5 * d * d / {sigma * sigma})) FROM range({-top}, {top + 1}) n(d)) AS w FROM range({-top}, {top + 1}) n(d))"


def folded(i: str, n: int) -> str:
    """An index mirrored at the edges, the edge doubled, as SQL."""
    return f"(CASE WHEN (({i}) % {2 * n} + {2 * n}) % {2 * n} < {n} THEN (({i}) % {2 * n} + {2 * n}) % {2 * n} ELSE {2 * n - 1} - (({i}) % {2 * n} + {2 * n}) % {2 * n} END)"


BOOK = Book(
    voxels=fx.VOXELS,
    labels="labels AS (SELECT t, label, count(*) AS volume, max(z) - min(z) + 1 AS zext, max(y) - min(y) + 1 AS yext, max(x) - min(x) + 1 AS xext, avg(z) AS cz, avg(value) AS mean_value FROM voxels WHERE label > 0 GROUP BY 1, 2)",
    sizes="sizes AS (SELECT l.*, m FROM labels l JOIN (SELECT t, median(volume) AS m FROM labels GROUP BY 1) USING (t))",
    slices="slices AS (SELECT t, z, count(DISTINCT CASE WHEN label > 0 THEN label END) AS cells FROM voxels GROUP BY 1, 2)",
    stats="""stats AS (SELECT * FROM (SELECT t, avg((cells > 0)::INTEGER) AS z_coverage, CASE WHEN count(*) FILTER (WHERE cells > 0) > 1 THEN stddev_pop(cells) FILTER (WHERE cells > 0) / avg(cells) FILTER (WHERE cells > 0) ELSE 0.0 END AS z_density_cv,
  avg(cells) AS cells_per_z_mean, stddev_pop(cells) AS cells_per_z_std FROM slices GROUP BY 1) LEFT JOIN (SELECT t, count(*) AS n_cells, avg(volume) AS mean_volume, any_value(m) AS median_volume, stddev_pop(volume) AS std_volume, min(volume) AS min_volume, max(volume) AS max_volume,
  stddev_pop(volume) / avg(volume) AS volume_cv, avg((volume < 0.25 * m)::INTEGER) AS small_fraction, avg((volume > 4 * m)::INTEGER) AS large_fraction, avg(zext) AS mean_z_extent, avg((yext + xext) / 2) AS mean_xy_extent,
  avg(zext / ((yext + xext) / 2)) AS mean_elongation, avg(volume / (zext * yext * xext)) AS mean_sphericity FROM sizes GROUP BY 1) USING (t))""",
    touch="""nbr AS (SELECT DISTINCT a.t, a.label, b.label AS other FROM voxels a JOIN voxels b ON a.t = b.t AND abs(a.z - b.z) + abs(a.y - b.y) + abs(a.x - b.x) = 1 AND b.z BETWEEN a.z - 1 AND a.z + 1 WHERE a.label > 0 AND b.label > 0 AND a.label <> b.label),
touch AS (SELECT l.t, count(DISTINCT n.label)::DOUBLE / count(DISTINCT l.label) AS touching FROM labels l LEFT JOIN nbr n ON l.t = n.t AND l.label = n.label GROUP BY 1)""",
)
# The neighbour join as three shifted equi-joins, which both engines hash.
BOOK.views["touch"] = """face AS (SELECT a.t, a.label, b.label AS other FROM voxels a JOIN voxels b ON a.t = b.t AND a.z + 1 = b.z AND a.y = b.y AND a.x = b.x UNION ALL SELECT a.t, a.label, b.label FROM voxels a JOIN voxels b ON a.t = b.t AND a.z = b.z AND a.y + 1 = b.y AND a.x = b.x
  UNION ALL SELECT a.t, a.label, b.label FROM voxels a JOIN voxels b ON a.t = b.t AND a.z = b.z AND a.y = b.y AND a.x + 1 = b.x),
nbr AS (SELECT DISTINCT t, label, other FROM (SELECT * FROM face UNION ALL SELECT t, other, label FROM face) WHERE label > 0 AND other > 0 AND label <> other),
touch AS (SELECT l.t, count(DISTINCT n.label)::DOUBLE / count(DISTINCT l.label) AS touching FROM labels l LEFT JOIN nbr n ON l.t = n.t AND l.label = n.label GROUP BY 1)"""
a = BOOK.add


def on(f):
    """A query that applies f to the voxels."""
    return lambda s, sf: f(fx.voxels(s, sf))


SEG = ("mean_volume", "median_volume", "std_volume", "volume_cv", "small_fraction", "large_fraction", "mean_z_extent", "mean_xy_extent", "mean_elongation", "mean_sphericity", "z_coverage", "z_density_cv")
a(
    "agg9_segmentation_metrics",
    on(lambda v: rounded(lb.segmentation_metrics(v))),
    f"SELECT t, n_cells AS seg_n_cells, {r(*(f'{n} AS seg_{n}' for n in SEG), 'touching AS seg_touching')} FROM stats JOIN touch USING (t)",
    "voxels",
    "labels",
    "sizes",
    "slices",
    "stats",
    "touch",
)
a("agg9_touching", on(lambda v: rounded(lb.touching_fraction(v))), f"SELECT t, {r('touching')} FROM touch", "voxels", "labels", "touch")
a(
    "agg10_global_nuclei_stats",
    on(lambda v: rounded(lb.label_stats(v).drop("mean_z_extent", "mean_xy_extent"))),
    f"SELECT t, n_cells, min_volume, max_volume, {r(*(n for n in SEG if 'extent' not in n), 'cells_per_z_mean', 'cells_per_z_std')} FROM stats",
    "voxels",
    "labels",
    "sizes",
    "slices",
    "stats",
)
a(
    "agg11_per_slice_nuclei",
    on(lambda v: rounded(lb.per_slice_labels(v))),
    f"""SELECT t, z, count(area) FILTER (WHERE label > 0) AS n_labels, count(*) FILTER (WHERE label > 0 AND abs(cz - z) < 0.5) AS n_centroids, coalesce(sum(area) FILTER (WHERE label > 0), 0)::BIGINT AS total_area,
  {r('coalesce(avg(area) FILTER (WHERE label > 0), 0) AS mean_area', 'coalesce(median(area) FILTER (WHERE label > 0), 0) AS median_area', 'coalesce(stddev_pop(area) FILTER (WHERE label > 0), 0) AS std_area')}, coalesce(min(area) FILTER (WHERE label > 0), 0)::BIGINT AS min_area, coalesce(max(area) FILTER (WHERE label > 0), 0)::BIGINT AS max_area,
  {r('coalesce(sum(area) FILTER (WHERE label > 0), 0)::DOUBLE / sum(area) AS fraction')} FROM (SELECT t, z, label, count(*) AS area FROM voxels GROUP BY 1, 2, 3) LEFT JOIN (SELECT t, label, cz FROM labels) USING (t, label) GROUP BY 1, 2""",
    "voxels",
    "labels",
)
a(
    "agg12_intensity_in_nuclei",
    on(lambda v: rounded(lb.intensity_in_labels(v))),
    f"""SELECT t, {r('mean', 'std', 'min', 'max', 'snr')} FROM (SELECT t, avg(mean_value) AS mean, stddev_pop(mean_value) AS std, min(mean_value) AS min, max(mean_value) AS max FROM labels GROUP BY 1) JOIN
  (SELECT t, CASE WHEN count(*) FILTER (WHERE label = 0) > 100 AND stddev_pop(value) FILTER (WHERE label = 0) > 1e-8 THEN avg(value) FILTER (WHERE label > 0) / stddev_pop(value) FILTER (WHERE label = 0) ELSE 0.0 END AS snr FROM voxels GROUP BY 1) USING (t)""",
    "voxels",
    "labels",
)
Q = lambda p, n: f"quantile_cont(value, {p}) AS {n}"
a(
    "agg13_per_slice_stats",
    on(lambda v: rounded(im.per_slice_stats(v))),
    f"""
    SELECT t, z, {r('avg(value) AS mean', 'stddev_pop(value) AS std', *(Q(p / 100, f'p{p}') for p in im.PERCENTS))}, max(value) AS max, min(value) AS min, count(*) FILTER (WHERE value = 0) AS n_zero, count(*) FILTER (WHERE value >= 65535) AS n_sat
    FROM voxels
    GROUP BY 1, 2
    """,
    "voxels",
)
SNR = "SELECT {k}, " + r("CASE WHEN count(*) FILTER (WHERE value <= q) >= {n} AND stddev_pop(value) FILTER (WHERE value <= q) >= 1e-10 THEN any_value(p) / stddev_pop(value) FILTER (WHERE value <= q) {e} END AS snr") + " FROM voxels JOIN (SELECT {k}, quantile_cont(value, 0.1) AS q, quantile_cont(value, 0.95) AS p FROM voxels GROUP BY ALL) USING ({k}) GROUP BY {k}"
a(
    "agg14_robust_snr_per_slice",
    on(lambda v: rounded(im.robust_snr_per_slice(v.withColumn("value", F.col("value") + F.col("x"))))),
    "WITH v2 AS (SELECT t, z, y, x, value + x AS value FROM voxels) " + SNR.format(k="t, z", n=51, e="ELSE 0.0").replace("FROM voxels", "FROM v2"),
    "voxels",
)
a(
    "agg16_snr",
    on(lambda v: rounded(im.volume_snr(v.withColumn("value", F.col("value") + F.col("x"))))),
    "WITH v2 AS (SELECT t, z, y, x, value + x AS value FROM voxels) " + SNR.format(k="t", n=100, e="").replace("FROM voxels", "FROM v2"),
    "voxels",
)
a(
    "agg15_dynamic_range_info",
    on(lambda v: rounded(im.dynamic_range_info(v))),
    f"""
    SELECT t, min(value) AS min, max(value) AS max, {r(Q(0.01, 'p1'), Q(0.99, 'p99'), Q(0.999, 'p999'), 'avg((value = 0)::INTEGER) AS frac_zero', 'avg((value >= 65535)::INTEGER) AS frac_sat', 'avg(value) AS mean', 'stddev_pop(value) AS std')}
    FROM voxels
    GROUP BY 1
    """,
    "voxels",
)
a(
    "agg17_edge_ratio",
    on(lambda v: rounded(im.edge_ratio(v, SHAPE, 3))),
    f"""
    SELECT t, {r('avg(value) FILTER (WHERE NOT i) / avg(value) FILTER (WHERE i) AS edge_ratio')}
    FROM (SELECT *, z BETWEEN 3 AND 12 AND y BETWEEN 3 AND 20 AND x BETWEEN 3 AND 20 AS i
    FROM voxels)
    GROUP BY 1
    """,
    "voxels",
)
a(
    "agg18_z_uniformity",
    on(lambda v: rounded(im.z_uniformity(v))),
    f"SELECT t, {r('stddev_pop(m) / avg(m) AS z_uniformity')} FROM (SELECT t, z, avg(value) AS m FROM voxels GROUP BY 1, 2) GROUP BY 1",
    "voxels",
)
a(
    "agg19_sharpness",
    on(lambda v: rounded(im.sharpness(v, SHAPE), 3)),
    f"""SELECT t, {r('avg(s) AS sharpness', digits=3)} FROM (SELECT t, z, var_pop(l) AS s FROM (SELECT t, z, coalesce(lag(value) OVER wx, value) + coalesce(lead(value) OVER wx, value) + coalesce(lag(value) OVER wy, value) + coalesce(lead(value) OVER wy, value) - 4 * value AS l FROM voxels
  WHERE z IN (0, 3, 7, 11, 15) WINDOW wx AS (PARTITION BY t, z, y ORDER BY x), wy AS (PARTITION BY t, z, x ORDER BY y)) GROUP BY 1, 2) GROUP BY 1""",
    "voxels",
)
a(
    "agg20_dynamic_range",
    on(lambda v: rounded(im.dynamic_range(v))),
    f"SELECT t, {r('(quantile_cont(value, 0.999) - quantile_cont(value, 0.001)) / 65535.0 AS dynamic_range')} FROM voxels GROUP BY 1",
    "voxels",
)
GRID = [int(4 + (18 - 6) * i / 19 + 2) for i in range(20)]  # 20 places from 6 to 18, truncated
AT = "(VALUES " + ", ".join(f"({v})" for v in GRID) + ")"
a(
    "agg21_z_frequency",
    on(lambda v: rounded(im.z_frequency(v, SHAPE))),
    f"""WITH cols AS (SELECT v.*, g.y AS gy FROM voxels v JOIN {AT} g(y) ON v.y = g.y JOIN {AT} h(x) ON v.x = h.x),
  one AS (SELECT t, y, x, count(*) / {fx.NZ} AS w, stddev_pop(value) AS s FROM cols GROUP BY 1, 2, 3),
  spectrum AS (SELECT t, y, x, k, pow(sum(value * cos(2 * pi() * k * z / {fx.NZ})), 2) + pow(sum(value * sin(2 * pi() * k * z / {fx.NZ})), 2) AS p FROM (SELECT v.* FROM voxels v JOIN one USING (t, y, x)), range({fx.NZ // 2 + 1}) q(k) GROUP BY 1, 2, 3, 4),
  share AS (SELECT t, y, x, sum(p) FILTER (WHERE k >= {(fx.NZ // 2 + 1) // 4}) / sum(p) AS f FROM spectrum GROUP BY 1, 2, 3)
  SELECT t, {r('coalesce(sum(f * w) FILTER (WHERE s >= 1e-10) / sum(w) FILTER (WHERE s >= 1e-10), 0.0) AS z_frequency')} FROM one JOIN share USING (t, y, x) GROUP BY 1""",
    "voxels",
)
a(
    "agg22_image_stats",
    on(lambda v: rounded(im.image_stats(v))),
    f"""
    SELECT t, min(value) AS min, max(value) AS max, {r('avg(value) AS mean', Q(0.01, 'p01'), Q(0.5, 'p50'), Q(0.99, 'p99'), 'avg((value = 0)::INTEGER) AS frac_zero')}
    FROM voxels
    GROUP BY 1
    """,
    "voxels",
)
WINDOW = """strided AS (SELECT value FROM voxels WHERE z % 2 = 0 AND y % 2 = 0 AND x % 2 = 0), span AS (SELECT min(value)::DOUBLE AS lo, max(value)::DOUBLE AS hi FROM strided),
heights AS (SELECT CASE WHEN hi > lo THEN least(floor((value - lo) / ((hi - lo) / 256)), 255) ELSE 0 END AS bin, count(*) AS c FROM strided, span WHERE value > 0 GROUP BY 1),
contrast AS (SELECT lo + coalesce(a, 0) * (hi - lo) / 256 AS lo, lo + coalesce(b, 0) * (hi - lo) / 256 AS hi FROM span, (SELECT min(bin) FILTER (WHERE up >= n * 0.005) AS a, min(bin) FILTER (WHERE up >= n * 0.995) AS b FROM (SELECT *, sum(c) OVER (ORDER BY bin) AS up, sum(c) OVER () AS n FROM heights)))"""
BOOK.views["contrast"] = WINDOW
a("agg25_contrast_percentiles", on(lambda v: rounded(im.contrast_percentiles(v))), f"SELECT {r('lo', 'hi')} FROM contrast", "voxels", "contrast")
a(
    "agg32_camera_noise_table",
    on(lambda v: rounded(im.camera_noise_table(v.withColumn("value", F.col("value") + F.col("x"))))),
    f"""WITH v2 AS (SELECT t, z, y, x, value + x AS value FROM voxels), c AS (SELECT t, quantile_cont(value, 0.3) AS c FROM v2 GROUP BY 1), b AS (SELECT t, avg(value) + 3 * stddev_pop(value) AS b FROM v2 JOIN c USING (t) WHERE value < c GROUP BY 1),
  q AS (SELECT t, z, quantile_cont(value, 0.02) AS p2, quantile_cont(value, 0.05) AS p5, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.995) - quantile_cont(value, 0.005) AS contrast, quantile_cont(value, 0.9) AS p90 FROM v2 GROUP BY 1, 2)
  SELECT t, z, {r('any_value(p2) AS p2', 'any_value(p5) AS p5', 'any_value(p50) AS p50', 'any_value(contrast) AS contrast', 'avg((value < b)::INTEGER) AS bg_share', 'avg((value > p90)::INTEGER) AS bright_share')} FROM v2 JOIN q USING (t, z) JOIN b USING (t) GROUP BY t, z""",
    "voxels",
)
a(
    "agg33_slice_contrast",
    on(lambda v: im.slice_contrast(v.groupBy("y", "x").agg(F.max("value").alias("value")))),
    """
    SELECT coalesce(floor(l), 0)::INTEGER AS lo, coalesce(greatest(floor(h), floor(l) + 1), 255)::INTEGER AS hi
    FROM (SELECT quantile_cont(value, 0.01) AS l, quantile_cont(value, 0.995) AS h
    FROM (SELECT y, x, max(value) AS value
    FROM voxels
    GROUP BY 1, 2)
    WHERE value > 0)
    """,
    "voxels",
)
a(
    "jn7_label_lut",
    on(lambda v: jn.label_lut(v, v.where("label % 2 = 1").select("label").distinct().withColumn("lut", F.col("label") % 251)).select("t", "z", "y", "x", "lut")),
    "SELECT t, z, y, x, CASE WHEN label % 2 = 1 THEN label % 251 ELSE 0 END AS lut FROM voxels",
    "voxels",
)
a(
    "vol17_relabel_contiguous",
    on(lambda v: lb.relabelled(v).select("t", "z", "y", "x", "dense")),
    """
    SELECT t, z, y, x, coalesce(d, 0)::INTEGER AS dense
    FROM voxels
    LEFT
    JOIN (SELECT t, label, dense_rank() OVER (PARTITION BY t
    ORDER BY label) AS d
    FROM labels) USING (t, label)
    """,
    "voxels",
    "labels",
)
BOUND = """six AS (SELECT v.t, v.z, v.y, v.x, min(w.label) AS lo, max(w.label) AS hi FROM voxels v, (VALUES (0, 0, 0), (1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1)) d(a, b, c) JOIN voxels w ON w.t = v.t AND w.z = v.z + d.a AND w.y = v.y + d.b AND w.x = v.x + d.c GROUP BY 1, 2, 3, 4),
around AS (SELECT v.t, v.z, v.y, v.x, count(DISTINCT w.label) FILTER (WHERE w.label > 0) AS k FROM voxels v, range(-1, 2) p(a), range(-1, 2) q(b), range(-1, 2) u(c) JOIN voxels w ON w.t = v.t AND w.z = v.z + a AND w.y = v.y + b AND w.x = v.x + c GROUP BY 1, 2, 3, 4),
bound AS (SELECT v.*, lo <> hi AND (label = 0 OR k > 1) AS boundary FROM voxels v JOIN six USING (t, z, y, x) JOIN around USING (t, z, y, x))"""
BOOK.views["bound"] = BOUND
a("vol14_foreground_gate", on(lambda v: lb.foreground_gate(v).select("t", "z", "y", "x", "foreground")), "SELECT t, z, y, x, label > 0 AND NOT boundary AS foreground FROM bound", "voxels", "bound")
a(
    "vol14_boundary_width",
    on(lambda v: lb.foreground_gate(v, 2).select("t", "z", "y", "x", "foreground")),
    """
    SELECT v.t, v.z, v.y, v.x, v.label > 0 AND NOT bool_or(w.boundary) AS foreground
    FROM bound v, (VALUES (0, 0, 0), (1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1)) d(a, b, c)
    JOIN bound w ON w.t = v.t AND w.z = v.z + d.a AND w.y = v.y + d.b AND w.x = v.x + d.c
    GROUP BY v.t, v.z, v.y, v.x, v.label
    """,
    "voxels",
    "bound",
)
BOOK.views["smoothed"] = f"""gk AS {gauss(2.0)}, cz AS (SELECT a.t, a.z, a.y, a.x, sum(w * b.boundary::INTEGER) AS v FROM (SELECT t, z, y, x, w, {folded('z + d', fx.NZ)} AS s FROM bound, gk) a JOIN bound b ON a.t = b.t AND a.s = b.z AND a.y = b.y AND a.x = b.x GROUP BY 1, 2, 3, 4),
cy AS (SELECT a.t, a.z, a.y, a.x, sum(w * b.v) AS v FROM (SELECT t, z, y, x, w, {folded('y + d', fx.NY)} AS s FROM cz, gk) a JOIN cz b ON a.t = b.t AND a.z = b.z AND a.s = b.y AND a.x = b.x GROUP BY 1, 2, 3, 4),
cx AS (SELECT a.t, a.z, a.y, a.x, sum(w * b.v) AS v FROM (SELECT t, z, y, x, w, {folded('x + d', fx.NX)} AS s FROM cy, gk) a JOIN cy b ON a.t = b.t AND a.z = b.z AND a.y = b.y AND a.s = b.x GROUP BY 1, 2, 3, 4)"""
a(
    "vol22_label_contours",
    on(lambda v: rounded(lb.label_contours(v, SHAPE))),
    f"SELECT t, z, y, x, (label > 0)::INTEGER::DOUBLE AS foreground, {r('v AS contour')} FROM bound JOIN cx USING (t, z, y, x)",
    "voxels",
    "bound",
    "smoothed",
)
# Each voxel's least voxel reachable by faces, by a recursive walk.
COMPONENTS = """SELECT t, coalesce(sum(n) FILTER (WHERE n >= 20), 0)::BIGINT AS kept, sum(n)::BIGINT AS labelled, count(*) AS components, count(*) FILTER (WHERE n >= 20) AS large FROM (
  WITH RECURSIVE fg AS (SELECT t, z, y, x, (z * 24 + y) * 24 + x AS i FROM voxels WHERE label > 0),
  e AS (SELECT a.t, a.i AS a, b.i AS b FROM fg a, (VALUES (1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1)) d(p, q, u) JOIN fg b ON b.t = a.t AND b.z = a.z + p AND b.y = a.y + q AND b.x = a.x + u),
  walk AS (SELECT t, i AS root, i FROM fg UNION SELECT w.t, w.root, e.b FROM walk w JOIN e ON e.t = w.t AND e.a = w.i AND e.b > w.root),
  roots AS (SELECT t, i, min(root) AS root FROM walk GROUP BY 1, 2) SELECT t, root, count(*) AS n FROM roots GROUP BY 1, 2) GROUP BY 1"""
a(
    "vol15_remove_small_components",
    on(lambda v: lb.without_small_components(v, 20, 5).groupBy("t").agg(F.count_if("keep").alias("kept"), F.count_if(F.col("component") > 0).alias("labelled"), F.max("component").alias("components"), F.count_distinct(F.when(F.col("keep"), F.col("component"))).alias("large"))),
    COMPONENTS,
    "voxels",
)
a(
    "vol7_downscale_labels",
    on(lambda v: lb.nearest_labels(v, 0.5, fx.NY, fx.NX)),
    """
    SELECT t, z, y2::INTEGER AS y, x2::INTEGER AS x, label
    FROM voxels
    JOIN (SELECT i AS y2, floor((i + 0.5) * 2)::INTEGER AS y
    FROM range(12) q(i)) USING (y)
    JOIN (SELECT i AS x2, floor((i + 0.5) * 2)::INTEGER AS x
    FROM range(12) q(i)) USING (x)
    """,
    "voxels",
)
a("vol18_mask_axis_fix", on(lambda v: lb.axis_fixed(v.where("y < 6")).select("t", "z", "y", "x", "label")), "SELECT t, y AS z, z AS y, x, label FROM voxels WHERE y < 6", "voxels")
a("flt19_crop_roi", on(lambda v: fl.crop_roi(v, 4, 6, 10, 8, fx.NY, fx.NX)), "SELECT t, z, y - 4 AS y, x - 6 AS x, value, label FROM voxels WHERE y >= 4 AND y < 14 AND x >= 6 AND x < 14", "voxels")
a("flt20_max_timepoints", on(lambda v: fl.max_timepoints(v, 3).groupBy("t").agg(F.sum("value").alias("total"))), "SELECT t, sum(value)::BIGINT AS total FROM voxels WHERE t <= 3 GROUP BY 1", "voxels")
a(
    "flt21_stride_downsample",
    on(lambda v: fl.stride_downsample(v, 3)),
    "SELECT t, z // 3 AS z, y // 3 AS y, x // 3 AS x, value, label FROM voxels WHERE z % 3 = 0 AND y % 3 = 0 AND x % 3 = 0",
    "voxels",
)
a("srt5_first_middle_last", on(fl.first_middle_last), "SELECT DISTINCT t FROM voxels WHERE t IN (1, 3, 7)", "voxels")
a("smp5_all_labels", on(lambda v: lb.per_label(v).groupBy("t").agg(F.count(F.lit(1)).alias("n"))), "SELECT t, count(*) AS n FROM labels GROUP BY 1", "voxels", "labels")
