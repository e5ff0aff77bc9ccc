"""Volume transforms over voxel tables (t, z, y, x, value): corrections, resampling, projections, stencils.

Relational steps stay in SQL functions. Kernels that need a neighbourhood or a spline work on one plane or one column at a time in
Arrow batches, so memory follows the size of a plane, not of a volume.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tetraframe.functions.scalars import clip
from tetraframe.operators.image import contrast_percentiles

TYPE_MAX = 65535


def as_uint16(x: Column) -> Column:
    """Clipped to the type and truncated."""
    return clip(x, 0, TYPE_MAX).cast("int")


def z_level_smooth(levels: DataFrame, window: int, column: str = "level") -> DataFrame:
    """(t, z, level): moving average along z with repeated ends; an even window becomes odd. One row a slice."""
    w = window + 1 - window % 2
    p = w // 2
    top = levels.groupBy("t").agg(F.max("z").alias("_top"))
    spread = levels.select("t", "z").join(top, "t").withColumn("_d", F.explode(F.sequence(F.lit(-p), F.lit(p))))
    spread = spread.withColumn("_z", F.least(F.greatest(F.col("z") + F.col("_d"), F.lit(0)), F.col("_top")))
    src = levels.select("t", F.col("z").alias("_z"), F.col(column).alias("_v"))
    return spread.join(src, ["t", "_z"]).groupBy("t", "z").agg(F.avg("_v").alias(column))


def depth_correction(voxels: DataFrame, percentile: float | None = 0.99, window: int = 9, low: float = 0.25, high: float = 4.0, eps: float = 1e-6) -> DataFrame:
    """Add corrected: every slice scaled so that its smoothed level meets the median level; percentile None: the mean.

    The scale table has one row a slice and is joined, broadcast when small.
    """
    level = F.avg("value") if percentile is None else F.percentile("value", percentile)
    levels = voxels.groupBy("t", "z").agg(F.greatest(level, F.lit(eps)).alias("level"))
    smooth = z_level_smooth(levels, window)
    target = smooth.groupBy("t").agg(F.median("level").alias("_t"))
    scale = smooth.join(target, "t").select("t", "z", clip(F.col("_t") / F.col("level"), low, high).alias("scale"))
    return voxels.join(scale, ["t", "z"]).withColumn("corrected", as_uint16(F.col("value") * F.col("scale")))


def depth_correction_damped(voxels: DataFrame, percentile: float = 0.5, window: int = 11, most: float = 2.0, floor_share: float = 0.25) -> DataFrame:
    """(t, z, scale): to the median of the smoothed slice levels; below a share of it a slice is scaled less, in proportion; then held to `most`."""
    levels = voxels.groupBy("t", "z").agg(F.greatest(F.percentile("value", percentile), F.lit(1e-8)).alias("level"))
    smooth = z_level_smooth(levels, window)
    target = smooth.groupBy("t").agg(F.median("level").alias("_t"))
    full, floor = F.col("_t") / F.col("level"), F.col("_t") * floor_share
    damped = F.when(F.col("level") < floor, 1 + (full - 1) * F.col("level") / (floor + 1e-8)).otherwise(full)
    return smooth.join(target, "t").select("t", "z", F.least(damped, F.lit(most)).alias("scale"))


def camera_background_subtract(voxels: DataFrame, percentile: float = 0.02) -> DataFrame:
    """Add corrected: less the slice's low percentile, not below 0."""
    q = voxels.groupBy("t", "z").agg(F.percentile("value", percentile).alias("_q"))
    return voxels.join(q, ["t", "z"]).withColumn("corrected", F.greatest(F.col("value") - F.col("_q"), F.lit(0.0))).drop("_q")


def gaussian_kernel(sigma: float, truncate: float = 4.0) -> np.ndarray:
    """Weights of a truncated Gaussian, radius int(truncate * sigma + 0.5)."""
    r = int(truncate * sigma + 0.5)
    x = np.arange(-r, r + 1)
    w = np.exp(-0.5 * (x / sigma) ** 2)
    return w / w.sum()


def _mirrored(n: int, r: int) -> np.ndarray:
    """Indices -r .. n-1+r mirrored at the edges, the edge doubled."""
    i = np.arange(-r, n + r) % (2 * n)
    return np.where(i < n, i, 2 * n - 1 - i)


def smooth_plane(plane: np.ndarray, sigma: float) -> np.ndarray:
    """A separable Gaussian over a plane with mirrored edges."""
    k = gaussian_kernel(sigma)
    r = len(k) // 2
    for axis in (0, 1):
        n = plane.shape[axis]
        a = np.moveaxis(plane, axis, 0)[_mirrored(n, r)]
        out = np.zeros((n, *a.shape[1:]))
        for j, w in enumerate(k):
            out += w * a[j : j + n]
        plane = np.moveaxis(out, 0, axis)
    return plane


def _plane(pdf: pd.DataFrame, column: str = "value") -> np.ndarray:
    out = np.zeros((int(pdf["y"].max()) + 1, int(pdf["x"].max()) + 1))
    out[pdf["y"], pdf["x"]] = pdf[column]
    return out


def shading_field(voxels: DataFrame, sigma: float = 64.0, least: float = 1e-8) -> DataFrame:
    """(t, y, x, gain): mean over the smoothed projection of the mean over z, the projection held at `least`. One plane a t is in a task."""
    mean = voxels.groupBy("t", "y", "x").agg(F.avg("value").alias("value"))

    def gain(pdf: pd.DataFrame) -> pd.DataFrame:
        field = np.maximum(smooth_plane(_plane(pdf), sigma), least)
        g = field.mean() / field
        return pdf[["t", "y", "x"]].assign(gain=g[pdf["y"], pdf["x"]])

    return mean.groupBy("t").applyInPandas(gain, "t int, y int, x int, gain double")


def planar_correction(voxels: DataFrame, sigma: float = 64.0, most: float | None = 2.0) -> DataFrame:
    """Add corrected: voxels times the shading gain, the gain capped."""
    field = shading_field(voxels, sigma)
    gain = F.col("gain") if most is None else F.least(F.col("gain"), F.lit(most))
    return voxels.join(field, ["t", "y", "x"]).withColumn("corrected", as_uint16(F.col("value") * gain)).drop("gain")


def shading_diagnosis(voxels: DataFrame, sigma: float = 96.0) -> DataFrame:
    """Add gain and corrected: voxels times the shading gain, neither capped nor rounded."""
    return voxels.join(shading_field(voxels, sigma, 1e-6), ["t", "y", "x"]).withColumn("corrected", F.col("value") * F.col("gain"))


def local_noise(voxels: DataFrame, size: int = 7) -> DataFrame:
    """Add noise: the deviation in a square around each voxel of its plane, edges mirrored."""
    r = size // 2

    def noise(pdf: pd.DataFrame) -> pd.DataFrame:
        p = _plane(pdf)
        p = p[_mirrored(p.shape[0], r)][:, _mirrored(p.shape[1], r)]

        def mean(a: np.ndarray) -> np.ndarray:
            c = np.pad(a.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
            return (c[size:, size:] - c[:-size, size:] - c[size:, :-size] + c[:-size, :-size]) / size**2

        n = np.sqrt(np.maximum(mean(p * p) - mean(p) ** 2, 0))
        return pdf[["t", "z", "y", "x"]].assign(noise=n[pdf["y"], pdf["x"]])

    return voxels.select("t", "z", "y", "x", "value").groupBy("t", "z").applyInPandas(noise, "t int, z int, y int, x int, noise double")


def _reflected(i: Column, n: int) -> Column:
    """Indices up to one period outside 0..n-1, mirrored about the end samples."""
    return F.when(i < 0, -i).when(i > n - 1, 2 * (n - 1) - i).otherwise(i) if n > 1 else F.lit(0)


def resliced_linear(voxels: DataFrame, nz: int, new_nz: int, edge: str = "corners") -> DataFrame:
    """(t, z, y, x, value): linear interpolation along z to another number of slices.

    edge "corners": end slices meet, source i * (nz - 1) / (new_nz - 1). Otherwise pixel centres do, and beyond the end slices stand
    "mirror" their mirror image or "zero" nothing.
    """
    if new_nz == nz:
        return voxels.select("t", "z", "y", "x", F.col("value").cast("double").alias("value"))
    i = F.col("_i")
    src = i * ((nz - 1) / max(new_nz - 1, 1)) if edge == "corners" else (i + 0.5) * (nz / new_nz) - 0.5
    plan = voxels.sparkSession.range(new_nz).select(F.col("id").cast("int").alias("_i")).select("_i", src.alias("_s"))  # one row a new slice
    low = F.floor("_s").cast("int")
    tap = lambda k: F.struct((low + k).alias("z"), (F.col("_s") - low if k else 1 - (F.col("_s") - low)).alias("w"))
    taps = plan.select("_i", F.explode(F.array(tap(0), tap(1))).alias("_t")).select("_i", "_t.z", "_t.w").where("w > 0")
    taps = taps.where(F.col("z").between(0, nz - 1)) if edge == "zero" else taps.withColumn("z", _reflected(F.col("z"), nz))
    return voxels.join(F.broadcast(taps), "z").groupBy("t", "_i", "y", "x").agg(F.sum(F.col("value") * F.col("w")).alias("value")).select("t", F.col("_i").alias("z"), "y", "x", "value")


def _mirror(i: np.ndarray, n: int) -> np.ndarray:
    """Any indices mirrored about the end samples, which are not doubled."""
    if n == 1:
        return np.zeros_like(i)
    i = np.abs(i) % (2 * n - 2)
    return np.where(i < n, i, 2 * n - 2 - i)


def spline_weights(n: int, m: int, order: int = 3, antialias: bool = True) -> np.ndarray:
    """Matrix (m, n) that resamples n samples to m at pixel centres by a spline, linear or cubic, through the samples, ends mirrored.

    Cubic: the coefficients solve the B-spline's equations at the samples. Shrinking axes are smoothed first by a Gaussian of
    deviation (n / m - 1) / 2.
    """
    x = (np.arange(m) + 0.5) * (n / m) - 0.5
    base = np.floor(x).astype(int)
    rows, out = np.arange(m), np.zeros((m, n))
    if order <= 1:
        for k in (0, 1):
            np.add.at(out, (rows, _mirror(base + k, n)), np.abs(1 - k - (x - base)))
    else:
        basis = lambda d: np.where(d < 1, 2 / 3 - d * d + d**3 / 2, np.where(d < 2, (2 - d) ** 3 / 6, 0))
        for k in range(-1, 3):
            np.add.at(out, (rows, _mirror(base + k, n)), basis(np.abs(x - (base + k))))
        at = np.zeros((n, n))
        for k, w in ((-1, 1 / 6), (0, 2 / 3), (1, 1 / 6)):
            np.add.at(at, (np.arange(n), _mirror(np.arange(n) + k, n)), w)
        out = np.linalg.solve(at.T, out.T).T
    if antialias and m < n:
        k = gaussian_kernel((n / m - 1) / 2)
        blur, r = np.zeros((n, n)), len(k) // 2
        for j, w in enumerate(k):
            np.add.at(blur, (np.arange(n), _mirror(np.arange(n) + j - r, n)), w)
        out = out @ blur
    return out


def _planes(voxels: DataFrame, ny: int, nx: int, my: int, mx: int, order: int = 3) -> DataFrame:
    """Every plane resampled in y and x."""
    a, b = spline_weights(ny, my, order), spline_weights(nx, mx, order)

    def scale(pdf: pd.DataFrame) -> pd.DataFrame:
        p = np.zeros((ny, nx))
        p[pdf["y"], pdf["x"]] = pdf["value"]
        y, x = np.mgrid[:my, :mx]
        return pd.DataFrame({"t": int(pdf["t"].iat[0]), "z": int(pdf["z"].iat[0]), "y": y.ravel(), "x": x.ravel(), "value": (a @ p @ b.T).ravel()})

    return voxels.select("t", "z", "y", "x", "value").groupBy("t", "z").applyInPandas(scale, "t int, z int, y int, x int, value double")


def _along_z(voxels: DataFrame, nz: int, mz: int, order: int = 3) -> DataFrame:
    """Every column resampled in z."""
    w = spline_weights(nz, mz, order)

    def one(z: pd.Series, v: pd.Series) -> pd.Series:
        a = np.zeros((len(z), nz))
        a[np.repeat(np.arange(len(z)), [len(i) for i in z]), np.concatenate(z.to_numpy())] = np.concatenate(v.to_numpy())
        return pd.Series(list(a @ w.T))

    columns = voxels.groupBy("t", "y", "x").agg(F.collect_list("z").alias("_z"), F.collect_list("value").alias("_v"))  # a column has nz voxels
    return columns.select("t", "y", "x", F.posexplode(F.pandas_udf(one, "array<double>")("_z", "_v")).alias("z", "value")).select("t", "z", "y", "x", "value")


def within_range(resampled: DataFrame, source: DataFrame) -> DataFrame:
    """Values held inside the range of the source volume of each t, which a spline overshoots."""
    e = source.groupBy("t").agg(F.min("value").cast("double").alias("_lo"), F.max("value").cast("double").alias("_hi"))  # a row a t
    return resampled.join(e, "t").withColumn("value", F.least(F.greatest("value", "_lo"), F.col("_hi"))).drop("_lo", "_hi")


def truncated(x: Column) -> Column:
    """The whole part; sums that miss a whole number by rounding alone count as it."""
    return F.round(x, 6).cast("int")


def rescaled_xy(voxels: DataFrame, ny: int, nx: int, factor: float) -> DataFrame:
    """(t, z, y, x, value): planes rescaled by a cubic spline, smoothed first when they shrink, held inside the volume's range."""
    return within_range(_planes(voxels, ny, nx, max(1, round(ny * factor)), max(1, round(nx * factor))), voxels)


def isotropic(voxels: DataFrame, shape: tuple[int, int, int], spacing: tuple[float, float, float], target: float, order: int = 3) -> DataFrame:
    """All three axes resampled to one voxel size by a linear (order 1) or cubic spline, smoothed first on shrinking axes.

    Values are held inside the volume's range and truncated to whole numbers; a volume of that size already stays as it is.
    """
    new = [max(1, round(n * s / target)) for n, s in zip(shape, spacing)]
    out = voxels.select("t", "z", "y", "x", "value")
    if list(shape) == new:
        return out
    if new[1:] != list(shape[1:]):
        out = _planes(out, *shape[1:], *new[1:], order)
    if new[0] != shape[0]:
        linear = order <= 1 and new[0] > shape[0]
        out = resliced_linear(out, shape[0], new[0], "mirror") if linear else _along_z(out, shape[0], new[0], order)
    return within_range(out, voxels).withColumn("value", truncated(F.col("value")))


def raw_isotropic(voxels: DataFrame, shape: tuple[int, int, int], factor: float, new_nz: int) -> DataFrame:
    """Planes rescaled by a cubic spline, then slices interpolated linearly at pixel centres with nothing beyond the ends; whole numbers."""
    planes = rescaled_xy(voxels, shape[1], shape[2], factor)
    out = planes if new_nz == shape[0] else within_range(resliced_linear(planes, shape[0], new_nz, "zero"), planes)
    return out.withColumn("value", as_uint16(F.round("value", 6)))


def slab_projection(voxels: DataFrame, axis: str, low: int, high: int, how: str = "max") -> DataFrame:
    """Projection of an index range along an axis."""
    keep = [a for a in "zyx" if a != axis]
    f = {"max": F.max, "mean": F.avg}[how]
    return voxels.where(F.col(axis).between(low, high)).groupBy("t", *keep).agg(f("value").alias("value"))


def oriented_slab(voxels: DataFrame, rotation: np.ndarray, center: tuple[float, float, float], size: int, depth: int, step: float = 1.0, how: str = "max") -> DataFrame:
    """(t, i, j, value): a plane through a centre (z, y, x) with axes turned by a rotation, nearest voxels, projected over its depth.

    The grid has size * size * depth points and is broadcast; it joins the voxels by position.
    """
    spark = voxels.sparkSession
    n = size * size * depth
    if n > 256 * 256 * 5:
        raise ValueError("at most 256 x 256 x 5 points")
    g = spark.range(n).select(F.floor(F.col("id") / (size * size)).cast("int").alias("k"), (F.floor(F.col("id") / size) % size).cast("int").alias("i"), (F.col("id") % size).cast("int").alias("j"))
    local = [(F.col("k") - (depth - 1) / 2) * step, (F.col("i") - (size - 1) / 2) * step, (F.col("j") - (size - 1) / 2) * step]
    r = np.asarray(rotation, float).T
    at = [F.rint(sum((local[c] * float(r[row, c]) for c in range(1, 3)), local[0] * float(r[row, 0])) + float(center[row])).cast("int") for row in range(3)]
    grid = g.select("i", "j", *(p.alias(a) for p, a in zip(at, "zyx")))
    f = {"max": F.max, "mean": F.avg}[how]
    return voxels.join(F.broadcast(grid), ["z", "y", "x"]).groupBy("t", "i", "j").agg(f("value").alias("value"))


def as_uint8(voxels: DataFrame, low: float = 0.5, high: float = 99.5, stride: int = 2) -> DataFrame:
    """Add byte: the contrast window of all time points mapped to 0..255."""
    window = contrast_percentiles(voxels, low, high, stride).select(F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))  # one row
    v = (F.col("value") - F.col("_lo")) * (255.0 / F.greatest(F.col("_hi") - F.col("_lo"), F.lit(1e-10)))
    return voxels.crossJoin(F.broadcast(window)).withColumn("byte", clip(v, 0, 255).cast("int")).drop("_lo", "_hi")


def normalised(voxels: DataFrame, percentile: float = 0.999) -> DataFrame:
    """Add norm: over a high percentile of the values above zero, held in 0..1."""
    q = voxels.groupBy("t").agg(F.percentile(F.when(F.col("value") > 0, F.col("value")), percentile).alias("_q"))
    return voxels.join(q, "t").withColumn("norm", clip(F.coalesce(F.try_divide(F.col("value"), F.col("_q")), F.lit(0.0)), 0.0, 1.0)).drop("_q")


def padded_hyperstack(voxels: DataFrame, flip_y: bool = False) -> DataFrame:
    """A dense stack in which short time points are filled with zeros to the greatest z; y may be mirrored."""
    e = voxels.groupBy("t").agg(*(F.max(a).alias(f"_{a}") for a in "zyx"))
    both = e.agg(F.max("_z").alias("_nz"), F.count_distinct("_y", "_x").alias("_k"), F.max("_y").alias("_ny"), F.max("_x").alias("_nx"))
    spine = e.select("t").crossJoin(F.broadcast(both))  # one row
    spine = spine.select("t", "_ny", "_nx", F.explode(F.sequence(F.lit(0), F.col("_nz"))).alias("z")).select("t", "z", "_nx", "_ny", F.explode(F.sequence(F.lit(0), F.col("_ny"))).alias("y"))
    spine = spine.select("t", "z", "y", "_ny", F.explode(F.sequence(F.lit(0), F.col("_nx"))).alias("x"))
    out = spine.join(voxels.select("t", "z", "y", "x", "value"), ["t", "z", "y", "x"], "left")
    y = F.col("_ny") - F.col("y") if flip_y else F.col("y")
    return out.select("t", "z", y.alias("y"), "x", F.coalesce("value", F.lit(0)).alias("value"))


def pyramid(voxels: DataFrame, factors: tuple[int, ...] = (1, 2, 4)) -> DataFrame:
    """(level, t, z, y, x, value): nearest levels, every factor-th voxel."""
    out = None
    for level, f in enumerate(factors):
        rows = voxels.where(" AND ".join(f"{a} % {f} = 0" for a in "zyx")).select(F.lit(level).alias("level"), "t", *(F.floor(F.col(a) / f).cast("int").alias(a) for a in "zyx"), "value")
        out = rows if out is None else out.unionByName(rows)
    return out
