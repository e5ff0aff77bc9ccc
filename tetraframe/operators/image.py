"""Image statistics of voxel tables (t, z, y, x, value): by slice and by volume."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PERCENTS = (1, 5, 25, 50, 75, 95, 99)


def per_slice_stats(voxels: DataFrame) -> DataFrame:
    """A row a slice: moments, percentiles, ends, zeros and saturated voxels."""
    q = F.percentile("value", F.lit([p / 100 for p in PERCENTS]))
    out = voxels.groupBy("t", "z").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), q.alias("_q"), F.max("value").alias("max"), F.min("value").alias("min"),
        F.count_if(F.col("value") == 0).alias("n_zero"), F.count_if(F.col("value") >= 65535).alias("n_sat"),
    )
    return out.select("t", "z", "mean", "std", *(F.col("_q")[i].alias(f"p{p}") for i, p in enumerate(PERCENTS)), "max", "min", "n_zero", "n_sat")


def _snr(voxels: DataFrame, keys: list[str], fewest: int) -> DataFrame:
    """95th percentile over the deviation of the values up to the 10th; null without enough of these."""
    cut = voxels.groupBy(*keys).agg(F.percentile("value", F.lit([0.95, 0.1])).alias("_q"))
    low = F.when(F.col("value") <= F.col("_q")[1], F.col("value"))
    out = voxels.join(cut, keys).groupBy(*keys).agg(F.count(low).alias("_n"), F.stddev_pop(low).alias("_s"), F.first("_q")[0].alias("_p"))
    return out.select(*keys, F.when((F.col("_n") >= fewest) & (F.col("_s") >= 1e-10), F.col("_p") / F.col("_s")).alias("snr"))


def robust_snr_per_slice(voxels: DataFrame) -> DataFrame:
    """(t, z, snr) with more than 50 background voxels; 0 without them or without noise."""
    return _snr(voxels, ["t", "z"], 51).withColumn("snr", F.coalesce("snr", F.lit(0.0)))


def noise_per_slice(voxels: DataFrame) -> DataFrame:
    """(t, z, snr, noise_std): deviation of the values up to the 10th percentile (0 for 50 voxels or fewer), and the 95th over it (0 without noise)."""
    cut = voxels.groupBy("t", "z").agg(F.percentile("value", F.lit([0.95, 0.1])).alias("_q"))
    low = F.when(F.col("value") <= F.col("_q")[1], F.col("value"))
    out = voxels.join(cut, ["t", "z"]).groupBy("t", "z").agg(F.when(F.count(low) > 50, F.stddev_pop(low)).otherwise(0.0).alias("noise_std"), F.first("_q")[0].alias("_p"))
    return out.select("t", "z", F.when(F.col("noise_std") > 1e-10, F.col("_p") / F.col("noise_std")).otherwise(0.0).alias("snr"), "noise_std")


def volume_snr(voxels: DataFrame) -> DataFrame:
    """(t, snr) with 100 background voxels or more."""
    return _snr(voxels, ["t"], 100)


def dynamic_range_info(voxels: DataFrame) -> DataFrame:
    """A row a t: ends, percentiles, shares of zero and saturated voxels, moments."""
    out = voxels.groupBy("t").agg(
        F.min("value").alias("min"), F.max("value").alias("max"), F.percentile("value", F.lit([0.01, 0.99, 0.999])).alias("_q"), F.avg((F.col("value") == 0).cast("double")).alias("frac_zero"),
        F.avg((F.col("value") >= 65535).cast("double")).alias("frac_sat"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
    )
    return out.select("t", "min", "max", *(F.col("_q")[i].alias(n) for i, n in enumerate(("p1", "p99", "p999"))), "frac_zero", "frac_sat", "mean", "std")


def image_stats(voxels: DataFrame) -> DataFrame:
    """A row a t: ends, mean, three percentiles, share of zeros."""
    out = voxels.groupBy("t").agg(F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"), F.percentile("value", F.lit([0.01, 0.5, 0.99])).alias("_q"), F.avg((F.col("value") == 0).cast("double")).alias("frac_zero"))
    return out.select("t", "min", "max", "mean", *(F.col("_q")[i].alias(n) for i, n in enumerate(("p01", "p50", "p99"))), "frac_zero")


def edge_ratio(voxels: DataFrame, shape: tuple[int, int, int], border: int = 10) -> DataFrame:
    """(t, edge_ratio): mean of the border on all faces over the mean inside."""
    inside = None
    for a, n in zip("zyx", shape):
        c = (F.col(a) >= border) & (F.col(a) < n - border)
        inside = c if inside is None else inside & c
    v = F.col("value")
    return voxels.groupBy("t").agg(F.try_divide(F.avg(F.when(~inside, v)), F.avg(F.when(inside, v))).alias("edge_ratio"))


def z_uniformity(voxels: DataFrame) -> DataFrame:
    """(t, z_uniformity): relative deviation of the slice means."""
    m = voxels.groupBy("t", "z").agg(F.avg("value").alias("m"))
    return m.groupBy("t").agg(F.try_divide(F.stddev_pop("m"), F.avg("m")).alias("z_uniformity"))


def sharpness(voxels: DataFrame, shape: tuple[int, int, int], slices: int = 5) -> DataFrame:
    """(t, sharpness): mean over evenly spaced slices of the variance of the Laplacian; edges are mirrored with the edge doubled."""
    nz = shape[0]
    zs = [int(i * (nz - 1) / (slices - 1)) for i in range(slices)]
    v = voxels.where(F.col("z").isin(zs))
    wx, wy = Window.partitionBy("t", "z", "y").orderBy("x"), Window.partitionBy("t", "z", "x").orderBy("y")
    near = lambda w: F.coalesce(F.lag("value").over(w), F.col("value")) + F.coalesce(F.lead("value").over(w), F.col("value"))
    lap = v.withColumn("_x", near(wx)).withColumn("_l", near(wy) + F.col("_x") - 4 * F.col("value"))
    return lap.groupBy("t", "z").agg(F.var_pop("_l").alias("_v")).groupBy("t").agg(F.avg("_v").alias("sharpness"))


def dynamic_range(voxels: DataFrame, top: float = 65535.0) -> DataFrame:
    """(t, dynamic_range): spread between the 0.1th and 99.9th percentile over the type's range."""
    q = voxels.groupBy("t").agg(F.percentile("value", F.lit([0.999, 0.001])).alias("_q"))
    return q.select("t", ((F.col("_q")[0] - F.col("_q")[1]) / top).alias("dynamic_range"))


def z_frequency(voxels: DataFrame, shape: tuple[int, int, int], grid: int = 20) -> DataFrame:
    """(t, z_frequency): share of spectral power along z at or above a quarter of the spectrum, mean over columns.

    The columns are those of a grid over the middle half of the plane, grid by grid of them; a column that two grid lines share counts
    for each. Columns without variation are left out; without any other the result is 0.
    """
    nz, ny, nx = shape
    ys, xs = (np.linspace(n // 4, 3 * n // 4, grid, dtype=int).tolist() for n in (ny, nx))
    times = lambda at: {k: at.count(k) for k in sorted(set(at))}
    weight = lambda a, at: F.create_map(*(F.lit(v) for kv in times(at).items() for v in kv))[F.col(a)]
    picked = voxels.where(F.col("y").isin(sorted(set(ys))) & F.col("x").isin(sorted(set(xs))))
    columns = picked.groupBy("t", "y", "x").agg(F.collect_list("z").alias("_z"), F.collect_list("value").alias("_v"))  # a column has nz voxels

    def share(z: pd.Series, v: pd.Series) -> pd.Series:
        a = np.zeros((len(z), nz))
        a[np.repeat(np.arange(len(z)), [len(i) for i in z]), np.concatenate(z.to_numpy())] = np.concatenate(v.to_numpy())
        power = np.abs(np.fft.rfft(a, axis=1)) ** 2
        total = power.sum(1)
        dead = (a.std(1) < 1e-10) | (total < 1e-20)
        return pd.Series(np.where(dead, np.nan, power[:, power.shape[1] // 4 :].sum(1) / np.where(dead, 1, total)))

    rows = columns.select("t", (weight("y", ys) * weight("x", xs)).alias("_w"), F.nanvl(F.pandas_udf(share, "double")("_z", "_v"), F.lit(None)).alias("_s"))
    mean = F.try_divide(F.sum(F.col("_s") * F.col("_w")), F.sum(F.when(F.col("_s").isNotNull(), F.col("_w"))))
    return rows.groupBy("t").agg(F.coalesce(mean, F.lit(0.0)).alias("z_frequency"))


def contrast_percentiles(voxels: DataFrame, low: float = 0.5, high: float = 99.5, stride: int = 2, bins: int = 256) -> DataFrame:
    """(lo, hi): values at two percentiles of a histogram of the strided voxels above zero.

    The histogram spans all strided voxels, zeros included. One value throughout gives that value, nothing above zero the least.
    """
    v = voxels.where(" AND ".join(f"{a} % {stride} = 0" for a in "zyx")).select("value")
    e = v.agg(F.min("value").cast("double").alias("_lo"), F.max("value").cast("double").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(width > 0, F.least(F.floor((F.col("value") - F.col("_lo")) / width), F.lit(bins - 1))).otherwise(0).cast("int")
    h = v.where("value > 0").crossJoin(F.broadcast(e)).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("c"))
    h = h.withColumns({"_up": F.sum("c").over(Window.orderBy("bin")), "_n": F.sum("c").over(Window.partitionBy())})  # 256 rows
    first = lambda p: F.min(F.when(F.col("_up") >= F.col("_n") * (p / 100), F.col("bin")))
    at = h.agg(first(low).alias("_a"), first(high).alias("_b"))
    place = lambda c: F.col("_lo") + F.coalesce(F.col(c), F.lit(0)) * width
    return e.crossJoin(at).select(place("_a").alias("lo"), place("_b").alias("hi"))  # one row each


def camera_noise_table(voxels: DataFrame) -> DataFrame:
    """A row a slice: low percentiles, contrast, shares under the background's bound and over the slice's own 90th percentile.

    The background are values below the volume's 30th percentile.
    """
    cut = voxels.groupBy("t").agg(F.percentile("value", 0.3).alias("_c"))
    bg = voxels.join(F.broadcast(cut), "t").where("value < _c").groupBy("t").agg((F.avg("value") + 3 * F.stddev_pop("value")).alias("_b"))
    q = voxels.groupBy("t", "z").agg(F.percentile("value", F.lit([0.02, 0.05, 0.5, 0.995, 0.005, 0.9])).alias("_q"))
    rows = voxels.join(q, ["t", "z"]).join(F.broadcast(bg), "t", "left")
    out = rows.groupBy("t", "z").agg(F.first("_q").alias("_q"), F.avg((F.col("value") < F.col("_b")).cast("double")).alias("bg_share"), F.avg((F.col("value") > F.col("_q")[5]).cast("double")).alias("bright_share"))
    return out.select("t", "z", F.col("_q")[0].alias("p2"), F.col("_q")[1].alias("p5"), F.col("_q")[2].alias("p50"), (F.col("_q")[3] - F.col("_q")[4]).alias("contrast"), F.coalesce("bg_share", F.lit(0.0)).alias("bg_share"), "bright_share")


def slice_contrast(projected: DataFrame) -> DataFrame:
    """(lo, hi): whole percentiles of the pixels above zero, hi above lo; 0 and 255 without any."""
    q = projected.where("value > 0").agg(F.percentile("value", F.lit([0.01, 0.995])).alias("_q"))
    lo = F.floor(F.col("_q")[0]).cast("int")
    return q.select(F.coalesce(lo, F.lit(0)).alias("lo"), F.coalesce(F.greatest(F.floor(F.col("_q")[1]).cast("int"), lo + 1), F.lit(255)).alias("hi"))
