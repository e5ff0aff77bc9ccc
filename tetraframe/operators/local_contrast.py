"""Local contrast and wavelet background of planes, the older processing chain, over voxel tables (t, z, y, x, value).

Histograms of tiles, their clipped maps and the blending of four maps are groupings and one join; a task holds no plane. Wavelet levels
are groupings of two by two places, so a level is a quarter of the one before. Only the Gaussian of the background takes planes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tetraframe.functions.scalars import clip
from tetraframe.operators.volumes import TYPE_MAX, as_uint16, smooth_plane

#: Grey levels before binning, and bins of a tile's histogram; fixed values of the method.
GREYS, BINS = 1 << 14, 256

# --- local histogram equalisation --------------------------------------------------------------------------------


def clipped_histogram(counts: np.ndarray, most: int) -> np.ndarray:
    """counts with what lies above `most` spread over the bins below it: evenly first, then one at a time at even steps, of which the last round may add a few more."""
    h = np.minimum(counts, most)
    over = int(counts.sum() - h.sum())
    share = over // len(h)
    full = most - share
    low, middle = h < full, (h >= full) & (h < most)
    over -= int(low.sum()) * share + int((most - h[middle]).sum())
    h = np.where(low, h + share, np.where(middle, most, h))
    while over > 0:
        before = over
        for first in range(len(h)):
            step = max(1, int((h < most).sum()) // over)
            places = np.arange(first, len(h), step)
            places = places[h[places] < most]
            h[places] += 1
            over -= len(places)
            if over <= 0:
                break
        if over == before:
            break
    return h


def tile_map(counts: np.ndarray, most: int, pixels: int) -> np.ndarray:
    """The grey level that each bin of a tile becomes."""
    return np.minimum(np.cumsum(clipped_histogram(counts, most)) * ((GREYS - 1) / pixels), GREYS - 1).astype(np.int64)


def contrast_window(voxels: DataFrame, low: float, high: float) -> DataFrame:
    """(t, z, _lo, _hi): percentiles of each slice."""
    return voxels.groupBy("t", "z").agg(F.percentile("value", low / 100).alias("_lo"), F.percentile("value", high / 100).alias("_hi"))


def _mirrored(place: str, size: int, tiles: int, kernel: int) -> Column:
    """The place and, where the last tile goes beyond the edge, the place there that mirrors it (the edge itself once)."""
    other = F.lit(2 * size - 2) - F.col(place)
    return F.when((other >= size) & (other < tiles * kernel), F.array(F.col(place), other)).otherwise(F.array(F.col(place)))


def local_equalisation(voxels: DataFrame, shape: tuple[int, int], clip_limit: float = 0.01, kernel: tuple[int, int] | None = None, low: float = 0.5, high: float = 99.5) -> DataFrame:
    """Add equalised: each slice's values between two percentiles, equalised in tiles of `kernel` places with clipped histograms.

    shape: y and x of all slices, kernel an eighth of it unless given. A voxel's grey level comes from the maps of the four tiles whose
    centres are around it. A slice without contrast becomes zero; the result of a slice is spread over the whole range of the type.
    """
    ny, nx = shape
    ky, kx = kernel or (max(ny // 8, 1), max(nx // 8, 1))
    tiles = (-(-ny // ky), -(-nx // kx))
    pixels = ky * kx
    most = max(int(clip_limit * pixels), 1) if clip_limit > 0 else 1 << 20
    # A row a slice: broadcast when small, and else joined by slice.
    window = contrast_window(voxels, low, high)
    grey = F.floor((clip(F.col("value"), F.col("_lo"), F.col("_hi")) - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * (GREYS - 1))
    rows = voxels.join(window, ["t", "z"]).withColumn("_bin", F.when(F.col("_hi") > F.col("_lo") + 1e-8, F.floor(grey / (1 + GREYS // BINS))).cast("int")).drop("_lo", "_hi")
    placed = rows.where("_bin IS NOT NULL").select("t", "z", F.explode(_mirrored("y", ny, tiles[0], ky)).alias("y"), "x", "_bin")
    placed = placed.select("t", "z", F.floor(F.col("y") / ky).cast("int").alias("ty"), F.explode(_mirrored("x", nx, tiles[1], kx)).alias("x"), "_bin")
    counts = placed.groupBy("t", "z", "ty", F.floor(F.col("x") / kx).cast("int").alias("tx"), "_bin").agg(F.count(F.lit(1)).alias("_n"))
    tile = counts.groupBy("t", "z", "ty", "tx").agg(F.collect_list("_bin").alias("bins"), F.collect_list("_n").alias("counts"))  # 256 at most

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for bins, n in zip(batch.column("bins"), batch.column("counts")):
                h = np.zeros(BINS, np.int64)
                h[bins.values.to_numpy()] = n.values.to_numpy()
                out.append(tile_map(h, most, pixels))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("t", "z", "ty", "tx")), pa.array(out, pa.list_(pa.int64()))], ["t", "z", "ty", "tx", "map"])

    mapped = tile.mapInArrow(maps, "t int, z int, ty int, tx int, map array<long>")
    # A cell lies between the centres of four tiles; beyond the outermost centres the edge tile stands for the missing one.
    near = lambda at: F.explode(F.sequence(F.col(at), F.col(at) + 1))
    sides = lambda at, n, cell: (F.greatest(F.col(cell) - 1, F.lit(0)) == F.col(at), F.least(F.col(cell), F.lit(n - 1)) == F.col(at))
    cells = mapped.withColumn("cy", near("ty")).withColumn("cx", near("tx"))
    (y0, y1), (x0, x1) = sides("ty", tiles[0], "cy"), sides("tx", tiles[1], "cx")
    corners = cells.groupBy("t", "z", "cy", "cx").agg(*(F.max(F.when(a & b, F.col("map"))).alias(f"_m{i}{j}") for i, a in enumerate((y0, y1)) for j, b in enumerate((x0, x1))))
    py, px = F.col("y") + ky // 2, F.col("x") + kx // 2
    cell = rows.withColumns({"cy": F.floor(py / ky).cast("int"), "cx": F.floor(px / kx).cast("int"), "_wy": (py % ky) / ky, "_wx": (px % kx) / kx})
    m = {c: F.get(F.col(f"_m{c}"), F.col("_bin")) for c in ("00", "01", "10", "11")}
    blended = (1 - F.col("_wy")) * ((1 - F.col("_wx")) * m["00"] + F.col("_wx") * m["01"]) + F.col("_wy") * ((1 - F.col("_wx")) * m["10"] + F.col("_wx") * m["11"])
    out = cell.join(corners, ["t", "z", "cy", "cx"], "left").select(*voxels.columns, blended.alias("_grey"))
    ends = out.groupBy("t", "z").agg(F.min("_grey").alias("_lo"), F.max("_grey").alias("_hi"))
    spread = F.try_divide(F.col("_grey") - F.col("_lo"), F.col("_hi") - F.col("_lo")) * TYPE_MAX
    return out.join(ends, ["t", "z"]).select(*voxels.columns, F.coalesce(as_uint16(spread), F.lit(0)).alias("equalised"))


# --- wavelets ----------------------------------------------------------------------------------------------------

BANDS = ("ll", "lh", "hl", "hh")


def haar_level(rows: DataFrame) -> DataFrame:
    """(t, z, y, x, ll, lh, hl, hh) of every two by two places; a place beyond an odd edge repeats the edge."""
    odd = lambda i, j: F.max(F.when((F.col("y") % 2 == i) & (F.col("x") % 2 == j), F.col("value").cast("double")))
    half = lambda a: F.expr(f"int({a} div 2)").alias(f"_{a}")
    four = rows.groupBy("t", "z", half("y"), half("x")).agg(odd(0, 0).alias("a"), odd(0, 1).alias("b"), odd(1, 0).alias("c"), odd(1, 1).alias("d"))
    a, b, c, d = F.col("a"), F.coalesce("b", "a"), F.coalesce("c", "a"), F.coalesce("d", "c", "b", "a")
    sums = {"ll": a + b + c + d, "lh": a - b + c - d, "hl": a + b - c - d, "hh": a - b - c + d}
    return four.select("t", "z", F.col("_y").alias("y"), F.col("_x").alias("x"), *((v / 2).alias(k) for k, v in sums.items()))


def haar_split(voxels: DataFrame, levels: int) -> DataFrame:
    """(level, band, t, z, y, x, value): details lh, hl, hh of levels 1 to `levels`, and ll of the last."""
    out, rows = None, voxels
    for level in range(1, levels + 1):
        four = haar_level(rows)
        bands = BANDS if level == levels else BANDS[1:]
        pairs = F.explode(F.array(*(F.struct(F.lit(b).alias("band"), F.col(b).alias("value")) for b in bands))).alias("_b")
        part = four.select(F.lit(level).alias("level"), "t", "z", "y", "x", pairs).select("level", "_b.band", "t", "z", "y", "x", "_b.value")
        out = part if out is None else out.unionByName(part)
        rows = four.select("t", "z", "y", "x", F.col("ll").alias("value"))
    return out


def haar_join(bands: DataFrame, levels: int, shape: tuple[int, int]) -> DataFrame:
    """(t, z, y, x, value) from what haar_split() gives; shape: y and x of a slice."""
    rows = bands.where(F.col("band") == "ll").select("t", "z", "y", "x", F.col("value").alias("ll"))
    for level in range(levels, 0, -1):
        ny, nx = (-(-n // (1 << (level - 1))) for n in shape)
        own = bands.where((F.col("level") == level) & (F.col("band") != "ll")).groupBy("t", "z", "y", "x").pivot("band", list(BANDS[1:])).agg(F.first("value"))
        four = rows.join(own, ["t", "z", "y", "x"])
        ll, lh, hl, hh = (F.col(b) for b in BANDS)
        places = [(0, 0, ll + lh + hl + hh), (0, 1, ll - lh + hl - hh), (1, 0, ll + lh - hl - hh), (1, 1, ll - lh - hl + hh)]
        each = F.explode(F.array(*(F.struct((2 * F.col("y") + i).alias("y"), (2 * F.col("x") + j).alias("x"), (v / 2).alias("v")) for i, j, v in places))).alias("_p")
        rows = four.select("t", "z", each).select("t", "z", "_p.y", "_p.x", F.col("_p.v").alias("ll")).where((F.col("y") < ny) & (F.col("x") < nx))
    return rows.withColumnRenamed("ll", "value")


def low_pass(voxels: DataFrame, levels: int) -> DataFrame:
    """Add _low: what the wavelets of `levels` levels leave of a voxel without any details, the mean of its block."""
    size = 1 << levels
    rows = voxels.select("t", "z", "y", "x", "value")
    for _ in range(levels):
        rows = haar_level(rows).select("t", "z", "y", "x", F.col("ll").alias("value"))
    rows = rows.select("t", "z", F.col("y").alias("_by"), F.col("x").alias("_bx"), (F.col("value") / size).alias("_low"))
    block = lambda a: F.expr(f"int({a} div {size})").alias(f"_b{a}")
    return voxels.select("*", block("y"), block("x")).join(rows, ["t", "z", "_by", "_bx"]).drop("_by", "_bx")


def wavelet_background(voxels: DataFrame, resolution: float, noise_levels: int = 0) -> DataFrame:
    """Add background and corrected: less the smoothed background of everything wider than `resolution` places, and less noise.

    With n the levels that the resolution takes, the background is what n - 1 levels leave, under a Gaussian of 2^n places. The noise is the
    positive part of the details of the finest `noise_levels` levels, held to two deviations above its mean in the slice. Below zero is zero.
    """
    n = max(math.ceil(math.log2(resolution)), 1)
    low = low_pass(voxels, n - 1)

    def smooth(pdf: pd.DataFrame) -> pd.DataFrame:
        plane = np.zeros((int(pdf["y"].max()) + 1, int(pdf["x"].max()) + 1))
        plane[pdf["y"], pdf["x"]] = pdf["_low"]
        return pdf[["t", "z", "y", "x"]].assign(background=smooth_plane(plane, float(1 << n))[pdf["y"], pdf["x"]])

    back = low.select("t", "z", "y", "x", "_low").groupBy("t", "z").applyInPandas(smooth, "t int, z int, y int, x int, background double")
    out = voxels.join(back, ["t", "z", "y", "x"]).withColumn("corrected", F.greatest(F.col("value") - F.col("background"), F.lit(0.0)))
    if not noise_levels:
        return out
    fine = low_pass(out, noise_levels).withColumn("_noise", F.greatest(F.col("value") - F.col("_low"), F.lit(0.0))).drop("_low")
    bound = fine.groupBy("t", "z").agg((F.avg("_noise") + 2 * F.stddev_pop("_noise")).alias("_most"))
    rows = fine.join(bound, ["t", "z"])
    return rows.withColumn("corrected", F.greatest(F.col("corrected") - F.least("_noise", "_most"), F.lit(0.0))).drop("_noise", "_most")
