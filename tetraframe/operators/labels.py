"""Label volumes: sizes, shapes, slices, neighbours, components. Voxel tables are (t, z, y, x, value, label), background included."""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tetraframe.functions.scalars import clip
from tetraframe.operators.tables import dropped, kept_table
from tetraframe.operators.volumes import gaussian_kernel


def per_label(voxels: DataFrame) -> DataFrame:
    """A row a label and t: volume, extents on each axis, mean z and mean value."""
    extent = [(F.max(a) - F.min(a) + 1).alias(f"{a}ext") for a in "zyx"]
    return voxels.where("label > 0").groupBy("t", "label").agg(F.count(F.lit(1)).alias("volume"), *extent, F.avg("z").alias("cz"), F.avg("value").alias("mean_value"))


def cells_per_slice(voxels: DataFrame) -> DataFrame:
    """(t, z, cells): distinct labels of each slice, 0 for empty ones."""
    return voxels.groupBy("t", "z").agg(F.count_distinct(F.when(F.col("label") > 0, F.col("label"))).alias("cells"))


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def label_stats(voxels: DataFrame) -> DataFrame:
    """A row a t: number, volumes, shares of small and large ones, elongation, sphericity, coverage and density along z."""
    labels = per_label(voxels)
    mid = labels.groupBy("t").agg(F.median("volume").alias("_m"))
    rows = labels.join(mid, "t")
    v = F.col("volume")
    xy = (F.col("yext") + F.col("xext")) / 2
    share = lambda c: F.avg((F.when(F.col("_m") > 0, c).otherwise(F.lit(False))).cast("double"))
    size = rows.groupBy("t").agg(
        F.count(F.lit(1)).alias("n_cells"), F.avg(v).alias("mean_volume"), F.first("_m").alias("median_volume"), F.stddev_pop(v).alias("std_volume"), F.min(v).alias("min_volume"), F.max(v).alias("max_volume"),
        F.try_divide(F.stddev_pop(v), F.avg(v)).alias("volume_cv"), share(v < 0.25 * F.col("_m")).alias("small_fraction"), share(v > 4 * F.col("_m")).alias("large_fraction"),
        F.avg("zext").alias("mean_z_extent"), F.avg(xy).alias("mean_xy_extent"), F.avg(F.col("zext") / xy).alias("mean_elongation"), F.avg(v / (F.col("zext") * F.col("yext") * F.col("xext"))).alias("mean_sphericity"),
    )
    c = F.when(F.col("cells") > 0, F.col("cells"))
    slices = cells_per_slice(voxels).groupBy("t").agg(
        F.avg((F.col("cells") > 0).cast("double")).alias("z_coverage"),
        F.when(F.count(c) > 1, F.try_divide(F.stddev_pop(c), F.avg(c))).otherwise(0.0).alias("z_density_cv"), F.avg("cells").alias("cells_per_z_mean"), F.stddev_pop("cells").alias("cells_per_z_std"),
    )
    both = slices.join(size, "t", "left")
    counts = ("n_cells", "min_volume", "max_volume")
    return both.select("t", *(F.coalesce(c, F.lit(0)).alias(c) if c in counts else _zero(F.col(c)).alias(c) for c in both.columns if c != "t"))


def slabs(voxels: DataFrame, size: int, before: int, after: int, *columns: str) -> DataFrame:
    """(t, z, y, x, columns, _slab): each voxel in the slab of `size` slices that owns it and in those that see it as a halo."""
    lo, hi = F.floor((F.col("z") - after) / size), F.floor((F.col("z") + before) / size)
    return voxels.select("t", "z", "y", "x", *columns, F.explode(F.sequence(lo.cast("int"), hi.cast("int"))).alias("_slab")).where("_slab >= 0")


def _block(pdf: pd.DataFrame, column: str = "label") -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """A slab's column as an array from its first slice on, and where each row stands in it."""
    at = tuple(pdf[a].to_numpy() for a in "zyx")
    at = (at[0] - at[0].min(), *at[1:])
    out = np.zeros(tuple(int(i.max()) + 1 for i in at), pdf[column].dtype)
    out[at] = pdf[column]
    return out, at


def _shifted(a: np.ndarray, step: tuple[int, int, int], outside: int) -> np.ndarray:
    """The neighbour of every element at a step."""
    out = np.full_like(a, outside)
    to = tuple(slice(max(-d, 0), n - max(d, 0)) for d, n in zip(step, a.shape))
    of = tuple(slice(max(d, 0), n - max(-d, 0)) for d, n in zip(step, a.shape))
    out[to] = a[of]
    return out


FACES = ((1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1))


def neighbours(voxels: DataFrame, size: int = 4) -> DataFrame:
    """(t, label, other): pairs of different labels that share a face, each both ways. Slabs see one slice more."""

    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        a, _ = _block(pdf)
        found = []
        for step in ((1, 0, 0), (0, 1, 0), (0, 0, 1)):
            b = _shifted(a, step, 0)
            both = (a > 0) & (b > 0) & (a != b)
            found.append(np.stack([a[both], b[both]], 1))
        p = np.unique(np.concatenate(found), axis=0)
        return pd.DataFrame({"t": int(pdf["t"].iat[0]), "label": p[:, 0], "other": p[:, 1]})

    found = slabs(voxels, size, 0, 1, "label").groupBy("t", "_slab").applyInPandas(pairs, "t int, label int, other int")
    return found.union(found.select("t", "other", "label")).distinct()


def touching_fraction(voxels: DataFrame) -> DataFrame:
    """(t, touching): share of all labels that share a face with another."""
    n = per_label(voxels).groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    k = neighbours(voxels).groupBy("t").agg(F.count_distinct("label").alias("k"))
    return n.join(k, "t", "left").select("t", F.coalesce(F.col("k") / F.col("n"), F.lit(0.0)).alias("touching"))


def segmentation_metrics(voxels: DataFrame) -> DataFrame:
    """A row a t with the seg_ metrics; an empty mask gives zeros."""
    m = label_stats(voxels).join(touching_fraction(voxels), "t", "left").withColumn("touching", _zero(F.col("touching")))
    names = ("n_cells", "mean_volume", "median_volume", "std_volume", "volume_cv", "small_fraction", "large_fraction", "mean_z_extent", "mean_xy_extent", "mean_elongation", "mean_sphericity", "z_coverage", "z_density_cv", "touching")
    return m.select("t", *(F.col(n).alias(f"seg_{n}") for n in names))


def per_slice_labels(voxels: DataFrame) -> DataFrame:
    """A row a slice: labels in it, labels centred on it, areas and the labelled share; zeros for empty slices."""
    areas = voxels.groupBy("t", "z", "label").agg(F.count(F.lit(1)).alias("area"))
    center = voxels.where("label > 0").groupBy("t", "label").agg(F.avg("z").alias("cz"))
    a = areas.join(center, ["t", "label"], "left")
    own = F.when(F.col("label") > 0, F.col("area"))
    out = a.groupBy("t", "z").agg(
        F.count(own).alias("n_labels"), F.count_if((F.col("label") > 0) & (F.abs(F.col("cz") - F.col("z")) < 0.5)).alias("n_centroids"), F.coalesce(F.sum(own), F.lit(0)).alias("total_area"),
        _zero(F.avg(own)).alias("mean_area"), _zero(F.median(own)).alias("median_area"), _zero(F.stddev_pop(own)).alias("std_area"), F.coalesce(F.min(own), F.lit(0)).alias("min_area"), F.coalesce(F.max(own), F.lit(0)).alias("max_area"),
        (F.coalesce(F.sum(own), F.lit(0)) / F.sum("area")).alias("fraction"),
    )
    return out


def depth_thirds(slices: DataFrame, nz: int, keys: tuple[str, ...] = ("t",), column: str = "n_centroids") -> DataFrame:
    """Centroids in the first quarter of the slices, the middle half and the last quarter, their sum, and deep over shallow (0 without shallow).

    slices: a row a slice, as per_slice_labels gives them; nz: slices of a volume.
    """
    q1, q3 = nz // 4, 3 * nz // 4
    part = lambda c: F.coalesce(F.sum(F.when(c, F.col(column))), F.lit(0)).cast("long")
    z = F.col("z")
    out = slices.groupBy(*keys).agg(part(z < q1).alias("shallow"), part((z >= q1) & (z < q3)).alias("mid"), part(z >= q3).alias("deep"), part(F.lit(True)).alias("total"))
    return out.withColumn("deep_over_shallow", F.coalesce(F.try_divide("deep", "shallow"), F.lit(0.0)))


def intensity_in_labels(voxels: DataFrame, plain: bool = False) -> DataFrame:
    """A row a t: statistics of the labels' mean values, and mean inside over deviation outside (0 with 100 outside voxels or fewer, or where they are flat).

    plain: that ratio as it comes, infinite over a flat background.
    """
    means = per_label(voxels).groupBy("t").agg(F.avg("mean_value").alias("mean"), F.stddev_pop("mean_value").alias("std"), F.min("mean_value").alias("min"), F.max("mean_value").alias("max"))
    inside, outside = F.when(F.col("label") > 0, F.col("value")), F.when(F.col("label") == 0, F.col("value"))
    mean, std = F.avg(inside), F.stddev_pop(outside)
    # A deviation put together from parts may miss 0 by rounding where all values are equal.
    flat = (F.min(outside) == F.max(outside)) | (std == 0)
    ratio = F.when(flat, mean * float("inf")).otherwise(mean / std) if plain else F.when((F.count(outside) > 100) & (std > 1e-8), mean / std).otherwise(0.0)
    snr = voxels.groupBy("t").agg(ratio.alias("snr"))
    return snr.join(means, "t", "left").select("t", "mean", "std", "min", "max", (F.col("snr") if plain else _zero(F.col("snr"))).alias("snr"))


def relabelled(voxels: DataFrame, cap: int = 65535) -> DataFrame:
    """Voxels with labels renumbered from 1 without gaps within each t, ascending, at most cap."""
    ids = voxels.where("label > 0").select("t", "label").distinct()
    new = ids.withColumn("dense", F.least(F.dense_rank().over(Window.partitionBy("t").orderBy("label")), F.lit(cap)))
    return voxels.join(new, ["t", "label"], "left").withColumn("dense", F.coalesce("dense", F.lit(0)))


def boundaries(labels: np.ndarray, width: int = 1) -> np.ndarray:
    """Outer boundaries of a label array: background that shares a face with a label, and labelled elements that share a face with
    anything else and touch another label, by a corner at least. Dilated by faces to a width."""
    top = np.iinfo(labels.dtype).max
    low, high = labels.copy(), labels.copy()
    for step in FACES:
        high = np.maximum(high, _shifted(labels, step, 0))
        low = np.minimum(low, _shifted(labels, step, top))
    filled = np.where(labels == 0, top, labels)
    near, far = filled.copy(), labels.copy()
    for step in np.ndindex(3, 3, 3):
        step = tuple(d - 1 for d in step)
        near = np.minimum(near, _shifted(filled, step, top))
        far = np.maximum(far, _shifted(labels, step, 0))
    out = (low != high) & ((labels == 0) | (near != far))
    for _ in range(width - 1):
        out = out | np.logical_or.reduce([_shifted(out.view(np.int8), step, 0).astype(bool) for step in FACES])
    return out


#: Slices, rows and columns of a tile.
TILE = (16, 128, 128)


def tiles(voxels: DataFrame, size: tuple[int, int, int], halo: int, *columns: str) -> DataFrame:
    """(t, z, y, x, columns, _z, _y, _x): each voxel in the tile that owns it and in those that see it as a halo, numbered along each axis."""
    rows = voxels.select("t", "z", "y", "x", *columns)
    for axis, n in zip("zyx", size):
        lo, hi = F.floor((F.col(axis) - halo) / n), F.floor((F.col(axis) + halo) / n)
        rows = rows.withColumn(f"_{axis}", F.explode(F.sequence(F.greatest(lo, F.lit(0)).cast("int"), hi.cast("int"))))
    return rows


def _tile(pdf: pd.DataFrame, size: tuple[int, int, int], column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A tile's column with its halo as an array, where the array begins, the places of the rows in it, and which rows the tile owns."""
    places = pdf[["z", "y", "x"]].to_numpy()
    first = places.min(0)
    out = np.zeros(places.max(0) - first + 1, pdf[column].dtype)
    at = places - first
    out[tuple(at.T)] = pdf[column]
    return out, first, at, (places // np.array(size) == pdf[["_z", "_y", "_x"]].to_numpy()).all(1)


def outer_boundary(voxels: DataFrame, width: int = 1, size: tuple[int, int, int] = TILE) -> DataFrame:
    """Voxels with boundary, dilated to a width. Tiles see `width` places on every side, so a task holds a tile."""

    def mark(pdf: pd.DataFrame) -> pd.DataFrame:
        a, _, at, own = _tile(pdf, size, "label")
        return pdf.loc[own, ["t", "z", "y", "x"]].assign(boundary=boundaries(a, width)[tuple(at[own].T)])

    found = tiles(voxels, size, width, "label").groupBy("t", "_z", "_y", "_x").applyInPandas(mark, "t int, z int, y int, x int, boundary boolean")
    return voxels.join(found, ["t", "z", "y", "x"])


def foreground_gate(voxels: DataFrame, width: int = 1) -> DataFrame:
    """Voxels with foreground: labelled and not on a boundary of a width."""
    return outer_boundary(voxels, width).withColumn("foreground", (F.col("label") > 0) & ~F.col("boundary"))


def label_contours(voxels: DataFrame, shape: tuple[int, int, int], sigma: float = 2.0, size: tuple[int, int, int] = TILE) -> DataFrame:
    """(t, z, y, x, foreground, contour): labelled or not as 1 or 0, and the boundaries smoothed by a Gaussian on all axes, ends mirrored.

    shape: z, y, x of a volume. Tiles see as far as the kernel reaches and a place more, whose own neighbours a halo's boundaries need.
    """
    kernel = gaussian_kernel(sigma)
    r = len(kernel) // 2

    def smooth(pdf: pd.DataFrame) -> pd.DataFrame:
        a, first, at, own = _tile(pdf, size, "label")
        if not own.any():  # beyond the volume: seen as a halo only
            return pdf.loc[[], ["t", "z", "y", "x"]].assign(foreground=0.0, contour=0.0)
        edge, begin = boundaries(a).astype(float), (at[own] + first).min(0)
        for axis, n in enumerate(shape):
            end = min(int(begin[axis]) + size[axis], n)
            near = (np.arange(int(begin[axis]), end)[:, None] + np.arange(-r, r + 1)) % (2 * n)
            near = np.where(near < n, near, 2 * n - 1 - near) - first[axis]
            edge = np.moveaxis(edge, axis, 0)
            edge = np.moveaxis(np.stack([np.tensordot(kernel, edge[k], axes=(0, 0)) for k in near]), 0, axis)
        rows = pdf.loc[own, ["t", "z", "y", "x"]]
        return rows.assign(foreground=(pdf["label"][own] > 0).astype(float), contour=edge[tuple((at[own] + first - begin).T)])

    found = tiles(voxels, size, r + 1, "label").groupBy("t", "_z", "_y", "_x")
    return found.applyInPandas(smooth, "t int, z int, y int, x int, foreground double, contour double")


def nearest_labels(voxels: DataFrame, factor: float, ny: int, nx: int) -> DataFrame:
    """Labels on a grid of factor times the size in y and x, each from the nearest source voxel."""
    my, mx = max(1, round(ny * factor)), max(1, round(nx * factor))
    spine = voxels.select("t", "z").distinct().withColumn("y2", F.explode(F.sequence(F.lit(0), F.lit(my - 1)))).withColumn("x2", F.explode(F.sequence(F.lit(0), F.lit(mx - 1))))
    at = lambda c, n, m: clip(F.floor((F.col(c) + 0.5) * (n / m)), 0, n - 1).cast("int")
    rows = spine.withColumns({"y": at("y2", ny, my), "x": at("x2", nx, mx)}).join(voxels.select("t", "z", "y", "x", "label"), ["t", "z", "y", "x"])
    return rows.select("t", "z", F.col("y2").alias("y"), F.col("x2").alias("x"), "label")


def thinnest_axis_first(nz: int, ny: int, nx: int) -> tuple[int, int, int]:
    """The order of axes that moves a strictly smallest axis to the front."""
    n = (nz, ny, nx)
    k = int(np.argmin(n))
    if k == 0 or sorted(n)[0] == sorted(n)[1]:
        return 0, 1, 2
    return (k, *(i for i in range(3) if i != k))


def axis_fixed(voxels: DataFrame) -> DataFrame:
    """Voxels with z as the strictly smallest axis."""
    e = voxels.agg(*(F.coalesce(F.max(a), F.lit(0)).alias(a) for a in "zyx")).first()  # an empty table keeps its axes
    order = thinnest_axis_first(*(int(e[a]) + 1 for a in "zyx"))
    return voxels.select("t", *(F.col("zyx"[k]).alias(a) for a, k in zip("zyx", order)), *(c for c in voxels.columns if c not in "tzyx"))


def components6(mask: np.ndarray) -> np.ndarray:
    """Numbers of the 6-connected components of a mask, 0 outside: least neighbour labels with jumping, whole arrays at a time."""
    n = mask.size
    at = np.arange(n).reshape(mask.shape)
    pairs = []
    for axis in range(mask.ndim):
        a, b = (tuple(slice(lo, hi) if i == axis else slice(None) for i in range(mask.ndim)) for lo, hi in ((0, -1), (1, None)))
        both = mask[a] & mask[b]
        pairs.append(np.stack([at[a][both], at[b][both]]))
    u, v = np.concatenate(pairs, axis=1)
    root = np.arange(n)
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    while (root[root] != root).any():
        root = root[root]
    out = np.zeros(n, np.int64)
    flat = mask.ravel()
    _, out[flat] = np.unique(root[flat], return_inverse=True)
    out[flat] += 1
    return out.reshape(mask.shape)


def joined_ids(edges: DataFrame) -> DataFrame:
    """(id, root): the smallest id reachable by edges (a, b), edges of a node to itself included. Stored after every round."""
    both, both_at = kept_table(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    roots, roots_at = kept_table(both.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("id"), F.least("a", "root").alias("root")), "roots")
    while True:
        near = both.join(roots.select(F.col("id").alias("b"), F.col("root").alias("_r")), "b").groupBy("a").agg(F.min("_r").alias("_r")).select(F.col("a").alias("id"), "_r")
        low = roots.join(near, "id").select("id", F.col("root").alias("_old"), F.least("root", "_r").alias("_new"))
        up = roots.select(F.col("id").alias("_new"), F.col("root").alias("_up"))
        new, new_at = kept_table(low.join(up, "_new").select("id", F.least("_new", "_up").alias("root"), (F.least("_new", "_up") != F.col("_old")).alias("_moved")), "roots")
        dropped(edges.sparkSession, roots_at)
        roots, roots_at = new.select("id", "root"), new_at
        if not new.where("_moved").take(1):
            dropped(edges.sparkSession, both_at)
            return roots


def without_small_components(voxels: DataFrame, least: int, size: int = 8) -> DataFrame:
    """Voxels with component (6-connected, of label > 0, numbered within a t) and keep: whether it has `least` voxels.

    Slabs of `size` slices find their own components and share one slice with the next slab, whose voxels tie the components of both
    together; a task holds a slab.
    """

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        a, at = _block(pdf)
        own = components6(a > 0)[at]
        return pdf[["t", "z", "y", "x", "_slab"]].assign(c=own)

    rows = slabs(voxels, size, 0, 1, "label").groupBy("t", "_slab").applyInPandas(find, "t int, z int, y int, x int, _slab int, c long").where("c > 0")
    rows, _ = kept_table(rows.withColumn("id", F.col("t").cast("long") * (1 << 48) + F.col("_slab").cast("long") * (1 << 32) + F.col("c")), "parts")
    own = rows.where(F.floor(F.col("z") / size) == F.col("_slab"))
    seen = rows.where(F.floor(F.col("z") / size) != F.col("_slab")).select("t", "z", "y", "x", F.col("id").alias("b"))
    edges = own.join(seen, ["t", "z", "y", "x"]).select(F.col("id").alias("a"), "b").unionByName(own.select(F.col("id").alias("a"), F.col("id").alias("b")))
    roots = joined_ids(edges.distinct())
    parts = own.join(roots, "id").select("t", "z", "y", "x", "root")
    sizes = parts.groupBy("t", "root").agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.withColumn("component", F.row_number().over(Window.partitionBy("t").orderBy("root")).cast("long"))  # a row a component
    found = parts.join(sizes, ["t", "root"]).select("t", "z", "y", "x", "component", (F.col("_n") >= least).alias("keep"))
    out = voxels.select("t", "z", "y", "x").join(found, ["t", "z", "y", "x"], "left")
    return out.select("t", "z", "y", "x", F.coalesce("component", F.lit(0)).cast("long").alias("component"), F.coalesce("keep", F.lit(False)).alias("keep"))
