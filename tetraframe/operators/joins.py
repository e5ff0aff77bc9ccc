"""Joins: track assignment by key and by distance, nearest neighbours, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tetraframe.functions.quantiles import exact_quantiles
from tetraframe.functions.scalars import norm
from tetraframe.operators import nearest
from tetraframe.operators.filters import shuffle_key

AXES = ("x", "y", "z")


def assign_by_id(spots: DataFrame, tracks: DataFrame, null_safe: bool = False) -> DataFrame:
    """Spots with the track of the same frame and id; the spots' own track goes. Duplicate keys in tracks multiply rows.

    null_safe: null ids match each other.
    """
    t = tracks.select(F.col("frame").alias("_f"), F.col("id").alias("_i"), "track_id")
    same = (lambda a, b: a.eqNullSafe(b)) if null_safe else (lambda a, b: a == b)
    s = spots.drop("track_id")
    on = same(F.col("frame"), F.col("_f")) & same(F.col("id"), F.col("_i"))
    keep = [c for c in ("frame", "id", "position_x", "position_y", "position_z") if c in s.columns]
    return s.join(t, on, "left").select(*keep, *(c for c in s.columns if c not in keep), "track_id")


def assign_stats(assigned: DataFrame) -> DataFrame:
    """Rows, rows with a track, tracks."""
    return assigned.agg(F.count(F.lit(1)).alias("n_spots"), F.count("track_id").alias("n_assigned"), F.count_distinct("track_id").alias("n_tracks"))


def assign_nearest(spots: DataFrame, tracks: DataFrame, tolerance: float) -> DataFrame:
    """Spots with track_id filled from the nearest track centroid of the frame.

    Each (track, frame) centroid takes its nearest spot within the tolerance (ties: smaller id); a spot taken by several goes to
    the lowest track, the others get none; spots that have a track keep it. Both meet by leaves of a k-d partition.
    """
    names = [f"position_{a}" for a in AXES]
    cent = tracks.where("track_id IS NOT NULL").groupBy("track_id", "frame").agg(*(F.avg(n).alias(n) for n in names))
    won = nearest.taken_within(cent, spots, names, tolerance).withColumnRenamed("track_id", "_won")
    return spots.join(won, ["frame", "id"], "left").withColumn("track_id", F.coalesce("track_id", "_won")).drop("_won")


def nearest_distance(points: DataFrame) -> DataFrame:
    """(id, distance): distance of each point to its nearest other one, by a k-d partition of the cloud."""
    return nearest.nearest_distance(points, [f"position_{a}" for a in AXES])


def nn_tolerance(points: DataFrame, most: int | None = 5_000, seed: int = 0) -> DataFrame:
    """(tolerance): one and a half times the median distance to the nearest neighbour, at least 1e-6.

    Distances are those within a sample of `most` points by shuffled id, which the tolerance is defined on; None: all points.
    """
    some = points if most is None else points.orderBy(shuffle_key(F.col("id"), seed), "id").limit(most)
    return exact_quantiles(nearest_distance(some), "distance", [0.5]).select(F.greatest(1.5 * F.col("q")[0], F.lit(1e-6)).alias("tolerance"))


def map_track_stats(spots: DataFrame, stats: DataFrame) -> DataFrame:
    """Values of each track on its rows; null for untracked rows."""
    return spots.join(stats, "track_id", "left")


def label_lut(voxels: DataFrame, values: DataFrame) -> DataFrame:
    """Voxels with the value of their label, 0 where there is none. values: (label, lut)."""
    return voxels.join(values, "label", "left").withColumn("lut", F.coalesce("lut", F.lit(0)))


def combine_metadata(files: DataFrame, metadata: DataFrame) -> DataFrame:
    """Every file with the one shared metadata row."""
    return files.crossJoin(F.broadcast(metadata.limit(1)))


def raw_vs_processed(processed: DataFrame, raw: DataFrame, other: DataFrame | None = None) -> DataFrame:
    """Processed rows with the raw metrics of the same time point and the ratios; 0 where the raw metric is not above 0.

    other: a second source of raw metrics for time points that the first has not.
    """
    own = raw.select("timepoint", F.col("preproc_snr").alias("raw_snr"), F.col("preproc_sharpness").alias("raw_sharpness"))
    if other is not None:
        more = other.select("timepoint", F.col("preproc_snr").alias("raw_snr"), F.col("preproc_sharpness").alias("raw_sharpness"))
        own = own.unionByName(more.join(own.select("timepoint"), "timepoint", "left_anti"))
    both = processed.join(own, "timepoint", "left")
    ratio = lambda a, b: F.when(F.col(b).isNotNull(), F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0))
    return both.withColumns({"snr_improvement": ratio("preproc_snr", "raw_snr"), "sharpness_improvement": ratio("preproc_sharpness", "raw_sharpness")})


def nearest_frame(spots: DataFrame, frame: int) -> DataFrame:
    """Rows of the frame nearest to the wanted one; ties go to the earlier."""
    near = spots.select("frame").distinct().orderBy(F.abs(F.col("frame") - frame), "frame").limit(1)
    return spots.join(F.broadcast(near), "frame", "left_semi")


def nearest_spot(spots: DataFrame, point: tuple[float, float, float], frame: int) -> DataFrame:
    """The spot nearest to a point in the nearest frame."""
    d = norm(*(F.col(f"position_{a}") - v for a, v in zip(AXES, point)))
    return nearest_frame(spots, frame).withColumn("distance", d).orderBy("distance", "id").limit(1)


def nearest_to_ray(spots: DataFrame, origin: tuple[float, float, float], direction: tuple[float, float, float], frame: int) -> DataFrame:
    """The spot nearest to a ray's line in the nearest frame."""
    size = sum(v * v for v in direction) ** 0.5
    x, y, z = (F.col(f"position_{a}") - v for a, v in zip(AXES, origin))
    dx, dy, dz = direction
    d = norm(y * dz - z * dy, z * dx - x * dz, x * dy - y * dx) / size
    return nearest_frame(spots, frame).withColumn("distance", d).orderBy(F.round("distance", 9), "id").limit(1)


def nearest_frame_centroid(spots: DataFrame, frame: int) -> DataFrame:
    """Mean position in the nearest frame."""
    return nearest_frame(spots, frame).groupBy("frame").agg(*(F.avg(f"position_{a}").alias(a) for a in AXES))


def window_lookup(rows: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    """A value of each key's first row on all of its rows."""
    return rows.withColumn(name, F.first(value).over(Window.partitionBy(key).orderBy("frame")))
