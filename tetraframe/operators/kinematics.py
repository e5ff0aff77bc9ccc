"""Speeds, radial motion and selection metrics along tracks. One exchange and one sort by (track, frame) serve all windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tetraframe.functions.scalars import norm

AXES = ("x", "y", "z")


def by_track() -> WindowSpec:
    """All rows of a track."""
    return Window.partitionBy("track_id")


def along_track() -> WindowSpec:
    """A track in time order."""
    return by_track().orderBy("frame", "id")


def whole_track() -> WindowSpec:
    """A track in time order, all of it in view."""
    return along_track().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _step(scale: float = 1.0, lag: int = 1) -> tuple[Column, Column]:
    """Displacement over `lag` rows, and frames between."""
    moved = norm(*((F.col(f"position_{a}") - F.lag(f"position_{a}", lag).over(along_track())) * scale for a in AXES))
    return moved, F.col("frame") - F.lag("frame", lag).over(along_track())


def step_speed(df: DataFrame) -> DataFrame:
    """Add step_speed: distance from the row before over frames between; null on first rows, without a frame between, untracked."""
    moved, frames = _step()
    return df.withColumn("step_speed", F.when(F.col("track_id").isNotNull() & (frames > 0), moved / frames))


def radial_distance(df: DataFrame, center: tuple[float, float, float]) -> DataFrame:
    """Add radial_dist_to_center."""
    return df.withColumn("radial_dist_to_center", norm(*(F.col(f"position_{a}") - c for a, c in zip(AXES, center))))


def radial_velocity(df: DataFrame) -> DataFrame:
    """Add radial_velocity from radial_dist_to_center."""
    frames = F.col("frame") - F.lag("frame").over(along_track())
    change = F.col("radial_dist_to_center") - F.lag("radial_dist_to_center").over(along_track())
    return df.withColumn("radial_velocity", F.when(F.col("track_id").isNotNull() & (frames > 0), change / frames))


def smooth_radial_velocity(df: DataFrame, window: int = 5) -> DataFrame:
    """Add radial_velocity_smooth: centred mean over an odd window of at least 3 rows, nulls skipped."""
    h = (max(3, window | 1) - 1) // 2
    return df.withColumn("radial_velocity_smooth", F.when(F.col("track_id").isNotNull(), F.avg("radial_velocity").over(along_track().rowsBetween(-h, h))))


def track_velocity_stats(df: DataFrame) -> DataFrame:
    """Add median, mean, inward share and minimum of the smoothed radial velocity of each track."""
    v = F.col("radial_velocity_smooth")
    tracked = F.col("track_id").isNotNull()
    return df.withColumns({
        "track_median_radial_vel": F.when(tracked, F.median(v).over(by_track())), "track_mean_radial_vel": F.when(tracked, F.avg(v).over(by_track())),
        "track_inward_fraction": F.when(tracked, F.avg((v < 0).cast("double")).over(by_track())), "track_max_inward_vel": F.when(tracked, F.min(v).over(by_track())),
    })


def radial_motion(df: DataFrame, center: tuple[float, float, float], window: int = 5) -> DataFrame:
    """All radial columns."""
    return track_velocity_stats(smooth_radial_velocity(radial_velocity(radial_distance(df, center)), window))


def lag_speed(df: DataFrame, lag: int = 4, scale: float = 1.0, interval_s: float = 30.0) -> DataFrame:
    """Add lag_speed: displacement over `lag` rows a minute, where the rows are just `lag` frames apart."""
    moved, frames = _step(scale, lag)
    return df.withColumn("lag_speed", F.when(frames == lag, moved / (lag * interval_s / 60)))


def smooth_array(a: Column, k: int) -> Column:
    """Mean over the window of a centred convolution that returns the longer of both lengths; nulls are skipped.

    Element i averages a[j] for j in i+s-k+1 .. i+s, s = (min(n, k) - 1) // 2.
    """
    n = F.size(a)
    s = F.floor((F.least(n, F.lit(k)) - 1) / 2).cast("int")

    def one(i: Column) -> Column:
        lo, hi = F.greatest(i + s - k + 1, F.lit(0)), F.least(i + s, n - 1)
        part = F.filter(F.slice(a, lo + 1, F.greatest(hi - lo + 1, F.lit(0))), lambda v: v.isNotNull())
        return F.when(F.size(part) > 0, F.aggregate(part, F.lit(0.0), lambda t, v: t + v) / F.size(part))

    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(k)) - 1), one)).otherwise(F.array().cast("array<double>"))


def straightness(df: DataFrame) -> DataFrame:
    """(track_id, straightness): net over path length; null without a path."""
    moved, _ = _step()
    rows = df.where("track_id IS NOT NULL").withColumn("_m", moved)
    at = F.struct(*(f"position_{a}" for a in AXES))
    key = F.struct("frame", "id")
    ends = rows.groupBy("track_id").agg(F.min_by(at, key).alias("a"), F.max_by(at, key).alias("b"), F.sum("_m").alias("path"))
    net = norm(*(F.col(f"b.position_{a}") - F.col(f"a.position_{a}") for a in AXES))
    return ends.select("track_id", F.when(F.col("path") > 0, net / F.col("path")).alias("straightness"))


def smoothed_speeds(df: DataFrame, lag: int = 4, smooth: int = 5, scale: float = 1.0, interval_s: float = 30.0) -> DataFrame:
    """(track_id, n_points, minutes, _v): speeds over the lag of each track, in order, smoothed; null where no row of the window has one."""
    rows = lag_speed(df.where("track_id IS NOT NULL"), lag, scale, interval_s).withColumn("_i", F.row_number().over(along_track()))
    lists = rows.groupBy("track_id").agg(
        F.count(F.lit(1)).alias("n_points"), (F.count(F.lit(1)) * (interval_s / 60)).alias("minutes"),
        F.array_sort(F.collect_list(F.when(F.col("_i") > lag, F.struct("_i", "lag_speed")))).alias("_s"),
    )
    return lists.withColumn("_v", smooth_array(F.transform("_s", lambda x: x["lag_speed"]), smooth)).drop("_s")


def step_speeds(df: DataFrame, lag: int = 4, smooth: int = 5, scale: float = 1.0, interval_s: float = 30.0) -> DataFrame:
    """(track_id, speed): a row for every known smoothed speed of every track."""
    return smoothed_speeds(df, lag, smooth, scale, interval_s).select("track_id", F.explode("_v").alias("speed")).where("speed IS NOT NULL")


def selection_metrics(df: DataFrame, lag: int = 4, smooth: int = 5, scale: float = 1.0, interval_s: float = 30.0) -> DataFrame:
    """(track_id, n_points, minutes, straightness, mean_speed, n_speeds): speeds over the lag, smoothed along the track.

    minutes: rows times the interval. See also step_speeds for the speeds themselves.
    """
    lists = smoothed_speeds(df, lag, smooth, scale, interval_s)
    known = F.filter("_v", lambda v: v.isNotNull())
    mean = F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda t, v: t + v) / F.size(known))
    return lists.select("track_id", "n_points", "minutes", F.size("_v").alias("n_speeds"), mean.alias("mean_speed")).join(straightness(df), "track_id")


def last_point_extension(df: DataFrame) -> DataFrame:
    """df with a copy of each track's last row at the table's last frame, where the track ends before it."""
    end = df.agg(F.max("frame").alias("_end"))
    last = df.where("track_id IS NOT NULL").withColumn("_r", F.row_number().over(by_track().orderBy(F.desc("frame"), F.desc("id")))).where("_r = 1").drop("_r")
    more = last.crossJoin(F.broadcast(end)).where("frame < _end").withColumn("frame", F.col("_end")).drop("_end")
    return df.unionByName(more)


def first_point(df: DataFrame) -> DataFrame:
    """(track_id, frame, x, y, z) where each track starts."""
    at = F.min_by(F.struct("frame", *(f"position_{a}" for a in AXES)), F.struct("frame", "id"))
    return df.where("track_id IS NOT NULL").groupBy("track_id").agg(at.alias("p")).select("track_id", "p.*")
