"""Inward movement: runs, onset, criteria, score and automatic threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tetraframe.functions.quantiles import exact_quantiles
from tetraframe.functions.scalars import clip
from tetraframe.operators.kinematics import along_track, by_track, whole_track
from tetraframe.operators.tables import kept_table


def net_radial_displacement(df: DataFrame) -> DataFrame:
    """Add track_net_radial_disp: last less first known distance of the track."""
    r = "radial_dist_to_center"
    return df.withColumn("track_net_radial_disp", F.when(F.col("track_id").isNotNull(), F.last(r, True).over(whole_track()) - F.first(r, True).over(whole_track())))


def inward_runs(df: DataFrame, velocity: str = "radial_velocity_smooth") -> DataFrame:
    """Add track_sustained_inward, the longest run of inward rows, and ingression_onset_frame.

    A row that is not inward resets the onset unless the run before it had three rows; the onset is the first inward frame
    after the last reset.
    """
    inward = F.coalesce(F.col(velocity) < 0, F.lit(False))
    rows = df.withColumn("_in", inward).withColumn("_island", F.sum((~F.col("_in")).cast("int")).over(along_track().rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy("track_id", "_island").orderBy("frame", "id")
    rows = rows.withColumn("_run", F.when(F.col("_in"), F.sum(F.col("_in").cast("int")).over(run.rowsBetween(Window.unboundedPreceding, 0))).otherwise(0))
    rows = rows.withColumn("_reset", (~F.col("_in") & (F.coalesce(F.lag("_run").over(along_track()), F.lit(0)) < 3)).cast("int"))
    rows = rows.withColumn("_epoch", F.sum("_reset").over(along_track().rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("_last", F.max("_epoch").over(by_track()))
    tracked = F.col("track_id").isNotNull()
    onset = F.min(F.when(F.col("_in") & (F.col("_epoch") == F.col("_last")), F.col("frame"))).over(by_track())
    out = rows.withColumns({"track_sustained_inward": F.when(tracked, F.max("_run").over(by_track())).cast("long"), "ingression_onset_frame": F.when(tracked, onset)})
    return out.drop("_in", "_island", "_run", "_reset", "_epoch", "_last")


def flag_ingressing(df: DataFrame, threshold: float = -0.5, min_frames: int = 5, min_inward: float = 0.5) -> DataFrame:
    """Add ingressing and ingression_score; needs the radial columns. Untracked rows are not flagged and score 0.

    The score of a flagged track: 0.30 how far the velocity lies beyond the threshold (in thresholds, 2 at most, halved), 0.20 its
    inward share, 0.25 its longest inward run over its length, 0.25 its inward displacement over its length.
    """
    rows = inward_runs(net_radial_displacement(df)).withColumn("_n", F.count("frame").over(by_track()))
    v = F.coalesce("track_median_radial_vel", "track_mean_radial_vel")
    need = F.greatest(F.lit(3), F.floor(F.col("_n") * 0.15))
    ok = (F.col("_n") >= min_frames) & v.isNotNull() & (v <= threshold) & (F.col("track_inward_fraction") >= min_inward)
    ok &= (F.col("track_net_radial_disp").isNull() | (F.col("track_net_radial_disp") < -0.5)) & (F.col("track_sustained_inward") >= need)
    flag = F.coalesce(F.col("track_id").isNotNull() & ok, F.lit(False))
    length = F.greatest(F.col("_n"), F.lit(1))
    score = (
        0.30 * F.coalesce(clip((threshold - v) / max(abs(threshold), 0.01), 0.0, 2.0) / 2, F.lit(0.0)) + 0.20 * clip(F.col("track_inward_fraction"), 0.0, 1.0)
        + 0.25 * clip(F.col("track_sustained_inward") / length, 0.0, 1.0) + 0.25 * clip(F.coalesce(-F.col("track_net_radial_disp"), F.lit(0.0)) / length, 0.0, 1.0)
    )
    return rows.withColumn("ingressing", flag).withColumn("ingression_score", F.when(F.col("ingressing"), F.coalesce(score, F.lit(0.0))).otherwise(0.0)).drop("_n")


def roi_restrict(df: DataFrame, y_max: float | None = None) -> DataFrame:
    """Unflag tracks that are never in the region (in_roi), and those that ever exceed y_max."""
    keep = F.bool_or("in_roi").over(by_track())
    if y_max is not None:
        keep &= F.max("position_y").over(by_track()) <= y_max
    return df.withColumn("ingressing", F.col("ingressing") & F.coalesce(keep, F.lit(False)))


def otsu_threshold(df: DataFrame, bins: int = 200, fewest: int = 20, highest: float = -0.005, fallback: float = -0.5) -> DataFrame:
    """(threshold): Otsu's split of the tracks' median velocities, at most `highest`; with few tracks their median as it is, or the fallback.

    df: one row a track with v. Only the histogram of `bins` rows meets in one task.
    """
    df, _ = kept_table(df.select("v").where("v IS NOT NULL"), "velocities")  # what df stands for is computed once, not by each use
    ends = df.agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).crossJoin(exact_quantiles(df, "v", [0.5]).select(F.col("q")[0].alias("mid")))  # one row each
    width = (F.col("hi") - F.col("lo")) / bins
    rows = df.crossJoin(F.broadcast(ends))
    b = F.when(width > 0, F.least(F.floor((F.col("v") - F.col("lo")) / width), F.lit(bins - 1))).otherwise(0).cast("int")
    hist = rows.withColumn("bin", b).groupBy("bin").agg(F.count("v").alias("c"), F.first("lo").alias("lo"), F.first("hi").alias("hi"))
    center = F.col("lo") + (F.col("bin") + 0.5) * (F.col("hi") - F.col("lo")) / bins
    up = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    hist = hist.withColumn("m", F.col("c") * center).withColumns({"w0": F.sum("c").over(up), "s0": F.sum("m").over(up), "n": F.sum("c").over(Window.partitionBy()), "s": F.sum("m").over(Window.partitionBy())})
    w1 = F.col("n") - F.col("w0")
    between = F.col("w0") * w1 * F.pow(F.col("s0") / F.col("w0") - (F.col("s") - F.col("s0")) / w1, 2)
    best = hist.where(F.col("n") > F.col("w0")).agg(F.max_by(center, F.struct(F.round(between, 6), -F.col("bin"))).alias("split"))
    few = F.coalesce("mid", F.lit(fallback))
    # One value only: the first of the 200 centres about it, as for a histogram of width 1.
    split = F.coalesce("split", F.col("lo") - 0.5 + 0.5 / bins)
    return ends.crossJoin(best).select(F.when(F.col("n") < fewest, few).otherwise(F.least(split, F.lit(highest))).alias("threshold"))
