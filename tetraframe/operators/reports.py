"""Summaries, counts, stage deltas, alerts and the tables behind plots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tetraframe.functions.quantiles import exact_quantiles
from tetraframe.functions.scalars import clean, lut_diverging, lut_flag, lut_value
from tetraframe.operators.filters import track_limits
from tetraframe.operators.kinematics import step_speed

AXES = ("x", "y", "z")

#: Columns that hold one value a track.
TRACK_COLUMNS = (
    "track_median_radial_vel", "track_mean_radial_vel", "track_inward_fraction", "track_max_inward_vel", "track_net_radial_disp",
    "track_sustained_inward", "ingression_onset_frame", "ingressing", "ingression_score",
)


def _basics() -> list[Column]:
    return [F.count(F.lit(1)).alias("n_spots"), F.min("frame").alias("frame_start"), F.max("frame").alias("frame_end"), *(F.avg(f"position_{a}").alias(f"mean_{a}") for a in AXES)]


def track_summary(df: DataFrame) -> DataFrame:
    """A row a track: spots, frames, mean position, and of the other columns what the table has."""
    has = set(df.columns)
    more = [F.first(c, True).alias(c) for c in TRACK_COLUMNS if c in has]
    more += [F.avg(c).alias(f"mean_{c}") for c in ("spherical_depth", "theta_deg", "phi_deg") if c in has]
    more += [F.bool_or(c).alias(c) for c in ("in_roi", "filtered_out") if c in has]
    more += [F.first(c, True).alias(c) for c in ("filter_reason",) if c in has]
    return df.where("track_id IS NOT NULL").groupBy("track_id").agg(*_basics(), *more)


def section_summary(df: DataFrame) -> DataFrame:
    """A row a track with its fastest step."""
    return step_speed(df).where("track_id IS NOT NULL").groupBy("track_id").agg(*_basics(), F.max("step_speed").alias("max_speed"))


def summary_join(df: DataFrame) -> DataFrame:
    """A row a track with in_roi of its first row, in one aggregation."""
    return df.where("track_id IS NOT NULL").groupBy("track_id").agg(*_basics(), F.min_by("in_roi", F.struct("frame", "id")).alias("first_in_roi"))


def dataset_track_stats(df: DataFrame) -> DataFrame:
    """Number of tracks and quantiles of length and greatest speed; a track without a step has speed 0."""
    rows = track_limits(df).withColumn("max_speed", F.coalesce("max_speed", F.lit(0.0)))
    q = rows.agg(
        F.count(F.lit(1)).alias("n_tracks"), F.min("length").alias("len_min"), F.percentile("length", F.lit([0.5, 0.95])).alias("l"), F.max("length").alias("len_max"),
        F.max("max_speed").alias("speed_max"),
    ).crossJoin(exact_quantiles(rows, "max_speed", [0.5, 0.95, 0.99]).select(F.col("q").alias("s")))  # one row each
    return q.select(
        "n_tracks", "len_min", F.col("l")[0].cast("long").alias("len_p50"), F.col("l")[1].cast("long").alias("len_p95"), "len_max",
        F.col("s")[0].alias("speed_p50"), F.col("s")[1].alias("speed_p95"), F.col("s")[2].alias("speed_p99"), "speed_max",
    )


def filter_counts(kept: DataFrame) -> DataFrame:
    """Tracks kept, dropped and the share kept."""
    n = F.count_if("kept")
    return kept.agg(n.alias("kept"), F.count_if(~F.col("kept")).alias("dropped"), F.try_divide(100.0 * n, F.count(F.lit(1))).alias("kept_pct"))


def export_meta(df: DataFrame) -> DataFrame:
    """Counts of an export; df has filtered_out."""
    out = F.col("filtered_out")
    return df.agg(
        F.count(F.lit(1)).alias("n_spots"), F.count_distinct("frame").alias("n_frames"), F.count_if(~out).alias("kept_spots"), F.count_if(out).alias("filtered_spots"),
        F.count_distinct(F.when(~out, F.col("track_id"))).alias("kept_tracks"), F.count_distinct(F.when(out, F.col("track_id"))).alias("filtered_tracks"),
    )


def ingression_counts(df: DataFrame) -> DataFrame:
    """Flagged spots and tracks, and the share of tracks."""
    n = F.count_distinct(F.when(F.col("ingressing"), F.col("track_id")))
    return df.agg(F.count_if("ingressing").alias("flagged_spots"), n.alias("flagged_tracks"), F.try_divide(100.0 * n, F.count_distinct("track_id")).alias("flagged_pct"))


def travel(df: DataFrame, column: str) -> DataFrame:
    """Range of a column along each track."""
    return df.where("track_id IS NOT NULL").groupBy("track_id").agg((F.max(column) - F.min(column)).alias("travel"))


def quantiles(df: DataFrame, column: str) -> DataFrame:
    """Median, 10th and 90th percentile."""
    q = exact_quantiles(df, column, [0.5, 0.1, 0.9])
    return q.select(F.col("q")[0].alias("median"), F.col("q")[1].alias("p10"), F.col("q")[2].alias("p90"))


def axis_ranges(df: DataFrame) -> DataFrame:
    """Least and greatest position and frame."""
    return df.agg(*(f(f"position_{a}").alias(f"{a}_{n}") for a in AXES for f, n in ((F.min, "min"), (F.max, "max"))), F.min("frame").alias("frame_min"), F.max("frame").alias("frame_max"))


def stage_delta(stages: DataFrame) -> DataFrame:
    """Change of the count from the stage before, in percent, and from the first. A table of stages is small."""
    w = Window.orderBy("stage_name")
    n, before = F.col("total_nuclei"), F.lag("total_nuclei").over(w)
    first = F.first("total_nuclei").over(w)
    return stages.select("stage_name", "total_nuclei", (n - before).alias("delta"), F.try_divide(100.0 * (n - before), before).alias("delta_pct"), (n - first).alias("cumulative"))


def stage_alerts(stages: DataFrame) -> DataFrame:
    """(stage_name, alert): the rules that a stage breaks against the one before; none where that counted nothing."""
    w = Window.orderBy("stage_name")
    prev = {c: F.lag(c).over(w) for c in ("total_nuclei", "median_volume", "small_fraction", "large_fraction", "z_coverage")}
    rows = stages.withColumns({f"_{c}": v for c, v in prev.items()})
    now, old = F.col, lambda c: F.col(f"_{c}")
    change = F.try_divide(now("total_nuclei") - old("total_nuclei"), old("total_nuclei")) * 100
    volume = F.try_divide(now("median_volume") - old("median_volume"), old("median_volume")) * 100
    rules = [
        F.when(change < -5, "LOSS"), F.when(change > 15, "GAIN"), F.when(volume > 20, "GROWING").when(volume < -20, "SHRINKING"),
        F.when(now("small_fraction") - old("small_fraction") > 0.1, "SMALL"), F.when(now("large_fraction") - old("large_fraction") > 0.05, "LARGE"),
        F.when(F.try_divide(now("z_coverage") - old("z_coverage"), old("z_coverage")) * 100 < -5, "Z_COVERAGE"),
    ]
    return rows.where("_total_nuclei > 0").select("stage_name", F.explode(F.array_compact(F.array(*rules))).alias("alert"))


def benchmark_summary(metrics: DataFrame, columns: list[str]) -> DataFrame:
    """Mean of each metric by experiment."""
    return metrics.groupBy("experiment").agg(*(F.avg(c).alias(c) for c in columns))


def benchmark_pivot(metrics: DataFrame, columns: list[str], experiments: list[str]) -> DataFrame:
    """A row a metric, a column an experiment."""
    pairs = ", ".join(f"'{c}', {c}" for c in columns)
    long = metrics.selectExpr("experiment", f"stack({len(columns)}, {pairs}) AS (metric, value)")
    return long.groupBy("metric").pivot("experiment", experiments).agg(F.avg("value"))


def elongation_by_timepoint(metrics: DataFrame, experiments: list[str]) -> DataFrame:
    """A row a time point, a column an experiment."""
    return metrics.groupBy("timepoint").pivot("experiment", experiments).agg(F.avg("seg_mean_elongation"))


def histogram(df: DataFrame, column: str, most: int, fewest: int, low: float | None = None, high: float | None = None) -> DataFrame:
    """(bin, left, right, n): as many bins as the root of the number of rows, held between two bounds; the last bin is closed."""
    ends = df.where(F.col(column).isNotNull()).agg(F.count(column).alias("_n"), F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    if low is not None:
        ends = ends.withColumns({"_lo": F.lit(low), "_hi": F.lit(high)})
    ends = ends.withColumn("_bins", F.least(F.lit(most), F.greatest(F.lit(fewest), F.floor(F.sqrt("_n")).cast("int"))).cast("int"))
    width = (F.col("_hi") - F.col("_lo")) / F.col("_bins")
    rows = df.where(F.col(column).isNotNull()).crossJoin(F.broadcast(ends))
    own = F.when(width > 0, F.least(F.floor((F.col(column) - F.col("_lo")) / width), F.col("_bins") - 1)).otherwise(0).cast("int")
    counts = rows.where(F.col(column).between(F.col("_lo"), F.col("_hi"))).groupBy(own.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spine = ends.withColumn("bin", F.explode(F.sequence(F.lit(0), F.col("_bins") - 1)))
    return spine.join(counts, "bin", "left").select("bin", (F.col("_lo") + F.col("bin") * width).alias("left"), (F.col("_lo") + (F.col("bin") + 1) * width).alias("right"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def interpretation(metrics: DataFrame) -> DataFrame:
    """Verdicts on a benchmark row: elongation, and bright borders where the table has an edge ratio."""
    e = F.col("seg_mean_elongation")
    out = metrics.withColumn("elongation_verdict", F.when(e < 0.7, "flattened").when(e > 1.5, "stretched").otherwise("ok"))
    return out.withColumn("edge_verdict", F.when(F.col("preproc_edge_ratio") > 1.5, "bright").otherwise("ok")) if "preproc_edge_ratio" in metrics.columns else out


#: Columns of the table of stages, in order; fixed values.
STAGE_COLUMNS = (
    "stage_name", "n_nuclei_3d", "median_volume_px", "mean_volume_px", "std_volume_px", "volume_cv", "mean_z_extent", "mean_xy_extent", "small_fraction", "large_fraction",
    "z_coverage", "cells_per_z_mean", "cells_per_z_std", "snr_in_nuclei", "mean_intensity", "std_intensity",
)


def stage_table(stats: DataFrame, intensity: DataFrame, key: str = "t") -> DataFrame:
    """A row a stage with the 16 columns of the stage table, from label_stats and intensity_in_labels by the same key."""
    renamed = {"n_cells": "n_nuclei_3d", "median_volume": "median_volume_px", "mean_volume": "mean_volume_px", "std_volume": "std_volume_px"}
    own = stats.withColumnsRenamed(renamed).withColumn("stage_name", F.col(key).cast("string"))
    means = intensity.select(key, F.col("snr").alias("snr_in_nuclei"), F.col("mean").alias("mean_intensity"), F.col("std").alias("std_intensity"))
    return own.join(means, key).select(*STAGE_COLUMNS)


#: Series of the report's panels, by panel; fixed values.
PANELS = {
    "counts": ("n_nuclei_3d",), "volumes": ("median_volume_px", "mean_volume_px", "std_volume_px"), "heterogeneity": ("volume_cv", "small_fraction", "large_fraction"),
    "coverage": ("z_coverage", "cells_per_z_mean", "cells_per_z_std"),
}


def panels(stages: DataFrame) -> DataFrame:
    """(panel, stage_name, series, value): the tables behind the report's plots. stages: stage_table."""
    rows = [F.struct(F.lit(p).alias("panel"), F.lit(c).alias("series"), F.col(c).cast("double").alias("value")) for p, cs in PANELS.items() for c in cs]
    return stages.select("stage_name", F.explode(F.array(*rows)).alias("_p")).select("_p.panel", "stage_name", "_p.series", "_p.value")


def diagnostic_table(ranges: DataFrame, noise: DataFrame, key: str = "t") -> DataFrame:
    """A row a stage with the 13 columns of the diagnosis: dynamic_range_info by key, and the slices' SNR and noise. noise: (key, z, snr, noise_std)."""
    per = noise.groupBy(key).agg(F.median("snr").alias("snr_median"), F.min("snr").alias("snr_min"), F.median("noise_std").alias("noise_std_median"))
    return ranges.join(per, key).select(
        F.col(key).cast("string").alias("name"), "min", "max", F.col("p1").alias("p01"), "p99", "p999", "mean", "std", "frac_zero", F.col("frac_sat").alias("frac_saturated"),
        "snr_median", "snr_min", "noise_std_median",
    )


def diagnostic_findings(voxels: DataFrame, scales: DataFrame, table: DataFrame, camera_percentile: float = 0.02, least_scale: float = 1.5) -> DataFrame:
    """(t, finding, value): the diagnosis of each volume as rows.

    Background (values below the 30th percentile): mean, deviation, what the camera's percentile takes off and what remains, and
    whether more than the deviation remains. Corrections (t, z, scale): the greatest and how many slices exceed `least_scale`. The
    share of zeros, and the 1st and 99th percentile with and without them. table: diagnostic_table, for the noise.
    """
    v = F.col("value")
    cut = voxels.groupBy("t").agg(F.percentile(v, F.lit([0.3, camera_percentile, 0.01, 0.99])).alias("_q"), F.percentile(F.when(v > 0, v), F.lit([0.01, 0.99])).alias("_p"), F.avg((v == 0).cast("double")).alias("zeros"))
    dark = voxels.join(cut.select("t", F.col("_q")[0].alias("_c")), "t").where(v < F.col("_c")).groupBy("t").agg(F.avg(v).alias("bg_mean"), F.stddev_pop(v).alias("bg_std"))
    steep = scales.groupBy("t").agg(F.max("scale").alias("max_scale"), F.count_if(F.col("scale") > least_scale).cast("double").alias("n_high_scale"))
    noise = table.select(F.col("name").cast("int").alias("t"), "noise_std_median", "snr_median")
    rows = cut.join(dark, "t", "left").join(steep, "t", "left").join(noise, "t", "left").withColumn("residual", F.col("bg_mean") - F.col("_q")[1])
    found = {
        "background_mean": F.col("bg_mean"), "background_std": F.col("bg_std"), "camera_level": F.col("_q")[1], "residual": F.col("residual"), "residual_problem": (F.col("residual") > F.col("bg_std")).cast("double"),
        "max_scale": F.col("max_scale"), "n_high_scale": F.col("n_high_scale"), "noise_std": F.col("noise_std_median"), "snr": F.col("snr_median"), "zero_share": F.col("zeros"),
        "p1": F.col("_q")[2], "p1_tissue": F.col("_p")[0], "p99": F.col("_q")[3], "p99_tissue": F.col("_p")[1],
    }
    return rows.select("t", F.explode(F.array(*(F.struct(F.lit(n).alias("finding"), c.cast("double").alias("value")) for n, c in found.items()))).alias("_f")).select("t", "_f.*")


def noise_amplification(before: DataFrame, after: DataFrame) -> DataFrame:
    """(name, amplification): noise after a step over noise before it, the latter at least 0.01. Both: diagnostic_table."""
    own = before.select("name", F.col("noise_std_median").alias("_b"))
    return after.join(own, "name").select("name", (F.col("noise_std_median") / F.greatest("_b", F.lit(0.01))).alias("amplification"))


def report_lines(stages: DataFrame) -> DataFrame:
    """(section, stage_name, line): the table of stages with changes, then the alerts, in words. A table of stages is small."""
    shown = lambda x: clean(x, 1).cast("string")
    d = stage_delta(stages).join(stages.select("stage_name", "median_volume", "z_coverage"), "stage_name")
    head = d.select(F.lit("table").alias("section"), "stage_name", F.format_string("%s %d %+d %s%% %s %s%%", "stage_name", "total_nuclei", F.coalesce("delta", F.lit(0)), shown(F.coalesce("delta_pct", F.lit(0.0))), shown(F.col("median_volume")), shown(F.col("z_coverage") * 100)).alias("line"))
    alerts = stage_alerts(stages).select(F.lit("alerts").alias("section"), "stage_name", F.concat_ws(" ", "alert", "stage_name").alias("line"))
    return head.unionByName(alerts)


#: Value of a track by colour mode: the column that is averaged over its rows; fixed values.
MEAN_MODES = {"frame": "frame", "depth": "spherical_depth", "theta": "theta_deg", "phi": "phi_deg", "speed": "step_speed", "radial_vel": "radial_velocity_smooth"}


def track_lut(df: DataFrame, mode: str) -> DataFrame:
    """(track_id, lut): brightness 5..255 of each track's label by a colour mode.

    Means of a column over the range of all tracks; "depth_travel" the range of depth along the track; "radial_vel" diverges about
    zero, its ends at the greater of the 2nd and 98th percentile; "ingressing" and "roi" are bright if any row has the flag. A track
    without a value is dim, and counts as 0 in the range.
    """
    rows = (step_speed(df) if mode == "speed" and "step_speed" not in df.columns else df).where("track_id IS NOT NULL")
    flags = {"ingressing": "ingressing", "roi": "in_roi"}
    if mode in flags:
        return rows.groupBy("track_id").agg(F.bool_or(flags[mode]).alias("_v")).select("track_id", lut_flag(F.col("_v")).alias("lut"))
    value = F.max("spherical_depth") - F.min("spherical_depth") if mode == "depth_travel" else F.avg(MEAN_MODES[mode])
    tracks = rows.groupBy("track_id").agg(value.cast("double").alias("_v"))
    if mode == "radial_vel":
        q = exact_quantiles(tracks, "_v", [0.02, 0.98]).select(F.greatest(F.abs(F.col("q")[0]), F.abs(F.col("q")[1])).alias("_most"))  # one row
        return tracks.crossJoin(F.broadcast(q)).select("track_id", lut_diverging(F.col("_v"), F.col("_most")).alias("lut"))
    known = F.coalesce("_v", F.lit(0.0))
    ends = tracks.agg(F.min(known).alias("_lo"), F.max(known).alias("_hi"))  # one row
    return tracks.crossJoin(F.broadcast(ends)).select("track_id", lut_value(F.col("_v"), F.col("_lo"), F.col("_hi")).alias("lut"))
