"""Filters, orders, samples and set operations over spots and tracks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tetraframe.operators.kinematics import by_track, step_speed


def tracked_only(df: DataFrame) -> DataFrame:
    """Rows with a track."""
    return df.where("track_id IS NOT NULL")


def frame_range(df: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """Rows of frames first..last, each bound optional and included."""
    if first is not None:
        df = df.where(F.col("frame") >= first)
    return df if last is None else df.where(F.col("frame") <= last)


def current_frame(df: DataFrame, frame: int) -> DataFrame:
    """Rows of one frame."""
    return df.where(F.col("frame") == frame)


def in_box(x0: float, x1: float, y0: float, y1: float) -> Column:
    """Inside an XY box, bounds included; Z is free."""
    return F.col("position_x").between(x0, x1) & F.col("position_y").between(y0, y1)


def roi_filter(df: DataFrame, *box: float) -> DataFrame:
    """Rows inside a box."""
    return df.where(in_box(*box))


def flag_roi(df: DataFrame, *box: float) -> DataFrame:
    """Add in_roi."""
    return df.withColumn("in_roi", in_box(*box))


def slab(df: DataFrame, axis: str, position: float, thickness: float) -> DataFrame:
    """Rows within half a thickness of a plane."""
    return df.where(F.col(f"position_{axis}").between(position - thickness / 2, position + thickness / 2))


#: The two axes that a slab along an axis is seen in: rows, columns.
SEEN = {"x": ("z", "y"), "y": ("z", "x"), "z": ("y", "x")}


def slab_project(df: DataFrame, axis: str) -> DataFrame:
    """Coordinates in the plane across an axis."""
    row, col = SEEN[axis]
    return df.select("id", "frame", F.col(f"position_{row}").alias("row"), F.col(f"position_{col}").alias("col"))


def min_track_length(df: DataFrame, n: int) -> DataFrame:
    """Rows of tracks with at least n rows in df."""
    return df.withColumn("_n", F.count("frame").over(by_track())).where(F.col("_n") >= n).drop("_n")


def max_speed(df: DataFrame, limit: float, null_speed: str = "drop") -> DataFrame:
    """Rows of tracks whose fastest step is within a limit; a track without a step is dropped, or counts as speed 0."""
    fastest = F.max("step_speed").over(by_track())
    if null_speed == "zero":
        fastest = F.coalesce(fastest, F.lit(0.0))
    return step_speed(df).withColumn("_max", fastest).where(F.col("_max") <= limit).drop("_max", "step_speed")


def track_set(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose track is among ids (a table with track_id)."""
    return df.join(ids.select("track_id").distinct(), "track_id", "left_semi")


def tracks_where(df: DataFrame, condition: Column) -> DataFrame:
    """All rows of tracks with at least one row where the condition holds."""
    return df.where("track_id IS NOT NULL").withColumn("_any", F.bool_or(F.coalesce(condition, F.lit(False))).over(by_track())).where("_any").drop("_any")


def tracks_touching_roi(df: DataFrame, *box: float) -> DataFrame:
    """All rows of tracks that enter a box."""
    return tracks_where(df, in_box(*box))


def tracks_ingressing(df: DataFrame) -> DataFrame:
    """All rows of tracks flagged as ingressing anywhere."""
    return tracks_where(df, F.col("ingressing"))


def tracks_in_slab(df: DataFrame, axis: str, position: float, thickness: float, frame: int) -> DataFrame:
    """In-slab rows, over all frames, of tracks in the slab at one frame, if the track has two of them."""
    inside = slab(tracked_only(df), axis, position, thickness)
    return min_track_length(track_set(inside, current_frame(inside, frame)), 2)


def track_filter_pipeline(
    df: DataFrame, box: tuple[float, ...] | None = None, first: int | None = None, last: int | None = None, min_length: int = 3, speed: float | None = None,
    selection: DataFrame | None = None, ingressing: bool = False, most: int | None = None, seed: int = 42,
) -> DataFrame:
    """Chosen tracks, then those touching a box, those ingressing anywhere, the frame window, length, speed and a sample of tracks.

    Each step works on what the one before left. selection: a table with track_id; ingressing needs that column; most: tracks kept.
    """
    rows = tracked_only(df)
    if selection is not None:
        rows = track_set(rows, selection)
    if box is not None:
        rows = tracks_touching_roi(rows, *box)
    if ingressing:
        rows = tracks_ingressing(rows)
    rows = min_track_length(frame_range(rows, first, last), min_length)
    if speed is not None:
        rows = max_speed(rows, speed)
    return rows if most is None else subsample_tracks(rows, most, seed)


def track_limits(df: DataFrame) -> DataFrame:
    """(track_id, length, max_speed) of every track."""
    return step_speed(tracked_only(df)).groupBy("track_id").agg(F.count("frame").alias("length"), F.max("step_speed").alias("max_speed"))


def kept_dropped_ids(df: DataFrame, min_length: int, speed: float) -> DataFrame:
    """(track_id, kept) over the whole table; a track without a step has speed 0."""
    return track_limits(df).select("track_id", ((F.col("length") >= min_length) & (F.coalesce("max_speed", F.lit(0.0)) <= speed)).alias("kept"))


def filter_flags(df: DataFrame, min_length: int, speed: float, unnamed_length: bool = False) -> DataFrame:
    """Add filtered_out and filter_reason to every row; untracked rows pass. unnamed_length: a failure of length alone has no reason."""
    rows = step_speed(df)
    short = F.count("frame").over(by_track()) < min_length
    fast = ~F.coalesce(F.max("step_speed").over(by_track()) <= speed, F.lit(False))
    tracked = F.col("track_id").isNotNull()
    rows = rows.withColumns({"_short": tracked & short, "_fast": tracked & fast})
    reason = F.when(F.col("_short") & F.col("_fast"), "min_length+max_speed").when(F.col("_fast"), "max_speed").when(F.col("_short"), "" if unnamed_length else "min_length").otherwise("")
    return rows.withColumns({"filtered_out": F.col("_short") | F.col("_fast"), "filter_reason": reason}).drop("_short", "_fast", "step_speed")


def column_reorder(df: DataFrame, front: list[str]) -> DataFrame:
    """The named columns first, the others as they were."""
    return df.select(*front, *(c for c in df.columns if c not in front))


def crop_roi(voxels: DataFrame, y: int, x: int, h: int, w: int, ny: int, nx: int) -> DataFrame:
    """Voxels of a window in y and x over all z, counted from its corner; the window must lie in the volume."""
    if y < 0 or x < 0 or h <= 0 or w <= 0 or y + h > ny or x + w > nx:
        raise ValueError("the window leaves the volume")
    inside = voxels.where((F.col("y") >= y) & (F.col("y") < y + h) & (F.col("x") >= x) & (F.col("x") < x + w))
    return inside.withColumns({"y": F.col("y") - y, "x": F.col("x") - x})


def max_timepoints(df: DataFrame, n: int, by: str = "t") -> DataFrame:
    """Rows of the first n time points; all for n <= 0."""
    if n <= 0:
        return df
    return df.join(df.select(by).distinct().orderBy(by).limit(n), by, "left_semi")


def stride_downsample(voxels: DataFrame, n: int) -> DataFrame:
    """Every n-th voxel on each axis, renumbered."""
    keep = voxels.where(" AND ".join(f"{a} % {n} = 0" for a in "zyx"))
    return keep.withColumns({a: F.floor(F.col(a) / n).cast("int") for a in "zyx"})


def selected_tracks(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of chosen tracks with drawable: whether the track has two rows or more."""
    return track_set(df, ids).withColumn("drawable", F.count("frame").over(by_track()) >= 2)


def sort_track_frame(df: DataFrame) -> DataFrame:
    """The canonical order."""
    return df.orderBy("track_id", "frame", "id")


def natural_sort_files(names: DataFrame) -> DataFrame:
    """Names with their place: those with a number in the stem first, by the last one there, then by name."""
    stem = F.regexp_replace("name", r"(?<=.)\.[^.]*$", "")
    number = F.regexp_extract(stem, r"(\d+)(?!.*\d)", 1)
    key = [F.when(number == "", 1).otherwise(0), F.try_to_number(F.nullif(number, F.lit("")), F.lit("999999999999")), F.col("name")]
    # A listing of one folder.
    return names.withColumn("place", F.row_number().over(Window.orderBy(*key)))


def latest_points(df: DataFrame) -> DataFrame:
    """The last row of each track."""
    last = Window.partitionBy("track_id").orderBy(F.desc("frame"), F.desc("id"))
    return tracked_only(df).withColumn("_r", F.row_number().over(last)).where("_r = 1").drop("_r")


def first_middle_last(df: DataFrame, by: str = "t") -> DataFrame:
    """Up to three time points: the first, the one at half the number (from 1), the last."""
    w = Window.orderBy(by)
    t = df.select(by).distinct().withColumns({"_i": F.row_number().over(w), "_n": F.count(F.lit(1)).over(Window.partitionBy())})
    return t.where((F.col("_i") == 1) | (F.col("_i") == F.greatest(F.floor(F.col("_n") / 2), F.lit(1))) | (F.col("_i") == F.col("_n"))).select(by)


def linspace_slices(n: int, k: int) -> Column:
    """k evenly spaced whole numbers from 0 to n-1, truncated."""
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.floor(i * ((n - 1) / max(k - 1, 1))).cast("int"))


def shuffle_key(id: Column, seed: int) -> Column:
    """A number below 2^31 that orders ids as if at random, by arithmetic that any SQL engine has: two rounds of a linear congruence."""
    m, step = F.lit(2147483647), lambda x, k: F.pmod(x * k + 12345 + seed, F.lit(2147483647))
    return step(F.pmod(step(F.pmod(id.cast("long"), m), 48271) * 1103515, m) + F.pmod(F.floor(id / 65536), m), 69621)


def subsample_tracks(df: DataFrame, most: int, seed: int = 42) -> DataFrame:
    """Rows of at most `most` tracks, those with the smallest key: the same for the same seed on any cluster."""
    ids = tracked_only(df).select("track_id").distinct().orderBy(shuffle_key(F.col("track_id"), seed), "track_id").limit(most)
    return track_set(df, ids)


def lowest(df: DataFrame, key: Column, n: int, *ties: str) -> DataFrame:
    """The n rows of the least keys (below 2^31, then by `ties`), as a filter: only rows of one of 65,536 ranges of keys are put in order."""
    counts = df.groupBy(F.shiftright(key, 15).alias("_range")).agg(F.count(F.lit(1)).alias("_n")).orderBy("_range").collect()
    before = 0
    for r in counts:
        if before + r["_n"] > n:
            some = df.where(F.shiftright(key, 15) == r["_range"]).orderBy(key, *ties).limit(n - before)
            return df.where(F.shiftright(key, 15) < r["_range"]).unionByName(some)
        before += r["_n"]
    return df


def subsample_points(df: DataFrame, percent: float, floor: int = 1000, seed: int = 0) -> DataFrame:
    """A share of the rows by shuffled id, but `floor` rows at least."""
    n = df.count()
    return lowest(df, shuffle_key(F.col("id"), seed), min(n, max(floor, int(n * percent / 100))), "id")


def sample_without_repeat(df: DataFrame, drawn: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n track ids that were not drawn before."""
    rest = tracked_only(df).select("track_id").distinct().join(drawn, "track_id", "left_anti")
    return rest.orderBy(shuffle_key(F.col("track_id"), seed), "track_id").limit(n)


def toggle_selection(selected: DataFrame, clicked: DataFrame) -> DataFrame:
    """The selected ids with the clicked ones switched."""
    return selected.join(clicked, "track_id", "left_anti").unionByName(clicked.join(selected, "track_id", "left_anti"))


def id_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Ids of a that are not in b."""
    return a.join(b, "track_id", "left_anti")


def id_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    """Ids in both."""
    return a.intersect(b)


def union_of_columns(frames: Iterable[DataFrame]) -> DataFrame:
    """Rows of all tables, missing columns null."""
    first, *rest = frames
    for f in rest:
        first = first.unionByName(f, allowMissingColumns=True)
    return first


def dedupe_files(*listings: DataFrame) -> DataFrame:
    """Names of several listings, each once."""
    first, *rest = listings
    for x in rest:
        first = first.union(x)
    return first.dropDuplicates(["name"])


def display_points(df: DataFrame, box: tuple[float, ...] | None = None, selection: DataFrame | None = None, ingressing: bool = False, percent: float = 100.0, floor: int = 1000, seed: int = 0) -> DataFrame:
    """Points shown, tracked or not: of chosen tracks, inside a box, of tracks ingressing anywhere; below 100 percent that share, `floor` at least."""
    rows = df if selection is None else track_set(df, selection)
    if box is not None:
        rows = roi_filter(rows, *box)
    if ingressing:
        # The tracks are those of the whole table: the point that is flagged may lie outside the box.
        rows = track_set(rows, df.where("ingressing AND track_id IS NOT NULL").select("track_id"))
    return rows if percent >= 100 else subsample_points(rows, percent, floor, seed)
