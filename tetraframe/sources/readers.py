"""Scans: point tables in two CSV dialects, file listings, metadata, stage statistics, volumes as partitioned tables."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tetraframe.sources.images import micrometres_a_pixel

CORE = ("position_x", "position_y", "position_z", "frame")
TRACK_TABLE = {"track_id", "t", "z", "y", "x"}
#: Columns that are numbers besides those whose name holds POSITION.
NUMBERS = ("FRAME", "QUALITY", "RADIUS", "ID", "TRACK_ID")
WHOLE = {"FRAME": "int", "ID": "long", "TRACK_ID": "long"}


def number(c: Column) -> Column:
    """A text as a double; null if it is none, or is not a number."""
    v = F.trim(c).try_cast("double")
    return F.when(~F.isnan(v), v)


def whole(c: Column, kind: str) -> Column:
    """A text as a whole number, truncated."""
    return number(c).try_cast(kind)


def _csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True)


def sniff_format(spark: SparkSession, path: str) -> str:
    """"ultrack" if the header has the track table's columns, else "trackmate"."""
    return "ultrack" if set(_csv(spark, path).columns) >= TRACK_TABLE else "trackmate"


def scan_trackmate(spark: SparkSession, path: str) -> DataFrame:
    """A spots export: text columns, numbers coerced, the rows of units under the header left out.

    Unit rows are known by value: if the first line's first numeric column is no number, the first three lines go; they are found
    again by their content, so the scan stays split.
    """
    raw = _csv(spark, path)
    names = [c for c in raw.columns if "POSITION" in c.upper() or c.upper() in NUMBERS]
    head = raw.limit(3).collect()  # three rows
    if head and names and not _is_number(head[0][names[0]]):
        for row in head:
            same = None
            for c in raw.columns:
                m = F.col(c).eqNullSafe(F.lit(row[c]))
                same = m if same is None else same & m
            raw = raw.where(~same)
    return raw.select(*((whole(F.col(c), WHOLE[c.upper()]) if c.upper() in WHOLE else number(F.col(c))).alias(c.lower()) if c in names else F.col(c).alias(c.lower()) for c in raw.columns))


def _is_number(v: str | None) -> bool:
    try:
        float(v)
    except (TypeError, ValueError):
        return False
    return True


def scan_ultrack(spark: SparkSession, path: str) -> DataFrame:
    """A track table: t, z, y, x become frame and positions, parent_track_id is kept as a number."""
    raw = _csv(spark, path)
    renamed = {"t": "frame", "z": "position_z", "y": "position_y", "x": "position_x"}
    kinds = {"track_id": "long", "t": "int", "id": "long", "parent_track_id": "long", "parent_id": "long"}
    out = []
    for c in raw.columns:
        v = whole(F.col(c), kinds[c]) if c in kinds else number(F.col(c)) if c in renamed else F.col(c)
        out.append(v.alias(renamed.get(c, c)))
    return raw.select(*out)


def load_spots(spark: SparkSession, path: str) -> DataFrame:
    """Sniff, scan, and keep rows with all core columns; a missing core column is an error."""
    df = scan_ultrack(spark, path) if sniff_format(spark, path) == "ultrack" else scan_trackmate(spark, path)
    missing = [c for c in CORE if c not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    return df.dropna(subset=list(CORE)).withColumn("frame", F.col("frame").cast("int"))


#: Number patterns of file names, in order; fixed values.
TIMEPOINT_PATTERNS = (r"(?i)t(\d+)_Channel", r"(?i)(?:^|[^a-z])t(\d+)", r"(?i)tp(\d+)", r"(?i)--[A-Za-z]*T(\d+)", r"[_\-\s](\d+)\.(?:[tT][iI][fF]{1,2}|[hH]5|[hH][dD][fF]5)$", r"(\d+)")


def extract_timepoints(names: DataFrame) -> DataFrame:
    """Add timepoint: the first pattern that matches; if none does for any, the alphabetical place; for the rest numbers above.

    A listing of one folder is small.
    """
    got = F.coalesce(*(F.nullif(F.regexp_extract("name", p, 1), F.lit("")) for p in TIMEPOINT_PATTERNS)).try_cast("int")
    rows = names.withColumn("_t", got)
    order = Window.partitionBy(F.col("_t").isNull()).orderBy("name")
    rows = rows.withColumns({"_r": F.row_number().over(order), "_m": F.max("_t").over(Window.partitionBy())})
    fill = F.when(F.col("_m").isNull(), F.col("_r") - 1).otherwise(F.col("_m") + F.col("_r"))
    return rows.withColumn("timepoint", F.coalesce("_t", fill).cast("int")).drop("_t", "_r", "_m")


def channel_files(names: DataFrame, channel: int) -> DataFrame:
    """(timepoint, name) of one channel of a split recording, one file a time point."""
    p = r"--C(\d{2,})--T(\d{4,5})\.h5?$"
    rows = names.select("name", F.regexp_extract("name", p, 1).try_cast("int").alias("c"), F.regexp_extract("name", p, 2).try_cast("int").alias("timepoint"))
    return rows.where(F.col("c") == channel).groupBy("timepoint").agg(F.min("name").alias("name"))


def resolve_channel(wanted: int, channels: int) -> int:
    """Index from 0 of a channel given from 1; 0 asks for the only one."""
    if wanted == 0:
        if channels != 1:
            raise ValueError("several channels: name one")
        return 0
    if not 1 <= wanted <= channels:
        raise ValueError(f"channel {wanted} of {channels}")
    return wanted - 1


def discover_results(listing: DataFrame, kinds: tuple[str, ...] = ("preprocessed", "segmented", "cropped")) -> DataFrame:
    """A row a time point, a column a kind of file. listing: (timepoint, kind, name)."""
    return listing.groupBy("timepoint").pivot("kind", list(kinds)).agg(F.min("name"))


def voxel_metadata(raw: DataFrame) -> DataFrame:
    """(id, x_um, y_um, z_um) from an attribute text: XML sizes, as attributes or as elements, else JSON attributes; units become micrometres."""
    forms = [r'PhysicalSize{0}="([0-9.eE+-]+)"', r'PhysicalSize{0}\b[^>]*?(?:value=|>)" ?([0-9.eE+-]+) ?"', r"<PhysicalSize{0}>([^<]+)</PhysicalSize{0}>"]
    first = lambda *patterns: F.coalesce(*(F.nullif(F.regexp_extract("meta", p, 1), F.lit("")) for p in patterns))
    xml = {a: first(*(f.format(a.upper()) for f in forms)).try_cast("double") for a in "xyz"}
    unit = F.lower(first(r'PhysicalSizeXUnit="(\w+)"', r"<PhysicalSizeUnit>(\w+)</PhysicalSizeUnit>", r'PhysicalSizeUnit="(\w+)"'))
    factor = F.when(unit == "nm", 1e-3).when(unit == "mm", 1e3).when(unit == "pm", 1e-6).otherwise(1.0)
    js = F.from_json("meta", "x_um double, y_um double, z_um double")
    return raw.select("id", *(F.coalesce(xml[a] * factor, js[f"{a}_um"]).alias(f"{a}_um") for a in "xyz"))


def resolved_voxel_size(rows: DataFrame, manual: tuple[float, float, float] | None = None) -> DataFrame:
    """Add vox_x, vox_y, vox_z and voxel_size_source: configured, else the sidecar's three sizes, else spacing and resolution, else 1.

    Resolutions are pixels a unit: inches for unit code 2, else centimetres. rows: x_um, y_um, z_um and source of the sidecar,
    x_resolution, y_resolution, resolution_unit and spacing of the image.
    """
    if manual is not None:
        return rows.withColumns({f"vox_{a}": F.lit(v) for a, v in zip("xyz", manual)} | {"voxel_size_source": F.lit("manual_override")})
    side = F.col("x_um").isNotNull() & F.col("y_um").isNotNull() & F.col("z_um").isNotNull()
    per = {a: micrometres_a_pixel(F.col(f"{a}_resolution"), F.col("resolution_unit")) for a in "xy"} | {"z": F.col("spacing")}
    out = {f"vox_{a}": F.when(side, F.col(f"{a}_um")).otherwise(F.coalesce(per[a], F.lit(1.0))) for a in "xyz"}
    named = F.concat(F.lit("sidecar_imaris ("), F.coalesce("source", F.lit("unknown source")), F.lit(")"))
    return rows.withColumns(out | {"voxel_size_source": F.when(side, named).otherwise("auto_detected")})


def load_stage_results(spark: SparkSession, pattern: str) -> DataFrame:
    """Stage statistics of many JSON files, by stage name."""
    return spark.read.json(pattern, multiLine=True).orderBy("stage_name")


def stage_slices(stages: DataFrame) -> DataFrame:
    """(stage_name, z, n_labels): the arrays of the stage statistics as rows."""
    return stages.select("stage_name", F.posexplode("per_slice_stats.n_labels").alias("z", "n_labels"))


def scan_volumes(spark: SparkSession, path: str) -> DataFrame:
    """A stack stored by time point: partitions are pruned by t."""
    return spark.read.parquet(path)


def check_one_shape(volumes: DataFrame) -> DataFrame:
    """The stack, if all time points have one shape."""
    s = volumes.groupBy("t").agg(*(F.max(a).alias(a) for a in "zyx"))
    if s.agg(F.count_distinct("z", "y", "x")).first()[0] > 1:
        raise ValueError("time points differ in shape")
    return volumes


def stack_timepoints(parts: list[DataFrame], stride: int = 1) -> DataFrame:
    """Volumes (z, y, x, value) one after the other as t = 0, 1, ..., checked for one shape, optionally every stride-th voxel."""
    from tetraframe.operators.filters import stride_downsample

    out = None
    for t, p in enumerate(parts):
        p = p.withColumn("t", F.lit(t))
        out = p if out is None else out.unionByName(p)
    check_one_shape(out)
    return out if stride == 1 else stride_downsample(out, stride)


def image_layout(shape: tuple[int, ...], grouped: bool) -> str:
    """Layout of an array file: grouped by resolution level, or a flat array of 3 to 5 axes; a flat first axis above 32 is refused."""
    if grouped:
        return "pyramid"
    if not 3 <= len(shape) <= 5:
        raise ValueError(f"{len(shape)} axes")
    if len(shape) >= 4 and shape[0] > 32:
        raise ValueError("the first axis is too long for channels or times")
    return {3: "ZYX", 4: "CZYX", 5: "TCZYX"}[len(shape)]


@dataclass
class Config:
    """Settings of a run with their defaults."""

    input_dir: str = ""
    max_timepoints: int = 0
    channel: int = 0
    crop: dict = field(default_factory=dict)
    output_formats: str = "tiff"
    auto_detect_voxel_size: bool = True
    voxel_size: tuple[float, float, float] = (1.0, 1.0, 1.0)


def load_config(text: str) -> Config:
    """Settings from JSON: a byte-order mark and backslashes that escape nothing are dropped, unknown keys ignored, values checked."""
    text = re.sub(r'\\(?!["\\/bfnrtu])', "", text.lstrip("﻿"))
    got = json.loads(text)
    c = Config(**{k: v for k, v in got.items() if k in Config.__dataclass_fields__})
    if c.max_timepoints < 0 or c.channel < 0:
        raise ValueError("max_timepoints and channel are not negative")
    if any(v <= 0 for v in c.voxel_size):
        raise ValueError("voxel sizes are positive")
    return c
