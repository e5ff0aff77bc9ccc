"""Sinks: table bundles, filtered exports, stacks by time point, metric files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tetraframe.operators import filters as fl
from tetraframe.operators import reports as rep
from tetraframe.operators.volumes import padded_hyperstack, pyramid

FRONT = ["track_id", "frame", "filtered_out", "filter_reason"]


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files with upper-case headers."""
    df.toDF(*(c.upper() for c in df.columns)).write.mode("overwrite").csv(path, header=True)


def write_table(df: DataFrame, path: str) -> None:
    """A folder of CSV files with the headers as they are."""
    df.write.mode("overwrite").csv(path, header=True)


def export_filtered(spots: DataFrame, path: str, min_length: int, speed: float) -> None:
    """Flagged spots, the tracks that pass, their summary, and a JSON row of counts."""
    flagged = fl.column_reorder(fl.filter_flags(spots, min_length, speed), FRONT)
    write_csv(flagged, f"{path}/cross_section_filtered_spots.csv")
    write_csv(fl.tracked_only(flagged.where("NOT filtered_out")), f"{path}/cross_section_filtered_tracks.csv")
    write_csv(rep.track_summary(flagged), f"{path}/cross_section_filtered_summary.csv")
    rep.export_meta(flagged).write.mode("overwrite").json(f"{path}/analysis_metadata.json")


def export_bundle(spots: DataFrame, path: str, sphere: DataFrame | None = None, box: tuple[float, ...] | None = None, landmarks: DataFrame | None = None, parameters: dict | None = None) -> None:
    """All tables of an analysis; those without input are left out."""
    spark = spots.sparkSession
    ordered = fl.sort_track_frame(spots)
    write_csv(ordered, f"{path}/oriented_spots.csv")
    write_csv(fl.tracked_only(ordered), f"{path}/oriented_tracks.csv")
    write_csv(rep.track_summary(spots), f"{path}/track_summary.csv")
    if sphere is not None:
        write_csv(as_parameters(sphere), f"{path}/sphere_params.csv")
    if box is not None:
        write_csv(spark.createDataFrame([tuple(map(float, box))], "x_min double, x_max double, y_min double, y_max double"), f"{path}/roi_bounds.csv")
    if landmarks is not None:
        write_csv(landmarks, f"{path}/gastrulation_landmarks.csv")
    if parameters:
        write_csv(spark.createDataFrame([(k, str(v)) for k, v in parameters.items()], "parameter string, value string"), f"{path}/ingression_params.csv")
    spots.agg(F.count(F.lit(1)).alias("n_spots"), F.count_distinct("frame").alias("n_frames"), F.count_distinct("track_id").alias("n_tracks")).write.mode("overwrite").json(f"{path}/analysis_metadata.json")


def as_parameters(row: DataFrame) -> DataFrame:
    """(parameter, value) rows of a one-row table."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in row.columns)
    return row.selectExpr(f"stack({len(row.columns)}, {pairs}) AS (parameter, value)")


def write_volumes(voxels: DataFrame, path: str) -> None:
    """A stack by time point, sorted by z inside."""
    voxels.repartition("t").sortWithinPartitions("t", "z", "y", "x").write.mode("overwrite").partitionBy("t").parquet(path)


def write_stack(voxels: DataFrame, path: str, formats: list[str], flip_y: bool = False) -> None:
    """A padded stack, and levels of a pyramid where asked for."""
    dense = padded_hyperstack(voxels, flip_y)
    if "tiff" in formats:
        write_volumes(dense, f"{path}/stack")
    if "bdv" in formats:
        pyramid(dense).write.mode("overwrite").partitionBy("level", "t").parquet(f"{path}/pyramid")


#: Names of the two output formats; fixed values.
FORMAT_NAMES = {"tiff": "tiff", "tif": "tiff", "bdv": "bdv", "hdf5": "bdv", "xml": "bdv"}


def parse_formats(given: str | list[str]) -> list[str]:
    """Output formats, sorted: of a list the known names (the plain stack if none is), of one text that format, "both" or "all" both, else the plain stack."""
    if isinstance(given, list):
        return sorted({FORMAT_NAMES[n] for x in given if (n := x.lower().strip()) in FORMAT_NAMES}) or ["tiff"]
    name = given.lower().strip()
    return ["bdv", "tiff"] if name in ("both", "all") else [FORMAT_NAMES.get(name, "tiff")]


def merged_voxel_size(rows: DataFrame) -> DataFrame:
    """Add vox_xy and vox_z: resolution over scaling, and spacing spread over the new number of slices where that changed."""
    z = F.when(F.col("nz") != F.col("nz0"), F.col("spacing") * F.col("nz0") / F.col("nz")).otherwise(F.col("spacing"))
    return rows.withColumns({"vox_xy": F.col("res") / F.col("scaling"), "vox_z": z})


def save_metrics(parts: list[DataFrame], path: str) -> None:
    """Rows with all columns of any part, as CSV and JSON."""
    rows = fl.union_of_columns(parts)
    rows.write.mode("overwrite").csv(f"{path}/metrics_csv", header=True)
    rows.write.mode("overwrite").json(f"{path}/metrics_json")
