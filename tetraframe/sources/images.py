"""Image scans: TIFF volumes and hyperstacks, voxel sizes from their tags, chunked array stores, layouts of container files.

Pages, chunks and datasets come from the data sources beside this module; sizes and layouts are column expressions over the metadata.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tetraframe.sources.tiff_source import scan_tiff


def described_value(key: str, description: Column | None = None) -> Column:
    """The number of a key=value line of a description; null without one."""
    text = F.col("description") if description is None else description
    return F.regexp_extract(text, rf"(?m)^\s*{key}=([0-9.eE+-]+)\s*$", 1).try_cast("double")


def micrometres_a_pixel(per_unit: Column, unit: Column) -> Column:
    """Micrometres from pixels a unit: inches for code 2, else centimetres; null unless positive."""
    return F.when(per_unit > 0, F.when(unit == 2, 25400.0).otherwise(10000.0) / per_unit)


def tiff_voxel_size(tags: DataFrame) -> DataFrame:
    """Add vox_x, vox_y, vox_z in micrometres and recovered: whether none had to be taken as 1.

    In this order: sizes written out in the description, spacing there for z, resolution tags with their unit, 1.
    """
    positive = lambda c: F.when(c > 0, c)
    x, y = (F.coalesce(positive(described_value(f"{a}_resolution_um")), micrometres_a_pixel(F.col(f"{a}_resolution"), F.col("resolution_unit"))) for a in "xy")
    z = described_value("spacing")
    return tags.withColumns({"recovered": x.isNotNull() & y.isNotNull() & z.isNotNull(), **{f"vox_{a}": F.coalesce(v, F.lit(1.0)) for a, v in zip("xyz", (x, y, z))}})


def file_shapes(tags: DataFrame) -> DataFrame:
    """(z, y, x, n): how many files have each shape, before they are merged: z may differ and is filled up. Files that differ in y or x raise an error."""
    shapes = tags.groupBy(F.col("pages").alias("z"), F.col("height").alias("y"), F.col("width").alias("x")).agg(F.count(F.lit(1)).alias("n"))
    every = F.size(F.collect_set(F.struct("y", "x")).over(Window.partitionBy()))  # a row a shape
    return shapes.withColumn("_k", every).select("z", "y", "x", F.when(F.col("_k") > 1, F.raise_error("files differ in y or x")).otherwise(F.col("n")).cast("long").alias("n"))


def scan_hyperstack(spark: SparkSession, path: str) -> DataFrame:
    """(path, t, z, y, x, value): pages as time points and slices by the description; one time point where its numbers don't fit the pages."""
    return scan_tiff(spark, path, ("path", "t", "z", "y", "x", "value"))


def scan_tiff_volumes(spark: SparkSession, path: str) -> DataFrame:
    """(t, z, y, x, value): one volume a file, its time point from the file's name."""
    from tetraframe.sources.readers import extract_timepoints

    rows = scan_tiff(spark, path, ("path", "page", "y", "x", "value")).withColumn("name", F.element_at(F.split("path", "/"), -1))
    names = extract_timepoints(spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name")))  # a row a file
    return rows.join(names, "name").select(F.col("timepoint").alias("t"), F.col("page").alias("z"), "y", "x", "value")


def legacy_voxel_size(rows: DataFrame) -> DataFrame:
    """Add vox_x, vox_y, vox_z by the older rule: tags without a unit and spacing for TIFF, else one pixel size and slices of 3.

    rows: kind ("tif" or another), x_resolution, y_resolution, spacing, pixel_microns.
    """
    tiff = F.col("kind") == "tif"
    out = {f"vox_{a}": F.when(tiff, F.coalesce(F.try_divide(F.lit(1.0), F.col(f"{a}_resolution")), F.lit(1.0))).otherwise(F.col("pixel_microns")) for a in "xy"}
    return rows.withColumns(out | {"vox_z": F.when(tiff, F.coalesce("spacing", F.lit(1.0))).otherwise(3.0)})


# --- container files ---------------------------------------------------------------------------------------------

#: Where a container keeps its full resolution, and names of a plain array; fixed values.
PYRAMID = r"^/?DataSet/ResolutionLevel 0/((?i:time ?point|t)[^/]*)/((?i:c)[^/]*)/Data$"
PLAIN = ("DataSet/ImageData", "Data", "data", "image")


def container_layout(listing: DataFrame, longest: int = 32) -> DataFrame:
    """(file, mode, n_t, n_c, n_z, n_y, n_x) from a container's datasets. listing: (file, dataset, shape).

    "imaris": a dataset a time point and channel under resolution level 0; "flat": one array of 4 axes (C, Z, Y, X) or 5 (T before
    them) whose first axis is at most `longest`. Files with neither are left out.
    """
    rows = listing.withColumns({"_t": F.regexp_extract("dataset", PYRAMID, 1), "_c": F.regexp_extract("dataset", PYRAMID, 2)})
    last = lambda k: F.element_at("shape", -k)
    size = {"n_z": last(3), "n_y": last(2), "n_x": last(1)}
    deep = rows.where("_t <> ''").groupBy("file").agg(F.count_distinct("_t").alias("n_t"), F.count_distinct("_c").alias("n_c"), *(F.first(c).alias(n) for n, c in size.items())).withColumn("mode", F.lit("imaris"))
    plain = rows.where(F.trim(F.col("dataset"), F.lit("/")).isin(*PLAIN) & F.size("shape").isin(4, 5) & (F.col("shape")[0] <= longest))
    plain = plain.join(deep.select("file"), "file", "left_anti")
    order = F.array_position(F.array(*map(F.lit, PLAIN)), F.trim(F.col("dataset"), F.lit("/")))
    plain = plain.withColumn("_r", F.row_number().over(Window.partitionBy("file").orderBy(order))).where("_r = 1")
    flat = plain.select("file", F.when(F.size("shape") == 5, F.col("shape")[0]).otherwise(1).cast("long").alias("n_t"), last(4).cast("long").alias("n_c"), *(c.alias(n) for n, c in size.items()), F.lit("flat").alias("mode"))
    names = ["file", "mode", "n_t", "n_c", "n_z", "n_y", "n_x"]
    return deep.select(*names).unionByName(flat.select(*names))


def container_slices(listing: DataFrame) -> DataFrame:
    """(file, t, c, dataset): where each time point and channel of a pyramid stands, both in the order of the numbers in their names."""
    rows = listing.withColumns({"_t": F.regexp_extract("dataset", PYRAMID, 1), "_c": F.regexp_extract("dataset", PYRAMID, 2)}).where("_t <> ''")
    number = lambda c: F.coalesce(F.nullif(F.regexp_replace(c, r"\D", ""), F.lit("")).cast("long"), F.lit(0))
    rank = lambda c: (F.dense_rank().over(Window.partitionBy("file").orderBy(number(c), c)) - 1).alias(c[1:])
    return rows.select("file", rank("_t"), rank("_c"), "dataset")
