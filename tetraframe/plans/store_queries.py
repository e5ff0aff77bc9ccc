"""Queries over image stores: the voxel view is written as pages, chunks or containers and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tetraframe.plans import fixtures as fx
from tetraframe.plans.book import Book, folder, rounded
from tetraframe.sources import array_store as st
from tetraframe.sources import container_source as ct
from tetraframe.sources import images as im
from tetraframe.sources import readers as rd
from tetraframe.sources import tiff_source as ts

BOOK = Book(voxels=fx.VOXELS)
a = BOOK.add
PLACE = ("t", "z", "y", "x")


def view(s: SparkSession, f: str) -> DataFrame:
    """Voxels with time points from 0, as stores number them."""
    return fx.voxels(s, f).select((F.col("t") - 1).alias("t"), "z", "y", "x", "value", "label")


def whole(df: DataFrame, kind: str = "int") -> DataFrame:
    """Values as whole numbers."""
    return df.withColumn("value", F.col("value").cast(kind))


# --- pages -------------------------------------------------------------------------------------------------------


def tiff_files(s: SparkSession, f: str) -> str:
    """A file a time point: every second one deflated with differences, the others by LZW."""
    path, v = folder(s, "tiff"), fx.voxels(s, f)
    ts.write_tiff(v.where("t % 2 = 1"), path, compression="zlib", predictor=True)
    ts.write_tiff(v.where("t % 2 = 0"), path, compression="lzw")
    return path


def sized_files(s: SparkSession, f: str) -> str:
    """A file a time point: sizes written out, or resolutions by the inch, or by the centimetre."""
    path, v = folder(s, "sized"), fx.voxels(s, f)
    ts.write_tiff(v.where("t % 3 = 0"), path, voxel_um=(2.5, 0.5, 0.25))
    ts.write_tiff(v.where("t % 3 = 1"), path, text="ImageJ=1.11a\nspacing=3.5\n", resolution=(26738, 26738, 2), compression="none")
    ts.write_tiff(v.where("t % 3 = 2"), path, text="ImageJ=1.11a\nspacing=4.5\n", resolution=(26738, 13369, 3))
    return path


def stack(s: SparkSession, f: str, **options) -> str:
    path = folder(s, "stack")
    ts.write_tiff(view(s, f), path, "stack", **options)
    return path


def written_stack(s: SparkSession, f: str) -> DataFrame:
    """Time points of 15, 14, .. slices, filled up, mirrored in y, and read back."""
    path = folder(s, "stack")
    ts.write_tiff(view(s, f).where("z < 15 - t"), path, "stack", shape=(15, fx.NY, fx.NX), flip_y=True)
    return whole(im.scan_hyperstack(s, path)).select((F.col("t") + 1).alias("t"), "z", "y", "x", "value")


def written_volumes(s: SparkSession, f: str) -> DataFrame:
    path = folder(s, "volumes")
    ts.write_tiff(fx.voxels(s, f), path, voxel_um=(2.0, 0.374, 0.374))
    return whole(im.scan_tiff_volumes(s, path))


a("src5_scan_tiff_volume", lambda s, f: whole(im.scan_tiff_volumes(s, tiff_files(s, f))), "SELECT t, z, y, x, value FROM voxels", "voxels")
a(
    "src5_tiff_voxel_size",
    lambda s, f: rounded(im.tiff_voxel_size(ts.scan_tiff_tags(s, sized_files(s, f))).select("pages", "vox_x", "vox_y", "vox_z", "recovered")),
    """
    SELECT (max(z) + 1)::INTEGER AS pages, true AS recovered, round([0.25, 25400.0 / 26738, 10000.0 / 26738][t % 3 + 1]::DOUBLE, 6) AS vox_x,
      round([0.5, 25400.0 / 26738, 10000.0 / 13369][t % 3 + 1]::DOUBLE, 6) AS vox_y, [2.5, 3.5, 4.5][t % 3 + 1]::DOUBLE AS vox_z
    FROM voxels GROUP BY t
    """,
    "voxels",
)
a(
    "src5_scan_pages",
    lambda s, f: whole(ts.scan_tiff(s, stack(s, f), (*PLACE, "value"), 4096)).where("t IN (2, 5) AND z >= 3 AND z < 9 AND value > 1000"),
    "SELECT t - 1 AS t, z, y, x, value FROM voxels WHERE t IN (3, 6) AND z BETWEEN 3 AND 8 AND value > 1000",
    "voxels",
)
a("src6_scan_hyperstack", lambda s, f: whole(im.scan_hyperstack(s, stack(s, f))).drop("path"), "SELECT t - 1 AS t, z, y, x, value FROM voxels", "voxels")
a(
    "src6_hyperstack_inconsistent",
    lambda s, f: whole(im.scan_hyperstack(s, stack(s, f, text="ImageJ=1.11a\nslices=16\nframes=5\n"))).drop("path"),
    f"SELECT 0 AS t, ((t - 1) * {fx.NZ} + z)::INTEGER AS z, y, x, value FROM voxels",
    "voxels",
)


def legacy_sizes(s: SparkSession, f: str) -> DataFrame:
    """Sizes by the older rule, from the files' tags and from rows of another kind."""
    tags = ts.scan_tiff_tags(s, sized_files(s, f))
    rows = tags.select(F.lit("tif").alias("kind"), "x_resolution", "y_resolution", im.described_value("spacing").alias("spacing"), F.lit(None).cast("double").alias("pixel_microns"))
    none = F.lit(None).cast("double")
    other = view(s, f).select("t").distinct().select(F.lit("nd2").alias("kind"), none.alias("x_resolution"), none.alias("y_resolution"), none.alias("spacing"), (F.col("t") / 10).alias("pixel_microns"))
    return rounded(im.legacy_voxel_size(rows.unionByName(other)).select("kind", "vox_x", "vox_y", "vox_z"))


a(
    "src19_legacy_voxel_size",
    legacy_sizes,
    """
    SELECT 'tif' AS kind, round([0.25, 1 / 26738.0, 1 / 26738.0][t % 3 + 1]::DOUBLE, 6) AS vox_x, round([0.5, 1 / 26738.0, 1 / 13369.0][t % 3 + 1]::DOUBLE, 6) AS vox_y,
      [2.5, 3.5, 4.5][t % 3 + 1]::DOUBLE AS vox_z FROM (SELECT DISTINCT t FROM voxels)
    UNION ALL SELECT 'nd2', round((t - 1) / 10.0, 6)::DOUBLE, round((t - 1) / 10.0, 6)::DOUBLE, 3.0 FROM (SELECT DISTINCT t FROM voxels)
    """,
    "voxels",
)
a("snk3_write_volume", written_volumes, "SELECT t, z, y, x, value FROM voxels", "voxels")
a(
    "snk4_write_hyperstack",
    written_stack,
    "SELECT t, z, 23 - y AS y, x, CASE WHEN z < 16 - t THEN value ELSE 0 END AS value FROM voxels WHERE z < 15",
    "voxels",
)



def short_files(s: SparkSession, f: str) -> DataFrame:
    """Shapes of a file a time point; every third has two slices less."""
    path, v = folder(s, "shapes"), fx.voxels(s, f)
    ts.write_tiff(v.where("t % 3 <> 0"), path)
    ts.write_tiff(v.where("t % 3 = 0 AND z < 14"), path)
    return im.file_shapes(ts.scan_tiff_tags(s, path))


a(
    "agg31_shape_histogram",
    short_files,
    f"""
    SELECT z, {fx.NY} AS y, {fx.NX} AS x, count(*) AS n
    FROM (SELECT t, CASE WHEN t % 3 = 0 THEN 14 ELSE (max(z) + 1)::INTEGER END AS z
    FROM voxels
    GROUP BY t)
    GROUP BY z
    """,
    "voxels",
)

# --- containers --------------------------------------------------------------------------------------------------


def channels(s: SparkSession, f: str) -> DataFrame:
    """Voxels of two channels: the values, and the labels."""
    v = view(s, f)
    return v.select("t", F.lit(0).alias("c"), "z", "y", "x", "value").unionByName(v.select("t", F.lit(1).alias("c"), "z", "y", "x", F.col("label").alias("value")))


def containers(s: SparkSession, f: str) -> str:
    """One container a layout. The first tells sizes in a text, from the view's brightest voxel, the second in an attribute."""
    path, v = folder(s, "containers"), channels(s, f)
    most = v.where("c = 0").agg(F.max("value")).first()[0]
    ct.write_imaris(v, f"{path}/a.ims", (5, 10, 24), info=f'<Pixels><PhysicalSizeX value="{most}"/><PhysicalSizeY value="374"/><PhysicalSizeZ value="748"/><PhysicalSizeUnit>nm</PhysicalSizeUnit></Pixels>')
    ct.write_flat(v, f"{path}/b.h5", "Data", (16, 7, 9), attributes={"voxel_size_um": '{"x": 0.4, "y": 0.4, "z": 2.0}'})
    ct.write_flat(v.where("t = 0 AND c = 0"), f"{path}/c.h5", "image", attributes={"physical_pixel_sizes": [3.0, 0.5, 0.25]})
    return path


def listing(s: SparkSession, path: str) -> DataFrame:
    return ct.container_listing(s, path).withColumn("file", F.element_at(F.split("file", "/"), -1))


def scanned(s: SparkSession, f: str, name: str) -> DataFrame:
    return whole(ct.scan_container(s, f"{containers(s, f)}/{name}")).drop("path")


def split_files(s: SparkSession, f: str) -> DataFrame:
    """One time point of one channel, from the container over a file of its own."""
    path = folder(s, "split")
    rows = ct.scan_container(s, f"{containers(s, f)}/a.ims").where("c = 0")
    ts.write_tiff(rows.select((F.col("t") + 1).alias("t"), "z", "y", "x", "value"), path, voxel_um=(0.748, 0.374, 0.374))
    return whole(im.scan_tiff_volumes(s, f"{path}/t0003_*")).select("z", "y", "x", "value")


TWO = """
SELECT t - 1 AS t, 0 AS c, z, y, x, value FROM voxels
UNION ALL SELECT t - 1, 1, z, y, x, label FROM voxels
"""
a("src7_scan_imaris", lambda s, f: scanned(s, f, "a.ims"), TWO, "voxels")
a("src7_scan_flat", lambda s, f: scanned(s, f, "b.h5"), TWO, "voxels")
a(
    "src7_scan_chunks",
    lambda s, f: scanned(s, f, "a.ims").where("t = 4 AND c = 1 AND z BETWEEN 6 AND 11 AND y > 12 AND x <= 20"),
    "SELECT t - 1 AS t, 1 AS c, z, y, x, label AS value FROM voxels WHERE t = 5 AND z BETWEEN 6 AND 11 AND y > 12 AND x <= 20",
    "voxels",
)
a(
    "src7_container_layout",
    lambda s, f: im.container_layout(listing(s, containers(s, f))),
    """
    WITH n AS (SELECT count(DISTINCT t) AS t, (max(z) + 1)::INTEGER AS z, (max(y) + 1)::INTEGER AS y, (max(x) + 1)::INTEGER AS x FROM voxels)
    SELECT 'a.ims' AS file, 'imaris' AS mode, t AS n_t, 2::BIGINT AS n_c, z AS n_z, y AS n_y, x AS n_x FROM n
    UNION ALL SELECT 'b.h5', 'flat', t, 2, z, y, x FROM n
    UNION ALL SELECT 'c.h5', 'flat', 1, 1, z, y, x FROM n
    """,
    "voxels",
)
a(
    "src7_container_slices",
    lambda s, f: im.container_slices(listing(s, containers(s, f))),
    """
    SELECT 'a.ims' AS file, t - 1 AS t, c::INTEGER AS c, 'DataSet/ResolutionLevel 0/TimePoint ' || (t - 1) || '/Channel ' || c || '/Data' AS dataset
    FROM (SELECT DISTINCT t FROM voxels), range(2) q(c)
    """,
    "voxels",
)
a(
    "src7_image_layout",
    lambda s, f: listing(s, containers(s, f)).where("size(shape) >= 3").groupBy(F.size("shape").alias("axes")).agg(F.count(F.lit(1)).alias("n")).withColumn("layout", F.create_map(*(F.lit(x) for k in (3, 4, 5) for x in (k, rd.image_layout((1,) * k, False))))[F.col("axes")]),
    "SELECT 5 AS axes, 2 * count(DISTINCT t) + 2 AS n, 'TCZYX' AS layout FROM voxels",
    "voxels",
)
a(
    "src8_voxel_metadata",
    lambda s, f: rounded(rd.voxel_metadata(ct.container_listing(s, containers(s, f), "info").withColumn("id", F.element_at(F.split("file", "/"), -1)))),
    """
    SELECT 'a.ims' AS id, round(max(value) / 1000.0, 6)::DOUBLE AS x_um, 0.374::DOUBLE AS y_um, 0.748::DOUBLE AS z_um FROM voxels
    UNION ALL SELECT * FROM (VALUES ('b.h5', 0.4::DOUBLE, 0.4::DOUBLE, 2.0::DOUBLE), ('c.h5', 0.25, 0.5, 3.0)) v(id, x_um, y_um, z_um)
    """,
    "voxels",
)
a("src10_split_timepoints", split_files, "SELECT z, y, x, value FROM voxels WHERE t = 3", "voxels")


def viewer_levels(s: SparkSession, f: str) -> DataFrame:
    path = f"{folder(s, 'levels')}/levels.h5"
    ct.write_viewer_levels(view(s, f), path, chunk=(8, 8, 16))
    return stacked_levels([ct.scan_container(s, path, level) for level in range(3)])


def stacked_levels(levels: list[DataFrame]) -> DataFrame:
    out = None
    for level, rows in enumerate(levels):
        rows = whole(rows).select(F.lit(level).alias("level"), (F.col("t") + 1).alias("t"), "z", "y", "x", "value")
        out = rows if out is None else out.unionByName(rows)
    return out


LEVELS = "\nUNION ALL ".join(f"SELECT {k} AS level, t, z // {f} AS z, y // {f} AS y, x // {f} AS x, value FROM voxels WHERE z % {f} = 0 AND y % {f} = 0 AND x % {f} = 0" for k, f in enumerate((1, 2, 4)))
a("snk5_write_bdv", viewer_levels, LEVELS, "voxels")

# --- chunks ------------------------------------------------------------------------------------------------------


def array_store(s: SparkSession, f: str, layout: str, codec: str, form: int) -> DataFrame:
    path = folder(s, layout)
    st.write_array_store(view(s, f), path, layout, (5, 10, 24), codec=codec, form=form)
    return st.scan_array_store(s, path)


def pyramid_store(s: SparkSession, f: str) -> DataFrame:
    path = folder(s, "pyramid")
    st.write_pyramid(view(s, f), path, chunk=(8, 16, 16), voxel_um=(2.0, 0.374, 0.374))
    return stacked_levels([st.scan_array_store(s, f"{path}/{level}") for level in range(3)])


def label_store(s: SparkSession, f: str) -> DataFrame:
    path = folder(s, "labels")
    st.write_array_store(view(s, f).drop("value").withColumnRenamed("label", "value"), path, "group", (4, 12, 12), "int32")
    return st.scan_array_store(s, path).where("value > 0").groupBy((F.col("t") + 1).alias("t"), F.col("value").cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n"))


for _layout, _codec, _form in (("array", "zstd", 3), ("group", "gzip", 3), ("folder", "zlib", 2)):
    a(
        f"src11_scan_zarr_{_layout}",
        lambda s, f, k=(_layout, _codec, _form): array_store(s, f, *k),
        "SELECT t - 1 AS t, z, y, x, value::BIGINT AS value FROM voxels",
        "voxels",
    )
a(
    "src11_scan_box",
    lambda s, f: array_store(s, f, "array", "zstd", 3).where("t = 3 AND z < 6 AND y >= 12 AND x IN (1, 2, 23)"),
    "SELECT t - 1 AS t, z, y, x, value::BIGINT AS value FROM voxels WHERE t = 4 AND z < 6 AND y >= 12 AND x IN (1, 2, 23)",
    "voxels",
)
a("snk5_write_pyramid", pyramid_store, LEVELS, "voxels")
a("snk11_zarr_sink", label_store, "SELECT t, label, count(*) AS n FROM voxels WHERE label > 0 GROUP BY 1, 2", "voxels")
