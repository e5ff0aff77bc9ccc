"""Queries over sources and sinks: views are written in a source's format and read again."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tetraframe.functions import scalars as sc
from tetraframe.operators import filters as fl
from tetraframe.operators import joins as jn
from tetraframe.plans import fixtures as fx
from tetraframe.plans.book import Book, folder, r, rounded
from tetraframe.plans.spot_queries import STEP
from tetraframe.sources import readers as rd
from tetraframe.sources import writers as wr
from tetraframe.streaming.speeds import streamed_speeds

BOOK = Book(spots=fx.SPOTS, voxels=fx.VOXELS, names=fx.NAMES_SQL, metrics=fx.METRICS, speeds=STEP)
a = BOOK.add


def texts(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(c).cast("string").alias(c) for c in df.columns))


def trackmate_csv(spark: SparkSession, sf: str) -> str:
    """Spots as an export with three rows of units under the header, and some cells that are no numbers."""
    s = fx.spots(spark, sf)
    rows = texts(s.select(F.concat(F.lit("ID"), "id").alias("LABEL"), F.col("id").alias("ID"), F.col("track_id").alias("TRACK_ID"), F.when(F.col("id") % 50 != 0, F.col("position_x")).alias("POSITION_X"), F.col("position_y").alias("POSITION_Y"), F.col("position_z").alias("POSITION_Z"), F.col("frame").alias("FRAME")))
    rows = rows.withColumn("POSITION_X", F.coalesce("POSITION_X", F.lit("n/a")))
    units = spark.createDataFrame([(f"L{k}", f"u{k}", f"u{k}", f"(px{k})", f"(py{k})", f"(pz{k})", f"f{k}") for k in range(3)], rows.schema)
    path = folder(spark, "trackmate")
    # One file, so that the rows of units come first.
    units.withColumn("_o", F.lit(0)).unionByName(rows.withColumn("_o", F.lit(1))).coalesce(1).sortWithinPartitions("_o", "ID").drop("_o").write.csv(path, header=True)
    return path


def ultrack_csv(spark: SparkSession, sf: str) -> str:
    """Spots as a track table with parents."""
    s = fx.spots(spark, sf).where("track_id IS NOT NULL")
    path = folder(spark, "ultrack")
    s.select("track_id", F.col("frame").alias("t"), F.col("position_z").alias("z"), F.col("position_y").alias("y"), F.col("position_x").alias("x"), "id", F.when(F.col("track_id") > 100, F.col("track_id") - 100).alias("parent_track_id")).write.csv(path, header=True)
    return path


LOADED = "SELECT 'ID' || id AS label, id, track_id, position_x, position_y, position_z, frame FROM spots WHERE id % 50 <> 0"
a(
    "src1_scan_trackmate",
    lambda s, f: rounded(rd.scan_trackmate(s, trackmate_csv(s, f))),
    f"SELECT 'ID' || id AS label, id, track_id, {r('CASE WHEN id % 50 <> 0 THEN position_x END AS position_x', 'position_y', 'position_z')}, frame FROM spots",
    "spots",
)
a(
    "src2_scan_ultrack",
    lambda s, f: rounded(rd.scan_ultrack(s, ultrack_csv(s, f))),
    f"""
    SELECT track_id, frame, {r('position_z', 'position_y', 'position_x')}, id, CASE WHEN track_id > 100 THEN track_id - 100 END AS parent_track_id
    FROM spots
    WHERE track_id IS NOT NULL
    """,
    "spots",
)
a(
    "src3_sniff_format",
    lambda s, f: s.createDataFrame([("a", rd.sniff_format(s, trackmate_csv(s, f))), ("b", rd.sniff_format(s, ultrack_csv(s, f)))], "file string, format string"),
    "SELECT * FROM (VALUES ('a', 'trackmate'), ('b', 'ultrack')) v(file, format)",
)
a("src4_load_spots", lambda s, f: rounded(rd.load_spots(s, trackmate_csv(s, f))), LOADED, "spots")


a(
    "src9_channel_files",
    lambda s, f: rd.channel_files(fx.names(s, f), 1),
    "SELECT regexp_extract(name, '--T([0-9]{4,5})', 1)::INTEGER AS timepoint, name FROM names WHERE regexp_matches(name, '--C01--T[0-9]{4,5}[.]h5$')",
    "names",
)
def written_volumes(s: SparkSession, f: str) -> DataFrame:
    path = folder(s, "volumes")
    wr.write_volumes(fx.voxels(s, f), path)
    return rd.scan_volumes(s, path)


a("src11_scan_volumes", lambda s, f: written_volumes(s, f).groupBy("t").agg(F.sum("value").alias("total")), "SELECT t, sum(value)::BIGINT AS total FROM voxels GROUP BY 1", "voxels")
STEM = "regexp_extract(regexp_replace(name, '(.)[.][^.]*$', '\\1'), '([0-9]+)[^0-9]*$', 1)"
ORDERED = f"row_number() OVER (ORDER BY CASE WHEN {STEM} <> '' THEN 0 ELSE 1 END, nullif({STEM}, '')::BIGINT NULLS FIRST, name)::INTEGER AS place"
a(
    "src12_scan_tp_folder",
    lambda s, f: fl.natural_sort_files(fx.names(s, f).where("name LIKE '%.tif' OR name LIKE '%.zarr'")),
    f"SELECT name, {ORDERED} FROM names WHERE name LIKE '%.tif' OR name LIKE '%.zarr'",
    "names",
)
a("srt3_natural_sort_files", lambda s, f: fl.natural_sort_files(fx.names(s, f)), f"SELECT name, {ORDERED} FROM names", "names")


def stacked(s: SparkSession, f: str) -> DataFrame:
    """Every second voxel of all time points, stacked."""
    return rd.stack_timepoints([fx.voxels(s, f).where(f"t = {k}").select("z", "y", "x", "value") for k in range(1, fx.NT + 1)], 2)


a("src13_stack_timepoints", stacked, "SELECT t - 1 AS t, z // 2 AS z, y // 2 AS y, x // 2 AS x, value FROM voxels WHERE z % 2 = 0 AND y % 2 = 0 AND x % 2 = 0", "voxels")


def stage_files(s: SparkSession, f: str) -> DataFrame:
    """A file a stage: each order priority with its orders by status as counts by slice."""
    path = folder(s, "stages")
    o = fx.read(s, f, "orders").groupBy(F.col("o_orderpriority").alias("stage_name"))
    counts = F.array(*(F.count_if(F.col("o_orderstatus") == k) for k in "FOP"))
    o.agg(F.struct(counts.alias("n_labels")).alias("per_slice_stats")).select(F.to_json(F.struct("stage_name", "per_slice_stats")).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return rd.load_stage_results(s, path)


def listing(s: SparkSession, f: str) -> DataFrame:
    """Result files by time point and kind; a fifth is missing."""
    kind = F.element_at(F.array(F.lit("preprocessed"), F.lit("segmented"), F.lit("cropped")), (F.col("k") % 3 + 1).cast("int"))
    return fx.customers(s, f).where("k % 5 <> 0").select((F.col("k") / 3).cast("int").alias("timepoint"), kind.alias("kind"), F.concat(F.lit("n"), "k").alias("name"))


a(
    "src14_load_stage_json",
    lambda s, f: rd.stage_slices(stage_files(s, f)),
    """
    SELECT o_orderpriority AS stage_name, z::INTEGER AS z, count(*) FILTER (WHERE o_orderstatus = ['F', 'O', 'P'][z + 1]) AS n_labels
    FROM orders, range(3) b(z) GROUP BY 1, 2
    """,
)
a(
    "src15_discover_results",
    lambda s, f: rd.discover_results(listing(s, f)),
    """
    SELECT (c_custkey // 3)::INTEGER AS timepoint, max(CASE c_custkey % 3 WHEN 0 THEN 'n' || c_custkey END) AS preprocessed,
      max(CASE c_custkey % 3 WHEN 1 THEN 'n' || c_custkey END) AS segmented, max(CASE c_custkey % 3 WHEN 2 THEN 'n' || c_custkey END) AS cropped
    FROM customer WHERE c_custkey % 5 <> 0 GROUP BY 1
    """,
)
TP = "coalesce(" + ", ".join(f"nullif(regexp_extract(name, '{p}', 1), '')" for p in (r"(?i)t([0-9]+)_channel", r"(?i)(?:^|[^a-z])t([0-9]+)", r"(?i)tp([0-9]+)", r"(?i)--[a-z]*t([0-9]+)", r"(?i)[_ -]([0-9]+)\.(?:tiff?|h5|hdf5)$", r"([0-9]+)")) + ")::INTEGER"
a(
    "src16_extract_timepoint",
    lambda s, f: rd.extract_timepoints(fx.names(s, f)),
    f"""
    SELECT name, coalesce(t, (max(t) OVER ()) + row_number() OVER (PARTITION BY t IS NULL
    ORDER BY name))::INTEGER AS timepoint
    FROM (SELECT name, {TP} AS t
    FROM names)
    """,
    "names",
)


def configs(s: SparkSession, f: str) -> DataFrame:
    """A configuration a region, as its text is loaded."""
    rows = fx.read(s, f, "region").select("r_name", "r_regionkey").collect()  # five regions
    loaded = [rd.load_config('\ufeff{"input_dir": "%s\\ b", "max_timepoints": %d, "other": 1}' % (r["r_name"], 5 * r["r_regionkey"])) for r in rows]
    return s.createDataFrame([(c.input_dir, c.max_timepoints, c.channel) for c in loaded], "input_dir string, max_timepoints int, channel int")


def resolved_channels(s: SparkSession, f: str) -> DataFrame:
    """The channel that each nation's configuration leads to."""
    rows = fx.read(s, f, "nation").select("n_nationkey", "n_regionkey").collect()  # 25 nations
    pairs = [(r["n_nationkey"] % (r["n_regionkey"] + 1) + 1, r["n_regionkey"] + 1) for r in rows]
    return s.createDataFrame([(w, n, rd.resolve_channel(w, n)) for w, n in pairs], "wanted int, channels int, found int")


a("src17_load_config", configs, "SELECT r_name || ' b' AS input_dir, (5 * r_regionkey)::INTEGER AS max_timepoints, 0 AS channel FROM region")
a(
    "src18_resolve_channel",
    resolved_channels,
    """
    SELECT (n_nationkey % (n_regionkey + 1) + 1)::INTEGER AS wanted, (n_regionkey + 1)::INTEGER AS channels, (n_nationkey % (n_regionkey + 1))::INTEGER AS found
    FROM nation
    """,
)


def sizes(s: SparkSession, f: str) -> DataFrame:
    """What is known of a file's voxels, in turn: a sidecar, part of one and tags, nothing, tags by the inch."""
    k = F.col("k")
    of = lambda **c: F.coalesce(*(F.when(k % 4 == int(i[1:]), F.lit(v) if not hasattr(v, "cast") else v) for i, v in c.items()))
    return fx.customers(s, f).select(
        k.cast("int").alias("id"), of(k1=k / 1000).alias("x_um"), of(k1=0.374, k2=0.4).alias("y_um"), of(k1=0.748, k2=0.8).alias("z_um"), of(k1="h5").alias("source"),
        of(k1=2.0, k2=25000.0, k3=0.0, k0=50800.0 + k).alias("x_resolution"), of(k1=2.0, k2=20000.0, k0=25400.0).alias("y_resolution"), of(k1=3, k2=3, k0=2).alias("resolution_unit"), of(k1=1.0, k2=3.0, k0=2.0).alias("spacing"),
    )


SIZED = ["id", "vox_x", "vox_y", "vox_z", "voxel_size_source"]
a(
    "src20_resolve_voxel_size",
    lambda s, f: rounded(rd.resolved_voxel_size(sizes(s, f)).select(*SIZED)),
    f"""
    SELECT c_custkey::INTEGER AS id, {r("CASE c_custkey % 4 WHEN 1 THEN c_custkey / 1000.0 WHEN 2 THEN 0.4 WHEN 3 THEN 1.0 ELSE 25400.0 / (50800.0 + c_custkey) END::DOUBLE AS vox_x")},
      [1.0, 0.374, 0.5, 1.0][c_custkey % 4 + 1]::DOUBLE AS vox_y, [2.0, 0.748, 3.0, 1.0][c_custkey % 4 + 1]::DOUBLE AS vox_z,
      CASE WHEN c_custkey % 4 = 1 THEN 'sidecar_imaris (h5)' ELSE 'auto_detected' END AS voxel_size_source
    FROM customer
    """,
)
a(
    "src20_manual_voxel_size",
    lambda s, f: rd.resolved_voxel_size(sizes(s, f), (0.3, 0.3, 2.0)).select(*SIZED),
    "SELECT c_custkey::INTEGER AS id, 0.3::DOUBLE AS vox_x, 0.3::DOUBLE AS vox_y, 2.0::DOUBLE AS vox_z, 'manual_override' AS voxel_size_source FROM customer",
)


def merges(s: SparkSession, f: str) -> DataFrame:
    """Merged volumes: resolution, scaling and slices before and after, by customer."""
    k = F.col("k")
    return wr.merged_voxel_size(fx.customers(s, f).select(k.alias("id"), (0.3 + k / 1000).alias("res"), F.when(k % 2 == 0, 0.5).otherwise(1.0).alias("scaling"), F.lit(2.0).alias("spacing"), F.lit(100).alias("nz0"), (100 + k % 3 * 87).alias("nz")))


MERGED = "merged AS (SELECT c_custkey AS id, 0.3 + c_custkey / 1000.0::DOUBLE AS res, CASE WHEN c_custkey % 2 = 0 THEN 0.5 ELSE 1.0 END::DOUBLE AS scaling, 100 + c_custkey % 3 * 87 AS nz FROM customer)"
BOOK.views["merged"] = MERGED
a(
    "snk7_merged_voxel_size",
    lambda s, f: rounded(merges(s, f).select("id", "vox_xy", "vox_z")),
    f"SELECT id, {r('res / scaling AS vox_xy', 'CASE WHEN nz <> 100 THEN 200.0::DOUBLE / nz ELSE 2.0 END AS vox_z')} FROM merged",
    "merged",
)
a(
    "src21_original_z_spacing",
    lambda s, f: rounded(merges(s, f).select("id", (F.col("vox_z") * F.col("nz") / F.col("nz0")).alias("original"))),
    "SELECT id, 2.0::DOUBLE AS original FROM merged",
    "merged",
)
a(
    "sc13_channel_from_name",
    lambda s, f: fx.names(s, f).select("name", sc.channel_of(F.col("name")).alias("channel")),
    "SELECT name, coalesce(nullif(regexp_extract(name, '_Channel ([0-9]+)', 1), '')::INTEGER, 1) AS channel FROM names",
    "names",
)
a(
    "set6_dedupe_files",
    lambda s, f: fl.dedupe_files(*(fx.names(s, f).where(f"name LIKE '{p}'") for p in ("%.tif", "t%", "%.h5"))),
    "SELECT DISTINCT name FROM names WHERE name LIKE '%.tif' OR name LIKE 't%' OR name LIKE '%.h5'",
    "names",
)
a(
    "jn8_combine_metadata",
    lambda s, f: jn.combine_metadata(fx.names(s, f), fx.customers(s, f).agg(F.lit("um").alias("unit"), F.round(F.max("c_acctbal"), 2).alias("spacing"))),
    "SELECT name, 'um' AS unit, (SELECT round(max(c_acctbal), 2) FROM customer) AS spacing FROM names",
    "names",
)


def formats(s: SparkSession, f: str) -> DataFrame:
    """Output formats from words that customers' segments and keys give, alone and as lists."""
    words = F.element_at(F.array(*map(F.lit, ("tif", " XML ", "all", "hdf5,tiff", "bdv", "both", "HDF5"))), (F.col("k") % 7 + 1).cast("int"))
    given = fx.customers(s, f).select(F.when(F.col("k") % 3 == 0, F.lower("c_mktsegment")).otherwise(words).alias("w")).distinct().orderBy("w").collect()  # a dozen words
    rows = [(r["w"], ",".join(wr.parse_formats(r["w"])), ",".join(wr.parse_formats([r["w"], "bdv"]))) for r in given]
    return s.createDataFrame(rows, "given string, alone string, listed string")


a(
    "snk6_parse_formats",
    formats,
    """
    WITH w AS (SELECT DISTINCT CASE WHEN c_custkey % 3 = 0 THEN lower(c_mktsegment) ELSE ['tif', ' XML ', 'all', 'hdf5,tiff', 'bdv', 'both', 'HDF5'][c_custkey % 7 + 1] END AS given FROM customer)
    SELECT given, CASE WHEN given IN ('all', 'both') THEN 'bdv,tiff' WHEN lower(trim(given)) IN ('bdv', 'hdf5', 'xml') THEN 'bdv' ELSE 'tiff' END AS alone,
      CASE WHEN lower(trim(given)) IN ('tif', 'tiff') THEN 'bdv,tiff' ELSE 'bdv' END AS listed
    FROM w
    """,
)


def bundle(s: SparkSession, f: str, name: str) -> DataFrame:
    path = folder(s, "bundle")
    wr.export_bundle(fx.spots(s, f), path, box=(0, 1, 2, 3), parameters={"threshold": -0.5})
    return s.read.csv(f"{path}/{name}", header=True)


def exported(s: SparkSession, f: str) -> DataFrame:
    path = folder(s, "filtered")
    wr.export_filtered(fx.spots(s, f), path, 60, 200.0)
    return s.read.csv(f"{path}/cross_section_filtered_spots.csv", header=True)


def saved(s: SparkSession, f: str) -> DataFrame:
    path, m = folder(s, "metrics"), fx.metrics(s, f)
    wr.save_metrics([m.where("experiment = 'F'").select("experiment", "timepoint", "seg_n_cells"), m.where("experiment <> 'F'").select("experiment", "timepoint")], path)
    return s.read.csv(f"{path}/metrics_csv", header=True).select("experiment", F.col("timepoint").cast("int").alias("timepoint"), F.col("seg_n_cells").cast("double").alias("seg_n_cells"))


def bundle_counts(s: SparkSession, f: str) -> DataFrame:
    """(name, n, n_columns) of every table of an export with all its parts."""
    path, spots = folder(s, "bundle"), fx.spots(s, f)
    sphere = s.createDataFrame([(1.0, 2.0, 3.0, 50.0)], "center_x double, center_y double, center_z double, radius double")
    marks = s.createDataFrame([("dorsal", 1.0, 0.0, 0.0), ("animal_pole", 0.0, -1.0, 0.0)], "landmark string, x double, y double, z double")
    wr.export_bundle(spots, path, sphere, (0, 1, 2, 3), marks, {"threshold": -0.5, "min_frames": 5})
    names = ("oriented_spots", "oriented_tracks", "track_summary", "sphere_params", "roi_bounds", "gastrulation_landmarks", "ingression_params")
    tables = [(n, s.read.csv(f"{path}/{n}.csv", header=True)) for n in names] + [("analysis_metadata", s.read.json(f"{path}/analysis_metadata.json"))]
    out = None
    for n, t in tables:
        row = t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n", F.lit(len(t.columns)).alias("n_columns"))
        out = row if out is None else out.unionByName(row)
    return out


a(
    "snk1_export_bundle",
    bundle_counts,
    """SELECT * FROM (SELECT 'oriented_spots' AS name, count(*) AS n, 6 AS n_columns FROM spots UNION ALL SELECT 'oriented_tracks', count(track_id), 6 FROM spots UNION ALL SELECT 'track_summary', count(DISTINCT track_id), 7 FROM spots
  UNION ALL SELECT * FROM (VALUES ('sphere_params', 4, 2), ('roi_bounds', 1, 4), ('gastrulation_landmarks', 2, 4), ('ingression_params', 2, 2), ('analysis_metadata', 1, 3)) v(name, n, n_columns))""",
    "spots",
)
a(
    "snk1_exported_summary",
    lambda s, f: rounded(bundle(s, f, "track_summary.csv").select(F.col("TRACK_ID").cast("long").alias("track_id"), F.col("N_SPOTS").cast("long").alias("n_spots"), F.col("FRAME_START").cast("int").alias("frame_start"), F.col("MEAN_X").cast("double").alias("mean_x"))),
    f"SELECT track_id, count(*) AS n_spots, min(frame) AS frame_start, {r('avg(position_x) AS mean_x')} FROM spots WHERE track_id IS NOT NULL GROUP BY 1",
    "spots",
)
a(
    "snk2_export_filtered",
    lambda s, f: exported(s, f).select(F.col("ID").cast("long").alias("id"), F.col("TRACK_ID").cast("long").alias("track_id"), F.col("FILTERED_OUT").cast("boolean").alias("filtered_out"), F.coalesce("FILTER_REASON", F.lit("")).alias("filter_reason")),
    """WITH steps AS (SELECT *, CASE WHEN track_id IS NOT NULL AND frame > lag(frame) OVER w THEN sqrt(pow(position_x - lag(position_x) OVER w, 2) + pow(position_y - lag(position_y) OVER w, 2) + pow(position_z - lag(position_z) OVER w, 2)) / (frame - lag(frame) OVER w) END AS v FROM spots WINDOW w AS (PARTITION BY track_id ORDER BY frame, id)),
  lim AS (SELECT track_id, count(*) < 60 AS short, NOT coalesce(max(v) <= 200.0, false) AS fast FROM steps WHERE track_id IS NOT NULL GROUP BY 1)
  SELECT id, track_id, coalesce(short OR fast, false) AS filtered_out, CASE WHEN short AND fast THEN 'min_length+max_speed' WHEN fast THEN 'max_speed' WHEN short THEN 'min_length' ELSE '' END AS filter_reason FROM spots LEFT JOIN lim USING (track_id)""",
    "spots",
)
a("snk8_save_metrics", saved, "SELECT experiment, timepoint, CASE WHEN experiment = 'F' THEN seg_n_cells END AS seg_n_cells FROM metrics", "metrics")
a(
    "json_round_trip",
    lambda s, f: fx.spots(s, f).select("id", F.from_json(F.to_json(F.struct("id", "frame")), "id long, frame int").alias("j")).select("id", "j.frame"),
    "SELECT id, frame FROM spots",
    "spots",
)
a(
    "stream_step_speed",
    lambda s, f: rounded(streamed_speeds(s, fx.spots(s, f).where("track_id IS NOT NULL"), folder(s, "stream")).select("track_id", "frame", "id", "step_speed")),
    f"SELECT track_id, frame, id, {r('step_speed')} FROM speeds WHERE track_id IS NOT NULL",
    "spots",
    "speeds",
)
