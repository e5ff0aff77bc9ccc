"""Views of the input tables in the engine's own data model, and the same views as SQL text for the oracle."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Grid of the voxel view: t from 1, the others from 0.
NT, NZ, NY, NX = 7, 16, 24, 24


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spots from events: users are tracks (every 17th is untracked), hours are frames, one spot a track and frame."""
    e = read(spark, sf_dir, "events").select("event_id", "user_id", "value", F.expr("timestampdiff(HOUR, TIMESTAMP_NTZ '2024-01-01 00:00:00', ts)").cast("int").alias("frame"))
    first = e.groupBy("user_id", "frame").agg(F.min(F.struct("event_id", "value")).alias("e"))
    i = F.col("e.event_id")
    return first.select(
        F.when(F.col("user_id") % 17 != 0, F.col("user_id")).alias("track_id"), "frame", F.col("e.value").alias("position_x"),
        ((i * 37) % 211).cast("double").alias("position_y"), ((i * 53) % 97).cast("double").alias("position_z"), i.alias("id"),
    )


SPOTS = """spots AS (
  SELECT CASE WHEN user_id % 17 <> 0 THEN user_id END AS track_id, frame, value AS position_x,
         ((event_id * 37) % 211)::DOUBLE AS position_y, ((event_id * 53) % 97)::DOUBLE AS position_z, event_id AS id
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id, frame ORDER BY event_id) AS rn
        FROM (SELECT *, datediff('hour', TIMESTAMP '2024-01-01 00:00:00', ts)::INTEGER AS frame FROM events)) WHERE rn = 1)"""


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tracks table: the spots of every third track."""
    return spots(spark, sf_dir).where("track_id % 3 = 0").select("track_id", "frame", "position_x", "position_y", "position_z", "id")


def all_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tracks table: the spots of all tracks."""
    return spots(spark, sf_dir).where("track_id IS NOT NULL").select("track_id", "frame", "position_x", "position_y", "position_z", "id")


TRACKS = "tracks AS (SELECT * FROM spots WHERE track_id % 3 = 0)"


def cloud(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points from embeddings: the first three components as doubles, the label as frame."""
    e = read(spark, sf_dir, "embeddings")
    xyz = [F.get("embedding", F.lit(k)).cast("double").alias(f"position_{a}") for k, a in enumerate("xyz")]
    return e.select(F.col("vec_id").alias("id"), F.col("label").cast("int").alias("frame"), *xyz)


CLOUD = """cloud AS (SELECT vec_id AS id, label::INTEGER AS frame, embedding[1]::DOUBLE AS position_x, embedding[2]::DOUBLE AS position_y,
  embedding[3]::DOUBLE AS position_z FROM embeddings)"""


def voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dense grid from lineitem: value is 100 times the summed quantity of a cell, labels are blocks of bright cells."""
    li = read(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").cast("int").alias("t"), (F.col("l_orderkey") % NZ).cast("int").alias("z"), (F.col("l_partkey") % NY).cast("int").alias("y"),
        (F.col("l_suppkey") % NX).cast("int").alias("x"), (F.col("l_quantity") * 100).cast("int").alias("q"),
    )
    cells = li.groupBy("t", "z", "y", "x").agg(F.sum("q").alias("q"))
    i = F.col("id")
    spine = spark.range(NT * NZ * NY * NX).select(
        (F.floor(i / (NZ * NY * NX)) + 1).cast("int").alias("t"), (F.floor(i / (NY * NX)) % NZ).cast("int").alias("z"), (F.floor(i / NX) % NY).cast("int").alias("y"), (i % NX).cast("int").alias("x"),
    )
    v = spine.join(cells, ["t", "z", "y", "x"], "left").withColumn("value", F.least(F.coalesce("q", F.lit(0)), F.lit(65535)).cast("int")).drop("q")
    block = 1 + F.floor(F.col("z") / 4) * 36 + F.floor(F.col("y") / 4) * 6 + F.floor(F.col("x") / 4)
    bright = (F.col("value") >= 2500) & ((F.col("y") + F.col("x")) % 8 < 7)
    return v.withColumn("label", F.when(bright, block).otherwise(0).cast("int"))


VOXELS = f"""voxels AS (
  SELECT t, z, y, x, value, CASE WHEN value >= 2500 AND (y + x) % 8 < 7 THEN 1 + (z // 4) * 36 + (y // 4) * 6 + (x // 4) ELSE 0 END::INTEGER AS label
  FROM (SELECT s.t, s.z, s.y, s.x, least(coalesce(c.q, 0), 65535)::INTEGER AS value FROM
    (SELECT (i // {NZ * NY * NX} + 1)::INTEGER AS t, (i // {NY * NX} % {NZ})::INTEGER AS z, (i // {NX} % {NY})::INTEGER AS y, (i % {NX})::INTEGER AS x FROM range({NT * NZ * NY * NX}) r(i)) s
    LEFT JOIN (SELECT l_linenumber AS t, l_orderkey % {NZ} AS z, l_partkey % {NY} AS y, l_suppkey % {NX} AS x, sum((l_quantity * 100)::INTEGER) AS q FROM lineitem GROUP BY ALL) c USING (t, z, y, x)))"""


def stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipeline stages from orders by priority."""
    o = read(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_orderpriority").alias("stage_name")).agg(
        F.count(F.lit(1)).alias("total_nuclei"), F.median("o_totalprice").alias("median_volume"), F.avg("o_totalprice").alias("mean_volume"),
        F.avg((F.col("o_totalprice") < 50000).cast("double")).alias("small_fraction"), F.avg((F.col("o_totalprice") > 400000).cast("double")).alias("large_fraction"),
        F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("z_coverage"),
    )


STAGES = """stages AS (SELECT o_orderpriority AS stage_name, count(*) AS total_nuclei, median(o_totalprice) AS median_volume, avg(o_totalprice) AS mean_volume,
  avg((o_totalprice < 50000)::INTEGER::DOUBLE) AS small_fraction, avg((o_totalprice > 400000)::INTEGER::DOUBLE) AS large_fraction,
  avg((o_orderstatus = 'F')::INTEGER::DOUBLE) AS z_coverage FROM orders GROUP BY 1)"""


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark rows from orders by status and month."""
    o = read(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_orderstatus").alias("experiment"), F.date_format("o_orderdate", "yyyyMM").cast("int").alias("timepoint")).agg(
        F.avg("o_totalprice").alias("preproc_snr"), F.stddev_pop("o_totalprice").alias("preproc_sharpness"), F.count(F.lit(1)).cast("double").alias("seg_n_cells"),
        (F.max("o_totalprice") / F.min("o_totalprice")).alias("seg_mean_elongation"),
    )


METRICS = """metrics AS (SELECT o_orderstatus AS experiment, strftime(o_orderdate, '%Y%m')::INTEGER AS timepoint, avg(o_totalprice) AS preproc_snr,
  stddev_pop(o_totalprice) AS preproc_sharpness, count(*)::DOUBLE AS seg_n_cells, max(o_totalprice) / min(o_totalprice) AS seg_mean_elongation FROM orders GROUP BY 1, 2)"""

#: Patterns of file names, by customer; the sixth has no digits.
PATTERNS = ["t%04d_Channel {c}.tif", "T%03d_decon.tif", "tp%03d.tif", "run--C0{b}--T%05d.h5", "embryo_%03d.tif", "no_digits_{w}.tif", "frame%d.zarr", "scan-%d.hdf5"]


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' keys as k, with balance and name."""
    return read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("k"), "c_name", "c_acctbal", "c_mktsegment")


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing of file names: one a customer, in turn by each pattern."""
    k = F.col("k")
    parts = {"c": k % 3 + 1, "b": k % 2, "w": F.translate(k.cast("string"), "0123456789", "abcdefghij")}
    name = lambda p: F.concat(*(F.format_string(x, k) if "%" in x else parts[x[1]].cast("string") if x[0] == "{" else F.lit(x) for x in re.split(r"(\{\w\})", p) if x))
    which = F.lit(None).cast("string")
    for i, p in enumerate(PATTERNS):
        which = F.when(k % len(PATTERNS) == i, name(p)).otherwise(which)
    return customers(spark, sf_dir).select(which.alias("name"))


def _name_sql(p: str) -> str:
    parts = {"c": "(c_custkey % 3 + 1)", "b": "(c_custkey % 2)", "w": "translate(c_custkey::VARCHAR, '0123456789', 'abcdefghij')"}
    return " || ".join(f"printf('{x}', c_custkey)" if "%" in x else parts[x[1]] if x[0] == "{" else f"'{x}'" for x in re.split(r"(\{\w\})", p) if x)


NAMES_SQL = "names AS (SELECT CASE c_custkey % 8 " + " ".join(f"WHEN {i} THEN {_name_sql(p)}" for i, p in enumerate(PATTERNS)) + " END AS name FROM customer)"
