"""Intermediate tables of operators that work in rounds: written to the shared folder and read again, which cuts their plans."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: While a table is written, Spark removes the query's shuffle files at its end; else they stay until the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local session without one gets a folder of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tetraframe-"))
        base = spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


def kept_table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """df as a stored table and its place in the shared folder. Removed when the application ends."""
    spark = df.sparkSession
    place = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(place)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(place), place


def dropped(spark: SparkSession, *places: str) -> None:
    """Remove tables that kept_table() wrote, once nothing reads them any more."""
    for place in places:
        path = spark._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
