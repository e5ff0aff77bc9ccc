"""Step speeds over arriving spots: an extension of the engine for Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

AXES = ("x", "y", "z")
COLUMNS = ["track_id", "frame", *(f"position_{a}" for a in AXES), "id"]


def _speeds(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Speeds of a track's new rows after its last known one, which is the state.

    Rows of a frame that is not beyond the last known one come too late: what followed has been told already, so they are handed on
    marked, without a speed, and leave the state alone. Counting the marked rows of a batch tells how many there were.
    """
    rows = pd.concat(list(batches)).sort_values(["frame", "id"])
    if state.exists:
        frame, x, y, z = state.get
        late = rows[rows["frame"] <= frame]
        if len(late):
            yield pd.DataFrame({"track_id": key[0], "frame": late["frame"].to_numpy(), "id": late["id"].to_numpy(), "step_speed": np.nan, "late": True})
        rows = rows[rows["frame"] > frame]
        before = pd.DataFrame({"frame": [frame], "position_x": [x], "position_y": [y], "position_z": [z]})
        both = pd.concat([before, rows], ignore_index=True)
        skip = 1
    else:
        both, skip = rows.reset_index(drop=True), 0
    if not len(rows):
        return
    d = both[[f"position_{a}" for a in AXES]].diff()
    gap = both["frame"].diff()
    speed = np.sqrt((d**2).sum(axis=1, skipna=False)) / gap.where(gap > 0)
    last = both.iloc[-1]
    state.update((int(last["frame"]), float(last["position_x"]), float(last["position_y"]), float(last["position_z"])))
    yield pd.DataFrame({"track_id": key[0], "frame": rows["frame"].to_numpy(), "id": rows["id"].to_numpy(), "step_speed": speed.to_numpy()[skip:], "late": False})


def speed_stream(stream: DataFrame) -> DataFrame:
    """(track_id, frame, id, step_speed, late) of a stream of spots; late rows have no speed."""
    return stream.select(*COLUMNS).groupBy("track_id").applyInPandasWithState(
        _speeds, "track_id long, frame int, id long, step_speed double, late boolean", "frame long, x double, y double, z double", "append", GroupStateTimeout.NoTimeout
    )


def streamed_speeds(spark: SparkSession, spots: DataFrame, folder: str, files: int = 3) -> DataFrame:
    """Write spots in frame order as files, stream them one file a trigger into a table, and read that."""
    schema = spots.select(*COLUMNS).schema
    spots.select(*COLUMNS).repartitionByRange(files, "frame").withColumn("_part", F.spark_partition_id()).write.partitionBy("_part").parquet(f"{folder}/parts")
    parts = spark.read.schema(f"{schema.toDDL()}, _part int").parquet(f"{folder}/parts")
    # One after the other: the stream takes files by age.
    for k in range(files):
        parts.where(F.col("_part") == k).drop("_part").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    query = speed_stream(stream).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema("track_id long, frame int, id long, step_speed double, late boolean").parquet(f"{folder}/out")
