"""TIFF files as a data source and a sink.

Reading: a partition is a share of a file's pages. A task opens the file, walks the directories, and reads by seek the strips of the
pages it has to give, one page at a time, so a file of any size needs a page's memory. Filters on t, z and page are decided by the
source: pages that they leave out are not read.

Writing: pages are encoded in parallel, a row a page; offsets come from sums of their sizes; then tasks write each page with its
directory at its offset into one unfinished file, which the commit closes with a header and renames. The folder must be mounted
on all hosts, since stores of whole objects don't write at an offset. A task that is repeated writes the same bytes at the same
places; a job that fails removes the unfinished file.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, Filter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from tetraframe.operators.tables import dropped, kept_table
from tetraframe.sources.stores import Bounds, listed, located, opened
from tetraframe.sources.tiff import DESCRIPTION, HEADER, HEIGHT, UNIT, WIDTH, X_RES, Y_RES, Pages, directory, packed_page

#: Bytes of a file a partition takes; pixels handed over at a time.
PART_BYTES, BATCH = 64 << 20, 1 << 17
COLUMNS = {"path": ("string", pa.string()), "t": ("int", pa.int32()), "z": ("int", pa.int32()), "page": ("int", pa.int32()), "y": ("int", pa.int32()), "x": ("int", pa.int32()), "value": ("double", pa.float64())}
TAGS = "path string, pages int, description string, x_resolution double, y_resolution double, resolution_unit int, height int, width int"


@dataclass
class Share(InputPartition):
    """The k-th of `of` equal shares of a file's pages."""

    path: str
    k: int
    of: int


class TiffReader(DataSourceReader):
    """Pixels of all pages, in the columns asked for."""

    def __init__(self, options: dict, columns: list[str]):
        self.path, self.columns = options["path"], columns
        self.part_bytes = int(options.get("partbytes", PART_BYTES))
        self.bounds = Bounds(("t", "z", "page"))

    def pushFilters(self, filters: list[Filter]) -> list[Filter]:
        return self.bounds.take(filters)

    def partitions(self) -> list[Share]:
        out = []
        for path, size in listed(self.path, (".tif", ".tiff")):
            of = max(1, -(-size // self.part_bytes))
            out += [Share(path, k, of) for k in range(of)]
        return out

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        with opened(partition.path) as f:
            pages = Pages(f)
            for page in range(pages.count * partition.k // partition.of, pages.count * (partition.k + 1) // partition.of):
                t, z = divmod(page, pages.depth)
                if self.bounds(t=t, z=z, page=page):
                    yield from self._rows({"path": partition.path, "t": t, "z": z, "page": page}, pages.pixels(page))

    def _rows(self, same: dict, pixels: np.ndarray) -> Iterator[pa.RecordBatch]:
        step = max(1, BATCH // max(pixels.shape[1], 1))
        for y in range(0, pixels.shape[0], step):
            part = pixels[y : y + step]
            rows = {"y": lambda: np.repeat(np.arange(y, y + len(part), dtype=np.int32), part.shape[1]), "x": lambda: np.tile(np.arange(part.shape[1], dtype=np.int32), len(part)), "value": lambda: part.ravel().astype(np.float64)}  # noqa: B023
            made = [pa.array(rows[c]()) if c in rows else pa.repeat(pa.scalar(same[c], COLUMNS[c][1]), part.size) for c in self.columns]
            yield pa.RecordBatch.from_arrays(made, self.columns)


class TagReader(TiffReader):
    """A row a file: what its first directory says. Pixels are not read."""

    def pushFilters(self, filters: list[Filter]) -> list[Filter]:
        return filters

    def partitions(self) -> list[Share]:
        return [Share(path, 0, 1) for path, _ in listed(self.path, (".tif", ".tiff"))]

    def read(self, partition: Share) -> Iterator[tuple]:
        with opened(partition.path) as f:
            pages = Pages(f)
            ratio = lambda t: pages.head[t][0] / pages.head[t][1] if t in pages.head and pages.head[t][1] else None
            yield partition.path, pages.count, pages.head.get(DESCRIPTION), ratio(X_RES), ratio(Y_RES), pages.head.get(UNIT, (None,))[0], pages.head[HEIGHT][0], pages.head[WIDTH][0]


@dataclass
class Written(WriterCommitMessage):
    """Pages a task has written, by file."""

    pages: dict[str, int] = field(default_factory=dict)


class TiffWriter(DataSourceArrowWriter):
    """Pages at their offsets: rows (file, at, after, first, ny, nx, data)."""

    def __init__(self, options: dict):
        self.options, self.job = options, uuid.uuid4().hex
        self.folder = located(options["path"])[1]
        os.makedirs(self.folder, exist_ok=True)

    def _open_name(self, name: str) -> str:
        return os.path.join(self.folder, f".{name}.{self.job}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        o, done, files = self.options, Written(), {}
        x, y, unit = o["resolution"].split(",") if "resolution" in o else (0, 0, 0)
        resolution = (float(x), float(y), int(unit)) if unit else None
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    name = row["file"]
                    if name not in files:
                        os.makedirs(self.folder, exist_ok=True)
                        files[name] = os.open(self._open_name(name), os.O_WRONLY | os.O_CREAT, 0o644)
                    text = o["description"] if row["first"] else ""
                    head = directory(row["at"], row["after"], (row["ny"], row["nx"]), np.dtype(o["kind"]), len(row["data"]), o["compression"], o["predictor"] == "true", text, resolution)
                    record = memoryview(head + row["data"])
                    while record:
                        n = os.pwrite(files[name], record, row["at"] + len(head) + len(row["data"]) - len(record))
                        record = record[n:]
                    done.pages[name] = done.pages.get(name, 0) + 1
        finally:
            for f in files.values():
                os.fsync(f)
                os.close(f)
        return done

    def commit(self, messages: list[Written | None]) -> None:
        got: dict[str, int] = {}
        for m in filter(None, messages):
            for name, n in m.pages.items():
                got[name] = got.get(name, 0) + n
        short = {name: n for name, n in got.items() if n != int(self.options["pages"])}
        if short:
            self.abort(messages)
            raise ValueError(f"files lack pages, {self.options['pages']} were due: {short}")
        for name in got:
            f = os.open(self._open_name(name), os.O_WRONLY)
            os.pwrite(f, HEADER, 0)
            os.fsync(f)
            os.close(f)
        for name in got:
            os.replace(self._open_name(name), os.path.join(self.folder, name))

    def abort(self, messages: list[Written | None]) -> None:
        for name in os.listdir(self.folder):
            if name.endswith(self.job):
                os.unlink(os.path.join(self.folder, name))


class TiffSource(DataSource):
    """Format "tiff". Options: path; columns, a list with commas; partbytes; what = "pixels" or "tags"."""

    @classmethod
    def name(cls) -> str:
        return "tiff"

    def _columns(self) -> list[str]:
        return [c.strip() for c in self.options.get("columns", ",".join(COLUMNS)).split(",")]

    def schema(self) -> str:
        return TAGS if self.options.get("what") == "tags" else ", ".join(f"{c} {COLUMNS[c][0]}" for c in self._columns())

    def reader(self, schema: StructType) -> DataSourceReader:
        return TagReader(self.options, []) if self.options.get("what") == "tags" else TiffReader(self.options, self._columns())

    def writer(self, schema: StructType, overwrite: bool) -> TiffWriter:
        return TiffWriter(self.options)


def register(spark: SparkSession, source: type[DataSource] = TiffSource) -> None:
    """Make a source known to a session, with its filters: Spark hands filters to Python sources only where the session says so."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(source)


def scan_tiff(spark: SparkSession, path: str, columns: tuple[str, ...] = ("path", "page", "y", "x", "value"), part_bytes: int = PART_BYTES) -> DataFrame:
    """Pixels of all pages of the files at a path, in a folder or under a pattern. t and z follow from the numbers of frames and slices in the description; one time point where they don't fit the pages."""
    register(spark)
    return spark.read.format("tiff").option("columns", ",".join(columns)).option("partbytes", part_bytes).load(path)


def scan_tiff_tags(spark: SparkSession, path: str) -> DataFrame:
    """(path, pages, description, x_resolution, y_resolution, resolution_unit, height, width) of each file: pixels a unit, and the unit's code."""
    register(spark)
    return spark.read.format("tiff").option("what", "tags").load(path)


# --- writing -----------------------------------------------------------------------------------------------------

TYPES = {"uint8": "u1", "uint16": "u2", "int16": "i2", "uint32": "u4", "int32": "i4", "float32": "f4", "float64": "f8"}


def planes(voxels: DataFrame, shape: tuple[int, int], kind: str = "uint16", compression: str = "zlib", predictor: bool = False) -> DataFrame:
    """(t, z, data): a row a plane, encoded; a task holds a plane. Voxels that are not there are zero. voxels: (t, z, y, x, value)."""
    ny, nx = shape

    def encode(key: tuple, rows: pa.Table) -> pa.Table:
        page = np.zeros(shape, TYPES[kind])
        page[rows["y"].to_numpy(), rows["x"].to_numpy()] = rows["value"].to_numpy()
        return pa.table({"t": pa.array([key[0].as_py()], pa.int32()), "z": pa.array([key[1].as_py()], pa.int32()), "data": pa.array([packed_page(page, compression, predictor)], pa.binary())})

    rows = voxels.select(F.col("t").cast("int").alias("t"), F.col("z").cast("int").alias("z"), "y", "x", "value")
    return rows.groupBy("t", "z").applyInArrow(encode, "t int, z int, data binary")


def with_offsets(pages: DataFrame, layout: str, first_head: int, head: int) -> DataFrame:
    """pages (t, z, bytes, first, last) with at and after: the records of a file one behind the other, the first with a longer directory.

    In a stack sizes are summed inside a time point and then over time points, so no window holds more than a time point's slices
    or a row a time point.
    """
    whole = F.when(F.col("first"), first_head).otherwise(head) + F.col("bytes")
    inside = Window.partitionBy("t").orderBy("z")
    pages = pages.withColumn("_own", whole).withColumn("at", F.sum("_own").over(inside) - F.col("_own") + len(HEADER))
    if layout == "stack":
        sums = pages.groupBy("t").agg(F.sum("_own").alias("_sum"))
        sums = sums.select("t", (F.sum("_sum").over(Window.orderBy("t")) - F.col("_sum")).alias("_before"))  # a row a time point
        pages = pages.join(sums, "t").withColumn("at", F.col("at") + F.col("_before")).drop("_before")
    return pages.withColumn("after", F.when(F.col("last"), 0).otherwise(F.col("at") + F.col("_own"))).drop("_own")


def description(pages: int, slices: int, frames: int, voxel_um: tuple[float, float, float] | None) -> str:
    """The lines that readers of stacks take sizes from; voxel_um: z, y, x."""
    lines = ["ImageJ=1.11a", f"images={pages}", "channels=1", f"slices={slices}", f"frames={frames}", "hyperstack=true", f"axes={'TZYX' if frames > 1 else 'ZYX'}"]
    if voxel_um is not None:
        lines += [f"spacing={voxel_um[0]}", "unit=um", f"x_resolution_um={voxel_um[2]}", f"y_resolution_um={voxel_um[1]}"]
    return "\n".join(lines) + "\n"


def write_tiff(
    voxels: DataFrame, path: str, layout: str = "volumes", kind: str = "uint16", compression: str = "zlib", predictor: bool = False,
    voxel_um: tuple[float, float, float] | None = None, shape: tuple[int, int, int] | None = None, name: str = "t%04d_Channel 1.tif", stack_name: str = "hyperstack.tif", flip_y: bool = False,
    text: str | None = None, resolution: tuple[float, float, int] | None = None,
) -> None:
    """Voxels (t, z, y, x, value) as files with 64-bit offsets: a file a time point, or with layout "stack" one for all.

    shape: z, y, x of every time point; without it the largest places found. Slices that a time point lacks are zero. voxel_um: z, y, x.
    text and resolution (pixels a unit for x and y, the unit's code) are written in place of what voxel_um gives.
    """
    spark = voxels.sparkSession
    register(spark)
    ends = voxels.agg(*(F.max(a).alias(a) for a in "zyx"), F.min("t").alias("t0"), F.max("t").alias("t1"), F.count_distinct("t").alias("n")).first()
    if not ends["n"]:
        return
    nz, ny, nx = shape or tuple(ends[a] + 1 for a in "zyx")
    if flip_y:
        voxels = voxels.withColumn("y", F.lit(ny - 1) - F.col("y"))
    done, place = kept_table(planes(voxels, (ny, nx), kind, compression, predictor), "planes")
    dtype, stack = np.dtype(TYPES[kind]), layout == "stack"
    frames = ends["n"] if stack else 1
    text = description(nz * frames, nz, frames, voxel_um) if text is None else text
    if resolution is None and voxel_um is not None:
        resolution = (1 / voxel_um[2], 1 / voxel_um[1], 1)
    heads = [len(directory(0, 0, (ny, nx), dtype, 0, compression, predictor, t, resolution)) for t in (text, "")]
    blank = packed_page(np.zeros((ny, nx), dtype), compression, predictor)
    spine = done.select("t").distinct().withColumn("z", F.explode(F.sequence(F.lit(0), F.lit(nz - 1))))
    lengths = done.select("t", "z", F.octet_length("data").alias("_n"))
    first, last = F.col("z") == 0, F.col("z") == nz - 1
    if stack:
        first, last = first & (F.col("t") == ends["t0"]), last & (F.col("t") == ends["t1"])
    pages = spine.join(lengths, ["t", "z"], "left").select("t", "z", F.coalesce("_n", F.lit(len(blank))).alias("bytes"), first.alias("first"), last.alias("last"))
    file = F.lit(stack_name) if stack else F.format_string(name, "t")
    rows = with_offsets(pages, layout, *heads).join(done, ["t", "z"], "left")
    rows = rows.select(file.alias("file"), F.col("at").cast("long").alias("at"), F.col("after").cast("long").alias("after"), "first", F.lit(ny).alias("ny"), F.lit(nx).alias("nx"), F.coalesce("data", F.lit(blank)).alias("data"))
    writer = rows.write.format("tiff").mode("append").option("kind", dtype.str).option("compression", compression).option("predictor", str(predictor).lower()).option("description", text).option("pages", nz * frames)
    if resolution is not None:
        writer = writer.option("resolution", ",".join(map(str, resolution)))
    writer.save(path)
    dropped(spark, place)
