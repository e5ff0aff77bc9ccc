"""Containers of image data (HDF5) as a data source and a sink.

Three layouts are read. "imaris": a dataset a time point and channel under the full resolution level; time points, and channels of the
first of them, in the order of the numbers in their names. "flat": one array of 5 axes (t, c, z, y, x), or 4 without t, whose first
axis is at most 32. "levels": what write_viewer_levels() writes, one level of it. Groups and headers are read to plan; a partition is a share of the chunks of one time point and channel, and filters
on t, c, z, y and x leave out datasets and chunks. A task holds a chunk.

Writing: chunks are encoded in parallel, their places come from sums of their sizes, tasks write them into one unfinished file, and
the commit adds what the format needs to find them. The index of chunks, some 60 bytes each, goes through the driver.
"""

from __future__ import annotations

import json
import os
import re
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
from tetraframe.sources.hdf5 import START, Container, Dataset, Node, closing, packed_block
from tetraframe.sources.stores import Bounds, listed, located, opened
from tetraframe.sources.tiff_source import BATCH, register

SUFFIXES = (".ims", ".h5", ".hdf5")
#: Names of a plain array, in the order in which they are looked for, and the longest first axis of one; fixed values.
PLAIN, LONGEST = ("DataSet/ImageData", "Data", "data", "image"), 32
PART_BYTES = 64 << 20


def _number(name: str) -> int:
    return int("".join(c for c in name if c.isdigit()) or 0)


def _named(names: dict[str, int], *starts: str) -> list[str]:
    return sorted((n for n in names if n.lower().startswith(starts)), key=lambda n: (_number(n), n))


def images(c: Container, level: int = 0) -> tuple[str, list[tuple[int, int, str]]]:
    """The layout of a container and its (time point, channel, dataset); for "flat" the one dataset stands for every pair. level: of "levels"."""
    top = c.find("DataSet")
    groups = c.children(top) if top is not None else {}
    levels = [g for g in ("ResolutionLevel 0", *sorted(groups)) if g in groups and g.startswith(("ResolutionLevel", "Resolution Level"))]
    for name in dict.fromkeys(levels):
        points = c.children(groups[name])
        t_names = _named(points, "timepoint", "time point", "t")
        if t_names:
            channels = _named(c.children(points[t_names[0]]), "channel", "c")
            return "imaris", [(t, k, f"DataSet/{name}/{tn}/{cn}/Data") for t, tn in enumerate(t_names) for k, cn in enumerate(channels)]
    for name in () if levels else PLAIN:
        at = c.find(name)
        d = c.dataset(at) if at is not None else None
        if d is not None:
            if d.shape[0] > LONGEST or len(d.shape) not in (4, 5):
                raise ValueError(f"a plain array of shape {d.shape}: 4 or 5 axes, the first at most {LONGEST}, are read")
            times, channels = d.shape[:2] if len(d.shape) == 5 else (1, d.shape[0])
            return "flat", [(t, k, name) for t in range(times) for k in range(channels)]
    points = [n for n in c.children(c.root) if re.fullmatch(r"t\d{5}", n)]
    if points:
        setups = sorted(n for n in c.children(c.find(min(points))) if re.fullmatch(r"s\d{2}", n))
        return "levels", [(int(t[1:]), k, f"{t}/{s}/{level}/cells") for t in sorted(points) for k, s in enumerate(setups)]
    raise ValueError("no image data of a known layout in the container")


@dataclass
class Part(InputPartition):
    """The k-th of `of` shares of the chunks of one time point and channel."""

    path: str
    dataset: str
    flat: bool
    t: int
    c: int
    k: int
    of: int


class ContainerReader(DataSourceReader):
    """Voxels of the time points, channels and chunks that filters leave."""

    def __init__(self, options: dict):
        self.path, self.part_bytes = options["path"], int(options.get("partbytes", PART_BYTES))
        self.level = int(options.get("level", 0))
        self.bounds = Bounds(("t", "c", "z", "y", "x"))

    def pushFilters(self, filters: list[Filter]) -> list[Filter]:
        return self.bounds.take(filters)

    def partitions(self) -> list[Part]:
        out: list[InputPartition] = []
        for path, _ in listed(self.path, SUFFIXES):
            with opened(path) as f:
                c = Container(f)
                layout, found = images(c, self.level)
                size = None
                for t, k, name in found:
                    if not self.bounds(t=t, c=k):
                        continue
                    if size is None:
                        d = c.dataset(c.find(name))
                        size = int(np.prod(d.shape[-3:])) * d.kind.itemsize
                    of = max(1, -(-size // self.part_bytes))
                    out += [Part(path, name, layout == "flat", t, k, i, of) for i in range(of)]
        return out or [InputPartition(None)]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, Part):
            return
        with opened(partition.path) as f:
            c = Container(f)
            at = c.find(partition.dataset)
            d = c.dataset(at) if at is not None else None
            if d is None or len(d.shape) < 3:
                raise ValueError(f"{partition.path}: no image data under {partition.dataset}")
            # Where the volume stands among the axes in front of z, y, x: those of a time point's own dataset have one place each.
            lead = ((partition.t, partition.c) if len(d.shape) == 5 else (partition.c,)) if partition.flat else (0,) * (len(d.shape) - 3)
            chunk = d.chunk or (*(1,) * len(lead), 1, *d.shape[-2:])
            grid = [-(-n // k) for n, k in zip(d.shape[-3:], chunk[-3:])]
            n = int(np.prod(grid))
            for i in range(n * partition.k // partition.of, n * (partition.k + 1) // partition.of):
                first = [int(v) * k for v, k in zip(np.unravel_index(i, grid), chunk[-3:])]
                inside = [np.arange(a, min(a + k, m)) for a, k, m in zip(first, chunk[-3:], d.shape[-3:])]
                places = [p[[self.bounds(**{axis: int(v)}) for v in p]] for axis, p in zip("zyx", inside)]
                if all(map(len, places)):
                    block = self._block(c, d, lead, tuple(first), chunk)
                    yield from self._rows(partition, block[np.ix_(*(p - a for p, a in zip(places, first)))], places)

    def _block(self, c: Container, d: Dataset, lead: tuple[int, ...], first: tuple[int, ...], chunk: tuple[int, ...]) -> np.ndarray:
        if d.inline is not None:
            return c.whole(d)[lead][first[0] : first[0] + 1]
        if d.chunk is None:
            line = int(np.ravel_multi_index((*lead, first[0]), d.shape[:-2]))
            size = int(np.prod(d.shape[-2:])) * d.kind.itemsize
            return np.frombuffer(c._read(d.at + line * size, size), d.kind).reshape(1, *d.shape[-2:])
        offsets = (*(v // k * k for v, k in zip(lead, chunk)), *first)
        for _, place, size, mask in c.chunks(d, offsets, offsets):
            return c.block(d, place, size, mask)[tuple(v % k for v, k in zip(lead, chunk))]
        return np.zeros(chunk[-3:], d.kind)

    def _rows(self, p: Part, block: np.ndarray, places: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        size = block.shape[1] * block.shape[2]
        step = max(1, BATCH // size)
        y, x = (v.ravel().astype(np.int32) for v in np.meshgrid(places[1], places[2], indexing="ij"))
        for k in range(0, len(block), step):
            z = places[0][k : k + step]
            n = len(z) * size
            same = [pa.repeat(pa.scalar(v, kind), n) for v, kind in ((p.path, pa.string()), (p.t, pa.int32()), (p.c, pa.int32()))]
            own = [np.repeat(z, size).astype(np.int32), np.tile(y, len(z)), np.tile(x, len(z)), block[k : k + step].ravel().astype(np.float64)]
            yield pa.RecordBatch.from_arrays([*same, *map(pa.array, own)], ["path", "t", "c", "z", "y", "x", "value"])


class ListingReader(DataSourceReader):
    """What is in the containers: datasets with their shapes, or the texts that hold sizes of voxels. A partition a file."""

    def __init__(self, options: dict, info: bool):
        self.path, self.info = options["path"], info

    def partitions(self) -> list[Part]:
        return [Part(path, "", False, 0, 0, 0, 1) for path, _ in listed(self.path, SUFFIXES)]

    def read(self, partition: Part) -> Iterator[tuple]:
        with opened(partition.path) as f:
            c = Container(f)
            if not self.info:
                for name, d in c.datasets():
                    yield partition.path, name, [int(n) for n in d.shape]
                return
            yield partition.path, _size_text(c)


def _size_text(c: Container) -> str | None:
    """The text about voxel sizes: a description in the container, else its attributes as JSON."""
    for name in ("DatasetInfoXml", "ImageInfoXml"):
        at = c.find(f"DataSet/Info/{name}")
        d = c.dataset(at) if at is not None else None
        if d is not None:
            return c.whole(d).tobytes().decode("utf-8", "replace").rstrip("\0")
    plain = lambda v: v.tobytes().rstrip(b"\0").decode("utf-8", "replace") if v.dtype.kind == "S" else v.tolist()
    notes = {k: plain(v) for k, v in c.attributes(c.root).items()}
    if isinstance(notes.get("voxel_size_um"), str):
        sizes = json.loads(notes["voxel_size_um"])
        return json.dumps({f"{a}_um": sizes.get(a) for a in "xyz"})
    found = notes.get("physical_pixel_sizes")
    return json.dumps(dict(zip(("z_um", "y_um", "x_um"), found))) if isinstance(found, list) and len(found) == 3 else None


@dataclass
class Placed(WriterCommitMessage):
    """Chunks a task has written: (dataset, offsets, place, bytes)."""

    chunks: list[tuple[str, tuple[int, ...], int, int]] = field(default_factory=list)


class ContainerWriter(DataSourceArrowWriter):
    """Chunks at their places: rows (dataset, offsets, at, data)."""

    def __init__(self, options: dict):
        self.options = options
        self.path = located(options["path"])[1]
        self.open_path = f"{os.path.dirname(self.path)}/.{os.path.basename(self.path)}.{uuid.uuid4().hex}"
        os.makedirs(os.path.dirname(self.path), exist_ok=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Placed:
        done, f = Placed(), os.open(self.open_path, os.O_WRONLY | os.O_CREAT, 0o644)
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    data, at = memoryview(row["data"]), row["at"]
                    done.chunks.append((row["dataset"], tuple(row["offsets"]), at, len(data)))
                    while data:
                        n = os.pwrite(f, data, at)
                        data, at = data[n:], at + n
            os.fsync(f)
        finally:
            os.close(f)
        return done

    def commit(self, messages: list[Placed | None]) -> None:
        chunks = [c for m in messages if m for c in m.chunks]
        if len(chunks) != int(self.options["chunks"]):
            self.abort(messages)
            raise ValueError(f"{len(chunks)} of {self.options['chunks']} chunks have come")
        root = Node()
        for name, d in json.loads(self.options["datasets"]).items():
            node = root.at(name)
            node.shape, node.kind, node.chunk = tuple(d["shape"]), np.dtype(d["kind"]), d["chunk"] and tuple(d["chunk"])
            node.data = bytes.fromhex(d.get("data", ""))
        for name, text in json.loads(self.options["attributes"]).items():
            root.attributes[name] = text if isinstance(text, str) else np.array(text, float)
        for name, offsets, at, size in chunks:
            root.at(name).index.append((offsets, at, size))
        end = -(-max([START, *(at + size for _, _, at, size in chunks)]) // 8) * 8
        head, tail = closing(root, end)
        f = os.open(self.open_path, os.O_WRONLY | os.O_CREAT, 0o644)
        os.pwrite(f, tail, end)
        os.pwrite(f, head, 0)
        os.fsync(f)
        os.close(f)
        os.replace(self.open_path, self.path)

    def abort(self, messages: list[Placed | None]) -> None:
        if os.path.exists(self.open_path):
            os.unlink(self.open_path)


class ContainerSource(DataSource):
    """Format "container". Options: path; partbytes; level; what = "voxels", "datasets" or "info"."""

    @classmethod
    def name(cls) -> str:
        return "container"

    def schema(self) -> str:
        return {"datasets": "file string, dataset string, shape array<int>", "info": "file string, meta string"}.get(self.options.get("what", ""), "path string, t int, c int, z int, y int, x int, value double")

    def reader(self, schema: StructType) -> DataSourceReader:
        what = self.options.get("what", "voxels")
        return ContainerReader(self.options) if what == "voxels" else ListingReader(self.options, what == "info")

    def writer(self, schema: StructType, overwrite: bool) -> ContainerWriter:
        return ContainerWriter(self.options)


def scan_container(spark: SparkSession, path: str, level: int = 0, part_bytes: int = PART_BYTES) -> DataFrame:
    """(path, t, c, z, y, x, value) of the containers at a path: all time points and channels, of the full resolution unless a level is named."""
    register(spark, ContainerSource)
    return spark.read.format("container").option("partbytes", part_bytes).option("level", level).load(path)


def container_listing(spark: SparkSession, path: str, what: str = "datasets") -> DataFrame:
    """(file, dataset, shape) of every dataset in the containers at a path; or with "info" (file, meta), the text about voxel sizes."""
    register(spark, ContainerSource)
    return spark.read.format("container").option("what", what).load(path)


# --- writing -----------------------------------------------------------------------------------------------------


def write_container(voxels: DataFrame, path: str, shapes: dict[str, tuple[int, ...]], axes: tuple[str, ...], chunk: tuple[int, ...], kind: str = "uint16", plain: dict[str, np.ndarray] | None = None, attributes: dict[str, str | list[float]] | None = None) -> None:
    """Voxels (dataset, axes, value) as one container. shapes: of every dataset, along `axes`; plain: small datasets beside them.

    Chunks that hold zeros only are not stored.
    """
    spark = voxels.sparkSession
    register(spark, ContainerSource)

    def encode(keys: tuple, rows: pa.Table) -> pa.Table:
        name, *at = (k.as_py() for k in keys)
        offsets = [i * c for i, c in zip(at, chunk)]
        block = np.zeros(chunk, np.dtype(kind).newbyteorder("<"))
        block[tuple(rows[a].to_numpy() - o for a, o in zip(axes, offsets))] = rows["value"].to_numpy()
        return pa.table({"dataset": pa.array([name], pa.string()), "offsets": pa.array([offsets], pa.list_(pa.int64())), "data": pa.array([packed_block(block)], pa.binary())})

    places = [F.floor(F.col(a) / c).cast("int").alias(f"_{a}") for a, c in zip(axes, chunk)]
    rows = voxels.where("value <> 0").select("dataset", *places, *axes, "value").groupBy("dataset", *(f"_{a}" for a in axes))
    done, place = kept_table(rows.applyInArrow(encode, "dataset string, offsets array<bigint>, data binary"), "chunks")
    sizes = done.select("dataset", "offsets", F.octet_length("data").cast("long").alias("_n"))
    inside = Window.partitionBy("dataset").orderBy("offsets")
    sums = sizes.groupBy("dataset").agg(F.sum("_n").alias("_all"))
    before = sums.select("dataset", (F.sum("_all").over(Window.orderBy("dataset")) - F.col("_all")).alias("_before"))  # a row a dataset
    at = sizes.withColumn("_in", F.sum("_n").over(inside) - F.col("_n")).join(before, "dataset").select("dataset", "offsets", (F.col("_before") + F.col("_in") + START).alias("at"))
    numpy_kind = np.dtype(kind).newbyteorder("<").str
    datasets = {name: {"shape": shape, "kind": numpy_kind, "chunk": chunk} for name, shape in shapes.items()}
    datasets |= {name: {"shape": a.shape, "kind": a.dtype.str, "chunk": None, "data": a.tobytes().hex()} for name, a in (plain or {}).items()}
    writer = done.join(at, ["dataset", "offsets"]).select("dataset", "offsets", "at", "data").write.format("container").mode("append")
    writer.option("chunks", done.count()).option("datasets", json.dumps(datasets)).option("attributes", json.dumps(attributes or {})).save(path)
    dropped(spark, place)


def write_imaris(voxels: DataFrame, path: str, chunk: tuple[int, int, int] = (8, 256, 256), kind: str = "uint16", info: str = "") -> None:
    """Voxels (t, c, z, y, x, value) as a container with a dataset a time point and channel, of 5 axes; info: the text about sizes."""
    ends = voxels.agg(*(F.max(a).alias(a) for a in "tczyx")).first()
    name = "DataSet/ResolutionLevel 0/TimePoint %d/Channel %d/Data"
    shape = (1, 1, *(ends[a] + 1 for a in "zyx"))
    shapes = {name % (t, c): shape for t in range(ends["t"] + 1) for c in range(ends["c"] + 1)}
    rows = voxels.select(F.format_string(name, "t", "c").alias("dataset"), F.lit(0).alias("_i"), F.lit(0).alias("_j"), "z", "y", "x", "value")
    text = np.frombuffer(info.encode(), np.uint8)
    write_container(rows, path, shapes, ("_i", "_j", "z", "y", "x"), (1, 1, *chunk), kind, {"DataSet/Info/DatasetInfoXml": text} if info else None)


def write_flat(voxels: DataFrame, path: str, name: str = "Data", chunk: tuple[int, int, int] = (8, 256, 256), kind: str = "uint16", attributes: dict[str, str | list[float]] | None = None) -> None:
    """Voxels (t, c, z, y, x, value) as one array of 5 axes."""
    ends = voxels.agg(*(F.max(a).alias(a) for a in "tczyx")).first()
    shape = tuple(ends[a] + 1 for a in "tczyx")
    write_container(voxels.withColumn("dataset", F.lit(name)), path, {name: shape}, tuple("tczyx"), (1, 1, *chunk), kind, attributes=attributes)


def write_viewer_levels(voxels: DataFrame, path: str, factors: tuple[int, ...] = (1, 2, 4), chunk: tuple[int, int, int] = (16, 64, 64), kind: str = "uint16") -> None:
    """Voxels (t, z, y, x, value) as levels of resolution in one container, t00000/s00/<level>/cells, with the tables of factors and chunks that viewers look for, x first."""
    ends = voxels.agg(*(F.max(a).alias(a) for a in "tzyx")).first()
    shapes = {f"t{t:05d}/s00/{k}/cells": tuple(-(-(ends[a] + 1) // f) for a in "zyx") for t in range(ends["t"] + 1) for k, f in enumerate(factors)}
    holds = [F.when(F.expr(" AND ".join(f"{a} % {f} = 0" for a in "zyx")), F.struct(F.lit(k).alias("k"), F.lit(f).alias("f"))) for k, f in enumerate(factors)]
    rows = voxels.select("t", "z", "y", "x", "value", F.explode(F.array_compact(F.array(*holds))).alias("_l"))
    rows = rows.select(F.format_string("t%05d/s00/%d/cells", "t", "_l.k").alias("dataset"), *(F.expr(f"int({a} div _l.f)").alias(a) for a in "zyx"), "value")
    plain = {"s00/resolutions": np.array([[f] * 3 for f in factors], np.float64), "s00/subdivisions": np.array([chunk[::-1]] * len(factors), np.int32)}
    write_container(rows, path, shapes, ("z", "y", "x"), chunk, kind, plain)
