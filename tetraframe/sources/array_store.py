"""Chunked array stores as a data source and a sink: formats 2 and 3, plain, gzip, zlib and zstd chunks.

Three layouts are read: one array of 4 axes (t, z, y, x); a group, or a folder without a group's metadata, whose children with whole
numbers for names are arrays of 3 axes, one a time point, in the order of those numbers.

Reading: filters on t, z, y and x are turned into ranges of chunks, so chunks outside are neither listed nor opened; a partition is a
share of the chunks that remain. A chunk that is not there holds the fill value. A task holds a chunk.

Writing: voxels meet by chunk, a task encodes a chunk at a time and writes it as a file of its own; the metadata that makes the folder
an array comes with the commit, last. The folder must be new, and a job that fails removes it.
"""

from __future__ import annotations

import gzip
import json
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, Filter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from tetraframe.sources.stores import Bounds, located
from tetraframe.sources.tiff_source import BATCH, register

AXES = ("t", "z", "y", "x")
#: Bytes of decoded chunks that a partition takes.
PART_BYTES = 64 << 20


def _zstd(raw: bytes, pack: bool) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor().compress(raw) if pack else zstandard.ZstdDecompressor().decompressobj().decompress(raw)


PACK = {"gzip": lambda raw: gzip.compress(raw, 5, mtime=0), "zlib": lambda raw: zlib.compress(raw, 5), "zstd": lambda raw: _zstd(raw, True), "none": lambda raw: raw}
UNPACK = {"gzip": gzip.decompress, "zlib": zlib.decompress, "zstd": lambda raw: _zstd(raw, False), "none": lambda raw: raw}


@dataclass(frozen=True)
class Array:
    """What the metadata of an array says."""

    path: str
    shape: tuple[int, ...]
    chunk: tuple[int, ...]
    kind: str
    codecs: tuple[str, ...]
    fill: float
    prefix: str
    separator: str

    def key(self, at: tuple[int, ...]) -> str:
        return self.prefix + self.separator.join(map(str, at))


def parsed(path: str, text: str) -> Array | None:
    """The array that metadata of either format describes; null for a group."""
    m = json.loads(text)
    if m["zarr_format"] == 2:
        if "shape" not in m:
            return None
        codec = (m.get("compressor") or {}).get("id")
        if m.get("filters") or m.get("order", "C") != "C" or codec not in (None, "gzip", "zlib", "zstd"):
            raise ValueError(f"{path}: filters, column order and compressor {codec} are not read")
        return Array(path, tuple(m["shape"]), tuple(m["chunks"]), np.dtype(m["dtype"]).str, (codec,) if codec else (), float(m.get("fill_value") or 0), "", m.get("dimension_separator", "."))
    if m["node_type"] != "array":
        return None
    grid, keys = m["chunk_grid"]["configuration"]["chunk_shape"], m.get("chunk_key_encoding", {"name": "default"})
    order, codecs = "<", []
    for c in m["codecs"]:
        if c["name"] == "bytes":
            order = ">" if c.get("configuration", {}).get("endian") == "big" else "<"
        elif c["name"] in ("gzip", "zstd"):
            codecs.insert(0, c["name"])
        else:
            raise ValueError(f"{path}: codec {c['name']} is not read")
    default = keys["name"] == "default"
    separator = keys.get("configuration", {}).get("separator", "/" if default else ".")
    return Array(path, tuple(m["shape"]), tuple(grid), np.dtype(m["data_type"]).newbyteorder(order).str, tuple(codecs), float(m.get("fill_value") or 0), "c" + separator if default else "", separator)


def _text(system: fs.FileSystem, path: str) -> str | None:
    for name in ("zarr.json", ".zarray"):
        if system.get_file_info(f"{path}/{name}").type == fs.FileType.File:
            with system.open_input_file(f"{path}/{name}") as f:
                return f.read().decode()
    return None


def found_arrays(address: str) -> list[tuple[int | None, Array]]:
    """(time point or null for an array that has its own axis, array) of a store, in order."""
    system, path = located(address.rstrip("/"))
    text = _text(system, path)
    whole = parsed(path, text) if text is not None else None
    if whole is not None:
        if len(whole.shape) != 4:
            raise ValueError(f"{address}: an array of {len(whole.shape)} axes, not of t, z, y, x")
        return [(None, whole)]
    names = sorted(int(i.base_name) for i in system.get_file_info(fs.FileSelector(path)) if i.type == fs.FileType.Directory and i.base_name.isdigit())
    if not names:
        raise ValueError(f"{address}: neither an array nor a folder of arrays with numbers for names")
    out = []
    for t, n in enumerate(names):
        a = parsed(f"{path}/{n}", _text(system, f"{path}/{n}") or "null")
        if a is None or len(a.shape) != 3:
            raise ValueError(f"{address}/{n}: not an array of z, y, x")
        out.append((t, a))
    return out


@dataclass
class Chunks(InputPartition):
    """Chunks first to last (exclusive) of a box of chunk places of one array; t: the time point of an array of 3 axes."""

    array: Array
    t: int | None
    low: tuple[int, ...]
    box: tuple[int, ...]
    first: int
    last: int


class ArrayReader(DataSourceReader):
    """Voxels of the chunks that filters leave."""

    def __init__(self, options: dict):
        self.path, self.part_bytes = options["path"], int(options.get("partbytes", PART_BYTES))
        self.bounds = Bounds(AXES)

    def pushFilters(self, filters: list[Filter]) -> list[Filter]:
        return self.bounds.take(filters)

    def partitions(self) -> list[Chunks]:
        out: list[InputPartition] = []
        for t, a in found_arrays(self.path):
            axes = AXES[-len(a.shape) :]
            if t is not None and not self.bounds(t=t):
                continue
            reached = [[k for k in range(-(-n // c)) if self.bounds.meets(axis, k * c, min((k + 1) * c, n) - 1)] for axis, n, c in zip(axes, a.shape, a.chunk)]
            if not all(reached):
                continue
            low, box = tuple(r[0] for r in reached), tuple(r[-1] - r[0] + 1 for r in reached)
            each = max(1, self.part_bytes // (math.prod(a.chunk) * np.dtype(a.kind).itemsize))
            count = math.prod(box)
            out += [Chunks(a, t, low, box, k, min(k + each, count)) for k in range(0, count, each)]
        return out or [InputPartition(None)]

    def read(self, partition: Chunks) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, Chunks):
            return
        a = partition.array
        system, _ = located(a.path)
        for k in range(partition.first, partition.last):
            at = tuple(int(i) + lo for i, lo in zip(np.unravel_index(k, partition.box), partition.low))
            first = [i * c for i, c in zip(at, a.chunk)]
            inside = [np.arange(f, min(f + c, n)) for f, c, n in zip(first, a.chunk, a.shape)]
            places = [p[[self.bounds(**{axis: int(v)}) for v in p]] for axis, p in zip(AXES[-len(at) :], inside)]
            if not all(map(len, places)):
                continue
            block = self._chunk(system, a, at)[np.ix_(*(p - f for p, f in zip(places, first)))]
            if len(places) == 3:
                places, block = [np.array([partition.t]), *places], block[None]
            yield from self._rows(block.reshape(-1, *block.shape[2:]), places)

    def _chunk(self, system: fs.FileSystem, a: Array, at: tuple[int, ...]) -> np.ndarray:
        name = f"{a.path}/{a.key(at)}"
        if system.get_file_info(name).type != fs.FileType.File:
            return np.full(a.chunk, a.fill, np.dtype(a.kind).newbyteorder("="))
        with system.open_input_file(name) as f:
            raw = f.read()
        for codec in a.codecs:
            raw = UNPACK[codec](raw)
        return np.frombuffer(raw, a.kind).reshape(a.chunk)

    def _rows(self, planes: np.ndarray, places: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """planes: (t and z, y, x)."""
        t, z = (v.ravel() for v in np.meshgrid(places[0], places[1], indexing="ij"))
        size = planes.shape[1] * planes.shape[2]
        step, kind = max(1, BATCH // size), np.float64 if planes.dtype.kind == "f" else np.int64
        y, x = (v.ravel().astype(np.int32) for v in np.meshgrid(places[2], places[3], indexing="ij"))
        for k in range(0, len(planes), step):
            n = len(planes[k : k + step])
            columns = [np.repeat(t[k : k + n], size).astype(np.int32), np.repeat(z[k : k + n], size).astype(np.int32), np.tile(y, n), np.tile(x, n), planes[k : k + n].ravel().astype(kind)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [*AXES, "value"])


class ArrayWriter(DataSourceArrowWriter):
    """Chunks as files: rows (name, data); the files of the option "metadata" come last."""

    def __init__(self, options: dict):
        self.metadata = json.loads(options["metadata"])
        self.system, self.folder = located(options["path"].rstrip("/"))
        if self.system.get_file_info(self.folder).type != fs.FileType.NotFound:
            raise ValueError(f"{options['path']} is there already")

    def _put(self, name: str, data: bytes) -> None:
        self.system.create_dir(f"{self.folder}/{name}".rpartition("/")[0], recursive=True)
        with self.system.open_output_stream(f"{self.folder}/{name}") as f:
            f.write(data)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        for batch in iterator:
            for name, data in zip(batch.column("name").to_pylist(), batch.column("data")):
                self._put(name, data.as_py())
        return WriterCommitMessage()

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        for name, text in self.metadata.items():
            self._put(name, text.encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        if self.system.get_file_info(self.folder).type == fs.FileType.Directory:
            self.system.delete_dir(self.folder)


class ArrayStore(DataSource):
    """Format "arraystore". Options: path; partbytes; to write: metadata."""

    @classmethod
    def name(cls) -> str:
        return "arraystore"

    def schema(self) -> str:
        floating = np.dtype(found_arrays(self.options["path"])[0][1].kind).kind == "f"
        return f"t int, z int, y int, x int, value {'double' if floating else 'long'}"

    def reader(self, schema: StructType) -> ArrayReader:
        return ArrayReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> ArrayWriter:
        return ArrayWriter(self.options)


def scan_array_store(spark: SparkSession, path: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """(t, z, y, x, value) of a chunked array store; value is a double for arrays of floating numbers, else a long."""
    register(spark, ArrayStore)
    return spark.read.format("arraystore").option("partbytes", part_bytes).load(path)


# --- writing -----------------------------------------------------------------------------------------------------


def metadata(shape: tuple[int, ...], chunk: tuple[int, ...], kind: str = "uint16", codec: str = "zstd", form: int = 3) -> tuple[str, str]:
    """Name and text of the metadata file of an array."""
    if form == 2:
        compressor = None if codec == "none" else {"id": codec, "level": 5}
        return ".zarray", json.dumps({"zarr_format": 2, "shape": shape, "chunks": chunk, "dtype": np.dtype(kind).newbyteorder("<").str, "compressor": compressor, "fill_value": 0, "order": "C", "filters": None, "dimension_separator": "."})
    packed = {"gzip": [{"name": "gzip", "configuration": {"level": 5}}], "zstd": [{"name": "zstd", "configuration": {"level": 3, "checksum": False}}], "none": []}[codec]
    return "zarr.json", json.dumps({
        "zarr_format": 3, "node_type": "array", "shape": shape, "data_type": kind, "chunk_grid": {"name": "regular", "configuration": {"chunk_shape": chunk}},
        "chunk_key_encoding": {"name": "default", "configuration": {"separator": "/"}}, "fill_value": 0, "codecs": [{"name": "bytes", "configuration": {"endian": "little"}}, *packed],
    })


def chunk_files(voxels: DataFrame, chunk: tuple[int, ...], kind: str, codec: str, form: int) -> DataFrame:
    """(name, data): a row a chunk that holds something but zeros. voxels: (array, axes of the array, value); array: its folder with a slash, or empty."""
    axes = AXES[-len(chunk) :]
    key = "c/" + "/".join(["%d"] * len(chunk)) if form == 3 else ".".join(["%d"] * len(chunk))

    def encode(keys: tuple, rows: pa.Table) -> pa.Table:
        array, *at = (k.as_py() for k in keys)
        block = np.zeros(chunk, np.dtype(kind).newbyteorder("<"))
        block[tuple(rows[a].to_numpy() - i * c for a, i, c in zip(axes, at, chunk))] = rows["value"].to_numpy()
        return pa.table({"name": pa.array([array + key % tuple(at)], pa.string()), "data": pa.array([PACK[codec](block.tobytes())], pa.binary())})

    places = [F.floor(F.col(a) / c).cast("int").alias(f"_{a}") for a, c in zip(axes, chunk)]
    rows = voxels.where("value <> 0").select("array", *places, *axes, "value")
    return rows.groupBy("array", *(f"_{a}" for a in axes)).applyInArrow(encode, "name string, data binary")


def _save(files: DataFrame, path: str, texts: dict[str, str]) -> None:
    register(files.sparkSession, ArrayStore)
    files.write.format("arraystore").mode("append").option("metadata", json.dumps(texts)).save(path)


def write_array_store(voxels: DataFrame, path: str, layout: str = "array", chunk: tuple[int, int, int] = (16, 256, 256), kind: str = "uint16", codec: str = "zstd", form: int = 3, shape: tuple[int, int, int] | None = None) -> None:
    """Voxels (t, z, y, x, value), t from 0, as a new store in one of the three layouts; voxels that are not there are zero.

    shape: z, y, x; without it the largest places found. Chunks of an array of 4 axes hold one time point each.
    """
    ends = voxels.agg(*(F.max(a).alias(a) for a in AXES)).first()
    if ends["t"] is None:
        raise ValueError("no voxels to write")
    shape = shape or tuple(ends[a] + 1 for a in "zyx")
    if layout == "array":
        name, text = metadata((ends["t"] + 1, *shape), (1, *chunk), kind, codec, form)
        _save(chunk_files(voxels.withColumn("array", F.lit("")), (1, *chunk), kind, codec, form), path, {name: text})
        return
    name, text = metadata(shape, chunk, kind, codec, form)
    texts = {f"{t}/{name}": text for t in range(ends["t"] + 1)}
    if layout == "group":
        texts |= {"zarr.json": '{"zarr_format": 3, "node_type": "group"}'} if form == 3 else {".zgroup": '{"zarr_format": 2}'}
    _save(chunk_files(voxels.withColumn("array", F.concat(F.col("t").cast("string"), F.lit("/"))), chunk, kind, codec, form), path, texts)


def write_pyramid(voxels: DataFrame, path: str, factors: tuple[int, ...] = (1, 2, 4), chunk: tuple[int, int, int] = (16, 256, 256), kind: str = "uint16", codec: str = "zstd", voxel_um: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> None:
    """Levels 0, 1, .. of a new group: an array of 4 axes each, of every factor-th voxel, and an index of the levels with their sizes.

    All levels are written by one job: a voxel is read once and goes to the levels that hold it.
    """
    ends = voxels.agg(*(F.max(a).alias(a) for a in AXES)).first()
    if ends["t"] is None:
        raise ValueError("no voxels to write")
    texts, shape = {}, [ends[a] + 1 for a in "zyx"]
    for level, f in enumerate(factors):
        name, text = metadata((ends["t"] + 1, *(-(-n // f) for n in shape)), (1, *chunk), kind, codec)
        texts[f"{level}/{name}"] = text
    scales = [{"path": str(level), "coordinateTransformations": [{"type": "scale", "scale": [1.0, *(v * f for v in voxel_um)]}]} for level, f in enumerate(factors)]
    index = {"version": "0.5", "multiscales": [{"axes": [{"name": "t", "type": "time"}, *({"name": a, "type": "space", "unit": "micrometer"} for a in "zyx")], "datasets": scales}]}
    texts["zarr.json"] = json.dumps({"zarr_format": 3, "node_type": "group", "attributes": {"ome": index}})
    holds = [F.when(F.expr(" AND ".join(f"{a} % {f} = 0" for a in "zyx")), F.struct(F.lit(level).alias("level"), F.lit(f).alias("f"))) for level, f in enumerate(factors)]
    rows = voxels.select(*AXES, "value", F.explode(F.array_compact(F.array(*holds))).alias("_l"))
    rows = rows.select(F.concat(F.col("_l.level").cast("string"), F.lit("/")).alias("array"), "t", *(F.expr(f"int({a} div _l.f)").alias(a) for a in "zyx"), "value")
    _save(chunk_files(rows, (1, *chunk), kind, codec, 3), path, texts)
