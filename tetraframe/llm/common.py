"""Shared pieces of the training-data operators: tables, the shared folder, byte-level hashing."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that a Python worker takes at a time of the batches that Spark hands it: documents are long.
BATCH_ROWS = 1_000
#: While a table is stored: Spark removes a query's shuffle files at its end, which otherwise stay until the driver happens to
#: collect garbage, and hands Python batches of few rows, since documents are long.
WHILE_STORED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, as Spark reads it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut into smaller ones, empty ones left out. After the last one the worker, which outlives its task, hands free memory back."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    hand_back()


def hand_back() -> None:
    """Free memory of this process goes back to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; only a local session without it gets one of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tetraframe-"))
        found = spark.sparkContext.getCheckpointDir()
    return found


def _path(spark: SparkSession, place: str):
    return spark._jvm.org.apache.hadoop.fs.Path(place)


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> tuple[DataFrame, str]:
    """Write df as a table in the shared folder and read it again, which cuts its lineage. Removed when the application ends.

    The session has its own settings again when the write is over.
    """
    spark = df.sparkSession
    place = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    before = {k: spark.conf.get(k, None) for k in WHILE_STORED}
    for k, v in WHILE_STORED.items():
        spark.conf.set(k, v)
    try:
        writer = df.write.option("compression", "zstd")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(place)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    path = _path(spark, place)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(place), place


def discard(spark: SparkSession, *places: str) -> None:
    """Remove tables that stored() wrote, once nothing reads them any more."""
    for place in places:
        path = _path(spark, place)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def set_apart(docs: DataFrame, *keep: str) -> tuple[DataFrame, Callable[..., list[Column]]]:
    """docs with every column but those in `keep` under a name of its own, and what gives docs' columns back under their names.

    Columns are taken by place, so names that clash with an operator's own, or differ in case alone, do no harm. The second
    result is called with names to leave out, columns that the operator gives anew.
    """
    names = docs.columns
    inner = [n if n in keep and n not in names[:i] else f"carried_{i}" for i, n in enumerate(names)]
    return docs.toDF(*inner), lambda *out: [F.col(i).alias(n) for i, n in zip(inner, names) if n not in out]


def copies_apart(rows: DataFrame, key: str, weight: Column, most: float) -> tuple[DataFrame, str]:
    """rows with _copy, and a stored place: 0, or the row's place in the input where rows of its key weigh more than `most` together.

    A hash of (key, _copy) then spreads a key's mass of rows while all others go by content alone. rows should be read, not
    computed: places hold as long as its files are read in the same way.
    """
    sums = rows.groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"), F.sum(weight).alias("_w"))
    hot, place = stored(sums.where((F.col("_n") > 1) & (F.col("_w") > most)).select("_hot"), "hot")
    placed = rows.withColumn("_place", F.monotonically_increasing_id()).join(hot, F.col(key) == F.col("_hot"), "left")
    return placed.withColumn("_copy", F.when(F.col("_hot").isNotNull(), F.col("_place")).otherwise(F.lit(0).cast("long"))).drop("_hot", "_place"), place


def content_key(df: DataFrame, seed: int) -> Column:
    """A seeded hash of all of a row's columns that can be hashed."""
    return F.xxhash64(F.lit(seed), *(F.col(f"`{f.name}`") for f in df.schema.fields if not _holds_map(f.dataType)))


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return _holds_map(kind.elementType) if isinstance(kind, T.ArrayType) else isinstance(kind, (T.MapType, T.VariantType))


def crc_mod(column: str, n: int) -> Column:
    """crc32 of a column's text, modulo n."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def planes(x: np.ndarray) -> bytes:
    """Numbers below 2^32, compressed byte by byte."""
    return zlib.compress(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def from_planes(raw: bytes) -> np.ndarray:
    """The numbers that planes() packed."""
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(raw), np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


# --- byte-level hashing in numpy -------------------------------------------------------------------------------

_R = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_R), -1, 1 << 64))
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of the hash base, or of its inverse, modulo 2**64."""
    key = "inv" if inverse else "pow"
    have = _POWERS.get(key)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, _INV if inverse else _R, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _POWERS[key] = have
    return have[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums of table[byte] * base**position before each position: the hash of any substring in two lookups."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the substrings [start, end)."""
    shifted = (prefix[end] - prefix[start]) * powers(len(prefix), True)[start]
    return mix(shifted + np.asarray(end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def chunks(texts: list[str | bytes | None], most: int = 1 << 20):
    """Cut a batch into runs of documents of about `most` bytes: (first, after last, bytes of all, offsets). Hashing a run takes some 60 times its bytes."""
    raw = [t if isinstance(t, bytes) else (t or "").encode("utf-8", "surrogatepass") for t in texts]
    first = size = 0
    for i, x in enumerate(raw):
        if size and size + len(x) > most:
            yield first, i, *_joined(raw[first:i])
            first, size = i, 0
        size += len(x)
    if first < len(raw):
        yield first, len(raw), *_joined(raw[first:])


def _joined(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each document, A-Z lower-cased, as 64-bit hashes: hashes in order, their number by document, their document."""
    low = _LOWER[data]
    n = len(low)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64), np.zeros(0, np.int64)
    space = _SPACE[low]
    first = ~space
    first[1:] &= space[:-1]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = ~space[begins]
    last = ~space
    last[:-1] &= space[1:]
    last[begins[1:] - 1] = ~space[begins[1:] - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = span_hash(prefix_hash(low), start, end)
    doc = np.searchsorted(offsets, start, "right") - 1
    return hashes, np.bincount(doc, minlength=len(offsets) - 1), doc
