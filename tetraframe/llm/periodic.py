"""Periodic runs of words inside a document, by bit-parallel lags.

A document's words become numbers, and the numbers' bits become planes: big integers with a bit a word. Against a plane shifted by
a lag the exclusive or marks words that differ there; the or over the planes marks every word that differs from the one a lag
later. Zeros are equal words, and doubling shifts with and leave a bit only where a stretch of zeros is long enough. A run's stretch
at its period is maximal, so its ends are the run's.

Which lags are tried: a run of period q has its next 2q places equal at lag q, so a gram of G words, q <= G <= 2q, comes again
exactly q words later and, since q is the smallest period, not sooner. Grams of doubled length are told apart exactly, by pairs of
the numbers of their halves; the distances between a gram's neighbouring occurrences are the lags that can hold a run. All
other lags hold none, so nothing is missed, and a long text costs n log n and not its square.

Defined cases: null and empty texts have no words, no runs, and the digests of nothing; words are equal if their bytes are;
a stretch that has a smaller period is reported once, by the smallest; runs may overlap, and a word goes if any run covers it after
that run's first period; repeated rows each give a row; columns that the input has stay, in front, and those of the result must
be named apart by `prefix`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tetraframe.llm.common import slices, stored, table

#: A run has at least so many words and at least so many periods.
LEAST, PERIODS = 24, 3
#: The shortest grams compared, at most LEAST - LEAST // PERIODS.
GRAM = 16

Run = tuple[int, int, int]  # start, length, period


def numbers(words: list[bytes]) -> np.ndarray:
    """The words as numbers from 0, equal words alike."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def lags(ids: np.ndarray) -> list[int]:
    """Ascending lags that may be the smallest period of a run."""
    n, found, size = len(ids), [], 1
    if n < LEAST:
        return found
    # `at`: places whose gram of `size` words comes more than once, `kind`: which gram; all other places have no part in what follows.
    at, kind = _repeated(np.arange(n), ids)
    while len(at) and (size < GRAM or PERIODS * (size + 1) <= n):
        halves = np.full(n, -1, np.int64)
        halves[at] = kind
        at = at[at + 2 * size <= n]
        first, second = halves[at], halves[at + size]
        both = second >= 0
        at, size = at[both], 2 * size
        at, kind = _repeated(at, first[both] * (n + 1) + second[both])
        if size < GRAM or not len(at):
            continue
        order = np.lexsort((at, kind))
        near = np.diff(at[order])[np.diff(kind[order]) == 0]
        near = near[(near <= size) & ((near > size // 2) | (size == GRAM)) & (PERIODS * near <= n)]
        lag, times = np.unique(near, return_counts=True)
        stretch = np.maximum(LEAST, PERIODS * lag) - lag
        found += lag[times > stretch - size].tolist()
    return found


def _repeated(at: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places whose key comes more than once, and their keys as small numbers."""
    _, kind, times = np.unique(key, return_inverse=True, return_counts=True)
    more = times[kind] > 1
    return at[more], kind[more]


def bit_planes(ids: np.ndarray) -> list[int]:
    """One integer for each bit of the numbers; bit i of it belongs to word i."""
    top = int(ids.max()).bit_length() if len(ids) else 0
    return [int.from_bytes(np.packbits((ids >> b & 1).astype(np.uint8), bitorder="little").tobytes(), "little") for b in range(max(top, 1))]


def stretches(planes: list[int], n: int, lag: int) -> np.ndarray:
    """Starts and ends (exclusive) of maximal stretches of words that equal the one a lag later, long enough for a run of that period."""
    every = (1 << (n - lag)) - 1
    differ = 0
    for plane in planes:
        differ |= plane ^ (plane >> lag)
    alike, have, need = ~differ & every, 1, max(LEAST, PERIODS * lag) - lag
    while have < need and alike:
        step = min(have, need - have)
        alike &= alike >> step
        have += step
    if not alike:
        return np.zeros((0, 2), np.int64)
    bits = np.unpackbits(np.frombuffer(alike.to_bytes((n + 7) // 8, "little"), np.uint8), bitorder="little")
    edges = np.flatnonzero(np.diff(np.concatenate([[0], bits, [0]]).astype(np.int8))).reshape(-1, 2)
    return edges + [0, need - 1]


def runs_of(words: list[bytes]) -> list[Run]:
    """All runs by start, then period."""
    ids, n = numbers(words), len(words)
    found: dict[tuple[int, int], int] = {}
    tried = lags(ids)
    planes = bit_planes(ids) if tried else []
    for lag in tried:
        for start, end in stretches(planes, n, lag).tolist():
            # A stretch with a smaller period has one that divides the lag, and is the same stretch there.
            found.setdefault((start, end - start + lag), lag)
    return sorted((start, length, lag) for (start, length), lag in found.items())


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run covers after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, lag in runs:
        edge[start + lag] += 1
        edge[start + length] -= 1
    keep = np.cumsum(edge[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist()) if k]


def _steeper(a: Run, b: Run) -> int:
    return b[1] * a[2] - a[1] * b[2] or a[0] - b[0] or a[2] - b[2]


def strongest(runs: list[Run]) -> Run | None:
    """The run of most periods; of ties the first, then the shortest period."""
    return min(runs, key=cmp_to_key(_steeper)) if runs else None


RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def detected(docs: DataFrame, text: str = "text", prefix: str = "_", keep: list[str] | None = None) -> DataFrame:
    """docs with <prefix>runs, an array of (start, length, period), <prefix>best, the run of most periods or null, and <prefix>collapsed, the text without repetitions.

    keep: the columns of docs to give back, all unless named.
    """
    keep = docs.columns if keep is None else keep
    docs = docs.select(*(F.col(f"`{n}`") for n in keep), F.col(f"`{text}`").alias("the text"))
    names, at = keep, len(keep)
    added = [T.StructField(f"{prefix}runs", T.ArrayType(RUN)), T.StructField(f"{prefix}best", RUN), T.StructField(f"{prefix}collapsed", T.StringType())]
    if set(names) & {f.name for f in added}:
        raise ValueError(f"choose a prefix that keeps {[f.name for f in added]} apart from the columns {names}")
    kinds = [pa.list_(pa.struct([(c, pa.int64()) for c in RUN.names])), pa.struct([(c, pa.int64()) for c in RUN.names]), pa.string()]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        as_run = lambda x: dict(zip(RUN.names, x)) if x else None
        for batch in slices(batches):
            runs, best, rest = [], [], []
            for value in batch.column(at):
                words = (value.as_py() or "").encode().split()  # bytes.split() splits at the six ASCII spaces alone
                runs.append(runs_of(words))
                best.append(as_run(strongest(runs[-1])))
                rest.append(b" ".join(collapsed(words, runs[-1])).decode())
            columns = [pa.array([[as_run(r) for r in x] for x in runs], kinds[0]), pa.array(best, kinds[1]), pa.array(rest, kinds[2])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], *columns], [*names, *(f.name for f in added)])

    return docs.mapInArrow(found, T.StructType([*docs.schema.fields[:at], *added]))


def repeating(text: Column, h: Column) -> Column:
    """The text whose words from a = floor(h / 10) mod n on repeat with a period that holds 3 to 10 times in what follows."""
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n, g = F.size(words), F.floor(h / 10)
    a = F.pmod(g, F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    return F.when(n > 0, F.array_join(F.concat(F.slice(words, 1, a), F.slice(tail, 1, n - a)), " ")).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document; a tenth of them, by a hash of doc_id, are made to repeat first."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = docs.withColumn("text", F.when(F.pmod(h, F.lit(10)) == 0, repeating(F.col("text"), h)).otherwise(F.col("text")))
    rows = detected(docs, keep=["doc_id"])
    lines = F.concat_ws("", F.transform("_runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    best = F.col("_best")
    rows = rows.select(
        "doc_id", F.size("_runs").cast("long").alias("n_runs"), *(best[c].alias(c) for c in RUN.names),
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("_collapsed", 256).alias("collapsed_sha256"),
    )
    return stored(rows, "runs")[0]  # while a table is stored, workers get small batches of texts
