"""Suffix-array dedup: a run-length index with sampled run ends, and matching statistics streamed from it.

Goal: all bytes covered by a string of `length` bytes that also starts elsewhere in the corpus.

1. Each window of `length` bytes picks its least hash of K-byte strings (leftmost). Equal windows pick the same string, so
   windows are dealt by it: all windows of one choice are a segment, and a window lies in one segment only. Choices made once in
   the corpus hold no repeated window and go no further.
2. Equal segments are one, with a multiplicity. The distinct segments of a bucket form a text; its suffixes are sorted by prefix
   doubling, which gives the Burrows-Wheeler transform. It is kept as runs. At each run's start the suffix and its common prefix
   with the one before it are sampled, at each run's end those with the one after it.
   Samples shorter than `length` are kept as 0, since no value that follows from them reaches it.
3. Matching statistics stream over the text: inside a run the common prefix of position i is that of i - 1 less one, so every
   value follows from the last sample. Positions whose longest match with another suffix reaches `length`, and those of segments
   of multiplicity two or more, start repeated windows.
4. A choice with more than HOT distinct segments would overfill a bucket. Its segments are dealt again as texts of their own, each
   with its multiplicity, by longer strings (ANCHORS), which split it; the last are as long as the windows, so that a choice is one
   string. Each level builds its own index, and no bucket grows with a choice.
Marks go back to all occurrences of their segments, and to documents as runs of bytes.

Segments are equal if two 64-bit hashes are, that of the string that dealt them and that of their bytes, under 400 of them; a
document's key has 128 bits. Inside a bucket the bytes themselves are sorted.

Defined cases: null text is the empty text; texts shorter than `length` keep all; repeated rows are documents of their own and so
repeat each other; an empty table gives an empty result; other columns are carried along.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tetraframe.llm.common import chunks, discard, prefix_hash, set_apart, slices, span_hash, stored, table

#: Distinct segments of a bucket, and of a choice that is dealt again.
BUCKET, HOT = 3_000, 4_000
#: Lengths of the strings that deal windows out, level by level, as shares of the window.
ANCHORS = (0.4, 0.7, 0.9, 1.0)
_PLACE = np.uint64((1 << 28) - 1)


def segments(data: np.ndarray, offsets: np.ndarray, length: int, k: int, most: int = 1 << 27) -> tuple[np.ndarray, ...]:
    """Segments of joined texts: document, first window (inside the document), number of windows, hash of choice, hash of content.

    A text of more than `most` bytes, which comes alone, is taken in stretches that overlap by a window less a byte: every window is in
    one of them, and its choice depends on its own bytes only.
    """
    n, w = len(data), length - k + 1
    if n > max(most, length) and len(offsets) == 2:
        step = max(most - length, 0) + 1
        parts = [(a, segments(data[a : a + step + length - 1], np.array([0, min(step + length - 1, n - a)]), length, k, n)) for a in range(0, n - length + 1, step)]
        return tuple(np.concatenate([p[i] + a if i == 1 else p[i] for a, p in parts]) for i in range(5))
    if n < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    prefix = prefix_hash(data)
    at = np.arange(n - k + 1)
    h = span_hash(prefix, at, at + k)
    key = (h & ~_PLACE) | at.astype(np.uint64)
    rows = -(-len(key) // w)
    grid = np.full(rows * w, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64)
    grid[: len(key)] = key
    grid = grid.reshape(rows, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - length + 1
    least = np.minimum(behind[:starts], ahead[w - 1 : w - 1 + starts])
    choice = (least & _PLACE).astype(np.int64)
    start = np.arange(starts)
    doc = np.searchsorted(offsets, start, "right") - 1
    inside = start + length <= offsets[doc + 1]
    start, doc, choice = start[inside], doc[inside], choice[inside]
    if not len(start):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    new = np.concatenate([[True], (choice[1:] != choice[:-1]) | (doc[1:] != doc[:-1])])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(start)))
    lo = start[first]
    content = span_hash(prefix, lo, lo + count + length - 1)
    return doc[first], lo - offsets[doc[first]], count, h[choice[first]], content


def sort_suffixes(data: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Suffixes in order, each up to the end of its segment, equal ones by place. Prefix doubling over what is still tied."""
    n = len(data)
    place = np.arange(n)
    key = np.zeros(n, np.int64)
    for j in range(7):
        at = place + j
        key = key * 257 + np.where(at < end, data[np.minimum(at, n - 1)].astype(np.int64) + 1, 0)
    order = np.argsort(key)
    key = key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    head = np.maximum.accumulate(np.where(new, place, 0))
    rank = np.empty(n, np.int64)
    rank[order] = head + 1
    depth = 7
    longest = int((end - place).max(initial=0))
    slots = place  # slots of the order that are still tied
    while True:
        tied = np.concatenate([new[1:], [True]]) & new
        slots, head = slots[~tied], head[~tied]
        if not len(slots):
            return order
        who = order[slots]
        if depth >= longest:
            break
        at = who + depth
        second = head * (n + 1) + np.where(at < end[who], rank[np.minimum(at, n - 1)], 0)
        by = np.argsort(second)
        who, second, head = who[by], second[by], head[by]
        order[slots] = who
        new = np.concatenate([[True], second[1:] != second[:-1]])
        head = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        rank[who] = head + 1
        depth *= 2
    order[slots] = who[np.lexsort((who, head))]
    return order


def common_prefix(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, least: int, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of suffixes a and b, at most `most`, by binary search over hashes; 0 if below `least`."""
    out = np.zeros(len(a), np.int64)
    can = np.flatnonzero(most >= least)
    can = can[span_hash(prefix, a[can], a[can] + least) == span_hash(prefix, b[can], b[can] + least)]
    a, b, lo, hi = a[can], b[can], np.full(len(can), least, np.int64), most[can].astype(np.int64)
    while (lo < hi).any():
        mid = (lo + hi + 1) >> 1
        same = span_hash(prefix, a, a + mid) == span_hash(prefix, b, b + mid)
        lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
    out[can] = lo
    return out


class RunLengthIndex:
    """Runs of the Burrows-Wheeler transform of joined segments, with samples at run starts and ends."""

    def __init__(self, raw: list[bytes], length: int):
        size = np.array([len(r) for r in raw], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(size)])
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        end = np.repeat(self.begin[1:], size)
        order = sort_suffixes(self.data, end)
        # The byte before each suffix; none before a segment's first, which never extends a run.
        before = np.where(order > np.repeat(self.begin[:-1], size)[order], self.data[order - 1].astype(np.int16), -1)
        change = (before[1:] != before[:-1]) | (before[1:] < 0) | (before[:-1] < 0)
        self.runs = int(change.sum()) + bool(len(order))
        # Common prefixes of neighbours in order, where a run ends at the first and another starts at the second.
        at = np.flatnonzero(change)
        a, b = order[at], order[at + 1]
        value = common_prefix(prefix_hash(self.data), a, b, length, np.minimum(end[a] - a, end[b] - b))
        first, last = (order[:1], order[-1:])
        self.above = self._by_place(np.concatenate([first, b]), np.concatenate([[0][: len(first)], value]))
        self.below = self._by_place(np.concatenate([a, last]), np.concatenate([value, [0][: len(last)]]))

    @staticmethod
    def _by_place(here: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Samples by place."""
        by = np.argsort(here)
        return here[by], value[by]

    def matching_statistics(self) -> np.ndarray:
        """Longest match of each place with any other suffix, streamed from the samples; right where it reaches `length`."""
        place = np.arange(len(self.data))
        out = np.zeros(len(self.data), np.int64)
        for at, value in (self.above, self.below):
            last = np.searchsorted(at, place, "right") - 1
            out = np.maximum(out, value[last] - (place - at[last]))
        return out


def _runs(mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of true."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mark, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


def _match(pdf: pd.DataFrame, length: int) -> pd.DataFrame:
    """Repeated windows of a bucket's segments: (h, g, lo, hi), offsets in the segment, hi excluded."""
    raw = pdf["bytes"].tolist()
    index = RunLengthIndex(raw, length)
    long = index.matching_statistics() >= length
    seg, lo, hi = [], [], []
    a, b = _runs(long)
    # A run may not cross segments: matches end with them, so a long one is at least `length` before the end.
    owner = np.searchsorted(index.begin, a, "right") - 1
    seg, lo, hi = owner, a - index.begin[owner], b - index.begin[owner]
    return pd.DataFrame({"h": pdf["h"].to_numpy()[seg], "g": pdf["g"].to_numpy()[seg], "lo": lo.astype(np.int32), "hi": hi.astype(np.int32)})


_KEYS = ("_k1", "_k2")


def _keyed(docs: DataFrame) -> DataFrame:
    """Add the document's key: two hashes of doc_id and text."""
    return docs.withColumns({"_k1": F.xxhash64(F.lit(1), F.col("doc_id"), F.col("text")), "_k2": F.xxhash64(F.lit(2), F.col("text"), F.col("doc_id"))})


def occurrences(texts: DataFrame, length: int, k: int) -> DataFrame:
    """(_k1, _k2, w, s, n, h, g): all segments of all texts. texts: keys, text, and w, how many there are of it."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in slices(batches):
                for first, _, data, offsets in chunks(batch.column("text").to_pylist(), 1 << 19):
                    doc, s, n, h, g = segments(data, offsets, length, k)
                    rows = pa.array(doc + first)
                    yield pa.RecordBatch.from_arrays([*(batch.column(k).take(rows) for k in (*_KEYS, "w")), pa.array(s.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(h.view(np.int64)), pa.array(g.view(np.int64))], [*_KEYS, "w", "s", "n", "h", "g"])

    return texts.select(*_KEYS, "w", "text").mapInArrow(find, "_k1 long, _k2 long, w long, s int, n int, h long, g long")


def cut_segments(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(h, g, c, again, bytes) of wanted segments. wanted: keys, h, g, c, s, n, again."""
    per_text = wanted.groupBy(*_KEYS).agg(F.collect_list(F.struct("h", "g", "c", "s", "n", "again")).alias("_w"))  # at most a text's segments
    kinds = {"h": pa.int64(), "g": pa.int64(), "c": pa.int64(), "again": pa.bool_(), "bytes": pa.binary()}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in kinds}
            size = 0
            for text, wants in zip(batch.column("text"), batch.column("_w")):
                raw = _bytes(text.as_py())
                for x in wants.as_py():
                    part = raw[x["s"] : x["s"] + x["n"] + length - 1]
                    for k in ("h", "g", "c", "again"):
                        out[k].append(x[k])
                    out["bytes"].append(part)
                    size += len(part)
                if size > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(out[k], t) for k, t in kinds.items()], list(kinds))
                    out, size = {k: [] for k in kinds}, 0
            yield pa.RecordBatch.from_arrays([pa.array(out[k], t) for k, t in kinds.items()], list(kinds))

    # Repeated rows have the same key and the same bytes: one of them speaks for all, their number is in c.
    found = texts.select(*_KEYS, "text").join(per_text, list(_KEYS)).select("text", "_w").mapInArrow(cut, "h long, g long, c long, again boolean, bytes binary")
    return found.dropDuplicates(["h", "g"])


def _repeated(texts: DataFrame, length: int, hot: int, level: int = 0) -> tuple[DataFrame, str]:
    """(_k1, _k2, _marks), stored: runs of starts of repeated windows in texts that are there w times. Tables are stored where a key's
    rows are to be joined, so that Spark can split a hot key."""
    spark = texts.sparkSession
    k = min(length, max(1, round(ANCHORS[level] * length)))
    found, found_at = stored(occurrences(texts, length, k), "segments")
    twice, twice_at = stored(found.groupBy("h").agg(F.sum("w").alias("_n")).where("_n > 1").select("h"), "twice")
    same, same_at = stored(found.join(twice, "h", "left_semi"), "repeated")
    discard(spark, found_at, twice_at)
    kinds = same.groupBy("h", "g").agg(F.sum("w").alias("c"), F.min(F.struct(*_KEYS, "s", "n")).alias("_at"))
    kinds, kinds_at = stored(kinds.select("h", "g", "c", "_at.*"), "kinds")
    several, several_at = stored(kinds.groupBy("h").agg(F.count(F.lit(1)).alias("_kinds")).where("_kinds > 1"), "several")
    last = level == len(ANCHORS) - 1
    wanted = kinds.join(several, "h").withColumn("again", (F.col("_kinds") > hot) & F.lit(not last))
    parts, parts_at = stored(cut_segments(texts, wanted, length), "parts")
    plain = parts.where("NOT again")
    buckets = max(1, math.ceil(plain.count() / BUCKET))
    plain = plain.select("h", "g", "bytes").withColumn("_bucket", F.pmod(F.xxhash64("h"), F.lit(buckets)))
    marks = plain.groupBy("_bucket").applyInPandas(lambda pdf: _match(pdf, length), "h long, g long, lo int, hi int")
    whole = kinds.where("c > 1").select("h", "g", F.lit(0).alias("lo"), F.col("n").alias("hi"))
    marks, places = whole.unionByName(marks), [same_at, kinds_at, several_at, parts_at]
    again = parts.where("again")
    if not last and again.take(1):
        # Segments of hot choices are the next level's texts; what repeats in several of them, or in one that is there c times, is repeated.
        deeper, deeper_at = _repeated(again.select(F.col("h").alias("_k1"), F.col("g").alias("_k2"), F.col("c").alias("w"), F.col("bytes").alias("text")), length, hot, level + 1)
        marks = marks.unionByName(deeper.select(F.col("_k1").alias("h"), F.col("_k2").alias("g"), F.explode("_marks").alias("_m")).select("h", "g", "_m.lo", "_m.hi"))
        places.append(deeper_at)
    all_marks, marks_at = stored(marks.groupBy("h", "g").agg(F.collect_set(F.struct("lo", "hi")).alias("_m")), "marks")  # at most a segment's windows
    back = same.join(all_marks, ["h", "g"]).select(*_KEYS, F.transform("_m", lambda x: F.struct((F.col("s") + x["lo"]).alias("lo"), (F.col("s") + x["hi"]).alias("hi"))).alias("_m"))
    out = stored(back.groupBy(*_KEYS).agg(F.flatten(F.collect_set("_m")).alias("_marks")), "marks")  # at most a text's windows
    discard(spark, marks_at, *places)
    return out


def repeated_windows(docs: DataFrame, length: int = 200, hot: int = HOT) -> DataFrame:
    """(_k1, _k2, _marks): for each document key the runs [lo, hi) of starts of repeated windows, as an array."""
    return _repeated(_keyed(docs.select("doc_id", "text")).select(*_KEYS, F.lit(1).cast("long").alias("w"), "text"), length, hot)[0]


def _bytes(text: str | bytes | None) -> bytes:
    return text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")


def covered(marks: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by windows that start in the runs [lo, hi)."""
    out: list[list[int]] = []
    for lo, hi in sorted(marks):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi + length - 1)
        else:
            out.append([lo, hi + length - 1])
    return [(a, b) for a, b in out]


def with_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """docs with _marks, the runs [lo, hi) of starts of repeated windows (null: none)."""
    marks = repeated_windows(docs, length)
    return _keyed(docs).join(marks, list(_KEYS), "left").drop(*_KEYS)


def cut_out(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """raw without the spans."""
    out, at = [], 0
    for lo, hi in spans:
        out.append(raw[at:lo])
        at = hi
    return b"".join([*out, raw[at:]])


def removed(docs: DataFrame, length: int = 200) -> DataFrame:
    """docs with _kept (bytes), _kept_text without characters that a cut went through, _n_bytes, _n_removed and _n_spans; columns of docs under these names give way."""
    docs, back = set_apart(docs, "doc_id", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at = batch.schema.get_field_index("_marks")
            kept, size, gone, spans = [], [], [], []
            for text, marks in zip(batch.column("text"), batch.column("_marks")):
                raw = _bytes(text.as_py())
                own = covered([(m["lo"], m["hi"]) for m in marks.as_py() or ()], length)
                kept.append(cut_out(raw, own))
                size.append(len(raw))
                spans.append(len(own))
                gone.append(len(raw) - len(kept[-1]))
            yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(batch.columns) if i != at), pa.array(kept, pa.binary()), pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()), *(pa.array(x, pa.int64()) for x in (size, gone, spans))], [*(n for n in batch.schema.names if n != "_marks"), "_kept", "_kept_text", "_n_bytes", "_n_removed", "_n_spans"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    rows = with_repeats(docs, length).select(*docs.columns, "_marks").mapInArrow(cut, f"{schema}, _kept binary, _kept_text string, _n_bytes long, _n_removed long, _n_spans long")
    added = ("_kept", "_kept_text", "_n_bytes", "_n_removed", "_n_spans")
    return rows.select(*back(*added), *added)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every document without bytes covered by repeated strings of 200 bytes."""
    rows = removed(table(spark, sf_dir, "documents").select("doc_id", "text"), 200)
    return rows.select("doc_id", *(F.col(f"_{c}").alias(c) for c in ("n_bytes", "n_removed", "n_spans")), F.sha2("_kept", 256).alias("kept_sha256"))
