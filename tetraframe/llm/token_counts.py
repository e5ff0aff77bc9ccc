"""Token counts without ids: pieces are counted once for each distinct pre-token of the corpus and joined to frequencies.

1. Documents form blocks. A block keeps its distinct pre-tokens once, and for each document the numbers of its distinct pre-tokens
   with their frequencies, packed.
2. The blocks' pre-tokens, made distinct over the corpus, are cut into pieces once each; only how many is kept.
3. Pre-tokens of blocks join these numbers, in several passes by hash so that one pass's shuffle is on disk at a time, and each
   document sums frequency times pieces.

Special strings inside a text count one each, as the library does by default; the text between them is cut on its own. Words come
from the tokenizer's own pattern, so counts are those of the library.

Defined cases: null text is the empty text, 0 tokens; any length of text is read whole; repeated rows are counted each, also with a
null doc_id; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import functools
import json
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tetraframe.llm.common import discard, from_planes, planes, slices, stored, table

#: Bytes of a block's texts, and passes of the join.
BLOCK, PASSES = 12 << 20, 3


def vocabulary(name: str) -> str:
    """A public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class PreTokens:
    """Pre-tokens of texts, and numbers of pieces, of a byte-level BPE file whose ranks stand beside it."""

    def __init__(self, file: str):
        import public_tokenizers
        import tiktoken

        self.special = [t["content"] for t in json.loads(Path(file).read_text())["added_tokens"]]
        pairs = (line.split() for line in Path(file).with_suffix(".tiktoken").read_bytes().splitlines() if line)
        self.core = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})._core_bpe
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.between = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def pieces(self, pre: str) -> int:
        """Pieces of one pre-token."""
        return len(self.core.encode_single_piece(pre.encode("utf-8", "surrogatepass")))

    def frequencies(self, text: str | None) -> tuple[Counter, int]:
        """How often each pre-token stands in a text, and the special strings in it."""
        if not text:
            return Counter(), 0
        if self.between is None or not any(s in text for s in self.special):
            return Counter(self.pattern.findall(text)), 0
        parts = self.between.split(text)
        total: Counter = Counter()
        for p in parts:
            total.update(self.pattern.findall(p))
        return total, len(parts) - 1


@functools.lru_cache(maxsize=2)
def pre_tokens(file: str) -> PreTokens:
    """One cutter a worker process."""
    return PreTokens(file)


def blocks(docs: DataFrame, file: str, size: int) -> DataFrame:
    """A row a block: ids, bytes and special strings of its documents, sizes of their lists, steps between ascending numbers, frequencies, distinct pre-tokens."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["ids", "n_bytes", "special", "sizes", "steps", "times", "pre"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = pre_tokens(file)
        known: dict[str, int] = {}
        ids: list[pa.Array] = []
        n_bytes, special, sizes, steps, times, held = [], [], [], [], [], 0

        def row() -> pa.RecordBatch:
            every = pa.concat_arrays(ids)
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (every, pa.array(n_bytes, pa.int64()), pa.array(special, pa.int64()))]
            packed = [pa.array([planes(x)], pa.binary()) for x in (np.array(sizes, np.int64), np.concatenate(steps), np.concatenate(times))]
            return pa.RecordBatch.from_arrays([*lists, *packed, pa.array([list(known)], pa.list_(pa.string()))], names)

        for batch in slices(batches, 256):
            for i, x in enumerate(batch.column("text")):
                text = x.as_py()
                counts, n = cutter.frequencies(text)
                code = np.fromiter((known.setdefault(p, len(known)) for p in counts), np.int64, len(counts))
                order = np.argsort(code)
                ids.append(batch.column("doc_id").slice(i, 1))
                n_bytes.append(len((text or "").encode("utf-8", "surrogatepass")))
                special.append(n)
                sizes.append(len(code))
                steps.append(np.diff(code[order], prepend=0))
                times.append(np.fromiter(counts.values(), np.int64, len(counts))[order])
                held += n_bytes[-1]
                if held >= size:
                    yield row()
                    known, ids, n_bytes, special, sizes, steps, times, held = {}, [], [], [], [], [], [], 0
        if ids:
            yield row()

    schema = f"ids array<{kind}>, n_bytes array<long>, special array<long>, sizes binary, steps binary, times binary, pre array<string>"
    return docs.select("doc_id", "text").mapInArrow(build, schema).withColumn("block", F.monotonically_increasing_id())


def counted(pre: DataFrame, file: str) -> DataFrame:
    """(pre, n): pieces of distinct pre-tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = pre_tokens(file)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("pre"), pa.array(map(cutter.pieces, batch.column("pre").to_pylist()), pa.int32())], ["pre", "n"])

    return pre.mapInArrow(count, "pre string, n int")


def summed(rows: DataFrame, kind: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of blocks with _n, the pieces of their pre-tokens in order."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            ids, n_bytes, special = (batch.column(c).flatten() for c in ("ids", "n_bytes", "special"))
            sizes, steps, times = (from_planes(batch.column(c)[0].as_py()) for c in ("sizes", "steps", "times"))
            # Steps start anew with each document: running sums less what stood before it.
            running, first = np.cumsum(steps), np.cumsum(sizes) - sizes
            before = np.where(first > 0, running[np.maximum(first - 1, 0)], 0) if len(running) else first
            code = running - np.repeat(before, sizes)
            n = batch.column("_n").flatten().to_numpy()
            total = np.bincount(np.repeat(np.arange(len(sizes)), sizes), n[code] * times if len(code) else None, len(sizes)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([ids, n_bytes, pa.array(total + special.to_numpy())], ["doc_id", "n_bytes", "n_tokens"])

    return rows.select("ids", "n_bytes", "special", "sizes", "steps", "times", "_n").mapInArrow(add, f"doc_id {kind}, n_bytes long, n_tokens long")


def token_counts(docs: DataFrame, file: str, limit: int = 512, size: int = BLOCK, passes: int = PASSES) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text. file: path of the tokenizer's .json, beside its ranks."""
    spark = docs.sparkSession
    kept, kept_at = stored(blocks(docs, file, size), "blocks")
    # A block's pre-tokens and their places; the distinct ones are counted, once each.
    rows = kept.select("block", F.posexplode("pre").alias("pos", "pre"))
    pieces, pieces_at = stored(counted(rows.select("pre").distinct(), file), "pieces")
    part = lambda k: F.pmod(F.xxhash64("pre"), F.lit(passes)) == k
    found = [stored(rows.where(part(k)).join(pieces.where(part(k)), "pre").select("block", "pos", "n"), "counted") for k in range(passes)]
    every = found[0][0]
    for more, _ in found[1:]:
        every = every.unionByName(more)
    numbers = every.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("pos", "n"))).alias("_p")).select("block", F.transform("_p", lambda x: x["n"]).alias("_n"))  # a block's own pre-tokens
    both = kept.drop("pre").join(numbers, "block", "left").withColumn("_n", F.coalesce("_n", F.array().cast("array<int>")))
    out, _ = stored(summed(both, docs.schema["doc_id"].dataType.simpleString()), "tokens")
    discard(spark, kept_at, pieces_at, *(at for _, at in found))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents with the 50k byte-level vocabulary."""
    return token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
