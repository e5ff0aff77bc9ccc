"""Exact top-k inner products by block-at-a-time pruning.

Vectors become integers. Ranges of vec_id form blocks; a block keeps its vectors (a forward index) and, for each term
(component), its largest and smallest value. The sum over terms of the larger of query * maximum and query * minimum
bounds every score in the block. Each query takes the blocks in falling order of that bound and stops where the bound is
below its k-th score; a bound equal to it is still scored, since ties go to the smaller vec_id.

Bounds come before data. Blocks are stored; what travels first are their largest and smallest values and largest norms, a
hundredth of the vectors; the bound is the lesser of the sum over terms and of the product of norms. Queries form groups. A group
looks at all bounds, and each of its queries is scored on its most promising block alone, which gives a first k-th score; only blocks
that are most promising to some query move for that. Only blocks whose bound reaches it for some query of a group are then sent to that group, in shards of bounded
size; a task holds a shard and a group, and the best k of all shards are merged.

Defined cases: vectors that are null, or hold a null or non-finite component, take no part; a shorter vector counts as
zeros beyond its end; repeated vec_id: each row is a candidate of other queries, and the smallest of the vectors is the
query; a null vec_id takes no part; integers of any size up to 63 bits are multiplied exactly, and a score that needs more fails with
an error; fewer than k candidates give all; other columns are not read; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tetraframe.llm.common import stored, table

#: Vectors of a block, of a shard and queries of a block of queries.
BLOCK, SHARD, QUERIES = 256, 16_384, 2_048


def integer_vectors(rows: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component, of the rows whose vectors are whole and finite."""
    x = F.col("embedding")
    odd = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return rows.where(x.isNotNull() & ~odd & F.col("vec_id").isNotNull()).select("vec_id", F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("long")).alias("v"))


def _matrix(raw: list[bytes]) -> np.ndarray:
    """Rows of 64-bit integers; shorter ones are filled with zeros."""
    rows = [np.frombuffer(r, np.int64) for r in raw]
    width = max(map(len, rows), default=0)
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in vec_id order to blocks: ids, widths and values as bytes."""
    for batch in batches:
        ids, vectors = batch.column("vec_id").to_numpy(zero_copy_only=False), batch.column("v")
        out = []
        for at in range(0, len(ids), BLOCK):
            part = vectors.slice(at, BLOCK)
            widths = np.diff(part.offsets.to_numpy()).astype(np.int32)
            out.append((int(ids[at]), ids[at : at + BLOCK].astype(np.int64).tobytes(), widths.tobytes(), part.flatten().to_numpy(zero_copy_only=False).astype(np.int64).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*out), (pa.int64(), pa.binary(), pa.binary(), pa.binary()))] if out else [pa.array([], t) for t in (pa.int64(), pa.binary(), pa.binary(), pa.binary())], ["first", "ids", "widths", "data"])


def _block_rows(ids: bytes, widths: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids, widths, data = np.frombuffer(ids, np.int64), np.frombuffer(widths, np.int32), np.frombuffer(data, np.int64)
    out = np.zeros((len(ids), int(widths.max(initial=0))), np.int64)
    out[np.arange(out.shape[1])[None, :] < widths[:, None]] = data
    return ids, out


def _fit(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def search_block(queries: np.ndarray, query_ids: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The best k of the blocks for each query: (query index, vec_id, score), and how many (query, block) pairs were scored."""
    width = max([queries.shape[1], *(m.shape[1] for _, m in blocks)])
    queries, blocks = _fit(queries, width), [(ids, _fit(m, width)) for ids, m in blocks]
    high, low = (np.stack([f(m, axis=0) for _, m in blocks]) for f in (np.max, np.min))
    # Below 2**53 every sum is exact in double precision, below 2**63 in integers of 64 bits, and beyond that in unbounded ones.
    most = float(np.abs(queries).max(initial=0)) * float(max(np.abs(high).max(initial=0), np.abs(low).max(initial=0))) * max(width, 1)
    kind = np.float64 if most < 2**53 else np.int64 if most < 2**62 else object
    least = {np.float64: -np.inf, np.int64: np.iinfo(np.int64).min, object: -(1 << 200)}[kind]
    q = queries.astype(kind)
    forward = [m.astype(kind).T for _, m in blocks]
    bounds = np.maximum(q, 0) @ high.astype(kind).T + np.minimum(q, 0) @ low.astype(kind).T
    order = np.argsort(-bounds, axis=1, kind="stable")
    kth = np.full(len(q), -np.inf)
    top = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    alive, scored = np.arange(len(q)), 0
    for turn in range(len(blocks)):
        at = order[alive, turn]
        keep = bounds[alive, at] >= kth[alive]  # falling bounds: whoever fails here is done
        alive, at = alive[keep], at[keep]
        if not len(alive):
            break
        found = [top]
        for b in np.unique(at):
            who = alive[at == b]
            scored += len(who)
            ids = blocks[b][0]
            s = q[who] @ forward[b]
            own = query_ids[who][:, None] == ids[None, :]
            s = np.where(own, least, s)
            floor = kth[who]
            if s.shape[1] > k:
                floor = np.maximum(floor, np.partition(s, -k, axis=1)[:, -k])
            i, j = np.nonzero((s >= floor[:, None]) & ~own)
            found.append((who[i], ids[j], s[i, j].astype(np.int64)))
        who, ids, s = (np.concatenate(x) for x in zip(*found))
        rank = np.lexsort((ids, -s, who))
        who, ids, s = who[rank], ids[rank], s[rank]
        first = np.searchsorted(who, who)
        best = np.arange(len(who)) - first < k
        top = who[best], ids[best], s[best]
        n = np.bincount(top[0], minlength=len(q))
        last = np.cumsum(n) - 1
        full = n == k
        kth[full] = top[2][last[full]]
    return *top, scored


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks to their largest and smallest values by component, as bytes."""
    for batch in batches:
        high, low, norm = [], [], []
        for x in zip(*(batch.column(c).to_pylist() for c in ("ids", "widths", "data"))):
            _, m = _block_rows(*x)
            high.append(m.max(axis=0).tobytes())
            low.append(m.min(axis=0).tobytes())
            norm.append(float(np.sqrt((m.astype(float) ** 2).sum(axis=1)).max(initial=0)))
        yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(high, pa.binary()), pa.array(low, pa.binary()), pa.array(norm, pa.float64())], ["block", "high", "low", "norm"])


def _bounds(pdf: pd.DataFrame, queries: np.ndarray) -> np.ndarray:
    """The bound of each query (row) in each block (column)."""
    high, low = _matrix(pdf["high"].tolist()), _matrix(pdf["low"].tolist())
    width = max(high.shape[1], queries.shape[1])
    high, low, queries = _fit(high, width).astype(float), _fit(low, width).astype(float), _fit(queries, width).astype(float)
    # Sums of doubles may fall a little short beyond 2**53; a bound must not.
    terms = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    norms = np.sqrt((queries**2).sum(axis=1))[:, None] * pdf["norm"].to_numpy()[None, :]
    bound = np.minimum(terms, norms)
    return bound + np.abs(bound) * 1e-12 + norms * 1e-14


def _queries(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return pdf["vec_id"].to_numpy(np.int64), _matrix([np.asarray(v, np.int64).tobytes() for v in pdf["v"]])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, shard: int = SHARD, per_block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k largest inner products; vectors and queries: (vec_id, v)."""
    kept = vectors.repartitionByRange("vec_id").sortWithinPartitions("vec_id").mapInArrow(_blocks, "first long, ids binary, widths binary, data binary")
    kept, _ = stored(kept.withColumn("block", F.monotonically_increasing_id()), "vectors")
    summary, _ = stored(kept.mapInArrow(_summary, "block long, high binary, low binary, norm double"), "bounds")
    asked, _ = stored(queries.groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    shards, groups = max(1, math.ceil(summary.count() * BLOCK / shard)), max(1, math.ceil(asked.count() / per_block))
    group = F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")
    asked = asked.withColumn("_group", group)
    # Bounds, not vectors, go to every group; each group meets a part of them at a time.
    some = max(1, math.ceil(shards / 64))
    parts = summary.withColumn("_part", F.pmod(F.xxhash64("block"), F.lit(some)).cast("int")).withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    everywhere = asked.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(some - 1))))

    def promising(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"vec_id": [], "block": [], "bound": []})
        ids, q = _queries(right)
        b = _bounds(left, q)
        at = b.argmax(axis=1)
        return pd.DataFrame({"vec_id": ids, "block": left["block"].to_numpy()[at], "bound": b[np.arange(len(ids)), at]})

    best = parts.groupBy("_group", "_part").cogroup(everywhere.groupBy("_group", "_part")).applyInPandas(promising, "vec_id long, block long, bound double")
    best = best.groupBy("vec_id").agg(F.max_by("block", "bound").alias("block")).join(asked, "vec_id")
    # Only blocks that some query finds most promising move, and one that many do is met by a slice of them at a time.
    chosen = best.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / per_block).cast("int").alias("_slices"))
    best = best.join(chosen, "block").withColumn("_slice", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("_slices")).cast("int")).drop("_slices")
    moved = kept.join(chosen, "block").withColumn("_slice", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)))

    def first_scores(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"vec_id": [], "floor": []})
        ids, q = _queries(right)
        r = left.iloc[0]
        who, _, s, _ = search_block(q, ids, [_block_rows(r["ids"], r["widths"], r["data"])], k)
        n = np.bincount(who, minlength=len(ids))
        last = np.cumsum(n) - 1
        return pd.DataFrame({"vec_id": ids[n == k], "floor": s[last[n == k]].astype(float)})

    floors = moved.groupBy("block", "_slice").cogroup(best.groupBy("block", "_slice")).applyInPandas(first_scores, "vec_id long, floor double")
    asked, _ = stored(asked.join(floors, "vec_id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))), "floors")
    everywhere = asked.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(some - 1))))

    def reached(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"block": [], "_group": []})
        _, q = _queries(right)
        hit = (_bounds(left, q) >= right["floor"].to_numpy()[:, None]).any(axis=0)
        return pd.DataFrame({"block": left["block"].to_numpy()[hit], "_group": int(right["_group"].iat[0])})

    wanted = parts.groupBy("_group", "_part").cogroup(everywhere.groupBy("_group", "_part")).applyInPandas(reached, "block long, _group int")
    placed, _ = stored(wanted.withColumn("_shard", F.pmod(F.xxhash64("block"), F.lit(shards)).cast("int")), "placed")
    sent = kept.join(placed, "block")
    # A group's queries go to the shards that hold something for it.
    places = placed.select(F.col("_group").alias("_g"), F.col("_shard").alias("_s")).distinct()
    everywhere = asked.join(places, asked["_group"] == places["_g"])

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids, q = _queries(right)
        left = left.sort_values("first", kind="stable")
        who, found, s, _ = search_block(q, ids, [_block_rows(*x) for x in zip(left["ids"], left["widths"], left["data"])], k)
        return pd.DataFrame({"query_id": ids[who], "vec_id": found, "score": s})

    found = sent.groupBy("_group", "_shard").cogroup(everywhere.groupBy("_g", "_s")).applyInPandas(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best of all vectors for each vector whose id is divisible by 100."""
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), 10)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
