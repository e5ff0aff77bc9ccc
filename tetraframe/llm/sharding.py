"""A random order of a whole table in shards of equal counts, by an external shuffle in two passes.

First pass: every row goes to one of B buckets by a seeded hash of its content, B so large that a bucket fits in a task's memory;
buckets of neighbouring numbers travel to the same task, which is the one time that texts move. Second pass: a task takes its buckets
one after another, brings each to an order that depends on content alone, shuffles it by Fisher-Yates with a generator seeded by
the bucket's number, and writes it. Buckets in their order are then a random order of the table. Places in a task become places in
the table by the counts of the tasks before, a table with a row a task, and equal stretches of places are the shards.

The order depends on the rows and the seed alone, not on files, tasks or executors: B comes from the texts' bytes. Rows that are
alike in every column are interchangeable; where they would fill a good part of a bucket, their copies are spread over all buckets
by their place in the input.

Defined cases: a null text counts as no bytes; null ids and repeated rows are rows like any other; shards beyond the number of
rows stay empty; an empty table gives no rows; columns of the input, whatever their names, stay, and the new ones must not be
among them (they can be renamed by `names`). A bucket has at least one row, so a single text must fit in a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tetraframe.llm.common import content_key, copies_apart, discard, stored, table

#: Bytes of text in a bucket: a task holds a bucket three times over (as read, joined, shuffled).
BUCKET_BYTES = 8 << 20
#: Copies of one row that make up more than this part of a bucket are spread over all buckets.
HOT_PART = 8
#: Rows of a shuffled bucket handed back at a time.
OUT_ROWS = 2_000


def size(text: Column) -> Column:
    """UTF-8 bytes of a text and eight for its id."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A uniform permutation of n rows; numpy's is the swap of each place with one not yet settled."""
    return np.random.Generator(np.random.PCG64([seed, bucket])).permutation(n)


def _buckets(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each bucket, from batches that are sorted by bucket."""
    held, number = [], None
    for batch in batches:
        ids = batch.column(at).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
        for first, last in zip(cuts[:-1], cuts[1:]):
            if last == first:
                continue
            if held and ids[first] != number:
                yield number, pa.Table.from_batches(held)
                held = []
            number = int(ids[first])
            held.append(batch.slice(first, last - first))
    if held:
        yield number, pa.Table.from_batches(held)


def shuffled(docs: DataFrame, seed: int = 17, text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, str]:
    """docs' columns as _c0, _c1, .. with _task and _rank, the rows' place in a random order: by task, then by rank; and where it is stored."""
    spark = docs.sparkSession
    rows = docs.select(*(F.col(f"`{n}`").alias(f"_c{i}") for i, n in enumerate(docs.columns)))
    body = F.col(f"_c{docs.columns.index(text)}")
    rows = rows.withColumn("_key", content_key(rows, seed))
    total = rows.agg(F.sum(size(body))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    rows, hot_at = copies_apart(rows, "_key", size(body), bucket_bytes // HOT_PART)
    tasks = min(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(F.lit(seed), "_key", "_copy"), F.lit(buckets))).drop("_copy")
    task = F.expr(f"int(_bucket * {tasks} div {buckets})")
    rows = rows.repartitionById(tasks, task).sortWithinPartitions("_bucket", "_key")
    kept = [f for f in rows.schema.fields if f.name not in ("_bucket", "_key")]
    at = rows.columns.index("_bucket")

    def shuffle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = 0
        for number, bucket in _buckets(batches, at):
            bucket = bucket.select([f.name for f in kept])
            order = fisher_yates(len(bucket), seed, number)
            for first in range(0, len(order), OUT_ROWS):
                part = bucket.take(pa.array(order[first : first + OUT_ROWS])).combine_chunks()
                places = pa.array(np.arange(rank, rank + len(part)))
                rank += len(part)
                task_id = pa.array(np.full(len(part), number * tasks // buckets, np.int32))
                for batch in part.append_column("_task", task_id).append_column("_rank", places).to_batches():
                    yield batch

    out, written = stored(rows.mapInArrow(shuffle, T.StructType([*kept, T.StructField("_task", T.IntegerType()), T.StructField("_rank", T.LongType())])), "shuffled")
    discard(spark, hot_at)
    return out, written


def sharded(docs: DataFrame, shards: int, seed: int = 17, text: str = "text", bucket_bytes: int = BUCKET_BYTES, names: tuple[str, str] = ("shard", "slot")) -> DataFrame:
    """docs in a random order, with the shard of each row (from 0) and its slot there (from 0): counts of shards differ by at most one."""
    if clash := set(names) & set(docs.columns):
        raise ValueError(f"docs has columns {sorted(clash)}: give other names for shard and slot")
    rows, _ = shuffled(docs, seed, text, bucket_bytes)
    tasks = rows.groupBy("_task").agg(F.count(F.lit(1)).alias("_rows"))
    across = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)  # a row a task
    before = tasks.select("_task", F.coalesce(F.sum("_rows").over(across), F.lit(0)).alias("_before"))
    total = tasks.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("_total"))
    # A row a task, at most as many as the session has shuffle partitions.
    rows = rows.join(F.broadcast(before), "_task").crossJoin(F.broadcast(total)).withColumn("_place", F.col("_before") + F.col("_rank"))
    each, larger = F.floor(F.col("_total") / shards), F.pmod("_total", F.lit(shards))
    edge = larger * (each + 1)  # the first shards have a row more
    early, late = F.floor(F.col("_place") / (each + 1)), F.floor((F.col("_place") - edge) / F.greatest(each, F.lit(1)))
    first = F.col("_place") < edge
    shard = F.when(first, early).otherwise(larger + late)
    slot = F.when(first, F.pmod("_place", each + 1)).otherwise(F.pmod(F.col("_place") - edge, F.greatest(each, F.lit(1))))
    return rows.select(*(F.col(f"_c{i}").alias(n) for i, n in enumerate(docs.columns)), shard.cast("int").alias(names[0]), slot.cast("long").alias(names[1]))


def write_shards(rows: DataFrame, path: str, shard: str = "shard", slot: str = "slot") -> None:
    """Write what sharded() gives as a folder a shard. A task holds a stretch of the order, so it opens few shards' files; a file is in order of slots."""
    rows.write.partitionBy(shard).option("compression", "zstd").parquet(path)


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards in a random order; the law is equal counts of rows."""
    docs = table(spark, sf_dir, "documents")
    rows = sharded(docs, 24)
    return rows.select(
        "doc_id", size(F.col("text")).alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
