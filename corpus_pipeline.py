"""A training corpus from raw documents: filter, deduplicate twice, mix and pack.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and returns the columns of documents; the last
returns packed pieces. Stage by stage:

Of tied rows and of rows repeated whole each stage keeps what its operator's docstring says; an empty table gives an empty one at
every stage; columns beyond those of documents are carried along up to packing, whatever their names.

- toxicity: documents that the grammar, learned from the labels table, predicts as toxic go.
- near_dedup: one document, that of the smallest doc_id, stays of each component alike to 0.8 on five-word shingles.
- suffix_dedup: bytes covered by repeated strings of 200 bytes go from the texts, n_chars follows; a document of which nothing is
  left goes.
- mixing: sources are tempered so that none is shown more than 1.5 times as often as another; every document is shown at least
  once, so rows of small sources may come twice.
- packing: texts become ids and pieces of at most 2048 tokens in sequences.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tetraframe.llm.common import discard, set_apart, stored, table
from tetraframe.llm.long_matches import removed
from tetraframe.llm.mixing import mixed
from tetraframe.llm.near_dedup import deduplicated
from tetraframe.llm.packing import packed
from tetraframe.llm.token_counts import vocabulary
from tetraframe.llm.toxicity import scored

#: How often the most repeated source is shown for one showing of the least repeated.
REPETITION = 1.5


#: The columns of documents; whatever else a table has is carried along.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def carried(stage: Stage) -> Stage:
    """The stage over documents whose other columns are renamed before and named back after, so that no name can clash with its own."""

    @functools.wraps(stage)
    def named_apart(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        docs, back = set_apart(docs, *DOCUMENT)
        return stage(spark, docs, sf_dir).select(*back())

    return named_apart


@carried
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return scored(docs, table(spark, sf_dir, "labels")).where("_toxic = 0").select(*docs.columns)


@carried
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return deduplicated(docs)


@carried
def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated passages; what was empty before stays."""
    rows = removed(docs).where("_kept_text <> '' OR _n_removed = 0").withColumn("text", F.when(F.col("_n_removed") > 0, F.col("_kept_text")).otherwise(F.col("text")))
    return rows.withColumn("n_chars", F.when(F.col("_n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


@carried
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the tempered mixture shows them."""
    return mixed(docs, repetition=REPETITION).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids, packed into sequences."""
    docs, _ = set_apart(docs, *DOCUMENT)
    return packed(docs, vocabulary("word_bpe_49k.json"), 2048)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("suffix_dedup", suffix_dedup), ("mixing", mixing), ("packing", packing)]

#: SQL can't express the learned filter, the signatures or the packing; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written to the shared folder and read again."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs, place = stored(stage(spark, docs, sf_dir), name)
        if last is not None:
            discard(spark, last)  # nothing reads it any more
        last = place
    return STAGES[-1][1](spark, docs, sf_dir)
