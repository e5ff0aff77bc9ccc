"""Document fingerprints: a canonical exact digest, with classes confirmed byte by byte. SQL functions only.

A text is brought to a canonical form (compatibility composition, full case folding, runs of white space to one blank,
ends trimmed) and digested by two xxhash64 of different seeds, 128 bits. Equal digests are buckets; inside a bucket the
canonical bytes are compared with the bucket's first text, and what differs forms classes by its bytes. The digest is
exact, so two fingerprints are alike (1) or not (0).

The normaliser is called through java_method, which Catalyst takes for nondeterministic: filters are not pushed through it.

Defined cases: null text is the empty text; null doc_id sorts below all others; rows of one doc_id come in the order of their text;
repeated rows keep one row each; an empty table gives an empty result; only the named columns are read, so extra ones don't matter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tetraframe.llm.common import stored, table

_LEAST = -(1 << 63)


def canonical(text: Column) -> Column:
    """Compatibility composition, case folding, composition again, white space to single blanks. Null gives the empty text."""
    compose = lambda c: F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(True))
    folded = F.java_method(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), compose(F.coalesce(text, F.lit(""))), F.lit(True))
    return F.trim(F.regexp_replace(compose(folded), r"(?U)\s+", " "))


def digest(form: Column) -> Column:
    """128 bits of a canonical form, as 32 hexadecimal digits."""
    part = lambda seed: F.lpad(F.hex(F.xxhash64(F.lit(seed), form)), 16, "0")
    return F.lower(F.concat(part(1), part(2)))


def exact_classes(docs: DataFrame, fingerprints: DataFrame, derive: Callable[[Column], Column] = digest) -> DataFrame:
    """(doc_id, fingerprint, class_id): rows of equal canonical bytes share the smallest doc_id of them.

    fingerprints: (doc_id, fingerprint) of docs, made by `derive`. Only buckets of two or more rows fetch texts; every row is compared
    with its bucket's first text, never with all others, so a bucket of many copies stays a join that Spark can split.
    """
    fp = fingerprints.select("doc_id", "fingerprint")
    buckets = fp.groupBy("fingerprint").agg(F.min("doc_id").alias("_rep"), F.count(F.lit(1)).alias("_n"))
    shared, _ = stored(buckets.where("_n > 1").select("fingerprint", "_rep"), "buckets")
    members = docs.select("doc_id", "text").join(fp.join(shared, "fingerprint", "left_semi").select("doc_id").distinct(), "doc_id", "left_semi")
    forms = members.select("doc_id", canonical(F.col("text")).alias("_form")).withColumn("fingerprint", derive(F.col("_form")))
    reps = shared.join(forms.withColumnRenamed("doc_id", "_rep"), ["fingerprint", "_rep"]).groupBy("fingerprint", "_rep").agg(F.min("_form").alias("_rep_form"))
    compared = forms.join(reps, "fingerprint").select("doc_id", "fingerprint", "_rep", F.when(F.col("_form") != F.col("_rep_form"), F.col("_form")).alias("_other"))
    same = compared.where("_other IS NULL").select("doc_id", "fingerprint", F.col("_rep").alias("class_id"))
    other = compared.where("_other IS NOT NULL").select("doc_id", "fingerprint", "_other")
    split = other.join(other.groupBy("_other").agg(F.min("doc_id").alias("class_id")), "_other").select("doc_id", "fingerprint", "class_id")
    return same.unionByName(split).groupBy("doc_id", "fingerprint").agg(F.min("class_id").alias("class_id"))


def with_next(docs: DataFrame, columns: list[str], derive: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Add next_<column> for each named column: that of the next row in descending doc_id order, after the last the first's.

    derive adds columns to rows once they stand in order, so that what it computes is computed once a row.

    Rows are sorted by ranges and stored, part by part. Inside a part the next row is the window's; the last row of a part takes the
    first row of the next part that has one, from a table with a row a part. No part's bounds pass through the driver.
    """
    rows = docs.withColumn("_key", F.coalesce(F.col("doc_id"), F.lit(_LEAST)))
    # Ends of equal keys must meet in one part, which the range does: it goes by the key alone.
    ordered = derive(rows.repartitionByRange(F.desc("_key"))).withColumn("_part", F.spark_partition_id())
    kept, _ = stored(ordered, "ordered")
    order = [F.desc("_key"), *(F.col(c) for c in columns)]
    inside = Window.partitionBy("_part").orderBy(*order)
    first = kept.groupBy(F.col("_part").alias("_after")).agg(F.min_by(F.struct(*columns), F.struct(F.negative(F.col("_key").cast("decimal(20,0)")), *columns)).alias("_border"))
    across = Window.orderBy("_part")  # a number a part; the parts' first rows are joined to it
    parts = kept.select("_part").distinct()
    first = parts.select("_part", F.coalesce(F.lead("_part").over(across), F.first("_part").over(across)).alias("_after")).join(first, "_after").drop("_after")
    numbered = kept.select("*", F.struct(*(F.lead(c).over(inside).alias(c) for c in columns)).alias("_next"), F.lead(F.lit(True)).over(inside).alias("_more"))
    out = numbered.join(first, "_part").withColumn("_next", F.when(F.col("_more"), F.col("_next")).otherwise(F.col("_border")))
    return out.select(*(c for c in kept.columns if c not in ("_key", "_part")), *(F.col(f"_next.{c}").alias(f"next_{c}") for c in columns))


def edited(text: Column, following: Column) -> Column:
    """The last half of the code points replaced by the first as many of the following text."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), n - half), F.substr(following, F.lit(1), half))


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the fingerprint of a text column. The form is a column of its own, so that it is computed once."""
    return df.withColumn("_form", canonical(F.col(text))).withColumn(name, digest(F.col("_form"))).drop("_form")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and the class of byte-equal canonical texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(base, ["fingerprint", "text"], lambda df: with_fingerprint(df, "text", "fingerprint"))
    rows = rows.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), "fingerprint", "next_fingerprint", edited(F.col("text"), F.col("next_text")).alias("_edited"))
    rows = with_fingerprint(rows, "_edited", "edited_fingerprint")
    alike = lambda other: F.when(F.col("fingerprint") == F.col(other), 1.0).otherwise(0.0)
    rows = rows.select(
        "doc_id", "n_chars", F.sha2(F.col("_edited"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        alike("edited_fingerprint").alias("near_edited"), alike("next_fingerprint").alias("near_next"),
    )
    rows, _ = stored(rows, "fingerprints")
    classes = exact_classes(docs, rows).select(F.col("doc_id").alias("_id"), F.col("fingerprint").alias("_fp"), "class_id")
    found = rows.join(classes, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("fingerprint") == F.col("_fp")), "left")
    return found.select(*rows.columns, F.coalesce("class_id", "doc_id").alias("class_id"))
