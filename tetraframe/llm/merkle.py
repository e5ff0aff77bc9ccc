"""Merkle manifest of a table: a digest a row, a tree of digests a group, a tree over the groups, and each row's inclusion path.

Leaves are numbered inside their group in the order of a key. Level by level, a window over (group, parent number) with the
ordered full frame collects a run of nodes; the run gives the parent's preimage, and to each node its siblings. A run's first node
stands for the parent in the next level, so parents are distinct without another exchange. The groups' roots are the leaves of one
more tree. Paths go down again by joins from each level to the one below, whose sizes fall by the fanout. Texts are digested where
they are read and never move. DataFrame functions only.

Defined cases: a null field is "-", so it differs from an empty one; a null group is a group, the first; rows of null keys come first
in their group; rows of equal keys come in the order of their digests, and equal rows are leaves each; an empty table has no root
and gives an empty result; only the named columns are read, so extra ones don't matter, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tetraframe.llm.common import crc_mod, discard, stored, table

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_SHIFT = 33  # monotonically_increasing_id() holds the partition above the row's number in it


def sha(text: Column) -> Column:
    """Lower-case hexadecimal sha256 of a string's bytes."""
    return F.sha2(text, 256)


def field(value: Column) -> Column:
    """A value with its length in bytes in front; null is a dash."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    """The digest of a row's fields."""
    return sha(F.concat(*map(field, values)))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path give."""
    return F.aggregate(path, start, lambda digest, run: sha(F.concat(run["before"], digest, run["after"])))


def proof(path: Column) -> Column:
    """The digest of a path's siblings, leaf level first, each run from left to right."""
    return sha(F.array_join(F.transform(path, lambda run: F.concat(run["before"], run["after"])), ""))


def numbered(rows: DataFrame, by: list[str]) -> tuple[DataFrame, str]:
    """rows with `number`, a row's place in its `_group` from 0 in the order of `by`, and `of`, the group's rows; and the stored place.

    Sorted by ranges of (group, by), so no group meets in one task; the random last key only splits ranges of equal rows. Places in
    a part become places in a group by a table with a row a part and group.
    """
    ranged = rows.withColumn("_spread", F.rand(13)).repartitionByRange("_group", *by, "_spread")
    sorted_rows = ranged.sortWithinPartitions("_group", *by).drop("_spread").withColumn("_place", F.monotonically_increasing_id())
    kept, place = stored(sorted_rows, "leaves")
    part = F.shiftright("_place", _SHIFT)
    kept = kept.withColumn("_part", part)
    spans = kept.groupBy("_part", "_group").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy("_group")
    spans = spans.withColumns({"of": F.sum("_rows").over(whole), "_before": F.sum("_rows").over(whole.orderBy("_part")) - F.col("_rows")})
    found = kept.join(spans.drop("_rows"), ["_part", "_group"])
    return found.withColumn("number", F.col("_place") - F.col("_first") + F.col("_before")).drop("_place", "_part", "_first", "_before"), place


def tree(leaves: DataFrame, fanout: int = FANOUT) -> tuple[DataFrame, DataFrame, list[str]]:
    """From leaves (_group, number, of, digest, more columns): leaves with `path`, and (_group, digest) of the roots; and stored places.

    path: an array with the siblings before and after, from the leaf's run up to the root's. A lone leaf is its own root.
    """
    digits = max(leaves.agg(F.max("of")).first()[0] or 1, 1)
    run = Window.partitionBy("_group", "_parent").orderBy("number").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    at = F.pmod("number", F.lit(fanout)).cast("int")
    levels, places, nodes = [], [], leaves
    roots = nodes.where("of = 1").select("_group", "digest")
    while digits > 1:
        runs = nodes.where("of > 1").withColumn("_parent", F.floor(F.col("number") / fanout)).withColumn("_run", F.collect_list("digest").over(run))
        joined = lambda first, most: F.array_join(F.slice("_run", first, most), "")
        beside = F.struct(joined(F.lit(1), at).alias("before"), joined(at + 2, F.lit(fanout)).alias("after"))
        level, place = stored(runs.withColumns({"_beside": beside, "_above": sha(F.array_join("_run", ""))}).drop("_run"), "level")
        levels.append(level)
        places.append(place)
        parent_of = F.ceil(F.col("of") / fanout)
        nodes = level.where(F.pmod("number", F.lit(fanout)) == 0).select("_group", F.col("_parent").alias("number"), parent_of.alias("of"), F.col("_above").alias("digest"))
        roots = roots.unionByName(nodes.where("of = 1").select("_group", "digest"))
        digits = -(-digits // fanout)
    none = F.array().cast("array<struct<before:string,after:string>>")
    above = None
    for level in reversed(levels):
        path = F.array("_beside")
        if above is not None:
            upper = above.select(F.col("_group").alias("_g"), F.col("number").alias("_p"), F.col("path").alias("_upper"))
            level = level.join(upper, (F.col("_group") == F.col("_g")) & (F.col("_parent") == F.col("_p")), "left").drop("_g", "_p")
            path = F.concat(path, F.coalesce("_upper", none))
        above = level.withColumn("path", path).drop("_beside", "_above", "_parent", "_upper")
    lone = leaves.where("of = 1").withColumn("path", none)
    return (lone if above is None else above.unionByName(lone)), roots, places


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, by: str = "lang", key: str = "doc_id", fanout: int = FANOUT, more: dict[str, Column] | None = None) -> DataFrame:
    """(key, leaf, subroot, root, path) of every row, and the columns in `more`, computed from docs where texts are read.

    path goes from the leaf's run by the group's root to the table's: folded(leaf, path) is the root.
    """
    group = F.coalesce(F.concat(F.lit("1"), F.col(by).cast("string")), F.lit("0"))  # null first, then by bytes
    rows = docs.select(F.col(key).alias("_key"), group.alias("_group"), leaf(*(F.col(c) for c in fields)).alias("digest"), *(c.alias(n) for n, c in (more or {}).items()))
    leaves, first = numbered(rows, ["_key", "digest"])
    kept, place = stored(leaves, "numbered")
    discard(docs.sparkSession, first)
    inside, subroots, _ = tree(kept, fanout)
    names, _ = numbered(subroots.select(F.lit("").alias("_group"), F.col("_group").alias("_name"), "digest"), ["_name"])
    across, root, _ = tree(stored(names, "subroots")[0], fanout)
    tops = across.select(F.col("_name").alias("_group"), F.col("digest").alias("subroot"), F.col("path").alias("_top"))
    top = root.select(F.col("digest").alias("root"))  # one row
    tops, _ = stored(tops.crossJoin(F.broadcast(top)), "tops")
    found = inside.join(tops, "_group").withColumn("path", F.concat("path", "_top"))
    return found.select(F.col("_key").alias(key), F.col("digest").alias("leaf"), "subroot", "root", "path", *(more or {}))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests and proofs of all documents, and whether a row that may have been tampered with still leads to the root."""
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = leaf(*(low if c == "text" else F.col(c) for c in FIELDS))
    rows = manifest(docs, more={"_changed": F.when(crc_mod("doc_id", 3) == 0, changed)})
    rows = rows.withColumn("folded_root", folded(F.coalesce("_changed", "leaf"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR END"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(text if c == "text" else c) for c in FIELDS) + ")"


#: crc32 of the decimal doc_id, bit by bit: a byte comes in at every eighth step.
_CRC_SQL = """
xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
  lambda crc, byte: xor(xor(crc, byte) >> 1, 3988292384 * (xor(crc, byte) & 1))))
"""

OP13_SQL = f"""
WITH RECURSIVE
leaves AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS g, {_leaf_sql("text")} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {_CRC_SQL} % 3 = 0 THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
  FROM documents),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS n, count(*) OVER (PARTITION BY g) AS m FROM leaves),
nodes(g, level, n, m, digest) AS (
  SELECT g, 0, n, m, leaf FROM numbered
  UNION ALL
  SELECT g, level + 1, n // 8, (m + 7) // 8, sha256(string_agg(digest, '' ORDER BY n)) FROM nodes WHERE m > 1 GROUP BY g, level, n // 8, m),
subroots AS (
  SELECT g, digest, row_number() OVER (ORDER BY encode(g)) - 1 AS n, count(*) OVER () AS m FROM nodes WHERE m = 1),
upper_nodes(level, n, m, digest) AS (
  SELECT 0, n, m, digest FROM subroots
  UNION ALL
  SELECT level + 1, n // 8, (m + 7) // 8, sha256(string_agg(digest, '' ORDER BY n)) FROM upper_nodes WHERE m > 1 GROUP BY level, n // 8, m),
runs AS (
  SELECT g, level, n, coalesce(string_agg(digest, '') OVER (PARTITION BY g, level, n // 8 ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(digest, '') OVER (PARTITION BY g, level, n // 8 ORDER BY n ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM nodes WHERE m > 1),
upper_runs AS (
  SELECT level, n, coalesce(string_agg(digest, '') OVER (PARTITION BY level, n // 8 ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(digest, '') OVER (PARTITION BY level, n // 8 ORDER BY n ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM upper_nodes WHERE m > 1),
climbed(doc_id, leaf, g, place, level, n, digest, siblings) AS (
  SELECT doc_id, leaf, g, n, 0, n, coalesce(changed, leaf), '' FROM numbered
  UNION ALL
  SELECT c.doc_id, c.leaf, c.g, c.place, c.level + 1, c.n // 8, sha256(r.before || c.digest || r.after), c.siblings || r.before || r.after
  FROM climbed c JOIN runs r ON r.g = c.g AND r.level = c.level AND r.n = c.n),
inside AS (
  SELECT c.doc_id, c.leaf, s.digest AS subroot, s.n AS place, c.digest, c.siblings
  FROM climbed c JOIN subroots s ON s.g = c.g
  WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.g = c.g AND r.level = c.level)),
across(doc_id, leaf, subroot, level, n, digest, siblings) AS (
  SELECT doc_id, leaf, subroot, 0, place, digest, siblings FROM inside
  UNION ALL
  SELECT c.doc_id, c.leaf, c.subroot, c.level + 1, c.n // 8, sha256(r.before || c.digest || r.after), c.siblings || r.before || r.after
  FROM across c JOIN upper_runs r ON r.level = c.level AND r.n = c.n)
SELECT c.doc_id, c.leaf, c.subroot, u.digest AS root, sha256(c.siblings) AS proof_sha256, c.digest AS folded_root, c.digest = u.digest AS verified
FROM across c JOIN upper_nodes u ON u.m = 1 AND u.level = c.level
"""
