"""Temperature mixing of sources, realised as budgeted block permutations. DataFrame functions only.

Source weights are token shares raised to an exponent and normalised. The exponent is searched for by repeated subdivision of
its range: each round evaluates entropy and repetition at a grid of exponents in one aggregation over the source table and
keeps the cell where the target is met. Then every source gets weight * budget tokens: whole passes over all its documents,
and of one last pass as many documents, in a permuted order, as the rest of its budget holds. The permutation orders blocks of
documents by hash and documents by hash inside a block, anew in each pass; running token sums are taken over blocks first, so a
source of any size is never in one task. A slot of the mixed sequence takes the same fraction of every source's passes, so
slots hold the sources in proportion to their weights.

Without a budget it is the smallest that shows every document at least once. Tokens of a text are its blanks plus one.

Defined cases: null source is a source of its own; null and empty texts count one token; repeated rows are drawn each; rows of one
doc_id or of null ids are permuted like others, by their place in the input where there are many of them, and in the last pass
their content decides between a few; an empty table gives an empty result; other
columns are carried along under their own names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tetraframe.llm.common import content_key, copies_apart, stored, table

#: Documents of a block and blocks of a group on average; cells of a search round and rounds.
BLOCK, GROUP, GRID, ROUNDS = 512, 1024, 32, 6


def text_tokens(text: Column) -> Column:
    """Blanks of a text plus one."""
    t = F.coalesce(text, F.lit(""))
    return (F.char_length(t) - F.char_length(F.translate(t, " \n\t\r", "")) + 1).cast("long")


def _at(sources: DataFrame, exponents: list[float]) -> list[tuple[float, float, float]]:
    """(exponent, entropy, largest repetition over smallest) for each exponent."""
    grid = sources.select("share", F.explode(F.lit(exponents)).alias("a"))
    power, ratio = F.pow("share", F.col("a")), F.pow("share", F.col("a") - 1)
    rows = grid.groupBy("a").agg(F.sum(power).alias("z"), F.sum(power * F.ln("share")).alias("l"), F.max(ratio).alias("most"), F.min(ratio).alias("least")).collect()  # one row an exponent
    return sorted((r["a"], math.log(r["z"]) - r["a"] * r["l"] / r["z"], r["most"] / r["least"]) for r in rows)


def exponent(sources: DataFrame, entropy: float | None = None, repetition: float | None = None, highest: float = 4.0) -> float:
    """The largest exponent whose entropy (nats) reaches the target, or the smallest whose repetition stays within the limit.

    Repetition is how often the most repeated source is shown for one showing of the least repeated. Targets beyond the range
    give its end: 0 (all sources alike) for entropy, 1 (the shares themselves) for repetition.
    """
    low, high = 0.0, highest if entropy is not None else 1.0
    for _ in range(ROUNDS):
        if high - low < 1e-9:
            break
        found = _at(sources, [low + (high - low) * i / GRID for i in range(GRID + 1)])
        if entropy is not None:
            good = [i for i, x in enumerate(found) if x[1] >= entropy]
            i = good[-1] if good else 0
            low, high = found[i][0], found[min(i + 1, GRID)][0]
        else:
            good = [i for i, x in enumerate(found) if x[2] <= repetition * (1 + 1e-12)]
            i = good[0] if good else GRID
            low, high = found[max(i - 1, 0)][0], found[i][0]
    return low if entropy is not None else high


def source_weights(docs: DataFrame, entropy: float | None = None, repetition: float | None = None, budget: float | None = None) -> DataFrame:
    """(_source, tokens, documents, weight, exponent, passes): a row a source; docs: with _source and _tokens."""
    sums = docs.groupBy("_source").agg(F.sum("_tokens").alias("tokens"), F.count(F.lit(1)).alias("documents"))
    sums, _ = stored(sums, "sources")
    total = sums.agg(F.sum("tokens")).first()[0] or 1
    shares = sums.withColumn("share", F.col("tokens") / F.lit(float(total)))
    a = exponent(shares, entropy, repetition) if sums.take(1) else 1.0
    both = shares.agg(F.sum(F.pow("share", F.lit(a))).alias("z"), F.min(F.pow("share", F.lit(a - 1))).alias("least")).first()
    z = both["z"] or 1.0
    scale = (budget / total) if budget is not None else z / (both["least"] or 1.0)
    passes = F.pow("share", F.lit(a - 1)) * F.lit(scale / z)
    passes = F.when(F.abs(passes - F.rint(passes)) < 1e-9, F.rint(passes)).otherwise(passes)
    return shares.select("_source", "tokens", "documents", (F.pow("share", F.lit(a)) / z).alias("weight"), F.lit(a).alias("exponent"), passes.alias("passes"))


def running_before(blocks: DataFrame) -> DataFrame:
    """Add _before: tokens of a source's blocks before each one; sums over groups of blocks first, then inside a group."""
    blocks = blocks.withColumn("_group", F.floor(F.col("_block") / GROUP))
    inside = Window.partitionBy("_source", "_group").orderBy("_block")
    groups = blocks.groupBy("_source", "_group").agg(F.sum("_sum").alias("_gsum"))
    across = Window.partitionBy("_source").orderBy("_group")
    groups = groups.select("_source", "_group", (F.sum("_gsum").over(across) - F.col("_gsum")).alias("_gbefore"))
    return blocks.withColumn("_own", F.sum("_sum").over(inside) - F.col("_sum")).join(groups, ["_source", "_group"]).select("_source", "_block", (F.col("_own") + F.col("_gbefore")).alias("_before"))


def mixed(docs: DataFrame, entropy: float | None = None, repetition: float | None = 2.0, budget: float | None = None, slots: int = 1000, seed: int = 17, by: str = "source", tokens: str | None = None) -> DataFrame:
    """Rows of docs as often as the mixture shows them, with mix_pass (from 0), mix_slot of the sequence, mix_order inside the slot, mix_weight, mix_exponent.

    tokens: a column that holds each row's tokens; without it they are counted from text in each of the passes over docs.
    """
    names = docs.columns
    kept = [n for n in names]
    rows = docs.select(*(F.col(n).alias(f"_c{i}") for i, n in enumerate(kept)))
    content = content_key(rows, seed)
    c = {n: F.col(f"_c{i}") for i, n in enumerate(kept)}
    rows = rows.withColumn("_source", F.coalesce(F.concat(F.lit("="), c[by].cast("string")), F.lit(""))).withColumn("_tokens", c[tokens].cast("long") if tokens else text_tokens(c["text"]))
    weights, _ = stored(source_weights(rows.select("_source", "_tokens"), entropy, repetition, budget), "weights")
    weights = weights.withColumns({"_full": F.floor("passes").cast("int"), "_blocks": F.ceil(F.col("documents") / BLOCK)})
    block = lambda number: F.pmod(F.xxhash64(F.col("_key"), number), F.col("_blocks"))
    # Rows of one doc_id, null ids among them, would all be of one block: many of them are told apart by their places.
    rows, _ = copies_apart(rows.withColumn("_key", F.xxhash64(F.lit(seed), c["doc_id"], F.col("_source"))), "_key", F.lit(1), BLOCK // 4)
    rows = rows.withColumn("_key", F.when(F.col("_copy") == 0, F.col("_key")).otherwise(F.xxhash64("_key", "_copy"))).drop("_copy")
    rows = rows.join(weights, "_source").withColumn("_block", block(F.col("_full")))
    # The last pass: whole blocks while they fit, and in the block where the budget ends, documents while it isn't used up.
    slim = rows.select("_source", "_block", "_tokens").groupBy("_source", "_block").agg(F.sum("_tokens").alias("_sum"))
    rows = rows.join(running_before(slim), ["_source", "_block"])
    inside = Window.partitionBy("_source", "_block").orderBy(F.xxhash64(F.col("_key"), F.col("_full"), F.lit(1)), c["doc_id"], content).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_used", F.col("_before") + F.coalesce(F.sum("_tokens").over(inside), F.lit(0)))
    shown = F.col("_full") + (F.col("_used") < (F.col("passes") - F.col("_full")) * F.col("tokens") - 1e-6).cast("int")
    rows = rows.withColumn("_n", shown).where("_n > 0").withColumn("_pass", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    part = (F.col("_pass") + (block(F.col("_pass")) + 0.5) / F.col("_blocks")) / F.col("passes")
    rows = rows.withColumns({"_slot": F.floor(F.least(part, F.lit(0.999999)) * slots).cast("long"), "_order": F.xxhash64(F.col("_key"), F.col("_pass"), F.lit(2))})
    return rows.select(*(c[n].alias(n) for n in kept), F.col("_pass").cast("int").alias("mix_pass"), F.col("_slot").alias("mix_slot"), F.col("_order").alias("mix_order"), F.col("weight").alias("mix_weight"), F.col("exponent").alias("mix_exponent"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' sources mixed so that the smallest is shown at most twice for one showing of the largest."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", text_tokens(F.col("text")).alias("n_tokens"))
    docs, _ = stored(docs, "tokens")  # texts are read once
    return mixed(docs, repetition=2.0, tokens="n_tokens").select("doc_id", "source", *(F.col(f"mix_{c}").alias(c) for c in ("pass", "slot", "order", "weight", "exponent")))
