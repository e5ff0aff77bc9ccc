"""Katz backoff models of any order as stored n-gram tables, for texts that come later.

The model that `katz` evaluates in one go over a corpus, here as tables that stay: for each order k the distinct (context, word) pairs
of training texts with count and probability, and the contexts with their backoff weights, partitioned by a hash of the context.
Other texts are scored by one left join a level: the longest context that was seen with the word, else its weight times the next
shorter one's probability. All steps are DataFrame operations; rows follow the tokens.

Words and ends are as in `katz`: A-Z lower-cased, runs of anything but white space, one end a text; contexts before a text's start are
ends. Discounts and the unigram level are the same too.

Defined cases: null text is the empty text, one token; without training tokens every token has probability one; repeated rows are
scored each; columns other than text are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tetraframe.llm.common import stored
from tetraframe.llm.katz import MOST, discounts

#: Folders of contexts by hash.
BUCKETS = 16
#: The end of a text among its words, which are never empty.
END = ""


def tokens(docs: DataFrame, order: int) -> DataFrame:
    """(_row, word, c1 .. c<order-1>): a row a token, with the contexts of 1 to order - 1 tokens before it, joined by blanks. docs: _row, text."""
    low = F.translate(F.coalesce(F.col("text"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(low, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("_row", F.concat(F.array_repeat(F.lit(END), order - 1), words, F.array(F.lit(END))).alias("_w"))
    at = F.explode(F.sequence(F.lit(order), F.size("_w"))).alias("_i")
    rows = rows.select("_row", "_w", at)
    return rows.select("_row", F.element_at("_w", F.col("_i")).alias("word"), *(F.array_join(F.slice("_w", F.col("_i") - k, F.lit(k)), " ").alias(f"c{k}") for k in range(1, order)))


def train(docs: DataFrame, order: int = 3) -> tuple[list[DataFrame], list[DataFrame], dict[str, float]]:
    """Tables (context, word, n, p) and (context, alpha) by order, and the corpus's tokens, types and share of unseen words."""
    rows, _ = stored(tokens(docs.withColumn("_row", F.lit(0)), order), "tokens")
    one, _ = stored(rows.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "words")
    sums = one.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types"), F.count_if(F.col("n") == 1).alias("once")).first()
    total = sums["n"] or 0
    unseen = min(0.5, max(sums["once"], 1) / total) if total else 1.0
    lower = one.select(F.lit("").alias("context"), "word", "n", ((1 - unseen) * F.col("n") / max(total, 1)).alias("p"))
    grams, alphas = [lower], []
    for k in range(1, order):
        seen, _ = stored(rows.groupBy(F.col(f"c{k}").alias("context"), "word").agg(F.count(F.lit(1)).alias("n")), "grams")
        many = {r["n"]: r["k"] for r in seen.where(F.col("n") <= MOST + 1).groupBy("n").agg(F.count(F.lit(1)).alias("k")).collect()}  # MOST + 1 rows
        d = F.get(F.lit(discounts([many.get(j, 0) for j in range(1, MOST + 2)]).tolist()), F.least(F.col("n"), F.lit(MOST + 1)).cast("int"))
        # The same word after the context without its first token, which was seen as well.
        shorter = F.when(F.instr("context", " ") > 0, F.substring_index("context", " ", -(k - 1))).otherwise("") if k > 1 else F.lit("")
        below = lower.select(F.col("context").alias("_s"), F.col("word").alias("_w"), F.col("p").alias("_q"))
        both = seen.withColumns({"_kept": d * F.col("n"), "_c": shorter}).join(below, (F.col("_c") == F.col("_s")) & (F.col("word") == F.col("_w")))
        own = both.groupBy("context").agg(F.sum("n").alias("_n"), F.sum("_kept").alias("_k"), F.sum("_q").alias("_q"))
        bare = 1 - F.col("_k") / F.col("_n") <= 1e-12
        # A context all of whose followers keep their counts would leave nothing: its count is raised by a half, which is left.
        times = F.when(bare, F.col("_n") + 0.5).otherwise(F.col("_n"))
        left = F.when(bare, 0.5 / (F.col("_n") + 0.5)).otherwise(1 - F.col("_k") / F.col("_n"))
        own, _ = stored(own.select("context", times.alias("_t"), (left / F.greatest(1 - F.col("_q"), F.lit(1e-300))).alias("alpha")), "contexts")
        lower, _ = stored(both.select("context", "word", "n", "_kept").join(own, "context").select("context", "word", "n", (F.col("_kept") / F.col("_t")).alias("p")), "grams")
        grams.append(lower)
        alphas.append(own.select("context", "alpha"))
    return grams, alphas, {"tokens": float(total), "types": float(sums["types"]), "unseen": unseen}


def save(model: tuple[list[DataFrame], list[DataFrame], dict[str, float]], path: str) -> None:
    """The tables of a model, by order and hash of the context."""
    grams, alphas, facts = model
    bucket = F.pmod(F.xxhash64("context"), F.lit(BUCKETS)).cast("int")
    for kind, tables in (("grams", grams), ("contexts", alphas)):
        for k, t in enumerate(tables):
            t.withColumn("bucket", bucket).repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/{kind}{k}")
    grams[0].sparkSession.createDataFrame([(k, v) for k, v in facts.items()], "name string, value double").write.parquet(f"{path}/facts")


def load(spark: SparkSession, path: str, order: int) -> tuple[list[DataFrame], list[DataFrame], dict[str, float]]:
    """A stored model."""
    read = lambda name: spark.read.parquet(f"{path}/{name}").drop("bucket")
    return [read(f"grams{k}") for k in range(order)], [read(f"contexts{k}") for k in range(order - 1)], {r["name"]: r["value"] for r in read("facts").collect()}


def scored(docs: DataFrame, model: tuple[list[DataFrame], list[DataFrame], dict[str, float]]) -> DataFrame:
    """docs with n_tokens and score, the log10 probability of the text."""
    grams, alphas, facts = model
    order = len(grams)
    kept, _ = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "docs")
    rows = tokens(kept.select("_row", "text"), order)
    unseen = F.lit(facts["unseen"]) if facts["tokens"] else F.lit(1.0)
    rows = rows.join(grams[0].select("word", F.col("p").alias("_p")), "word", "left").withColumn("_p", F.coalesce("_p", unseen))
    for k in range(1, order):
        same: Column = F.col(f"c{k}")
        seen = grams[k].select(F.col("context").alias("_c"), F.col("word").alias("_w"), F.col("p").alias("_q"))
        rows = rows.join(seen, (same == F.col("_c")) & (F.col("word") == F.col("_w")), "left").drop("_c", "_w")
        rows = rows.join(alphas[k - 1].select(F.col("context").alias("_c"), F.col("alpha").alias("_a")), same == F.col("_c"), "left").drop("_c")
        rows = rows.withColumn("_p", F.coalesce(F.col("_q"), F.coalesce("_a", F.lit(1.0)) * F.col("_p"))).drop("_q", "_a")
    sums = rows.groupBy("_row").agg(F.count(F.lit(1)).alias("n_tokens"), F.sum(F.log10("_p")).alias("score"))
    return kept.join(sums, "_row").drop("_row")
