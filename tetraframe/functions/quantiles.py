"""Exact quantiles of a whole column of doubles, without a map of all distinct values in one task.

An approximate sketch brackets each quantile. One more pass counts the rows below and above each bracket and groups those inside by
value; only these, a few of each ten thousand rows, are ranked. The result is that of percentile().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, column: str | Column, shares: list[float], accuracy: int = 10_000) -> DataFrame:
    """One row: n, and q, the quantiles in order with linear interpolation; nulls don't count, and without values q holds nulls."""
    v = df.select((F.col(column) if isinstance(column, str) else column).cast("double").alias("_v")).where("_v IS NOT NULL")
    around = [min(max(p + d, 0.0), 1.0) for p in shares for d in (-2 / accuracy, 2 / accuracy)]
    ends = v.agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", around, accuracy).alias("_e"))  # one row
    rows = v.crossJoin(F.broadcast(ends)).withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(len(shares) - 1))))
    low, high = F.get("_e", 2 * F.col("_i")), F.get("_e", 2 * F.col("_i") + 1)
    side = F.when(F.col("_v") < low, -1).when(F.col("_v") > high, 1).otherwise(0)
    rows = rows.select("_i", "_n", "_v", side.alias("_s"))
    parts = rows.groupBy("_i", "_s", F.when(F.col("_s") == 0, F.col("_v")).alias("_in")).agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_min"), F.max("_v").alias("_max"), F.first("_n").alias("_n"))
    # Inside, ranks run over the values; the sides stand for one neighbour each, which a rounded rank may need.
    up = Window.partitionBy("_i").orderBy("_s", "_in").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("_up", F.sum("_c").over(up)).withColumn("_at", F.when(F.col("_s") < 0, F.col("_max")).otherwise(F.col("_min")))
    share = F.get(F.lit(shares), F.col("_i"))
    rank = (F.col("_n") - 1) * share
    value = lambda r: F.min_by("_at", F.when(F.col("_up") > r, F.col("_up")))
    found = parts.groupBy("_i").agg(value(F.floor(rank)).alias("_a"), value(F.ceil(rank)).alias("_b"), F.first(rank - F.floor(rank)).alias("_f"))
    found = found.select("_i", (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_f")).alias("_q"))
    every = found.agg(F.map_from_entries(F.collect_list(F.struct("_i", "_q"))).alias("_m"))  # an entry a share
    q = F.transform(F.sequence(F.lit(0), F.lit(len(shares) - 1)), lambda i: F.try_element_at("_m", i))
    return ends.crossJoin(every).select(F.col("_n").alias("n"), q.alias("q"))
