"""F-measures of link lists, their breakdowns, and drift figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BETA = 0.5


def f_beta(k: Column, m: Column, tp: Column, beta: float = BETA) -> Column:
    """1 if truth and list are empty, 0 without a hit."""
    b2 = beta * beta
    return F.when((k == 0) & (m == 0), 1.0).when(tp == 0, 0.0).otherwise((1 + b2) * tp / (b2 * k + m))


def per_entity(universe: DataFrame, truth: DataFrame, links: DataFrame, beta: float = BETA) -> DataFrame:
    """``(s1, k, m, tp, f)`` for every entity of ``universe``: one full pass over both link lists, one exchange by entity."""
    t = truth.select("s1", "mid").distinct().withColumn("t", F.lit(1))
    n = links.select("s1", "mid").distinct().withColumn("n", F.lit(1))
    both = t.join(n, ["s1", "mid"], "full").groupBy("s1").agg(F.count("t").alias("k"), F.count("n").alias("m"), F.sum(F.when(F.col("t").isNotNull() & F.col("n").isNotNull(), 1).otherwise(0)).alias("tp"))
    out = universe.select("s1").distinct().join(both, "s1", "left").na.fill(0, ["k", "m", "tp"])
    return out.withColumn("f", f_beta(F.col("k"), F.col("m"), F.col("tp"), beta))


def bucket(c: Column, most: int = 7) -> Column:
    return F.when(c >= most, F.lit(f"{most}+")).otherwise(c.cast("string"))


def rank_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the curve by the rank sum with average ranks; one row.

    Scores are counted first: the running sum goes over distinct scores, by ranges of the score, not over all rows.
    """
    by = df.groupBy(F.col(score).alias("x")).agg(F.sum(F.col(label).cast("long")).alias("pos"), F.count("*").alias("n"))
    # A running sum in two steps: within ranges, and of the ranges before (WIDTH rows).
    width = 256
    cut = F.floor(F.col("x") * width)
    within = Window.partitionBy("r").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    parts = by.withColumn("r", cut)
    totals = parts.groupBy("r").agg(F.sum("n").alias("size"))
    before = totals.select("r", F.coalesce(F.sum("size").over(Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    at = parts.join(before, "r").withColumn("rank", F.col("before") + F.coalesce(F.sum("n").over(within), F.lit(0)) + (F.col("n") + 1) / 2)
    s = at.agg(F.sum(F.col("rank") * F.col("pos")).alias("s"), F.sum("pos").alias("p"), F.sum("n").alias("n"))
    return s.select(((F.col("s") - F.col("p") * (F.col("p") + 1) / 2) / (F.col("p") * (F.col("n") - F.col("p")))).alias("auc"), F.col("p").alias("n_pos"), F.col("n").alias("n_all"))


def psi(df: DataFrame, bin_col: str, side_col: str, floor: float = 1e-4) -> DataFrame:
    """Population stability index of side 1 against side 0 over given bins; one row."""
    c = df.groupBy(bin_col).agg(F.sum(F.when(F.col(side_col) == 0, 1).otherwise(0)).alias("a"), F.sum(F.when(F.col(side_col) == 1, 1).otherwise(0)).alias("b"))
    total = c.agg(F.sum("a").alias("ta"), F.sum("b").alias("tb"))  # one row
    x = c.join(F.broadcast(total), F.lit(True)).select(F.greatest(F.col("a") / F.col("ta"), F.lit(floor)).alias("q"), F.greatest(F.col("b") / F.col("tb"), F.lit(floor)).alias("r"))
    return x.agg(F.sum((F.col("r") - F.col("q")) * F.log(F.col("r") / F.col("q"))).alias("psi"))
