"""Candidate generation: capped key joins, TF-IDF top-k, caps and reserves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def capped_join(q: DataFrame, p: DataFrame, cap: int = 30, block_cap: int = 150) -> DataFrame:
    """``(qi, pi)`` from ``q(qi, key, blk)`` and ``p(pi, key, blk)``.

    A key of at most ``cap`` pool rows joins everywhere; a commoner one joins inside a block (not an empty one) that has
    at most ``block_cap`` of its rows. The counts come first, so neither join ever sees a hot key.
    """
    p = p.distinct()
    n = p.groupBy("key").agg(F.count("*").alias("n"))
    rare = q.join(n.where(F.col("n") <= cap).select("key"), "key", "left_semi").join(p.join(n.where(F.col("n") <= cap).select("key"), "key", "left_semi").select("key", "pi"), "key").select("qi", "pi")
    common = p.join(n.where(F.col("n") > cap).select("key"), "key", "left_semi").where("blk <> ''")
    fine = common.groupBy("key", "blk").agg(F.count("*").alias("n")).where(F.col("n") <= block_cap).select("key", "blk")
    inside = q.join(fine, ["key", "blk"], "left_semi").join(common.join(fine, ["key", "blk"], "left_semi"), ["key", "blk"]).select("qi", "pi")
    return rare.unionByName(inside).distinct()


def rarest(rows: DataFrame, owner: str, value: str, frequency: DataFrame, n: int) -> DataFrame:
    """Each owner's ``n`` values of the smallest ``df``; values without one are left out."""
    w = Window.partitionBy(owner).orderBy("df", value)
    return rows.join(frequency, value).withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n", "df")


def tfidf(grams: DataFrame, prune_share: float = 0.01, prune_floor: int = 200) -> DataFrame:
    """``(blk, id, side, gram, w, common)`` from ``(blk, id, side, gram)``: weights of unit length within a block.

    tf = ln(1 + count), idf = ln((1 + n) / (1 + df)) + 1. ``common`` marks grams in more than max(share * n, floor) records.
    """
    counts = grams.groupBy("blk", "id", "side", "gram").agg(F.count("*").alias("c"))
    n = grams.groupBy("blk").agg(F.count_distinct("id").alias("n"))
    df = counts.groupBy("blk", "gram").agg(F.count("*").alias("df")).join(n, "blk")
    x = counts.join(df, ["blk", "gram"]).withColumn("w", F.log1p("c") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("blk", "id")))
    return x.select("blk", "id", "side", "gram", (F.col("w") / F.when(norm > 0, norm).otherwise(1.0)).alias("w"), (F.col("df") > F.greatest(F.col("n") * prune_share, F.lit(prune_floor))).alias("common"))


def similar(weights: DataFrame, query: Column, k: int, least: float = 0.05) -> DataFrame:
    """``(blk, qi, pi, score, rank)``: each query's ``k`` best pool records by partial cosine in its block.

    Common grams are dropped from the query only, which bounds the join by the pruning frequency.
    """
    q = weights.where(query & ~F.col("common")).select("blk", "gram", F.col("id").alias("qi"), F.col("w").alias("wq"))
    p = weights.where(~query).select("blk", "gram", F.col("id").alias("pi"), F.col("w").alias("wp"))
    s = q.join(p, ["blk", "gram"]).groupBy("blk", "qi", "pi").agg(F.round(F.sum(F.col("wq") * F.col("wp")), 6).alias("score")).where(F.col("score") >= least)
    w = Window.partitionBy("blk", "qi").orderBy(F.desc("score"), "pi")
    return s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def union_passes(passes: dict[str, DataFrame]) -> DataFrame:
    """One row for each pair, with a flag for each pass that made it and ``n_passes``."""
    rows = None
    for name, df in passes.items():
        x = df.select("qi", "pi", F.lit(name).alias("pass"))
        rows = x if rows is None else rows.unionByName(x)
    flags = [F.bool_or(F.col("pass") == name).alias(f"p_{name}") for name in passes]
    return rows.groupBy("qi", "pi").agg(*flags, F.count_distinct("pass").alias("n_passes"))


def capped(pairs: DataFrame, cap: int, reserve: Column | None = None, spare: int = 0, prio: str = "prio") -> DataFrame:
    """The ``cap`` best of each entity, and up to ``spare`` more of those cut whose reserve value is above 0."""
    w = Window.partitionBy("s1").orderBy(F.desc(prio), "cand")
    x = pairs.withColumn("__at", F.row_number().over(w))
    if reserve is None or spare <= 0:
        return x.where(F.col("__at") <= cap).drop("__at")
    x = x.withColumn("__r", reserve.cast("int"))
    cut = Window.partitionBy("s1").orderBy(F.when((F.col("__at") > cap) & (F.col("__r") > 0), 0).otherwise(1), F.desc("__r"), F.desc(prio), "cand")
    x = x.withColumn("__c", F.row_number().over(cut))
    return x.where((F.col("__at") <= cap) | ((F.col("__r") > 0) & (F.col("__c") <= spare))).drop("__at", "__r", "__c")


def cosine_top_k(vectors: DataFrame, query: Column, k: int) -> DataFrame:
    """``(blk, qi, pi, score, rank)`` from ``(id, blk, v)``: exact cosines within a block, computed in the JVM."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    x = vectors.select("id", "blk", F.transform("v", lambda c: c.cast("double")).alias("v")).withColumn("n", norm).withColumn("q", query)
    q = x.where("q").select("blk", F.col("id").alias("qi"), F.col("v").alias("vq"), F.col("n").alias("nq"))
    p = x.where("NOT q").select("blk", F.col("id").alias("pi"), F.col("v").alias("vp"), F.col("n").alias("np"))
    dot = F.aggregate(F.zip_with("vq", "vp", lambda a, b: a * b), F.lit(0.0), lambda s, y: s + y)
    s = q.join(p, "blk").select("blk", "qi", "pi", F.round(dot / (F.col("nq") * F.col("np")), 6).alias("score"))
    w = Window.partitionBy("blk", "qi").orderBy(F.desc("score"), "pi")
    return s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
