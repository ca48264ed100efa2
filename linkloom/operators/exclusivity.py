"""At most one owner for each candidate record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPS = 1e-6


def odds(p: Column, eps: float = EPS) -> Column:
    x = F.greatest(F.lit(0.0), F.least(p, F.lit(1 - eps)))
    return x / (1 - x)


def soft(edges: DataFrame, outside: DataFrame | None = None) -> DataFrame:
    """p becomes o / (1 + all claimants' odds); ``outside`` (cand, odds) adds claims that are not in the frame.

    Odds are added up in each task before they meet, so a candidate that everyone claims is no hot key; its edges are
    dealt anew by adaptive execution, as both sides of the join are plain exchanges.
    """
    every = edges.select("cand", odds(F.col("p")).alias("odds"))
    every = every if outside is None else every.unionByName(outside.select("cand", "odds"))
    total = every.groupBy("cand").agg(F.sum("odds").alias("__all"))
    return edges.join(total, "cand").withColumn("p", odds(F.col("p")) / (1 + F.col("__all"))).drop("__all").select(*edges.columns)


def _leaders(edges: DataFrame) -> DataFrame:
    """``(cand, __s1, __lead)``: the best claimant (of equal p the smallest entity) and its lead over the next."""
    first = edges.groupBy("cand").agg(F.min_by("s1", F.struct(-F.col("p"), "s1")).alias("__s1"), F.max("p").alias("__p"))
    second = edges.join(first, "cand").where("s1 <> __s1").groupBy("cand").agg(F.max("p").alias("__2"))
    return first.join(second, "cand", "left").select("cand", "__s1", (F.col("__p") - F.coalesce("__2", F.lit(0.0))).alias("__lead"))


def hard(edges: DataFrame, margin: float = 0.0, drop: bool = True) -> DataFrame:
    """Only the best claim of each candidate, and only if it leads by ``margin``; others go, or keep p = 0."""
    x = edges.join(_leaders(edges), "cand")
    keep = (F.col("s1") == F.col("__s1")) & (F.col("__lead") >= margin)
    out = x.where(keep) if drop else x.withColumn("p", F.when(keep, F.col("p")).otherwise(0.0))
    return out.select(*edges.columns)


def one_owner(edges: DataFrame) -> DataFrame:
    """Of the selected claims (``sel``) of a candidate only the best stays selected."""
    best = edges.where("sel").groupBy("cand").agg(F.min_by("s1", F.struct(-F.col("p"), "s1")).alias("__s1"))
    x = edges.join(best, "cand", "left")
    return x.withColumn("sel", F.col("sel") & F.coalesce(F.col("s1") == F.col("__s1"), F.lit(False))).select(*edges.columns)
