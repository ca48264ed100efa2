"""Priors by relation class, and label-free adaptation of scores to another mix."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.operators.exclusivity import odds

#: Bins of the logit histogram that the fixed point runs on, and its range.
BINS, REACH = 4096, 16.0


def source_priors(pairs: DataFrame) -> DataFrame:
    """By country and class, and pooled (``*``): n, pairs_per_s1, prior (mean label), mean_p. One pass with grouping sets."""
    g = pairs.groupingSets([["country", "hn_rel"], ["hn_rel"]], "country", "hn_rel").agg(
        F.count("*").alias("n"), (F.count("*") / F.count_distinct("s1")).alias("pairs_per_s1"), F.avg("label").alias("prior"), F.avg("p").alias("mean_p"), F.grouping("country").alias("pooled")
    )
    return g.withColumn("country", F.when(F.col("pooled") == 1, F.lit("*")).otherwise(F.col("country"))).drop("pooled")


def density_priors(source: DataFrame, target: DataFrame) -> DataFrame:
    """prior_t = prior_s times the ratio of pairs for each entity, source to target."""
    per = lambda df, *more: df.groupBy("hn_rel").agg((F.count("*") / F.count_distinct("s1")).alias("d"), *more)
    s = per(source, F.avg("label").alias("prior_s")).withColumnRenamed("d", "ds").where("prior_s > 0 AND prior_s < 1")
    return s.join(per(target), "hn_rel").withColumn("prior_t", F.greatest(F.lit(1e-9), F.least(F.col("prior_s") * F.col("ds") / F.col("d"), F.lit(1 - 1e-9))))


def em_prior(p: np.ndarray, weight: np.ndarray, prior: float, most: int = 5000, tol: float = 1e-10) -> tuple[float, int]:
    """The prior whose re-weighted scores average to itself."""
    now = prior
    for n in range(1, most + 1):
        a, b = p * now / prior, (1 - p) * (1 - now) / (1 - prior)
        new = float(np.sum(weight * a / (a + b)) / np.sum(weight))
        if abs(new - now) < tol:
            return new, n
        now = new
    return now, most


def em_estimates(source: DataFrame, target: DataFrame, least: int = 200, shrink: float = 2000.0, most_factor: float = 4.0, raise_allowed: bool = False) -> DataFrame:
    """By class: prior_s, prior_raw (fixed point), prior_t (shrunk) and the odds factor within 1/most_factor .. 1 (or most_factor).

    The driver sees histograms only: BINS rows for each class at most.
    """
    spark = source.sparkSession
    x = F.least(F.greatest(F.col("p"), F.lit(1e-7)), F.lit(1 - 1e-7))
    at = F.least(F.greatest(F.floor((F.log(x / (1 - x)) + REACH) * BINS / (2 * REACH)), F.lit(0)), F.lit(BINS - 1)).cast("int")
    prior = {r.hn_rel: r.prior for r in source.groupBy("hn_rel").agg(F.avg("label").alias("prior")).collect()}
    bins = target.groupBy("hn_rel", at.alias("at")).agg(F.count("*").alias("n"), F.avg("p").alias("p")).orderBy("hn_rel", "at").collect()
    rows = []
    for rel in sorted({r.hn_rel for r in bins}):
        n = np.array([r.n for r in bins if r.hn_rel == rel], np.float64)
        p = np.array([r.p for r in bins if r.hn_rel == rel])
        s, total = prior.get(rel), float(n.sum())
        if s is None or not 0 < s < 1 or total < least:
            rows.append((rel, int(total), s, None, s, 1.0))
            continue
        raw, _ = em_prior(p, n, s)
        w = total / (total + shrink)
        t = w * raw + (1 - w) * s
        factor = (t / (1 - t)) / (s / (1 - s))
        factor = min(max(factor, 1 / most_factor), most_factor if raise_allowed else 1.0)
        t = s * factor / (1 - s + s * factor)
        rows.append((rel, int(total), s, round(raw, 9), round(t, 9), round(factor, 9)))
    return spark.createDataFrame(rows, "hn_rel string, n long, prior_s double, prior_raw double, prior_t double, factor double")


def targeted_rule(links: DataFrame, hard: list[str], exact: list[str], below: float = 0.99) -> DataFrame:
    """Drops links of the hard classes under ``below`` where the entity also has a link of an exact class."""
    has = F.max(F.col("hn_rel").isin(exact)).over(Window.partitionBy("s1"))
    return links.withColumn("__has", has).where(~(F.col("hn_rel").isin(hard) & (F.col("p") < below) & F.col("__has"))).drop("__has")


def class_profile(pairs: DataFrame, hard: list[str], at: float = 0.5) -> DataFrame:
    """Pairs, score mass and links by class, per entity; and the row HARD over the hard classes. Rows are counted once."""
    by = pairs.groupBy("hn_rel").agg(F.count("*").alias("n"), F.sum("p").alias("s"), F.sum((F.col("p") >= at).cast("int")).alias("l"))
    by = by.select(F.explode(F.when(F.col("hn_rel").isin(hard), F.array("hn_rel", F.lit("HARD"))).otherwise(F.array("hn_rel"))).alias("hn_rel"), "n", "s", "l")
    total = pairs.agg(F.count_distinct("s1").alias("u"))  # one row
    return by.groupBy("hn_rel").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("l").alias("l")).join(F.broadcast(total), F.lit(True)).select("hn_rel", (F.col("n") / F.col("u")).alias("pairs"), (F.col("s") / F.col("u")).alias("mass"), (F.col("l") / F.col("u")).alias("links"))


__all__ = ["source_priors", "density_priors", "em_prior", "em_estimates", "targeted_rule", "class_profile", "odds"]
