"""Which candidates to link: thresholds, and lists of the best expected F."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from linkloom.operators import exclusivity

BETA = 0.5


def _all() -> WindowSpec:
    return Window.partitionBy("s1")


def _order() -> WindowSpec:
    return _all().orderBy(F.desc("p"), "cand")


def ranked(edges: DataFrame) -> DataFrame:
    """``rank`` from 0: p falling, then the smaller candidate."""
    return edges.withColumn("rank", F.row_number().over(_order()) - 1)


def threshold(edges: DataFrame, at: float = 0.5, fallback: float | None = None) -> DataFrame:
    """Selected if p >= ``at``, or if it is the first and p >= ``fallback``."""
    sel = F.col("p") >= at
    if fallback is not None:
        sel = sel | ((F.col("rank") == 0) & (F.col("p") >= fallback))
    return ranked(edges).withColumn("sel", sel)


def expected_lists(edges: DataFrame, kind: str = "series", missing: float = 0.0, beta: float = BETA, empty_bias: float = 1.0) -> DataFrame:
    """The list length of the best approximate expected F, as running sums over each entity's ranking.

    ``plugin`` is the ratio of the expectations; ``series`` adds second-order terms. ``missing``: expected true links outside the list.
    """
    b2 = beta * beta
    p = F.greatest(F.lit(0.0), F.least(F.col("p"), F.lit(1.0)))
    upto = _order().rowsBetween(Window.unboundedPreceding, 0)
    e = ranked(edges).select(
        "*", F.sum(p).over(upto).alias("__1"), F.sum(p * p).over(upto).alias("__2"), F.sum(p * p * p).over(upto).alias("__3"),
        (F.sum(p).over(_all()) + missing).alias("__mu"), (F.sum(p * (1 - p)).over(_all()) + missing).alias("__v"),
        F.exp(F.sum(F.log(F.greatest(1 - p, F.lit(1e-300)))).over(_all()) - missing).alias("__0"),
    )
    m = F.col("rank") + 1
    if kind == "plugin":
        ef = (1 + b2) * F.col("__1") / (m + b2 * F.col("__mu"))
    else:
        c = m + b2 * (1 + F.col("__mu"))
        ef = (1 + b2) * (F.col("__1") / c + b2 * F.col("__2") / (c * c) + b2 * b2 * (F.col("__v") * F.col("__1") - F.col("__2") + 2 * F.col("__3")) / (c * c * c))
    # Sums in another order differ in the last digits: ties are judged on rounded values.
    e = e.withColumn("ef", ef).withColumn("__ef", F.round("ef", 9)).withColumn("__max", F.max("__ef").over(_all()))
    e = e.withColumn("__at", F.min(F.when(F.col("__ef") == F.col("__max"), F.col("rank"))).over(_all()))
    sel = ~(F.round(F.col("__0") * empty_bias, 9) >= F.col("__max")) & (F.col("rank") <= F.col("__at"))
    return e.withColumn("sel", sel).drop("__1", "__2", "__3", "__mu", "__v", "__0", "__ef", "__max", "__at")


def poisson(rate: np.ndarray, size: int) -> np.ndarray:
    """Poisson probabilities of 0 .. size - 1; the last takes the rest."""
    k = np.arange(size)
    log_k = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, size)))))
    rate = np.maximum(np.asarray(rate, np.float64), 0.0)[:, None]
    out = np.where(rate > 0, np.exp(k * np.log(np.where(rate > 0, rate, 1.0)) - rate - log_k), (k == 0) * 1.0)
    out[:, -1] += np.maximum(0.0, 1 - out.sum(1))
    return out


def expected_f(p: np.ndarray, background: np.ndarray, beta: float = BETA) -> np.ndarray:
    """Exact E[F] of taking the first m of each row of falling probabilities, for m = 0 .. L.

    Each row's truth: independent hits with probabilities p, and a number outside the list with law ``background``. For
    each m the number of hits within the first m and that of all other hits are independent; F depends on the two alone.
    """
    rows, length = p.shape
    b2 = beta * beta
    after = [background]
    for j in reversed(range(length)):
        law = np.pad(after[-1], ((0, 0), (0, 1)))
        after.append(law * (1 - p[:, [j]]) + np.roll(law, 1, axis=1) * p[:, [j]])
    after.reverse()
    within = np.ones((rows, 1))
    out = np.zeros((rows, length + 1))
    out[:, 0] = np.prod(1 - p, axis=1) * background[:, 0]
    for m in range(1, length + 1):
        law = np.pad(within, ((0, 0), (0, 1)))
        within = law * (1 - p[:, [m - 1]]) + np.roll(law, 1, axis=1) * p[:, [m - 1]]
        hits, rest = np.arange(m + 1)[:, None], np.arange(after[m].shape[1])[None, :]
        f = (1 + b2) * hits / (b2 * (hits + rest) + m)
        out[:, m] = np.einsum("ra,ab,rb->r", within, f, after[m])
    return out


def exact_lists(edges: DataFrame, missing: float = 0.0, length: int = 16, outside: int = 12, beta: float = BETA, empty_bias: float = 1.0) -> DataFrame:
    """``(s1, m_star, p_empty, ef)``: the best list length by the exact expectation; ties go to the shorter.

    Rows beyond ``length`` add their p to the rate of links outside the list. Lists are arrays of ``length`` at most.
    """
    head = F.col("rank") < length
    lists = ranked(edges).groupBy("s1").agg(
        F.sort_array(F.collect_list(F.when(head, F.least(F.greatest("p", F.lit(0.0)), F.lit(1.0)))), asc=False).alias("ps"),
        (F.coalesce(F.sum(F.when(~head, F.col("p"))), F.lit(0.0)) + missing).alias("rate"),
    )

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            p = np.zeros((len(b), length))
            for i, x in enumerate(b.ps):
                p[i, : len(x)] = x
            ef = expected_f(p, poisson(b.rate.to_numpy(), outside), beta)
            biased = ef.copy()
            biased[:, 0] *= empty_bias
            biased[np.arange(length + 1)[None, :] > b.ps.map(len).to_numpy()[:, None]] = -1
            at = np.argmax(biased, axis=1)
            yield pd.DataFrame({"s1": b.s1, "m_star": at.astype(np.int32), "p_empty": ef[:, 0], "ef": ef[np.arange(len(b)), at]})

    kind = edges.schema["s1"].dataType.simpleString()
    return lists.mapInPandas(run, f"s1 {kind}, m_star int, p_empty double, ef double")


def decide_exact(edges: DataFrame, **how: float) -> DataFrame:
    best = exact_lists(edges, **how).select("s1", "m_star")
    return ranked(edges).join(best, "s1").withColumn("sel", F.col("rank") < F.col("m_star")).drop("m_star")


def resolve(edges: DataFrame, decide: Callable[[DataFrame], DataFrame] = expected_lists, exclusive: str = "soft", rounds: int = 2) -> DataFrame:
    """Exclusivity, decision, repair, and the one-owner guarantee: ``(s1, cand, p, sel)``.

    In a repair round, selected claims that a better selected claim contests are taken out, and only the entities that
    lose one decide again.
    """
    e = edges.select("s1", "cand", "p")
    e = exclusivity.soft(e) if exclusive == "soft" else exclusivity.hard(e) if exclusive == "hard" else e
    d = decide(e).select("s1", "cand", "p", "sel")
    claims = Window.partitionBy("cand")
    for _ in range(rounds):
        best, n = F.max(F.when(F.col("sel"), F.col("p"))).over(claims), F.sum(F.col("sel").cast("int")).over(claims)
        d = d.withColumn("__lost", F.col("sel") & (n > 1) & (F.col("p") < best))
        d = d.withColumn("__again", F.max("__lost").over(_all()))
        redone = decide(d.where("__again AND NOT __lost").select("s1", "cand", "p")).select("s1", "cand", "p", "sel")
        d = d.where("NOT __again").select("s1", "cand", "p", "sel").unionByName(redone)
    return exclusivity.one_owner(d)
