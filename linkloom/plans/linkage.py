"""Decision, exclusivity, collective and metric queries over the edge view."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.functions import numbers
from linkloom.operators import adaptation, candidates, decision, exclusivity, features, metrics
from linkloom.plans.views import EDGES, edges, truth

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query and, where there is one, its SQL twin (``{E}`` stands for the edge view)."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql.replace("{E}", EDGES)
        return f

    return add


def r6(*names: str) -> list:
    return [F.round(n, 6).alias(n) for n in names]


_SOFT = "o AS (SELECT *, least(p, 1 - 1e-6) / (1 - least(p, 1 - 1e-6)) AS o FROM e), s AS (SELECT s1, cand, label, o / (1 + sum(o) OVER (PARTITION BY cand)) AS p FROM o)"


@query("WITH {E}, " + _SOFT + " SELECT s1, cand, round(p, 6) AS p FROM s")
def soft_exclusivity(spark, sf):
    return exclusivity.soft(edges(spark, sf)).select("s1", "cand", *r6("p"))


@query("""WITH {E}, x AS (SELECT cand, sum(least(p, 1 - 1e-6) / (1 - least(p, 1 - 1e-6))) AS m FROM e WHERE s1 % 5 = 0 GROUP BY cand),
o AS (SELECT *, least(p, 1 - 1e-6) / (1 - least(p, 1 - 1e-6)) AS o FROM e WHERE s1 % 5 <> 0)
SELECT s1, cand, round(o / (1 + sum(o) OVER (PARTITION BY cand) + coalesce(m, 0)), 6) AS p FROM o LEFT JOIN x USING (cand)""")
def soft_exclusivity_outside(spark, sf):
    e = edges(spark, sf)
    out = e.where("s1 % 5 = 0").select("cand", exclusivity.odds(F.col("p")).alias("odds"))
    return exclusivity.soft(e.where("s1 % 5 <> 0"), out).select("s1", "cand", *r6("p"))


@query("""WITH {E}, r AS (SELECT *, row_number() OVER w AS n, coalesce(lead(p) OVER w, 0) AS q FROM e WINDOW w AS (PARTITION BY cand ORDER BY p DESC, s1))
SELECT s1, cand, p FROM r WHERE n = 1 AND p - q >= 0.05""")
def hard_exclusivity_margin(spark, sf):
    return exclusivity.hard(edges(spark, sf), 0.05).select("s1", "cand", "p")


@query("""WITH {E}, r AS (SELECT *, row_number() OVER w AS n, coalesce(lead(p) OVER w, 0) AS q FROM e WINDOW w AS (PARTITION BY cand ORDER BY p DESC, s1))
SELECT s1, cand, CASE WHEN n = 1 AND p - q >= 0.05 THEN p ELSE 0 END AS p FROM r""")
def hard_exclusivity_zeroed(spark, sf):
    return exclusivity.hard(edges(spark, sf), 0.05, drop=False).select("s1", "cand", "p")


_THR = "t AS (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY p DESC, cand) - 1 AS rank FROM e), d AS (SELECT *, p >= 0.8 OR (rank = 0 AND p >= 0.3) AS sel FROM t)"
_ONE = _THR + ", g AS (SELECT *, row_number() OVER (PARTITION BY cand ORDER BY sel DESC, p DESC, s1) AS n FROM d), l AS (SELECT s1, cand AS mid, p FROM g WHERE sel AND n = 1)"


@query("WITH {E}, " + _THR + " SELECT s1, cand, p, CAST(rank AS INTEGER) AS rank, sel FROM d")
def threshold_fallback(spark, sf):
    return decision.threshold(edges(spark, sf), 0.8, 0.3).select("s1", "cand", "p", F.col("rank").cast("int").alias("rank"), "sel")


def links(spark, sf):
    return exclusivity.one_owner(decision.threshold(edges(spark, sf), 0.8, 0.3)).where("sel").select("s1", F.col("cand").alias("mid"), "p")


@query("WITH {E}, " + _ONE + " SELECT s1, mid, p FROM l")
def one_owner_guarantee(spark, sf):
    return links(spark, sf)


_EF = """t AS (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY p DESC, cand) AS m FROM e),
x AS (SELECT *, sum(p) OVER u AS a, sum(p * p) OVER u AS b, sum(p * p * p) OVER u AS c, sum(p) OVER g AS mu, sum(p * (1 - p)) OVER g AS v,
  round(exp(sum(ln(greatest(1 - p, 1e-300))) OVER g), 9) AS z
  FROM t WINDOW u AS (PARTITION BY s1 ORDER BY p DESC, cand ROWS UNBOUNDED PRECEDING), g AS (PARTITION BY s1)),
f AS (SELECT *, FORMULA AS ef, round(FORMULA, 9) AS ef9 FROM x),
h AS (SELECT *, max(ef9) OVER (PARTITION BY s1) AS top FROM f), k AS (SELECT *, min(CASE WHEN ef9 = top THEN m END) OVER (PARTITION BY s1) AS best FROM h)
SELECT s1, cand, round(ef, 6) AS ef, (NOT (z >= top)) AND m <= best AS sel FROM k"""


@query("WITH {E}, " + _EF.replace("FORMULA", "1.25 * a / (m + 0.25 * mu)"))
def ef_plugin(spark, sf):
    return decision.expected_lists(edges(spark, sf), "plugin").select("s1", "cand", *r6("ef"), "sel")


@query("WITH {E}, " + _EF.replace("FORMULA", "1.25 * (a / (m + 0.25 * (1 + mu)) + 0.25 * b / pow(m + 0.25 * (1 + mu), 2) + 0.0625 * (v * a - b + 2 * c) / pow(m + 0.25 * (1 + mu), 3))"))
def ef_series(spark, sf):
    return decision.expected_lists(edges(spark, sf), "series").select("s1", "cand", *r6("ef"), "sel")


@query()
def ef_exact(spark, sf):
    return decision.exact_lists(edges(spark, sf)).select("s1", "m_star", *r6("p_empty", "ef"))


@query()
def conflict_repair(spark, sf):
    return decision.resolve(edges(spark, sf)).select("s1", "cand", *r6("p"), "sel")


@query("""WITH {E}, x AS (SELECT *, least(greatest(p, 1e-6), 1 - 1e-6) AS q FROM e)
SELECT s1, cand, round(ln(q / (1 - q)), 6) AS logit, CAST(row_number() OVER o - 1 AS INTEGER) AS w_rank, round(p - max(p) OVER g, 6) AS w_gap_top,
  round(p - lead(p, 1, 0.0) OVER o, 6) AS w_gap_next, round(lag(p, 1, 1.0) OVER o - p, 6) AS w_gap_prev,
  CAST(count(*) FILTER (WHERE p > 0.5) OVER g AS BIGINT) AS w_n05, CAST(count(*) FILTER (WHERE p > 0.2) OVER g AS BIGINT) AS w_n02,
  round(sum(p) OVER g, 6) AS w_sum, count(*) OVER g AS w_ncand, max(p) OVER g AS w_top1,
  coalesce(nth_value(p, 2) OVER (PARTITION BY s1 ORDER BY p DESC, cand ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0) AS w_top2, round(sum(p) OVER g - p, 6) AS w_sum_other
FROM x WINDOW o AS (PARTITION BY s1 ORDER BY p DESC, cand), g AS (PARTITION BY s1)""")
def within_s1_features(spark, sf):
    e = features.within(edges(spark, sf))
    return e.select("s1", "cand", *r6("logit"), F.col("w_rank").cast("int").alias("w_rank"), *r6("w_gap_top", "w_gap_next", "w_gap_prev"), "w_n05", "w_n02", *r6("w_sum"), "w_ncand", "w_top1", "w_top2", *r6("w_sum_other"))


@query("""WITH {E}, x AS (SELECT *, least(p, 1 - 1e-6) / (1 - least(p, 1 - 1e-6)) AS o FROM e),
y AS (SELECT *, count(*) OVER c AS n, sum(p) OVER c AS t, sum(o) OVER c AS os, count(*) FILTER (WHERE p > 0.3) OVER c AS n03, row_number() OVER k AS a, max(p) OVER c AS top,
  coalesce(nth_value(p, 2) OVER (PARTITION BY cand ORDER BY p DESC, s1 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0) AS second
  FROM x WINDOW c AS (PARTITION BY cand), k AS (PARTITION BY cand ORDER BY p DESC, s1)),
z AS (SELECT *, CASE WHEN a = 1 THEN second ELSE top END AS other FROM y)
SELECT s1, cand, n - 1 AS c_n_other, round(other, 6) AS c_other_max, round(p - other, 6) AS c_margin, CAST(n03 - CASE WHEN p > 0.3 THEN 1 ELSE 0 END AS BIGINT) AS c_n_other03,
  round(least(p / greatest(t, 1e-6), 1), 6) AS c_share, round(o / (1 + os), 6) AS c_soft, round(greatest(t - p, 0), 6) AS c_sum_other, a = 1 AS c_is_best FROM z""")
def competition_features(spark, sf):
    e = features.competition(edges(spark, sf))
    return e.select("s1", "cand", "c_n_other", *r6("c_other_max", "c_margin"), F.col("c_n_other03").cast("long").alias("c_n_other03"), *r6("c_share", "c_soft", "c_sum_other"), "c_is_best")


@query("""WITH {E}, g AS (SELECT *, max(p) OVER (PARTITION BY cand) AS t FROM e),
h AS (SELECT *, count(*) FILTER (WHERE p = t) OVER (PARTITION BY cand) AS n, max(p) FILTER (WHERE p < t) OVER (PARTITION BY cand) AS u FROM g)
SELECT s1, cand, t AS best, round(p - CASE WHEN p < t OR n > 1 THEN t ELSE coalesce(u, 0) END, 6) AS gap, p = t AS is_best FROM h""")
def tie_symmetric_competition(spark, sf):
    return features.tie_symmetric(edges(spark, sf), "p").select("s1", "cand", "best", *r6("gap"), "is_best")


def _rescored(e):
    return e.withColumn("p1", F.col("p")).withColumn("p2", F.round((F.sqrt("p") + F.col("label")) / 2, 6)).withColumn("mm", (F.col("s1") + F.col("cand")) % 3 == 0)


_P2 = "x AS (SELECT *, p AS p1, round((sqrt(p) + label) / 2, 6) AS p2, (s1 + cand) % 3 = 0 AS mm FROM e)"


@query("WITH {E}, " + _P2 + " SELECT s1, cand, CASE WHEN mm THEN least(p1, p2) ELSE p2 END AS g1, CASE WHEN mm THEN p1 ELSE p2 END AS g2 FROM x")
def guards(spark, sf):
    e = _rescored(edges(spark, sf))
    return e.select("s1", "cand", features.guarded(F.col("mm"), F.col("p1"), F.col("p2")).alias("g1"), features.guarded(F.col("mm"), F.col("p1"), F.col("p2"), "G2").alias("g2"))


@query("WITH {E}, " + _P2 + " SELECT s1, cand, CASE WHEN p1 BETWEEN 0.1 AND 0.9 THEN p2 ELSE p1 END AS p FROM x")
def merge_rescored(spark, sf):
    e = edges(spark, sf)
    return features.merged(e.select("s1", "cand", "p"), _rescored(e).where("p1 BETWEEN 0.1 AND 0.9").select("s1", "cand", F.col("p2").alias("p"))).select("s1", "cand", "p")


def _rel(a: str, b: str, rows: str) -> str:
    """The relation classes in SQL, by rules of its own: places are unnested and counted, bands are looked up in a table of bounds."""
    return f"""n AS (SELECT row_number() OVER () AS i, *, {a} AS na, {b} AS nb FROM {rows}),
fg AS (SELECT *, regexp_replace(na, '[^0-9]', '', 'g') AS fa, regexp_replace(nb, '[^0-9]', '', 'g') AS fb FROM n),
pl AS (SELECT i, count(*) AS changed FROM (SELECT i, fa, fb, unnest(range(1, 17)) AS k FROM fg) WHERE substr(fa, k, 1) <> substr(fb, k, 1) GROUP BY i),
gp AS (SELECT fg.*, coalesce(changed, 0) AS changed, abs(TRY_CAST(substr(fa, 1, 12) AS BIGINT) - TRY_CAST(substr(fb, 1, 12) AS BIGINT)) AS gap FROM fg LEFT JOIN pl USING (i)),
bands AS (SELECT * FROM (VALUES ('s', 0, 2, 'subst_d1_2'), ('s', 3, 5, 'subst_d3_9'), ('s', 6, 6, 'subst_d6_8'), ('s', 7, 7, 'subst_d3_9'), ('s', 8, 8, 'subst_d6_8'), ('s', 9, 9, 'subst_d3_9'),
  ('s', 10, 99, 'subst_d10_99'), ('s', 100, 999999999999, 'subst_d100plus'), ('d', 0, 2, 'diff_1_2'), ('d', 3, 10, 'diff_3_10'), ('d', 11, 100, 'diff_11_100'), ('d', 101, 999999999999, 'diff_100plus')) AS t(kind, least, most, name)),
kd AS (SELECT *, CASE WHEN na = '' AND nb = '' THEN 'none' WHEN '' IN (na, nb) THEN 'one_missing' WHEN na = nb THEN 'exact' WHEN '' IN (fa, fb) THEN 'other' WHEN fa = fb THEN 'letter_change'
  WHEN length(fa) > length(fb) AND position(fb IN fa) > 0 THEN 'digit_dropped' WHEN length(fa) < length(fb) AND position(fa IN fb) > 0 THEN 'digit_added'
  WHEN length(fa) = length(fb) AND changed = 1 THEN 's' ELSE 'd' END AS kind FROM gp),
c AS (SELECT kd.* EXCLUDE (i, na, nb, fa, fb, changed, gap, kind), coalesce(bands.name, kd.kind) AS hn_rel FROM kd LEFT JOIN bands ON kd.kind = bands.kind AND gap BETWEEN least AND most)"""


_REL = _rel("CAST(s1 AS VARCHAR)", "CAST(cand AS VARCHAR)", "e")
# Numbers of ten and more figures that differ behind the eighth, some with letters.
_LONG_A, _LONG_B = "'1234567' || lpad(CAST(s1 % 1000 AS VARCHAR), 3, '0') || CASE WHEN s1 % 7 = 0 THEN 'b' ELSE '' END", "'1234567' || lpad(CAST(cand % 1000 AS VARCHAR), 3, '0') || CASE WHEN cand % 11 = 0 THEN '5' ELSE '' END"


def related(spark, sf):
    return numbers.related(edges(spark, sf), F.col("s1").cast("string"), F.col("cand").cast("string"))


@query("WITH {E}, " + _REL + " SELECT s1, cand, hn_rel FROM c")
def house_relation(spark, sf):
    return related(spark, sf).select("s1", "cand", "hn_rel")


@query("WITH {E}, " + _rel(_LONG_A, _LONG_B, "e") + " SELECT s1, cand, hn_rel FROM c")
def house_relation_long(spark, sf):
    number = lambda k, n, end: F.concat(F.lit("1234567"), F.lpad((F.col(k) % 1000).cast("string"), 3, "0"), F.when(F.col(k) % n == 0, end).otherwise(""))
    return numbers.related(edges(spark, sf), number("s1", 7, "b"), number("cand", 11, "5")).select("s1", "cand", "hn_rel")


@query("""WITH {E}, x AS (SELECT s1, cand, CAST(s1 AS VARCHAR) AS p, CAST(cand AS VARCHAR) AS q FROM e),
y AS (SELECT *, levenshtein(p, q) AS edits, (SELECT min(k) FROM unnest(range(1, 20)) AS t(k) WHERE substr(p, k, 1) <> substr(q, k, 1)) AS fst FROM x)
SELECT s1, cand, CASE WHEN p = q THEN 'equal' WHEN length(p) = length(q) AND edits = 1 THEN 'substitution'
  WHEN length(p) = length(q) AND substr(p, 1, fst - 1) || substr(p, fst + 1, 1) || substr(p, fst, 1) || substr(p, fst + 2) = q THEN 'transposition'
  WHEN length(p) <> length(q) AND edits = 1 THEN 'insert_delete' WHEN abs(s1 - cand) <= 10 THEN 'offset' ELSE 'other' END AS hn7 FROM y""")
def number_seven_classes(spark, sf):
    return edges(spark, sf).select("s1", "cand", numbers.seven_classes(F.col("s1").cast("string"), F.col("cand").cast("string")).alias("hn7"))


_PRI = """pr AS (SELECT coalesce(country, '*') AS country, hn_rel, count(*) AS n, count(*) * 1.0 / count(DISTINCT s1) AS pps, avg(label) AS prior, avg(p) AS mean_p
  FROM (SELECT *, CAST(s1 % 4 AS VARCHAR) AS country FROM c) GROUP BY GROUPING SETS ((country, hn_rel), (hn_rel)))"""


@query("WITH {E}, " + _REL + ", " + _PRI + " SELECT country, hn_rel, n, round(pps, 6) AS pairs_per_s1, round(prior, 6) AS prior, round(mean_p, 6) AS mean_p FROM pr")
def source_priors_grouping_sets(spark, sf):
    e = related(spark, sf).withColumn("country", (F.col("s1") % 4).cast("string"))
    return adaptation.source_priors(e).select("country", "hn_rel", "n", *r6("pairs_per_s1", "prior", "mean_p"))


@query("WITH {E}, " + _REL + """, q AS (SELECT hn_rel, count(*) FILTER (WHERE s1 % 2 = 0) AS ns, count(DISTINCT s1) FILTER (WHERE s1 % 2 = 0) AS us, avg(label) FILTER (WHERE s1 % 2 = 0) AS prior,
  count(*) FILTER (WHERE s1 % 2 = 1) AS nt, count(DISTINCT s1) FILTER (WHERE s1 % 2 = 1) AS ut FROM c GROUP BY hn_rel)
SELECT hn_rel, round(prior, 6) AS prior_s, round(least(greatest(prior * (ns * 1.0 / us) / (nt * 1.0 / ut), 1e-9), 1 - 1e-9), 6) AS prior_t FROM q WHERE prior > 0 AND prior < 1 AND nt > 0""")
def density_prior(spark, sf):
    e = related(spark, sf)
    return adaptation.density_priors(e.where("s1 % 2 = 0"), e.where("s1 % 2 = 1")).select("hn_rel", *r6("prior_s", "prior_t"))


@query("WITH {E}, " + _REL + """, f AS (SELECT *, CASE WHEN p >= 0.001 AND hn_rel = 'subst_d10_99' THEN 0.5 WHEN p >= 0.001 AND hn_rel = 'diff_100plus' THEN 2.0 ELSE 1.0 END AS r FROM c)
SELECT s1, cand, round(r * p / (r * p + 1 - p), 6) AS p FROM f""")
def odds_rescale(spark, sf):
    factor = F.when(F.col("hn_rel") == "subst_d10_99", 0.5).when(F.col("hn_rel") == "diff_100plus", 2.0)
    return related(spark, sf).withColumn("p", features.rescaled(F.col("p"), factor)).select("s1", "cand", *r6("p"))


@query()
def em_prior_shift(spark, sf):
    return adaptation.em_estimates(related(spark, sf).where("s1 % 2 = 0"), related(spark, sf).where("s1 % 2 = 1"))


_HARD = "('subst_d1_2', 'subst_d3_9', 'subst_d10_99')"


@query("WITH {E}, " + _REL + f""", u AS (SELECT count(DISTINCT s1) AS n FROM c),
x AS (SELECT hn_rel, p, label FROM c UNION ALL SELECT 'HARD' AS hn_rel, p, label FROM c WHERE hn_rel IN {_HARD})
SELECT hn_rel, round(count(*) * 1.0 / any_value(n), 6) AS pairs, round(sum(p) / any_value(n), 6) AS mass, round(count(*) FILTER (WHERE p >= 0.5) * 1.0 / any_value(n), 6) AS links FROM x CROSS JOIN u GROUP BY hn_rel""")
def class_profile(spark, sf):
    return adaptation.class_profile(related(spark, sf), ["subst_d1_2", "subst_d3_9", "subst_d10_99"]).select("hn_rel", *r6("pairs", "mass", "links"))


@query("WITH {E}, " + _REL + f""", y AS (SELECT *, bool_or(hn_rel IN ('exact', 'digit_added')) OVER (PARTITION BY s1) AS any_exact FROM c WHERE p >= 0.3)
SELECT s1, cand, p FROM y WHERE NOT (hn_rel IN {_HARD} AND p < 0.99 AND any_exact)""")
def targeted_rule(spark, sf):
    return adaptation.targeted_rule(related(spark, sf).where("p >= 0.3"), ["subst_d1_2", "subst_d3_9", "subst_d10_99"], ["exact", "digit_added"]).select("s1", "cand", "p")


@query("""WITH {E}, t AS (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY p DESC, cand) AS n FROM e), k AS (SELECT unnest([1, 5, 10, 20, 40, 60]) AS cap)
SELECT cap, round(count(*) FILTER (WHERE label = 1 AND n <= cap) * 1.0 / count(*) FILTER (WHERE label = 1), 6) AS recall FROM t CROSS JOIN k GROUP BY cap""")
def recall_at_cap(spark, sf):
    t = decision.ranked(edges(spark, sf)).where("label = 1").select((F.col("rank") + 1).alias("n"))
    caps = [1, 5, 10, 20, 40, 60]
    one = t.agg(F.count("*").alias("all"), *[F.sum((F.col("n") <= c).cast("int")).alias(f"c{c}") for c in caps])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("cap"), F.round(F.col(f"c{c}") / F.col("all"), 6).alias("recall")) for c in caps])).alias("x")).select("x.*")


@query("""WITH {E}, t AS (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY p DESC, cand) AS n, CAST(cand % 7 = 0 AS INTEGER) AS r FROM e),
c AS (SELECT *, row_number() OVER (PARTITION BY s1, n > 10 AND r > 0 ORDER BY r DESC, p DESC, cand) AS k FROM t)
SELECT s1, cand, p FROM c WHERE n <= 10 OR (r > 0 AND k <= 3)""")
def cap_with_reserve(spark, sf):
    return candidates.capped(edges(spark, sf).withColumn("prio", F.col("p")), 10, F.col("cand") % 7 == 0, 3).select("s1", "cand", "p")


@query("WITH {E}, " + _THR + " SELECT s1, cand FROM d WHERE sel AND rank < 3")
def list_cap(spark, sf):
    return decision.threshold(edges(spark, sf), 0.8, 0.3).where("sel AND rank < 3").select("s1", "cand")


@query("WITH {E}, " + _THR + """, a AS (SELECT s1, cand FROM d WHERE sel), b AS (SELECT s1, cand FROM e WHERE p >= 0.6)
SELECT 'added' AS change, s1, cand FROM b ANTI JOIN a USING (s1, cand) UNION ALL SELECT 'removed', s1, cand FROM a ANTI JOIN b USING (s1, cand)""")
def link_diff(spark, sf):
    a = decision.threshold(edges(spark, sf), 0.8, 0.3).where("sel").select("s1", "cand")
    b = edges(spark, sf).where("p >= 0.6").select("s1", "cand")
    change = F.when(F.col("a").isNull(), "added").otherwise("removed")
    both = a.withColumn("a", F.lit(1)).join(b.withColumn("b", F.lit(1)), ["s1", "cand"], "full")
    return both.where("a IS NULL OR b IS NULL").select(change.alias("change"), "s1", "cand")


@query("WITH {E} SELECT CAST(least(floor(p * 10), 9) AS INTEGER) AS bin, count(*) AS n, round(avg(p), 6) AS mean_p, round(avg(label), 6) AS rate FROM e GROUP BY 1")
def calibration_bins(spark, sf):
    return edges(spark, sf).groupBy(F.least(F.floor(F.col("p") * 10), F.lit(9)).cast("int").alias("bin")).agg(F.count("*").alias("n"), F.round(F.avg("p"), 6).alias("mean_p"), F.round(F.avg("label"), 6).alias("rate"))


@query("WITH {E} SELECT cand, count(*) AS n, round(sum(p), 6) AS mass FROM e WHERE p >= 0.3 GROUP BY cand HAVING sum(p) > 1.2")
def over_claimed_records(spark, sf):
    return edges(spark, sf).where("p >= 0.3").groupBy("cand").agg(F.count("*").alias("n"), F.sum("p").alias("m")).where("m > 1.2").select("cand", "n", F.round("m", 6).alias("mass"))


_F = _ONE + """, k AS (SELECT s1, count(*) AS k FROM e WHERE label = 1 GROUP BY s1), m AS (SELECT s1, count(*) AS m FROM l GROUP BY s1),
tp AS (SELECT l.s1, count(*) AS tp FROM l JOIN e ON e.s1 = l.s1 AND e.cand = l.mid AND e.label = 1 GROUP BY l.s1),
f AS (SELECT c_custkey AS s1, c_nationkey AS country, coalesce(k, 0) AS k, coalesce(m, 0) AS m, coalesce(tp, 0) AS tp
  FROM customer LEFT JOIN k ON k.s1 = c_custkey LEFT JOIN m ON m.s1 = c_custkey LEFT JOIN tp ON tp.s1 = c_custkey),
s AS (SELECT *, CASE WHEN k = 0 AND m = 0 THEN 1.0 WHEN tp = 0 THEN 0.0 ELSE 1.25 * tp / (0.25 * k + m) END AS f FROM f)"""


def scored(spark, sf):
    universe = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("s1"), F.col("c_nationkey").alias("country"))
    return metrics.per_entity(universe, truth(edges(spark, sf)), links(spark, sf)).join(universe, "s1")


@query("WITH {E}, " + _F + " SELECT s1, CAST(k AS BIGINT) AS k, CAST(m AS BIGINT) AS m, CAST(tp AS BIGINT) AS tp, round(f, 6) AS f FROM s")
def per_s1_fbeta(spark, sf):
    return scored(spark, sf).select("s1", "k", "m", "tp", *r6("f"))


@query("WITH {E}, " + _F + """ SELECT count(*) AS n, round(avg(f), 6) AS macro_f, round(sum(tp) * 1.0 / sum(m), 6) AS micro_precision, round(sum(tp) * 1.0 / sum(k), 6) AS micro_recall,
  round(avg(CASE WHEN m = 0 THEN 1.0 ELSE 0 END), 6) AS empty_rate, round(avg(CASE WHEN k = 0 THEN 1.0 ELSE 0 END), 6) AS singleton_rate FROM s""")
def macro_fbeta(spark, sf):
    rate = lambda c: F.round(F.avg(F.when(c, 1.0).otherwise(0.0)), 6)
    return scored(spark, sf).agg(F.count("*").alias("n"), F.round(F.avg("f"), 6).alias("macro_f"), F.round(F.sum("tp") / F.sum("m"), 6).alias("micro_precision"), F.round(F.sum("tp") / F.sum("k"), 6).alias("micro_recall"), rate(F.col("m") == 0).alias("empty_rate"), rate(F.col("k") == 0).alias("singleton_rate"))


@query("WITH {E}, " + _F + """, b AS (SELECT *, CASE WHEN k >= 7 THEN '7+' ELSE CAST(k AS VARCHAR) END AS kb FROM s)
SELECT coalesce(CAST(country AS VARCHAR), 'ALL') AS country, coalesce(kb, 'ALL') AS kb, count(*) AS n, round(avg(f), 6) AS f FROM b GROUP BY GROUPING SETS ((), (country), (kb), (country, kb))""")
def fbeta_breakdown(spark, sf):
    x = scored(spark, sf).select(F.col("country").cast("string").alias("country"), metrics.bucket(F.col("k")).alias("kb"), "f")
    g = x.groupingSets([[], ["country"], ["kb"], ["country", "kb"]], "country", "kb").agg(F.count("*").alias("n"), F.round(F.avg("f"), 6).alias("f"))
    return g.na.fill("ALL", ["country", "kb"])


@query("WITH {E}, " + _F + """ SELECT CASE WHEN f = 1 THEN 'perfect' WHEN k = 0 THEN 'false_link' WHEN m = 0 THEN 'empty_list' WHEN tp = 0 THEN 'all_wrong' WHEN tp = m THEN 'missing_only' ELSE 'mixed' END AS loss,
  count(*) AS n, round(sum(1 - f), 6) AS points FROM s GROUP BY 1""")
def loss_points(spark, sf):
    kind = F.when(F.col("f") == 1, "perfect").when(F.col("k") == 0, "false_link").when(F.col("m") == 0, "empty_list").when(F.col("tp") == 0, "all_wrong").when(F.col("tp") == F.col("m"), "missing_only").otherwise("mixed")
    return scored(spark, sf).groupBy(kind.alias("loss")).agg(F.count("*").alias("n"), F.round(F.sum(1 - F.col("f")), 6).alias("points"))


@query("""WITH {E}, b AS (SELECT CAST(least(floor(p * 10), 9) AS INTEGER) AS bin, count(*) FILTER (WHERE s1 % 2 = 0) AS a, count(*) FILTER (WHERE s1 % 2 = 1) AS b FROM e GROUP BY 1),
s AS (SELECT greatest(a * 1.0 / sum(a) OVER (), 1e-4) AS q, greatest(b * 1.0 / sum(b) OVER (), 1e-4) AS r FROM b) SELECT round(sum((r - q) * ln(r / q)), 6) AS psi FROM s""")
def psi(spark, sf):
    return metrics.psi(edges(spark, sf).select(F.least(F.floor(F.col("p") * 10), F.lit(9)).alias("bin"), (F.col("s1") % 2).alias("side")), "bin", "side").select(*r6("psi"))


@query("""WITH {E}, r AS (SELECT label, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS r FROM e)
SELECT round((sum(r) FILTER (WHERE label = 1) - sum(label) * (sum(label) + 1) / 2.0) / (sum(label) * (count(*) - sum(label))), 6) AS auc, CAST(sum(label) AS BIGINT) AS n_pos, count(*) AS n_all FROM r""")
def rank_auc(spark, sf):
    return metrics.rank_auc(edges(spark, sf), "p", "label").select(*r6("auc"), "n_pos", "n_all")


@query("""WITH {E}, a AS (SELECT s1, sum(p) AS x, sum(label) AS y FROM e GROUP BY s1),
r AS (SELECT rank() OVER (ORDER BY round(x, 9)) + (count(*) OVER (PARTITION BY round(x, 9)) - 1) / 2.0 AS rx, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM a)
SELECT round(corr(rx, ry), 6) AS rho, count(*) AS n FROM r""")
def spearman(spark, sf):
    a = edges(spark, sf).groupBy("s1").agg(F.round(F.sum("p"), 9).alias("x"), F.sum("label").cast("double").alias("y"))
    a = features.overall_percentile(features.overall_percentile(a, "x", "rx"), "y", "ry")
    return a.agg(F.round(F.corr("rx", "ry"), 6).alias("rho"), F.count("*").alias("n"))


@query("""WITH {E}, x AS (SELECT CAST(s1 % 2 AS INTEGER) AS side, CAST(least(floor(p * 10), 9) AS INTEGER) AS bin, label FROM e),
c AS (SELECT bin, avg(label) FILTER (WHERE side = 0) AS m, count(*) FILTER (WHERE side = 0) AS n, count(*) FILTER (WHERE side = 1) AS w FROM x GROUP BY bin), o AS (SELECT avg(label) AS m FROM x WHERE side = 0)
SELECT round(sum(w * CASE WHEN n >= 200 THEN c.m ELSE o.m END) / sum(w), 6) AS estimate FROM c CROSS JOIN o""")
def reweighted_estimate(spark, sf):
    x = edges(spark, sf).select((F.col("s1") % 2).alias("side"), F.least(F.floor(F.col("p") * 10), F.lit(9)).alias("bin"), "label")
    c = x.groupBy("bin").agg(F.avg(F.when(F.col("side") == 0, F.col("label"))).alias("m"), F.sum((F.col("side") == 0).cast("int")).alias("n"), F.sum((F.col("side") == 1).cast("int")).alias("w"))
    o = x.where("side = 0").agg(F.avg("label").alias("o"))  # one row
    return c.join(F.broadcast(o), F.lit(True)).agg(F.round(F.sum(F.col("w") * F.when(F.col("n") >= 200, F.col("m")).otherwise(F.col("o"))) / F.sum("w"), 6).alias("estimate"))


@query("""WITH {E}, x AS (SELECT CAST(s1 % 5 AS INTEGER) AS a, CAST(cand % 5 AS INTEGER) AS b FROM e WHERE label = 1), j AS (SELECT a, b, count(*) AS n FROM x GROUP BY a, b)
SELECT a, b, n, round(n * sum(n) OVER () * 1.0 / (sum(n) OVER (PARTITION BY a) * sum(n) OVER (PARTITION BY b)), 6) AS lift FROM j""")
def lift_table(spark, sf):
    j = edges(spark, sf).where("label = 1").groupBy((F.col("s1") % 5).cast("int").alias("a"), (F.col("cand") % 5).cast("int").alias("b")).agg(F.count("*").alias("n"))
    t = lambda *k: F.sum("n").over(Window.partitionBy(*k))
    return j.select("a", "b", "n", F.round(F.col("n") * t(F.lit(1)) / (t("a") * t("b")), 6).alias("lift"))


@query("""WITH {E}, d AS (SELECT label, CAST(floor(((rank() OVER (ORDER BY p)) - 1) * 10.0 / count(*) OVER ()) AS INTEGER) AS decile FROM e) SELECT decile, count(*) AS n, round(avg(label), 6) AS rate FROM d GROUP BY decile""")
def decile_rates(spark, sf):
    by = features.running_counts(edges(spark, sf).groupBy("p").agg(F.count("*").alias("n"), F.sum("label").alias("y")), "p")
    by = by.withColumn("d", F.floor(F.col("before") * 10 / F.col("total")).cast("int"))
    return by.groupBy(F.col("d").alias("decile")).agg(F.sum("n").alias("n"), F.round(F.sum("y") / F.sum("n"), 6).alias("rate"))


@query("""WITH {E} SELECT s1, string_agg(CAST(cand AS VARCHAR), ',' ORDER BY CAST(cand AS VARCHAR)) AS ids FROM e WHERE p >= 0.8 GROUP BY s1
UNION ALL SELECT c_custkey, '' FROM customer WHERE c_custkey NOT IN (SELECT s1 FROM e WHERE p >= 0.8)""")
def id_list_sink(spark, sf):
    from linkloom.sources import idlists

    order = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("s1"))
    return idlists.lists(order, edges(spark, sf).where("p >= 0.8").select("s1", F.col("cand").cast("string").alias("mid")), "ids")


@query("""WITH {E}, q AS (SELECT s1, CAST(p >= 0.5 AS INTEGER) AS a, CAST(label AS INTEGER) AS b FROM e) SELECT a, b, count(*) AS n, count(DISTINCT s1) AS n_s1 FROM q GROUP BY a, b""")
def confusion(spark, sf):
    return edges(spark, sf).groupBy((F.col("p") >= 0.5).cast("int").alias("a"), F.col("label").alias("b")).agg(F.count("*").alias("n"), F.count_distinct("s1").alias("n_s1"))


@query("""WITH {E}, k AS (SELECT CAST(unnest([0.3, 0.4, 0.5, 0.55, 0.6, 0.65, 0.7, 0.8]) AS DOUBLE) AS t),
x AS (SELECT t, s1, count(*) FILTER (WHERE label = 1) AS k, count(*) FILTER (WHERE p >= t) AS m, count(*) FILTER (WHERE p >= t AND label = 1) AS tp FROM e CROSS JOIN k GROUP BY t, s1)
SELECT t, round(avg(CASE WHEN k = 0 AND m = 0 THEN 1.0 WHEN tp = 0 THEN 0.0 ELSE 1.25 * tp / (0.25 * k + m) END), 6) AS macro_f FROM x GROUP BY t""")
def threshold_grid(spark, sf):
    grid = [0.3, 0.4, 0.5, 0.55, 0.6, 0.65, 0.7, 0.8]
    count = lambda c: F.sum(c.cast("int"))
    per = edges(spark, sf).groupBy("s1").agg(F.sum("label").alias("k"), *[x for i, t in enumerate(grid) for x in (count(F.col("p") >= t).alias(f"m{i}"), count((F.col("p") >= t) & (F.col("label") == 1)).alias(f"h{i}"))])
    one = per.agg(*[F.avg(metrics.f_beta(F.col("k"), F.col(f"m{i}"), F.col(f"h{i}"))).alias(f"f{i}") for i in range(len(grid))])
    return one.select(F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.round(f"f{i}", 6).alias("macro_f")) for i, t in enumerate(grid)])).alias("x")).select("x.*")
