"""Relational coverage over the star schema, learned models, and the event stream's batch twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.operators import model
from linkloom.plans.views import edges, table
from linkloom.streaming import events as stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem
WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def pricing_summary(spark, sf):
    l = table(spark, sf, "lineitem").where("l_shipdate <= TIMESTAMP '1998-09-02'")
    return l.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


@query("""SELECT n_name, r_name, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def dimension_lookup(spark, sf):
    o, c = table(spark, sf, "orders").select("o_custkey", "o_totalprice"), table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    names = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select("n_nationkey", "n_name", "r_name")
    by = o.join(c, o["o_custkey"] == c["c_custkey"]).groupBy("c_nationkey").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("t"))
    return by.join(names, by["c_nationkey"] == names["n_nationkey"]).select("n_name", "r_name", "n", F.round("t", 2).alias("total"))


@query("SELECT c_custkey FROM customer ANTI JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') o ON c_custkey = o_custkey")
def anti_join(spark, sf):
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders").where("o_orderstatus = 'F'")
    return c.join(o, c["c_custkey"] == o["o_custkey"], "left_anti").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey IN (SELECT o_custkey FROM orders)")
def semi_join(spark, sf):
    c, o = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'"), table(spark, sf, "orders")
    return c.join(o, c["c_custkey"] == o["o_custkey"], "left_semi").select("c_custkey")


@query("""WITH a AS (SELECT p_brand AS k, count(*) AS x FROM part WHERE p_size < 10 GROUP BY 1), b AS (SELECT p_brand AS k, count(*) AS y FROM part WHERE p_size > 40 GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, coalesce(x, 0) AS x, coalesce(y, 0) AS y FROM a FULL JOIN b ON a.k = b.k""")
def full_outer_join(spark, sf):
    p = table(spark, sf, "part")
    a, b = p.where("p_size < 10").groupBy(F.col("p_brand").alias("k")).agg(F.count("*").alias("x")), p.where("p_size > 40").groupBy(F.col("p_brand").alias("k")).agg(F.count("*").alias("y"))
    return a.join(b, "k", "full").na.fill(0, ["x", "y"])


@query("SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey")
def sibling_self_join(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    a, b = s.select(F.col("s_suppkey").alias("a"), "s_nationkey"), s.select(F.col("s_suppkey").alias("b"), "s_nationkey")
    return a.join(b, "s_nationkey").where("a < b").select("a", "b")


@query("""WITH n AS (SELECT p_name, count(*) AS n FROM part GROUP BY p_name), k AS (SELECT p_name FROM n WHERE n * n <= 2000)
SELECT a.p_partkey AS a, b.p_partkey AS b FROM part a JOIN k USING (p_name) JOIN part b USING (p_name) WHERE a.p_partkey < b.p_partkey""")
def product_guard_join(spark, sf):
    p = table(spark, sf, "part").select("p_name", "p_partkey")
    ok = p.groupBy("p_name").agg(F.count("*").alias("n")).where("n * n <= 2000").select("p_name")
    p = p.join(ok, "p_name", "left_semi")
    return p.withColumnRenamed("p_partkey", "a").join(p.withColumnRenamed("p_partkey", "b"), "p_name").where("a < b").select("a", "b")


@query("SELECT o_orderpriority, quantile_cont(o_totalprice, 0.5) AS p50, quantile_cont(o_totalprice, 0.95) AS p95 FROM orders GROUP BY 1")
def quantiles(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.percentile("o_totalprice", F.lit(0.5)).alias("p50"), F.percentile("o_totalprice", F.lit(0.95)).alias("p95"))


@query("WITH c AS (SELECT c_nationkey AS k, c_mktsegment AS v, count(*) AS n FROM customer GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, v) AS i FROM c) SELECT k, v, n FROM r WHERE i = 1")
def most_common(spark, sf):
    c = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("k"), F.col("c_mktsegment").alias("v")).agg(F.count("*").alias("n"))
    return c.groupBy("k").agg(F.min_by("v", F.struct(-F.col("n"), "v")).alias("v"), F.max("n").alias("n"))


@query("WITH r AS (SELECT o_orderkey, sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) - o_totalprice AS before FROM orders) SELECT o_orderkey FROM r WHERE before < 200000")
def cumulative_quota(spark, sf):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, sf, "orders").withColumn("before", F.sum("o_totalprice").over(w) - F.col("o_totalprice")).where("before < 200000").select("o_orderkey")


@query("SELECT coalesce(c_mktsegment, 'ALL') AS c_mktsegment, coalesce(n_regionkey, -1) AS n_regionkey, count(*) AS n, grouping(c_mktsegment) AS g1, grouping(n_regionkey) AS g2 FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY CUBE (c_mktsegment, n_regionkey)")
def cube_counts(spark, sf):
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    x = c.join(n, c["c_nationkey"] == n["n_nationkey"]).cube("c_mktsegment", "n_regionkey").agg(F.count("*").alias("n"), F.grouping("c_mktsegment").cast("long").alias("g1"), F.grouping("n_regionkey").cast("long").alias("g2"))
    return x.na.fill({"c_mktsegment": "ALL", "n_regionkey": -1})


@query("(SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0 INTERSECT SELECT o_custkey FROM orders) EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def set_operations(spark, sf):
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders")
    return c.where("c_acctbal > 0").select(F.col("c_custkey").alias("k")).intersect(o.select("o_custkey")).subtract(o.where("o_orderstatus = 'F'").select("o_custkey"))


@query("""WITH d AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS keep FROM documents) SELECT doc_id FROM d WHERE doc_id = keep""")
def dedup_keep_first(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.xxhash64("text").alias("a"), F.md5(F.encode("text", "UTF-8")).alias("b"))
    return d.groupBy("a", "b").agg(F.min("doc_id").alias("doc_id")).select("doc_id")


@query("""SELECT user_id, event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS total, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS hour FROM events GROUP BY user_id, event_type, hour""")
def hourly_events(spark, sf):
    return stream.hourly(table(spark, sf, "events")).select("user_id", "event_type", "n", F.round("total", 4).alias("total"), "hour")


@query("""WITH g AS (SELECT user_id, ts, event_id, CASE WHEN epoch(ts) - epoch(lag(ts) OVER w) <= 1800 THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM g) SELECT user_id, CAST(sid AS BIGINT) AS sid, count(*) AS n FROM s GROUP BY 1, 2""")
def sessions(spark, sf):
    return stream.sessions(table(spark, sf, "events"), 1800)


@query("SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def distinct_users(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))


@query()
def gbt_oof(spark, sf):
    return model.out_of_fold(model.pair_features(edges(spark, sf)))


@query()
def isotonic_calibration(spark, sf):
    return model.calibrated(edges(spark, sf))


@query()
def leave_one_group_out(spark, sf):
    return model.leave_one_out(model.pair_features(edges(spark, sf)).withColumn("grp", (F.col("s1") % 2).cast("int")))
