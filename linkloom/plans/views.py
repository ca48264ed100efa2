"""Linkage-shaped views of the test tables, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(s1, cand, p, label)``: customers as entities, parts as candidates."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return items.join(orders, items["l_orderkey"] == orders["o_orderkey"]).groupBy(F.col("o_custkey").alias("s1"), F.col("l_partkey").alias("cand")).agg(
        F.round(F.pow(F.max("l_quantity") / 51.0, F.lit(3.0)), 6).alias("p"), F.max((F.col("l_returnflag") == "R").cast("int")).alias("label")
    )


def truth(e: DataFrame) -> DataFrame:
    return e.where("label = 1").select("s1", F.col("cand").alias("mid"))


#: Words of a record: four of its name, three of its street.
RECORD_WORDS, NAME_WORDS = 7, 4


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records from whole texts: every RECORD_WORDS words (three letters A-Z or more) of a document make one, so each word is in one.

    ``(id, side, country, state_key, city_key, name_core, name_norm, name_compact, addr_norm, house_nums)``. Towns follow the source; a
    few records have no state, and some of the pool a wrong one.
    """
    words = F.transform(F.regexp_extract_all("text", F.lit("[A-Za-z]{3,}"), F.lit(0)), F.lower)
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", "lang", "source", words.alias("w"))
    parts = F.ceil(F.size("w") / F.lit(RECORD_WORDS)).cast("int")
    each = F.when(parts > 0, F.transform(F.sequence(F.lit(0), parts - 1), lambda k: F.struct(k.alias("k"), F.slice("w", k * RECORD_WORDS + 1, RECORD_WORDS).alias("w"))))
    # Each row holds its own words only, not those of the document.
    d = d.select("doc_id", "lang", "source", F.explode_outer(each).alias("e")).where("e IS NOT NULL").select("doc_id", "lang", "source", F.col("e.k").alias("k"), F.col("e.w").alias("w"))
    name, rest = F.slice("w", 1, NAME_WORDS), F.slice("w", 1 + NAME_WORDS, RECORD_WORDS - NAME_WORDS)
    side, number, town = (F.col("doc_id") % 3).cast("int"), ((F.col("doc_id") * 7 + F.col("k")) % 997).cast("string"), F.concat("source", F.lit(" town"))
    state = F.when(F.col("doc_id") % 23 == 0, "").when((side > 0) & (F.col("doc_id") % 11 == 0), "src0").otherwise(F.col("source"))
    core = F.array_join(name, " ")
    return d.select(
        (F.col("doc_id") * 100_000 + F.col("k")).alias("id"), side.alias("side"), F.col("lang").alias("country"), state.alias("state_key"), town.alias("city_key"), core.alias("name_core"), F.concat(core, F.lit(" inc")).alias("name_norm"),
        F.array_join(name, "").alias("name_compact"), F.concat_ws(" ", number, F.nullif(F.array_join(rest, " "), F.lit("")), town).alias("addr_norm"), F.array(number).alias("house_nums"),
    )


def own_ids(spark: SparkSession, sf: str) -> bool:
    """Whether each record has an id of its own: no document's id is null or repeated, and none has so many words that its records' numbers reach the next id."""
    d = table(spark, sf, "documents").where("text IS NOT NULL")
    n = d.agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("ids"), F.coalesce(F.max(F.length("text")), F.lit(0)).alias("most")).first()
    return n.n == n.ids and n.most < 2_000_000  # a record takes 27 letters and spaces at least, so far fewer than 100,000


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("blk"), F.col("embedding").alias("v"))


EDGES = """
e AS (SELECT o_custkey AS s1, l_partkey AS cand, round(pow(max(l_quantity) / 51.0, 3), 6) AS p, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS label
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""
RECORDS = """
w AS (SELECT doc_id, lang, source, list_transform(regexp_extract_all(text, '[A-Za-z]{3,}'), lambda x: lower(x)) AS w FROM documents WHERE text IS NOT NULL),
wk AS (SELECT *, unnest(range(0, CAST(ceil(len(w) / 7.0) AS BIGINT))) AS k FROM w),
r AS (SELECT doc_id * 100000 + k AS id, CAST(doc_id % 3 AS INTEGER) AS side, lang AS country, CASE WHEN doc_id % 23 = 0 THEN '' WHEN doc_id % 3 > 0 AND doc_id % 11 = 0 THEN 'src0' ELSE source END AS state_key,
  source || ' town' AS city_key, array_to_string(w[k * 7 + 1:k * 7 + 4], ' ') AS name_core, array_to_string(w[k * 7 + 1:k * 7 + 4], ' ') || ' inc' AS name_norm, array_to_string(w[k * 7 + 1:k * 7 + 4], '') AS name_compact,
  concat_ws(' ', CAST((doc_id * 7 + k) % 997 AS VARCHAR), nullif(array_to_string(w[k * 7 + 5:k * 7 + 7], ' '), ''), source || ' town') AS addr_norm, [CAST((doc_id * 7 + k) % 997 AS VARCHAR)] AS house_nums FROM wk)"""
