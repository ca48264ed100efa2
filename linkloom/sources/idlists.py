"""Truth and id-list files: one entity and a comma list of ids in each line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def lists(order: DataFrame, pairs: DataFrame, name: str = "ids", by_score: bool = False) -> DataFrame:
    """``(s1, <name>)`` for every entity of ``order``: its distinct ids, sorted (or by falling p), or an empty list."""
    if by_score:
        each = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("p")).alias("p"), "mid"))), lambda x: x["mid"])
    else:
        each = F.array_sort(F.collect_set("mid"))
    got = pairs.groupBy("s1").agg(F.array_join(each, ",").alias(name))
    return order.select("s1").distinct().join(got, "s1", "left").withColumn(name, F.coalesce(name, F.lit("")))


def exploded(wide: DataFrame, key: str, ids: str) -> DataFrame:
    """``(s1, mid)``: list items trimmed, blanks dropped, carriage returns stripped; entities without any have no row."""
    return wide.select(F.col(key).alias("s1"), F.explode(F.split(F.col(ids), ",")).alias("x")).select("s1", F.trim(F.replace("x", F.lit("\r"), F.lit(""))).alias("mid")).where("mid <> ''")


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    from linkloom.sources.records import read_tsv

    return exploded(read_tsv(spark, path, ["source1_entity_id", "matched_entity_ids"]), "source1_entity_id", "matched_entity_ids")


def problems(order: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(rule, n)`` of what a strict writer refuses: null or blank ids, spaces or commas in ids, entities not in the order file, owned twice."""
    known = order.select("s1").distinct()
    bad = F.col("mid").isNull() | (F.trim("mid") == "") | F.col("mid").rlike("[,\\s]")
    one = pairs.where(bad).agg(F.lit("bad_id").alias("rule"), F.count("*").alias("n"))
    two = pairs.join(known, "s1", "left_anti").agg(F.lit("unknown_entity").alias("rule"), F.count("*").alias("n"))
    three = pairs.distinct().groupBy("mid").count().where("count > 1").agg(F.lit("owned_twice").alias("rule"), F.count("*").alias("n"))
    four = order.groupBy("s1").count().where("count > 1").agg(F.lit("repeated_entity").alias("rule"), F.count("*").alias("n"))
    return one.unionByName(two).unionByName(three).unionByName(four)


def write(df: DataFrame, path: str) -> None:
    """Tab-separated, without quoting, LF."""
    df.write.option("sep", "\t").option("header", True).option("quote", "\u0000").option("emptyValue", "").mode("error").csv(path)
