"""Source records: strict tab-separated text, Parquet with projection, and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from linkloom.functions.text import unquoted

RECORD = ("entity_id", "business_name", "business_address", "country")


def read_tsv(spark: SparkSession, path: str, columns: list[str] | tuple[str, ...] = RECORD, unquote: bool = False, encoding: str = "UTF-8") -> DataFrame:
    """Text columns only, no quoting, nothing taken for null: a missing value is ''. The header must have all ``columns``."""
    head = spark.read.option("lineSep", "\n").text(path).limit(1).first()
    found = [x.strip().strip("﻿") for x in (head[0] if head else "").rstrip("\r").split("\t")]
    if len(found) < 2 and len(columns) > 1:
        raise ValueError(f"{path} is not tab-separated")
    missing = [c for c in columns if c not in found]
    if missing:
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in found])
    raw = spark.read.schema(schema).option("sep", "\t").option("header", True).option("enforceSchema", True).option("quote", "").option("escape", "").option("nullValue", "\u0000").option("emptyValue", "").option("mode", "FAILFAST").option("encoding", encoding).csv(path)
    out = [F.coalesce(F.col(c), F.lit("")) for c in columns]
    return raw.select(*[(unquoted(x) if unquote else x).alias(c) for x, c in zip(out, columns, strict=True)])


def read(spark: SparkSession, path: str, columns: list[str] | tuple[str, ...] = RECORD) -> DataFrame:
    return spark.read.parquet(path).select(*columns) if path.endswith(".parquet") else read_tsv(spark, path, columns)


def convert(spark: SparkSession, source: str, target: str, columns: list[str] | tuple[str, ...] = RECORD) -> int:
    """Text to Parquet once; the number of rows. A finished target is left as it is."""
    try:
        return spark.read.parquet(target).count()
    except Exception as e:  # only a missing target goes on
        if "PATH_NOT_FOUND" not in str(e):
            raise
    read_tsv(spark, source, columns).write.option("compression", "zstd").parquet(target)
    return spark.read.parquet(target).count()


def verify(records: DataFrame, key: str = "entity_id", prefix: str = "S[123]-") -> DataFrame:
    """One row: rows, repeated and blank keys, keys without the prefix, blank cells, cells that say a null word."""
    others = [c for c in records.columns if c != key]
    word = lambda c: F.upper(F.trim(c)).isin("NULL", "NONE", "NA", "N/A")
    count = lambda c: F.sum(c.cast("int")).cast("long")
    one = records.agg(F.count("*").alias("n"), F.count_distinct(key).alias("n_keys"), count(F.col(key) == "").alias("blank_keys"), count(~F.col(key).rlike(f"^{prefix}")).alias("bad_prefix"), *[x for c in others for x in (count(F.col(c) == "").alias(f"blank_{c}"), count(word(F.col(c))).alias(f"null_word_{c}"))])
    return one


def sniff(spark: SparkSession, path: str) -> DataFrame:
    """One row about a text file: lines, tabs in a line (least, most), whether lines end in CR, whether there is a BOM."""
    line = F.col("value")
    tabs = F.length(line) - F.length(F.replace(line, F.lit("\t"), F.lit("")))
    return spark.read.option("lineSep", "\n").text(path).agg(F.count("*").alias("lines"), F.min(tabs).alias("least_tabs"), F.max(tabs).alias("most_tabs"), F.bool_or(F.endswith(line, F.lit("\r"))).alias("crlf"), F.bool_or(F.startswith(line, F.lit("﻿"))).alias("bom"))
