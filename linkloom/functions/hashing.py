"""Deterministic hashes, folds and samples, the same on any machine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crc_bucket(*cols: Column, buckets: int, salt: str = "") -> Column:
    """crc32 of the salted text, modulo ``buckets``."""
    return F.pmod(F.crc32(F.concat(F.lit(salt), *[c.cast("string") for c in cols]).cast("binary")), F.lit(buckets)).cast("int")


def folds(df: DataFrame, key: str, k: int = 5, salt: str = "fold") -> DataFrame:
    """``fold``: all rows of a key fall into one."""
    return df.withColumn("fold", crc_bucket(F.col(key), buckets=k, salt=salt))


def hash_sample(df: DataFrame, key: str, n: int, salt: str = "sample") -> DataFrame:
    """``n`` rows in the order of a hash of their key: a sampling operator that any engine repeats."""
    return df.orderBy(F.crc32(F.concat(F.lit(salt), F.col(key).cast("string")).cast("binary")), key).limit(n)
