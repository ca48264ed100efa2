"""Tables written to the cluster's shared folder: they cut lineage and outlive a lost executor."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from linkloom.llm.components import checkpoint_dir


def _folder(spark: SparkSession) -> str:
    """Where this application's tables stand, below spark.checkpoint.dir."""
    checkpoint_dir(spark)
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return f"{folder}/tables-{spark.sparkContext.applicationId}"


def stash(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet below spark.checkpoint.dir and read again. ``sweep`` removes what an application wrote."""
    spark = df.sparkSession
    path = f"{_folder(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession) -> None:
    """Removes all tables that ``stash`` wrote in this application; call it when no result that reads them is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of ``df`` is called so."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
    return out


def named(c: str) -> str:
    """A column's name as an expression reads it, dots and all."""
    return "`" + c.replace("`", "``") + "`"


def mapped(df: DataFrame, run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], columns: list[str]) -> DataFrame:
    """``run`` over batches with all columns of ``df``, whatever their names; it returns those in ``columns``, in order."""
    names, safe = df.columns, [f"c{i}" for i in range(len(df.columns))]
    kinds = [f"{safe[names.index(c)]} {df.schema[names.index(c)].dataType.simpleString()}" for c in columns]

    def renamed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(pa.RecordBatch.from_arrays(b.columns, names=names) for b in batches):
            yield pa.RecordBatch.from_arrays(out.columns, names=[x.split(" ", 1)[0] for x in kinds])

    return df.toDF(*safe).mapInArrow(renamed, ", ".join(kinds)).toDF(*columns)
