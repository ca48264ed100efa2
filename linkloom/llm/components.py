"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_dir(spark: SparkSession) -> None:
    """The cluster's shared folder comes from spark.checkpoint.dir. Only a local session gets one of our own where it names none."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    context.setCheckpointDir(folder or "/tmp/checkpoints")


#: Rows of two longs that a checkpoint's task writes, and the tasks that are always allowed.
TASK_ROWS, LEAST_TASKS = 100_000, 24


def cut(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint in the shared folder.

    Where no more than ``rows`` short rows are to be expected, it is written in as many files as they need.
    """
    checkpoint_dir(df.sparkSession)
    return (df if rows is None else df.coalesce(max(LEAST_TASKS, rows // TASK_ROWS))).checkpoint(eager=True)


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Edges ``(a, b)`` of longs, to ``(node, component)`` with the smallest node of each component.

    Every node of an edge gets one row; nulls and loops are ignored, repeated edges do no harm, and no edges give no
    rows. Each round is two aggregations and two joins on the node; minima are checkpointed first, so that both
    sides of a join are plain exchanges, which adaptive execution splits where a hub holds many edges.
    """
    links = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before, most = None, 2 * links.count()
    for _ in range(rounds):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), most)
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = cut(large, most)
        low = cut(large.groupBy("u").agg(F.min("v").alias("m")), most)
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        links = cut(small.select("e.u", "e.v").where("u <> v").distinct(), most)
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    # Settled: every node but the roots points at its root.
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
