"""Exact top-k search with a vector-approximation file.

The file holds, for blocks of vectors, one byte a component: the number of its cell. A block has CELLS cells for each
dimension, of about equally many vectors, with the least and the largest component in each. A scan of this file alone
bounds each vector's inner product with a query from below and above, vector by vector. The k-th largest lower bound over
all blocks leaves few candidates; their exact vectors are fetched from the highest upper bound down, until the k-th
best score found is above all bounds that are left: the 2k highest first, then those that still reach the k-th score.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm._stash import stash

#: Cells of a dimension; their numbers fit a byte.
CELLS = 64
#: Components of a block of the file, and of a block of queries.
COMPONENTS, ASKED = 1 << 20, 1 << 17
#: Query blocks of so many bytes at most are broadcast; more are dealt to the blocks of the file by a shuffle.
BROADCAST = 32 << 20
_FOUND = "query_id long, row long, vec_id long, low double, high double"


def integers(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """``(vec_id, v)`` with floor(scale * x) of every component; rows with a null id, or a null, empty or non-finite vector are left out."""
    x = F.col(vec_col)
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return df.where(F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0)).where(good).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"))


def cells_of(v: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell number of every component, and least and largest component in each cell (dimension, cell)."""
    n, dim = v.shape
    edges = np.sort(v, axis=0)[np.arange(1, cells) * n // cells]  # least components of the cells but the first
    code = np.empty((n, dim), np.uint8)
    low, high = np.zeros((dim, cells), v.dtype), np.zeros((dim, cells), v.dtype)
    for d in range(dim):
        code[:, d] = at = np.searchsorted(edges[:, d], v[:, d], "right")
        order = np.argsort(at, kind="stable")
        used, first = np.unique(at[order], return_index=True)
        low[d, used] = np.minimum.reduceat(v[order, d], first)
        high[d, used] = np.maximum.reduceat(v[order, d], first)
    return code, low, high


def bounds(q: np.ndarray, code: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of each query's inner product with each vector of which only the cells are known.

    With m and h a cell's middle and half width, a component adds q * m, give or take |q| * h. Single-precision products
    are widened by what they may round off.
    """
    dims = np.arange(code.shape[1])
    middle, half = (low + high.astype(np.float64)) / 2, (high - low.astype(np.float64)) / 2
    most = np.abs(middle).max(1, initial=0) + half.max(1, initial=0)
    q64, q32 = np.abs(q.astype(np.float64)), q.astype(np.float32)
    near = (q32 @ middle.astype(np.float32)[dims, code].T).astype(np.float64)
    wide = (np.abs(q32) @ half.astype(np.float32)[dims, code].T).astype(np.float64)
    wide += (q64 @ most * ((code.shape[1] + 8) * 2.0**-23) + 1e-3)[:, None]
    return near - wide, near + wide


def candidates(q_ids: np.ndarray, q: np.ndarray, rows: np.ndarray, ids: np.ndarray, code: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For some queries at a time: (query, row, vector, lower, upper) of what may be among the block's k best, other than the query itself."""
    step = max(1, (1 << 22) // max(len(ids), 1))
    for i in range(0, len(q), step):
        least, most = bounds(q[i : i + step], code, low, high)
        same = q_ids[i : i + step, None] == ids[None, :]
        least[same], most[same] = -np.inf, -np.inf
        certain = np.partition(least, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) > k else np.full(len(least), -np.inf)
        who, at = np.nonzero((most >= certain[:, None]) & ~same)
        yield q_ids[i + who], rows[at], ids[at], least[who, at], most[who, at]


def _few_copies(vectors: DataFrame, k: int) -> DataFrame:
    """``vectors`` without copies that cannot be among any k best.

    Of one vector's copies the smallest ids win. Without the query's own id, of which k copies are kept, the k smallest
    are among the first 2k. Both limits are applied in each task before rows are exchanged.
    """
    key = F.xxhash64("v").alias("key")
    own = Window.partitionBy("key", "v", "vec_id").orderBy("vec_id")
    all_ = Window.partitionBy("key", "v").orderBy("vec_id")
    x = vectors.select("vec_id", "v", key).withColumn("n", F.row_number().over(own)).where(F.col("n") <= k)
    return x.withColumn("n", F.row_number().over(all_)).where(F.col("n") <= 2 * k).select("vec_id", "v")


def _blocks(rows: DataFrame, components: int, run, schema: str) -> DataFrame:
    """``run(dim, ids, rows, vectors, number)`` for blocks of the vectors of one length."""

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n = TaskContext.get().partitionId() << 32, 0
        held: dict[int, list[tuple]] = {}

        def out(dim: int) -> pa.RecordBatch:
            nonlocal n
            n += 1
            ids, row, v = zip(*held.pop(dim), strict=True)
            return run(dim, np.array(ids, np.int64), np.array(row, np.int64), np.array(v, np.int64), base + n)

        for b in batches:
            for i, r, x in zip(*(b.column(c).to_pylist() for c in ("vec_id", "row", "v")), strict=True):
                held.setdefault(len(x), []).append((i, r, x))
                if len(held[len(x)]) * len(x) >= components:
                    yield out(len(x))
        for dim in list(held):
            yield out(dim)

    return rows.mapInArrow(split, schema)


def _record(**cols: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([cols])


def approximation(exact: DataFrame) -> DataFrame:
    """The file of ``(vec_id, row, v)``: block, dim, ids, rows, cell numbers (a byte each), and the cells' bounds."""

    def run(dim: int, ids: np.ndarray, rows: np.ndarray, v: np.ndarray, block: int) -> pa.RecordBatch:
        code, low, high = cells_of(v)
        return _record(block=block, dim=dim, ids=ids.tobytes(), rows=rows.tobytes(), cells=code.tobytes(), low=low.tobytes(), high=high.tobytes())

    return _blocks(exact, COMPONENTS, run, "block long, dim long, ids binary, rows binary, cells binary, low binary, high binary")


def scan(asks: DataFrame, file: DataFrame, k: int) -> DataFrame:
    """Candidates of every query, by a scan of the file alone; ``asks`` is ``(vec_id, row, v)``."""

    def pack(dim: int, ids: np.ndarray, _: np.ndarray, v: np.ndarray, __: int) -> pa.RecordBatch:
        return _record(dim=dim, q_ids=ids.tobytes(), q=v.tobytes())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                dim = r["dim"]
                of = lambda c: np.frombuffer(r[c], np.int64)  # noqa: B023, E731
                code = np.frombuffer(r["cells"], np.uint8).reshape(-1, dim)
                for cols in candidates(of("q_ids"), of("q").reshape(-1, dim), of("rows"), of("ids"), code, of("low").reshape(dim, -1), of("high").reshape(dim, -1), k):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["query_id", "row", "vec_id", "low", "high"])

    asked = stash(_blocks(asks, ASKED, pack, "dim long, q_ids binary, q binary"))
    size = asked.agg(F.sum(F.octet_length("q"))).first()[0] or 0
    if size <= BROADCAST:
        both = file.join(F.broadcast(asked), "dim")
    else:
        # Every query block meets every block of its length once: the queries are copied, the file is not.
        where = file.select("dim", "block")
        both = file.join(asked.join(F.broadcast(where) if where.count() * 16 <= BROADCAST else where, "dim").hint("shuffle_hash"), ["dim", "block"])
    return both.select("dim", "ids", "rows", "cells", "low", "high", "q_ids", "q").mapInArrow(run, _FOUND)


def _exactly(found: DataFrame, exact: DataFrame, asks: DataFrame) -> DataFrame:
    """``found`` with the exact score: vectors are fetched by row, multiplied in batches."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v, q = b.column("v"), b.column("q")
            ends = np.concatenate(([0], np.cumsum(pc.list_value_length(v).to_numpy(zero_copy_only=False).astype(np.int64))))
            # Sums modulo 2 ** 64: differences of running sums are the rows' products whatever the running sums do.
            total = np.concatenate(([0], np.cumsum(v.flatten().to_numpy(zero_copy_only=False) * q.flatten().to_numpy(zero_copy_only=False))))
            product = total[ends[1:]] - total[ends[:-1]]
            yield pa.RecordBatch.from_arrays([b.column("query_id"), b.column("vec_id"), pa.array(product)], names=["query_id", "vec_id", "score"])

    few = found.select("row").distinct()
    few = F.broadcast(few) if few.count() * 16 <= BROADCAST else few
    wanted = exact.join(few, "row", "left_semi").select("row", "v")
    pairs = found.select("query_id", "row", "vec_id").join(wanted, "row").join(asks.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")), "query_id")
    return pairs.select("query_id", "vec_id", "v", "q").mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5, reads: bool = False) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k largest integer inner products for each query, itself left out.

    Both sides are ``integers()``. Queries meet vectors of their own length only; with fewer than k of them all come; ties
    go to the smaller vec_id. A repeated query id is one query (its least vector); candidates of the query's id never
    count; other repeated rows each do. Scores must fit 63 bits. Empty tables give no rows; other columns are not read.
    With ``reads``: one row for each query instead, with the exact vectors fetched for it.

    The scan is queries times vectors by nature; the exact table is exchanged once at most in each of the two fetches.
    """
    exact = stash(_few_copies(vectors, k).withColumn("row", F.monotonically_increasing_id()))
    asks = stash(queries.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("row", F.lit(0).cast("long")))
    found = stash(scan(asks, stash(approximation(exact)), k))
    best = Window.partitionBy("query_id").orderBy(F.desc("low"), "row")
    known = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k).groupBy("query_id").agg(F.min("low").alias("least"), F.count("*").alias("n"))
    left = found.join(known.select("query_id", F.when(F.col("n") == k, F.col("least")).alias("least")), "query_id").where("least IS NULL OR high >= least").drop("least")
    order = Window.partitionBy("query_id").orderBy(F.desc("high"), "row")
    left = stash(left.withColumn("at", F.row_number().over(order)))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    rank = F.row_number().over(order).alias("rank")
    first = stash(_exactly(left.where(F.col("at") <= 2 * k), exact, asks).select("*", rank).where(F.col("rank") <= k))
    sure = first.where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
    more = left.where(F.col("at") > 2 * k).join(sure, "query_id").where(F.col("high") >= F.col("kth"))
    if reads:
        return left.where(F.col("at") <= 2 * k).select("query_id").unionByName(more.select("query_id")).groupBy("query_id").agg(F.count("*").alias("n_read"))
    both = first.drop("rank").unionByName(_exactly(more, exact, asks))
    return both.select("query_id", rank.cast("int").alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
