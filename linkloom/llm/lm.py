"""Stupid-backoff scores of documents against all other documents' n-gram counts.

Rows are dealt to blocks of some megabytes, whatever their id and text, so copies spread. A block's distinct n-grams,
named by 64-bit hashes, go with their counts to the parts of the count table that their hashes belong to; those parts
add up all blocks and answer each with the totals; the block joins them to its exploded n-grams, takes off each
document's own share, and sums by document. An n-gram crosses the network once for each block, however often it stands
there, so frequent ones make no partition heavy.

What is exchanged is the relation (part, n, block, n-gram, count). Its rows are packed by (part, n, block), n-grams in
order and as byte planes: plain rows take about 12 bytes an n-gram each way instead of five and one. There is a packed
row only where there are n-grams, so packed rows are never more than n-grams and grow in proportion to the input.

Two different n-grams share a name with probability 2 ** -64. Of N different n-grams a share of N / 2 ** 64 at most is
expected to meet another's count: under one in a million up to 1.8e13, beyond 100 TB of text.

With c the counts in all other documents and a = 0.4: S(w | u v) is c(u v w) / c(u v) if c(u v w) > 0, else a S(w | v);
S(w | v) is c(v w) / c(v) if c(v w) > 0, else a S(w); S(w) is max(c(w), 1) / (n + 1) with n the words of the others. A
document's first words have the shorter context, without a factor.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm._text import U64, batch_words, mix, pieces, texts

ORDER, ALPHA = 3, 0.4
#: Bytes of text in a block, and n-grams in a part of a count table, about.
BLOCK, PART = 12 << 20, 2_000_000
LEAST_BLOCK = 2 << 20
#: Tasks that blocks and parts are dealt to at most; a task takes several one after another.
TASKS = 50_000
_K = (U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9))
_PACK, _UNPACK = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
_KIND = "part int, n int, block long, grams binary, counts binary"


def grams(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams in the texts, and the place of each one's last word."""
    row = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(n - 1, len(words))
    at = at[row[at] == row[at - n + 1]]
    h = words[at]
    for k in range(1, n):
        h = mix(h) + words[at - k] * _K[k]
    return mix(h + U64(n)), at


def packed(x: np.ndarray, width: int, rising: bool = False) -> bytes:
    """Numbers, or the steps between rising ones, as planes of bytes: the high planes hardly differ, and compress away."""
    if rising and len(x):
        x = np.concatenate((x[:1], np.diff(x)))
    return _PACK.compress(x.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width :].T.tobytes())


def unpacked(x: bytes, width: int, rising: bool = False) -> np.ndarray:
    planes = np.frombuffer(_UNPACK.decompress(x), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, 8 - width :] = planes.T
    out = out.reshape(-1).view(">u8").astype(U64)
    return np.cumsum(out, dtype=U64) if rising else out


def _cuts(u: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Parts that n-grams in order fall into, and where each of these starts and ends; their top bits pick the part."""
    part = ((u >> U64(32)) * U64(parts)) >> U64(32)
    first = np.nonzero(np.concatenate(([True], part[1:] != part[:-1])))[0] if len(u) else np.zeros(0, np.int64)
    return part[first].astype(np.int32), np.append(first, len(u))


def _zipped(column: pa.Array) -> pa.Array:
    return pa.array([_PACK.compress(x) for x in texts(column)], pa.binary())


def _texts(column: pa.Array) -> list[bytes]:
    return [_UNPACK.decompress(x) if x else b"" for x in column.to_pylist()]


def _ask(order: int, parts: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(block: int, held: list) -> Iterator[pa.RecordBatch]:
            words, counts = np.concatenate([w for w, _ in held]), np.concatenate([c for _, c in held])
            for n in range(1, order + 1):
                u, c = np.unique(grams(words, counts, n)[0], return_counts=True)
                some, cut = _cuts(u, parts)
                ends = list(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True))
                cols = [pa.array(some, pa.int32()), pa.array([n] * len(some), pa.int32()), pa.array([block] * len(some), pa.int64())]
                cols += [pa.array([packed(u[i:j], 8, True) for i, j in ends], pa.binary()), pa.array([packed(c[i:j], 4) for i, j in ends], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["part", "n", "block", "grams", "counts"])

        now, held = None, []
        for b in pieces(batches, "text"):
            block = b.column("block").to_numpy()
            edges = np.concatenate(([0], np.nonzero(block[1:] != block[:-1])[0] + 1, [len(block)]))
            for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if block[i] != now:
                    if held:
                        yield from out(now, held)
                    now, held = int(block[i]), []
                held.append(batch_words(_texts(b.column("text").slice(i, j - i))))
        if held:
            yield from out(now, held)

    return run


def _answer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (n, part): totals over the blocks, for each block in its order."""

    def out(key: tuple, held: list) -> Iterator[pa.RecordBatch]:
        sizes = [len(g) for _, g, _ in held]
        u, at = np.unique(np.concatenate([g for _, g, _ in held]), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate([c for _, _, c in held]), minlength=len(u)).astype(U64)[at]
        split = np.split(total, np.cumsum(sizes)[:-1])
        cols = [pa.array([key[1]] * len(held), pa.int32()), pa.array([key[0]] * len(held), pa.int32()), pa.array([b for b, _, _ in held], pa.int64()), pa.array([packed(t, 5) for t in split], pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, names=["part", "n", "block", "totals"])

    now, held = None, []
    for b in batches:
        n, part, block, g, c = (b.column(k).to_pylist() for k in ("n", "part", "block", "grams", "counts"))
        for i in range(b.num_rows):
            if (n[i], part[i]) != now:
                if held:
                    yield from out(now, held)
                now, held = (n[i], part[i]), []
            held.append((block[i], unpacked(g[i], 8, True), unpacked(c[i], 4)))
    if held:
        yield from out(now, held)


def backoff(words: np.ndarray, counts: np.ndarray, totals: list[np.ndarray], everything: int, alpha: float = ALPHA) -> np.ndarray:
    """Sum of log S over each text. ``totals[n - 1]``: counts of the block's sorted distinct n-grams in all documents."""
    row = np.repeat(np.arange(len(counts)), counts)
    others: list[np.ndarray] = []
    for n, total in enumerate(totals, 1):
        h, at = grams(words, counts, n)
        _, inv = np.unique(h, return_inverse=True)
        rest = total[inv].astype(np.int64) - 1
        more = np.nonzero(rest > 0)[0]  # an n-gram that stands once in all has no other document
        if len(more):
            _, mine, own = np.unique(inv[more] * len(counts) + row[at[more]], return_inverse=True, return_counts=True)
            rest[more] += 1 - own[mine]
        c = np.zeros(len(words), np.int64)
        c[at] = rest
        others.append(c)
    rest = np.maximum(everything - counts, 0)[row]
    score = np.log(np.maximum(others[0], 1) / (rest + 1))
    for n in range(2, len(totals) + 1):
        c, context = others[n - 1], np.concatenate(([0], others[n - 2][:-1])) if len(words) else others[n - 2]
        first = np.concatenate([np.arange(min(n - 1, k)) for k in counts]) if len(counts) else np.zeros(0, np.int64)
        start = np.repeat(np.cumsum(counts) - counts, np.minimum(counts, n - 1)) + first
        short = np.zeros(len(words), bool)
        short[start.astype(np.int64)] = True
        hit = (c > 0) & ~short
        score = np.where(hit, np.log(np.where(hit, c, 1) / np.where(hit, np.maximum(context, 1), 1)), np.where(short, score, score + np.log(alpha)))
    return np.bincount(row, weights=score, minlength=len(counts)).astype(np.float64)


def score(docs: DataFrame, order: int = ORDER, block_bytes: int = BLOCK, part_grams: int = PART, alpha: float = ALPHA) -> DataFrame:
    """doc_id, n_words, log_score (sum of natural logs), mean_log_score for each row of ``docs``.

    Rows are documents: rows that repeat an id or a text count as others to each other. Null and empty texts have no
    words, a sum of 0 and a null mean; a null id keeps its row; an empty table gives none; other columns are not read.
    A block and a part fit in a task's memory at any size of the corpus; a single document, of whatever length, must, too.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = words = 0
        for b in pieces(batches):
            for x in texts(b.column("text")):
                size, words = size + len(x), words + len(x.split())
        yield pa.RecordBatch.from_arrays([pa.array([size]), pa.array([words])], names=["size", "words"])

    size, everything = docs.select("text").mapInArrow(measure, "size long, words long").agg(F.sum("size"), F.sum("words")).first()
    size, everything = size or 0, everything or 0
    # Blocks are as small as all cores need, but of LEAST_BLOCK bytes.
    cores = docs.sparkSession.sparkContext.defaultParallelism
    blocks, parts = max(1, -(-size // block_bytes), min(cores, size // LEAST_BLOCK)), max(1, -(-everything // part_grams))

    def compress(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), _zipped(b.column("text"))], names=["doc_id", "text"])

    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).alias("block")
    # Twice as many tasks as blocks and parts: few tasks then get several.
    tasks, adding = min(2 * blocks, TASKS), min(2 * parts * order, TASKS)
    dealt = docs.mapInArrow(compress, "doc_id long, text binary").select("doc_id", "text", block).repartition(tasks, "block")
    # All columns stay, so that both readers of ``dealt`` share one exchange.
    asked = dealt.sortWithinPartitions("block").mapInArrow(_ask(order, parts), _KIND)
    answers = asked.repartition(adding, "n", "part").sortWithinPartitions("n", "part").mapInArrow(_answer, "part int, n int, block long, totals binary").repartition(tasks, "block")

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        words, counts = batch_words([x for c in left.column("text").chunks for x in _texts(c)])
        found = sorted(zip(right.column("n").to_pylist(), right.column("part").to_pylist(), right.column("totals").to_pylist(), strict=True))
        totals = [np.concatenate([np.zeros(0, U64), *(unpacked(t, 5) for k, _, t in found if k == n)]) for n in range(1, order + 1)]
        s = backoff(words, counts, totals, everything, alpha)
        mean = np.divide(s, counts, out=np.zeros(len(s)), where=counts > 0)
        return pa.table({"doc_id": left.column("doc_id"), "n_words": pa.array(counts, pa.int64()), "log_score": pa.array(s), "mean_log_score": pa.array(mean, mask=counts == 0)})

    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, "doc_id long, n_words long, log_score double, mean_log_score double")


def rounded(docs: DataFrame) -> DataFrame:
    return score(docs).select("doc_id", "n_words", F.round("log_score", 3).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score"))


SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
t AS (SELECT rid, unnest(w) AS w, unnest(range(1, len(w) + 1)) AS i FROM d),
g AS (SELECT rid, i, w, lag(w) OVER (PARTITION BY rid ORDER BY i) AS v, lag(w, 2) OVER (PARTITION BY rid ORDER BY i) AS u FROM t),
n AS (SELECT count(*) AS n FROM g), m AS (SELECT rid, count(*) AS m FROM g GROUP BY rid),
o1 AS (SELECT rid, w, count(*) AS c FROM g GROUP BY ALL), o2 AS (SELECT rid, v, w, count(*) AS c FROM g WHERE v IS NOT NULL GROUP BY ALL),
o3 AS (SELECT rid, u, v, w, count(*) AS c FROM g WHERE u IS NOT NULL GROUP BY ALL),
c1 AS (SELECT *, sum(c) OVER (PARTITION BY w) - c AS r FROM o1), c2 AS (SELECT *, sum(c) OVER (PARTITION BY v, w) - c AS r FROM o2),
c3 AS (SELECT *, sum(c) OVER (PARTITION BY u, v, w) - c AS r FROM o3),
s AS (
  SELECT g.rid, ln(CASE WHEN coalesce(c3.r, 0) > 0 THEN CAST(c3.r AS DOUBLE) / p2.r
    ELSE (CASE WHEN g.u IS NULL THEN 1 ELSE 0.4 END) * (CASE WHEN coalesce(c2.r, 0) > 0 THEN CAST(c2.r AS DOUBLE) / p1.r
      ELSE (CASE WHEN g.v IS NULL THEN 1 ELSE 0.4 END) * greatest(CAST(c1.r AS DOUBLE), 1) / (n.n - m.m + 1) END) END) AS x
  FROM g CROSS JOIN n JOIN m USING (rid)
  JOIN c1 ON c1.rid = g.rid AND c1.w = g.w
  LEFT JOIN c2 ON c2.rid = g.rid AND c2.v = g.v AND c2.w = g.w
  LEFT JOIN c3 ON c3.rid = g.rid AND c3.u = g.u AND c3.v = g.v AND c3.w = g.w
  LEFT JOIN c2 p2 ON p2.rid = g.rid AND p2.v = g.u AND p2.w = g.v
  LEFT JOIN c1 p1 ON p1.rid = g.rid AND p1.w = g.v),
a AS (SELECT rid, sum(x) AS x, count(*) AS k FROM s GROUP BY rid)
SELECT doc_id, CAST(coalesce(k, 0) AS BIGINT) AS n_words, round(coalesce(x, 0), 3) AS log_score, round(x / k, 6) AS mean_log_score FROM d LEFT JOIN a USING (rid)
"""
