"""Near copies by shingle-set similarity: MinHash cells for candidates, an exact Jaccard check of each candidate.

A text's shingles of ``size`` words form a set; texts of equal sets are one node. BANDS cells of ROWS minima each bring
nodes together: at similarity 0.8 a pair shares no cell with probability (1 - 0.8 ** 4) ** 24, about 3 in a million, and
less above. Every candidate is judged by its complete sets, so whatever is linked is similar.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm._stash import named, stash
from linkloom.llm._text import U64, mix, pieces, signed, texts
from linkloom.llm.components import connected_components, cut
from linkloom.llm.simhash import named_by_smallest, shingle_hashes, without

#: Words in a shingle, and the similarity from which texts are near copies.
SIZE, SIMILARITY = 5, 0.8
#: Cells of a set, and minima in a cell.
BANDS, ROWS = 24, 4
#: Bits of a set's bitmap.
BITS = 2048
#: Bytes of a table that is broadcast, at most; a larger one is joined by a shuffle.
BROADCAST = 32 << 20
_FACTORS = np.random.default_rng(5).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * U64(2) + U64(1)


def shingle_set(text: bytes, size: int = SIZE) -> np.ndarray:
    """The distinct shingle hashes in order; none without words."""
    parts = list(shingle_hashes(text, size))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, U64)


def cells(sets: list[np.ndarray]) -> np.ndarray:
    """BANDS cells for each of the sets, none of which is empty."""
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1])).astype(np.int64)
    every, out = np.concatenate(sets), np.empty((len(sets), BANDS), U64)
    for band in range(BANDS):
        key = np.full(len(sets), band + 1, U64)
        for factor in _FACTORS[band * ROWS : (band + 1) * ROWS]:
            key = mix(key ^ np.minimum.reduceat(every * factor, starts))
        out[:, band] = key
    return out


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two ordered sets have that Jaccard similarity or more."""
    if min(len(a), len(b)) < similarity * max(len(a), len(b)) - 1e-9:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both) - 1e-9


def bitmap(s: np.ndarray) -> bytes:
    """A bit for each value of the low bits of the set's hashes."""
    out = np.zeros(BITS, bool)
    out[(s & U64(BITS - 1)).astype(np.int64)] = True
    return np.packbits(out).tobytes()


def _sketches(keyed: DataFrame, size: int) -> DataFrame:
    """``(row, doc_id, text)`` to ``(row, doc_id, node, n, bits, cells)``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            sets = [shingle_set(x, size) for x in texts(b.column("text"))]
            node = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], U64)
            n = np.array([len(s) for s in sets], np.int32)
            found = cells([s for s in sets if len(s)]) if n.any() else np.zeros((0, BANDS), U64)
            ends = np.concatenate(([0], np.cumsum((n > 0) * BANDS))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(found.ravel())))
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), pa.array(signed(node)), pa.array(n), pa.array([bitmap(s) for s in sets], pa.binary()), lists], names=["row", "doc_id", "node", "n", "bits", "cells"])

    return keyed.mapInArrow(run, "row long, doc_id long, node long, n int, bits binary, cells array<long>")


def _sets(rows: DataFrame, size: int) -> DataFrame:
    """``(node, text)`` to ``(node, s)``, the set as bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array([shingle_set(x, size).tobytes() for x in texts(b.column("text"))], pa.binary())], names=["node", "s"])

    return rows.mapInArrow(run, "node long, s binary")


def _judged(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``(a, b)`` that are similar."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x"), batch.column("y")
            ok = [similar(np.frombuffer(x[i].as_buffer(), U64), np.frombuffer(y[i].as_buffer(), U64), similarity) for i in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    x, y = sets.select(F.col("node").alias("a"), F.col("s").alias("x")), sets.select(F.col("node").alias("b"), F.col("s").alias("y"))
    # Few first ends (a leader for each group): their sets go to the pairs, which then need not move with a set in tow.
    few = x.join(pairs.select("a").distinct(), "a", "left_semi")
    size = few.agg(F.sum(F.octet_length("x") + 32)).first()[0] or 0
    return pairs.join(y, "b").join(F.broadcast(few) if size <= BROADCAST else x, "a").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _possible(pairs: DataFrame, marks: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``(a, b)`` whose bitmaps (``marks``: node, n, bits) do not rule the similarity out; exact, and without the sets.

    Each bit in which two bitmaps differ comes from a shingle that one of the texts lacks, and similar sets differ in
    (1 - similarity) / (1 + similarity) of their sizes' sum at most.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), U64).reshape(-1, BITS // 64) for c in ("x", "y"))
            size = b.column("n").to_numpy(zero_copy_only=False) * ((1 - similarity) / (1 + similarity)) + 1e-6
            yield b.select(["a", "b"]).filter(pa.array(np.bitwise_count(x ^ y).sum(1) <= size))

    small = marks.count() * (BITS // 8 + 16) <= BROADCAST
    ends = [marks.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(v)) for c, v in (("a", "x"), ("b", "y"))]
    both = pairs
    for c, end in zip("ab", ends, strict=True):
        both = both.join(F.broadcast(end) if small else end, c)
    return both.select("a", "b", (F.col("n_a") + F.col("n_b")).alias("n"), "x", "y").mapInArrow(run, "a long, b long")


def _risen(first: DataFrame, jumps: int = 2) -> DataFrame:
    """``(a, b)``, one ``a`` for each ``b``, with ``a`` moved up to the fourth ancestor, or to the root where that is nearer.

    It only tells which pairs need not be judged again, so what lies deeper costs judgements, not links.
    """
    most = first.count()
    for _ in range(jumps):
        inner = first.join(first.select(F.col("a").alias("b")).distinct(), "b", "left_semi").select(F.col("b").alias("a"), F.col("a").alias("above"))
        small = inner.count() * 24 <= BROADCAST
        first = cut(first.join(F.broadcast(inner) if small else inner, "a", "left").select(F.coalesce("above", "a").alias("a"), "b"), most)
    return first


def links(members: DataFrame, sets: DataFrame, marks: DataFrame, similarity: float) -> DataFrame:
    """``(cell, lead, node, n)`` of the cells of several nodes to links whose components are those of all similar pairs that share a cell.

    First each node is held against one leader, the least of its cells' smallest nodes. What then has no common ancestor
    is held against each other: every such pair has an end outside the cell's chosen tree, so those ends ask. Pairs that their bitmaps rule out go before any set is moved.
    """
    stars = cut(members.where("node <> lead").groupBy(F.col("node").alias("b")).agg(F.min("lead").alias("a")).select("a", "b"))
    first = cut(_judged(cut(_possible(stars, marks, similarity)), sets, similarity))
    risen = _risen(first).select(F.col("b").alias("node"), F.col("a").alias("above"))
    rooted = members.join(risen, "node", "left").select("cell", "node", "n", F.coalesce("above", "node").alias("root"))
    rooted = cut(rooted)
    mixed = rooted.groupBy("cell", "root").agg(F.count("*").alias("k")).groupBy("cell").agg(F.max_by("root", "k").alias("main"), F.count("*").alias("roots")).where("roots > 1").select("cell", "main")
    asked = cut(rooted.join(mixed, "cell"))
    asks = asked.where("root <> main").select("cell", F.col("node").alias("node_"), F.col("n").alias("n_"), F.col("root").alias("root_"))
    alike = (F.col("root") != F.col("root_")) & (F.least("n", "n_") >= F.greatest("n", "n_") * similarity - 1e-9)
    rest = asks.join(asked, "cell").where(alike).select(F.least("node", "node_").alias("a"), F.greatest("node", "node_").alias("b")).distinct()
    return first.unionByName(_judged(cut(_possible(rest, marks, similarity)), sets, similarity))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose id is the smallest of their class of near copies.

    Links are pairs of ``similarity`` or more; a class is what they connect. Null and wordless texts have no shingles
    and are copies of each other. Ids are treated as in ``simhash.representatives``.
    """
    ident, text = F.col(named(id_col)), F.col(named(text_col))
    keyed = docs.select(F.xxhash64(ident, text).alias("row"), ident.cast("long").alias("doc_id"), text.alias("text"))
    sketches = stash(_sketches(keyed, size))
    # Texts of equal sets are one node: of its rows one has the cells, found by its key, so cells never meet before they are few.
    nodes = cut(sketches.groupBy("node").agg(F.min("doc_id").alias("low"), F.min("row").alias("row")))
    firsts = nodes.select("node", "row")
    firsts = F.broadcast(firsts) if firsts.count() * 24 <= BROADCAST else firsts
    cells_of = sketches.join(firsts, ["node", "row"], "left_semi").dropDuplicates(["node"]).select("node", "n", F.explode("cells").alias("cell"))
    members = stash(cells_of)
    shared = cut(members.groupBy("cell").agg(F.min("node").alias("lead"), F.count("*").alias("k")).where("k > 1").select("cell", "lead"))
    members = stash(members.join(F.broadcast(shared) if shared.count() * 24 <= BROADCAST else shared, "cell").select("cell", "lead", "node", "n"))
    one = nodes.join(members.select("node").distinct(), "node", "left_semi").select("row", "node")
    sets = stash(_sets(keyed.select("row", "text").join(one, "row").select("node", "text").dropDuplicates(["node"]), size))
    marks = stash(sketches.join(one, ["node", "row"], "left_semi").dropDuplicates(["node"]).select("node", "n", "bits"))
    found = connected_components(links(members, sets, marks, similarity)).withColumnsRenamed({"component": "root"})
    classes = cut(named_by_smallest(nodes.join(found, "node", "left").select("node", "low", "root"), "node"))
    gone = sketches.select("row", "doc_id", "node").join(classes, "node").where("NOT doc_id <=> component_id")
    return without(docs, gone, id_col, text_col)
