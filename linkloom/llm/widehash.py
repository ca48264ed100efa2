"""Near copies by SimHash: fingerprints wide enough for a shingle-set similarity of 0.8, an exact Jaccard check of each candidate.

A text's shingles of five words form a set; texts of equal sets are one node. At similarity 0.8 two fingerprints differ in
about 15 % of their bits (the angle between the sets, over pi), too many for an index of all near values of 64 bits.
So a node has WIDE bits, and multi-index hashing takes TABLES tables, each by TAKEN of the bits: at 0.8 a pair has no
equal key in any of them about 5 times in a million, and less above. Nodes of a key are held against each other by CHECK
bits, of which a pair at 0.8 differs in more than APART with a chance below 1 in a million; these are figures by
calculation, for sets of some dozens of shingles and more. Every candidate is judged by its complete sets, in the tasks:
pairs of a group grow with its square, so they are never rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm._stash import named, stash
from linkloom.llm._text import U64, mix, pieces, signed, texts
from linkloom.llm.components import connected_components, cut
from linkloom.llm.minhash import BROADCAST, SIMILARITY, SIZE, _sets, bitmap, shingle_set, similar
from linkloom.llm.simhash import _BITS, named_by_smallest, without

WIDE, TABLES, TAKEN = 512, 72, 10
CHECK, APART = 256, 77
#: Nodes for which a cluster gets a part, and parts that it has at most.
PART, PARTS = 128, 16
#: Shingles counted at once, and pairs of fingerprints compared at once.
STEP, PAIRS = 1 << 16, 1 << 20
_RANDOM = np.random.default_rng(11)
_FACTORS = _RANDOM.integers(0, 1 << 63, WIDE // 64, dtype=np.uint64) * U64(2) + U64(1)
_CHECKS = [f"c{i}" for i in range(CHECK // 64)]
_TAKEN = np.stack([_RANDOM.permutation(WIDE)[:TAKEN] for _ in range(TABLES)])


def wide_fingerprint(s: np.ndarray) -> np.ndarray:
    """WIDE bits as bytes, each set in over half of the values that the hashes of the set have for it."""
    counts = np.zeros(WIDE, np.int64)
    for at in range(0, len(s), STEP):
        planes = mix(s[at : at + STEP, None] * _FACTORS).astype(">u8").view(np.uint8).reshape(-1, WIDE // 8)
        if len(planes) < 64:
            counts += np.unpackbits(planes, axis=1).sum(0, dtype=np.int64)
        else:
            counts += np.concatenate([np.bincount(planes[:, i], minlength=256) @ _BITS for i in range(WIDE // 8)])
    return np.packbits(2 * counts > len(s))


def _sketches(keyed: DataFrame, size: int) -> DataFrame:
    """``(row, doc_id, text)`` to ``(row, doc_id, node, n, bits, fp)``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            sets = [shingle_set(x, size) for x in texts(b.column("text"))]
            node = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], U64)
            columns = [pa.array(signed(node)), pa.array([len(s) for s in sets], pa.int32()), pa.array([bitmap(s) for s in sets], pa.binary()), pa.array([wide_fingerprint(s).tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), *columns], names=["row", "doc_id", "node", "n", "bits", "fp"])

    return keyed.mapInArrow(run, "row long, doc_id long, node long, n int, bits binary, fp binary")


def _dealt(nodes: DataFrame) -> DataFrame:
    """``(node, n, fp)`` to ``(key, node, n, c0 ...)``, a row for each table, together and ordered by key and n."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(i, 1000) for i in range(0, whole.num_rows, 1000)):
                fp = np.frombuffer(b"".join(b.column("fp").to_pylist()), np.uint8).reshape(-1, WIDE // 8)
                taken = np.unpackbits(fp, axis=1)[:, _TAKEN.ravel()].reshape(-1, TABLES, TAKEN).astype(np.int32)
                key = (taken @ (1 << np.arange(TAKEN, dtype=np.int32))) + (np.arange(TABLES, dtype=np.int32) << TAKEN)
                check = np.ascontiguousarray(fp[:, : CHECK // 8]).view(np.int64)
                each = lambda x: pa.array(np.repeat(x, TABLES))
                longs = [each(b.column(c).to_numpy()) for c in ("node", "n")]
                yield pa.RecordBatch.from_arrays([pa.array(key.ravel().astype(np.int32)), *longs, *(each(c) for c in check.T)], names=["key", "node", "n", *_CHECKS])

    rows = nodes.select("node", "n", "fp").mapInArrow(run, ", ".join(["key int", "node long", "n int", *(f"{c} long" for c in _CHECKS)]))
    return rows.repartition("key").sortWithinPartitions("key", "n")


def _grouped(batches: Iterable[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of each run of rows with the same key."""
    kept: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [c.to_numpy() for c in batch.columns]
        if kept is not None:
            cols = [np.concatenate((x, y)) for x, y in zip(kept, cols, strict=True)]
        cuts = [0, *(np.nonzero(cols[0][1:] != cols[0][:-1])[0] + 1).tolist()]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield [c[a:b] for c in cols]
        kept = [c[cuts[-1] :] for c in cols]
    if kept is not None:
        yield kept


def _close(group: list[np.ndarray], similarity: float, roots: Callable[[], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs of a group that sizes and the check bits leave possible and whose roots, as they are by then, differ; a group is ordered by n."""
    n, check = group[2], group[3:]
    # Those up to n / similarity shingles stand behind a node.
    end = np.searchsorted(n, (n / similarity + 1e-9).astype(np.int64), "right")
    at = 0
    while at < len(n) - 1:
        to = min(len(n) - 1, at + max(1, PAIRS // (len(n) - at)))
        stop, root = int(end[to - 1]), roots()
        if (root[at:stop] == root[at]).all():
            at = to
            continue
        x, y = slice(at, to), slice(at + 1, stop)
        near = np.zeros((to - at, max(0, stop - at - 1)), np.uint16)
        for c in check:
            c = c.view(U64)
            near += np.bitwise_count(c[x, None] ^ c[None, y])
        i, j = np.nonzero(near <= APART)
        i, j = i + at, j + at + 1
        ok = (j > i) & (j < end[i]) & (root[i] != root[j])
        if ok.any():
            yield i[ok], j[ok]
        at = to


def _merged(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``root``, the first place of each place's class, after the classes of ``i`` and ``j`` have become one, pair by pair."""
    while True:
        x, y = root[i], root[j]
        apart = x != y
        if not apart.any():
            return root
        i, j, x, y = i[apart], j[apart], x[apart], y[apart]
        up = np.arange(len(root))
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
        while (up != (higher := up[up])).any():
            up = higher
        root = up[root]


def _met(dealt: DataFrame, similarity: float) -> DataFrame:
    """``(a, b)``: the nodes of a key that chains of close pairs connect, each with one of them, so rows grow with nodes and not with pairs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches):
            node = group[1]
            root = np.arange(len(node))
            for i, j in _close(group, similarity, lambda: root):  # noqa: B023
                root = _merged(root, i, j)
            # The same one for most keys: the least by a hash.
            order = np.argsort(mix(node.view(U64)))[::-1]
            lead = np.empty_like(node)
            lead[root[order]] = node[order]
            a = lead[root]
            led = a != node
            if led.any():
                yield pa.RecordBatch.from_arrays([pa.array(a[led]), pa.array(node[led])], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _linked(nodes: list[tuple], cross: int, similarity: float) -> list[tuple[int, int]]:
    """Links that connect what all similar pairs of a cell connect; ``nodes``: (node, check bits, set).

    Pairs are those of the first ``cross`` with the others, or all if there are no others. Once connected, two are not held against each other.
    """
    sets = [s for _, _, s in nodes]
    n = np.array([len(s) for s in sets])
    check, bits = (np.frombuffer(b"".join(x), U64).reshape(len(sets), -1) for x in ([c for _, c, _ in nodes], map(bitmap, sets)))
    root, out = np.arange(len(nodes)), []
    for x in range(cross):
        y = np.arange(cross if cross < len(nodes) else x + 1, len(nodes))
        y = y[root[y] != root[x]]
        y = y[np.bitwise_count(check[y] ^ check[x]).sum(1) <= APART]
        y = y[np.minimum(n[y], n[x]) >= similarity * np.maximum(n[y], n[x]) - 1e-9]
        # As in minhash._possible: exact, each bit apart comes from a shingle that one of them lacks.
        y = y[np.bitwise_count(bits[y] ^ bits[x]).sum(1) <= (n[y] + n[x]) * ((1 - similarity) / (1 + similarity)) + 1e-6]
        for z in y.tolist():
            if root[z] != root[x] and similar(sets[x], sets[z], similarity):
                root[root == max(root[x], root[z])] = min(root[x], root[z])
                out.append((nodes[x][0], nodes[z][0]))
    return out


def _judged(rows: DataFrame, similarity: float) -> DataFrame:
    """The links ``(a, b)`` of each cell, from its nodes ``(cluster, i, j, role, node, c, s)``, whose sets are held against each other in its task."""

    def links_of(cell: list[tuple]) -> pa.RecordBatch:
        found = _linked([x[1:] for x in cell], sum(x[0] == 0 for x in cell), similarity)
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], names=["a", "b"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, cell = None, []
        for b in batches:
            s = b.column("s")
            for k, row in enumerate(zip(*(b.column(c).to_pylist() for c in ("cluster", "i", "j", "role", "node", "c")), strict=True)):
                if row[:3] != key:
                    if len(cell) > 1:
                        yield links_of(cell)
                    key, cell = row[:3], []
                cell.append((*row[3:], np.frombuffer(s[k].as_buffer(), U64).copy()))
        if len(cell) > 1:
            yield links_of(cell)

    spark = rows.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # By range: tasks get about as many rows each, and a cell is never parted.
    dealt = rows.repartitionByRange(tasks, "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "role", "node")
    return dealt.mapInArrow(run, "a long, b long")


def _cells(clusters: DataFrame) -> DataFrame:
    """``(node, cluster)`` to ``(node, cluster, i, j, role)``: each pair of a cluster's parts is a cell, and a node is in all cells of its part.

    A cluster has a part for each PART nodes, up to PARTS of them, so a node is in PARTS cells at most.
    """
    parts = clusters.groupBy("cluster").agg(F.least(F.lit(PARTS), F.ceil(F.count("*") / PART)).cast("int").alias("parts"))
    many = parts.where("parts > 1")
    many = F.broadcast(many) if many.count() * 24 <= BROADCAST else many
    x = clusters.join(many, "cluster", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    x = x.withColumn("own", F.pmod(F.xxhash64("node"), "parts").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return x.select("node", "cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("role"))


def links(nodes: DataFrame, sets: Callable[[DataFrame], DataFrame], similarity: float = SIMILARITY) -> DataFrame:
    """``(node, n, bits, fp)`` to links ``(a, b)`` whose components are those of all similar pairs that a table brings together.

    Pairs are never rows: what chains of close pairs connect is a cluster, and the nodes of a cluster are held against each
    other in its cells' tasks, each of which gives links enough to connect what it found. ``sets`` gives ``(node, s)`` of nodes.
    """
    clusters = cut(connected_components(cut(_met(_dealt(nodes), similarity))).select("node", F.col("component").alias("cluster")))
    cells, of = cut(_cells(clusters)), clusters.select("node")
    few = F.broadcast(of) if of.count() * 16 <= BROADCAST else of
    marks = nodes.join(few, "node", "left_semi").select("node", F.substring("fp", 1, CHECK // 8).alias("c"))
    held = stash(sets(of).join(F.broadcast(marks) if of.count() * 48 <= BROADCAST else marks, "node"))
    return stash(_judged(held.join(F.broadcast(cells) if cells.count() * 48 <= BROADCAST else cells, "node"), similarity))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose id is the smallest of their class of near copies.

    Links are pairs of ``similarity`` or more; a class is what they connect. Null and wordless texts have no shingles
    and are copies of each other. Ids are treated as in ``simhash.representatives``.
    """
    ident, text = F.col(named(id_col)), F.col(named(text_col))
    keyed = docs.select(F.xxhash64(ident, text).alias("row"), ident.cast("long").alias("doc_id"), text.alias("text"))
    sketches = stash(_sketches(keyed, size))
    # Texts of equal sets are one node: of its rows one stands for it, found by its key, so fingerprints are not exchanged to become few.
    nodes = cut(sketches.groupBy("node").agg(F.min("doc_id").alias("low"), F.min("row").alias("row")))
    firsts = nodes.select("node", "row")
    firsts = F.broadcast(firsts) if firsts.count() * 24 <= BROADCAST else firsts
    marks = stash(sketches.join(firsts, ["node", "row"], "left_semi").dropDuplicates(["node"]).where("n > 0").select("node", "n", "bits", "fp"))

    def sets(of: DataFrame) -> DataFrame:
        one = nodes.join(F.broadcast(of) if of.count() * 16 <= BROADCAST else of, "node", "left_semi").select("row", "node")
        one = F.broadcast(one) if one.count() * 24 <= BROADCAST else one
        return _sets(keyed.select("row", "text").join(one, "row").select("node", "text").dropDuplicates(["node"]), size)

    found = connected_components(links(marks, sets, similarity)).withColumnsRenamed({"component": "root"})
    classes = cut(named_by_smallest(nodes.join(found, "node", "left").select("node", "low", "root"), "node"))
    gone = sketches.select("row", "doc_id", "node").join(classes, "node").where("NOT doc_id <=> component_id")
    return without(docs, gone, id_col, text_col)
