"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits. Fingerprints within ``bits`` differing bits are linked; documents of one component form a
class. With s segments and ``bits = s * r + a``, two linked fingerprints differ by at most r bits in one of the first
a + 1 segments or by at most r - 1 bits in one of the others. So the table holds every fingerprint under its segment
values, each fingerprint asks for the values of those small Hamming balls, and complete distances are verified on what
is found. Only distinct fingerprints take part: copies meet in an aggregation before.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm._stash import fresh, named
from linkloom.llm._text import STEP, U64, pieces, signed, spans, texts
from linkloom.llm.components import connected_components, cut

#: How many of the 8 bits are set, for each byte and bit position.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
#: A cell of the table with more fingerprints than this is dealt to several tasks.
CELL = 1024
#: Tasks that the members of a class are dealt to when they learn its smallest id.
DEALT = 32


def shingle_hashes(text: bytes, size: int = 4, seed: int = 42) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of ``size`` words, lower-cased (A-Z), space-joined, repeats included, in parts.

    Fewer words than ``size`` make one shingle; no words make none.
    """
    digest, kept, any_yet = xxhash.xxh64_intdigest, [], False
    for part in spans(text, STEP):
        words = kept + part.lower().split()
        if len(words) >= size:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = np.concatenate(([0], ends[:-1]))[: len(words) - size + 1].tolist()
            ends = (ends[size - 1 :] - 1).tolist()
            yield np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, ends, strict=True)), U64, len(starts))
            any_yet = True
            kept = words[len(words) - size + 1 :]
        else:
            kept = words
    if not any_yet and kept:
        yield np.array([digest(b" ".join(kept), seed)], U64)


def fingerprint(text: bytes, size: int = 4, seed: int = 42) -> int:
    """The bits set in over half the shingle hashes; 0 without words."""
    counts, n = np.zeros(64, np.int64), 0
    for h in shingle_hashes(text, size, seed):
        n += len(h)
        planes = h.astype(">u8").view(np.uint8).reshape(-1, 8)
        if len(h) < 64:
            counts += np.unpackbits(planes, axis=1).sum(0, dtype=np.int64)
        else:
            counts += np.concatenate([np.bincount(planes[:, i], minlength=256) @ _BITS for i in range(8)])
    return int(np.packbits(2 * counts > n).view(">u8")[0]) if n else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4) -> DataFrame:
    """``(doc_id, fp)`` for every row; ``fp`` is the fingerprint as a signed long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            fp = np.array([fingerprint(x, size) for x in texts(b.column("text"))], U64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(signed(fp))], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, fp long")


def segments(parts: int, bits: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of each segment, from the high bits down."""
    r, a = divmod(bits, parts)
    out, top = [], 64
    for i in range(parts):
        width = 64 // parts + (i < 64 % parts)
        top -= width
        out.append((top, width, r if i <= a else r - 1))
    return [x for x in out if x[2] >= 0]


def _cell(fp: Column, k: int, shift: int, width: int, flip: int = 0) -> Column:
    value = F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1)).bitwiseXOR(F.lit(flip))
    return F.lit(k << 40).cast("long").bitwiseOR(value.cast("long"))


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (node, smallest node) of the links, so that a dense group yields no more rows than nodes."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def _verify(batches: Iterable[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (cell, tb, pb, probe), table entries first: links found, as a forest for each part."""

    def links(group: np.ndarray, probe: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        entries, asks = np.nonzero(~probe)[0], np.nonzero(probe)[0]
        first = np.searchsorted(group[entries], group[asks], "left")
        n = np.searchsorted(group[entries], group[asks], "right") - first
        found: list[tuple[np.ndarray, np.ndarray]] = []
        at, ends = 0, np.cumsum(n)
        while at < len(asks):
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + 1_000_000, "right")))
            m = n[at:to]
            who = np.repeat(np.arange(at, to), m)
            t = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + first[who]
            x, y = fp[asks[who]], fp[entries[t]]
            ok = (x > y) & (np.bitwise_count(x ^ y) <= bits)
            if ok.any():
                found.append(_forest(x[ok], y[ok]))
            at = to
        if found:
            a, b = _forest(np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]))
            yield pa.RecordBatch.from_arrays([pa.array(signed(a)), pa.array(signed(b))], names=["a", "b"])

    kept: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in ("cell", "tb", "pb", "probe", "fp")]
        if kept is not None:
            cols = [np.concatenate((x, y)) for x, y in zip(kept, cols, strict=True)]
        cell, tb, pb, probe, fp = cols
        new = np.concatenate(([False], (cell[1:] != cell[:-1]) | (tb[1:] != tb[:-1]) | (pb[1:] != pb[:-1])))
        group, last = np.cumsum(new), int(np.nonzero(new)[0][-1]) if new.any() else 0
        # The last group may go on in the next batch; a long one is judged as it comes, keeping its table entries only.
        whole = len(fp) if len(fp) - last > 20_000 else last
        yield from links(group[:whole], probe[:whole], fp[:whole].view(U64))
        rest = np.arange(last, len(fp))
        if whole > last:
            rest = rest[~probe[last:]]
        kept = [x[rest] for x in cols]
    if kept is not None and len(kept[0]):
        yield from links(np.zeros(len(kept[0]), np.int64), kept[3], kept[4].view(U64))


def linked(fps: DataFrame, bits: int = 4, parts: int = 3) -> DataFrame:
    """Distinct fingerprints ``(fp)`` to links ``(a, b)`` whose components are those of all pairs within ``bits``.

    A cell's entries and asks are dealt in blocks of about CELL fingerprints; a block yields a spanning forest, so
    neither a pair list nor a whole cell ever stands in one task.
    """
    plan = segments(parts, bits)
    balls = [(k, s, w, sum(1 << i for i in c)) for k, (s, w, r) in enumerate(plan) for n in range(r + 1) for c in combinations(range(w), n)]
    fp = F.col("fp")
    table = fps.select("fp", F.explode(F.array(*[_cell(fp, k, s, w) for k, (s, w, _) in enumerate(plan)])).alias("cell"))
    sizes = cut(table.groupBy("cell").agg(F.count("*").alias("n")))
    asks = fps.select("fp", F.explode(F.array(*[F.struct(_cell(fp, k, s, w, x).alias("cell"), F.lit(x != 0).alias("far")) for k, s, w, x in balls])).alias("e")).select("fp", "e.cell", "e.far")
    blocks = F.ceil(F.col("n") / CELL).cast("int")
    mine, other = F.pmod(F.xxhash64("fp"), blocks).cast("int"), F.explode(F.sequence(F.lit(0), blocks - 1))
    asks = asks.join(sizes, "cell").where("far OR n > 1").select("cell", "fp", other.alias("tb"), mine.alias("pb"), F.lit(True).alias("probe"))
    entries = table.join(sizes, "cell").select("cell", "fp", mine.alias("tb"), other.alias("pb"), F.lit(False).alias("probe"))
    rows = entries.unionByName(asks).repartition("cell", "tb", "pb").sortWithinPartitions("cell", "tb", "pb", "probe")
    return rows.select("cell", "tb", "pb", "probe", "fp").mapInArrow(lambda b: _verify(b, bits), "a long, b long")


def _classes(fps: DataFrame, bits: int, parts: int) -> DataFrame:
    """``(doc_id, fp)`` to ``(fp, component_id)``, one row for each fingerprint."""
    distinct = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("low")))
    found = connected_components(linked(distinct.select("fp"), bits, parts)).withColumnsRenamed({"node": "fp", "component": "root"})
    return cut(named_by_smallest(distinct.join(found, "fp", "left"), "fp"))


def named_by_smallest(rooted: DataFrame, node: str) -> DataFrame:
    """``(node, low, root)``, root null where nothing is linked, to ``(node, component_id)``: the least ``low`` of each root.

    Members of a class are dealt to DEALT tasks, each of which gets a copy of the class's one row, so a large class is no hot key.
    """
    alone = rooted.where("root IS NULL").select(node, F.col("low").alias("component_id"))
    members = rooted.where("root IS NOT NULL")
    smallest = members.groupBy("root").agg(F.min("low").alias("component_id")).withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))))
    dealt = members.withColumn("deal", F.pmod(F.xxhash64(node), F.lit(DEALT)).cast("int"))
    return alone.unionByName(dealt.join(smallest, ["root", "deal"]).select(node, "component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, bits: int = 4, parts: int = 3) -> DataFrame:
    """One row for each row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable).

    Null and wordless texts have fingerprint zero and are linked like any other. A null doc_id keeps its row, and
    counts for a component's id only by not being the smallest. Rows that repeat a doc_id each get a row. An empty table
    gives none; other columns of ``docs`` are not read.
    """
    fps = cut(fingerprints(docs, id_col, text_col, size))
    return fps.join(_classes(fps, bits, parts), "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, bits: int = 4, parts: int = 3, most: int = 32 << 20) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose id is the smallest of their class.

    Of a class without any id all rows stay; rows that repeat the id and text of one that stays are that document and
    stay. The others' keys are broadcast if they take ``most`` bytes at most, else joined by a shuffle.
    """
    ident, text = F.col(named(id_col)), F.col(named(text_col))
    keyed = docs.select(F.xxhash64(ident, text).alias("row"), ident.cast("long").alias("doc_id"), text.alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            fp = np.array([fingerprint(x, size) for x in texts(b.column("text"))], U64)
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), pa.array(signed(fp))], names=["row", "doc_id", "fp"])

    fps = cut(keyed.mapInArrow(run, "row long, doc_id long, fp long"))
    gone = fps.join(_classes(fps.select("doc_id", "fp"), bits, parts), "fp").where("NOT doc_id <=> component_id")
    return without(docs, gone, id_col, text_col, most)


def without(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = 32 << 20) -> DataFrame:
    """``docs`` without the rows whose id and text have a hash in ``gone (row)``; the hashes are broadcast if they take ``most`` bytes at most."""
    (ROW,) = fresh(docs, "__row")
    gone = cut(gone.select(F.col("row").alias(ROW)).distinct())
    gone = F.broadcast(gone) if gone.count() * 16 <= most else gone
    return docs.join(gone, F.xxhash64(F.col(named(id_col)), F.col(named(text_col))) == F.col(ROW), "left_anti")
