"""Exact removal of passages that repeat across documents, by recompression.

A text is a string of word hashes. Each round names maximal runs of one symbol, then splits the symbols into left and
right ones by a bit of their name and names every left-right pair. A name is a hash of what it stands for, so equal
strings get equal names on all executors without an exchange. Along with each symbol goes the stretch of words
that its name and its borders depend on: wherever that stretch occurs again, the same symbol arises.

A window of ``size`` words holds the symbols whose stretches lie inside it; the one with the least hash is its anchor.
Equal windows so have equal anchors, wherever they stand. Windows in a row with one anchor make a span. Spark groups
spans by anchor: whose anchor no smaller document has needs nothing more; a span that a smaller document has in full is
done; for the few others (at the ends of repeats) every window is compared. Windows without any symbol (in long runs of
one word) are their own anchors.

Names only bring candidates together. What is removed is decided by a 128-bit BLAKE2 digest of the words themselves, of
the whole span or of the window, which owes nothing to the names: names that collide cost time, never a word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm._stash import fresh, mapped, named, stash
from linkloom.llm._text import U64, mix, pieces, signed, spans, texts, word_hashes

#: Rounds of recompression: with four, a window of 50 words holds about nine symbols of its own.
ROUNDS = 4
#: A longer document is worked on in parts that overlap by a window.
PART = 200_000
_Q = U64(0xD6E8FEB86659FD93)
_QI = U64(pow(int(_Q), -1, 1 << 64))
_A, _B, _C = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9)
_LAST = (1 << 63) - 1


class _Prefix:
    """Hashes of any stretch of a string of word hashes."""

    powers = np.ones(1, U64)
    inverse = np.ones(1, U64)

    def __init__(self, words: np.ndarray):
        n = len(words) + 1
        if len(_Prefix.powers) < n:
            size = max(n, 1 << 19)
            one = np.ones(size, U64)
            one[1:] = _Q
            _Prefix.powers = np.cumprod(one)
            one[1:] = _QI
            _Prefix.inverse = np.cumprod(one)
        self.sums = np.zeros(n, U64)
        np.cumsum(words * self.powers[: n - 1], out=self.sums[1:])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.sums[b] - self.sums[a]) * self.inverse[a] + (b - a).astype(U64) * _C)


def recompress(words: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of the texts after ``rounds``: name, first and last+1 word that it depends on; and each text's start.

    Positions count words with one blank place before, between and after the texts.
    """
    start = 1 + np.cumsum(counts + 1) - (counts + 1)
    n = int(counts.sum()) + len(counts) + 1
    sep = np.zeros(n, bool)
    sep[np.concatenate(([0], start + counts))] = True
    sym = np.zeros(n, U64)
    sym[~sep] = words
    lo, hi = np.arange(n), np.arange(1, n + 1)
    for r in range(rounds):
        salt = mix(np.array([r + 1], U64))[0]
        same = (sym[1:] == sym[:-1]) & ~sep[1:] & ~sep[:-1]
        first = np.nonzero(np.concatenate(([True], ~same)))[0]
        last = np.append(first[1:] - 1, n - 1)
        k, apart = last - first + 1, sep[first]
        lo = np.where(apart, lo[first], lo[np.maximum(first - 1, 0)])
        hi = np.where(apart, hi[last], hi[np.minimum(last + 1, n - 1)])
        sym = np.where(k > 1, mix(sym[first] * _A + k.astype(U64) + salt), sym[first])
        sep, n = apart, len(first)

        right = (mix(sym ^ salt) >> U64(63)).astype(bool)
        left = ~right & ~sep
        right &= ~sep
        pair = np.append(left[:-1] & right[1:], False)
        at = np.nonzero(~np.concatenate(([False], pair[:-1])))[0]
        two, after = pair[at], np.minimum(at + 1, n - 1)
        lo = np.where(right[at], lo[np.maximum(at - 1, 0)], lo[at])
        hi = np.where(left[at], hi[after], hi[at])
        sym = np.where(two, mix(sym[at] * _A + mix(sym[after] + salt)), sym[at])
        sep, n = sep[at], len(at)
    return sym[~sep], lo[~sep], hi[~sep], start


def digests(text: bytes, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of the digests of stretches of words, ``first`` to ``last`` - 1, joined by one space.

    Stretches are in order and no longer than the part of the text that they lie in.
    """
    out = bytearray()
    starts, ends, base, at, data = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 0, b""
    queue = iter(spans(text))
    while at < len(first):
        # Words of one more part of the text, behind those that are still needed.
        part = next(queue).split()
        if not part:
            continue
        drop = max(int(first[at]) - base, 0)
        drop = min(drop, len(starts))
        cut = int(starts[drop]) if drop < len(starts) else len(data)
        data, starts, ends, base = data[cut:], starts[drop:] - cut, ends[drop:] - cut, base + drop
        joined = b" ".join(part)
        size = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
        shift = len(data) + bool(len(data))
        data = data + b" " + joined if data else joined
        starts, ends = np.concatenate((starts, shift + np.concatenate(([0], size[:-1]))[: len(part)])), np.concatenate((ends, shift + size - 1))
        upto = at + int(np.searchsorted(last[at:], base + len(starts), "right"))
        for a, b in zip(starts[first[at:upto] - base].tolist(), ends[last[at:upto] - 1 - base].tolist(), strict=True):
            out += hashlib.blake2b(data[a:b], digest_size=16).digest()
        at = upto
    halves = np.frombuffer(bytes(out), np.int64).reshape(-1, 2)
    return halves[:, 0], halves[:, 1]


def span_rows(words: np.ndarray, counts: np.ndarray, size: int = 50) -> tuple[np.ndarray, ...]:
    """Spans of all texts: text number, first and last window (word positions), hash of the anchor's stretch."""
    sym, lo, hi, start = recompress(words, counts)
    total = int(counts.sum()) + len(counts) + 1
    full = np.zeros(total, U64)
    keep = np.ones(total, bool)
    keep[np.concatenate(([0], start + counts))] = False
    full[keep] = words
    prefix = _Prefix(full)
    n = np.maximum(counts - size + 1, 0)
    row = np.repeat(np.arange(len(counts)), n)
    p = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + start[row]
    if not len(p):
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(U64)
    if len(sym):
        # Of symbols in order, both bounds grow: those inside a window are neighbours.
        before = np.concatenate(([0], np.cumsum(np.bincount(lo, minlength=total + 1))))
        a = before[p]
        upto = np.cumsum(np.bincount(hi, minlength=total + 2))
        b = upto[p + size] - 1
        some = a <= b
        rank = mix(sym + _C)
        best = [np.arange(len(sym))]
        depth = int(np.max(b - a + 1, initial=1)).bit_length()
        for k in range(1, depth):
            x = best[-1]
            x, y = x[: len(x) - (1 << (k - 1))], x[1 << (k - 1) :]
            best.append(np.where(rank[x] <= rank[y], x, y))
        anchor = -p - 1
        length = b - a + 1
        level = np.zeros(max(int(length.max(initial=1)), 1) + 1, np.int64)
        level[1:] = np.log2(np.arange(1, len(level))).astype(np.int64)
        for k in range(depth):
            mine = np.nonzero(some & (level[np.maximum(length, 0)] == k))[0]
            if len(mine):
                x, y = best[k][a[mine]], best[k][b[mine] - (1 << k) + 1]
                anchor[mine] = np.where(rank[x] <= rank[y], x, y)
    else:
        anchor = -p - 1
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])))
    first = np.nonzero(new)[0]
    last = np.append(first[1:], len(p)) - 1
    which = anchor[first]
    own = which < 0
    x = np.where(own, p[first], lo[np.maximum(which, 0)] if len(sym) else 0)
    y = np.where(own, p[first] + size, hi[np.maximum(which, 0)] if len(sym) else 0)
    key = prefix.of(x, y)
    key = np.where(own, mix(key + _A), key)
    return row[first], p[first] - start[row[first]], p[last] - start[row[first]], key


def _parts(docs: list[bytes], size: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts in parts: hashes, words of each part, its text and its first word there."""
    words, counts, row, base = [], [], [], []
    for i, x in enumerate(docs):
        h = word_hashes(x) >> U64(64 - bits)
        for at in range(0, max(len(h) - size + 1, 1), PART):
            part = h[at : at + PART + size - 1]
            words.append(part)
            counts.append(len(part))
            row.append(i)
            base.append(at)
    return np.concatenate(words), np.array(counts, np.int64), np.array(row), np.array(base)


def _batch(**cols: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in cols.values()], names=list(cols))


_ROWS = "key long, span long, span_ long, rank long, rid long, first int, last int"


def _spans(docs: DataFrame, size: int, bits: int) -> DataFrame:
    """``key``: the anchor's name; ``span``, ``span_``: the digest of the span's words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            docs = texts(b.column("text"))
            words, counts, row, base = _parts(docs, size, bits)
            part, first, last, key = span_rows(words, counts, size)
            if len(part):
                at = row[part]
                first, last = first + base[part], last + base[part]
                cuts = np.searchsorted(at, np.arange(len(docs) + 1))
                both = [digests(x, first[i:j], last[i:j] + size) for x, i, j in zip(docs, cuts[:-1], cuts[1:], strict=True) if i < j]
                rank, rid = (b.column(k).to_numpy(zero_copy_only=False) for k in ("rank", "rid"))
                span, span_ = (np.concatenate([d[k] for d in both]) for k in (0, 1))
                yield _batch(key=signed(key), span=span, span_=span_, rank=rank[at], rid=rid[at], first=first.astype(np.int32), last=last.astype(np.int32))

    return docs.mapInArrow(run, _ROWS)


def _windows(docs: DataFrame, size: int) -> DataFrame:
    """Each window of the listed spans, with the digest of its words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            rank, rid = (b.column(k).to_pylist() for k in ("rank", "rid"))
            for i, (x, wanted) in enumerate(zip(texts(b.column("text")), b.column("spans").to_pylist(), strict=True)):
                wanted = sorted(wanted, key=lambda s: s["first"])
                first, n = np.array([s["first"] for s in wanted]), np.array([s["last"] - s["first"] + 1 for s in wanted])
                p = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
                key = np.repeat(np.array([s["key"] for s in wanted], np.int64), n)
                span, span_ = digests(x, p, p + size)
                yield _batch(key=key, span=span, span_=span_, rank=np.full(len(p), rank[i]), rid=np.full(len(p), rid[i]), first=p.astype(np.int32), last=p.astype(np.int32))

    return docs.mapInArrow(run, _ROWS)


def merged(first: list[int], last: list[int], size: int) -> list[tuple[int, int]]:
    """Word ranges covered by the windows, in order, without overlap."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(first, last, strict=True)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b + size))
        else:
            out.append((a, b + size))
    return out


def cut_words(text: bytes, gone: list[tuple[int, int]]) -> tuple[int, int, Iterator[bytes]]:
    """Number of words, of those removed, and the kept words."""
    kept, n, removed = [], 0, 0
    ranges, at = iter(gone), None
    at = next(ranges, None)
    for part in spans(text):
        words = part.split()
        start = 0
        while at and at[0] < n + len(words):
            a, b = max(at[0] - n, start), min(at[1] - n, len(words))
            kept += words[start:a]
            removed += b - a
            start = b
            if at[1] > n + len(words):
                break
            at = next(ranges, None)
        kept += words[start:]
        n += len(words)
    return n, removed, iter(kept)


def repeats(docs: DataFrame, size: int = 50, bits: int = 64) -> DataFrame:
    """``(rid, gone)`` for rows that lose words: ranges (first word, last + 1) in order. Needs rank, rid and text."""
    rows = stash(_spans(docs, size, bits))
    ends = [f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("rank", "span", "span_")]
    keys = rows.groupBy("key").agg(*ends).where("min_rank < max_rank")
    keys = stash(keys.selectExpr("key", "min_rank AS least", "min_span <> max_span OR min_span_ <> max_span_ AS mixed"))
    shared = stash(rows.join(keys, "key").where("mixed OR least < rank"))
    done = shared.where("NOT mixed").select("rid", "first", "last")
    mixed = shared.where("mixed")
    same = ["key", "span", "span_"]
    least = stash(mixed.groupBy(*same).agg(F.min("rank").alias("here")))
    mixed = stash(mixed.join(least, same))
    done = done.unionByName(mixed.where("here < rank").select("rid", "first", "last"))
    # What is left holds each different span once for each place in its smallest document.
    wanted = stash(mixed.where("here = rank").groupBy("rid").agg(F.collect_list(F.struct("first", "last", "key")).alias("spans")))
    size_of = wanted.select(F.sum(F.size("spans") * 24 + 32)).first()[0] or 0
    chosen = docs.join(F.broadcast(wanted) if size_of <= 48 << 20 else wanted, "rid")
    windows = stash(_windows(chosen.select("rank", "rid", "text", "spans"), size))
    least = stash(windows.groupBy(*same).agg(F.min("rank").alias("here"), F.max("rank").alias("most")).where("here < most").drop("most"))
    done = done.unionByName(windows.join(least, same).where("here < rank").select("rid", "first", "last"))
    return done.groupBy("rid").agg(F.collect_list("first").alias("first"), F.collect_list("last").alias("last"))


def remove_repeats(docs: DataFrame, size: int = 50, id_col: str = "doc_id", text_col: str = "text", output: str = "digest", bits: int = 64) -> DataFrame:
    """Removes every word covered by a window of ``size`` words that also starts in a document with a smaller id.

    ``output`` "digest": doc_id, n_words, n_removed, kept_sha256 for each row; "text": the rows of ``docs`` with their
    columns, the text of those that lose words being the kept words joined by one space. Null texts have no words; a null
    id counts as larger than all; rows of one id never cut each other, and repeated rows fare alike; an empty table
    gives no rows; further columns pass through untouched, whatever their names. A very long text is named and digested
    in parts; its words' hashes are held together. ``bits`` of a word's hash that go into names: fewer make more of them
    collide, which changes the work and not the result.
    """
    RID, FIRST, LAST = fresh(docs, "__rid", "__first", "__last")
    key, text = F.col(named(id_col)), F.col(named(text_col))
    row = F.xxhash64(key, text)
    base = docs.select(F.coalesce(key.cast("long"), F.lit(_LAST)).alias("rank"), row.alias("rid"), text.alias("text"))
    # Rows alike in id and text are one here; each finds its ranges again below.
    gone = stash(repeats(base, size, bits))
    small = (gone.select(F.sum(F.size("first") * 8 + 32)).first()[0] or 0) <= 48 << 20
    gone = gone.select(F.col("rid").alias(RID), F.col("first").alias(FIRST), F.col("last").alias(LAST))
    joined = docs.join(F.broadcast(gone) if small else gone, row == F.col(RID), "left")
    ranges = lambda b, i: merged(b.column(FIRST)[i].as_py(), b.column(LAST)[i].as_py(), size) if b.column(FIRST)[i].is_valid else []

    if output == "digest":

        def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in pieces(batches):
                out = []
                for i, x in enumerate(texts(b.column("text"))):
                    n, removed, kept = cut_words(x, ranges(b, i))
                    out.append((n, removed, hashlib.sha256(b" ".join(kept)).hexdigest()))
                n, removed, sha = zip(*out, strict=True)
                yield _batch(doc_id=b.column("doc_id"), n_words=pa.array(n, pa.int64()), n_removed=pa.array(removed, pa.int64()), kept_sha256=pa.array(sha, pa.string()))

        cols = [key.cast("long").alias("doc_id"), text.alias("text"), FIRST, LAST]
        return joined.select(*cols).mapInArrow(digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")

    def rewrite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, text_col):
            column = b.column(text_col)
            if b.column(FIRST).null_count < b.num_rows:
                new = [None if x is None else x.decode() for x in column.cast(pa.binary()).to_pylist()]
                for i, x in enumerate(new):
                    if x is not None and b.column(FIRST)[i].is_valid:
                        new[i] = b" ".join(cut_words(x.encode(), ranges(b, i))[2]).decode()
                column = pa.array(new, pa.string())
            names = [k for k in b.schema.names if k not in (RID, FIRST, LAST)]
            yield pa.RecordBatch.from_arrays([column if k == text_col else b.column(k) for k in names], names=names)

    return mapped(joined, rewrite, docs.columns)
