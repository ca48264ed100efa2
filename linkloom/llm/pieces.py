"""SentencePiece encoding and decoding by a max-plus parallel scan.

A piece sequence is what the merges yield for a text exactly if every two neighbours are what the merges yield for
those two alone. So an encoding is a path through states (place, last piece) whose steps weigh 0 if the two pieces stand
beside each other and minus infinity if not, and its text's best path, in the max-plus algebra, is the only finite one.

A giant text is split into chunks at fixed places. Each chunk yields, on its own, the matrix from the pieces that may
cross its left edge to those that may cross its right edge. Matrices combine associatively, so they are multiplied up a
tree in which a task sees FAN neighbours at a time; the pieces across all edges are then found down the same tree, and
from them each chunk is traced back on its own. No piece holds a space mark behind another character, so between two
words the state does not matter, and words are traced once for all their occurrences. Only one path leads from a start to
any place, so a word's path is looked for in depth, longest pieces first, and a place that leads nowhere is given up.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm._stash import stash
from linkloom.llm._text import Recent, texts
from linkloom.llm._text import pieces as batches_of

#: Characters of a chunk of a giant text.
CHUNK = 32_768
#: Neighbouring matrices that one task multiplies.
FAN = 64
#: Words of a generation remembered by a worker; all others are traced again.
WORDS = 250_000
#: Pairs of pieces of which a worker remembers whether they may stand beside each other.
PAIRS = 200_000
#: Pieces whose merges a worker remembers.
PIECES = 50_000
_MARK = "▁"
_NEVER = float("-inf")
_SIGNS = ".,;:!?%$#&*|"
_SEGMENT = re.compile(f"{_MARK}+[^{_MARK}\n]*|\n+|[^{_MARK}\n]+")
State = tuple[int, str]  # where the piece across an edge ends, counted from the edge, and the piece


class Scan:
    """The lattice of one model file of SentencePiece's BPE kind with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes = [0] * 256
        self.table: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
                self.table.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.table.append(b" \xe2\x81\x87 " if model.is_unknown(i) else b"")
            else:
                self.scores[piece], self.ids[piece] = model.get_score(i), i
                self.table.append(piece.replace(_MARK, " ").encode())
        self.longest = max(map(len, self.scores), default=1)
        if any(_MARK in p.lstrip(_MARK) or "\n" in p for p in self.scores):
            raise ValueError("the model has pieces across words")
        self.sound = {p for p in self.scores if len(p) == 1 or self.merged(p) == [p]}
        # Beginnings of pieces, each with those of its own beginnings that may stand by themselves in a path, longest first.
        self.heads: dict[str, tuple[str, ...]] = {}
        for head in sorted({p[:n] for p in self.scores for n in range(1, len(p) + 1)}, key=len):
            shorter = self.heads.get(head[:-1], ())
            self.heads[head] = (head, *shorter) if len(head) == 1 or head in self.sound else shorter
        self.codes = {p: np.array(i, "<i4").tobytes() for p, i in self.ids.items()}
        self.fits = lru_cache(PAIRS)(self.beside)
        # The merges inside a piece: score of the next, first and last part before it.
        self.steps = lru_cache(PIECES)(lambda p: tuple((score, parts[0], parts[-1]) for score, parts in self.merges(p)))
        self.recent = Recent(WORDS, lambda words: list(self.learn(words)))
        self.pairs = {p[i : i + 2] for p in self.scores for i in range(len(p) - 1)}

    def merges(self, text: str) -> Iterator[tuple[float, list[str]]]:
        """What stands there before each merge and behind the last, and the next merge's score. The pair of the best score first, of equal ones the leftmost."""
        score, parts = self.scores.get, list(text)
        pairs = [score(a + b, _NEVER) for a, b in pairwise(parts)]
        while pairs and (best := max(pairs)) > _NEVER:
            yield best, parts
            at = pairs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = score(parts[at - 1] + parts[at], _NEVER)
            if at < len(pairs):
                pairs[at] = score(parts[at] + parts[at + 1], _NEVER)
        yield _NEVER, parts

    def merged(self, text: str) -> list[str]:
        """What the merges yield."""
        parts: list[str] = []
        for _, parts in self.merges(text):  # noqa: B007
            pass
        return parts

    def beside(self, a: str, b: str) -> bool:
        """Whether the merges of ``a + b`` yield [a, b], each of which they yield for itself: no merge may cross before both are whole."""
        score, left, right = self.scores.get, iter(self.steps(a)), iter(self.steps(b))
        (x, _, last), (y, first, _) = next(left), next(right)
        while True:
            across = score(last + first, _NEVER)
            if across > x and across >= y:
                return False
            if x < y:
                y, first, _ = next(right)
            elif x > _NEVER:
                x, _, last = next(left)
            else:
                return True

    def forward(self, text: str, start: int, last: str, end: int) -> dict[int, tuple[str, int]]:
        """For each place up to ``end``, the piece that ends there on the one path from ``last`` at ``start``, and its start."""
        at: dict[int, tuple[str, int]] = {start: (last, -1)}
        heads, fits = self.heads.get, self.fits
        for i in range(start, end):
            if i not in at:
                continue
            before = at[i][0]
            for j in range(i + 1, end + 1):
                piece = text[i:j]
                whole = heads(piece) or (j == i + 1 and (piece,))
                if not whole:
                    break
                if len(whole[0]) == j - i and j not in at and (not before or fits(before, piece)):
                    at[j] = (piece, i)
        return at

    def back(self, at: dict[int, tuple[str, int]], end: int, start: int) -> list[str]:
        out = []
        while end > start:
            piece, end = at[end]
            out.append(piece)
        return out[::-1]

    def coded(self, parts: list[str]) -> bytes:
        codes = self.codes
        return b"".join([codes.get(p) or np.array([self.bytes[b] for b in p.encode()], "<i4").tobytes() for p in parts])

    def path(self, s: str) -> list[str]:
        """The one path over a whole segment, longest pieces first. A place is left for good: only one path leads there from the start."""
        heads, fits, end = self.heads.get, self.fits, len(s)
        out: list[str] = []
        untried: list[Iterator[str]] = []  # pieces that may still follow each place of ``out``
        dead = set()
        at, before = 0, ""
        while at < end:
            found = heads(s[at]) or (s[at],)
            j = at + 2
            while j <= end and (longer := heads(s[at:j])):
                found = longer
                j += 1
            rest = iter(found)
            while True:
                for piece in rest:
                    if (not before or fits(before, piece)) and at + len(piece) not in dead:
                        break
                else:
                    dead.add(at)
                    rest = untried.pop()
                    at -= len(out.pop())
                    before = out[-1] if out else ""
                    continue
                break
            out.append(piece)
            untried.append(rest)
            at += len(piece)
            before = piece
        return out

    def segment(self, s: str) -> bytes:
        """Ids of what stands between two free places."""
        return self.coded(self.path(s))

    def learn(self, segments: list[str]) -> Iterator[bytes]:
        """Ids of segments not seen lately. No piece crosses from a letter to most signs: what stands before them may be known."""
        known, old = self.recent.young, self.recent.old
        for s in segments:
            core = s.rstrip(_SIGNS)
            if core and len(core) < len(s) and s[len(core) - 1 : len(core) + 1] not in self.pairs:
                found = known.get(core) or old.get(core)
                if found is None:
                    found = known[core] = self.segment(core)
                yield found + self.segment(s[len(core) :])
            else:
                yield self.segment(s)

    def encode(self, normal: str) -> bytes:
        """Ids of a whole marked text, in one piece."""
        return b"".join(self.recent.values(_SEGMENT.findall(normal)))

    def crossing(self, text: str, edge: int) -> list[State]:
        """Pieces that may start before ``edge`` and end there or behind it."""
        out = []
        for i in range(max(0, edge - self.longest), edge):
            for j in range(edge, min(len(text), i + self.longest) + 1):
                if text[i:j] in self.sound or j - i == 1:
                    out.append((j - edge, text[i:j]))
        return out

    @staticmethod
    def free(text: str, at: int) -> bool:
        """Whether no piece can cross ``at``."""
        return 0 < at < len(text) and ((text[at] == _MARK) != (text[at - 1] == _MARK) and text[at] == _MARK or (text[at] == "\n") or (text[at - 1] == "\n"))

    def _inner(self, text: str, left: int, right: int) -> tuple[int, int] | None:
        """First and last free place in [left, right]."""
        a = next((i for i in range(left, right + 1) if self.free(text, i)), None)
        return None if a is None else (a, next(i for i in range(right, left - 1, -1) if self.free(text, i)))

    def matrix(self, text: str, left: int, right: int, first: bool, final: bool) -> dict[State, list[State]]:
        """Edge pieces from which a path leads to which edge pieces. ``text`` goes on beyond both edges by a piece's length."""
        starts: list[State] = [(0, "")] if first else self.crossing(text, left)
        goals: list[State] = [(0, "")] if final else self.crossing(text, right)
        free = self._inner(text, left, right)
        out: dict[State, list[State]] = {}
        tails = None
        for e, piece in starts:
            head = free[0] if free else right
            at = self.forward(text, left + e, piece, max(head, left + e) if free else min(len(text), right + self.longest))
            if free:
                if left + e > free[0] or free[0] not in at:
                    continue
                if tails is None:
                    tails = self._reach(text, self.forward(text, free[1], "", min(len(text), right + self.longest)), right, goals, final)
                out[(e, piece)] = tails
            elif reach := self._reach(text, at, right, goals, final):
                out[(e, piece)] = reach
        return out

    @staticmethod
    def _reach(text: str, at: dict[int, tuple[str, int]], right: int, goals: list[State], final: bool) -> list[State]:
        if final:
            return [(0, "")] if right in at else []
        return [(e, p) for e, p in goals if right + e in at and (at[right + e][0] == p or at[right + e][1] == -1)]

    def trace(self, text: str, left: int, right: int, enter: State, leave: State, final: bool) -> bytes:
        """Ids of the pieces that start in [left, right), given the pieces across both edges."""
        start, end = left + enter[0], right if final else right + leave[0]
        if start >= right and not final or start > right:
            return b""
        free = self._inner(text, start, right)
        if not free:
            return self.coded(self.back(self.forward(text, start, enter[1], end), end, start))
        head = self.coded(self.back(self.forward(text, start, enter[1], free[0]), free[0], start))
        tail = self.coded(self.back(self.forward(text, free[1], "", end), end, free[1])) if end > free[1] else b""
        return head + self.encode(text[free[0] : free[1]]) + tail

    def decode(self, ids: np.ndarray) -> str:
        data = b"".join(map(self.table.__getitem__, ids.tolist()))
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


def combine(a: dict[State, list[State]], b: dict[State, list[State]]) -> dict[State, list[State]]:
    """The max-plus product of two matrices of 0 and minus infinity; associative."""
    out = {}
    for s, mid in a.items():
        if reach := sorted({u for m in mid for u in b.get(m, ())}):
            out[s] = reach
    return out


_scans: dict[str, Scan] = {}


def scan(path: str) -> Scan:
    if path not in _scans:
        _scans[path] = Scan(path)
    return _scans[path]


def normal(text: str) -> str:
    return _MARK + text.replace(" ", _MARK) if text else ""


def _chunks(text: str, size: int, margin: int) -> Iterator[tuple[int, str, int, int, bool, bool]]:
    """(number, text with margins, left edge, right edge, first, final)."""
    for k, at in enumerate(range(0, len(text), size)):
        a, b = max(0, at - margin), min(len(text), at + size + margin)
        yield k, text[a:b], at - a, min(at + size, len(text)) - a, at == 0, at + size >= len(text)


_MATRIX = "array<struct<e:int,p:string,to:array<struct<e:int,p:string>>>>"


_PAIR = "struct<e:int,p:string>"


def _table(matrix: list[dict]) -> dict[State, list[State]]:
    return {(m["e"], m["p"]): [(t["e"], t["p"]) for t in m["to"]] for m in matrix}


def _plain(m: dict[State, list[State]]) -> list[dict]:
    return [{"e": e, "p": p, "to": [{"e": x, "p": y} for x, y in to]} for (e, p), to in m.items()]


def _states(rows: list[dict], enter: State = (0, ""), leave: State = (0, "")) -> list[tuple[State, State]]:
    """The pieces across both edges of each of some neighbours, given those across the outer edges."""
    tables = [_table(r["matrix"]) for r in rows]
    # Suffix products say which edge pieces lead to ``leave``; the first state then picks the one path.
    ends: list[dict[State, list[State]]] = [{s: [leave] for s, to in tables[-1].items() if leave in to}]
    for t in reversed(tables[:-1]):
        ends.append(combine(t, ends[-1]))
    ends.reverse()
    now, out = enter, []
    for k, t in enumerate(tables):
        after = leave if k == len(tables) - 1 else next(u for u in t[now] if u in ends[k + 1])
        out.append((now, after))
        now = after
    return out


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """``(doc_id, ids)``: ids as little-endian 32-bit numbers, for each row.

    Null and empty texts have no ids; a null id keeps its row; repeated rows get a row each; an empty table gives none;
    other columns are not read. Texts over ``chunk`` characters go through the scan over chunks, ``fan`` at a time; a
    text and its ids must fit in a row.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    giant = F.length("text") >= chunk

    def small(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = scan(model)
        for b in batches_of(batches):
            ids = [s.encode(normal(x.decode())) for x in texts(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margin = scan(model).longest
        for b in batches_of(batches, most=1):
            for row, doc_id, x in zip(b.column("row").to_pylist(), b.column("doc_id").to_pylist(), texts(b.column("text")), strict=True):
                for k, part, left, right, first, final in _chunks(normal(x.decode()), chunk, margin):
                    yield pa.RecordBatch.from_pylist([{"row": row, "doc_id": doc_id, "k": k, "part": part, "left": left, "right": right, "first": first, "final": final}], schema=pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("k", pa.int32()), ("part", pa.string()), ("left", pa.int32()), ("right", pa.int32()), ("first", pa.bool_()), ("final", pa.bool_())]))

    one = pa.struct([("e", pa.int32()), ("p", pa.string())])
    many = pa.list_(pa.struct([("e", pa.int32()), ("p", pa.string()), ("to", pa.list_(one))]))

    def matrices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = scan(model)
        for b in batches:
            out = []
            for r in b.to_pylist():
                m = s.matrix(r["part"], r["left"], r["right"], r["first"], r["final"])
                out.append(_plain(m))
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("k"), pa.array(out, many)], names=["row", "k", "matrix"])

    def product(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for chunks in b.column("chunks").to_pylist():
                total = _table(chunks[0]["matrix"])
                for c in chunks[1:]:
                    total = combine(total, _table(c["matrix"]))
                out.append(_plain(total))
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("k"), pa.array(out, many)], names=["row", "k", "matrix"])

    def edges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                outer = [(0, ""), (0, "")] if "enter" not in r else [(r[x]["e"], r[x]["p"]) for x in ("enter", "leave")]
                for c, (x, y) in zip(r["chunks"], _states(r["chunks"], *outer), strict=True):
                    out.append({"row": r["row"], "k": c["k"], "enter": {"e": x[0], "p": x[1]}, "leave": {"e": y[0], "p": y[1]}})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("row", pa.int64()), ("k", pa.int32()), ("enter", one), ("leave", one)]))

    def neighbours(table: DataFrame) -> DataFrame:
        """FAN matrices in order, under the number of their product."""
        return table.groupBy("row", F.floor(F.col("k") / fan).cast("int").alias("k")).agg(F.array_sort(F.collect_list(F.struct("k", "matrix"))).alias("chunks"))

    def traced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = scan(model)
        for b in batches:
            ids = [s.trace(r["part"], r["left"], r["right"], (r["enter"]["e"], r["enter"]["p"]), (r["leave"]["e"], r["leave"]["p"]), r["final"]) for r in b.to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), b.column("k"), pa.array(ids, pa.binary())], names=["row", "doc_id", "k", "ids"])

    short = docs.where(~F.coalesce(giant, F.lit(False))).mapInArrow(small, "doc_id long, ids binary")
    large = docs.where(giant).withColumn("row", F.monotonically_increasing_id())
    parts = stash(large.select("row", "doc_id", "text").mapInArrow(split, "row long, doc_id long, k int, part string, left int, right int, first boolean, final boolean"))
    levels = [parts.repartition("row", "k").mapInArrow(matrices, f"row long, k int, matrix {_MATRIX}")]
    most = (parts.agg(F.max("k")).first()[0] or 0) + 1
    while most > fan:
        levels[-1] = stash(levels[-1])
        levels.append(neighbours(levels[-1]).mapInArrow(product, f"row long, k int, matrix {_MATRIX}"))
        most = -(-most // fan)
    states = None
    for level in reversed(levels):
        found = neighbours(level)
        found = found if states is None else found.join(states, ["row", "k"])
        states = found.mapInArrow(edges, f"row long, k int, enter {_PAIR}, leave {_PAIR}")
    done = parts.join(states, ["row", "k"]).select("row", "doc_id", "k", "part", "left", "right", "final", "enter", "leave").mapInArrow(traced, "row long, doc_id long, k int, ids binary")
    joined = F.unhex(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "ids"))), lambda x: F.hex(x["ids"])), ""))
    return short.unionByName(done.groupBy("row", "doc_id").agg(joined.alias("ids")).select("doc_id", "ids"))


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``(doc_id, ids)`` to ``(doc_id, ids, text)``; bytes that are no UTF-8 become replacement characters."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = scan(model)
        for b in batches_of(batches, "ids"):
            text = [s.decode(np.frombuffer(x, "<i4")) for x in texts(b.column("ids"))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("ids"), pa.array(text, pa.string())], names=["doc_id", "ids", "text"])

    return encoded.mapInArrow(run, "doc_id long, ids binary, text string")


def digest(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_ids, ids_crc32, decoded_chars and decoded_sha256 (of the text decoded from the ids) for each row."""
    crc = F.crc32("ids")
    return decode(encode(docs, model), model).select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_ids"), crc.alias("ids_crc32"), F.length("text").cast("long").alias("decoded_chars"), F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))
