"""Packing of token sequences: vector bin packing by the dot-product heuristic.

Demands have three parts: tokens, segments (1 each) and loss-bearing tokens. The open sequence takes, of a window of
waiting examples, the one whose demand has the largest dot product with what is left of the sequence, all three as
shares of the limits; if none fits whole, the best one is cut. Each Spark task packs the rows it reads and nothing is
exchanged: the sequences left open at a task's end are cut to powers of two, so they need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm._text import Recent, pieces, spans, texts

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"
_SEP = 49407
_SIGNS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


@dataclass(frozen=True)
class Limits:
    """What a sequence may hold. ``window``: examples that wait at most; it bounds memory, not results' completeness."""

    tokens: int = 4096
    segments: int = 1024
    loss: int = 4096
    window: int = 256


@dataclass
class _Example:
    doc_id: int | None
    ids: bytes
    loss_from: int  # tokens from here on bear loss
    start: int = 0

    @property
    def total(self) -> int:
        return len(self.ids) // 4

    def loss(self, a: int, b: int) -> int:
        return max(0, b - max(a, self.loss_from))


class Packer:
    """Packs examples that come one by one; each placement is (example, start, length, sequence, offset)."""

    def __init__(self, limits: Limits, sequence: int = 0):
        self.limits, self.sequence = limits, sequence
        self.waiting: list[_Example] = []
        self.size = np.zeros((limits.window, 3))  # demands of those that wait
        self.most = np.array([limits.tokens, limits.segments, limits.loss], np.float64)
        self._open()

    def _open(self) -> None:
        self.left = [self.limits.tokens, self.limits.segments, self.limits.loss]
        self.held: list[tuple[_Example, int, int, int]] = []

    def add(self, x: _Example) -> Iterator[tuple]:
        self.size[len(self.waiting)] = x.total - x.start, 1, x.loss(x.start, x.total)
        self.waiting.append(x)
        while len(self.waiting) == self.limits.window:
            yield from self._fill()

    def _longest(self, x: _Example) -> int:
        """Tokens of ``x`` that the open sequence can take."""
        n = min(x.total - x.start, self.left[0])
        if x.loss(x.start, x.start + n) > self.left[2]:
            n = max(x.loss_from - x.start, 0) + self.left[2]
        return n if self.left[1] else 0

    def _fill(self) -> Iterator[tuple]:
        """Fills and closes the open sequence, as far as examples last."""
        while self.waiting:
            size, left = self.size[: len(self.waiting)], np.array(self.left, np.float64)
            score = np.where((size <= left).all(1), size @ (left / self.most**2), -1.0)
            at = int(np.argmax(score))
            if score[at] < 0:
                can = [self._longest(x) for x in self.waiting]
                at = int(np.argmax(can))
                n = can[at]
            else:
                n = self.waiting[at].total - self.waiting[at].start
            if n:
                x = self.waiting[at]
                self.held.append((x, x.start, n, self.limits.tokens - self.left[0]))
                self.left[0] -= n
                self.left[1] -= 1
                self.left[2] -= x.loss(x.start, x.start + n)
                x.start += n
                if x.start == x.total:
                    last = self.waiting.pop()
                    if at < len(self.waiting):
                        self.waiting[at], self.size[at] = last, self.size[len(self.waiting)]
                else:
                    self.size[at] = x.total - x.start, 1, x.loss(x.start, x.total)
            if not n or not self.left[0] or not self.left[1]:
                yield from self._close()
                return

    def _close(self) -> Iterator[tuple]:
        """Ends the open sequence. A full one stands as it is; any other is cut to powers of two."""
        total = self.limits.tokens - self.left[0]
        held = self.held
        self._open()
        if total == self.limits.tokens:
            for x, start, n, offset in held:
                yield x, start, n, self.sequence, offset
            self.sequence += 1
            return
        sizes = [1 << i for i in range(total.bit_length() - 1, -1, -1) if total >> i & 1]
        used = 0
        for x, start, n, _ in held:
            while n:
                take = min(n, sizes[0] - used)
                yield x, start, take, self.sequence, used
                start, n, used = start + take, n - take, used + take
                if used == sizes[0]:
                    sizes.pop(0)
                    used = 0
                    self.sequence += 1

    def finish(self) -> Iterator[tuple]:
        while self.waiting:
            yield from self._fill()
        yield from self._close()


class WordTokenizer:
    """Ids of a tokenizer that drops white space and never joins what it separates, a distinct word at a time.

    Words seen lately are remembered; the tokenizer must lower-case, so A-Z are lowered before. A text that could hold a special token goes through the tokenizer as a whole.
    """

    def __init__(self, path: str, most: int = 650_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.recent = Tokenizer.from_file(path), Recent(most, self.learn)

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def fresh(self, words: list[bytes]) -> Iterator[bytes]:
        for i in range(0, len(words), 4096):
            part = words[i : i + 4096]
            ids = self.ids("<|endoftext|>".join(w.decode() for w in part))
            cuts = np.nonzero(ids == _SEP)[0].tolist()
            if len(cuts) != len(part) - 1:
                raise ValueError("the tokenizer joined words")
            data = ids.tobytes()
            yield from (data[4 * a : 4 * b] for a, b in zip([0, *(c + 1 for c in cuts)], [*cuts, len(ids)], strict=True))

    def learn(self, words: list[bytes]) -> Iterator[bytes]:
        """Ids of words not seen lately. Signs behind a letter or figure are tokens of their own, so what stands before them may be known."""
        young, old = self.recent.young, self.recent.old
        split = [w.rstrip(_SIGNS) if b"'" not in w else w for w in words]
        split = [c if c and c[-1:].isalnum() else w for c, w in zip(split, words, strict=True)]
        known = {}
        for w, c in zip(words, split, strict=True):
            for part in (c, w[len(c) :]):
                if part and part not in known:
                    known[part] = young.get(part) or old.get(part)
        missing = [w for w, x in known.items() if x is None]
        known.update(zip(missing, self.fresh(missing), strict=True))
        known[b""] = b""
        # The parts are remembered as words are: the caller adds the whole words.
        young.update((c, known[c]) for c in split)
        return (known[c] + known[w[len(c) :]] for w, c in zip(words, split, strict=True))

    def encode(self, docs: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        return [self.ids(x.decode()).tobytes() if b"<|" in x else b"".join(b"".join(self.recent.values(p.lower().split())) for p in spans(x)) for x in docs]


_encoders: dict[tuple[str, int], WordTokenizer] = {}


def encoder(path: str, words: int = 650_000) -> WordTokenizer:
    if (path, words) not in _encoders:
        _encoders[path, words] = WordTokenizer(path, words)
    return _encoders[path, words]


def pack(df: DataFrame, encode: Callable[[list[bytes]], list[bytes]], limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None, end_id: int = 2) -> DataFrame:
    """One row for each piece: PIECE's columns.

    ``encode`` gives the ids of texts; ``end_id`` is set behind them. ``prompt_col``: text before ``text_col`` whose
    tokens bear no loss. Null and empty texts are the end id alone; longer examples than a sequence are cut; repeated
    rows are packed each; a null id is kept; an empty table gives no rows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        packer = Packer(limits, sequence=(context.partitionId() if context else 0) << 40)
        end = np.array([end_id], "<u4").tobytes()
        schema = pa.schema([(k, pa.int64()) for k in (x.split()[0] for x in PIECE.split(", "))])

        def rows(placed: Iterable[tuple]) -> Iterator[tuple]:
            for x, start, n, sequence, offset in placed:
                yield x.doc_id, start, n, zlib.crc32(x.ids[4 * start : 4 * (start + n)]), x.total, sequence, offset, x.loss(start, start + n)

        def out(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], schema=schema)

        found: list[tuple] = []
        for b in pieces(batches, "text"):
            ids = encode(texts(b.column("text")))
            before = encode(texts(b.column("prompt"))) if prompt_col else [b""] * len(ids)
            for doc_id, p, x in zip(b.column("doc_id").to_pylist(), before, ids, strict=True):
                found += rows(packer.add(_Example(doc_id, p + x + end, len(p) // 4)))
            if len(found) > 5000:
                yield out(found)
                found = []
        found += rows(packer.finish())
        if found:
            yield out(found)

    cols = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")] + ([F.col(prompt_col).alias("prompt")] if prompt_col else [])
    return df.select(*cols).mapInArrow(run, PIECE)


def pack_documents(docs: DataFrame, tokenizer: str, limits: Limits = Limits(), words: int = 650_000) -> DataFrame:
    """``pack`` with the words of ``tokenizer``, a file for the tokenizers library; a worker remembers about ``words`` of them twice over."""
    return pack(docs, lambda x: encoder(tokenizer, words).encode(x), limits)
