"""Byte-level helpers shared by the corpus operators.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D: exactly what ``bytes.split()`` yields.
UTF-8 never uses those bytes inside a character, so splitting bytes equals splitting text.
"""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Hashable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text worked on at once; bounds the temporary word objects of a task.
STEP = 2 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
U64 = np.uint64
_M1, _M2 = U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (murmur3's)."""
    x = x ^ (x >> U64(33))
    x = x * _M1
    x = x ^ (x >> U64(33))
    x = x * _M2
    return x ^ (x >> U64(33))


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def trim() -> None:
    """Gives freed memory back to the system: a worker goes from task to task and stage to stage, and what it holds unused adds to an executor's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def pieces(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = STEP) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``most`` bytes of text, or one row if that is longer; memory is trimmed before the first and behind the last."""
    trim()
    for batch in batches:
        if not batch.num_rows:
            continue
        length = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        bounds, first, total = [], 0, 0
        for i, n in enumerate(length.tolist()):
            if i > first and total + n > most:
                bounds.append((first, i))
                first, total = i, 0
            total += n
        bounds.append((first, batch.num_rows))
        for a, b in bounds:
            yield batch.slice(a, b - a)
    trim()


def spans(text: bytes, most: int = STEP) -> Iterator[bytes]:
    """``text`` in parts of about ``most`` bytes, cut at white space only."""
    start = 0
    while len(text) - start > most:
        found = _SPACE.search(text, start + most)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


def hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word, the same on every machine."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of one text, whatever its length."""
    if len(text) <= STEP:
        return hashes(text.split())
    return np.concatenate([hashes(x.split()) for x in spans(text)])


def batch_words(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts one after another, and the number of words of each."""
    parts = [word_hashes(x) for x in docs]
    counts = np.fromiter(map(len, parts), np.int64, len(parts))
    return (np.concatenate(parts) if parts else np.zeros(0, U64)), counts


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


class Recent:
    """Values of the words seen lately: two generations of about ``most`` each, which bounds the memory and nothing else.

    ``learn`` gives the values of a list of words.
    """

    def __init__(self, most: int, learn: Callable[[list], Iterable]):
        self.most, self.learn = most, learn
        self.young: dict[Hashable, bytes] = {}
        self.old: dict[Hashable, bytes] = {}

    def values(self, words: list) -> Iterator[bytes]:
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}
        young, old, missing = self.young, self.old, []
        for w in set(words).difference(young):
            found = old.get(w)
            if found is None:
                missing.append(w)
            else:
                young[w] = found
        if missing:
            young.update(zip(missing, self.learn(missing), strict=True))
        return map(young.__getitem__, words)
