"""Toxicity: a counterfactual-regularised logistic model on the beginnings of words.

Training reads a bounded sample of labelled rows. A mark is a word's beginning of LEAST to MOST bytes, or a whole word up
to MOST - 1 bytes, and how often it stands in the document (once, twice, three times or more). Marks are picked by
how far their document frequency differs between the classes, then weighted by logistic regression whose loss adds
the squared change of a sentence's score when its identity terms are swapped for others of their set. What tells group
mentions apart is so driven out of the weights.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm._text import U64, pieces, texts

#: Bytes of a word's beginning, and occurrences that are told apart.
LEAST, MOST, LEVELS = 3, 8, 3
#: Bounds of what is fitted: rows of either class, and marks of the model.
POSITIVE, NEGATIVE, MARKS = 4000, 8000, 4096
#: A mark must stand in so many sampled documents, its frequencies in the two classes must be so many standard errors
#: apart, and it must be so many times as frequent in toxic documents. Chosen by five-fold cross-validation on rows that
#: are not held out (sf0.01, sf0.1).
SUPPORT, LIFT, RATIO = 2, 1.5, 4.0
#: Groups named in neutral mentions; a swap takes the next term of the same set.
IDENTITY = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("women", "men"),
    ("woman", "man"),
    ("black", "white", "asian", "latino"),
    ("immigrants", "natives", "refugees"),
    ("disabled", "deaf", "blind"),
    ("frauen", "männer"),
    ("frau", "mann"),
    ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"),
    ("einwanderer", "flüchtlinge", "einheimische"),
    ("femmes", "hommes"),
    ("femme", "homme"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("immigrés", "réfugiés"),
    ("mujeres", "hombres"),
    ("mujer", "hombre"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("inmigrantes", "refugiados"),
)
_NEXT = {w.encode(): group[(i + 1) % len(group)].encode() for group in IDENTITY for i, w in enumerate(group)}
_WORD = re.compile(rb"(?<![^ ])(" + b"|".join(sorted(_NEXT, key=len, reverse=True)) + rb")(?![^ ])")
_SPACE = bytes(32 if b <= 32 or bytes([b]) in b".,;:!?\"'()-" else b for b in range(256))


def swapped(text: bytes) -> bytes:
    """A cleaned text with each identity term replaced by the next of its set."""
    return _WORD.sub(lambda m: _NEXT[m[1]], text)


def clean(text: bytes) -> bytes:
    """Lower-cased (A-Z), with a space for each white space, control character and common punctuation mark."""
    return text.lower().translate(_SPACE)


def marks(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different marks of each cleaned text: bytes as a number (padded by zeros; a space ends a whole word), text, occurrences."""
    gap = b" " + bytes(MOST)
    data = np.frombuffer(gap + gap.join(docs) + gap, np.uint8)
    sizes = np.array([len(x) for x in docs], np.int64) + len(gap)
    ends = np.cumsum(sizes) + len(gap) - 1
    blank = (data == 32) | (data == 0)
    at = np.nonzero(~blank[1:] & blank[:-1])[0] + 1
    row = np.searchsorted(ends, at, "right")
    code, codes, rows = np.zeros(len(at), U64), [], []
    for k in range(MOST):
        byte = data[at + k].astype(U64) << U64(56 - 8 * k)
        over = blank[at + k]
        codes.append(code[over] | U64(32 << (56 - 8 * k)))
        rows.append(row[over])
        at, row, code = at[~over], row[~over], (code | byte)[~over]
        if k + 1 >= LEAST:
            codes.append(code)
            rows.append(row)
    code, row = np.concatenate(codes), np.concatenate(rows)
    order = np.lexsort((code, row))
    code, row = code[order], row[order]
    first = np.nonzero(np.concatenate(([True], (code[1:] != code[:-1]) | (row[1:] != row[:-1]))))[0] if len(code) else np.zeros(0, np.int64)
    return code[first], row[first], np.diff(np.append(first, len(code)))


@dataclass
class Model:
    """``codes`` in order, and a weight for each of them at each level; a mark has those of all levels that it reaches."""

    codes: np.ndarray
    weights: np.ndarray
    bias: float

    def __post_init__(self) -> None:
        self.slots = np.zeros(1 << 20, bool)
        self.slots[self._slot(self.codes)] = True

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return ((codes * U64(0x9E3779B97F4A7C15)) >> U64(44)).astype(np.int64)

    def hits(self, docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(text, number of the code times LEVELS + level) of the model's marks in cleaned texts."""
        none = np.zeros(0, np.int64)
        if not docs or not len(self.codes):
            return none, none
        code, row, n = marks(docs)
        maybe = self.slots[self._slot(code)]
        code, row, n = code[maybe], row[maybe], n[maybe]
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        ok = self.codes[at] == code
        at, row, n = at[ok], row[ok], n[ok]
        out = [(row[n > k], at[n > k] * LEVELS + k) for k in range(LEVELS)]
        row, at = np.concatenate([r for r, _ in out]), np.concatenate([a for _, a in out])
        order = np.lexsort((at, row))
        return row[order], at[order]

    def score(self, docs: list[bytes]) -> np.ndarray:
        row, at = self.hits(docs)
        z = self.bias + np.bincount(row, weights=self.weights[at], minlength=len(docs)) if len(docs) else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def train(rows: list[np.ndarray], changed: list[np.ndarray | None], label: np.ndarray, size: int, ridge: float = 2e-4, swap: float = 10.0, steps: int = 300) -> tuple[np.ndarray, float]:
    """Logistic weights by accelerated gradient steps. ``changed``: a row's marks after the swap, None if it is the same.

    Loss: class-balanced log loss + ridge * |w|^2 + swap * mean over swapped rows of (w . (x - x'))^2.
    """
    n = len(rows)
    if not n or not size or not label.any() or label.all():
        return np.zeros(size), -4.0
    at = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    of = np.repeat(np.arange(n), [len(r) for r in rows])
    pairs = [(np.setdiff1d(a, b), np.setdiff1d(b, a)) for a, b in zip(rows, changed, strict=True) if b is not None]
    d_at = np.concatenate([np.concatenate(p) for p in pairs]) if pairs else np.zeros(0, np.int64)
    d_of = np.repeat(np.arange(len(pairs)), [len(a) + len(b) for a, b in pairs]) if pairs else np.zeros(0, np.int64)
    d_sign = np.concatenate([np.concatenate((np.ones(len(a)), -np.ones(len(b)))) for a, b in pairs]) if pairs else np.zeros(0)
    cost = np.where(label, 0.5 / label.sum(), 0.5 / (n - label.sum()))
    w, b, vw, vb = np.zeros(size), 0.0, np.zeros(size), 0.0
    gw2, gb2 = np.zeros(size), 0.0
    for step in range(1, steps + 1):
        z = b + np.bincount(of, weights=w[at], minlength=n)
        g = cost * (1 / (1 + np.exp(-np.clip(z, -60, 60))) - label)
        gw = np.bincount(at, weights=g[of], minlength=size) + 2 * ridge * w
        gb = g.sum()
        if len(pairs):
            d = np.bincount(d_of, weights=d_sign * w[d_at], minlength=len(pairs))
            gw += 2 * swap / len(pairs) * np.bincount(d_at, weights=d_sign * d[d_of], minlength=size)
        vw, vb = 0.9 * vw + 0.1 * gw, 0.9 * vb + 0.1 * gb
        gw2, gb2 = 0.99 * gw2 + 0.01 * gw * gw, 0.99 * gb2 + 0.01 * gb * gb
        rate = 0.1 * (1 - step / (steps + 1))
        c1, c2 = 1 - 0.9**step, 1 - 0.99**step
        w -= rate * (vw / c1) / (np.sqrt(gw2 / c2) + 1e-8)
        b -= rate * (vb / c1) / (np.sqrt(gb2 / c2) + 1e-8)
    return w, float(b)


def held_out(doc_id: int | None) -> bool:
    """Whether crc32 of the id as text leaves 1 modulo 3; a null id is never learnt from."""
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 3 == 1


def _sample(labels: DataFrame, positive: int, negative: int) -> DataFrame:
    usable = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL AND crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 <> 1")
    one = usable.groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").alias("toxic"))
    pick = lambda t, n: one.where(F.col("toxic") == t).orderBy(F.xxhash64("label_id"), "label_id").limit(n)
    return pick(1, positive).unionByName(pick(0, negative))


def fit(docs: DataFrame, labels: DataFrame, positive: int = POSITIVE, negative: int = NEGATIVE, most: int = MARKS, support: int = SUPPORT, least_lift: float = LIFT, swap: float = 10.0) -> Model:
    """The model from at most ``positive`` + ``negative`` labelled rows; the rest is never looked at."""
    sample = F.broadcast(_sample(labels, positive, negative))  # at most positive + negative rows
    learn = docs.join(sample, docs["doc_id"] == sample["label_id"]).select("text", F.col("toxic").cast("int").alias("toxic"))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, most=8 << 20):
            code, row, times = marks([clean(x) for x in texts(b.column("text"))])
            toxic = b.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)[row]
            for level in range(LEVELS):
                some = np.nonzero(times > level)[0]
                if len(some):
                    some = some[np.argsort(code[some], kind="stable")]
                    c = code[some]
                    start = np.nonzero(np.concatenate(([True], c[1:] != c[:-1])))[0]
                    pos, n = np.add.reduceat(toxic[some], start), np.diff(np.append(start, len(c)))
                    yield pa.RecordBatch.from_arrays([pa.array(c[start].view(np.int64)), pa.array(np.full(len(start), level, np.int32)), pa.array(pos), pa.array(n)], names=["code", "level", "pos", "n"])

    sizes = {r.toxic: r["count"] for r in learn.groupBy("toxic").count().collect()}
    n1, n0 = max(sizes.get(1, 0), 1), max(sizes.get(0, 0), 1)
    freq = learn.mapInArrow(count, "code long, level int, pos long, n long").groupBy("code", "level").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n")).where(F.col("n") >= support)
    p1, p0 = (F.col("pos") + 0.5) / (n1 + 1), (F.col("n") - F.col("pos") + 0.5) / (n0 + 1)
    lift = F.abs(p1 - p0) / F.sqrt(p1 * (1 - p1) / n1 + p0 * (1 - p0) / n0)
    picked = freq.where((lift >= least_lift) & (p1 >= RATIO * p0)).orderBy(F.desc(lift), "code", "level").limit(most).select("code", "level").collect()  # MARKS rows at most
    found = np.array([r.code for r in picked], np.int64).view(U64)
    codes = np.unique(found)
    used = np.unique(np.searchsorted(codes, found) * LEVELS + np.array([r.level for r in picked], np.int64)) if len(picked) else np.zeros(0, np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(Model(codes, np.zeros(len(codes) * LEVELS), 0.0))

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lists(cleaned: list[bytes]) -> list[np.ndarray]:
            row, at = shared.value.hits(cleaned)
            ok = np.isin(at, used)
            return np.split(at[ok], np.cumsum(np.bincount(row[ok], minlength=len(cleaned)))[:-1])

        for b in pieces(batches):
            cleaned = [clean(x) for x in texts(b.column("text"))]
            other = [swapped(x) for x in cleaned]
            kind = pa.list_(pa.int32())
            changed = [y.astype(np.int32) if s != c else None for y, s, c in zip(lists(other), other, cleaned, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array([x.astype(np.int32) for x in lists(cleaned)], kind), pa.array(changed, kind)], names=["toxic", "marks", "changed"])

    rows = learn.mapInArrow(find, "toxic int, marks array<int>, changed array<int>").collect()  # the sample
    rows.sort(key=lambda r: (r.toxic, r.marks, r.changed or []))
    weights, bias = train([np.array(r.marks, np.int64) for r in rows], [None if r.changed is None else np.array(r.changed, np.int64) for r in rows], np.array([r.toxic == 1 for r in rows]), len(codes) * LEVELS, swap=swap)
    return Model(codes, weights, bias)


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **bounds: int) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``.

    Null and empty texts get the score of a text without any mark; a very long text is scored whole, in one go. A null
    doc_id keeps its row, is held out and never learnt from. Equal texts score alike, repeated rows get a row each.
    Labels of a repeated doc_id count once, the larger one. Without labels of both classes all scores are low; an
    empty table gives no rows. Columns besides doc_id and text are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **bounds))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, most=1 << 20):
            p = model.value.score([clean(x) for x in texts(b.column("text"))])
            out = [held_out(i) for i in b.column("doc_id").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return docs.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
