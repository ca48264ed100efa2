"""Quality rules: base counts, then a hashed n-gram log-likelihood ratio.

Words and word pairs are hashed to ``BUCKETS`` buckets. Two multinomials are counted: over every raw document, and over
trusted documents (all rows labelled good that are set aside for it). A document's verdict is the mean of log(p_trusted / p_raw)
over its n-grams against one threshold; no sampling, so equal texts always fare alike.

Labels are split by crc32 of the id modulo 3: rows that leave 0 make the trusted model, rows that leave 2 set the
threshold, rows that leave 1 are never learnt from, so that figures on them are honest.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm._stash import mapped
from linkloom.llm._text import U64, batch_words, mix, pieces, texts

#: Fixed size of both models: what the driver holds and broadcasts does not grow with the corpus.
BUCKETS = 1 << 16
#: How many bad rows a good one is worth where the threshold is set.
GOOD_WORTH = 4.0
#: Ratios are counted in steps of 1 / STEPS for the threshold, within LIMIT of 0; farther ones count at the limit. It bounds what the driver gets.
STEPS, LIMIT = 10_000, 10
#: Bytes of labelled ids that are broadcast, at most; more are joined by a shuffle.
BROADCAST = 32 << 20
_A, _B, _C = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9)
RESULT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, llr double, kept boolean"


def buckets(words: np.ndarray, counts: np.ndarray, size: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and of all pairs of neighbours, with the row of each."""
    row = np.repeat(np.arange(len(counts)), counts)
    inside = row[1:] == row[:-1]
    pair = mix(words[:-1] * _A + words[1:] * _B)[inside]
    half = U64(size // 2)
    return np.concatenate((mix(words) % half, pair % half + half)).astype(np.int64), np.concatenate((row, row[1:][inside]))


def repeated(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Words of each text that lie in 3-word windows found twice or more in it, the first included."""
    n = len(words)
    if n < 3:
        return np.zeros(len(counts), np.int64)
    row = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    key = mix(words[:-2] * _A + words[1:-1] * _B + words[2:] * _C + mix(row[:-2] + U64(1)))
    at = np.nonzero(row[:-2] == row[2:])[0]
    order = at[np.argsort(key[at])]
    same = key[order][1:] == key[order][:-1]
    hit = order[np.concatenate((same, [False])) | np.concatenate(([False], same))] if len(order) else order
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[hit + k] = True
    return np.bincount(row[covered].astype(np.int64), minlength=len(counts))


def _dup_lines(text: bytes) -> int:
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line and not line.isspace():
            if line in seen:
                n += 1
            else:
                seen.add(line)
    return n


_SYMBOLS = b"#*$%&|<>"
_SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
_TAILS = bytes(range(0x80, 0xC0))


def base(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Word hashes, words of each text, and the base counts."""
    words, counts = batch_words(docs)
    size = lambda drop: np.array([len(x.translate(None, drop)) for x in docs], np.int64)
    return words, counts, {
        "word_chars": size(_SPACES + _TAILS),
        "n_symbols": np.array([len(x) for x in docs], np.int64) - size(_SYMBOLS),
        "n_dup_lines": np.array([_dup_lines(x) for x in docs], np.int64),
        "n_repeat_words": repeated(words, counts),
    }


def _labelled(labels: DataFrame, remainder: int) -> DataFrame:
    """``(labelled, quality)``: ids of that remainder with their label (of several, the larger counts)."""
    one = labels.where(f"doc_id IS NOT NULL AND quality IS NOT NULL AND crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = {remainder}")
    return one.groupBy(F.col("doc_id").alias("labelled")).agg(F.max("quality").alias("quality"))


def _few(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() * 16 <= BROADCAST else ids


def weights(docs: DataFrame, labels: DataFrame, smooth: float = 20.0) -> np.ndarray:
    """log(p_trusted / p_raw) of each bucket. The raw counts are of all rows; add-``smooth`` tied to the raw model."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for b in pieces(batches):
            words, counts = batch_words(texts(b.column("text")))
            at, row = buckets(words, counts)
            raw += np.bincount(at, minlength=BUCKETS)
            flag = b.column("good").to_numpy(zero_copy_only=False).astype(bool)
            if flag.any():
                good += np.bincount(at[flag[row]], minlength=BUCKETS)
        some = np.nonzero(raw)[0]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(good[some])], names=["bucket", "raw", "good"])

    good = _few(_labelled(labels, 0).where("quality = 1").select("labelled"))
    flagged = docs.join(good, docs["doc_id"] == good["labelled"], "left").select("text", F.col("labelled").isNotNull().alias("good"))
    rows = flagged.mapInArrow(run, "bucket long, raw long, good long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).collect()
    raw, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in rows:  # BUCKETS rows at most
        raw[r.bucket], good[r.bucket] = r.raw, r.good
    if not good.sum():
        return np.zeros(BUCKETS)
    p = (raw + 1) / (raw.sum() + BUCKETS)
    q = (good + smooth * BUCKETS * p / 16) / (good.sum() + smooth * BUCKETS / 16)
    return np.log(q / p)


def _judge(docs: list[bytes], model: np.ndarray, threshold: float) -> dict[str, np.ndarray]:
    words, n, found = base(docs)
    at, row = buckets(words, n)
    total = np.maximum(np.bincount(row, minlength=len(n)), 1)
    llr = np.bincount(row, weights=model[at], minlength=len(n)).astype(np.float64) / total
    failed = (n < 50) | (100 * found["n_repeat_words"] > 50 * n)
    return {"n_words": n, **found, "base_failed": failed, "llr": llr, "kept": ~failed & (llr >= threshold)}


def cut_between(good: np.ndarray, bad: np.ndarray, worth: float = GOOD_WORTH, n_good: np.ndarray | None = None, n_bad: np.ndarray | None = None) -> float:
    """The threshold that rejects most of the bad ratios less ``worth`` times the good ones, in shares; of equals the lowest.

    ``n_good`` and ``n_bad``: rows of each ratio, one if not given. Thresholds lie halfway between neighbouring ratios. Without
    ratios of both kinds nothing is below it.
    """
    if not len(good) or not len(bad):
        return -np.inf
    at = np.unique(np.concatenate((good, bad)))
    cuts = np.concatenate(([-np.inf], (at[1:] + at[:-1]) / 2))

    def below(ratios: np.ndarray, n: np.ndarray | None) -> np.ndarray:
        """Share of the rows below each cut."""
        order = np.argsort(ratios)
        sums = np.concatenate(([0], np.cumsum(np.ones(len(ratios), np.int64) if n is None else n[order])))
        return sums[np.searchsorted(ratios[order], cuts)] / sums[-1]

    gain = below(bad, n_bad) - worth * below(good, n_good)
    return float(cuts[np.argmax(gain)])


def threshold(docs: DataFrame, labels: DataFrame, model: np.ndarray) -> float:
    """``cut_between`` of all labelled rows set aside for it that pass the base rules, with their ratios in steps of 1 / STEPS."""
    judged = _few(_labelled(labels, 2).where("quality IN (0, 1)"))
    rows = docs.join(judged, docs["doc_id"] == judged["labelled"]).select("text", F.col("quality").cast("int").alias("quality"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            found = _judge(texts(b.column("text")), shared.value, -np.inf)
            ok = found["kept"]
            step = np.rint(np.clip(found["llr"][ok], -LIMIT, LIMIT) * STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("quality").filter(pa.array(ok)), pa.array(step)], names=["quality", "step"])

    # Two rows for each of 2 * LIMIT * STEPS + 1 steps at most, whatever the number of labels.
    found = rows.mapInArrow(run, "quality int, step long").groupBy("quality", "step").agg(F.count("*").alias("n")).collect()
    ratios, n = ({q: np.array([x[k] for x in found if x["quality"] == q], kind) for q in (1, 0)} for k, kind in (("step", np.float64), ("n", np.int64)))
    return cut_between(ratios[1] / STEPS, ratios[0] / STEPS, n_good=n[1], n_bad=n[0])


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Weights of the buckets, and the threshold."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = weights(docs, labels)
    return model, threshold(docs, labels, model) if model.any() else -np.inf


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """RESULT's columns for each row of ``docs``.

    A null or empty text has no words and fails the base rules (under 50 words); a very long text is judged whole, in one
    go; a null doc_id keeps its row; repeated rows get a row each, and equal texts fare alike; a ratio equal to the
    threshold is kept. Without trusted rows every ratio is 0, and without labelled rows of both kinds nothing is below
    the threshold: the base rules alone decide. An empty table gives no rows. Columns besides doc_id and text are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            found = _judge(texts(b.column("text")), *model.value)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *map(pa.array, found.values())], names=["doc_id", *found])

    return docs.mapInArrow(run, RESULT)


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``score`` keeps, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            yield b.filter(pa.array(_judge(texts(b.column("text")), *model.value)["kept"]))

    return mapped(docs, run, docs.columns)
