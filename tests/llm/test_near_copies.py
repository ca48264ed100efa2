"""Near copies by shingle-set similarity against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.llm import minhash, queries

pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"


def shingles(text: str, size: int = 5) -> set:
    w = text.lower().split()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def alike(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a or b else 1.0


def survivors(docs: dict[int, str], least: float = 0.8) -> set[int]:
    """The smallest id of each component of pairs that similar."""
    ids, sets = sorted(docs), {i: shingles(t) for i, t in docs.items()}
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sorted((find(i), find(j)))
            if a != b and min(len(sets[i]), len(sets[j])) >= least * max(len(sets[i]), len(sets[j])) and alike(sets[i], sets[j]) >= least:
                root[b] = a
    return {find(i) for i in ids}


def planted() -> dict[int, str]:
    """Texts of 40 to 600 words, each with copies of which one stretch is new; similarity from about 0.7 to 0.97."""
    r, docs = random.Random(8), {}
    for i in range(30):
        w = [f"w{r.randrange(3000)}" for _ in range(r.choice([40, 120, 300, 600]))]
        docs[i * 10] = " ".join(w)
        for j in range(1, 6):
            n = max(1, int(len(w) * r.uniform(0.01, 0.17)) - 4)
            at = r.randrange(len(w) - n)
            docs[i * 10 + j] = " ".join(w[:at] + [f"new{i}x{j}x{k}" for k in range(n)] + w[at + n :])
    return docs


@pytest.mark.parametrize("seed", [0, 1])
def test_planted_copies_go(spark, seed):
    import corpus_pipeline as p

    docs = planted()
    scores = [alike(shingles(docs[i * 10]), shingles(docs[i * 10 + j])) for i in range(30) for j in range(1, 6)]
    assert sum(0.8 <= s <= 0.85 for s in scores) > 10 and sum(s < 0.8 for s in scores) > 10
    rows = [(i, t, "en", "src0", len(t)) for i, t in docs.items()]
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {x.doc_id for x in p.simhash_near_dedup(spark, df, SF).collect()} == survivors(docs)


def test_documents_table(spark):
    import corpus_pipeline as p

    df = queries.table(spark, SF, "documents")
    docs = {r.doc_id: r.text or "" for r in df.collect()}
    left = [r.doc_id for r in p.simhash_near_dedup(spark, df, SF).collect()]
    assert len(left) == len(set(left)) and set(left) == survivors(docs)


def test_pairs_away_from_the_smallest_node_are_found(spark):
    """A cell whose smallest node is unlike the others: those are held against each other."""
    far, base = np.arange(1000, 1100, dtype=np.uint64), np.arange(100, dtype=np.uint64)
    sets = {1: far, 2: base, 3: base[:90], 4: np.arange(2000, 2100, dtype=np.uint64)}
    members = spark.createDataFrame([(7, 1, k, len(v)) for k, v in sets.items()], "cell long, lead long, node long, n int")
    marks = spark.createDataFrame([(k, len(v), bytearray(minhash.bitmap(v))) for k, v in sets.items()], "node long, n int, bits binary")
    found = minhash.links(members, spark.createDataFrame([(k, bytearray(v.tobytes())) for k, v in sets.items()], "node long, s binary"), marks, 0.8)
    assert [tuple(r) for r in found.select(F.least("a", "b"), F.greatest("a", "b")).collect()] == [(2, 3)]


def test_bitmaps_rule_out_no_similar_pair(spark):
    rng = np.random.default_rng(6)
    sets = {}
    for i in range(40):
        base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
        sets[2 * i] = np.unique(base)
        sets[2 * i + 1] = np.unique(np.concatenate((base[: 300 - 2 * i], rng.integers(0, 1 << 63, i, dtype=np.uint64))))
    marks = spark.createDataFrame([(k, len(v), bytearray(minhash.bitmap(v))) for k, v in sets.items()], "node long, n int, bits binary")
    pairs = spark.createDataFrame([(a, b) for a in sets for b in sets if a < b], "a long, b long")
    got = {(r.a, r.b) for r in minhash._possible(pairs, marks, 0.8).collect()}
    assert {(a, b) for a in sets for b in sets if a < b and minhash.similar(sets[a], sets[b], 0.8)} <= got and len(got) < 45
    assert minhash._possible(pairs.limit(0), marks, 0.8).count() == 0
