"""Wide SimHash fingerprints: what brings near copies together, against all pairs."""

from __future__ import annotations

import inspect

import numpy as np

from linkloom.llm import minhash, widehash


def pair(rng: np.random.Generator, both: int, apart: int) -> tuple[np.ndarray, np.ndarray]:
    every = np.unique(rng.integers(0, 1 << 63, both + 2 * apart, dtype=np.uint64) * np.uint64(2))
    rng.shuffle(every)
    return np.sort(every[: both + apart]), np.sort(np.concatenate((every[:both], every[both + apart :])))


def test_bits_are_those_of_a_plain_count():
    s = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 300, dtype=np.uint64))
    for n in (1, 5, 63, 64, 300):
        bits = ((widehash.mix(s[:n, None] * widehash._FACTORS)[:, :, None] >> np.arange(63, -1, -1, dtype=np.uint64)) & np.uint64(1)).reshape(n, -1).sum(0)
        assert (np.unpackbits(widehash.wide_fingerprint(s[:n])) == (2 * bits > n)).all()


def test_similar_sets_meet():
    """Pairs at similarity 0.8 share a key of some table and differ little in the check bits; sets of nothing in common do not."""
    rng, met, strange = np.random.default_rng(2), 0, 0
    for i in range(400):
        a, b = (np.unpackbits(widehash.wide_fingerprint(x)) for x in pair(rng, 160, 20))
        met += bool((a[widehash._TAKEN] == b[widehash._TAKEN]).all(1).any()) and (a != b)[: widehash.CHECK].sum() <= widehash.APART
        c = np.unpackbits(widehash.wide_fingerprint(np.sort(rng.integers(0, 1 << 63, 180, dtype=np.uint64))))
        strange += (a != c)[: widehash.CHECK].sum() <= widehash.APART
    assert met == 400 and strange < 4


def test_links_connect_what_all_pairs_connect(spark):
    """A large group around one set, some of it under the similarity to the smallest node, among sets of other sizes."""
    rng, sets = np.random.default_rng(3), {}
    base = np.unique(rng.integers(0, 1 << 63, 200, dtype=np.uint64))
    for i in range(150):
        n = int(rng.integers(1, 25)) if i else 60
        sets[i - 40] = np.unique(np.concatenate((base[n:] if i % 2 else base[:-n], rng.integers(0, 1 << 63, n, dtype=np.uint64))))
        sets[1000 + i] = np.unique(rng.integers(0, 1 << 63, 20 + 3 * i, dtype=np.uint64))
    marks = spark.createDataFrame([(k, len(v), bytearray(minhash.bitmap(v)), bytearray(widehash.wide_fingerprint(v).tobytes())) for k, v in sets.items()], "node long, n int, bits binary, fp binary")
    whole = spark.createDataFrame([(k, bytearray(v.tobytes())) for k, v in sets.items()], "node long, s binary")
    found = {(min(r), max(r)) for r in map(tuple, widehash.links(marks, lambda of: whole.join(of, "node")).collect())}
    want = {(a, b) for a in sets for b in sets if a < b and minhash.similar(sets[a], sets[b], 0.8)}

    def classes(pairs):
        root = {k: k for k in sets}
        for _ in range(len(sets)):
            for a, b in pairs:
                root[a] = root[b] = min(root[a], root[b])
        return root

    assert found <= want and classes(found) == classes(want) and len(want) > 1000 > len(found)


def test_the_stage_takes_its_candidates_from_simhash():
    import corpus_pipeline as p

    assert "widehash.representatives" in inspect.getsource(p.simhash_near_dedup)
