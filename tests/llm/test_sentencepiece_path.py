"""Words are traced by few questions, and the answers are those of the merges."""

from __future__ import annotations

import random

import numpy as np
import pytest

from linkloom.llm import pieces, queries


@pytest.fixture(scope="module")
def scan():
    return pieces.Scan(queries.piece_vocabulary())


def words() -> list[str]:
    r = random.Random(3)
    out = ["▁" + "".join(r.choice(["en", "tion", "ge", "keit", "th", "ou", "é", "ñ", "ß", "st", "er", "%", "日", "😀"]) for _ in range(r.randint(1, 8))) for _ in range(400)]
    return out + ["".join(r.choice("abeinrst") for _ in range(r.randint(1, 60))) for _ in range(400)] + ["a" * 300, "▁▁▁x", "\n\n\n"]


def plainly_merged(scan, text):
    parts = list(text)
    while True:
        found = [(-scan.scores[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in scan.scores]
        if not found:
            return parts
        at = min(found)[1]
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


def test_few_pairs_are_asked_for(scan):
    scan.fits.cache_clear()
    ids = sum(len(np.frombuffer(scan.segment(w), "<i4")) for w in words()[:400])
    info = scan.fits.cache_info()
    assert info.hits + info.misses < 1.5 * ids


def test_paths_are_what_the_merges_yield(scan):
    for w in words():
        want = plainly_merged(scan, w)
        assert scan.path(w) == scan.back(scan.forward(w, 0, "", len(w)), len(w), 0) == scan.merged(w) == want


def test_pairs_stand_beside_each_other_if_no_merge_crosses(scan):
    r = random.Random(4)
    sound = sorted(scan.sound)
    pairs = [(r.choice(sound), r.choice(sound)) for _ in range(2000)] + [(p[:k], p[k:]) for p in r.sample(sound, 500) for k in range(1, len(p)) if {p[:k], p[k:]} <= scan.sound]
    pairs += [("日", "😀"), ("a", "😀"), ("😀", "▁the")] + [x for w in words()[:100] for x in zip(scan.path(w), scan.path(w)[1:])]
    for a, b in pairs:
        assert scan.beside(a, b) == (plainly_merged(scan, a + b) == [a, b])
