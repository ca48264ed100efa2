"""All candidates at once: matches of grams are added up in tasks, pairs meet once, by their entity."""

from __future__ import annotations

import random

import pytest

from linkloom.operators import blocking
from linkloom.plans import records as plans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def few(spark):
    pick, words = random.Random(5), "abel bert cara dora emil fritz gabor hanna ida jörg kaï li".split()
    some = lambda: " ".join(pick.choices(words, k=pick.randint(0, 4)))
    rows = [(1000 + 7 * i % 997, i % 3, pick.choice(["", "a", "a", "b"]), pick.choice(["x", "x", "y"]), (n := some()), n, n.replace(" ", ""), f"{pick.randrange(30)} {some()}", [str(pick.randrange(30))]) for i in range(250)]
    return spark.createDataFrame(rows, "id long, side int, state_key string, city_key string, name_core string, name_norm string, name_compact string, addr_norm string, house_nums array<string>")


def test_same_candidates_as_by_grams(few):
    how = blocking.Blocking(city_votes=3, city_share=0.3, cap=None)
    side = lambda own: {(r.s1, r.cand): r.asDict() for r in blocking.generate(few, how, own_ids=own).collect()}
    a, b = side(True), side(False)
    assert len(a) > 3000 and len(a.keys() ^ b.keys()) <= len(a) // 200
    names = [f"p_key_{k}" for k in blocking.KEY_PASSES] + ["p_key_hit"]
    assert all(a[k][c] == b[k][c] for k in a.keys() & b.keys() for c in names)
    # The order of sums can move a score by one in the last place, and so the order of near ties.
    exact = [c for c in next(iter(a.values())) if "score" not in c and c != "prio"]
    assert sum(any(a[k][c] != b[k][c] for c in exact) for k in a.keys() & b.keys()) <= len(a) // 50
    assert all(abs((a[k][c] or 0) - (b[k][c] or 0)) <= 1.1e-6 for k in a.keys() & b.keys() for c in ("p_name_score", "p_addr_score") if (a[k][c] is None) == (b[k][c] is None))


def test_repeated_pairs_count_once(spark):
    keyed = spark.createDataFrame([("tok", 1, 2), ("tok", 1, 2), ("hn", 1, 2), ("tok", 1, 3)], "pass string, qi long, pi long")
    scored = spark.createDataFrame([("addr_rev", 1, 2, 0.5, 3), ("addr_fwd", 1, 2, 0.25, 7), ("both_fwd", 1, 4, 0.75, 1)], "pass string, qi long, pi long, score double, rank int")
    got = {r.pi: r for r in blocking.union(keyed, scored).collect()}
    assert sorted(got) == [2, 3, 4] and [got[k].n_passes for k in (2, 3, 4)] == [4, 1, 1] and [got[k].p_key_hit for k in (2, 3, 4)] == [2, 1, 0]
    assert got[2].p_key_tok and got[2].p_key_hn and not got[2].p_key_name and (got[2].p_addr_score, got[2].p_addr_rank, got[2].p_addr_rrank) == (0.5, 7, 3)
    assert (got[4].p_both_score, got[4].p_both_rank, got[4].p_both_rrank) == (0.75, 1, None) and got[3].p_addr_score is None
    assert [got[k].prio for k in (2, 3, 4)] == [1.28, 0.37, 0.97]


def test_pairs_are_exchanged_once(spark):
    keyed = spark.createDataFrame([("tok", 1, 2)], "pass string, qi long, pi long")
    u = blocking.candidates.capped(blocking.union(keyed, None, fields=()).withColumnsRenamed({"qi": "s1", "pi": "cand"}), 5)
    assert u._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_the_query_makes_its_matches_inside_tasks(spark, monkeypatch):
    monkeypatch.setattr(blocking, "weights", lambda *a, **k: pytest.fail("grams are exchanged"))
    assert plans.QUERIES["generate_candidates"](spark, SF).count() > 100_000
