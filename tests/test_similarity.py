"""Similar pairs multiplied inside the tasks against those of exchanged grams."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from linkloom.operators import blocking, similarity
from linkloom.plans import records as plans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def few(spark):
    """Names and addresses of few words, some empty, so that scores tie, with records without a state and cities that vote."""
    pick, words = random.Random(3), "abel bert cara dora emil fritz gabor hanna ida jörg kaï li".split()
    some = lambda: " ".join(pick.choices(words, k=pick.randint(0, 4)))
    rows = [(1000 + 7 * i % 997, i % 3, pick.choice(["", "a", "a", "b"]), pick.choice(["x", "x", "y"]), some(), f"{pick.randrange(30)} {some()}") for i in range(400)]
    return spark.createDataFrame(rows, "id long, side int, state_key string, city_key string, name_core string, addr_norm string")


@pytest.mark.parametrize(("asks", "pool", "products", "places"), [(1 << 17, 1 << 19, 1 << 18, 1 << 22), (50, 40, 300, 200)])
@pytest.mark.parametrize("field", ["name", "addr", "both", "skel"])
def test_same_pairs_as_by_grams(spark, few, monkeypatch, field, asks, pool, products, places):
    for k, v in (("ASKS", asks), ("POOL", pool), ("PRODUCTS", products), ("PLACES", places)):
        monkeypatch.setattr(similarity, k, v)
    how = blocking.Blocking(city_votes=3, city_share=0.3)
    want = blocking.similar_pairs(blocking.weights(few, ("name", "addr") if field == "both" else (field,), how), field, how)
    got = blocking.block_pairs(few, field, how=how)
    side = lambda df: sorted((r["pass"], r.qi, r.pi, r["rank"], r.score) for r in df.collect())
    a, b = side(got), side(want)
    assert len(a) == len(b) > 500
    # The order of sums can move a score by one in the last place, and so the order of near ties.
    assert sum(x[:4] != y[:4] for x, y in zip(a, b, strict=True)) <= len(a) // 200
    assert all(abs(x - y) <= 1.1e-6 for x, y in zip(sorted(r[4] for r in a), sorted(r[4] for r in b), strict=True))


@pytest.mark.parametrize("name", ["trigram_tfidf_topk_fwd", "trigram_tfidf_topk_rev", "trigram_tfidf_address"])
def test_matches_of_grams_are_not_exchanged(spark, name):
    plan = plans.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(blk" in plan and "gram#" not in plan.split("FlatMapGroupsInArrow")[0] and "Join" not in plan.split("FlatMapGroupsInArrow")[0]


def test_no_records_give_no_pairs(spark, few):
    assert blocking.block_pairs(few.where("false"), "name").count() == 0
    assert blocking.block_pairs(few.where("side = 0"), "both").count() == 0
    blank = few.withColumn("name_core", F.lit(""))
    assert blocking.block_pairs(blank, "name").count() == 0


@pytest.mark.parametrize("name", ["trigram_tfidf_topk_rev", "trigram_tfidf_address"])
def test_reverse_and_address_make_their_matches_inside_tasks(spark, monkeypatch, name):
    """Neither query joins weights by gram."""
    monkeypatch.setattr(blocking, "weights", lambda *a, **k: pytest.fail("grams are exchanged"))
    assert plans.QUERIES[name](spark, SF).count() > 1000
