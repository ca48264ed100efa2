"""Near copies: a large group of texts that are alike, but not enough, makes no more rows than its nodes have table keys."""

from __future__ import annotations

import numpy as np

from linkloom.llm import minhash, widehash


def rows_made(spark, run) -> int:
    """The most rows that an operator of a plan gives while ``run`` runs."""
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    before = {store.executionsList().apply(i).executionId() for i in range(store.executionsList().size())}
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    most, all_of = 0, store.executionsList()
    for i in range(all_of.size()):
        e = all_of.apply(i).executionId()
        if e in before:
            continue
        values, nodes = store.executionMetrics(e), store.planGraph(e).allNodes()
        for k in range(nodes.size()):
            metrics = nodes.apply(k).metrics()
            for m in (metrics.apply(x) for x in range(metrics.size())):
                if m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                    most = max(most, int(values.apply(m.accumulatorId()).split("\n")[-1].split(" ")[0].replace(",", "")))
    return most


def test_a_group_of_texts_alike(spark):
    rng, sets = np.random.default_rng(7), {}
    fresh = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64)
    base = fresh(200)
    for i in range(700):
        sets[i] = np.unique(np.concatenate((rng.permutation(base)[:170], fresh(30))))
    for i in range(0, 700, 20):
        sets[1000 + i] = np.unique(np.concatenate((rng.permutation(sets[i])[:185], fresh(5))))
    want = {(a, b) for a in sets for b in sets if a < b and minhash.similar(sets[a], sets[b], 0.8)}
    assert {(i, 1000 + i) for i in range(0, 700, 20)} <= want and len(want) < 100
    marks = spark.createDataFrame([(k, len(v), bytearray(minhash.bitmap(v)), bytearray(widehash.wide_fingerprint(v).tobytes())) for k, v in sets.items()], "node long, n int, bits binary, fp binary")
    whole = spark.createDataFrame([(k, bytearray(v.tobytes())) for k, v in sets.items()], "node long, s binary")
    found = []
    made = rows_made(spark, lambda: found.extend(widehash.links(marks, lambda of: whole.join(of, "node")).collect()))
    assert {(min(r), max(r)) for r in map(tuple, found)} == want
    assert 0 < made <= widehash.TABLES * len(sets)
