"""All labelled rows count for the models of the quality rules."""

from __future__ import annotations

import zlib

from linkloom.llm import quality


def test_threshold_is_set_on_all_labelled_rows(spark, monkeypatch):
    ids = range(13_000)
    docs = spark.createDataFrame([(i, " ".join(f"{'w' if i % 2 else 'v'}{(i * 7 + j) % 400}" for j in range(50))) for i in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in ids], "doc_id long, quality int, toxic int")
    seen = []
    cut = quality.cut_between
    monkeypatch.setattr(quality, "cut_between", lambda good, bad, *a, **k: seen.append((good, bad, k)) or cut(good, bad, *a, **k))
    at = quality.fit(docs, labels)[1]
    (good, bad, k), = seen
    n = [int(sum(k.get(name, [1] * len(x)))) for name, x in (("n_good", good), ("n_bad", bad))]
    assert n == [sum(zlib.crc32(str(i).encode()) % 3 == 2 for i in ids if i % 2 == q) for q in (1, 0)] and min(n) > 2000
    assert bad.max() < at < good.min()


def test_bytes_of_ids_do_not_matter(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(f"{'w' if i % 2 else 'v'}{(i + j) % 90}" for j in range(50))) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    held = quality.fit(docs, labels)
    monkeypatch.setattr(quality, "BROADCAST", 0)
    joined = quality.fit(docs, labels)
    assert (held[0] == joined[0]).all() and held[1] == joined[1]
