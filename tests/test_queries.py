"""Every query outside the corpus operators against its SQL twin, on the smallest tables."""

from __future__ import annotations

import math
import os
from glob import glob

import pytest

duckdb = pytest.importorskip("duckdb")
from linkloom.plans import linkage, normalise, records, tables  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES = linkage.QUERIES | records.QUERIES | normalise.QUERIES | tables.QUERIES
ORACLES = linkage.ORACLES | records.ORACLES | normalise.ORACLES | tables.ORACLES


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for p in glob(f"{SF}/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p if os.path.isfile(p) else p + '/*.parquet'}')")
    return c


def plain(row):
    return tuple(None if x is None or isinstance(x, float) and math.isnan(x) else round(float(x), 5) if isinstance(x, float) else x for x in row)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, db, name):
    got = QUERIES[name](spark, SF)
    want = db.sql(ORACLES[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    a = sorted((plain(r[c] for c in cols) for r in got.collect()), key=repr)
    at = [want.columns.index(c) for c in cols]
    b = sorted((plain(r[i] for i in at) for r in want.fetchall()), key=repr)
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert x == y or all(p == q or isinstance(p, float) and abs(p - q) <= 2e-5 for p, q in zip(x, y, strict=True))


@pytest.mark.parametrize("name", ["ef_exact", "conflict_repair", "em_prior_shift", "fuzzy_scores", "isotonic_calibration", "gbt_oof", "name_normalise", "address_normalise", "native_dictionary", "pair_features"])
def test_rows_of_the_others(spark, name):
    out = QUERIES[name](spark, SF)
    assert out.count() > 0
    if name == "conflict_repair":
        assert out.where("sel").groupBy("cand").count().where("count > 1").count() == 0
    if name == "gbt_oof":
        assert out.select("s1", "fold").distinct().groupBy("s1").count().where("count > 1").count() == 0


def test_entry_points(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize(("kind", "mode"), [("unique", "append"), ("watch", "complete")])
def test_streams_see_each_event_once(spark, kind, mode):
    from linkloom.streaming import events

    q = getattr(events, kind)(events.source(spark, SF, "events.parquet")).writeStream.format("memory").queryName(f"seen_{kind}").outputMode(mode).trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    n = spark.sql(f"SELECT {'count(*)' if kind == 'unique' else 'sum(n)'} FROM seen_{kind}").first()[0]
    assert n == spark.read.parquet(f"{SF}/events.parquet").count()
