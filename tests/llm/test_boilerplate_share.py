"""Boilerplate goes from pages of which it is the greater part; repeated texts stay."""

from __future__ import annotations

import pytest

pytest.importorskip("public_tokenizers")


def test_short_pages_lose_boilerplate_too(spark):
    import corpus_pipeline as p

    menu = "menu home about contact imprint all rights reserved"
    rows = [(i, f"{menu}\nown words {i}", "en", f"s{i}") for i in range(12)]
    rows += [(100 + i, menu, "en", f"s{i}") for i in range(2)]
    rows += [(200, f"{menu}\n", "en", "s1"), (201, "nothing shared", "en", "s2"), (202, None, "en", "s3"), (None, f"{menu}\nwithout id", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.text for r in p.line_dedup_stage(spark, df, "").collect()}
    assert all(got[i] == f"own words {i}" for i in range(12))
    assert got[100] == got[101] == menu
    assert got[200] == "" and got[201] == "nothing shared" and got[202] is None and got[None] == "without id"
    assert len(got) == len(rows)
