"""Record-linkage operators on hand-made rows and against brute force."""

from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.functions import fuzzy, numbers, text
from linkloom.operators import adaptation, candidates, decision, exclusivity, features, metrics
from linkloom.sources import idlists, records

E = "s1 string, cand string, p double"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_contested_candidate_has_one_owner(spark):
    e = spark.createDataFrame([("a", "x", 0.9), ("b", "x", 0.6), ("c", "y", 0.7)], E)
    out = {(r.s1, r.cand): r.sel for r in decision.resolve(e, lambda d: decision.threshold(d, 0.5)).collect()}
    assert out[("a", "x")] and not out[("b", "x")] and out[("c", "y")]


def test_repair_decides_again_for_losers(spark):
    e = spark.createDataFrame([("a", "x", 0.9), ("b", "x", 0.8), ("b", "y", 0.6)], E)
    d = decision.resolve(e, lambda d: decision.threshold(d, 0.95, 0.5), exclusive="none")
    assert rows(d.where("sel"), "s1", "cand") == [("a", "x"), ("b", "y")]


def test_soft_exclusivity_leaves_a_lone_claim(spark):
    e = spark.createDataFrame([("a", "x", 0.3), ("a", "y", 0.5), ("b", "y", 0.5)], E)
    p = {(r.s1, r.cand): r.p for r in exclusivity.soft(e).collect()}
    assert p[("a", "x")] == pytest.approx(0.3) and p[("a", "y")] == pytest.approx(1 / 3)


def brute_expected_f(p, background, m, beta=0.5):
    total = 0.0
    for bits in itertools.product((0, 1), repeat=len(p)):
        w = np.prod([x if b else 1 - x for x, b in zip(p, bits)])
        for q, pq in enumerate(background):
            truth, tp = sum(bits) + q, sum(bits[:m])
            f = (1.0 if truth == 0 else 0.0) if m == 0 else (1 + beta**2) * tp / (beta**2 * truth + m)
            total += w * pq * f
    return total


def test_exact_expectation_equals_enumeration():
    rng = np.random.default_rng(0)
    for n in (1, 3, 6):
        p = np.sort(rng.random(n))[::-1]
        bg = decision.poisson(np.array([0.4]), 5)[0]
        got = decision.expected_f(p[None, :], bg[None, :])[0]
        assert got == pytest.approx([brute_expected_f(p, bg, m) for m in range(n + 1)])
    assert decision.poisson(np.array([0.0, 2.0]), 4).sum(1) == pytest.approx([1, 1])


def test_exact_lists_prefer_the_shorter_on_ties(spark):
    e = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 0.0), ("b", "x", 0.0)], E)
    got = {r.s1: r.m_star for r in decision.exact_lists(e).collect()}
    assert got == {"a": 1, "b": 0}


def test_f_beta_edges(spark):
    u = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",)], "s1 string")
    t = spark.createDataFrame([("b", "1"), ("d", "1"), ("d", "2"), ("e", "1")], "s1 string, mid string")
    n = spark.createDataFrame([("c", "1"), ("d", "1"), ("d", "1"), ("d", "3"), ("e", "9"), ("zz", "9")], "s1 string, mid string")
    got = {r.s1: (r.k, r.m, r.tp, round(r.f, 6)) for r in metrics.per_entity(u, t, n).collect()}
    assert got == {"a": (0, 0, 0, 1.0), "b": (1, 0, 0, 0.0), "c": (0, 1, 0, 0.0), "d": (2, 2, 1, 0.5), "e": (1, 1, 0, 0.0)}


def test_rank_auc_with_ties(spark):
    s = [0.1, 0.1, 0.4, 0.4, 0.9, 1.0]
    y = [0, 1, 0, 1, 1, 0]
    want = np.mean([(a > b) + 0.5 * (a == b) for a, i in zip(s, y) if i for b, j in zip(s, y) if not j])
    assert metrics.rank_auc(spark.createDataFrame(list(zip(s, y)), "p double, label int"), "p", "label").first().auc == pytest.approx(want)


@pytest.mark.parametrize(
    ("a", "b", "want"),
    [("", "", "none"), ("1", "", "one_missing"), ("12", "12", "exact"), ("12a", "12b", "letter_change"), ("123", "12", "digit_dropped"), ("12", "123", "digit_added"), ("a", "b", "other"),
     ("12", "13", "subst_d1_2"), ("12", "18", "subst_d6_8"), ("12", "15", "subst_d3_9"), ("12", "52", "subst_d10_99"), ("123", "523", "subst_d100plus"), ("19", "21", "diff_1_2"), ("18", "27", "diff_3_10"), ("118", "187", "diff_11_100"), ("1234", "5671", "diff_100plus")],
)
def test_number_relations(spark, a, b, want):
    assert spark.range(1).select(numbers.number_relation(F.lit(a), F.lit(b)).alias("r")).first().r == want


def test_numbers_of_many_figures(spark):
    rows = [("1234567890", "1234567850", "subst_d10_99"), ("1234567890", "1234567050", "diff_100plus"), ("123456789012", "923456789812", "diff_100plus"), ("1234567890123456", "1234567890123457", "subst_d1_2"), ("12345678901234567", "12345678901234568", "diff_1_2"), (None, "7", "one_missing")]
    df = spark.createDataFrame([(a, b, c, a, b) for a, b, c in rows], "a string, b string, want string, p string, __q string")
    for r in numbers.related(df.drop("__q"), F.col("a"), F.col("b")).collect():
        assert r.hn_rel == r.want
    for r in df.withColumn("r", numbers.number_relation(F.col("a"), F.col("b"))).collect():
        assert r.r == r.want


def test_text_keys(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(text.sorted_key(F.lit("b a b"))) == "a b"
    assert one(text.phonetic_key(F.lit("czechphoqueyy"))) == "kjecfokuei"
    assert one(text.skeleton_key(F.lit("anna"))) == "an"
    assert one(text.grams(F.lit("ab c"))) == [" ab", "ab ", " c "]
    assert one(text.unquoted(F.lit('"say ""hi"""'))) == 'say "hi"' and one(text.unquoted(F.lit('"a" b'))) == '"a" b'
    assert one(text.without_repeats(F.split(F.lit("a a b a"), " "))) == ["a", "b", "a"]


def test_fuzzy_scores():
    assert fuzzy.ratio("kitten", "sitting") == pytest.approx(100 * 2 * 4 / 13)
    assert fuzzy.ratio("", "") == 100 and fuzzy.token_set("", "a") == 0
    assert fuzzy.token_sort("b a", "a b") == 100 and fuzzy.token_set("a b", "a b c") == 100
    assert fuzzy.partial("abc", "xxabcxx") == 100
    assert fuzzy.jaro_winkler("martha", "marhta") == pytest.approx(0.961111, abs=1e-6)
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = ("".join(rng.choice(list("abc"), rng.integers(0, 9))) for _ in range(2))
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
        assert fuzzy.lcs(a, b) == t[-1, -1]


def test_capped_join_splits_common_keys_by_block(spark):
    q = spark.createDataFrame([(1, "rare", "A"), (2, "hot", "A"), (3, "hot", "")], "qi long, key string, blk string")
    p = spark.createDataFrame([(10, "rare", "B")] + [(20 + i, "hot", "A" if i < 2 else "B") for i in range(6)], "pi long, key string, blk string")
    assert rows(candidates.capped_join(q, p, cap=3, block_cap=2), "qi", "pi") == [(1, 10), (2, 20), (2, 21)]


def test_cap_keeps_reserve(spark):
    e = spark.createDataFrame([("a", f"c{i}", 1 - i / 10, int(i in (3, 4, 5))) for i in range(7)], E + ", r int").withColumn("prio", F.col("p"))
    assert rows(candidates.capped(e, 2, F.col("r"), 2), "cand") == [("c0",), ("c1",), ("c3",), ("c4",)]


def test_competition_of_ties(spark):
    e = spark.createDataFrame([("a", "x", 0.5), ("b", "x", 0.5), ("c", "x", 0.1), ("a", "y", 0.4)], E)
    assert rows(features.tie_symmetric(e, "p"), "s1", "cand", "gap", "is_best") == [("a", "x", 0.0, True), ("a", "y", 0.4, True), ("b", "x", 0.0, True), ("c", "x", -0.4, False)]
    c = {(r.s1, r.cand): r.c_is_best for r in features.competition(e).collect()}
    assert c[("a", "x")] and not c[("b", "x")]


def test_em_is_neutral_where_the_mix_is_the_same():
    p = np.array([0.2, 0.6])
    prior, _ = adaptation.em_prior(p, np.array([1.0, 1.0]), 0.4)
    assert prior == pytest.approx(0.4, abs=1e-6)


def test_records_round_trip(spark, tmp_path):
    f = tmp_path / "r.tsv"
    f.write_bytes(b'\xef\xbb\xbfentity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"A ""B"" Co"\tO\'Hare "x\tNULL\nS1-2\t\tNA\tFR\n')
    got = rows(records.read_tsv(spark, str(f), unquote=True), *records.RECORD)
    assert got == [("S1-1", 'A "B" Co', 'O\'Hare "x', "NULL"), ("S1-2", "", "NA", "FR")]
    assert records.convert(spark, str(f), str(tmp_path / "r.parquet")) == 2 == records.convert(spark, str(f), str(tmp_path / "r.parquet"))
    with pytest.raises(ValueError, match="lacks"):
        records.read_tsv(spark, str(f), ["entity_id", "other"])
    v = records.verify(records.read_tsv(spark, str(f))).first()
    assert (v.n, v.blank_business_name, v.null_word_country) == (2, 1, 1)


def test_id_lists(spark, tmp_path):
    order = spark.createDataFrame([("a",), ("b",), ("c",)], "s1 string")
    pairs = spark.createDataFrame([("a", "2"), ("a", "1"), ("a", "2")], "s1 string, mid string")
    wide = idlists.lists(order, pairs, "matched_entity_ids")
    assert rows(wide, "s1", "matched_entity_ids") == [("a", "1,2"), ("b", ""), ("c", "")]
    out = str(tmp_path / "out")
    idlists.write(wide.withColumnRenamed("s1", "source1_entity_id"), out)
    assert rows(idlists.read_truth(spark, out), "s1", "mid") == [("a", "1"), ("a", "2")]
    bad = spark.createDataFrame([("a", "1"), ("b", "1"), ("z", "2"), ("a", " ")], "s1 string, mid string")
    assert {r.rule: r.n for r in idlists.problems(order, bad).collect()} == {"bad_id": 1, "unknown_entity": 1, "owned_twice": 1, "repeated_entity": 0}
