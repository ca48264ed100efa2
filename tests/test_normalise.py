"""Transliteration, names and the learned dictionary, on hand-made rows and against plain Python."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from linkloom.functions import addresses, names, scripts
from linkloom.functions.fuzzy import jaro_winkler
from linkloom.operators import dictionary


@pytest.mark.parametrize(
    ("word", "latin"),
    [("कमला", "kamla"), ("राम", "ram"), ("लिमिटेड", "limited"), ("मुंबई", "mumbai"), ("कृष्णा", "krishna"), ("वस्त्र", "vastra"), ("सरकार", "sarkar"), ("फल", "fal"),
     ("சென்னை", "sennai"), ("ஃபைனான்ஸ்", "fainans"), ("வெற்றி", "vetri"), ("എന്റെ", "ente"), ("പറ്റി", "patti"), ("കേരളം", "keralam"), ("తెలుగు", "telugu"), ("ગુજરાત", "gujrat"), ("१२३", "123"), ("", "")],
)
def test_words_in_latin_letters(word, latin):
    assert scripts.latin_word(word) == latin


def test_text_around_native_words_stays(spark):
    df = spark.createDataFrame([("ABC कमला-राम é",), (None,), ("",), ("plain  text",)], "t string")
    got = [r[0] for r in df.select(scripts.transliterate(F.col("t"))).collect()]
    assert got == ["ABC kamla - ram é", "", "", "plain  text"]


def test_fold_and_script(spark):
    df = spark.createDataFrame([("Société ŁÓDŹ Œuvre ß",), (None,), ("कम",), ("Привет",)], "t string")
    rows = df.select(scripts.fold(F.col("t")).alias("f"), scripts.script(F.col("t")).alias("s")).collect()
    assert [r.f for r in rows] == ["societe lodz oeuvre ss", "", "कम", "привет"]
    assert [r.s for r in rows] == ["latin", "latin", "indic", "other"]


@pytest.mark.parametrize(
    ("name", "country", "norm", "core"),
    [
        ("Ectoarc DBA: Patriot Eco, L.L.C.", "US", "patriot eco llc", "patriot eco"),
        ("WELFARE LEAGUE LTD | www.welfare.com", "us", "welfare league ltd", "welfare league"),
        ("M/s Shri Cesya's Hospita1ity Pvt. Ltd. (India)", "India", "cesyas hospitality pvt ltd india", "cesyas hospitality"),
        ("Les Établissements Dupont S.A.R.L.", "France", "les ets dupont sarl", "dupont"),
        ("The Limited Liability Company", "US", "the llc", "the llc"),
        ("lnc lndia 5ervices [[AB]] (id: 55)", "", "inc india services", "india services"),
        ("कमला ट्रस्ट - 9895970478", "India", "kamla trast", "kamla trast"),
        (None, None, "", ""),
        ("---", "US", "", ""),
    ],
)
def test_names(name, country, norm, core):
    assert names.variants_of(name, country)[:2] == (norm, core)


def test_glued_names():
    v = lambda n: names.variants_of(n, "US")
    assert names.segmented("vijaysoftwareprivate", ["vijay", "software", "private"]) == "vijay software private"
    assert names.segmented("xvijayzz", ["vijay"]) == "x vijay zz" and names.segmented("", ["a"]) == ""
    assert names.glued_score(v("tattoo corner.com"), v("Tattoo Corner LLC")) == 1.0
    assert names.glued_score(v("tattoocorner.com"), v("Corner Tattoo LLC")) == pytest.approx(0.8)
    assert names.glued_score(v("abc"), v("xyz")) == 0.0


def test_name_columns_keep_rows_and_nulls(spark):
    df = spark.createDataFrame([(1, "Acme Inc", "US"), (2, "Acme Inc", "US"), (3, None, None), (4, "Acme Inc", "France")], "id int, business_name string, country string")
    got = {r.id: (r.name_norm, r.name_core, r.script) for r in names.name_columns(df).collect()}
    assert got == {1: ("acme inc", "acme", "latin"), 2: ("acme inc", "acme", "latin"), 3: ("", "", "latin"), 4: ("acme inc", "acme", "latin")}
    assert names.name_columns(df.limit(0)).count() == 0


def test_name_flags(spark):
    df = spark.createDataFrame([("Acme DBA Best 5ervic3s",), ("www.acme.com (x)",), ("ACME",), (None,)], "n string")
    f = names.flags(F.col("n"))
    rows = df.select(*[c.alias(k) for k, c in f.items()]).collect()
    assert rows[0].alias and rows[0].leet and not rows[0].domain
    assert rows[1].domain and rows[1].bracket and not rows[1].alias
    assert rows[2].all_upper and not any(rows[3])


PAIRS = [("Kamla Traders Pvt", "कमला ट्रेडर्स प्रा"), ("Ram Traders Pvt", "राम ट्रेडर्स प्रा"), ("Kamla Foods", "कमला फूड्स"), ("Ram Pvt", "राम प्रा"), ("", "राम"), (None, None), ("Plain", "plain")]


def brute(pairs, support, share, least):
    rows = []
    for a, b in pairs:
        n = [w for w in dictionary.WORD.findall((b or "").lower()) if scripts.INDIC.search(w)]
        x = (a or "").lower().split()
        if n and x:
            rows.append((n, x))
    cn, cl, c = Counter(t for n, _ in rows for t in set(n)), Counter(w for _, x in rows for w in set(x)), Counter((t, w) for n, x in rows for t in set(n) for w in set(x))
    votes = Counter()
    for n, x in rows:
        used = set()
        for t in n:
            s, w = max(((jaro_winkler(dictionary.phonetic(scripts.latin_word(t)), dictionary.phonetic(w)), w) for w in x if w not in used), default=(0, ""))
            if s >= least:
                used.add(w)
            else:
                w = min((w for u, w in c if u == t), key=lambda w: (-2 * c[t, w] / (cn[t] + cl[w]), w))
                if w not in x:
                    continue
            votes[t, w] += 1
    best = {t: min((w for u, w in votes if u == t), key=lambda w: (-votes[t, w], w)) for t, _ in votes}
    return {(t, w, votes[t, w], round(min(1, votes[t, w] / cn[t]), 3)) for t, w in best.items() if votes[t, w] >= support and votes[t, w] / cn[t] >= share}


def test_dictionary_equals_brute_force(spark):
    df = spark.createDataFrame(PAIRS * 2, "latin string, native string")
    got = {tuple(r) for r in dictionary.learn(df).collect()}
    assert got == brute(PAIRS * 2, 2, 0.4, 0.55) and ("प्रा", "pvt") in {g[:2] for g in got}
    assert dictionary.learn(df.limit(0)).count() == 0


def test_dictionary_first_then_rules(spark):
    d = spark.createDataFrame([("प्रा", "pvt")], "native string, latin string")
    df = spark.createDataFrame([(1, "राम-प्रा X"), (2, "राम-प्रा X"), (3, None), (4, "plain"), (5, "")], "id int, t string")
    assert {r.id: r.latin for r in dictionary.transliterate(df, "t", d).collect()} == {1: "ram - pvt X", 2: "ram - pvt X", 3: "", 4: "plain", 5: ""}
    c = dictionary.coverage(df, "t", d).first()
    assert (c.types, c.known_types, c.words, c.known_words, c.word_share) == (2, 1, 4, 2, 0.5)


def test_snapping(spark):
    w = spark.createDataFrame([("kampani",), ("zzz",), ("",)], "word string")
    v = spark.createDataFrame([("company", 900), ("kampany", 3), ("compania", 900)], "token string, n int")
    assert {r.word: r.snapped for r in dictionary.snapped(w, v).collect()} == {"kampani": "company", "zzz": "zzz", "": ""}


@pytest.mark.parametrize(
    ("address", "country", "want"),
    [
        ("007 Main Street Suite 100, PMB 4432, Springfield, IL", "US", {"addr_norm": "7 main st unit 100 springfield il", "house_nums": ["7"], "unit_nums": ["100"], "street_type": "st", "street_key": "main", "city_cands": ["springfield"], "state_key": "il"}),
        ("221B N. Oak Ave., Washington, DC", "US", {"house_nums": ["221b"], "house_base": ["221"], "city_cands": ["washington"], "state_key": "dc"}),
        ("H.No 31-7-15/A, Plot No. 66, Near City Mall, MG Road, Bengaluru 560001, KA", "India", {"house_nums": ["31-7-15/a", "66"], "designated": {"hno": ["31-7-15/a"], "plot": ["66"]}, "landmarks": ["near city mall"], "postcodes": ["560001"], "city_cands": ["bengaluru", "bangalore"], "state_key": "karnataka"}),
        ("B-1201, दिल्ली", "India", {"house_nums": ["b1201"], "state_key": "delhi"}),
        ("12 bis Rue de la Paix, Lille", "France", {"house_nums": ["12b"], "street_key": "paix", "state_key": "hauts de france", "department": "nord"}),
        ("null, , N/A", "US", {"addr_norm": "", "house_nums": [], "state_key": "", "city_cands": []}),
        (None, None, {"addr_norm": "", "state_key": "", "street_type": None}),
    ],
)
def test_addresses(address, country, want):
    got = addresses.parsed(address, country)
    assert {k: got[k] for k in want} == want


@pytest.mark.parametrize(("token", "want"), [("004007", "4007"), ("000", "0"), ("1804A", "1804a"), ("8bis", "8b"), ("33ter", "33t"), ("B-1201", "b1201"), ("31-07-15/A", "31-7-15/a"), ("no34", "34")])
def test_house_numbers(token, want):
    assert addresses.number(token) == want


def test_city_of_most_addresses(spark):
    rows = [(1, "1 A St, Foo, Bar, TX", "US"), (2, "2 B St, Foo, TX", "US"), (3, "3 C St, Foo, TX", "US"), (4, "4 D St, Aaa, Bbb, TX", "US"), (5, None, None), (6, "1 A St, Foo, Bar, TX", "US")]
    df = spark.createDataFrame(rows, "id int, business_address string, country string")
    assert {r.id: r.city_key for r in addresses.address_columns(df).collect()} == {1: "foo", 2: "foo", 3: "foo", 4: "bbb", 5: "", 6: "foo"}
    prior = spark.createDataFrame([("US", "bar", 9)], "country string, city string, n long")
    assert {r.id: r.city_key for r in addresses.address_columns(df, prior=prior).collect()}[1] == "bar"
    assert addresses.address_columns(df.limit(0)).count() == 0


def test_names_are_split_into_words_once(spark):
    from linkloom.operators import dictionary

    pairs = spark.createDataFrame([("zeta karan", "करन ज़"), ("karan", "करन"), ("karan mo", "करन")], "latin string, native string")
    plan = dictionary.learn(pairs)
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
    assert {r.native: r.latin for r in plan.collect()}["करन"] == "karan"


def test_addresses_are_not_joined_with_their_rows(spark, monkeypatch):
    rows = [(i, a, c) for i, (a, c) in enumerate([("12 Main Street, Foo, Barton, Texas", "US"), ("7 Elm St, Barton, TX", "US"), ("7 Elm St, Barton, TX", None), (None, "US"), ("rue de la Paix 5, Paris", "France"), ("12 Main Street, Foo, Barton, Texas", "US")])]
    df = spark.createDataFrame(rows, "id long, business_address string, country string")
    out = addresses.address_columns(df)
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.id: r for r in out.collect()}
    assert got[0].city_key == got[1].city_key == "barton" and got[3].city_key == "" and got[3].addr_norm == ""
    monkeypatch.setattr(addresses, "HELD", -1)
    assert {r.id: r for r in addresses.address_columns(df).collect()} == got
