"""The corpus operators against brute force, round trips and hostile rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from linkloom.llm import chat, line_dedup, lm, packing, pieces, quality, queries, simhash, substring, toxicity, vafile
from linkloom.llm._text import word_hashes

public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
CLASH = ("row", "rank", "rid", "__rid", "__first", "__key", "__wide", "__row", "fp", "line", "good", "a.b")
LABELS = "doc_id long, quality int, toxic int"


def words(n: int, seed: int, vocabulary: int = 60) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def hostile() -> list[tuple]:
    """Nulls in each column, no text, blanks, a very long text, ties, repeated rows, odd characters."""
    passage = words(70, 1, 1000)
    return [
        (None, "no id " + passage, "en", "src0", 1), (1, None, "en", "src1", 0), (2, "", None, "src1", 0), (3, " \t\n ", "en", None, 4),
        (4, passage, "en", "src0", None), (5, passage, "en", "src2", 9), (5, passage, "en", "src2", 9), (6, "x " * 80_000, "en", "src3", 1),
        (7, "head line\n" + passage + "\ntail", "de", "src4", 1), (8, "<|endoftext|> it's [INST] </s> \\e ▁ 日本 😀 İ", "fr", "src5", 1), (9, "short", "en", "src6", 5), (9, "other text of one id", "en", "src6", 5),
    ]


@pytest.fixture(scope="module")
def bad(spark):
    df = spark.createDataFrame(hostile(), DOC)
    for i, c in enumerate(CLASH):
        df = df.selectExpr("*", f"{i} AS `{c}`")
    return df


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def some_docs(n: int = 60) -> dict[int, str]:
    r = random.Random(4)
    shared = [words(80, 100 + i, 400) for i in range(4)]
    docs = {}
    for i in range(n):
        t = words(r.choice([0, 3, 49, 50, 51, 200]), i, r.choice([2, 50, 500])).split()
        for _ in range(r.randint(0, 2)):
            s = r.choice(shared).split()
            a = r.randint(0, 20)
            at = r.randint(0, len(t))
            t[at:at] = s[a : a + r.choice([40, 50, 60])]
        docs[i] = " ".join(t)
    docs[n] = docs[10]
    docs[n + 1] = "same " * 130
    docs[n + 2] = "same " * 60
    return docs


def frame(spark, docs: dict[int, str]):
    return spark.createDataFrame([(i, t, "en", f"src{i % 7}", len(t)) for i, t in docs.items()], DOC)


# 1 ---------------------------------------------------------------------------------------------------------------


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(300, 8)) * 0.3
    v[10] = v[11]
    rows = [(i, [float(x) for x in v[i]]) for i in range(300)] + [(900, None), (901, [1.0, None] + [0.0] * 6), (902, [float("nan")] * 8), (903, [float("inf")] * 8), (None, [0.0] * 8), (904, [])]
    df = vafile.integers(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = defaultdict(list)
    for r in vafile.top_k(df.where("vec_id % 50 = 0"), df).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    q = np.floor(256 * v).astype(np.int64)
    for i in range(0, 300, 50):
        best = sorted((-int(q[i] @ q[j]), j) for j in range(300) if j != i)[:5]
        assert sorted(got[i]) == [(n + 1, j, -s) for n, (s, j) in enumerate(best)]
    few = df.where("vec_id < 3")
    assert vafile.top_k(few.where("vec_id = 0"), few).count() == 2
    assert vafile.top_k(df.where("false"), df.where("false")).count() == 0


def test_copies_ties_and_clashing_columns(spark):
    rng = np.random.default_rng(3)
    v = rng.integers(-3, 4, size=(40, 4)).astype(float) / 4
    rows = [(i, [float(x) for x in v[i]]) for i in range(40)] + [(i % 7 + 50, [0.75] * 4) for i in range(60)] + [(100, [0.75] * 4)] * 9 + [(200, [1.0] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS row", "2 AS v", "3 AS dim", "4 AS block")
    x = vafile.integers(df)
    got = defaultdict(list)
    for r in vafile.top_k(x.where("vec_id % 50 = 0"), x).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    q = [(i, np.floor(256 * np.array(e)).astype(np.int64)) for i, e in rows]
    for i in {i for i, _ in rows if i % 50 == 0}:
        mine = next(e for j, e in q if j == i)
        best = sorted((-int(mine @ e), j) for j, e in q if j != i and len(e) == len(mine))[:5]
        assert sorted(got[i]) == [(n + 1, j, -s) for n, (s, j) in enumerate(best)]


def test_shuffled_queries_and_few_reads(spark, monkeypatch):
    df = queries.table(spark, "/root/testdata/sf0.01", "embeddings")
    x = vafile.integers(df)
    asks = x.where("vec_id % 50 = 0")
    want = sorted(map(tuple, vafile.top_k(asks, x).collect()))
    reads = [r.n_read for r in vafile.top_k(asks, x, reads=True).collect()]
    assert sum(reads) < 0.1 * len(reads) * x.count()
    monkeypatch.setattr(vafile, "BROADCAST", 0)
    monkeypatch.setattr(vafile, "COMPONENTS", 64 * 100)
    monkeypatch.setattr(vafile, "ASKED", 64 * 3)
    assert sorted(map(tuple, vafile.top_k(asks, x).collect())) == want


@pytest.mark.parametrize("cells", [2, 5, 64])
def test_bounds_hold_and_never_lose_a_winner(cells):
    rng = np.random.default_rng(2)
    v = rng.integers(-200, 200, size=(500, 16)) * rng.integers(1, 50, size=16)
    ids = np.arange(500)
    code, low, high = vafile.cells_of(v, cells)
    least, most = vafile.bounds(v[:20], code, low, high)
    exact = v[:20] @ v.T
    assert (least <= exact).all() and (exact <= most).all()
    found = defaultdict(set)
    for who, _, at, _, _ in vafile.candidates(ids[:20], v[:20], ids, ids, code, low, high, 5):
        for i, j in zip(who.tolist(), at.tolist(), strict=True):
            found[i].add(j)
    for i in range(20):
        assert {j for _, j in sorted((-int(exact[i, j]), j) for j in range(500) if j != i)[:5]} <= found[i]


# 2 ---------------------------------------------------------------------------------------------------------------


def brute_lm(docs: dict) -> dict:
    t = {i: x.split() for i, x in docs.items()}
    counts = {i: [Counter(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) for n in (1, 2, 3)] for i, w in t.items()}
    total = [sum((c[n] for c in counts.values()), Counter()) for n in range(3)]
    size = sum(map(len, t.values()))
    out = {}
    for i, w in t.items():
        rest = lambda g, i=i: total[len(g) - 1][g] - counts[i][len(g) - 1][g]
        s = 0.0
        for k in range(len(w)):
            p, factor = None, 1.0
            for n in range(min(k, 2), 0, -1):
                g = tuple(w[k - n : k + 1])
                if rest(g) > 0:
                    p = factor * rest(g) / rest(g[:-1])
                    break
                factor *= 0.4
            s += np.log(p if p is not None else factor * max(rest((w[k],)), 1) / (size - len(w) + 1))
        out[i] = (len(w), s)
    return out


@pytest.mark.parametrize("block", [1 << 30, 300])
def test_backoff_scores(spark, block):
    docs = some_docs(40)
    want = brute_lm(docs)
    got = lm.score(frame(spark, docs), block_bytes=block, part_grams=500 if block < 1000 else 10**6).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.n_words == want[r.doc_id][0] and r.log_score == pytest.approx(want[r.doc_id][1], abs=1e-6)
        assert (r.mean_log_score is None) == (r.n_words == 0)


def test_backoff_of_hostile_rows(spark, bad, empty):
    want = brute_lm({i: r[1] or "" for i, r in enumerate(hostile())})
    by = Counter((r[0], want[i][0], round(want[i][1], 4)) for i, r in enumerate(hostile()))
    assert Counter((r.doc_id, r.n_words, round(r.log_score, 4)) for r in lm.score(bad, block_bytes=2000, part_grams=300).collect()) == by
    assert lm.score(empty).count() == 0
    same = spark.createDataFrame([(7, "one two three")] * 50, "doc_id long, text string")
    got = {(r.n_words, round(r.log_score, 9)) for r in lm.score(same, block_bytes=100).collect()}
    assert got == {(3, round(float(np.log(49 / (49 * 3 + 1)) + 0.0 + 0.0), 9))}


def test_texts_are_exchanged_once(spark):
    plan = lm.score(frame(spark, some_docs(11)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") == 1 or plan.count("hashpartitioning(block") == 3  # reuse is settled as the query runs


def test_packed_numbers_come_back():
    x = np.sort(np.random.default_rng(3).integers(0, 1 << 64, 1000, dtype=np.uint64))
    assert (lm.unpacked(lm.packed(x, 8, True), 8, True) == x).all()
    assert len(lm.unpacked(lm.packed(x[:0], 8, True), 8, True)) == 0
    part, cut = lm._cuts(x, 7)
    assert cut[0] == 0 and cut[-1] == 1000 and part.tolist() == list(range(7))
    assert all(int(v) * 7 >> 64 == p for p, i, j in zip(part, cut[:-1], cut[1:], strict=True) for v in (x[i], x[j - 1]))


# 3 ---------------------------------------------------------------------------------------------------------------


def brute_fingerprint(text: str | None) -> int:
    w = [bytes(x) for x in (text or "").encode().split()]
    w = [x.lower() for x in w]
    s = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else ([b" ".join(w)] if w else [])
    out = 0
    for bit in range(64):
        if 2 * sum(xxhash.xxh64_intdigest(x, 42) >> bit & 1 for x in s) > len(s):
            out |= 1 << bit
    return out


def brute_classes(rows: list[tuple]) -> list[tuple]:
    fp = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, f"{fp[i]:016x}", low.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


def test_classes_of_near_copies(spark, bad, empty):
    base = words(400, 7, 5000).split()
    docs = dict(some_docs(30))
    for i in range(40):
        w = list(base)
        w[(i * 9) % 400] = f"edit{i}"
        docs[200 + i] = " ".join(w)
    got = sorted((tuple(r) for r in simhash.near_duplicates(frame(spark, docs)).collect()), key=repr)
    assert got == brute_classes(list(docs.items()))
    got = sorted((tuple(r) for r in simhash.near_duplicates(bad).collect()), key=repr)
    assert got == brute_classes([(a, b) for a, b, *_ in hostile()])
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("parts", [2, 3, 4, 5])
def test_balls_find_every_link(spark, parts):
    r = random.Random(parts)
    seeds = [r.getrandbits(64) for _ in range(20)]
    fps = set(seeds)
    for s in seeds:
        for _ in range(15):
            x = s
            for b in r.sample(range(64), r.randint(1, 6)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    to = lambda x: x - (1 << 64) if x >> 63 else x
    from linkloom.llm.components import connected_components

    if parts == 2:
        fps = fps[:80]
    found = simhash.linked(spark.createDataFrame([(to(x),) for x in fps], "fp long"), 4, parts)
    got = {x: x for x in map(to, fps)} | {r.node: r.component for r in connected_components(found).collect()}
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(fps):
        for y in fps[:i]:
            if (x ^ y).bit_count() <= 4:
                root[find(x)] = find(y)
    mine, other = defaultdict(set), defaultdict(set)
    for x in fps:
        mine[got[to(x)]].add(x)
        other[find(x)].add(x)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, other.values()))


def test_one_of_each_class_stays(spark, bad):
    left = simhash.representatives(bad).collect()
    assert sorted(left[0].asDict()) == sorted(bad.columns)
    keep = {(d, f) for d, f, c in brute_classes([(a, b) for a, b, *_ in hostile()]) if d == c}
    assert {(r.doc_id, f"{brute_fingerprint(r.text):016x}") for r in left} == keep


# 4 ---------------------------------------------------------------------------------------------------------------


def check_pieces(rows, limits=packing.Limits()):
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append(r)
        by_doc[(r.doc_id, r.doc_tokens)].append(r)
    padding = total = 0
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= limits.tokens and len(s) <= limits.segments and sum(r.loss_tokens for r in s) <= limits.loss
        padding += 0 if at & (at - 1) == 0 else limits.tokens - at
        total += at
    assert padding <= 0.01 * total
    return by_doc


def test_pieces_hold_every_token_once(spark, bad, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    got = packing.pack_documents(bad, path).collect()
    check_pieces(got)
    want = Counter()
    for d, x, *_ in hostile():
        ids = np.array(t.encode(x or "", add_special_tokens=False).ids + [2], "<u4")
        want[(d, len(ids))] += len(ids)
        for r in got:
            if (r.doc_id, r.doc_tokens) == (d, len(ids)):
                assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    have = Counter()
    for r in got:
        have[(r.doc_id, r.doc_tokens)] += r.length
    assert have == want
    assert packing.pack_documents(empty, path).count() == 0


def test_all_three_limits_hold(spark):
    limits = packing.Limits(tokens=64, segments=3, loss=40, window=8)
    rows = [(i, "p " * (i % 9), "a " * (i % 31)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, prompt string, text string")
    encode = lambda docs: [np.arange(len(x.split()), dtype="<u4").tobytes() for x in docs]
    got = packing.pack(df, encode, limits, prompt_col="prompt").collect()
    by = check_pieces(got, limits)
    assert sum(r.loss_tokens for r in got) == sum(i % 31 + 1 for i in range(200))
    assert sum(sum(r.length for r in v) for v in by.values()) == sum(i % 9 + i % 31 + 1 for i in range(200))


# 5 ---------------------------------------------------------------------------------------------------------------


def brute_repeats(rows: list[tuple], size: int = 50) -> list[tuple]:
    last = 1 << 62
    first: dict[tuple, int] = {}
    split = [((d if d is not None else last), (t or "").encode().split()) for d, t in rows]
    for d, w in split:
        for p in range(len(w) - size + 1):
            k = tuple(w[p : p + size])
            first[k] = min(first.get(k, d), d)
    out = []
    for (d, _), (rank, w) in zip(rows, split, strict=True):
        gone = [False] * len(w)
        for p in range(len(w) - size + 1):
            if first[tuple(w[p : p + size])] < rank:
                gone[p : p + size] = [True] * size
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_repeated_passages(spark, empty):
    docs = some_docs()
    got = sorted((tuple(r) for r in substring.remove_repeats(frame(spark, docs)).collect()), key=repr)
    assert got == brute_repeats(list(docs.items()))
    assert substring.remove_repeats(empty).count() == 0


def test_repeats_in_hostile_rows(spark, bad):
    rows = [(a, b) for a, b, *_ in hostile()]
    assert sorted((tuple(r) for r in substring.remove_repeats(bad).collect()), key=repr) == brute_repeats(rows)
    text = substring.remove_repeats(bad, output="text")
    assert text.columns == bad.columns
    want = {(d, h) for d, n, gone, h in brute_repeats(rows) if gone}
    got = {(r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in text.collect()}
    assert want <= got and text.count() == len(rows)


@pytest.mark.parametrize("bits", [1, 3])
def test_colliding_names_change_nothing(spark, bits):
    docs = some_docs(25)
    got = sorted((tuple(r) for r in substring.remove_repeats(frame(spark, docs), bits=bits).collect()), key=repr)
    assert got == brute_repeats(list(docs.items()))


def test_digests_are_of_the_words(monkeypatch):
    monkeypatch.setattr(substring, "spans", lambda x: (x[i : i + 1800] for i in range(0, len(x), 1800)))
    text = b"".join(b"w%05d  \n" % (i % 997) for i in range(3000))  # nine bytes a word: parts end at white space
    w = text.split()
    first = np.sort(np.random.default_rng(4).integers(0, 2900, 400))
    last = np.maximum.accumulate(first + 50)
    low, high = substring.digests(text, first, last)
    for a, b, x, y in zip(first, last, low, high, strict=True):
        assert hashlib.blake2b(b" ".join(w[a:b]), digest_size=16).digest() == np.array([x, y]).tobytes()


def test_names_depend_on_their_stretch_alone():
    a = word_hashes(words(300, 3, 5).encode())
    sym, lo, hi, _ = substring.recompress(a, np.array([300]))
    for cut in (37, 90):
        s2, lo2, hi2, _ = substring.recompress(a[cut:], np.array([300 - cut]))
        mine = {(int(x), int(l), int(h)) for x, l, h in zip(sym, lo, hi, strict=True)}
        inside = [(int(x), int(l) + cut, int(h) + cut) for x, l, h in zip(s2, lo2, hi2, strict=True) if l >= 1 and h <= 300 - cut]
        assert inside and all(x in mine for x in inside)


# 6 ---------------------------------------------------------------------------------------------------------------


def test_boilerplate_goes(spark, bad, empty):
    rows = [(i, f"menu home about\nbody of page {i} goes on and on for a while\n\nall rights", "en", f"s{i % 12}", 0) for i in range(24)]
    rows += [(100 + i, "menu home about", "en", f"s{i}", 0) for i in range(12)]
    rows += [(200 + i, f"near nine {i}\nonly on nine sites here\nthe rest of this page is its own {i}", "en", f"s{i}", 0) for i in range(9)]
    out = {r.doc_id: r for r in line_dedup.remove_boilerplate(spark.createDataFrame(rows, DOC)).collect()}
    assert out[3].text == "body of page 3 goes on and on for a while\n" and out[3]["__removed"] == 2 and out[3]["__lines"] == 3
    assert out[105].text == "" and "only on nine" in out[203].text
    spared = {r.doc_id: r for r in line_dedup.remove_boilerplate(spark.createDataFrame(rows, DOC), spare_repeated=0.5).collect()}
    assert spared[105].text == "menu home about" and spared[3].text == out[3].text
    got = line_dedup.remove_boilerplate(bad)
    assert got.count() == len(hostile()) and got.columns[: len(bad.columns)] == bad.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter((a, b) for a, b, *_ in hostile())
    assert line_dedup.remove_boilerplate(empty).count() == 0


def test_native_plans_run_no_python(spark):
    for q in (queries.op6_line_dedup, queries.op10_chat_formatting):
        plan = q(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# 7 ---------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece.SentencePieceProcessor(model_file=path), pieces.Scan(path), path


def odd_texts() -> list[str]:
    r = random.Random(8)
    out = ["a", " ", "  two  spaces ", "line\n\nbreak", "日本語 😀", "don't stop", "aaaaaaaaaaaaaaaaaaaaaaaa", "x▁y", "======== ---"]
    out += ["".join(r.choice("abeinrst ▁\n1.,") for _ in range(150)) for _ in range(40)]
    return out + ["".join(r.choice("abeinrst") for _ in range(300)) for _ in range(20)]


def test_ids_equal_the_library(library):
    sp, scan, _ = library
    for x in odd_texts():
        assert np.frombuffer(scan.encode(pieces.normal(x)), "<i4").tolist() == sp.encode(x)
        assert scan.decode(np.array(sp.encode(x))) == sp.decode(sp.encode(x))


@pytest.mark.parametrize("size", [7, 40, 64])
def test_chunks_give_the_same_ids(library, size):
    sp, scan, _ = library
    for x in odd_texts():
        rows, cut = [], list(pieces._chunks(pieces.normal(x), size, scan.longest))
        for _, part, left, right, first, final in cut:
            m = scan.matrix(part, left, right, first, final)
            rows.append({"matrix": [{"e": e, "p": p, "to": [{"e": a, "p": b} for a, b in to]} for (e, p), to in m.items()]})
        got = b"".join(scan.trace(c[1], c[2], c[3], a, b, c[5]) for c, (a, b) in zip(cut, pieces._states(rows), strict=True))
        assert np.frombuffer(got, "<i4").tolist() == sp.encode(x)


def test_products_are_associative(library):
    _, scan, _ = library
    m = [scan.matrix(*c[1:]) for c in pieces._chunks(pieces.normal("thisisonelongwordwithoutspaces" * 6), 30, scan.longest)]
    one = pieces.combine(pieces.combine(m[0], m[1]), m[2])
    assert one == pieces.combine(m[0], pieces.combine(m[1], m[2]))


def test_giant_and_hostile_texts(spark, library, bad, empty):
    sp, _, path = library
    got = pieces.decode(pieces.encode(bad, path, chunk=1000), path).collect()
    want = Counter((d, tuple(sp.encode(x or ""))) for d, x, *_ in hostile())
    assert Counter((r.doc_id, tuple(np.frombuffer(bytes(r.ids), "<i4").tolist())) for r in got) == want
    assert Counter((r.doc_id, r.text) for r in got) == Counter((d, sp.decode(sp.encode(x or ""))) for d, x, *_ in hostile())
    tree = pieces.encode(bad, path, chunk=700, fan=3).collect()
    assert Counter((r.doc_id, tuple(np.frombuffer(bytes(r.ids), "<i4").tolist())) for r in tree) == want
    assert pieces.encode(empty, path).count() == 0


# 8 ---------------------------------------------------------------------------------------------------------------


def brute_base(text: str | None) -> tuple:
    t = text or ""
    w = t.encode().split()
    seen, dup = set(), 0
    for line in t.encode().split(b"\n"):
        if line.split():
            dup += line in seen
            seen.add(line)
    c = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    cover = [False] * len(w)
    for i in range(len(w) - 2):
        if c[tuple(w[i : i + 3])] > 1:
            cover[i : i + 3] = [True] * 3
    return len(w), sum(len(x.decode()) for x in w), sum(x in "#*$%&|<>" for x in t), dup, sum(cover)


def test_base_counts(spark, bad, empty):
    none = spark.createDataFrame([], LABELS)
    rows = [(a, b) for a, b, *_ in hostile()] + [(100, "a b c\na b c\n#x"), (101, "é é é é"), (102, "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in quality.score(df, none).collect())
    want = Counter()
    for d, t in rows:
        b = brute_base(t)
        failed = b[0] < 50 or 100 * b[4] > 50 * b[0]
        want[(d, *b, failed, not failed)] += 1
    assert got == want
    assert quality.score(empty, none).count() == 0
    assert quality.keep(bad, none).columns == bad.columns


def test_held_out_verdicts(spark):
    sf = "/root/testdata/sf0.1"
    labels = queries.table(spark, sf, "labels")
    r = quality.score(queries.table(spark, sf, "documents"), labels).join(labels, "doc_id").where("NOT base_failed AND crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1")
    n = {(x.quality, x.kept): x["count"] for x in r.groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) <= 0.01 * n[(1, True)] and n.get((0, True), 0) <= 0.05 * n[(0, False)]


def test_ratios_and_threshold_against_brute_force(spark):
    """Every step again with Python's dictionaries, from word hashes on."""
    docs = {i: words(60 + i % 5, i, 3000) if i % 4 else words(60, i, 40).replace("w", "v") for i in range(300)}
    labels = [(i, int(i % 4 != 0), 0) for i in docs if i % 2]
    got = {r.doc_id: r for r in quality.score(frame(spark, docs), spark.createDataFrame(labels, LABELS)).collect()}
    mixed = lambda x: int(quality.mix(np.array([x % (1 << 64)], np.uint64))[0])
    half = quality.BUCKETS // 2
    grams = {}
    for i, t in docs.items():
        h = [xxhash.xxh3_64_intdigest(w) for w in t.encode().split()]
        pair = [mixed(a * int(quality._A) + b * int(quality._B)) for a, b in zip(h, h[1:], strict=False)]
        grams[i] = [mixed(x) % half for x in h] + [x % half + half for x in pair]
    remainder = lambda i: zlib.crc32(str(i).encode()) % 3
    raw, good = Counter(), Counter()
    for i, g in grams.items():
        raw.update(g)
        if remainder(i) == 0 and (i, 1, 0) in labels:
            good.update(g)
    total, trusted, smooth = sum(raw.values()), sum(good.values()), 20 * quality.BUCKETS / 16
    p = lambda x: (raw[x] + 1) / (total + quality.BUCKETS)
    llr = {i: sum(np.log((good[x] + smooth * p(x)) / (trusted + smooth) / p(x)) for x in g) / len(g) for i, g in grams.items()}
    assert all(got[i].llr == pytest.approx(x, abs=1e-9) for i, x in llr.items())
    sides = [[x for i, x in llr.items() if remainder(i) == 2 and (i, q, 0) in labels and not got[i].base_failed] for q in (1, 0)]
    cut, best = -np.inf, 0.0
    at = sorted({*sides[0], *sides[1]})
    for t in ((a + b) / 2 for a, b in zip(at, at[1:], strict=False)):
        gain = sum(x < t for x in sides[1]) / max(len(sides[1]), 1) - quality.GOOD_WORTH * sum(x < t for x in sides[0]) / max(len(sides[0]), 1)
        if gain > best + 1e-12:
            cut, best = t, gain
    assert {i: r.kept for i, r in got.items()} == {i: not got[i].base_failed and x >= cut for i, x in llr.items()}


def test_thresholds_lie_between():
    f = lambda *x: quality.cut_between(*(np.array(y, float) for y in x))
    assert f([1, 2], [-1, 0]) == 0.5 and f([], [1]) == -np.inf == f([1], []) == f([0, 0], [0, 0]) == f([1, 2], [1.5])


# 9 ---------------------------------------------------------------------------------------------------------------


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = queries.table(spark, sf, "labels")
    r = toxicity.score(queries.table(spark, sf, "documents"), labels)
    x = r.join(labels, "doc_id").where("held_out").groupBy("toxic").agg({"predicted": "avg"}).collect()
    rate = {y.toxic: y["avg(predicted)"] for y in x}
    assert rate[0] <= 0.02 and rate[1] >= 0.85
    assert all(toxicity.held_out(y.doc_id) == (zlib.crc32(str(y.doc_id).encode()) % 3 == 1) == y.held_out for y in r.limit(50).collect())


def test_labels_are_not_read_from_held_out_rows(spark):
    docs = [(i, "idiot word here" if i % 2 else "calm word here") for i in range(400)]
    flip = lambda i: i % 2 if zlib.crc32(str(i).encode()) % 3 != 1 else 1 - i % 2
    df = spark.createDataFrame(docs, "doc_id long, text string")
    a, b = ({r.doc_id: round(r.score, 9) for r in toxicity.score(df, spark.createDataFrame([(i, 1, f(i)) for i, _ in docs], LABELS)).collect()} for f in (lambda i: i % 2, flip))
    assert a == b and a[1] > 0.7 > 0.3 > a[2]


def test_swaps_take_identity_out_of_the_weights():
    rng = np.random.default_rng(5)
    # Grams: 0 insult, 1 group a, 2 group b; group a goes with the insult in the sample.
    rows, changed, y = [], [], []
    for _ in range(400):
        bad, group = rng.random() < 0.5, rng.random()
        g = 1 if group < (0.8 if bad else 0.2) else 2
        insult = [0] if bad and rng.random() < 0.7 else []
        rows.append(np.array([*insult, g]))
        changed.append(np.array([*insult, 3 - g]))
        y.append(bad)
    plain, _ = toxicity.train(rows, [None] * 400, np.array(y), 3)
    fair, _ = toxicity.train(rows, changed, np.array(y), 3, swap=10.0)
    assert abs(plain[1] - plain[2]) > 5 * abs(fair[1] - fair[2]) and fair[0] > 1
    assert toxicity.swapped(toxicity.clean(b"The women, men and (Christians)")) == b"the men  women and  jews "


def test_toxicity_of_hostile_rows(spark, bad, empty):
    none = spark.createDataFrame([], LABELS)
    got = toxicity.score(bad, none).collect()
    assert len(got) == len(hostile()) and all(0 <= r.score < 0.7 and r.predicted == 0 for r in got)
    assert toxicity.score(empty, none).count() == 0


# 10 --------------------------------------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "hi <s> [INST] \\e \\\\l"), (1, 1, "assistant", "</s>"), (1, 2, "user", None), (1, 3, "assistant", "ok [/INST] \\"), (2, 0, "system", "x"), (2, 1, "user", ""), (None, None, None, "t"), (3, 0, "assistant", ""), (3, 0, "assistant", ""), (3, 1, "us[er", "q")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS target", "2 AS formatted")
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append(((t is not None, t or 0), r or "", x or ""))
    got = {r.conv_id: r for r in chat.read_back(chat.expand(df)).collect()}
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        all_turns = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(turns), hashlib.sha256(all_turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    e = chat.expand(df).where("conv_id = 1").orderBy("target").collect()
    assert [x.n_turns for x in e] == [2, 4] and e[1].formatted[e[1].loss_start : e[1].loss_start + e[1].loss_length] == "ok \\b/INST] \\e"
    assert chat.expand(df.where("false")).count() == 0


# pipeline --------------------------------------------------------------------------------------------------------


def test_pipeline(spark, bad):
    import corpus_pipeline as p

    docs = queries.table(spark, SF, "documents")
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert stage(spark, bad, SF).columns == bad.columns
        docs = p.stash(out)
    n = docs.count()
    assert 0 < n < queries.table(spark, SF, "documents").count()
    by = check_pieces(p.STAGES[-1][1](spark, docs, SF).collect())
    assert len({d for d, _ in by}) == n
