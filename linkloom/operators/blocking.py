"""Candidate generation as a whole: exact-key passes, TF-IDF passes in geographic blocks, their union, priority and cap.

Records are ``(id, side, state_key, city_key, name_core, name_norm, name_compact, addr_norm, house_nums)``; side 0 are the entities, all others
the pool. The keys of all passes are cut once into one table, joined once, and never by a key that more than a cap of
pool records carry. Unknown text is ''.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions import gazetteers as g
from linkloom.functions import text
from linkloom.operators import candidates, similarity
from linkloom.session import spread, stored

STREET_PASSES = ("akey", "stname")
KEY_PASSES = ("name", "compact", "addr", "skel", "tok", "hn", *STREET_PASSES)
TFIDF_FIELDS = ("name", "addr", "both")
# Words of an address that are no street's name, beside street types, units and designators; and words that are, although they are types.
NO_STREET = "n s e w ne nw se sw north south east west the and of at in on to near opp behind po dist tal vill ps co so wo floor box city county town township village no hno dno plot flat shop apt appt appart appartement etage bat pmb suite ste cdp twp cedex bp cs lieu dit unit room rm bldg building".split()
STILL_STREET = "main cross nagar colony sector layout".split()
STREET_STOP = sorted(set().union(*g.STREETS.values()) - set(STILL_STREET) | set(NO_STREET) | g.UNITS | g.DESIGNATORS | g.FLOORS | g.SMALL_WORDS)


@dataclass(frozen=True)
class Blocking:
    """Settings; ``reserve`` more candidates of the street passes are kept beyond ``cap``."""

    key_cap: int = 30
    block_cap: int = 150
    street_cap: int = 20
    token_letters: int = 3
    tokens: int = 3
    numbers: int = 3
    words: int = 6
    digits: int = 6
    street_letters: int = 2
    street_numbers: int = 2
    forward: dict = field(default_factory=lambda: {"name": 20, "addr": 20, "both": 20, "skel": 10})
    reverse: dict = field(default_factory=lambda: {"name": 3, "addr": 3, "both": 3, "skel": 2})
    least_score: float = 0.05
    fields: tuple = TFIDF_FIELDS
    unknown_forward: int = 5
    city_votes: int = 20
    city_share: float = 0.8
    cap: int | None = 80
    reserve: int = 5


def street_words(letters: int = 2) -> Column:
    """Sorted words of the address without figures, stop words and the words of its city and state, as an array."""
    own = F.concat(text.tokens(F.col("city_key")), text.tokens(F.col("state_key")))
    kept = F.filter(text.tokens(F.col("addr_norm")), lambda w: (F.length(w) >= letters) & ~w.rlike("[0-9]"))
    return F.array_sort(F.array_except(F.array_except(kept, F.array(*map(F.lit, STREET_STOP))), own))


def _plain_number(c: Column) -> Column:
    return F.ltrim(F.regexp_extract(c, "[0-9]+", 0), F.lit("0"))


def exact_keys(r: DataFrame, kind: str, how: Blocking = Blocking()) -> DataFrame:
    """``(id, side, blk, key)`` of one pass but ``tok`` and ``hn``, whose keys depend on the whole pool."""
    joined = lambda a, sep=" ": F.array_join(F.array_sort(F.array_distinct(a)), sep)
    core = text.tokens(F.col("name_core"))
    if kind == "name":
        keys = F.filter(F.array(joined(core)), lambda k: F.length(k) >= 2)
    elif kind == "compact":
        keys = F.filter(F.array("name_compact", F.replace("name_norm", F.lit(" "), F.lit(""))), lambda k: F.length(k) >= 5)
    elif kind == "addr":
        words = F.array_distinct(text.tokens(F.col("addr_norm")))
        keys = F.when(F.size(words) >= 3, F.array(joined(words))).otherwise(F.array().cast("array<string>"))
    elif kind == "skel":
        keys = F.filter(F.array(joined(F.filter(F.transform(core, text.skeleton_key), lambda k: k != ""))), lambda k: F.length(k) >= 3)
    elif kind in STREET_PASSES:
        street, city = F.array_join(street_words(how.street_letters), " "), F.col("city_key")
        if kind == "akey":
            numbers = F.filter(F.transform("house_nums", _plain_number), lambda n: F.length(n).between(1, how.digits))
            keys = F.transform(F.slice(F.array_distinct(numbers), 1, how.street_numbers), lambda n: F.concat_ws("|", n, street, city))
        else:
            names = F.filter(F.array(joined(core, ""), F.col("name_compact")), lambda n: F.length(n) >= 3)
            keys = F.transform(names, lambda n: F.concat_ws("|", street, city, n))
        keys = F.when((street != "") & (city != ""), keys).otherwise(F.array().cast("array<string>"))
    else:
        raise ValueError(f"no exact keys for pass {kind!r}")
    return r.select("id", "side", F.col("state_key").alias("blk"), F.explode(F.array_distinct(keys)).alias("key"))


def _in_pool(values: DataFrame, value: str) -> DataFrame:
    return values.where("side > 0").groupBy(value).agg(F.count("*").alias("df"))


def token_keys(r: DataFrame, how: Blocking = Blocking()) -> DataFrame:
    """All words of pool names; of an entity's, the rarest in the pool."""
    t = r.select("id", "side", F.col("state_key").alias("blk"), F.explode(F.array_distinct(text.tokens(F.col("name_core")))).alias("key")).where(F.length("key") >= how.token_letters)
    return candidates.rarest(t.where("side = 0"), "id", "key", _in_pool(t, "key"), how.tokens).select("id", "side", "blk", "key").unionByName(t.where("side > 0"))


def number_word_keys(r: DataFrame, how: Blocking = Blocking()) -> DataFrame:
    """Each record's rarest numbers with its rarest address words."""
    numbers = F.concat(F.regexp_extract_all("addr_norm", F.lit("[0-9]+"), F.lit(0)), F.coalesce("house_nums", F.array().cast("array<string>")))
    numbers = F.filter(F.array_distinct(F.transform(numbers, _plain_number)), lambda n: F.length(n).between(1, how.digits))
    words = F.filter(F.array_distinct(text.tokens(F.col("addr_norm"))), lambda w: w.rlike("^[a-z]{3,}$"))
    n, w = r.select("id", "side", F.col("state_key").alias("blk"), F.explode(numbers).alias("n")), r.select("id", "side", F.explode(words).alias("w"))
    few = candidates.rarest(n, "id", "n", _in_pool(n, "n"), how.numbers)
    return few.join(candidates.rarest(w, "id", "w", _in_pool(w, "w"), how.words).select("id", "w"), "id").select("id", "side", "blk", F.concat_ws("|", "n", "w").alias("key"))


def keys(r: DataFrame, passes: tuple[str, ...] = KEY_PASSES, how: Blocking = Blocking()) -> DataFrame:
    """``(pass, id, side, blk, key)`` of all passes."""
    out = None
    for kind in passes:
        x = token_keys(r, how) if kind == "tok" else number_word_keys(r, how) if kind == "hn" else exact_keys(r, kind, how)
        x = x.select(F.lit(kind).alias("pass"), "id", "side", "blk", "key")
        out = x if out is None else out.unionByName(x)
    return out


def key_pairs(keys: DataFrame, how: Blocking = Blocking(), once: bool = True) -> DataFrame:
    """``(pass, qi, pi)``: keys that few pool records carry join everywhere, commoner ones inside a known block that has few of them.

    If not ``once``, a pair is there once for each key of a pass that joins it, and pairs are not exchanged.
    """
    street = F.col("pass").isin(*STREET_PASSES)
    cap, block_cap = F.when(street, how.street_cap).otherwise(how.key_cap), F.when(street, how.street_cap).otherwise(how.block_cap)
    every = stored(keys.distinct())
    pool = every.where("side > 0")
    blocks = pool.groupBy("pass", "key", "blk").agg(F.count("*").alias("n_blk"))
    counted = blocks.groupBy("pass", "key").agg(F.sum("n_blk").alias("n"))
    kept = stored(blocks.join(counted, ["pass", "key"]).select("pass", "key", "blk", (F.col("n") <= cap).alias("everywhere"), "n_blk").where((F.col("everywhere")) | ((F.col("blk") != "") & (F.col("n_blk") <= block_cap))))
    q = every.where("side = 0").select("pass", "key", "blk", F.col("id").alias("qi"))
    p = pool.select("pass", "key", "blk", F.col("id").alias("pi")).join(kept.select("pass", "key", "blk", "everywhere"), ["pass", "key", "blk"])
    far = q.drop("blk").join(p.where("everywhere").drop("blk", "everywhere"), ["pass", "key"])
    near = q.join(p.where("NOT everywhere").drop("everywhere"), ["pass", "key", "blk"])
    pairs = far.select("pass", "qi", "pi").unionByName(near.select("pass", "qi", "pi"))
    return pairs.distinct() if once else pairs


#: Keys whose counts the tasks hold in memory, at most; with more of them, records meet the counts in a join.
HELD = 6_000_000


def _pool_counts(marked: DataFrame, how: Blocking) -> DataFrame:
    """``(key, df, near)`` of all keys of pool records in ``marks``; ``near``: the known blocks that have few of a key that is too common."""
    at = marked.where("side > 0").select("blk", F.explode("marks").alias("key")).groupBy("key", "blk").agg(F.count("*").alias("n"))
    few = F.when((F.col("n") <= how.block_cap) & (F.col("blk") != ""), F.col("blk"))
    every = at.groupBy("key").agg(F.sum("n").cast("int").alias("df"), F.collect_list(few).alias("near"))
    return every.withColumn("near", F.when(F.col("df") > how.key_cap, F.col("near")).otherwise(F.array().cast("array<string>")))


def _with_counts(marked: DataFrame, how: Blocking) -> Callable[[DataFrame], DataFrame]:
    """What adds ``c`` to rows of ``marked (id, side, blk, name_core, marks)``, without the marks: for each of them its pool records,
    below 0 if the key is common but few of the record's own block have it.

    Tasks hold the counts by 64-bit hashes, as long as those are few and all differ; otherwise counts are joined and gathered by id.
    """
    counts = stored(_pool_counts(marked, how))
    size = counts.agg(F.count("*"), F.coalesce(F.sum(F.size("near")), F.lit(0))).first()
    kept = [x for x in marked.columns if x != "marks"]
    if sum(size) <= HELD:
        own = counts.select(F.xxhash64("key").alias("h"), "df").toArrow()
        near = counts.select(F.explode(F.transform("near", lambda b: F.xxhash64("key", b))).alias("h")).toArrow()
        h, df, hb = own["h"].to_numpy(), own["df"].to_numpy(), np.sort(near["h"].to_numpy())
        order = np.argsort(h)
        h, df = h[order], df[order]
        if not (h[1:] == h[:-1]).any() and not (hb[1:] == hb[:-1]).any():
            held = marked.sparkSession.sparkContext.broadcast((h, df, hb))

            def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                h, df, hb = held.value
                for b in batches:
                    keys, inside = b.column("h"), b.column("hb")
                    flat, blk = keys.flatten().to_numpy(zero_copy_only=False), inside.flatten().to_numpy(zero_copy_only=False)
                    out = np.zeros(len(flat), np.int32)
                    if len(h):
                        at = np.minimum(np.searchsorted(h, flat), len(h) - 1)
                        out = np.where(h[at] == flat, df[at], 0).astype(np.int32)
                    if len(hb):
                        at = np.minimum(np.searchsorted(hb, blk), len(hb) - 1)
                        out = np.where(hb[at] == blk, -out, out)
                    ends = np.concatenate(([0], np.cumsum(keys.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([*(b.column(x) for x in kept), pa.ListArray.from_arrays(pa.array(ends), pa.array(out))], names=[*kept, "c"])

            kinds = ", ".join(f"{x} {marked.schema[x].dataType.simpleString()}" for x in kept)
            hashes = F.transform("marks", lambda k: F.xxhash64(k)).alias("h"), F.transform("marks", lambda k: F.xxhash64(k, "blk")).alias("hb")
            return lambda rows: rows.select(*kept, *hashes).mapInArrow(found, f"{kinds}, c array<int>")

    def joined(rows: DataFrame) -> DataFrame:
        each = rows.select("id", "blk", F.posexplode("marks").alias("at", "key")).join(counts, "key", "left")
        c = F.when(F.array_contains("near", F.col("blk")), -F.col("df")).otherwise(F.coalesce("df", F.lit(0)))
        gathered = each.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", c.alias("c")))), lambda x: x["c"]).alias("c"))
        return rows.join(gathered, "id", "left").select(*kept, F.coalesce("c", F.array().cast("array<int>")).alias("c"))

    return joined


def named_pairs(r: DataFrame, passes: tuple[str, ...] = ("tok",), how: Blocking = Blocking(), q: dict[str, Callable] | None = None, p: dict[str, Callable] | None = None) -> DataFrame:
    """The pairs of ``key_pairs(keys(r, passes))`` for the passes ``name`` and ``tok``, once each, without an exchange of pairs.

    Ids must be unique and known. Records bring their names to the join of the keys; a pair of several common keys is taken from the first
    that joins it, which the names tell. ``(qi, pi, nq, np, hay)`` with ``hay`` for ``np`` between spaces, a flag ``p_key_...`` for each pass, and ``q`` and ``p``: more columns of either
    side by name, made of the distinct words of its name and of their counts in the pool.
    """
    both_passes = "name" in passes and "tok" in passes
    r = r.select("id", "side", F.col("state_key").alias("blk"), "name_core")
    words, name = F.array_distinct(text.tokens(F.col("name_core"))), text.sorted_key(F.col("name_core"))
    marks = ([F.array(F.concat(F.lit("n|"), name))] if "name" in passes else []) + ([F.transform(words, lambda w: F.concat(F.lit("t|"), w))] if "tok" in passes else [])
    marked = r.withColumn("marks", F.concat(*marks))
    counted = _with_counts(marked, how)
    kept = lambda c: ((c > 0) & (c <= how.key_cap)) | (c < 0)
    # A key that joins anything begins with its kind; where only a block has few of it, the block stands behind it.
    entry = lambda kind, w, c: F.concat(F.lit(kind), w, F.when(c < 0, F.concat(F.lit("|"), "blk")).otherwise(F.lit("")))
    none = F.array().cast("array<string>")
    first = F.get("c", F.lit(0))
    by_name = F.when((F.length("name") >= 2) & kept(first), F.array(entry("n|", F.col("name"), first))).otherwise(none) if "name" in passes else none
    each = F.filter(F.zip_with("words", "wc", lambda w, c: F.struct(F.abs(c).alias("df"), w.alias("w"), c.alias("c"))), lambda z: (F.length(z["w"]) >= how.token_letters) & (z["df"] > 0))
    chosen = lambda z: F.filter(z, lambda e: kept(e["c"]))
    keys_of = lambda z: F.transform(z, lambda e: entry("t|", e["w"], e["c"]))

    def side(pool: bool) -> DataFrame:
        x = counted(marked.where("side > 0" if pool else "side = 0")).withColumn("words", words)
        if "name" in passes:
            x = x.withColumn("name", name)
        return x.withColumn("wc", F.slice("c", 2, F.size("words")) if both_passes else F.col("c"))

    made = lambda more: [f(F.col("words"), F.transform("wc", F.abs)).alias(k) for k, f in (more or {}).items()]
    hashed = [F.xxhash64("name").alias("hash")] if both_passes else []
    a, b = side(False), side(True)
    a = a.withColumn("z", chosen(F.slice(F.array_sort(each), 1, how.tokens)) if "tok" in passes else F.lit(None).cast("array<struct<df:int,w:string,c:int>>"))
    asks = F.concat(by_name, keys_of("z")) if "tok" in passes else by_name
    # What else joins the pair: f or n (anywhere, in the own block) and the word; the name is found by its hash.
    marks_of = F.transform("z", lambda e: F.concat(F.when(e["c"] < 0, F.lit("n")).otherwise(F.lit("f")), F.lit(" "), e["w"], F.lit(" "))) if "tok" in passes else none
    if "name" in passes:
        marks_of = F.concat(F.transform(by_name, lambda k: F.when(first < 0, F.lit("n=")).otherwise(F.lit("f="))), marks_of)
    a = a.select(F.col("id").alias("qi"), F.col("blk").alias("bq"), F.col("name_core").alias("nq"), *[h.alias("hq") for h in hashed], *made(q), F.posexplode_outer(asks).alias("at", "key"), marks_of.alias("m")).where("key IS NOT NULL")
    width = how.tokens * ("tok" in passes) + ("name" in passes)
    if both_passes:  # all are asked for flags
        a = a.select("*", *[F.get("m", F.lit(i)).alias(f"m{i}") for i in range(width)]).drop("m")
    else:
        a = a.select("*", *[F.when(F.col("at") > i, F.get("m", F.lit(i))).alias(f"m{i}") for i in range(width - 1)]).drop("m")
    has = F.concat(by_name, keys_of(chosen(each))) if "tok" in passes else by_name
    b = b.select(F.col("id").alias("pi"), F.col("blk").alias("bp"), F.concat(F.lit(" "), "name_core", F.lit(" ")).alias("hay"), *[h.alias("hp") for h in hashed], *made(p), F.explode_outer(has).alias("key")).where("key IS NOT NULL")
    tasks = max(4 * r.sparkSession.sparkContext.defaultParallelism, int(r.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    both = a.repartition(tasks, "key").join(b.repartition(tasks, "key"), "key")

    def hit(i: int) -> Column:
        """Whether the asking record's mark ``i`` joins the pair, too."""
        m = F.col(f"m{i}")
        known = F.contains("hay", F.substr(m, F.lit(2)))
        if both_passes:
            known = F.when(F.substr(m, F.lit(2)) == "=", (F.col("hq") == F.col("hp")) & (text.sorted_key(F.col("nq")) == text.sorted_key(F.col("hay")))).otherwise(known)
        return m.isNotNull() & (m.startswith("f") | (F.col("bq") == F.col("bp"))) & known

    for i in range(width - 1):
        both = both.where(~((F.col("at") > i) & F.coalesce(hit(i), F.lit(False))))
    flags = [(F.col("key").startswith("n|")).alias("p_key_name")] if "name" in passes else []  # a name's key comes first
    if "tok" in passes:
        tok = F.col("key").startswith("t|")
        for i in range(width if both_passes else 0):
            tok = tok | F.coalesce((F.substr(F.col(f"m{i}"), F.lit(2)) != "=") & hit(i), F.lit(False))
        flags.append(tok.alias("p_key_tok"))
    return both.select("qi", "pi", "nq", F.expr("substr(hay, 2, length(hay) - 2)").alias("np"), "hay", *flags, *(q or {}), *(p or {}))


def city_blocks(r: DataFrame, votes: int = 20, share: float = 0.8) -> DataFrame:
    """``(city_key, alt)``: the state that at least ``share`` of a city's entities (``votes`` or more with a known state) are in."""
    n = r.where("side = 0 AND city_key <> '' AND state_key <> ''").groupBy("city_key", "state_key").agg(F.count("*").alias("n"))
    total = n.groupBy("city_key").agg(F.sum("n").alias("all"), F.max_by("state_key", F.struct("n", "state_key")).alias("alt"), F.max("n").alias("most"))
    return total.where((F.col("all") >= votes) & (F.col("most") >= share * F.col("all"))).select("city_key", "alt")


def members(r: DataFrame, how: Blocking = Blocking(), city_alt: bool = True, more: tuple[str, ...] = ()) -> DataFrame:
    """``(blk, id, side, kind)`` and the columns ``more``: the blocks that records compare in.

    ``known``: a record's own state, and for the pool the state that its city votes for; ``far``: entities without a state
    against the whole pool; ``fallback``: pool records without one against all other entities.
    """
    known, unknown = F.col("state_key") != "", F.col("state_key") == ""
    put = lambda df, blk, kind: df.select(blk.alias("blk"), "id", "side", F.lit(kind).alias("kind"), *more)
    out = put(r.where(known), F.col("state_key"), "known")
    if city_alt:
        voted = r.where("side > 0").join(city_blocks(r, how.city_votes, how.city_share), "city_key").where("alt <> state_key")
        out = out.unionByName(put(voted, F.col("alt"), "known"))
    out = out.unionByName(put(r.where((F.col("side") > 0) | unknown), F.lit("<no state>"), "far"))
    return out.unionByName(put(r.where(((F.col("side") == 0) & known) | ((F.col("side") > 0) & unknown)), F.lit("<pool without state>"), "fallback"))


def _texts(field: str) -> Column:
    if field == "skel":
        return F.array_join(F.transform(text.tokens(F.col("name_core")), text.skeleton_key), " ")
    return F.col({"name": "name_core", "addr": "addr_norm"}[field])


def weights(r: DataFrame, fields: tuple[str, ...], how: Blocking = Blocking(), city_alt: bool = True) -> DataFrame:
    """``(field, blk, kind, id, side, gram, w, common)`` of trigrams, of unit length by field, block and record."""
    base = tuple(dict.fromkeys(f for x in fields for f in (("name", "addr") if x == "both" else (x,))))
    grams = None
    for f in base:
        x = r.select("id", F.lit(f).alias("field"), F.explode(text.grams(_texts(f))).alias("gram"))
        grams = x if grams is None else grams.unionByName(x)
    grams = grams.groupBy("id", "field", "gram").agg(F.count("*").alias("c"))
    m = members(r, how, city_alt)
    size = m.groupBy("blk").agg(F.count("*").alias("n"))
    placed = stored(m.join(grams, "id"))
    df = placed.groupBy("field", "blk", "gram").agg(F.count("*").alias("df"))
    x = placed.join(df, ["field", "blk", "gram"]).join(F.broadcast(size), "blk")
    x = x.withColumn("w", F.log1p("c") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1))
    length = x.groupBy("field", "blk", "id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return x.join(length, ["field", "blk", "id"]).select("field", "blk", "kind", "id", "side", "gram", (F.col("w") / F.when(F.col("norm") > 0, F.col("norm")).otherwise(1.0)).alias("w"), (F.col("df") > F.greatest(F.col("n") * 0.01, F.lit(200))).alias("common"))


def similar_pairs(w: DataFrame, field: str, how: Blocking = Blocking()) -> DataFrame:
    """``(pass, qi, pi, score, rank)`` of one field, both directions. ``both`` is the mean of the name's and the address's cosine.

    Common grams are left out on the asking side, which bounds the join; block by block the best of each asking record stay.
    """
    x = w.where(F.col("field").isin("name", "addr") if field == "both" else F.col("field") == field)
    scale = 0.5 if field == "both" else 1.0
    out = None
    for way, asks, k in (("fwd", F.col("side") == 0, how.forward.get(field, 0)), ("rev", F.col("side") > 0, how.reverse.get(field, 0))):
        if not k:
            continue
        a = x.where(asks & ~F.col("common")).select("field", "blk", "kind", "gram", F.col("id").alias("a"), F.col("w").alias("wa"))
        b = x.where(~asks).select("field", "blk", "gram", F.col("id").alias("b"), F.col("w").alias("wb"))
        s = a.join(b, ["field", "blk", "gram"]).groupBy("blk", "kind", "a", "b").agg(F.round(scale * F.sum(F.col("wa") * F.col("wb")), 6).alias("score")).where(F.col("score") >= how.least_score)
        most = F.when(F.col("kind") == "fallback", min(k, how.unknown_forward)).otherwise(k) if way == "fwd" else F.lit(k)
        s = s.withColumn("rank", F.row_number().over(Window.partitionBy("blk", "a").orderBy(F.desc("score"), "b"))).where(F.col("rank") <= max(k, 1)).where(F.col("rank") <= most)
        ends = (F.col("a").alias("qi"), F.col("b").alias("pi")) if way == "fwd" else (F.col("b").alias("qi"), F.col("a").alias("pi"))
        s = s.select(F.lit(f"{field}_{way}").alias("pass"), *ends, "score", "rank")
        out = s if out is None else out.unionByName(s)
    return out


def block_pairs(r: DataFrame, field: str, ways: tuple[str, ...] = ("fwd", "rev"), how: Blocking = Blocking(), city_alt: bool = True, at_hand: bool = False) -> DataFrame:
    """What ``similar_pairs`` gives, of records whose ids are their own: texts go to the tasks and matches of grams are never rows.

    Records are stored first unless they are ``at_hand``, read from a table.
    """
    xs = [_texts(f) for f in (("name", "addr") if field == "both" else (field,))]
    r = r.select("id", "side", "state_key", "city_key", *[x.alias(f"x{i}") for i, x in enumerate(xs)])
    r = r if at_hand else stored(r)
    m = members(r, how, city_alt, tuple(f"x{i}" for i in range(len(xs))))
    out = None
    for way in ways:
        k = (how.forward if way == "fwd" else how.reverse).get(field, 0)
        if not k:
            continue
        s = similarity.top_pairs(m, len(xs), way == "fwd", k, min(k, how.unknown_forward) if way == "fwd" else k, 1 / len(xs), how.least_score)
        ends = (F.col("a").alias("qi"), F.col("b").alias("pi")) if way == "fwd" else (F.col("b").alias("qi"), F.col("a").alias("pi"))
        s = s.select(F.lit(f"{field}_{way}").alias("pass"), *ends, "score", "rank")
        out = s if out is None else out.unionByName(s)
    return out


def field_pairs(r: DataFrame, how: Blocking = Blocking(), city_alt: bool = True) -> DataFrame | None:
    """``block_pairs`` of all fields and both directions, each stored when it is done, so that what it exchanged can go before the next is begun."""
    out = None
    for field, way in ((f, w) for f in how.fields for w in ("fwd", "rev")):
        s = block_pairs(r, field, (way,), how, city_alt, at_hand=True)
        if s is None:
            continue
        s = stored(s)
        # Files of an exchange are removed once the driver has collected what refers to it.
        r.sparkSession.sparkContext._jvm.System.gc()
        out = s if out is None else out.unionByName(s)
    return out


def union(keyed: DataFrame, scored: DataFrame | None, passes: tuple[str, ...] = KEY_PASSES, fields: tuple[str, ...] = TFIDF_FIELDS) -> DataFrame:
    """One row for each pair: a flag for each key pass, best score and ranks for each field, n_passes, p_key_hit and the hand-made prio.

    Pairs are exchanged once, by their entity and with their pass as a number, so that what comes after finds an entity's pairs together. They may repeat.
    """
    names = F.array(*map(F.lit, [*passes, *[f"{f}_{way}" for f in fields for way in ("fwd", "rev")]]))
    code = (F.array_position(names, F.col("pass")) - 1).cast("byte").alias("code")
    rows = keyed.select(code, "qi", "pi", F.lit(None).cast("double").alias("score"), F.lit(None).cast("int").alias("rank"))
    rows = rows if scored is None else rows.unionByName(scored.select(code, "qi", "pi", "score", "rank"))
    spark = rows.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.repartition(tasks, "qi")
    at = lambda f, way: len(passes) + 2 * fields.index(f) + (way == "rev")
    of = lambda c, *codes: F.when(F.col("code").isin(*codes), F.col(c))
    found = [x for f in fields for x in (F.max(of("score", at(f, "fwd"), at(f, "rev"))).alias(f"p_{f}_score"), F.min(of("rank", at(f, "fwd"))).alias(f"p_{f}_rank"), F.min(of("rank", at(f, "rev"))).alias(f"p_{f}_rrank"))]
    u = rows.groupBy("qi", "pi").agg(F.bit_or(F.expr("shiftleft(1, code)")).alias("mask"), *found)
    flags = [(F.col("mask").bitwiseAND(F.lit(1 << i)) != 0).alias(f"p_key_{k}") for i, k in enumerate(passes)]
    u = u.select("qi", "pi", *flags, *[f"p_{f}_{c}" for f in fields for c in ("score", "rank", "rrank")], F.bit_count("mask").alias("n_passes"))
    return u.withColumn("p_key_hit", sum((F.col(f"p_key_{k}").cast("int") for k in passes), F.lit(0))).withColumn("prio", hand_priority(fields))


def hand_priority(fields: tuple[str, ...] = TFIDF_FIELDS) -> Column:
    """Key hits first, then the best cosine, a first rank anywhere, and the number of passes."""
    best = F.greatest(F.lit(0.0), *[F.coalesce(f"p_{f}_score", F.lit(0.0)) for f in fields], F.lit(0.0))
    first = F.coalesce(F.least(F.lit(99), *[F.coalesce(c, F.lit(99)) for f in fields for c in (f"p_{f}_rank", f"p_{f}_rrank")], F.lit(99)) == 1, F.lit(False))
    return F.round(0.35 * F.col("p_key_hit") + best + 0.2 * first.cast("int") + 0.02 * F.col("n_passes"), 6)


def hit(*passes: str) -> Column:
    """Whether any of the passes made the pair: key passes by name, TF-IDF fields by theirs."""
    out = F.lit(False)
    for p in passes:
        out = out | (F.col(f"p_key_{p}") if p in KEY_PASSES else F.col(f"p_{p}_score").isNotNull())
    return out


def reserve_hits() -> Column:
    return sum((F.col(f"p_key_{k}").cast("int") for k in STREET_PASSES), F.lit(0))


def generate(r: DataFrame, how: Blocking = Blocking(), passes: tuple[str, ...] = KEY_PASSES, city_alt: bool = True, own_ids: bool = False) -> DataFrame:
    """``(s1, cand, passes, scores, ranks, n_passes, p_key_hit, prio)``: all candidates, capped for each entity, with a reserve of the street passes'.

    With ``own_ids``, each record has an id of its own, and matches of grams are added up in the tasks.
    """
    r = stored(spread(r, "id"))  # read by every pass
    keyed = key_pairs(keys(r, passes, how), how, once=False)
    scored = None
    if how.fields and own_ids:
        scored = field_pairs(r, how, city_alt)
    elif how.fields:
        w = stored(weights(r, how.fields, how, city_alt))
        for f in how.fields:
            s = similar_pairs(w, f, how)
            scored = s if scored is None else scored.unionByName(s)
    u = union(keyed, scored, passes, how.fields).withColumnsRenamed({"qi": "s1", "pi": "cand"})
    if how.cap is None:
        return u
    return candidates.capped(u, how.cap, reserve_hits() if set(STREET_PASSES) <= set(passes) else None, how.reserve)


def priority_features(u: DataFrame, passes: tuple[str, ...] = KEY_PASSES, fields: tuple[str, ...] = TFIDF_FIELDS) -> DataFrame:
    """What a learned priority looks at: flags, scores and ranks with neutral values, each score against the list's best, the rank by prio, and the list's size."""
    mine, order = Window.partitionBy("s1"), Window.partitionBy("s1").orderBy(F.desc("prio"), "cand")
    out = {f"f_{k}": F.col(f"p_key_{k}").cast("double") for k in passes}
    for f in fields:
        score = F.coalesce(f"p_{f}_score", F.lit(0.0))
        out |= {f"f_{f}": score, f"f_{f}_rel": score - F.max(score).over(mine), f"f_{f}_rank": F.coalesce(F.col(f"p_{f}_rank").cast("double"), F.lit(99.0)), f"f_{f}_rrank": F.coalesce(F.col(f"p_{f}_rrank").cast("double"), F.lit(99.0))}
    out |= {"f_hits": F.col("p_key_hit").cast("double"), "f_passes": F.col("n_passes").cast("double"), "f_prio": F.col("prio"), "f_prio_rank": F.row_number().over(order).cast("double"), "f_n": F.count("*").over(mine).cast("double")}
    return u.select("*", *[v.alias(k) for k, v in out.items()])


def recall(u: DataFrame, truth: DataFrame, universe: DataFrame) -> DataFrame:
    """One row: pair recall, share of entities with all their links among the candidates, candidates for each entity (mean, median, 95th percentile), and the macro F of an oracle that picks all true candidates."""
    found = truth.select("s1", F.col("mid").alias("cand")).distinct().join(u.select("s1", "cand").distinct().withColumn("hit", F.lit(1)), ["s1", "cand"], "left")
    per = found.groupBy("s1").agg(F.count("*").alias("k"), F.count("hit").alias("h"))
    size = u.groupBy("s1").agg(F.count("*").alias("c"))
    x = universe.select("s1").distinct().join(per, "s1", "left").join(size, "s1", "left").na.fill(0, ["k", "h", "c"])
    f = F.when(F.col("k") == 0, 1.0).when(F.col("h") == 0, 0.0).otherwise(1.25 * F.col("h") / (0.25 * F.col("k") + F.col("h")))
    return x.agg(
        (F.sum("h") / F.sum("k")).alias("pair_recall"), F.avg((F.col("h") == F.col("k")).cast("double")).alias("full_recall"), F.avg("c").alias("mean_candidates"), F.percentile("c", F.lit(0.5)).alias("p50_candidates"),
        F.percentile("c", F.lit(0.95)).alias("p95_candidates"), F.avg(f).alias("oracle_f"), F.sum("c").alias("pairs"),
    )
