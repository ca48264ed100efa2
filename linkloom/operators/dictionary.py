"""A dictionary of native words in Latin letters, learned from linked names, and its use."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions import scripts, text
from linkloom.functions.fuzzy import jaro_winkler
from linkloom.session import stored

#: Words that are broadcast, at most.
HELD = 200_000
#: The text in runs of native letters and of anything else.
PARTS = "[ऀ-ൿ‌‍]+|[^ऀ-ൿ‌‍]+"
WORD = re.compile("[0-9a-zऀ-ൿ‌‍]+")


@lru_cache(1 << 16)
def phonetic(word: str) -> str:
    """``functions.text.phonetic_key`` of one word."""
    for pattern, to in text.PHONETIC:
        word = re.sub(pattern, to.replace("$1", r"\1"), word)
    return word


@lru_cache(1 << 16)
def _sound(native: str) -> str:
    return phonetic(re.sub("[^a-z0-9]", "", scripts.latin_word(native)))


_alike = lru_cache(1 << 17)(jaro_winkler)


def aligned(native: list[str], latin: list[str], least: float) -> list[str | None]:
    """For each native word in turn, the unused Latin word that sounds most alike, if at least ``least``; ties to the first."""
    keys = {x: phonetic(x) for x in latin}
    free, out = list(keys), []
    for word in native:
        sound = _sound(word)
        same = next((x for x in free if keys[x] == sound), None) if sound and least <= 1 else None
        if same is not None:  # nothing sounds more alike
            free.remove(same)
            out.append(same)
            continue
        scored = [_alike(sound, keys[x]) for x in free]
        best = max(scored, default=0.0)
        out.append(free.pop(scored.index(best)) if best >= least and best > 0 else None)
    return out


def _words(latin: str | None, native: str | None, least: float) -> tuple[list[str], list[str], list[str | None]]:
    n = [scripts.INVISIBLE.sub("", w) for w in WORD.findall(unicodedata.normalize("NFC", native or "").lower()) if scripts.INDIC.search(w)]
    x = re.findall("[0-9a-z]+", scripts.folded(latin or ""))
    return n, x, aligned(n, x, least) if x else [None] * len(n)


def learn(pairs: DataFrame, min_support: int = 2, min_share: float = 0.4, least: float = 0.55) -> DataFrame:
    """``(native, latin, support, share)`` from linked names ``(latin, native)``.

    Each native word votes for the Latin word that sounds alike; without one, for the word it shares most pairs with (Dice),
    if that stands in the pair. A word keeps its most voted Latin form with enough votes in enough of its pairs. Ties go
    to the smaller word. Pairs without native or without Latin words, and null names, say nothing.

    Words are taken from the names once. Only words are exchanged, and all counts combine before the exchange, so a very common word is one row of each task.
    """
    schema = "native array<string>, latin array<string>, match array<string>"

    def words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = pa.list_(pa.string())
        for b in batches:
            rows = [r for r in (_words(x, y, least) for x, y in zip(b.column("latin").to_pylist(), b.column("native").to_pylist(), strict=True)) if r[0] and r[1]]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], strings) for k in range(3)], names=["native", "latin", "match"])

    w = stored(pairs.select("latin", "native").mapInArrow(words, schema))
    of_native = w.select(F.explode(F.array_distinct("native")).alias("t")).groupBy("t").agg(F.count("*").alias("n"))
    of_latin = w.select(F.explode(F.array_distinct("latin")).alias("x")).groupBy("x").agg(F.count("*").alias("m"))
    # Only native words that some pair leaves without a Latin word need the words they share pairs with.
    left = stored(w.where(F.exists("match", lambda x: x.isNull())).select(F.explode(F.arrays_zip("native", "match")).alias("z")).where("z.match IS NULL").select(F.col("z.native").alias("t")).distinct())
    left = F.broadcast(left) if left.count() <= HELD else left
    both = w.select(F.explode(F.array_distinct("native")).alias("t"), "latin").join(left, "t", "left_semi").select("t", F.explode(F.array_distinct("latin")).alias("x")).groupBy("t", "x").agg(F.count("*").alias("c"))
    dice = both.join(of_native, "t").join(of_latin, "x").groupBy("t").agg(F.min_by("x", F.struct(-2 * F.col("c") / (F.col("n") + F.col("m")), "x")).alias("dice"))
    each = w.select(F.explode(F.arrays_zip("native", "match")).alias("z"), "latin").select(F.col("z.native").alias("t"), F.col("z.match").alias("x"), "latin")
    found = each.where("x IS NOT NULL").groupBy("t", "x").agg(F.count("*").alias("c"))
    missed = each.where("x IS NULL").select("t", F.explode(F.array_distinct("latin")).alias("x")).groupBy("t", "x").agg(F.count("*").alias("c"))
    missed = missed.join(dice, "t").where("x = dice").select("t", "x", "c")
    votes = found.unionByName(missed).groupBy("t", "x").agg(F.sum("c").alias("c"))
    best = votes.groupBy("t").agg(F.min_by(F.struct("x", "c"), F.struct(-F.col("c"), "x")).alias("b"))
    share = F.least(F.lit(1.0), F.col("b.c") / F.col("n"))
    return best.join(of_native, "t").where((F.col("b.c") >= min_support) & (share >= min_share)).select(F.col("t").alias("native"), F.col("b.x").alias("latin"), F.col("b.c").alias("support"), F.round(share, 3).alias("share"))


def native_words(texts: DataFrame, column: str) -> DataFrame:
    """``(native, n)``: the distinct runs of native letters, with how often they stand there."""
    nfc = scripts._each(lambda x: unicodedata.normalize("NFC", x) if x else "", F.col(column))
    runs = F.regexp_extract_all(nfc, F.lit("[ऀ-ൿ‌‍]+"), F.lit(0))
    return texts.select(F.explode(runs).alias("r")).select(F.regexp_replace("r", "[​‌‍­﻿]", "").alias("native")).where("native <> ''").groupBy("native").agg(F.count("*").alias("n"))


def transliterate(texts: DataFrame, column: str, dictionary: DataFrame, to: str = "latin") -> DataFrame:
    """``texts`` with ``to``: known native words by the dictionary, others by rule, each distinct text once.

    Words meet the dictionary in a join, so it may be of any size. Null is empty.
    """
    whole = texts.select(F.col(column).alias("__x")).distinct().select("__x", scripts._each(lambda x: unicodedata.normalize("NFC", x) if x else "", F.col("__x")).alias("__t"))
    parts = whole.where(F.col("__t").rlike("[ऀ-ൿ]")).select("__x", F.posexplode(F.regexp_extract_all("__t", F.lit(PARTS), F.lit(0))).alias("at", "p"))
    parts = parts.withColumn("w", F.when(F.col("p").rlike("^[ऀ-ൿ‌‍]"), F.regexp_replace("p", "[​‌‍­﻿]", "")))
    known = dictionary.select(F.col("native").alias("w"), F.col("latin").alias("__l"))
    named = parts.join(known, "w", "left").withColumn("o", F.coalesce("__l", F.when(F.col("w").isNotNull(), scripts._each(lambda x: scripts.latin_word(x) if x else "", F.col("w"))).otherwise(F.col("p"))))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "o"))), lambda s: s["o"]), " ")
    done = named.groupBy("__x").agg(F.trim(F.regexp_replace(joined, r"\s+", " ")).alias("__r"))
    return texts.join(done, texts[column] == done["__x"], "left").select(*[texts[c] for c in texts.columns], F.coalesce("__r", texts[column], F.lit("")).alias(to))


def snapped(words: DataFrame, vocabulary: DataFrame, min_count: int = 500, least: float = 0.7) -> DataFrame:
    """``(word, snapped)`` for distinct ``word``: the frequent word ``(token, n)`` that sounds most alike, else itself.

    Both sides meet by first letter (all vowels are one) and a length at most three apart, so the join is of blocks; the
    similarity must exceed ``least``. Ties go to the smaller word.
    """
    block = lambda k: F.when(F.substring(k, 1, 1).rlike("[aeiou]"), F.lit("a")).otherwise(F.substring(k, 1, 1))
    w = words.select("word").distinct().withColumn("k", text.phonetic_key(F.col("word"))).withColumn("len", F.explode(F.sequence(F.length("k") - 3, F.length("k") + 3))).withColumn("b", block(F.col("k")))
    v = vocabulary.where((F.col("n") >= min_count) & F.col("token").rlike("^[a-z]+$")).select("token", text.phonetic_key(F.col("token")).alias("vk")).withColumn("len", F.length("vk")).withColumn("b", block(F.col("vk")))
    near = w.join(v, ["b", "len"]).withColumn("s", text.levenshtein_similarity(F.col("k"), F.col("vk"))).where(F.col("s") > least)
    best = near.groupBy("word").agg(F.min_by("token", F.struct(-F.col("s"), "token")).alias("t"))
    return words.select("word").distinct().join(best, "word", "left").select("word", F.coalesce("t", "word").alias("snapped"))


def coverage(texts: DataFrame, column: str, dictionary: DataFrame) -> DataFrame:
    """One row: distinct native words and their occurrences, how many of each the dictionary knows, and the shares."""
    w = native_words(texts, column).join(dictionary.select("native", F.lit(1).alias("k")), "native", "left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    x = w.agg(F.count("*").alias("types"), total(F.col("k")).alias("known_types"), total(F.col("n")).alias("words"), total(F.col("n") * F.col("k")).alias("known_words"))
    return x.withColumn("type_share", F.coalesce(F.try_divide("known_types", "types"), F.lit(0.0))).withColumn("word_share", F.coalesce(F.try_divide("known_words", "words"), F.lit(0.0)))
