"""Scalar text functions as Column expressions, inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rewrites of the phonetic key, in order (fixed values). Capital C and S stand for "ch" and "sh" meanwhile.
PHONETIC = (
    ("ch", "C"), ("sh", "S"), ("ph", "f"), ("w", "v"), ("q", "k"), ("x", "ks"), ("z", "j"),
    ("c(?=[eiy])", "s"), ("ck", "k"), ("c", "k"), ("([kgtdpbj])h", "$1"), ("C", "c"), ("S", "s"), ("y", "i"), (r"(.)\1+", "$1"),
)


def phonetic_key(c: Column) -> Column:
    for pattern, to in PHONETIC:
        c = F.regexp_replace(c, pattern, to)
    return c


def skeleton_key(c: Column) -> Column:
    """The phonetic key without vowels behind its first letter."""
    key = phonetic_key(c)
    return F.concat(F.substring(key, 1, 1), F.regexp_replace(F.substr(key, F.lit(2)), "[aeiou]", ""))


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda x: x != "")


def sorted_key(c: Column) -> Column:
    """Sorted distinct tokens, joined by a space: the same for any order of the words."""
    return F.array_join(F.array_sort(F.array_distinct(tokens(c))), " ")


def without_repeats(a: Column) -> Column:
    """Tokens that differ from the one before."""
    return F.filter(a, lambda x, i: (i == 0) | (x != F.get(a, i - 1)))


def initials(c: Column) -> Column:
    return F.array_join(F.transform(tokens(c), lambda x: F.substring(x, 1, 1)), "")


def unquoted(c: Column) -> Column:
    """A field that is one well-formed quoted token, unwrapped; any other as it is."""
    return F.when(c.rlike('^"([^"]|"")*"$'), F.replace(F.substr(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c)


def grams(c: Column, n: int = 3) -> Column:
    """Character n-grams of the words, each padded by a space on both sides, repeats included."""
    def of(w: Column) -> Column:
        padded = F.concat(F.lit(" "), w, F.lit(" "))
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - n + 1, F.lit(1))), lambda i: F.substr(padded, i, F.lit(n)))

    return F.flatten(F.transform(tokens(c), of))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 if both are empty."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))), F.lit(0.0))


def levenshtein_similarity(a: Column, b: Column) -> Column:
    return F.coalesce(1 - F.try_divide(F.levenshtein(a, b), F.greatest(F.length(a), F.length(b))), F.lit(1.0))
