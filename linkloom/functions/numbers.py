"""How two house numbers relate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Leading figures that are compared place by place, and those that are compared as a value.
PLACES, VALUE = 16, 12
# Names of the classes, by the size of the difference (up to the number given).
SUBSTITUTED = ((2, "subst_d1_2"), (9, "subst_d3_9"), (99, "subst_d10_99"), (None, "subst_d100plus"))
APART = ((2, "diff_1_2"), (10, "diff_3_10"), (100, "diff_11_100"), (None, "diff_100plus"))


def figures(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def changed_places(a: Column, b: Column) -> Column:
    """Of the first PLACES characters, those that differ."""
    letters = lambda c: F.split(F.substring(c, 1, PLACES), "")
    return F.size(F.filter(F.zip_with(letters(a), letters(b), lambda x, y: ~x.eqNullSafe(y)), lambda x: x))


def _band(size: Column, bands: tuple) -> Column:
    name = F.lit(bands[-1][1])
    for most, label in reversed(bands[:-1]):
        name = F.when(size <= most, label).otherwise(name)
    return name


def _named(a: Column, b: Column, p: Column, q: Column) -> Column:
    """The class of the numbers ``a`` and ``b`` with figures ``p`` and ``q``; the first that applies."""
    apart = F.abs(F.substring(p, 1, VALUE).try_cast("long") - F.substring(q, 1, VALUE).try_cast("long"))
    shorter, longer = F.when(F.length(p) < F.length(q), p).otherwise(q), F.when(F.length(p) < F.length(q), q).otherwise(p)
    swap = (F.length(p) == F.length(q)) & (changed_places(p, q) == 1)
    return F.coalesce(
        F.when((a == "") | (b == ""), F.when(a == b, "none").otherwise("one_missing")),
        F.when(a == b, "exact"),
        F.when((p == "") | (q == ""), "other"),
        F.when(p == q, "letter_change"),
        F.when((F.length(p) != F.length(q)) & F.contains(longer, shorter), F.when(shorter == q, "digit_dropped").otherwise("digit_added")),
        F.when(swap, F.when(apart.isin(6, 8), "subst_d6_8").otherwise(_band(apart, SUBSTITUTED))),
        _band(apart, APART),
    )


def number_relation(a: Column, b: Column) -> Column:
    """The class of the relation of two numbers; null is no number. The figures are cut out once, bound by a one-row array."""
    a, b = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    bound = F.array(F.struct(a.alias("a"), b.alias("b"), figures(a).alias("p"), figures(b).alias("q")))
    return F.get(F.transform(bound, lambda x: _named(x["a"], x["b"], x["p"], x["q"])), F.lit(0))


def related(df: DataFrame, a: Column, b: Column, to: str = "hn_rel") -> DataFrame:
    """``df`` with ``to``, the class of the relation: the figures are columns of an inner select, and all stays in generated code."""
    x = df.withColumns({"__a": F.coalesce(a, F.lit("")), "__b": F.coalesce(b, F.lit(""))})
    x = x.withColumns({"__p": figures(F.col("__a")), "__q": figures(F.col("__b"))})
    return x.withColumn(to, _named(F.col("__a"), F.col("__b"), F.col("__p"), F.col("__q"))).drop("__a", "__b", "__p", "__q")


def seven_classes(a: Column, b: Column) -> Column:
    """Another split: missing, equal, substitution, transposition, insert_delete, offset (10 at most), other."""
    p, q = (F.regexp_replace(figures(F.coalesce(c, F.lit(""))), "^0+(?=.)", "") for c in (a, b))
    edits, same_length = F.levenshtein(p, q), F.length(p) == F.length(q)
    # Two changed neighbours that stand the other way round.
    at = F.array_position(F.zip_with(F.split(p, ""), F.split(q, ""), lambda x, y: ~x.eqNullSafe(y)), True).cast("int")
    turned = F.concat(F.substring(p, F.lit(1), at - 1), F.reverse(F.substring(p, at, F.lit(2))), F.substr(p, at + 2))
    apart = F.abs(F.substring(p, 1, VALUE).try_cast("long") - F.substring(q, 1, VALUE).try_cast("long"))
    return (
        F.when((p == "") | (q == ""), "missing").when(p == q, "equal").when(same_length & (edits == 1), "substitution").when(same_length & (turned == q), "transposition")
        .when(~same_length & (edits == 1), "insert_delete").when(apart <= 10, "offset").otherwise("other")
    )
