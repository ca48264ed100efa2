"""Cross-site boilerplate lines, by the number of distinct sites that carry them. DataFrame functions only.

Each line hash gets a HyperLogLog sketch of its sites; sketches merge in the aggregation. Lines whose estimate is near
the threshold get exact distinct counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm._stash import fresh, named, stash

#: A line on so many sites is boilerplate.
SITES = 10
#: Estimates this close to the threshold, as a share, are counted exactly; six times a sketch's standard error.
NEAR = 0.1
#: log2 of a sketch's registers.
LG_K = 12
#: Names of the counts that are added.
COUNTS = ("__lines", "__removed")


def _lines(docs: DataFrame, text_col: str, site_col: str) -> DataFrame:
    """``(line, site)`` hashes of every line with a word; a null site is a site of its own."""
    line = F.explode(F.array_distinct(F.split(F.col(named(text_col)), "\n"))).alias("line")
    site = F.xxhash64(F.coalesce(F.concat(F.lit("s"), F.col(named(site_col)).cast("string")), F.lit("n"))).alias("site")
    return docs.select(line, site).where("line RLIKE '[^\\\\x20\\\\x09-\\\\x0D]'").select(F.xxhash64("line").alias("line"), "site")


def widespread(docs: DataFrame, text_col: str = "text", site_col: str = "source", sites: int = SITES) -> DataFrame:
    """``(line)``: hashes of the lines on at least ``sites`` distinct sites."""
    lines = _lines(docs, text_col, site_col)
    sketches = lines.groupBy("line").agg(F.hll_sketch_agg("site", LG_K).alias("sketch"))
    estimates = stash(sketches.select("line", F.hll_sketch_estimate("sketch").alias("n")).where(F.col("n") >= F.floor(F.lit(sites * (1 - NEAR)))))
    sure = estimates.where(F.col("n") > sites * (1 + NEAR)).select("line")
    near = estimates.where(F.col("n") <= sites * (1 + NEAR)).select("line")
    pairs = lines.join(near, "line", "left_semi").distinct()
    exact = pairs.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") >= sites).select("line")
    return sure.unionByName(exact)


def remove_boilerplate(docs: DataFrame, text_col: str = "text", site_col: str = "source", sites: int = SITES, spare_repeated: float | None = None) -> DataFrame:
    """The rows of ``docs`` with widespread lines cut out of the text, and ``__lines``, ``__removed`` counts.

    Lines are what lies between newlines, compared as they are; lines without a word are never removed. Every document
    loses every widespread line, whatever their share. ``spare_repeated`` (off by default): a text that occurs more than
    once, and of whose characters (in lines with a word) more than that share is widespread, stays as it is, for
    near-duplicate removal to judge. Null texts stay null with 0 lines; empty texts have 0 lines with a word; a very long
    text is one row's array of lines, and its hits are the set of its different widespread lines; every row is judged by
    its text, so repeated rows and null ids fare alike; a null site counts as one site; an empty table gives no rows;
    other columns pass through.
    """
    KEY, WIDE, ALONE, LINES, REMOVED = fresh(docs, "__key", "__wide", "__alone", *COUNTS)
    text = F.col(named(text_col))
    wide = stash(widespread(docs, text_col, site_col, sites))
    key = F.xxhash64(text)
    lines = docs.select(key.alias(KEY), F.explode(F.array_distinct(F.split(text, "\n"))).alias("line")).select(KEY, F.xxhash64("line").alias("line")).distinct()
    hit = lines.join(wide, "line").groupBy(KEY).agg(F.collect_set("line").alias(WIDE))
    if spare_repeated is not None:
        alone = docs.groupBy(key.alias(KEY)).agg((F.count("*") == 1).alias(ALONE))
        hit = hit.join(alone, KEY)
    else:
        hit = hit.withColumn(ALONE, F.lit(True))
    hit = stash(hit)
    size = hit.select(F.sum(F.size(WIDE) * 8 + 32)).first()[0] or 0
    joined = docs.join(F.broadcast(hit) if size <= 32 << 20 else hit, key == F.col(KEY), "left")
    parts = F.coalesce(F.split(text, "\n"), F.array().cast("array<string>"))
    worded = lambda x: x.rlike(r"[^\x20\x09-\x0D]")
    gone = lambda x: F.array_contains(F.col(WIDE), F.xxhash64(x)) & worded(x)
    chars = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + F.length(x))
    worded_lines, cut = F.filter(parts, worded), F.filter(parts, gone)
    few = F.coalesce(F.col(WIDE).isNotNull() & (F.col(ALONE) | (chars(cut) <= chars(worded_lines) * (spare_repeated or 0.0))), F.lit(False))
    left = F.when(few, F.array_join(F.filter(parts, lambda x: ~gone(x)), "\n")).otherwise(text)
    columns = [left.alias(c) if c == text_col else F.col(named(c)) for c in docs.columns]
    return joined.select(*columns, F.size(worded_lines).cast("long").alias(LINES), F.when(few, F.size(cut)).otherwise(0).cast("long").alias(REMOVED))


def report(docs: DataFrame, sites: int = SITES) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_chars and kept_sha256 of what is left, for each row."""
    out = remove_boilerplate(docs.select("doc_id", "text", "source"), sites=sites)
    text = F.coalesce("text", F.lit(""))
    return out.select("doc_id", F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"), F.length(text).cast("long").alias("kept_chars"), F.sha2(F.encode(text, "UTF-8"), 256).alias("kept_sha256"))


REPORT_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, coalesce('s' || source, 'n') AS site FROM documents),
p AS (SELECT rid, site, string_split(text, chr(10)) AS lines FROM d),
l AS (SELECT rid, site, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM p),
w AS (SELECT *, regexp_matches(line, '[^\\x20\\x09-\\x0D]') AS worded FROM l),
wide AS (SELECT line FROM w WHERE worded GROUP BY line HAVING count(DISTINCT site) >= {SITES}),
m AS (SELECT w.*, wide.line IS NOT NULL AS hit FROM w LEFT JOIN wide ON w.line = wide.line AND worded),
s AS (
  SELECT rid, count(*) FILTER (WHERE worded) AS n_lines, count(*) FILTER (WHERE hit) AS n_wide,
    coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT hit), '') AS rest
  FROM m GROUP BY rid),
f AS (SELECT doc_id, n_lines, n_wide, CASE WHEN n_wide > 0 THEN rest ELSE text END AS text FROM d JOIN s USING (rid))
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_wide AS BIGINT) AS n_removed, CAST(length(text) AS BIGINT) AS kept_chars, sha256(text) AS kept_sha256 FROM f
"""
