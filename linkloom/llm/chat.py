"""Chat formatting by prefix-target expansion. DataFrame functions only.

Every assistant turn becomes an example: all turns before it as context, and only its own text under the loss mask. What
follows the last assistant turn (or a conversation without any) makes one more example without loss, so that nothing
is lost. A turn is written ``<s>role[INST]text</s>``; in roles and texts ``\\``, ``<`` and ``[`` are written ``\\e``,
``\\l`` and ``\\b``, so no control string can arise from a text, and every text comes back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<s>", "[INST]", "</s>"
#: Fixed values of the contract: conversation -7.
EXTRA = "SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)"


def escape(c: Column) -> Column:
    for raw, safe in (("\\", "\\e"), ("<", "\\l"), ("[", "\\b")):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def unescape(c: Column) -> Column:
    for raw, safe in (("[", "\\b"), ("<", "\\l"), ("\\", "\\e")):
        c = F.replace(c, F.lit(safe), F.lit(raw))
    return c


def expand(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` rows to examples: conv_id, target (from 0), n_turns, formatted, loss_start, loss_length.

    ``loss_start`` counts code points of ``formatted`` from 0. Turns stand in the order of turn, role, text, null first;
    repeated turns each count; null texts and roles are empty; a null conv_id is one conversation; other columns are not
    read; an empty table gives no examples. A conversation is one record here; its examples are as long as its prefixes.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = turns.select("conv_id", F.struct("turn", role.alias("role"), text.alias("text")).alias("t"))
    conv = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    written = F.transform("turns", lambda t: F.concat(F.lit(OPEN), escape(t["role"]), F.lit(MIDDLE), escape(t["text"]), F.lit(CLOSE)))
    conv = conv.select("conv_id", F.transform("turns", lambda t: t["role"] == "assistant").alias("answers"), F.transform("turns", lambda t: F.length(escape(t["text"]))).alias("sizes"), written.alias("written"))
    last = F.size("answers") - 1
    targets = F.filter(F.sequence(F.lit(0), last), lambda i: F.get("answers", i) | (i == last))
    each = conv.select("*", F.explode(targets).alias("target"))
    formatted = F.array_join(F.slice("written", 1, F.col("target") + 1), "")
    answer = F.get("answers", F.col("target"))
    length = F.when(answer, F.get("sizes", F.col("target"))).otherwise(0)
    return each.select("conv_id", "target", (F.col("target") + 1).alias("n_turns"), formatted.alias("formatted"), length.alias("loss_length")).withColumn(
        "loss_start", F.when(F.col("loss_length") > 0, F.length("formatted") - len(CLOSE) - F.col("loss_length")).otherwise(0)
    )


def read_back(examples: DataFrame) -> DataFrame:
    """What the examples of each conversation hold, taken from their formatted text and mask alone."""
    loss = unescape(F.substr("formatted", F.col("loss_start") + 1, F.col("loss_length")))
    by = examples.groupBy("conv_id").agg(
        F.max_by("formatted", "target").alias("whole"),
        F.array_sort(F.collect_list(F.struct("target", loss.alias("text")))).alias("losses"),
        F.sum(F.length("formatted")).cast("long").alias("formatted_chars"),
    )
    parts = F.filter(F.split("whole", CLOSE), lambda x: x != "")
    split = F.transform(parts, lambda x: F.struct(unescape(F.split_part(F.substr(x, F.lit(len(OPEN) + 1)), F.lit(MIDDLE), F.lit(1))).alias("role"), unescape(F.split_part(x, F.lit(MIDDLE), F.lit(2))).alias("text")))
    turns = F.array_join(F.transform(split, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    lost = F.array_join(F.transform("losses", lambda t: t["text"]), "")
    return by.select(
        "conv_id",
        F.size(parts).cast("long").alias("n_turns"),
        F.sha2(F.encode(turns, "UTF-8"), 256).alias("turns_sha256"),
        F.length(lost).cast("long").alias("loss_chars"),
        F.sha2(F.encode(lost, "UTF-8"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def with_extra(turns: DataFrame) -> DataFrame:
    return turns.select("conv_id", "turn", "role", "text").unionByName(turns.sparkSession.sql(EXTRA))


SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
s AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n, count(*) OVER (PARTITION BY conv_id) AS n_turns,
    13 + length(role) + length(text)
      + (length(role || text) - length(replace(replace(replace(role || text, '\', ''), '<', ''), '[', ''))) AS size
  FROM t),
c AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY n) AS upto FROM s)
SELECT conv_id, CAST(max(n_turns) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (WHERE role = 'assistant' OR n = n_turns) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
