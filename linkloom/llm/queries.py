"""The thin queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkloom.llm import chat, line_dedup, lm, packing, pieces, quality, simhash, substring, toxicity, vafile


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_vocabulary() -> str:
    """The word vocabulary's file, where the box has it."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def piece_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = vafile.integers(table(spark, sf_dir, "embeddings"))
    return vafile.top_k(vectors.where("vec_id % 50 = 0"), vectors)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.rounded(table(spark, sf_dir, "documents"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), word_vocabulary())


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(table(spark, sf_dir, "documents"), piece_vocabulary())


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.read_back(chat.expand(chat.with_extra(table(spark, sf_dir, "conversations"))))


QUERIES = {f.__name__: f for f in (op1_exact_top_k, op2_lm_scoring, op3_simhash_near_dedup, op4_packing, op5_substring_dedup, op6_line_dedup, op7_sentencepiece, op8_quality_rules, op9_toxicity, op10_chat_formatting)}
ORACLES: dict[str, str] = {"op1_exact_top_k": vafile.SQL, "op2_lm_scoring": lm.SQL, "op6_line_dedup": line_dedup.REPORT_SQL, "op10_chat_formatting": chat.SQL}
