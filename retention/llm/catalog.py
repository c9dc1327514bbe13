"""Registered queries of this package: each operator over its whole table with production
parameters. ``ORACLE`` has DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retention.llm import bpe_fst, chat, ctph, line_dedup, mixing, packing, phrases, prefix_trie, quality_mcd, recurrent_lm, simhash, token_counts, warc
from retention.llm.common import table


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


#: A conversation whose texts hold the template's own marks, added to the table by ``op1_chat_format``.
MARKED = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    marked = spark.createDataFrame(MARKED, "conv_id bigint, turn bigint, role string, text string")
    return chat.chat_digests(table(spark, sf_dir, "conversations").select(*columns).unionByName(marked))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.score_documents(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"), _pattern())


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mcd.quality_rows(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_fst.bpe_round_trip(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.tiktoken"), _pattern())


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctph.edited_fingerprints(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_chat_format, op2_lm_score, op3_token_counts, op4_quality_rules, op5_simhash, op6_best_fit_packing, op7_warc, op8_bpe_round_trip, op9_fingerprints, op10_line_dedup,
    op11_phrase_collocations, op12_prefix_trie, op13_source_mixing,
)}

ORACLE: dict[str, str] = {
    "op1_chat_format": chat.ORACLE_SQL,
    "op7_warc": warc.ORACLE_SQL,
    "op11_phrase_collocations": phrases.ORACLE_SQL,
    "op12_prefix_trie": prefix_trie.ORACLE_SQL,
    "op13_source_mixing": mixing.ORACLE_SQL,
}
