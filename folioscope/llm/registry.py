"""Queries of the training-data operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, decontam, html, langid, mixing, neardup, pii, quality, tokens, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repetition_quality(_table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.read_token_files(tokens.write_token_files(_table(spark, sf_dir, "documents"), tokens.default_tokenizer()))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = "SELECT -7L conv_id, n turn, role, '</s>[INST] ok [/INST]' text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(n, role)"
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(spark.sql(extra))
    return chat.read_back(chat.format_conversations(rows))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_table(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(_table(spark, sf_dir, "pages"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archives(warc.write_archives(_table(spark, sf_dir, "pages")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_decontamination,
        op3_mixing,
        op4_token_output,
        op5_language_id,
        op6_chat_formatting,
        op7_pii,
        op8_near_dedup,
        op9_html_extraction,
        op10_warc,
    )
}
SQL: dict[str, str] = {
    "op2_decontamination": decontam.SQL,
    "op3_mixing": mixing.SQL,
    "op6_chat_formatting": chat.SQL,
    "op8_near_dedup": neardup.SQL,
    "op10_warc": warc.SQL,
}
