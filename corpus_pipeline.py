"""From documents to token files: language ID, near-dedup, decontamination, mixing, token output.

Each stage takes all that its predecessor kept, as Parquet, and its decisions take effect; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioscope.llm import decontam, langid, mixing, neardup, scan, tokens


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language can't be told: null and empty texts, texts without a letter, and ties of the two best
    languages. Judged row by row; with no labelled text at all, every document goes."""
    return langid.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the least doc_id.

    Texts without words are no copies and stay; rows without doc_id take part under an id made from their text; of equal
    rows of one doc_id one stays.
    """
    return neardup.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark: a full window of 13 words, or hits on 5 % of their words.

    Null, empty and wordless texts stay; each row is judged by itself; an empty benchmark drops nothing.
    """
    return decontam.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and samples documents so that the sources near their target weights.

    A null source is a source of its own; texts without words are not taken; repeated rows are taken or left together.
    """
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes token files and returns one row per document, read back from them.

    Null text: the end id alone. A null doc_id comes first and stays null; copies of a document follow one another.
    """
    return tokens.read_token_files(tokens.write_token_files(docs, tokens.default_tokenizer()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("token_output", token_output),
]

#: SQL can't express cross-parsing or the tokenizer; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to ``documents``."""
    folder = scan.shared_dir(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
