"""Projections between chunk records, stored rows and search hits; table checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T


def chunk_rows(chunks: DataFrame, model: str, include_aliases: bool = False) -> DataFrame:
    """Stored bill rows: nulls become empty text, counts and indexes integers; aliases only on demand."""
    t = lambda c: T.text_value(F.col(c)).alias(c)
    out = [
        "source_hash", t("bill_id"), T.text_value(F.coalesce("canonical_bill_id", "bill_id")).alias("canonical_bill_id"), T.safe_int(F.col("congress")).alias("congress"),
        T.text_value(F.col("type")).alias("bill_type"), T.text_value(F.col("number")).alias("bill_number"), F.lit("section").alias("chunk_type"),
        T.section_path(F.col("section_enum"), F.col("section_header")).alias("section_path"), T.text_value(F.col("short_title")).alias("title"), T.text_value(F.col("text")).alias("body"),
        T.safe_int(F.col("tokens")).alias("token_count"), T.text_value(F.col("version")).alias("source_version"), t("status"), t("section_enum"), t("section_header"),
        T.safe_int(F.col("chunk_index")).alias("chunk_index"), T.safe_int(F.col("original_chunk_index")).alias("original_chunk_index"), t("document_text_hash"), t("section_text_hash"),
    ]
    if include_aliases:
        out += [c for c in ("document_text_hashes", "document_aliases", "section_aliases") if c in chunks.columns]
    if "embedding" in chunks.columns:
        out += ["embedding", F.lit(model).alias("model")]
    return chunks.select(*out)


def vote_rows(chunks: DataFrame, model: str) -> DataFrame:
    """Stored vote rows: text else body, token_count else tokens, an empty bill_id as null."""
    have = set(chunks.columns)
    pick = lambda *names: F.coalesce(*(F.col(n) for n in names if n in have), F.lit(None))
    names = ("vote_id", "chamber", "session", "category", "type", "question", "subject", "result")
    out = [
        F.coalesce("source_hash", T.source_hash(F.col("vote_id"), F.col("chunk_index"), F.col("content_hash"))).alias("source_hash"), *(T.text_value(F.col(n)).alias(n) for n in names),
        T.safe_int(F.col("congress")).alias("congress"), T.safe_int(F.col("number")).alias("number"), T.parsed_timestamp(F.col("date")).alias("vote_date"),
        F.nullif(T.text_value(F.col("bill_id")), F.lit("")).alias("bill_id"), T.text_value(pick("text", "body")).alias("body"), T.safe_int(pick("token_count", "tokens")).alias("token_count"),
        T.safe_int(F.col("chunk_index")).alias("chunk_index"), "content_hash",
    ]
    return chunks.select(*out, *(["embedding", F.lit(model).alias("model")] if "embedding" in have else []))


def inline_rows(chunks: DataFrame, model: str) -> DataFrame:
    """Rows of the second table version, with the embedding in the row and bill_uid as entity."""
    return chunks.select(
        "source_hash", F.coalesce("canonical_bill_id", "bill_id").alias("bill_uid"), "congress", F.col("type").alias("bill_type"), F.col("number").alias("bill_number"), F.lit("section").alias("chunk_type"),
        "chunk_index", F.col("short_title").alias("title"), "status", "section_enum", "section_header", F.col("text").alias("body"), F.col("tokens").alias("token_count"), "embedding",
        F.lit(model).alias("embedding_model"),
    )


HIT = {
    "source_kind": "", "bill_id": "", "vote_id": "", "title": "", "status": "", "section_enum": "", "section_header": "", "chamber": "", "session": "", "vote_date": "", "type": "", "category": "",
    "question": "", "subject": "", "result": "", "body": "",
}


def hits(rows: DataFrame, kind: str) -> DataFrame:
    """One shape for hits of bills and votes: missing or null texts are empty."""
    have = set(rows.columns)
    value = lambda n: F.lit(kind) if n == "source_kind" else T.text_value(F.col(n)) if n in have else F.lit(HIT[n])
    return rows.select(F.col("similarity").cast("double").alias("similarity"), (T.safe_int(F.col("congress")) if "congress" in have else F.lit(0)).alias("congress"), *(value(n).alias(n) for n in HIT))


def request_map(pending: DataFrame, order: list[str], per_file: int, model: str, dimensions: int) -> DataFrame:
    """Numbered embedding requests: custom_id, file, identity of the chunk, and the request body as JSON."""
    from . import folds

    numbered = folds.number_within(pending.withColumn("_all", F.lit(1)), ["_all"], order).drop("_all")
    ident = T.chunk_identity(F.col("source_hash"), F.col("document_text_hash"), F.col("section_text_hash"), F.col("chunk_index"), F.col("bill_id"), F.col("section_enum"))
    body = F.to_json(F.struct(F.lit(model).alias("model"), F.col("text").alias("input"), F.lit(dimensions).alias("dimensions")))
    return numbered.select(
        F.concat(F.lit("chunk-"), F.lpad(F.col("rn").cast("string"), 9, "0")).alias("custom_id"), (F.floor((F.col("rn") - 1) / per_file) + 1).cast("int").alias("file"), ident.alias("identity"), body.alias("body")
    )


def merge_results(chunks: DataFrame, requests: DataFrame, results: DataFrame) -> DataFrame:
    """Chunks with the embeddings of a batch job, by custom_id and identity; unmatched results are ignored."""
    ident = T.chunk_identity(F.col("source_hash"), F.col("document_text_hash"), F.col("section_text_hash"), F.col("chunk_index"), F.col("bill_id"), F.col("section_enum"))
    found = results.join(requests.select("custom_id", "identity"), "custom_id").select("identity", "embedding")
    return chunks.withColumn("identity", ident).join(found, "identity", "left").drop("identity")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def require_columns(df: DataFrame, schema: str) -> None:
    """Refuses a table that lacks a column of the schema or has it with another type."""
    want = dict(df.sparkSession.createDataFrame([], schema).dtypes)
    have = dict(df.dtypes)
    wrong = {c: (t, have.get(c)) for c, t in want.items() if have.get(c) != t}
    if wrong:
        raise ValueError(f"the table does not fit: {wrong}")


def audit_event(spark: SparkSession, run_id: str, status: str, **fields) -> DataFrame:
    """One appended row of the run audit; the state of a run is its latest row."""
    schema = "run_id string, status string, model string, dimensions int, counts map<string, bigint>, shard_checksums map<string, string>, error string"
    names = ("model", "dimensions", "counts", "shard_checksums", "error")
    row = (run_id, status, *(fields.get(n) for n in names))
    return spark.createDataFrame([row], schema).withColumn("at", F.current_timestamp())


def superseded(audit: DataFrame, run_id: str) -> DataFrame:
    """Rows to append so that runs still marked running, other than this one, count as aborted."""
    from .state import latest

    now = latest(audit, "run_id", ["at"], ["status"])
    return now.where((F.col("status") == "running") & (F.col("run_id") != run_id)).select("run_id", F.lit("aborted").alias("status"), F.current_timestamp().alias("at"))
