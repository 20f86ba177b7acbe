"""From raw bill files to filtered, numbered chunks: parse, deduplicate documents, deduplicate sections, chunk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources import xml
from . import chunking, dedup

META = ("bill_id", "congress", "type", "number", "short_title", "version", "status", "format")
SECTIONS = "array<struct<enum: string, header: string, body_text: string, sub_texts: array<string>>>"


def load(joined: DataFrame) -> DataFrame:
    """Parsed documents from sidecars joined to their content; malformed XML and documents without text are dropped.

    HTML tags become nothing and references stay; bytes that are not UTF-8 are replaced.
    """
    is_xml = F.col("format") == "xml"
    keyed = joined.withColumn("doc_key", F.sha2(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in META)), 256))
    parsed = xml.parsed(keyed.where(is_xml), "doc_key", "content").where("ok").select("doc_key", "full_text", "sections")
    a = keyed.where(is_xml).join(parsed, "doc_key")
    a = a.select(*META, "full_text", "sections")
    raw = F.decode("content", "UTF-8")
    text = F.when(F.col("format") == "html", T.tags_removed(raw)).otherwise(raw)
    b = keyed.where(~is_xml).withColumn("_t", text)
    sections = F.transform(chunking.numbered_sections(F.col("_t")), lambda s: F.struct(s["enum"].alias("enum"), s["header"].alias("header"), s["body_text"].alias("body_text"), F.array().cast("array<string>").alias("sub_texts")))
    b = b.select(*META, T.clean_text(F.col("_t")).alias("full_text"), sections.alias("sections"))
    out = a.unionByName(b).where("full_text <> ''")
    return out.withColumn("document_text_hash", T.text_hash(F.col("full_text")))


def _key(*more):
    return T.alias_key(F.col("version"), F.col("bill_id"), *(more or (F.lit(""), F.lit(""))))


def canonical_documents(docs: DataFrame) -> DataFrame:
    """The first document of each text by alias order, with its sections and the number of duplicates."""
    rest = [c for c in docs.columns if c != "document_text_hash"]
    out = docs.groupBy("document_text_hash").agg(F.min_by(F.struct(*rest), _key()).alias("d"), (F.count("*") - 1).alias("n_duplicates"))
    return out.select("document_text_hash", "d.*", "n_duplicates").withColumn("canonical_bill_id", F.col("bill_id"))


def document_aliases(docs: DataFrame) -> DataFrame:
    """(document_text_hash, alias fields): one row per bill of each text, the alias list as a table."""
    return dedup.first_per_key(docs.select("document_text_hash", *META), ["document_text_hash", "bill_id"], _key())


def sections(documents: DataFrame, aliases: DataFrame) -> DataFrame:
    """(section_text_hash, section and alias fields): sections x aliases of canonical documents, once per bill and place."""
    rows = documents.select("document_text_hash", F.explode("sections").alias("s")).where("s.body_text <> ''")
    rows = rows.select(
        "document_text_hash", T.text_hash(F.col("s.body_text")).alias("section_text_hash"), F.regexp_replace("s.enum", r"\.+$", "").alias("section_enum"),
        F.col("s.header").alias("section_header"), F.col("s.body_text").alias("section_body"), F.col("s.sub_texts").alias("sub_texts"),
    )
    return rows.join(aliases, "document_text_hash")


def canonical_sections(rows: DataFrame) -> DataFrame:
    """The first section of each text by alias order, with the number of documents that hold it."""
    key = _key(F.col("section_enum"), F.col("section_header"))
    rest = [c for c in rows.columns if c != "section_text_hash"]
    docs = rows.select("section_text_hash", "document_text_hash").distinct().groupBy("section_text_hash").agg(F.count("*").alias("n_documents"))
    first = rows.groupBy("section_text_hash").agg(F.min_by(F.struct(*rest), F.struct(key.alias("k"), F.col("document_text_hash").alias("h"))).alias("s"))
    return first.select("section_text_hash", "s.*").join(docs, "section_text_hash")


def chunks(canonical: DataFrame, most: int = 512, overlap: int = 64, tail: str = "clean", tokenizer: str | None = None) -> DataFrame:
    """One row per chunk, with its source hash."""
    prefix = T.chunk_prefix(F.col("type"), F.col("number"), F.col("congress"), F.col("section_enum"), F.col("section_header"))
    rows = canonical.withColumn("c", F.explode(chunking.section_chunk_udf(most, overlap, tail, tokenizer)(prefix, F.col("section_body"), F.col("sub_texts"))))
    out = rows.select(
        "bill_id", F.col("bill_id").alias("canonical_bill_id"), "congress", "type", "number", "short_title", "version", "status", "section_enum", "section_header",
        "c.chunk_index", "c.text", "c.tokens", "document_text_hash", "section_text_hash",
    )
    return out


def with_source_hash(rows: DataFrame, include_text: bool = False) -> DataFrame:
    """``include_text`` also hashes the text, so that other chunk sizes give other hashes."""
    parts = [F.coalesce("canonical_bill_id", "bill_id"), F.col("document_text_hash"), F.col("section_text_hash"), F.col("chunk_index")]
    return rows.withColumn("source_hash", T.source_hash(*parts, *([F.col("text")] if include_text else [])))


def process(joined: DataFrame, most: int = 512, overlap: int = 64, min_tokens: int = 30, cap: int = 200, tail: str = "clean", tokenizer: str | None = None) -> DataFrame:
    """The whole chunk stage of one or more congresses; deduplication spans all rows that are given."""
    docs = load(joined)
    rows = chunks(canonical_sections(sections(canonical_documents(docs), document_aliases(docs))), most, overlap, tail, tokenizer)
    section = ["section_text_hash", "section_enum", "section_header"]
    kept = chunking.capped(chunking.at_least(rows, min_tokens), "canonical_bill_id", section, cap)
    return with_source_hash(chunking.renumbered(kept, "canonical_bill_id", section))
