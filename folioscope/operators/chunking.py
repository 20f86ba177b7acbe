"""Sections and chunks: sliding windows, section packing, filters, caps and numbering."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.batches import small_batches, trim


def estimated_tokens(words: int) -> int:
    return max(1, int(words / 1.3))


def paragraphs(df: DataFrame, text: str, least: int = 1) -> DataFrame:
    """Lines as sections: position, cleaned body, and the hash of the body alone."""
    rows = df.select("*", F.posexplode(F.split(text, "\n")).alias("section_enum", "_line"))
    # a line that has a word is not empty when cleaned; the test is cheap to push down, cleaning twice is not
    rows = rows.where(F.col("_line").rlike(T.WORD)).withColumn("body_text", T.clean_text(F.col("_line")))
    rows = rows.where(F.length("body_text") >= least) if least > 1 else rows
    return rows.withColumn("section_text_hash", F.sha2(F.lower("body_text"), 256)).drop("_line")


def numbered_sections(text: Column) -> Column:
    r"""array<struct<enum, header, body_text>> of a text cut at lines ``SECTION 1.`` or ``SEC. 2A.``.

    What stands before the first such line is dropped, as are boilerplate headers and empty bodies. Without any such
    line the whole text is one section, if it has 50 characters.
    """
    head = r"(?iU)(?:^|\n)" + T.SPACE + r"*(?:SECTION|SEC\.?)" + T.SPACE + r"+([0-9]+[A-Za-z]?)\." + T.SPACE + r"*([^\n]*)(?=\n)"
    bodies = F.slice(F.split(text, head), 2, 1 << 30)
    enums, headers = (F.regexp_extract_all(text, F.lit(head), k) for k in (1, 2))
    found = F.transform(
        F.arrays_zip(enums.alias("e"), headers.alias("h"), bodies.alias("b")),
        lambda s: F.struct(s["e"].alias("enum"), T.clean_text(s["h"]).alias("header"), T.clean_text(s["b"]).alias("body_text")),
    )
    found = F.filter(found, lambda s: ~F.regexp_replace(F.lower(s["header"]), r"\.+$", "").isin(*T.BOILERPLATE) & (s["body_text"] != ""))
    whole = T.clean_text(text)
    single = F.array(F.struct(F.lit("").alias("enum"), F.lit("").alias("header"), whole.alias("body_text")))
    return F.when(F.size(enums) > 0, found).when(F.length(whole) >= 50, single).otherwise(F.slice(single, 1, 0))


def sliding_windows(text: Column, most: int, overlap: int, tail: str = "clean", with_text: bool = True) -> Column:
    """array<struct<start, n, text>>: windows of ``most`` words, each ``overlap`` behind the last; a text that fits is one.

    ``clean`` stops at the window that reaches the end; ``parity`` goes on one word at a time from ``overlap`` words
    before the end. Native, no Python.
    """

    def cut(w: Column) -> Column:
        n = F.size(w)
        step = most - overlap
        last = F.greatest(F.lit(0), F.ceil((n - most) / F.lit(float(step))).cast("int"))
        starts = F.transform(F.sequence(F.lit(0), last), lambda i: i * step)
        if tail == "parity":
            first = F.greatest(n - overlap, last * step + 1)
            more = F.when((n > most) & (first < n), F.sequence(first, n - 1)).otherwise(F.array().cast("array<int>"))
            starts = F.concat(starts, more)
        size = lambda s: F.least(n - s, F.lit(most)).alias("n")
        if not with_text:
            return F.transform(starts, lambda s: F.struct(s.alias("start"), size(s)))
        return F.transform(starts, lambda s: F.struct(s.alias("start"), size(s), F.array_join(F.slice(w, s + 1, F.lit(most)), " ").alias("text")))

    # the words are bound as a lambda variable, so that they are split once and not once a window
    return F.transform(F.array(T.words(F.coalesce(text, F.lit("")))), cut)[0]


class Words:
    """Units of windows without a tokenizer: words, joined by one space; a text's tokens are estimated from them."""

    encode = staticmethod(str.split)
    decode = staticmethod(" ".join)

    def count(self, text: str) -> int:
        return estimated_tokens(len(text.split()))


class Library:
    """Units of windows by a tokenizers file: its token ids, without added ones."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)

    def encode(self, text: str) -> list[int]:
        return self._library.encode(text, add_special_tokens=False).ids

    def decode(self, ids: list[int]) -> str:
        return self._library.decode(ids, skip_special_tokens=False)

    def count(self, text: str) -> int:
        return max(1, len(self.encode(text)))


_CODECS: dict[str, Words | Library] = {"": Words()}


def codec(path: str | None = None) -> Words | Library:
    """The units for a tokenizer's file, loaded once per worker; words where there is none."""
    if (path or "") not in _CODECS:
        _CODECS[path] = Library(path)
    return _CODECS[path or ""]


def _to_sentence(part: list, units: Words | Library) -> tuple[str, int]:
    """The text of some units, cut after the last full stop of its second half if there is one, and how many units it has."""
    text = units.decode(part)
    stop = text.rfind(". ")
    if stop <= len(text) // 2:
        return text, len(part)
    return text[: stop + 1], max(1, len(units.encode(text[: stop + 1])))


def sentence_windows(text: str, most: int, overlap: int, tail: str = "clean", units: Words | Library = _CODECS[""]) -> list[tuple[int, str]]:
    """(start, text) of windows of at most ``most`` units, cut back to the end of a sentence where one ends late enough."""
    all_units = units.encode(text)
    if len(all_units) <= most:
        return [(0, text)]
    out, at = [], 0
    while at < len(all_units):
        part = all_units[at : at + most]
        piece, n = _to_sentence(part, units) if at + most < len(all_units) else (units.decode(part), len(part))
        out.append((at, piece.strip()))
        if tail == "clean" and at + n >= len(all_units):
            return out
        at += max(1, n - overlap)
    return out


def _sentence_batches(batches: Iterator[pa.RecordBatch], most: int, overlap: int, tail: str, names: list[str], held: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Batches (key, chunk_index, text) of about ``held`` characters; a longer single text is a batch of its own."""
    for batch in batches:
        ids, index, texts, size = [], [], [], 0
        kind, last = batch.schema.field(0).type, batch.num_rows - 1
        for i, (k, t) in enumerate(zip(batch.column(0), batch.column(1))):
            pieces = [p for _, p in sentence_windows(t.as_py() or "", most, overlap, tail)]
            ids += [k.as_py()] * len(pieces)
            index += range(len(pieces))
            texts += pieces
            size += sum(map(len, pieces))
            if size >= held or i == last:
                yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(index, pa.int32()), pa.array(texts, pa.string())], names=names)
                ids, index, texts, size = [], [], [], 0
        trim()


def sentence_chunks(df: DataFrame, key: str, text: str, most: int, overlap: int, tail: str = "clean") -> DataFrame:
    """Rows (key, chunk_index, text) of ``sentence_windows``: where a window ends decides where the next begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sentence_batches(batches, most, overlap, tail, [key, "chunk_index", "text"])

    small_batches(df.sparkSession)
    kind = dict(df.dtypes)[key]
    return df.select(key, text).mapInArrow(run, f"{key} {kind}, chunk_index int, text string")


def section_chunks(
    prefix: str, body: str, sub_texts: list[str], most: int, overlap: int, tail: str = "clean", keep_lead: bool = False, units: Words | Library = _CODECS[""]
) -> list[tuple[str, int]]:
    """(text, tokens) of one section: whole if it fits; else its subsections packed; else sliding windows.

    The first piece carries the prefix; later pieces of a sliding split do not. ``keep_lead`` also packs the text
    before the first subsection, which the reference loses.
    """
    count = units.count
    if not body:
        return []
    whole = f"{prefix} {body}"
    if count(whole) <= most:
        return [(whole, count(whole))]
    pieces = list(sub_texts)
    if pieces and keep_lead and (at := body.find(pieces[0])) > 0:
        pieces.insert(0, body[:at].strip())
    if not pieces:
        return [(p.strip(), count(p)) for _, p in sentence_windows(whole, most, overlap, tail, units)]
    out, now = [], prefix
    for piece in pieces:
        longer = f"{now} {piece}"
        if now != prefix and count(longer) > most:
            out.append((now.strip(), count(now)))
            now = f"{prefix} {piece}"
        else:
            now = longer
        if count(now) > most:
            out += [(p.strip(), count(p)) for _, p in sentence_windows(now, most, overlap, tail, units)]
            now = prefix
    if now != prefix:
        out.append((now.strip(), count(now)))
    return out


SECTION_CHUNK = "array<struct<chunk_index: int, text: string, tokens: int>>"


def token_count_udf(tokenizer: str):
    """Tokens of a text by a tokenizers file, at least 1, over Arrow batches; ``T.token_count`` estimates them natively."""

    @F.pandas_udf("int")
    def count(texts: pd.Series) -> pd.Series:
        units = codec(tokenizer)
        return pd.Series([units.count(t or "") for t in texts], dtype="int32")

    return count


def section_chunk_udf(most: int, overlap: int, tail: str = "clean", tokenizer: str | None = None):
    """``section_chunks`` of (prefix, body, sub_texts) columns over Arrow batches; tokens by a tokenizer's file, or estimated.

    Batches are bounded, and results are built as Arrow columns, without an object per piece or a copy in pandas.
    """
    if (spark := SparkSession.getActiveSession()) is not None:
        small_batches(spark)

    @F.arrow_udf(SECTION_CHUNK)
    def chunks(prefix: pa.Array, body: pa.Array, subs: pa.Array) -> pa.Array:
        units = codec(tokenizer)
        ends, index, texts, tokens = [0], [], [], []
        for p, b, s in zip(prefix, body, subs):
            found = section_chunks(p.as_py(), b.as_py() or "", s.as_py() or [], most, overlap, tail, units=units)
            index += range(len(found))
            texts += [t for t, _ in found]
            tokens += [n for _, n in found]
            ends.append(len(texts))
        pieces = pa.StructArray.from_arrays([pa.array(index, pa.int32()), pa.array(texts, pa.string()), pa.array(tokens, pa.int32())], ["chunk_index", "text", "tokens"])
        out = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pieces)
        del index, texts, tokens, pieces
        trim()
        return out

    return chunks


def window_udf(overlap: int):
    """The texts of ``sentence_windows`` of (text, most) columns, as an array; null for a null text."""

    @F.arrow_udf("array<string>")
    def windows(text: pa.Array, most: pa.Array) -> pa.Array:
        pieces = [t if t is None else [p for _, p in sentence_windows(t, m, min(overlap, m - 1))] for t, m in zip(text.to_pylist(), most.to_pylist())]
        out = pa.array(pieces, pa.list_(pa.string()))
        del pieces
        trim()
        return out

    return windows


def vote_chunks(votes: DataFrame, most: int, overlap: int) -> DataFrame:
    """One row per chunk of a vote's text; every piece of a long one gets the prefix again.

    Texts are made natively; only the narratives that do not fit pass through Python, which returns their windows. The
    vote's columns stay outside: they are repeated row by row where pieces are exploded, or not at all if unused.
    """
    small_batches(votes.sparkSession)
    v = votes.withColumn("_prefix", T.vote_prefix(F.col("vote_id"), F.col("chamber"), F.col("date"), F.col("category"), F.col("type")))
    v = v.withColumn("_narrative", T.vote_narrative(F.col("question"), F.col("subject"), F.col("result"), F.col("bill_id")))
    v = v.withColumn("_text", T.vote_text(F.col("_prefix"), F.col("_narrative")))
    v = v.withColumn("_room", F.greatest(F.lit(1), F.lit(most - 8) - T.token_count(F.col("_prefix"))))
    v = v.withColumn("_long", (T.token_count(F.col("_text")) > most) & (F.col("_narrative") != ""))
    v = v.withColumn("_pieces", window_udf(overlap)(F.when(F.col("_long"), F.col("_narrative")), F.col("_room")))
    v = v.withColumn("_pieces", F.coalesce("_pieces", F.array("_text")))
    # no array is empty; without outer, Spark infers a filter on their size and makes all pieces a second time for it
    out = v.select(*votes.columns, "_prefix", "_long", F.posexplode_outer("_pieces").alias("chunk_index", "_piece"))
    out = out.withColumn("text", F.when(F.col("_long"), T.vote_text(F.col("_prefix"), F.col("_piece"))).otherwise(F.col("_piece")))
    out = out.select(*votes.columns, "chunk_index", "text")
    # the texts are clean already, so only lower case is left of normalising
    out = out.withColumn("token_count", T.token_count(F.col("text"))).withColumn("content_hash", F.sha2(F.lower("text"), 256))
    return out.withColumn("source_hash", T.source_hash(F.col("vote_id"), F.col("chunk_index"), F.col("content_hash")))


def best_per_section(chunks: DataFrame, keys: list[str], index: str = "chunk_index") -> DataFrame:
    """The chunk of each section with most tokens, the first of equals."""
    rest = [c for c in chunks.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(-F.col("tokens"), F.col(index)))
    return chunks.groupBy(*keys).agg(best.alias("_b")).select(*keys, *(F.col(f"_b.{c}").alias(c) for c in rest))


def capped(chunks: DataFrame, bill: str, section: list[str], cap: int, index: str = "chunk_index") -> DataFrame:
    """At most ``cap`` chunks a bill: each section's best first, then the others by tokens. 0: no cap.

    The window by bill has narrow rows; Spark keeps only ``cap`` rows a bill on the map side (window group limit).
    """
    if cap <= 0:
        return chunks
    best = F.row_number().over(Window.partitionBy(bill, *section).orderBy(F.desc("tokens"), index)) == 1
    place = F.row_number().over(Window.partitionBy(bill).orderBy(F.col("_best").desc(), F.desc("tokens"), *section, index))
    return chunks.withColumn("_best", best).withColumn("_place", place).where(F.col("_place") <= cap).drop("_best", "_place")


def renumbered(chunks: DataFrame, bill: str, section: list[str], index: str = "chunk_index") -> DataFrame:
    """Indexes 0, 1, ... within each section of a bill; the old one is kept as original_chunk_index."""
    new = (F.row_number().over(Window.partitionBy(bill, *section).orderBy(index)) - 1).cast("int")
    return chunks.withColumn("original_chunk_index", F.col(index)).withColumn(index, new)


def at_least(chunks: DataFrame, tokens: int = 30) -> DataFrame:
    return chunks.where(F.col("tokens") >= tokens)
