"""Named queries over the provided tables, each with the SQL that an independent engine answers the same with.

Roles: documents are bills (lang ranks stand in for versions, source for the congress), their lines are sections,
embeddings are chunks of the bill ``label``, orders and customers are votes and bills, events are run states.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vectors as V
from ..operators import chunking, dedup, embedding, evaluation, folds, packing, rows, search, state
from ..sources import files, xml
from ..streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
LANG_RANKS = {"en": 0, "de": 1, "fr": 2, "es": 3}

# --- SQL fragments
_S = T.SQL_SPACE


def _clean(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace({x}, '{_S}+', ' ', 'g'), ' ([.,;:)])', '\1', 'g'))"


def _collapsed(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_S}+', ' ', 'g'))"


def _hash(x: str) -> str:
    return f"sha256(lower({_clean(x)}))"


def _words(x: str) -> str:
    return f"regexp_extract_all({x}, '{T.SQL_WORD}')"


_TOKENS = "greatest(1, trunc(len({w}) / 1.3))"
_RANK = "CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 WHEN 'fr' THEN 2 WHEN 'es' THEN 3 ELSE 99 END"
_SIM = "list_cosine_similarity(e.embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0))"
_SECTIONS = f"""lines AS (
  SELECT doc_id, lang, source, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS section_enum FROM documents WHERE text IS NOT NULL
), sections AS (
  SELECT doc_id, lang, source, section_enum::INT AS section_enum, {_clean('line')} AS body_text, {_hash('line')} AS section_text_hash FROM lines WHERE len({_clean('line')}) >= 1
)"""


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents")


def _doc_key(*more: str):
    return F.struct(T.ranked(F.col("lang"), LANG_RANKS).alias("r"), F.col("lang").alias("l"), F.col("doc_id").alias("d"), *(F.col(m) for m in more))


# --- text


@query(f"SELECT doc_id, {_clean('text')} AS text_clean FROM documents")
def text_clean(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.clean_text(F.col("text")).alias("text_clean"))


@query(f"SELECT doc_id, {_hash('text')} AS norm_hash FROM documents")
def text_norm_hash(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.text_hash(F.col("text")).alias("norm_hash"))


@query(f"SELECT doc_id, CASE WHEN len(c) <= 400 THEN c ELSE rtrim(left(c, 397)) || '...' END AS snippet FROM (SELECT doc_id, {_collapsed('text')} AS c FROM documents)")
def text_snippet(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.snippet(F.col("text"), 400).alias("snippet"))


@query(f"SELECT doc_id, len(w)::BIGINT AS n_words, {_TOKENS.format(w='w')}::BIGINT AS tokens FROM (SELECT doc_id, {_words('text')} AS w FROM documents)")
def token_count_fallback(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.word_count(F.col("text")).cast("bigint").alias("n_words"), T.token_count(F.col("text")).cast("bigint").alias("tokens"))


@query(f"SELECT source, min(t)::BIGINT AS tokens_min, (sum(t) // count(*))::BIGINT AS tokens_avg, max(t)::BIGINT AS tokens_max, sum(t)::BIGINT AS tokens_sum FROM (SELECT source, {_TOKENS.format(w=_words('text'))}::BIGINT AS t FROM documents) GROUP BY source")
def token_stats(spark, sf_dir):
    t = _docs(spark, sf_dir).select("source", T.token_count(F.col("text")).cast("bigint").alias("t"))
    return t.groupBy("source").agg(F.min("t").alias("tokens_min"), F.expr("sum(t) div count(*)").alias("tokens_avg"), F.max("t").alias("tokens_max"), F.sum("t").alias("tokens_sum"))


@query("SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS text FROM pages")
def html_strip_empty(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", T.tags_removed(F.col("html")).alias("text"))


@query(f"SELECT page_id, {_collapsed(chr(114) + 'egexp_replace(html, ' + chr(39) + '<[^>]+>' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ', ' + chr(39) + 'g' + chr(39) + ')')} AS text FROM pages")
def html_strip_space(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", T.tags_spaced(F.col("html")).alias("text"))


@query("SELECT page_id, contains(left(html, 2048), 'Page Not Found') OR contains(left(html, 2048), 'page you requested cannot be found') OR contains(left(html, 2048), 'govinfo.gov/error') AS is_error FROM pages")
def soft404_flag(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", T.is_error_page(F.col("html")).alias("is_error"))


# --- exact deduplication


def _hashed(spark, sf_dir) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", "lang", "source", T.text_hash(F.col("text")).alias("document_text_hash"))


@query(f"SELECT document_text_hash, arg_min(doc_id, k) AS canonical_doc_id, arg_min(source, k) AS canonical_source, count(*)::BIGINT AS n_members, (count(*) - 1)::BIGINT AS n_duplicates FROM (SELECT *, {_hash('text')} AS document_text_hash, ({_RANK}, lang, doc_id) AS k FROM documents) GROUP BY 1")
def doc_dedup_canonical(spark, sf_dir):
    return dedup.canonical(_hashed(spark, sf_dir), ["document_text_hash"], _doc_key(), ["doc_id", "source"])


@query(f"SELECT document_text_hash, source, doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY document_text_hash, source ORDER BY {_RANK}, lang, doc_id) AS rn FROM (SELECT *, {_hash('text')} AS document_text_hash FROM documents)) WHERE rn = 1")
def doc_alias_first(spark, sf_dir):
    return dedup.first_per_key(_hashed(spark, sf_dir), ["document_text_hash", "source"], _doc_key()).select("document_text_hash", "source", "doc_id", "lang")


@query(f"""WITH h AS (SELECT doc_id, lang, source, {_hash('text')} AS document_text_hash, {_RANK} AS r FROM documents),
c AS (SELECT document_text_hash, arg_min(doc_id, (r, lang, doc_id)) AS canonical_doc_id, count(*)::BIGINT AS n_members FROM h GROUP BY 1 HAVING count(*) > 1)
SELECT document_text_hash, doc_id, lang, source, canonical_doc_id, n_members FROM h JOIN c USING (document_text_hash)""")
def doc_alias_list(spark, sf_dir):
    return dedup.aliases(_hashed(spark, sf_dir), ["document_text_hash"], _doc_key(), ["doc_id"])


def _sections(spark, sf_dir) -> DataFrame:
    return chunking.paragraphs(_docs(spark, sf_dir).select("doc_id", "lang", "source", "text"), "text").drop("text")


@query(f"WITH {_SECTIONS} SELECT * FROM sections")
def section_explode(spark, sf_dir):
    return _sections(spark, sf_dir)


@query(f"WITH {_SECTIONS} SELECT section_text_hash, arg_min(doc_id, k) AS canonical_doc_id, arg_min(section_enum, k) AS canonical_section_enum, count(*)::BIGINT AS n_members, (count(*) - 1)::BIGINT AS n_duplicates FROM (SELECT *, ({_RANK}, lang, doc_id, section_enum) AS k FROM sections) GROUP BY 1")
def section_dedup(spark, sf_dir):
    return dedup.canonical(_sections(spark, sf_dir), ["section_text_hash"], _doc_key("section_enum"), ["doc_id", "section_enum"])


@query(f"""WITH {_SECTIONS}, p AS (SELECT DISTINCT section_text_hash, document_text_hash FROM sections JOIN (SELECT doc_id, {_hash('text')} AS document_text_hash FROM documents) USING (doc_id))
SELECT *, (count(*) OVER (PARTITION BY section_text_hash))::BIGINT AS n_values FROM p QUALIFY count(*) OVER (PARTITION BY section_text_hash) > 1""")
def section_hash_list(spark, sf_dir):
    docs = _docs(spark, sf_dir).withColumn("document_text_hash", T.text_hash(F.col("text")))
    rows = chunking.paragraphs(docs.select("document_text_hash", "text"), "text")
    return dedup.group_values(rows, ["section_text_hash"], "document_text_hash")


# --- chunking

_WINDOWS = """w AS (SELECT doc_id, {words} AS w FROM documents), s AS (
  SELECT doc_id, w, len(w) AS n, greatest(0, ceil((len(w) - 128) / 112.0))::BIGINT AS last FROM w
)"""


@query(f"""WITH {_WINDOWS.format(words=_words('text'))}
SELECT doc_id, i::INT AS chunk_index, (i * 112)::INT AS start, array_to_string(w[i * 112 + 1 : i * 112 + 128], ' ') AS text FROM (SELECT *, unnest(range(0, last + 1)) AS i FROM s)""")
def chunk_sliding(spark, sf_dir):
    w = chunking.sliding_windows(F.col("text"), 128, 16)
    return _docs(spark, sf_dir).select("doc_id", F.posexplode(w).alias("chunk_index", "_c")).select("doc_id", "chunk_index", "_c.start", "_c.text")


@query(f"""WITH {_WINDOWS.format(words=_words('text'))}, starts AS (
  SELECT doc_id, n, unnest(list_concat([x * 112 for x in range(0, last + 1)], CASE WHEN n > 128 THEN range(greatest(n - 16, last * 112 + 1), n) ELSE [] END)) AS start FROM s
) SELECT doc_id, count(*)::BIGINT AS n_windows, sum(least(start + 128, n) - start)::BIGINT AS n_words FROM starts GROUP BY doc_id""")
def chunk_sliding_parity(spark, sf_dir):
    w = chunking.sliding_windows(F.col("text"), 128, 16, tail="parity", with_text=False)
    rows = _docs(spark, sf_dir).select("doc_id", F.explode(w).alias("c"))
    return rows.groupBy("doc_id").agg(F.count("*").alias("n_windows"), F.sum("c.n").alias("n_words"))


@query(f"""WITH RECURSIVE w AS (SELECT doc_id, text, {_words('text')} AS w FROM documents), c AS (
  SELECT doc_id, text, w, len(w)::BIGINT AS n, 0::BIGINT AS i, 0::BIGINT AS start, least(128, len(w))::BIGINT AS stop, array_to_string(w[1:128], ' ') AS piece FROM w WHERE len(w) > 128
), cut0 AS (
  SELECT doc_id, w, n, i, start, CASE WHEN good THEN len(regexp_extract_all(left(piece, dot), '[^ ]+'))::BIGINT ELSE stop END AS stop, CASE WHEN good THEN left(piece, dot) ELSE piece END AS piece FROM (
    SELECT *, len(piece) - strpos(reverse(piece), ' .') AS dot, strpos(reverse(piece), ' .') > 0 AND len(piece) - strpos(reverse(piece), ' .') - 1 > len(piece) // 2 AS good FROM c)
), step(doc_id, w, n, i, start, stop, piece) AS (
  SELECT doc_id, w, n, i, start, stop, piece FROM cut0
  UNION ALL
  SELECT doc_id, w, n, i + 1, s2, CASE WHEN good THEN s2 + len(regexp_extract_all(left(p2, dot), '[^ ]+')) ELSE e2 END, CASE WHEN good THEN left(p2, dot) ELSE p2 END FROM (
    SELECT *, len(p2) - strpos(reverse(p2), ' .') AS dot, e2 < n AND strpos(reverse(p2), ' .') > 0 AND len(p2) - strpos(reverse(p2), ' .') - 1 > len(p2) // 2 AS good FROM (
      SELECT *, array_to_string(w[s2 + 1 : e2], ' ') AS p2 FROM (SELECT *, greatest(stop - 16, start + 1) AS s2, least(greatest(stop - 16, start + 1) + 128, n) AS e2 FROM step WHERE stop < n)))
)
SELECT doc_id, i::INT AS chunk_index, trim(piece) AS text FROM step UNION ALL SELECT doc_id, 0::INT, text FROM w WHERE len(w) <= 128""")
def chunk_sentence(spark, sf_dir):
    return chunking.sentence_chunks(_docs(spark, sf_dir), "doc_id", "text", 128, 16)


_CHUNKS = f"""{_SECTIONS}, cw AS (SELECT doc_id, section_enum, section_text_hash, {_words('body_text')} AS w FROM sections), chunks AS (
  SELECT doc_id, section_enum, section_text_hash, i::INT AS chunk_index, {_TOKENS.format(w='w[i * 48 + 1 : i * 48 + 64]')}::INT AS tokens
  FROM (SELECT *, unnest(range(0, greatest(0, ceil((len(w) - 64) / 48.0))::BIGINT + 1)) AS i FROM cw)
)"""


def _chunks(spark, sf_dir) -> DataFrame:
    w = chunking.sliding_windows(F.col("body_text"), 64, 16, with_text=False)
    rows = _sections(spark, sf_dir).select("doc_id", "section_enum", "section_text_hash", F.posexplode(w).alias("chunk_index", "_c"))
    return rows.select("doc_id", "section_enum", "section_text_hash", "chunk_index", T.tokens_of(F.col("_c.n")).alias("tokens"))


@query(f"WITH {_CHUNKS} SELECT * FROM chunks WHERE tokens >= 30")
def chunk_min_tokens(spark, sf_dir):
    return chunking.at_least(_chunks(spark, sf_dir), 30)


@query(f"WITH {_CHUNKS} SELECT doc_id, section_enum, section_text_hash, chunk_index, tokens FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, section_text_hash, section_enum ORDER BY tokens DESC, chunk_index) AS rn FROM chunks) WHERE rn = 1")
def chunk_best_per_section(spark, sf_dir):
    return chunking.best_per_section(_chunks(spark, sf_dir), ["doc_id", "section_text_hash", "section_enum"])


_CAPPED = f"""{_CHUNKS}, b AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, section_enum, section_text_hash ORDER BY tokens DESC, chunk_index) = 1 AS best FROM chunks WHERE tokens >= 5
), capped AS (
  SELECT doc_id, section_enum, section_text_hash, chunk_index, tokens FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY best DESC, tokens DESC, section_enum, section_text_hash, chunk_index) AS place FROM b) WHERE place <= 8
)"""


def _capped(spark, sf_dir) -> DataFrame:
    return chunking.capped(chunking.at_least(_chunks(spark, sf_dir), 5), "doc_id", ["section_enum", "section_text_hash"], 8)


@query(f"WITH {_CAPPED} SELECT * FROM capped")
def chunk_cap(spark, sf_dir):
    return _capped(spark, sf_dir)


@query(f"WITH {_CAPPED} SELECT doc_id, section_enum, section_text_hash, (row_number() OVER (PARTITION BY doc_id, section_enum, section_text_hash ORDER BY chunk_index) - 1)::INT AS chunk_index, tokens, chunk_index AS original_chunk_index FROM capped")
def chunk_renumber(spark, sf_dir):
    return chunking.renumbered(_capped(spark, sf_dir), "doc_id", ["section_enum", "section_text_hash"])


@query(f"WITH {_SECTIONS} SELECT doc_id, (section_enum + 1)::VARCHAR AS enum, 'Title ' || (section_enum + 1) AS header, body_text FROM sections WHERE section_enum > 0")
def section_numbered(spark, sf_dir):
    """Lines under headings SEC. n.; the first heading is boilerplate and its section goes."""
    line = lambda x, i: F.concat(F.lit("SEC. "), (i + 1).cast("string"), F.lit(". "), F.when(i == 0, "Short title.").otherwise(F.concat(F.lit("Title "), (i + 1).cast("string"))), F.lit("\n"), x)
    text = F.concat(F.lit("preamble\n"), F.array_join(F.transform(F.split("text", "\n"), line), "\n"))
    rows = _docs(spark, sf_dir).select("doc_id", F.explode(chunking.numbered_sections(text)).alias("s"))
    return rows.select("doc_id", "s.enum", "s.header", "s.body_text")


_PREFIX = "'[H.R. ' || doc_id || ', 110th Congress] —'"


@query(f"""WITH w AS (SELECT doc_id, {_words('text')} AS w FROM documents), n AS (SELECT *, len(w) AS n, greatest(0, (len(w) - 7) // 120)::BIGINT AS last FROM w WHERE len(w) > 0),
c AS (SELECT doc_id, w, n, last, unnest(range(0, last + 1)) AS i FROM n), x AS (SELECT doc_id, i::INT AS chunk_index, {_PREFIX} || ' ' || array_to_string(w[i * 120 + 1 : CASE WHEN i = last THEN n ELSE i * 120 + 120 END], ' ') AS text FROM c)
SELECT *, {_TOKENS.format(w=_words('text'))}::INT AS tokens FROM x""")
def section_packing(spark, sf_dir):
    """A document as a section with subsections of 40 words each, of which three fit into a chunk of 100 tokens, and a rest of 6."""
    words = T.words(F.coalesce("text", F.lit("")))
    pieces = T.let(words, lambda w: F.struct(F.array_join(w, " ").alias("body"), F.transform(F.filter(F.sequence(F.lit(0), F.size(w)), lambda i: (i % 40 == 0) & (i < F.size(w))), lambda i: F.array_join(F.slice(w, i + 1, F.lit(40)), " ")).alias("subs")))
    docs = _docs(spark, sf_dir).select("doc_id", pieces.alias("p"))
    prefix = T.chunk_prefix(F.lit("hr"), F.col("doc_id"), F.lit(110), F.lit(""), F.lit(""))
    return docs.select("doc_id", F.explode(chunking.section_chunk_udf(100, 16)(prefix, F.col("p.body"), F.col("p.subs"))).alias("c")).select("doc_id", "c.chunk_index", "c.text", "c.tokens")


@query("SELECT c_custkey, o_orderkey, rn FROM (SELECT o_custkey AS c_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn <= 3")
def first_n_per_group(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return folds.number_within(orders, ["c_custkey"], ["o_orderkey"]).where("rn <= 3")


_CODE = "CASE o_orderpriority WHEN '1-URGENT' THEN 'ENR' WHEN '2-HIGH' THEN 'eh' WHEN '3-MEDIUM' THEN 'rs' WHEN '4-NOT SPECIFIED' THEN 'zz' END"


@query(f"""SELECT o_custkey, arg_min(o_orderkey, (r, v, b)) AS o_orderkey FROM (SELECT o_custkey, o_orderkey, coalesce(lower({_CODE}), '') AS v, o_orderkey || '-110' AS b,
  CASE lower({_CODE}) WHEN 'enr' THEN 0 WHEN 'eh' THEN 2 WHEN 'rs' THEN 3 ELSE 99 END AS r FROM orders) GROUP BY o_custkey""")
def alias_first(spark, sf_dir):
    """The first alias of each customer's orders: by version rank, version, id."""
    key = T.alias_key(F.expr(_CODE), F.concat(F.col("o_orderkey").cast("string"), F.lit("-110")), F.lit(None).cast("string"), F.lit(""))
    return _t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min_by("o_orderkey", key).alias("o_orderkey"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY k, n IS NULL, n, s, o_orderkey) - 1 AS place FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'hr' ELSE 's' END AS k, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS n, CASE WHEN o_orderstatus = 'P' THEN 'x' || o_orderkey ELSE o_orderkey::VARCHAR END AS s FROM orders) QUALIFY place < 500")
def bill_order(spark, sf_dir):
    """The first 500 orders as bills: by type, then number, numeric ones first."""
    number = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("x"), "o_orderkey")).otherwise(F.col("o_orderkey").cast("string"))
    kind = F.when(F.col("o_orderstatus") == "F", "hr").otherwise("s")
    keyed = _t(spark, sf_dir, "orders").select("o_orderkey", T.bill_order_key(F.lit(110), kind, number, F.col("o_orderkey")).alias("_k"))
    top = keyed.orderBy("_k").limit(500)
    return search.ranked_hits(top, [F.col("_k")], "place").drop("_k")


# --- packing


@query("SELECT source, doc_id, (floor((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) / 20) + 1)::BIGINT AS shard_id FROM documents")
def shard_fixed(spark, sf_dir):
    return packing.fixed_shards(_docs(spark, sf_dir).select("source", "doc_id"), ["source"], ["doc_id"], 20)


_COUNTS = f"{_SECTIONS}, counts AS (SELECT source, doc_id, count(*)::BIGINT AS n_chunks, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM sections GROUP BY source, doc_id)"


def _counts(spark, sf_dir) -> DataFrame:
    return _sections(spark, sf_dir).groupBy("source", "doc_id").agg(F.count("*").alias("n_chunks"))


_GREEDY = f"""WITH RECURSIVE {_COUNTS}, g AS (
  SELECT source, doc_id, n_chunks, rn, 1::BIGINT AS shard_id, 1 AS bills, n_chunks AS total FROM counts WHERE rn = 1
  UNION ALL
  SELECT c.source, c.doc_id, c.n_chunks, c.rn, CASE WHEN g.bills >= 10 OR g.total + c.n_chunks > 150 THEN g.shard_id + 1 ELSE g.shard_id END,
    CASE WHEN g.bills >= 10 OR g.total + c.n_chunks > 150 THEN 1 ELSE g.bills + 1 END, CASE WHEN g.bills >= 10 OR g.total + c.n_chunks > 150 THEN c.n_chunks ELSE g.total + c.n_chunks END
  FROM g JOIN counts c ON c.source = g.source AND c.rn = g.rn + 1
)"""


@query(_GREEDY + " SELECT source, doc_id, n_chunks, shard_id FROM g")
def shard_greedy(spark, sf_dir):
    return packing.greedy_shards(_counts(spark, sf_dir), "source", ["doc_id"], "doc_id", "n_chunks", 10, 150)


@query(_GREEDY + " SELECT source, shard_id, count(*)::BIGINT AS bill_count, sum(n_chunks)::BIGINT AS chunk_count, min(doc_id) AS first_bill, max(doc_id) AS last_bill FROM g GROUP BY 1, 2")
def shard_manifest(spark, sf_dir):
    shards = packing.greedy_shards(_counts(spark, sf_dir), "source", ["doc_id"], "doc_id", "n_chunks", 10, 150)
    return packing.shard_manifest(shards, ["source"], "doc_id", "n_chunks", ["doc_id"])


@query(f"""WITH RECURSIVE t AS (SELECT source, doc_id, {_TOKENS.format(w=_words('text'))}::BIGINT AS tokens, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents), g AS (
  SELECT source, doc_id, tokens, rn, 1::BIGINT AS batch_id, 1 AS items, tokens AS total FROM t WHERE rn = 1
  UNION ALL
  SELECT t.source, t.doc_id, t.tokens, t.rn, CASE WHEN items >= 8 OR total + t.tokens > 30000 THEN batch_id + 1 ELSE batch_id END,
    CASE WHEN items >= 8 OR total + t.tokens > 30000 THEN 1 ELSE items + 1 END, CASE WHEN items >= 8 OR total + t.tokens > 30000 THEN t.tokens ELSE total + t.tokens END
  FROM g JOIN t ON t.source = g.source AND t.rn = g.rn + 1
) SELECT source, doc_id, tokens, batch_id FROM g""")
def batch_pack(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("source", "doc_id", T.token_count(F.col("text")).cast("bigint").alias("tokens"))
    return packing.pack_batches(rows, "source", ["doc_id"], "doc_id", "tokens", 8, 30_000)


# --- change detection and state
# The earlier state: Spanish documents were not there yet, toxic ones had another text, benchmark items have gone since.

_MANIFESTS = """cur AS (SELECT doc_id, sha256(text) AS h FROM documents), prev AS (
  SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN sha256('old ' || text) ELSE sha256(text) END AS h FROM documents WHERE lang <> 'es'
  UNION ALL SELECT -1 - item_id, sha256(text) FROM benchmark
), changes AS (
  SELECT coalesce(c.doc_id, p.doc_id) AS doc_id, CASE WHEN c.doc_id IS NULL THEN 'deleted' WHEN p.doc_id IS NULL THEN 'new' WHEN c.h = p.h THEN 'unchanged' ELSE 'modified' END AS status
  FROM cur c FULL JOIN prev p ON c.doc_id = p.doc_id
)"""


def _toxic(spark, sf_dir) -> DataFrame:
    return _t(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").distinct()


def _changes(spark, sf_dir) -> DataFrame:
    docs = _docs(spark, sf_dir)
    current = docs.select("doc_id", T.raw_hash(F.col("text")).alias("h"))
    toxic = _toxic(spark, sf_dir).withColumn("_toxic", F.lit(True))
    before = docs.where("lang <> 'es'").join(toxic, "doc_id", "left")
    before = before.select("doc_id", T.raw_hash(F.when(F.col("_toxic"), F.concat(F.lit("old "), "text")).otherwise(F.col("text"))).alias("h"))
    gone = _t(spark, sf_dir, "benchmark").select((-1 - F.col("item_id")).alias("doc_id"), T.raw_hash(F.col("text")).alias("h"))
    return state.detect_changes(current, before.unionByName(gone), "doc_id", "h")


@query(f"WITH {_MANIFESTS} SELECT * FROM changes")
def change_detect(spark, sf_dir):
    return _changes(spark, sf_dir)


@query(f"WITH {_MANIFESTS} SELECT (count(*) FILTER (status IN ('new', 'modified')))::BIGINT AS changed_count, (count(*) FILTER (status = 'unchanged'))::BIGINT AS unchanged_count, (count(*) FILTER (status = 'deleted'))::BIGINT AS deleted_count, (count(*) FILTER (status <> 'deleted'))::BIGINT AS total_count FROM changes")
def change_summary(spark, sf_dir):
    return state.change_summary(_changes(spark, sf_dir))


_SOURCE = f"""{_SECTIONS}, dh AS (SELECT doc_id, {_hash('text')} AS document_text_hash FROM documents), src AS (
  SELECT source, doc_id, section_enum, sha256(doc_id || '|' || document_text_hash || '|' || section_text_hash || '|' || section_enum) AS source_hash FROM sections JOIN dh USING (doc_id)
)"""


def _source_rows(spark, sf_dir) -> DataFrame:
    docs = _docs(spark, sf_dir).select("doc_id", "lang", "source", "text", T.text_hash(F.col("text")).alias("document_text_hash"))
    rows = chunking.paragraphs(docs, "text").drop("text")
    return rows.withColumn("source_hash", T.source_hash(F.col("doc_id"), F.col("document_text_hash"), F.col("section_text_hash"), F.col("section_enum")))


@query(f"WITH {_SOURCE} SELECT doc_id, section_enum, source_hash FROM src")
def source_hash(spark, sf_dir):
    return _source_rows(spark, sf_dir).select("doc_id", "section_enum", "source_hash")


@query(f"WITH {_SOURCE} SELECT source, left(source_hash, 2) AS part, count(*)::BIGINT AS n, sum(('0x' || left(source_hash, 15))::BIGINT)::VARCHAR AS hash_sum FROM src GROUP BY ALL")
def manifest_tree(spark, sf_dir):
    return state.manifest_tree(_source_rows(spark, sf_dir), "source", "source_hash").withColumn("hash_sum", F.col("hash_sum").cast("string"))


@query(f"WITH {_SOURCE} SELECT source, count(*)::BIGINT AS n, md5(string_agg(source_hash, ',' ORDER BY source_hash)) AS manifest_md5 FROM src GROUP BY source")
def manifest_md5(spark, sf_dir):
    return state.manifest_md5(_source_rows(spark, sf_dir), "source", "source_hash")


_STATES = f"""{_SOURCE}, desired AS (SELECT DISTINCT doc_id AS bill_uid, source_hash FROM src), actual AS (
  SELECT DISTINCT bill_uid, CASE WHEN bill_uid IN (SELECT doc_id FROM labels WHERE toxic = 1) AND section_enum = 0 THEN sha256('old ' || source_hash) ELSE source_hash END AS source_hash
  FROM (SELECT doc_id AS bill_uid, section_enum, source_hash FROM src WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'es'))
  UNION ALL SELECT -1 - item_id, sha256(text) FROM benchmark
), plan AS (
  SELECT coalesce(d.bill_uid, a.bill_uid) AS bill_uid, count(*) FILTER (d.bill_uid IS NOT NULL AND a.bill_uid IS NULL) AS n_add, count(*) FILTER (d.bill_uid IS NOT NULL AND a.bill_uid IS NOT NULL) AS n_reuse,
    count(*) FILTER (d.bill_uid IS NULL) AS n_drop FROM desired d FULL JOIN actual a ON d.bill_uid = a.bill_uid AND d.source_hash = a.source_hash GROUP BY 1
), planned AS (
  SELECT bill_uid, CASE WHEN n_add + n_reuse = 0 THEN 'delete' WHEN n_reuse + n_drop = 0 THEN 'new' WHEN n_add + n_drop > 0 THEN 'replace' ELSE 'keep' END AS action, n_add::BIGINT AS n_add, n_reuse::BIGINT AS n_reuse, n_drop::BIGINT AS n_drop FROM plan
)"""


def _states(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    # both sides come from one pass over the texts
    rows = folds.materialized(_source_rows(spark, sf_dir).select("doc_id", "lang", "section_enum", "source_hash"))
    desired = rows.select(F.col("doc_id").alias("bill_uid"), "source_hash").distinct()
    toxic = _toxic(spark, sf_dir).withColumn("_toxic", F.lit(True))
    old = rows.where("lang <> 'es'").join(toxic, "doc_id", "left")
    changed = F.when(F.col("_toxic") & (F.col("section_enum") == 0), F.sha2(F.concat(F.lit("old "), "source_hash"), 256)).otherwise(F.col("source_hash"))
    actual = old.select(F.col("doc_id").alias("bill_uid"), changed.alias("source_hash")).distinct()
    gone = _t(spark, sf_dir, "benchmark").select((-1 - F.col("item_id")).alias("bill_uid"), F.sha2(F.col("text"), 256).alias("source_hash"))
    return desired, actual.unionByName(gone)


@query(f"WITH {_STATES} SELECT * FROM planned")
def reconcile_plan(spark, sf_dir):
    return state.reconcile_plan(*_states(spark, sf_dir))


@query(f"WITH {_STATES} SELECT d.bill_uid, d.source_hash, CASE WHEN a.bill_uid IS NULL THEN 'new ' ELSE 'old ' END || d.source_hash AS embedding, CASE WHEN a.bill_uid IS NULL THEN 'added' ELSE 'reused' END AS origin FROM desired d LEFT JOIN actual a USING (bill_uid, source_hash)")
def reconcile_apply(spark, sf_dir):
    desired, actual = _states(spark, sf_dir)
    have = actual.withColumn("embedding", F.concat(F.lit("old "), "source_hash"))
    missing = desired.join(actual, ["bill_uid", "source_hash"], "left_anti").select("source_hash").distinct()
    return state.reconcile_apply(desired, have, missing.withColumn("embedding", F.concat(F.lit("new "), "source_hash")))


@query(f"WITH {_STATES} SELECT n_delete, n_actual, CASE WHEN n_actual > 0 THEN n_delete / n_actual ELSE 0.0 END::DOUBLE AS fraction FROM (SELECT (count(*) FILTER (action = 'delete'))::BIGINT AS n_delete, (count(*) FILTER (action <> 'new'))::BIGINT AS n_actual FROM planned)")
def delete_guard_fraction(spark, sf_dir):
    return state.delete_fraction(state.reconcile_plan(*_states(spark, sf_dir)))


@query("""SELECT s.o_custkey, s.n AS staged_count, coalesce(l.n, 0) AS live_count, CASE WHEN s.n = coalesce(l.n, 0) THEN 'upsert' ELSE 'replace' END AS strategy
FROM (SELECT o_custkey, count(*)::BIGINT AS n FROM orders GROUP BY 1) s LEFT JOIN (SELECT o_custkey, count(*)::BIGINT AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1) l USING (o_custkey)""")
def upsert_by_count(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    return state.upsert_by_count(orders, orders.where("o_orderstatus <> 'P'"), "o_custkey")


_LIVE = """live AS (
  SELECT o_orderkey, o_custkey, 'old' AS body FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT -1 - c_custkey, c_custkey, 'gone' FROM customer WHERE c_mktsegment = 'BUILDING'
), strategy AS (
  SELECT o_custkey, s.n = coalesce(l.n, 0) AS same FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) s LEFT JOIN (SELECT o_custkey, count(*) AS n FROM live GROUP BY 1) l USING (o_custkey)
)"""


@query(f"""WITH {_LIVE}, kept AS (SELECT * FROM live WHERE o_custkey NOT IN (SELECT o_custkey FROM strategy WHERE NOT same))
SELECT k.o_orderkey, k.o_custkey, CASE WHEN o.o_orderkey IS NULL THEN k.body ELSE 'new' END AS body FROM kept k LEFT JOIN orders o ON o.o_orderkey = k.o_orderkey
UNION ALL SELECT o_orderkey, o_custkey, 'new' FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM kept)""")
def upsert_snapshot(spark, sf_dir):
    orders, customers = _t(spark, sf_dir, "orders"), _t(spark, sf_dir, "customer")
    live = orders.where("o_orderstatus <> 'P'").select("o_orderkey", "o_custkey", F.lit("old").alias("body"))
    live = live.unionByName(customers.where("c_mktsegment = 'BUILDING'").select((-1 - F.col("c_custkey")).alias("o_orderkey"), F.col("c_custkey").alias("o_custkey"), F.lit("gone").alias("body")))
    return state.upsert_snapshot(orders.select("o_orderkey", "o_custkey", F.lit("new").alias("body")), live, "o_custkey", "o_orderkey", ["body"])


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_anti(spark, sf_dir):
    return embedding.pending(_docs(spark, sf_dir).select("doc_id", "source"), _t(spark, sf_dir, "labels"), ["doc_id"])


@query("SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def changed_semi(spark, sf_dir):
    return files.pruned_scan(_docs(spark, sf_dir).select("doc_id", "source"), _toxic(spark, sf_dir), "doc_id")


@query("SELECT doc_id, source FROM documents")
def changed_miss(spark, sf_dir):
    """One id of the list is unknown, so the list can't be trusted and all rows are taken."""
    ids = _toxic(spark, sf_dir).union(spark.range(1).selectExpr("-1L doc_id"))
    return files.pruned_scan(_docs(spark, sf_dir).select("doc_id", "source"), ids, "doc_id")


@query("SELECT o_orderkey, o_custkey, c_name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') ON o_custkey = c_custkey")
def vote_bill_left(spark, sf_dir):
    bills = _t(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(bills, "o_custkey", "left").select("o_orderkey", "o_custkey", "c_name")


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id, count(*)::BIGINT AS n_events FROM events GROUP BY user_id")
def audit_latest(spark, sf_dir):
    return state.latest(_t(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], ["event_type", "ts", "event_id"])


@query("SELECT (count(*) FILTER (vec_id IS NULL))::BIGINT AS no_hash, (count(*) FILTER (embedding IS NULL))::BIGINT AS no_embedding, (count(*) FILTER (len(embedding) <> 64))::BIGINT AS wrong_dimension FROM embeddings")
def embedding_guard(spark, sf_dir):
    return state.validate_embedded(_t(spark, sf_dir, "embeddings").withColumn("h", F.col("vec_id").cast("string")), "h", "embedding", 64)


# --- search


def _vectors(spark, sf_dir) -> DataFrame:
    return _t(spark, sf_dir, "embeddings")


def _first(df: DataFrame) -> list[float]:
    """The query vector: one row, pushed down by its key."""
    return list(df.where("vec_id = 0").select("embedding").first()[0])


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("similarity", F.round("similarity", 6))


_TOP = "SELECT vec_id, label, round(s, 6) AS similarity FROM (SELECT vec_id, label, {sim} AS s FROM embeddings e{where}) WHERE s IS NOT NULL AND NOT isnan(s) ORDER BY s DESC, vec_id LIMIT {k}"


@query(_TOP.format(sim=_SIM, where="", k=40))
def vec_topk(spark, sf_dir):
    e = _vectors(spark, sf_dir)
    return _rounded(search.top_k(e, _first(e), 40, "vec_id"))


@query(_TOP.format(sim=_SIM, where="", k=40))
def vec_topk_index(spark, sf_dir):
    """The same rows by the index, exactly: cells that can't hold any of them are not read."""
    e = _vectors(spark, sf_dir)
    index = search.build_index(e, folds.shared_dir(spark, "index"), "vec_id", cells=16)
    return _rounded(search.indexed_top_k(spark, index, _first(e), 40, "vec_id"))


@query(f"""WITH top AS (SELECT vec_id, label, {_SIM} AS s FROM embeddings e ORDER BY s DESC, vec_id LIMIT 40)
SELECT vec_id, label, round(s, 6) AS similarity, lang, source, n_chars FROM top LEFT JOIN documents ON doc_id = vec_id""")
def vec_hits_hydrated(spark, sf_dir):
    e = _vectors(spark, sf_dir)
    details = _docs(spark, sf_dir).select(F.col("doc_id").alias("vec_id"), "lang", "source", "n_chars")
    return search.hydrated(_rounded(search.top_k(e, _first(e), 40, "vec_id")), details, "vec_id")


@query(f"""WITH top AS (SELECT vec_id, {_SIM} AS s FROM embeddings e ORDER BY s DESC, vec_id LIMIT 100)
SELECT source, round(max(s), 6) AS similarity, count(*)::BIGINT AS n FROM top JOIN documents ON doc_id = vec_id GROUP BY source ORDER BY max(s) DESC, source LIMIT 10""")
def vec_overfetch_join(spark, sf_dir):
    """Embeddings over-fetched, joined to their chunks by id, then grouped by bill."""
    e = _vectors(spark, sf_dir)
    near = search.hydrated(search.top_k(e, _first(e), 100, "vec_id"), _docs(spark, sf_dir).select(F.col("doc_id").alias("vec_id"), "source"), "vec_id")
    found = near.where("source is not null").groupBy("source").agg(F.max("similarity").alias("similarity"), F.count("*").alias("n"))
    return _rounded(found.orderBy(F.desc("similarity"), "source").limit(10))


@query(f"""WITH s AS (SELECT vec_id, label, {_SIM} AS s FROM embeddings e), g AS (SELECT DISTINCT label FROM (SELECT label FROM s ORDER BY s DESC, vec_id LIMIT 5))
SELECT vec_id, label, round(s, 6) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY s DESC, vec_id) AS rn FROM s JOIN g USING (label)) WHERE rn <= 3""")
def vec_within_groups(spark, sf_dir):
    e = _vectors(spark, sf_dir)
    return _rounded(search.within_groups(e, search.top_k(e, _first(e), 5, "vec_id"), _first(e), 3, "label", "vec_id"))


@query(_TOP.format(sim=_SIM, where=" WHERE label BETWEEN 2 AND 6", k=10))
def vec_topk_filtered(spark, sf_dir):
    e = _vectors(spark, sf_dir)
    return _rounded(search.top_k(e, _first(e), 10, "vec_id", where=F.col("label").between(2, 6)))


@query(f"SELECT vec_id, label, round(s, 6) AS similarity FROM (SELECT vec_id, label, {_SIM} AS s FROM embeddings e) WHERE s >= 0.35 ORDER BY s DESC, vec_id LIMIT 100")
def vec_threshold(spark, sf_dir):
    e = _vectors(spark, sf_dir)
    return _rounded(search.top_k(e, _first(e), 100, "vec_id", least=0.35))


@query(f"SELECT label, arg_max(vec_id, (s, -vec_id)) AS vec_id, round(max(s), 6) AS similarity FROM (SELECT vec_id, label, {_SIM} AS s FROM embeddings e) GROUP BY label ORDER BY max(s) DESC, label LIMIT 5")
def vec_best_per_group(spark, sf_dir):
    e = _vectors(spark, sf_dir)
    return _rounded(search.best_per_group(e, _first(e), 5, "label", "vec_id"))


@query(f"SELECT label, round(max(s), 6) AS similarity FROM (SELECT vec_id, label, {_SIM} AS s FROM embeddings e ORDER BY s DESC, vec_id LIMIT 50) GROUP BY label ORDER BY max(s) DESC, label LIMIT 10")
def vec_overfetch_group(spark, sf_dir):
    e = _vectors(spark, sf_dir)
    return _rounded(search.overfetch_groups(e, _first(e), 10, "label", "vec_id"))


@query(f"SELECT vec_id, label, round(s, 6) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY s DESC, vec_id) AS rn FROM (SELECT vec_id, label, {_SIM} AS s FROM embeddings e ORDER BY s DESC, vec_id LIMIT 40)) WHERE rn = 1 ORDER BY s DESC, vec_id LIMIT 20")
def vec_first_n_groups(spark, sf_dir):
    e = _vectors(spark, sf_dir)
    return _rounded(search.first_groups(e, _first(e), 40, 20, "label", "vec_id"))


@query(f"""WITH s AS (SELECT vec_id, label, {_SIM} AS s, label >= 5 AS votes FROM embeddings e)
SELECT vec_id, label, round(s, 6) AS similarity, CASE WHEN votes THEN 'vote' ELSE 'bill' END AS source_kind FROM (
  SELECT * FROM (SELECT * FROM s WHERE NOT votes ORDER BY s DESC, vec_id LIMIT 10) UNION ALL SELECT * FROM (SELECT * FROM s WHERE votes ORDER BY s DESC, vec_id LIMIT 10)) ORDER BY s DESC, votes, vec_id LIMIT 10""")
def multi_index_merge(spark, sf_dir):
    e = _vectors(spark, sf_dir)
    return _rounded(search.merged([("bill", e.where("label < 5")), ("vote", e.where("label >= 5"))], _first(e), 10, "vec_id"))


_TERMS = ["license", "public", "general", "with", "und"]
_TERM_LIST = "['license', 'public', 'general', 'with', 'und']"
_KEYWORD = f"""kw AS (
  SELECT doc_id, len(list_filter({_TERM_LIST}, lambda t: list_contains(w, t)))::INT AS n_terms, len(list_filter(w, lambda x: list_contains({_TERM_LIST}, x)))::BIGINT AS n_hits
  FROM (SELECT doc_id, {_words('lower(text)')} AS w FROM documents)
)"""


def _keyword(spark, sf_dir, k: int) -> DataFrame:
    return search.keyword_top_k(_docs(spark, sf_dir), _TERMS, k, "doc_id", F.lower("text"))


@query(f"WITH {_KEYWORD} SELECT doc_id, n_terms, n_hits FROM kw WHERE n_hits > 0 ORDER BY n_terms DESC, n_hits DESC, doc_id LIMIT 50")
def keyword_rank(spark, sf_dir):
    return _keyword(spark, sf_dir, 50)


@query(f"""WITH {_KEYWORD}, k AS (SELECT doc_id AS id, row_number() OVER (ORDER BY n_terms DESC, n_hits DESC, doc_id) - 1 AS r FROM kw WHERE n_hits > 0 QUALIFY r < 100),
v AS (SELECT vec_id AS id, row_number() OVER (ORDER BY s DESC, vec_id) - 1 AS r FROM (SELECT vec_id, {_SIM} AS s FROM embeddings e) QUALIFY r < 100)
SELECT id, round(sum(1.0::DOUBLE / (60 + r)), 9) AS score FROM (SELECT * FROM k UNION ALL SELECT * FROM v) GROUP BY id""")
def hybrid_rrf(spark, sf_dir):
    e = _vectors(spark, sf_dir)
    near = search.ranked_hits(search.top_k(e, _first(e), 100, "vec_id"), [F.desc("similarity"), F.col("vec_id")]).select(F.col("vec_id").alias("id"), "rank")
    words = search.ranked_hits(_keyword(spark, sf_dir, 100), [F.desc("n_terms"), F.desc("n_hits"), F.col("doc_id")]).select(F.col("doc_id").alias("id"), "rank")
    return search.fuse([words, near], "id").withColumn("score", F.round("score", 9))


_EVAL = """q AS (SELECT label AS ql, min(vec_id) AS query_id FROM embeddings GROUP BY label), qv AS (SELECT q.*, e.embedding::DOUBLE[] AS v FROM q JOIN embeddings e ON e.vec_id = q.query_id),
top AS (SELECT query_id, ql, vec_id, label, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS r FROM (
  SELECT query_id, ql, vec_id, label, list_cosine_similarity(embedding::DOUBLE[], v) AS s FROM embeddings, qv WHERE vec_id <> query_id) QUALIFY r <= 10),
want AS (SELECT ql, query_id, count(*) - 1 AS n FROM q JOIN embeddings e ON e.label = q.ql GROUP BY 1, 2),
m AS (SELECT w.query_id, coalesce(count(*) FILTER (label = t.ql) / any_value(n), 0.0) AS recall, coalesce((count(*) FILTER (label = t.ql)) / greatest(count(t.vec_id), 1), 0.0) AS precision,
  coalesce(1.0::DOUBLE / min(r) FILTER (label = t.ql), 0.0::DOUBLE) AS mrr FROM want w LEFT JOIN top t USING (query_id) WHERE n > 0 GROUP BY 1)"""


def _evaluated(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Per-query metrics of one query vector per label (a stated set); relevant: the other rows of its label."""
    e = _vectors(spark, sf_dir)
    chosen = e.groupBy("label").agg(F.min_by(F.struct("vec_id", "embedding"), "vec_id").alias("q")).select("label", "q.*")
    queries = {r["vec_id"]: list(r["embedding"]) for r in chosen.collect()}
    hits = search.batch_top_k(e, queries, 10, "vec_id", "label")
    ids = F.broadcast(chosen.select(F.col("vec_id").alias("query_id"), "label"))  # a row per stated query
    expected = e.select("vec_id", "label").join(ids, "label").where("vec_id <> query_id").select("query_id", "vec_id")
    return evaluation.metrics(hits, expected, 10, "vec_id"), ids


@query(f"WITH {_EVAL} SELECT query_id, round(recall, 9) AS recall, round(precision, 9) AS precision, round(mrr, 9) AS mrr FROM m")
def eval_metrics(spark, sf_dir):
    m, _ = _evaluated(spark, sf_dir)
    return m.select("query_id", *(F.round(c, 9).alias(c) for c in ("recall", "precision", "mrr")))


@query(f"""WITH {_EVAL}, c AS (SELECT m.*, CASE WHEN q.ql < 5 THEN 'low' ELSE 'high' END AS category FROM m JOIN q USING (query_id)), u AS (SELECT * FROM c UNION ALL SELECT * REPLACE ('OVERALL' AS category) FROM c)
SELECT category, count(*)::BIGINT AS n_queries, round(avg(recall), 9) AS recall, round(avg(precision), 9) AS precision, round(avg(mrr), 9) AS mrr FROM u GROUP BY category""")
def eval_by_category(spark, sf_dir):
    m, ids = _evaluated(spark, sf_dir)
    rows = m.join(ids, "query_id").withColumn("category", F.when(F.col("label") < 5, "low").otherwise("high"))
    out = evaluation.by_category(rows, "category")
    return out.select("category", "n_queries", *(F.round(c, 9).alias(c) for c in ("recall", "precision", "mrr")))


@query("SELECT event_type, n, v[n // 2 + 1] AS p50, v[least(n - 1, trunc(0.95 * n)::BIGINT) + 1] AS p95 FROM (SELECT event_type, count(value)::BIGINT AS n, list(value ORDER BY value) FILTER (value IS NOT NULL) AS v FROM events GROUP BY event_type)")
def latency_percentiles(spark, sf_dir):
    return evaluation.index_percentiles(_t(spark, sf_dir, "events"), "event_type", "value")


# --- bill and vote fields

_KIND = "CASE o_orderstatus WHEN 'F' THEN 'hr' WHEN 'O' THEN 's' ELSE 'zz' END"
_BILL = f"CASE WHEN o_orderstatus <> 'P' THEN {_KIND} || o_orderkey || '-110' END"


def _orders(spark, sf_dir) -> DataFrame:
    kind = F.when(F.col("o_orderstatus") == "F", "hr").when(F.col("o_orderstatus") == "O", "s").otherwise("zz")
    congress = F.when(F.col("o_orderstatus") != "P", F.lit(110))
    return _t(spark, sf_dir, "orders").withColumn("kind", kind).withColumn("congress", congress).withColumn("bill_id", T.build_bill_id(kind, F.col("o_orderkey"), congress))


@query(f"SELECT o_orderkey, {_BILL} AS bill_id FROM orders")
def bill_id_build(spark, sf_dir):
    return _orders(spark, sf_dir).select("o_orderkey", "bill_id")


@query(f"SELECT o_orderkey, regexp_extract(b, '^([a-z]+)([0-9]+)-([0-9]+)$', 1) AS type, regexp_extract(b, '^([a-z]+)([0-9]+)-([0-9]+)$', 2) AS number, 110 AS congress FROM (SELECT o_orderkey, {_BILL} AS b FROM orders) WHERE b IS NOT NULL")
def bill_id_parse(spark, sf_dir):
    p = T.parse_bill_id(F.col("bill_id"))
    return _orders(spark, sf_dir).select("o_orderkey", p.alias("p")).where("p is not null").select("o_orderkey", "p.type", "p.number", "p.congress")


_STATUS = "CASE o_orderpriority WHEN '1-URGENT' THEN 'ENACTED:SIGNED' WHEN '2-HIGH' THEN 'PASS_OVER:HOUSE' WHEN '3-MEDIUM' THEN 'REPORTED' WHEN '4-NOT SPECIFIED' THEN 'REFERRED' ELSE 'INTRODUCED' END"


@query(f"""SELECT o_orderkey, array_to_string(CASE WHEN len(own) > 0 THEN own ELSE codes END, ',') AS versions FROM (SELECT o_orderkey, codes, list_filter(codes, lambda v: v = 'enr' OR right(v, 1) = c) AS own FROM (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'h' ELSE 's' END AS c, CASE WHEN s LIKE '%ENACTED%' OR s LIKE '%SIGNED%' THEN ['enr', 'eas', 'eah', 'es', 'eh', 'ih', 'is'] WHEN s LIKE '%PASS%' THEN ['es', 'eh', 'eas', 'eah', 'cps', 'cph', 'ih', 'is']
    WHEN s LIKE '%REPORTED%' THEN ['rs', 'rh', 'rds', 'rfh', 'rfs', 'ih', 'is'] WHEN s LIKE '%REFERRED%' THEN ['rfh', 'rfs', 'ih', 'is'] ELSE ['ih', 'is'] END AS codes FROM (SELECT *, {_STATUS} AS s FROM orders)))""")
def version_pick(spark, sf_dir):
    return _orders(spark, sf_dir).select("o_orderkey", F.array_join(T.version_choice(F.expr(_STATUS), F.col("kind")), ",").alias("versions"))


@query(f"""SELECT o_orderkey, 'https://example.org/pkg/BILLS-110' || k || o_orderkey || 'ih/xml/BILLS-110' || k || o_orderkey || 'ih.xml' AS url FROM (SELECT o_orderkey, {_KIND} AS k FROM orders)""")
def url_build(spark, sf_dir):
    return _orders(spark, sf_dir).select("o_orderkey", T.content_url("https://example.org/pkg", F.lit(110), F.col("kind"), F.col("o_orderkey").cast("string"), F.lit("ih")).alias("url"))


@query(f"""SELECT o_orderkey, '[' || CASE k WHEN 'hr' THEN 'H.R.' WHEN 's' THEN 'S.' ELSE upper(k) END || ' ' || o_orderkey || ', 110th Congress]' || CASE WHEN o_orderstatus = 'F' THEN ' Section ' || o_custkey || ': ' || o_orderpriority || ' —' WHEN o_orderstatus = 'O' THEN ' ' || o_orderpriority || ' —' ELSE ' —' END AS prefix FROM (SELECT *, {_KIND} AS k FROM orders)""")
def chunk_prefix(spark, sf_dir):
    enum = F.when(F.col("o_orderstatus") == "F", F.col("o_custkey").cast("string"))
    header = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return _orders(spark, sf_dir).select("o_orderkey", T.chunk_prefix(F.col("kind"), F.col("o_orderkey"), F.lit(110), enum, header).alias("prefix"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey || ' ' || o_orderpriority WHEN o_orderstatus = 'O' THEN o_orderpriority END AS path FROM orders")
def section_path(spark, sf_dir):
    enum = F.when(F.col("o_orderstatus") == "F", F.col("o_custkey").cast("string"))
    return _orders(spark, sf_dir).select("o_orderkey", T.section_path(enum, F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))).alias("path"))


_VOTES = """votes AS (
  SELECT o_orderkey, 'v' || o_orderkey AS vote_id, CASE o_orderstatus WHEN 'F' THEN 'House' WHEN 'O' THEN 'Senate' ELSE 'P' END AS chamber, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderpriority AS category, c_mktsegment AS type,
    c_name AS q, CASE WHEN o_orderstatus = 'F' THEN c_name || ' of  ' || n_name ELSE n_name END AS s0, CASE WHEN o_orderstatus <> 'P' THEN 'Passed' END AS result, {bill} AS bill_id
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
), pairs AS (SELECT *, CASE WHEN starts_with(lower(s), lower(q)) OR starts_with(lower(q), lower(s)) THEN CASE WHEN len(q) >= len(s) THEN q ELSE '' END ELSE q END AS question,
  CASE WHEN starts_with(lower(s), lower(q)) OR starts_with(lower(q), lower(s)) THEN CASE WHEN len(q) >= len(s) THEN '' ELSE s END ELSE s END AS subject FROM (SELECT *, {s} AS s FROM votes))""".format(bill=_BILL, s=_clean("s0"))


def _votes(spark, sf_dir) -> DataFrame:
    nation = F.broadcast(_t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"))  # 25 rows by definition
    who = _t(spark, sf_dir, "customer").join(nation, "c_nationkey").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment", "n_name")
    o = _orders(spark, sf_dir).join(who, "o_custkey")
    return o.select(
        "o_orderkey", F.concat(F.lit("v"), "o_orderkey").alias("vote_id"), F.when(F.col("o_orderstatus") == "F", "h").when(F.col("o_orderstatus") == "O", "s").otherwise("p").alias("chamber"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("date"), F.col("o_orderpriority").alias("category"), F.col("c_mktsegment").alias("type"), F.col("c_name").alias("question"),
        F.when(F.col("o_orderstatus") == "F", F.concat("c_name", F.lit(" of  "), "n_name")).otherwise(F.col("n_name")).alias("subject"), F.when(F.col("o_orderstatus") != "P", "Passed").alias("result"), "bill_id",
    )


@query(f"WITH {_VOTES} SELECT o_orderkey, question, subject FROM pairs")
def vote_pair_dedupe(spark, sf_dir):
    return _votes(spark, sf_dir).select("o_orderkey", T.vote_pair(F.col("question"), F.col("subject")).alias("p")).select("o_orderkey", "p.question", "p.subject")


_VOTE_TEXT = _clean(
    "'[Vote ' || vote_id || ', ' || chamber || ', ' || day || '] ' || category || ': ' || type || chr(10) || concat_ws(chr(10), CASE WHEN question <> '' THEN 'Question: ' || question END, CASE WHEN subject <> '' THEN 'Subject: ' || subject END, 'Result: ' || result, 'Related bill: ' || bill_id)"
)


@query(f"WITH {_VOTES} SELECT o_orderkey, vote_id, text, {_TOKENS.format(w=_words('text'))}::INT AS token_count, 0 AS chunk_index, sha256(lower(text)) AS content_hash, sha256(vote_id || '|0|' || sha256(lower(text))) AS source_hash FROM (SELECT *, {_VOTE_TEXT} AS text FROM pairs)")
def vote_text(spark, sf_dir):
    return chunking.vote_chunks(_votes(spark, sf_dir), 512, 64).select("o_orderkey", "vote_id", "text", "token_count", "chunk_index", "content_hash", "source_hash")


_LONG_PREFIX = "'[Vote v' || doc_id || ', House, 2001-02-03] ' || lang || ': ' || source"


@query(f"""WITH b AS (SELECT doc_id, {_clean(_LONG_PREFIX)} AS p, {_clean("replace(text, '.', ' ')")} AS q FROM documents WHERE text IS NOT NULL),
n AS (SELECT doc_id, p, concat_ws(chr(10), CASE WHEN q <> '' THEN 'Question: ' || q END, 'Result: Passed') AS t FROM b),
x AS (SELECT *, {_words('t')} AS w, greatest(1, 56 - {_TOKENS.format(w=_words('p'))}::INT) AS room, {_clean("p || chr(10) || t")} AS whole FROM n),
c AS (SELECT *, {_TOKENS.format(w=_words('whole'))} <= 64 AS fits, room - least(8, room - 1) AS step FROM x),
i AS (SELECT *, unnest(range(0, CASE WHEN fits OR len(w) <= room THEN 1 ELSE ceil((len(w) - room) / step::DOUBLE)::BIGINT + 1 END)) AS i FROM c)
SELECT doc_id, i::INT AS chunk_index, CASE WHEN fits THEN whole ELSE {_clean("p || chr(10) || array_to_string(w[i * step + 1 : i * step + room], ' ')")} END AS text FROM i""")
def vote_overflow(spark, sf_dir):
    """Votes whose question is a whole document, without full stops: most overflow and are cut into windows."""
    docs = _docs(spark, sf_dir).where("text is not null").select(
        "doc_id", F.concat(F.lit("v"), "doc_id").alias("vote_id"), F.lit("h").alias("chamber"), F.lit("2001-02-03T00:00:00").alias("date"), F.col("lang").alias("category"), F.col("source").alias("type"),
        F.replace("text", F.lit("."), F.lit(" ")).alias("question"), F.lit("").alias("subject"), F.lit("Passed").alias("result"), F.lit("").alias("bill_id"),
    )
    return chunking.vote_chunks(docs, 64, 8).select("doc_id", "chunk_index", "text")


# --- files: suppliers as bills and votes of a scraped tree

_STEM = "'110/bills/hr/hr' || s_suppkey"


def _written(spark, rows: DataFrame) -> str:
    root = folds.shared_dir(spark, "tree")
    files.write_files(rows, root)
    return root


def _suppliers(spark, sf_dir) -> DataFrame:
    return _t(spark, sf_dir, "supplier")


@query("""SELECT 'hr' || s_suppkey || '-110' AS bill_id, 110 AS congress, 'hr' AS type, s_suppkey::VARCHAR AS number, CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE s_name END AS short_title,
  CASE WHEN s_suppkey % 5 = 0 OR s_suppkey % 3 = 0 THEN '' ELSE 'An act of ' || s_name END AS official_title, CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE 'REPORTED' END AS status FROM supplier""")
def bill_tree_scan(spark, sf_dir):
    """A data.json for each bill, some without id and title, some malformed."""
    title = F.expr("CASE WHEN s_suppkey % 3 <> 0 THEN 'An act of ' || s_name END")
    made = F.to_json(F.struct(F.expr("CASE WHEN s_suppkey % 3 <> 0 THEN 'hr' || s_suppkey || '-110' END").alias("bill_id"), F.col("s_name").alias("short_title"), title.alias("official_title"), F.lit("REPORTED").alias("status")))
    content = F.when(F.col("s_suppkey") % 5 == 0, "{ not json").otherwise(made)
    root = _written(spark, _suppliers(spark, sf_dir).select(F.expr(_STEM + " || '/data.json'").alias("path"), content.alias("content")))
    return files.bill_tree(spark, root)


@query("""SELECT 'v' || s_suppkey AS vote_id, 110 AS congress, s_suppkey::INT AS number, 'h' AS chamber, '2007' AS session, CASE WHEN s_suppkey % 4 = 1 THEN '' ELSE s_name END AS question,
  CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE 'On ' || s_name END AS subject, CASE WHEN s_suppkey % 3 <> 0 THEN 'hr' || s_nationkey || '-110' END AS bill_id FROM supplier WHERE s_suppkey % 7 <> 0""")
def vote_tree_scan(spark, sf_dir):
    """A data.json for each vote; those without an id go."""
    bill = F.expr("CASE WHEN s_suppkey % 3 <> 0 THEN named_struct('congress', '110', 'number', string(s_nationkey), 'type', 'HR') END")
    record = F.struct(
        F.expr("CASE WHEN s_suppkey % 7 <> 0 THEN ' v' || s_suppkey || ' ' END").alias("vote_id"), F.lit("h").alias("chamber"), F.lit("110").alias("congress"), F.lit("2007").alias("session"), F.col("s_suppkey").cast("string").alias("number"),
        F.expr("CASE WHEN s_suppkey % 4 <> 1 THEN s_name END").alias("question"), F.expr("CASE WHEN s_suppkey % 2 <> 0 THEN 'On ' || s_name END").alias("subject"), bill.alias("bill"),
    )
    root = _written(spark, _suppliers(spark, sf_dir).select(F.expr("'110/votes/2007/h' || s_suppkey || '/data.json'").alias("path"), F.to_json(record).alias("content")))
    return files.votes(spark, root).select("vote_id", "congress", "number", "chamber", "session", "question", "subject", "bill_id")


_XML = (
    "'<bill bill-stage=\"IH\"><form><legis-num>H. R. ' || s_suppkey || '</legis-num><congress>110th</congress><official-title>An <em>act</em> of ' || s_name || ' .</official-title></form><legis-body>"
    "<section><enum>1.</enum><header>Short title</header><text>Named.</text></section><section><enum>2. </enum><header>Head  of ' || s_name || '</header><text>Body of ' || s_name || ' , yes.</text>"
    "<subsection>a one</subsection><subsection>b two</subsection></section><section><enum>3.</enum><header>Empty</header></section></legis-body></bill>'"
)


def _bill_files(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Sidecars and contents of XML bills; one in six is malformed."""
    s = _suppliers(spark, sf_dir)
    meta = F.to_json(F.struct(F.expr("'hr' || s_suppkey || '-110'").alias("bill_id"), F.lit(110).alias("congress"), F.lit("hr").alias("type"), F.col("s_suppkey").cast("string").alias("number"), F.lit("ih").alias("version"), F.lit("xml").alias("format")))
    content = F.when(F.col("s_suppkey") % 6 == 0, F.concat(F.lit("<bill>broken  "), "s_name")).otherwise(F.expr(_XML))
    rows = s.select(F.expr(_STEM + " || '/text/ih.meta.json'").alias("path"), meta.alias("content")).union(s.select(F.expr(_STEM + " || '/text/ih.xml'"), content))
    root = _written(spark, rows)
    return files.sidecars(spark, root), files.contents(spark, root)


@query("""SELECT 'hr' || s_suppkey || '-110' AS bill_id, s_suppkey % 6 <> 0 AS ok,
  CASE WHEN s_suppkey % 6 <> 0 THEN 'H. R. ' || s_suppkey || ' 110th An act of ' || s_name || '. 1. Short title Named. 2. Head of ' || s_name || ' Body of ' || s_name || ', yes. a one b two 3. Empty' END AS full_text,
  CASE WHEN s_suppkey % 6 <> 0 THEN 'H. R. ' || s_suppkey || ' 110th An act of ' || s_name || ' . 1. Short title Named. 2. Head  of ' || s_name || ' Body of ' || s_name || ' , yes. a one b two 3. Empty' ELSE 'broken ' || s_name END AS hash_text,
  CASE WHEN s_suppkey % 6 <> 0 THEN 'IH' END AS bill_stage, CASE WHEN s_suppkey % 6 <> 0 THEN 'H. R. ' || s_suppkey END AS legis_num, CASE WHEN s_suppkey % 6 <> 0 THEN 'An act of ' || s_name || '.' END AS official_title FROM supplier""")
def xml_documents(spark, sf_dir):
    joined = files.with_content(*_bill_files(spark, sf_dir))
    out = xml.parsed(joined, "bill_id", "content")
    return out.select(F.col("doc_key").alias("bill_id"), "ok", "full_text", "hash_text", "bill_stage", "legis_num", "official_title")


@query("SELECT 'hr' || s_suppkey || '-110' AS bill_id, '2.' AS enum, 'Head of ' || s_name AS header, 'Body of ' || s_name || ', yes. a one b two' AS body_text, 'a one|b two' AS sub_texts FROM supplier WHERE s_suppkey % 6 <> 0")
def xml_sections(spark, sf_dir):
    joined = files.with_content(*_bill_files(spark, sf_dir))
    out = xml.parsed(joined, "bill_id", "content").select(F.col("doc_key").alias("bill_id"), F.explode("sections").alias("s"))
    return out.select("bill_id", "s.enum", "s.header", "s.body_text", F.array_join("s.sub_texts", "|").alias("sub_texts"))


# --- stored rows

_FIELDS = "doc_id::VARCHAR AS bill_id, 110 AS congress, 'hr' AS type, lang AS status, NULLIF(source, 'src1') AS section_header"


def _records(spark, sf_dir) -> DataFrame:
    """Documents as chunk records, with nulls where files have them."""
    docs, null = _docs(spark, sf_dir), F.lit(None).cast("string")
    return docs.select(
        F.col("doc_id").cast("string").alias("bill_id"), F.when(F.col("lang") == "en", F.lit("7")).alias("canonical_bill_id"), F.lit("110").alias("congress"), F.lit("hr").alias("type"), F.col("doc_id").cast("string").alias("number"),
        null.alias("short_title"), F.lit("ih").alias("version"), F.col("lang").alias("status"), F.col("n_chars").cast("string").alias("section_enum"), F.nullif("source", F.lit("src1")).alias("section_header"),
        F.when(F.col("lang") != "de", 3).alias("chunk_index"), F.col("lang").alias("text"), F.lit("x").alias("tokens"), null.alias("document_text_hash"), F.sha2("text", 256).alias("section_text_hash"), F.lit(4).alias("original_chunk_index"),
        F.sha2(F.col("doc_id").cast("string"), 256).alias("source_hash"),
    )


@query("""SELECT sha256(doc_id::VARCHAR) AS source_hash, CASE WHEN lang = 'en' THEN '7' ELSE doc_id::VARCHAR END AS canonical_bill_id, 110 AS congress, doc_id::VARCHAR AS bill_number,
  n_chars || CASE WHEN source <> 'src1' THEN ' ' || source ELSE '' END AS section_path, '' AS title, lang AS body, 0 AS token_count, CASE WHEN lang <> 'de' THEN 3 ELSE 0 END AS chunk_index, CASE WHEN source <> 'src1' THEN source ELSE '' END AS section_header, '' AS document_text_hash FROM documents""")
def chunk_row_projection(spark, sf_dir):
    return rows.chunk_rows(_records(spark, sf_dir), "m").select("source_hash", "canonical_bill_id", "congress", "bill_number", "section_path", "title", "body", "token_count", "chunk_index", "section_header", "document_text_hash")


@query("""SELECT 1.0::DOUBLE AS similarity, 110 AS congress, 'bill' AS source_kind, doc_id::VARCHAR AS bill_id, '' AS vote_id, '' AS title, lang AS status, n_chars::VARCHAR AS section_enum, CASE WHEN source <> 'src1' THEN source ELSE '' END AS section_header, 'hr' AS type, '' AS body FROM documents""")
def hit_projection(spark, sf_dir):
    return rows.hits(_records(spark, sf_dir).withColumn("similarity", F.lit(1.0)), "bill").select("similarity", "congress", "source_kind", "bill_id", "vote_id", "title", "status", "section_enum", "section_header", "type", "body")


@query("""WITH n AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id::VARCHAR) AS rn FROM documents)
SELECT 'chunk-' || lpad(rn::VARCHAR, 9, '0') AS custom_id, (floor((rn - 1) / 300) + 1)::INT AS file, 'h|' || sha256(doc_id::VARCHAR) AS identity, '{"model":"m","input":"' || lang || '","dimensions":8}' AS body FROM n""")
def request_files(spark, sf_dir):
    return rows.request_map(_records(spark, sf_dir), ["bill_id"], 300, "m", 8)


@query("""SELECT doc_id::VARCHAR AS bill_id, CASE WHEN row_number() OVER (ORDER BY doc_id::VARCHAR) % 3 = 0 THEN row_number() OVER (ORDER BY doc_id::VARCHAR) END AS embedding FROM documents""")
def request_results(spark, sf_dir):
    """Results of every third request, merged back by custom id and identity."""
    chunks = _records(spark, sf_dir)
    requests = folds.materialized(rows.request_map(chunks, ["bill_id"], 300, "m", 8))
    n = F.substring("custom_id", 7, 9).cast("bigint")
    results = requests.where(n % 3 == 0).select("custom_id", n.alias("embedding"))
    return rows.merge_results(chunks, requests, results).select("bill_id", "embedding")


# --- aggregates


@query("SELECT source, lang, grouping(source, lang)::INT AS level, count(*)::BIGINT AS n_chunks, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY ROLLUP (source, lang)")
def congress_totals(spark, sf_dir):
    """Totals by congress and type, by congress, and over all."""
    out = _docs(spark, sf_dir).rollup("source", "lang").agg(F.grouping_id().cast("int").alias("level"), F.count("*").alias("n_chunks"), F.sum("n_chars").alias("chars"))
    return out.select("source", "lang", "level", "n_chunks", "chars")


@query("SELECT min(d) AS date_from, max(d) AS date_to FROM (SELECT nullif(trim(strftime(ts, '%Y-%m-%dT%H:%M:%S')), '') AS d FROM events)")
def date_bounds_all(spark, sf_dir):
    d = F.nullif(F.trim(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")), F.lit(""))
    return _t(spark, sf_dir, "events").select(d.alias("d")).agg(F.min("d").alias("date_from"), F.max("d").alias("date_to"))


@query("SELECT source, (count(*) FILTER (doc_id NOT IN (SELECT doc_id FROM labels)))::BIGINT AS to_embed, count(*)::BIGINT AS total FROM documents GROUP BY source")
def manifest_missing(spark, sf_dir):
    """Missing and all chunks by congress, from a manifest that holds an array of shards per congress."""
    have = _t(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("_have")).distinct()
    shards = _docs(spark, sf_dir).join(have, "doc_id", "left").groupBy("source", "lang").agg(F.count_if(F.col("_have").isNull()).alias("to_embed"), F.count("*").alias("total"))
    manifest = shards.groupBy("source").agg(F.collect_list(F.struct("to_embed", "total")).alias("shards"))  # at most one per language
    return manifest.select("source", F.explode("shards").alias("s")).groupBy("source").agg(F.sum("s.to_embed").alias("to_embed"), F.sum("s.total").alias("total"))


@query("SELECT source AS name, false AS ok FROM documents GROUP BY source HAVING sum(n_chars) > 70000")
def invariant_violations(spark, sf_dir):
    checks = _docs(spark, sf_dir).groupBy(F.col("source").alias("name")).agg((F.sum("n_chars") <= 70000).alias("ok"))
    return state.violations(checks)



@query("SELECT event_type, min(d) AS date_from, max(d) AS date_to FROM (SELECT event_type, nullif(trim(strftime(ts, '%Y-%m-%dT%H:%M:%S')), '') AS d FROM events) GROUP BY event_type")
def date_bounds(spark, sf_dir):
    d = F.nullif(F.trim(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")), F.lit(""))
    return _t(spark, sf_dir, "events").select("event_type", d.alias("d")).groupBy("event_type").agg(F.min("d").alias("date_from"), F.max("d").alias("date_to"))


@query("SELECT event_type, count(*)::BIGINT AS n FROM events GROUP BY event_type")
def status_counts(spark, sf_dir):
    return _t(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT source, count(*)::BIGINT AS n_chunks, count(DISTINCT lang)::BIGINT AS n_langs, max(n_chars) AS longest FROM documents GROUP BY source")
def monitor_rollup(spark, sf_dir):
    return _docs(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n_chunks"), F.count_distinct("lang").alias("n_langs"), F.max("n_chars").alias("longest"))


@query(f"SELECT source, m AS mode, sum(t)::BIGINT AS tokens, round(sum(t) / 1000000.0::DOUBLE * p, 9) AS cost FROM (SELECT source, {_TOKENS.format(w=_words('text'))}::BIGINT AS t FROM documents), (VALUES ('online', 0.02::DOUBLE), ('batch', 0.01::DOUBLE)) AS x(m, p) GROUP BY source, m, p")
def cost_estimate(spark, sf_dir):
    tokens = _docs(spark, sf_dir).select("source", T.token_count(F.col("text")).cast("bigint").alias("t")).groupBy("source").agg(F.sum("t").alias("tokens"))
    prices = F.array(F.struct(F.lit("online").alias("mode"), F.lit(0.02).alias("p")), F.struct(F.lit("batch").alias("mode"), F.lit(0.01).alias("p")))
    return tokens.select("source", "tokens", F.explode(prices).alias("x")).select("source", "x.mode", "tokens", F.round(F.col("tokens") / F.lit(1000000.0) * F.col("x.p"), 9).alias("cost"))


@query("""SELECT doc_id, CASE WHEN contains(t, 'license') OR contains(t, 'public') THEN 0 WHEN contains(t, 'water') THEN 1 END::INT AS axis FROM (SELECT doc_id, lower(text) AS t FROM documents)""")
def axis_embedding(spark, sf_dir):
    v = V.axis_embedding(F.col("text"), [("license", "public"), ("water",)], 8)
    at = F.array_position(v, 1.0)
    return _docs(spark, sf_dir).select("doc_id", F.when(at > 0, (at - 1).cast("int")).alias("axis"))


_CHAIN = ", ".join(f"sha256(unhex(d{k})) AS d{k + 1}" for k in range(1, 8))


@query(f"""WITH h AS (SELECT doc_id, sha256({_hash('text')}) AS d1 FROM documents WHERE text IS NOT NULL), c AS (SELECT doc_id, d1, {_CHAIN} FROM h),
v AS (SELECT doc_id, i, (x - CASE WHEN x >= 2147483648 THEN 4294967296 ELSE 0 END) / 2147483648.0::DOUBLE AS v FROM (SELECT doc_id, i, ('0x' || substr(d1 || d2 || d3 || d4 || d5 || d6 || d7 || d8, i * 8 + 1, 8))::BIGINT AS x FROM c, range(0, 64) AS r(i)))
SELECT doc_id, i::INT AS i, round(v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)), 6) AS value FROM v""")
def fake_embedding_values(spark, sf_dir):
    """Each value of the digest embedding of each document."""
    rows = _docs(spark, sf_dir).where("text is not null").select("doc_id", V.hash_embedding_udf(64)(T.text_hash(F.col("text"))).alias("e"))
    return rows.select("doc_id", F.posexplode("e").alias("i", "value")).withColumn("value", F.round("value", 6))


@query()
def fake_embedding(spark, sf_dir):
    """The same as arrays. Tested against a plain implementation."""
    rows = _docs(spark, sf_dir).select("doc_id", T.text_hash(F.col("text")).alias("source_hash"))
    return rows.withColumn("embedding", V.hash_embedding_udf(64)(F.col("source_hash")))


@query()
def chunk_sections(spark, sf_dir):
    """Chunks of the documents' lines as sections with prefix, over-long ones cut at sentences. No SQL: Arrow function."""
    prefix = T.chunk_prefix(F.lit("hr"), F.col("doc_id"), F.lit(110), F.col("section_enum").cast("string"), F.lit(""))
    none = F.array().cast("array<string>")
    rows = _sections(spark, sf_dir).withColumn("c", F.explode(chunking.section_chunk_udf(96, 16)(prefix, F.col("body_text"), none)))
    return rows.select("doc_id", "section_enum", "section_text_hash", "c.chunk_index", "c.text", "c.tokens")


@query("SELECT event_id, user_id, event_type, sha256(event_id::VARCHAR) AS _digest FROM events")
def incremental_stream(spark, sf_dir):
    """Takes the event files as a stream of what is available, and returns the merged snapshot."""
    out = folds.shared_dir(spark, "stream")
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    folder, glob = (path, "*.parquet") if os.path.isdir(path) else (sf_dir, "events.parquet")
    stream = incremental.stream_files(spark, folder, schema, glob).select("event_id", "user_id", "event_type", F.col("event_id").alias("_v"))
    incremental.run_available(stream, out, "event_id", "_v")
    return incremental.snapshot(spark, out, "event_id").drop("_v")
