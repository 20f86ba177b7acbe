"""Command line: ``python -m folioscope COMMAND ...``; each command is one or two calls of the library."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .functions import text as T
from .functions.vectors import hash_embedding
from .operators import documents, embedding, evaluation, packing, rows, search, state
from .operators.chunking import vote_chunks
from .sources import files, xml


def session(name: str) -> SparkSession:
    return SparkSession.builder.appName(name).config("spark.sql.adaptive.enabled", "true").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _bills(spark: SparkSession, a) -> DataFrame:
    meta = files.sidecars(spark, a.root)
    if a.congresses:
        meta = meta.where(F.col("congress").isin(a.congresses))
    if getattr(a, "bill_ids_file", None):
        meta = files.pruned_scan(meta, files.id_list(spark, a.bill_ids_file))
    return files.with_content(meta, files.contents(spark, a.root))


def hash_(spark: SparkSession, a) -> int:
    """Exit 0: something changed; 1: nothing; an unreadable root is an error of its own."""
    joined = _bills(spark, a)
    is_xml = F.col("format") == "xml"
    parsed = xml.parsed(joined.where(is_xml), "bill_id", "content").select(F.col("doc_key").alias("bill_id"), "hash_text")
    other = joined.where(~is_xml).select("bill_id", T.tags_spaced(F.decode("content", "UTF-8")).alias("hash_text"))
    now = parsed.unionByName(other).select("bill_id", T.raw_hash(F.col("hash_text")).alias("digest"))
    root = f"{a.out}/manifest"
    was = files.current(spark, root) if a.has_previous else now.limit(0)
    changes = state.detect_changes(now, was, "bill_id", "digest")
    files.write_snapshot(now, root, a.run_id)
    changes.where("status in ('new', 'modified')").select("bill_id").write.mode("overwrite").json(f"{a.out}/changed")
    summary = state.change_summary(changes).first().asDict()
    print(json.dumps(summary))
    return 0 if summary["changed_count"] or summary["deleted_count"] else 1


def chunk(spark: SparkSession, a) -> int:
    out = documents.process(_bills(spark, a), a.max_tokens, a.overlap, a.min_tokens, a.max_chunks_per_bill, a.tail, a.tokenizer)
    counts = out.groupBy("congress", "canonical_bill_id").agg(F.count("*").alias("n_chunks"))
    shards = packing.greedy_shards(counts, "congress", ["canonical_bill_id"], "canonical_bill_id", "n_chunks", a.shard_bills, a.shard_chunks)
    sharded = out.join(shards.drop("n_chunks"), ["congress", "canonical_bill_id"])
    if a.dry_run:
        packing.shard_manifest(shards, ["congress"], "canonical_bill_id", "n_chunks", ["canonical_bill_id"]).show(50, False)
    else:
        files.write_shards(sharded, a.out)
    return 0


def votes(spark: SparkSession, a) -> int:
    v = files.votes(spark, a.root)
    v = v.where(F.col("congress").isin(a.congresses)) if a.congresses else v
    out = packing.fixed_shards(vote_chunks(v, a.max_tokens, a.overlap), ["congress"], ["date", "session", "chamber", "number", "vote_id", "chunk_index"], a.shard_size)
    files.write_shards(out, a.out)
    return 0


def embed(spark: SparkSession, a) -> int:
    chunks = spark.read.schema(schemas.CHUNK).option("recursiveFileLookup", True).json(a.root)
    done = spark.read.parquet(a.out).select("source_hash") if a.has_previous else chunks.select("source_hash").limit(0)
    todo = embedding.pending(chunks, done, ["source_hash"])
    if a.dry_run:
        todo.agg(F.count("*").alias("chunks"), F.sum("tokens").alias("tokens")).show()
        return 0
    rounds = -(-todo.count() // a.checkpoint_every) if a.checkpoint_every > 0 else 1
    embedding.embed_in_rounds(todo, "source_hash", "text", embedding.hash_embedder(a.dimensions), a.out, rounds, "hash", a.batch_size)
    return 0


def upsert(spark: SparkSession, a) -> int:
    """Loads embedded chunks into the next snapshot: bills by counts of rows, votes by vote; refuses incomplete ones."""
    chunks = spark.read.schema(schemas.CHUNK if a.mode == "bills" else schemas.VOTE_CHUNK).option("recursiveFileLookup", True).json(a.root)
    vectors = spark.read.parquet(a.embeddings).select("source_hash", "embedding")
    staged = chunks.join(vectors, "source_hash", "left")
    bad = state.validate_embedded(staged, "source_hash", "embedding", a.dimensions).first().asDict()
    if any(bad.values()):
        raise ValueError(f"the staged rows are incomplete: {bad}")
    staged = rows.chunk_rows(staged, a.model) if a.mode == "bills" else rows.vote_rows(staged, a.model)
    live = files.current(spark, a.out) if a.has_previous else staged.limit(0)
    if a.mode == "bills":
        update = [c for c in staged.columns if c not in ("source_hash", "canonical_bill_id")]
        new = state.upsert_snapshot(staged, live, "canonical_bill_id", "source_hash", update)
    else:
        new = state.replace_by_key(staged, live, "vote_id")
    if a.dry_run:
        (state.upsert_by_count(staged, live, "canonical_bill_id").groupBy("strategy").count() if a.mode == "bills" else staged.groupBy("congress").count()).show()
        return 0
    files.write_snapshot(new, a.out, a.run_id)
    written = spark.read.parquet(f"{a.out}/{a.run_id}")
    totals = written.agg(F.count("*").alias("n"), F.count("embedding").alias("e")).first()
    state.require_counts(totals["n"], totals["e"], "embeddings of the snapshot")
    found = written.join(staged.select("source_hash").distinct(), "source_hash", "left_semi").select("source_hash").distinct().count()
    state.require_counts(staged.select("source_hash").distinct().count(), found, "staged rows in the snapshot")
    files.promote(spark, a.out, a.run_id)
    return 0


def reconcile(spark: SparkSession, a) -> int:
    desired = documents.with_source_hash(files.desired_state(spark, a.desired)).withColumn("bill_uid", F.coalesce("canonical_bill_id", "bill_id"))
    actual = files.current(spark, a.out) if a.has_previous else desired.limit(0).withColumn("embedding", F.array().cast("array<float>"))
    plan = state.reconcile_plan(desired, actual)
    state.guard_deletes(plan, a.max_delete_frac)
    if a.dry_run:
        plan.groupBy("action").count().show()
        return 0
    todo = embedding.pending(desired, actual.select("bill_uid", "source_hash"), ["bill_uid", "source_hash"]).dropDuplicates(["source_hash"])
    new = embedding.embed_rows(todo, "source_hash", "source_hash", embedding.hash_embedder(a.dimensions), 128)
    files.write_snapshot(state.reconcile_apply(desired, actual, new).drop("origin"), a.out, a.run_id, "congress")
    trees = (state.manifest_tree(d.withColumn("_all", F.lit(1)), "_all", "source_hash") for d in (desired, spark.read.parquet(f"{a.out}/{a.run_id}")))
    if state.manifest_mismatches(*trees, "_all").limit(1).count():
        raise ValueError("the written snapshot does not match the desired manifest; not promoted")
    files.promote(spark, a.out, a.run_id)
    return 0


def query(spark: SparkSession, a) -> int:
    q = hash_embedding(a.query, a.dimensions)
    found = []
    for kind, path in (("bill", a.bills), ("vote", a.votes)):
        if path and a.index in (kind + "s", "both"):
            df = spark.read.parquet(path)
            found.append((kind, df.where(F.col("congress").between(a.congress_min, a.congress_max))))
    hits = search.merged([(k, d.select("*", F.coalesce(F.col("source_hash"), F.lit("")).alias("_key"))) for k, d in found], q, a.top_k, "_key")
    shown = rows.hits(hits.withColumnRenamed("source_kind", "_kind"), "bill")
    for r in shown.select(T.hit_line(F.col("similarity"), F.col("bill_id"), F.col("section_enum"), F.col("section_header"), F.col("title"), F.col("body"), a.snippet_len).alias("line")).collect():
        print(r["line"], "\n")
    return 0


def evaluate(spark: SparkSession, a) -> int:
    queries = files.eval_set(spark, a.eval_set, a.only_fixtures)
    stated = {k: r for k, r in enumerate(queries.collect())}  # a file of stated queries
    df = spark.read.parquet(a.bills)
    ranked = None
    for k, r in stated.items():
        top = search.overfetch_groups(df, hash_embedding(r["query"], a.dimensions), a.k, "bill_id", "chunk_index")
        part = search.ranked_hits(top, [F.desc("similarity"), F.col("bill_id")]).select(F.lit(k).alias("query_id"), F.col("bill_id").alias("item"), (F.col("rank") + 1).alias("rank"))
        ranked = part if ranked is None else ranked.unionByName(part)
    expected = spark.createDataFrame([(k, b) for k, r in stated.items() for b in r["expected_bill_ids"]], "query_id int, item string")
    category = spark.createDataFrame([(k, r["category"]) for k, r in stated.items()], "query_id int, category string")
    evaluation.by_category(evaluation.metrics(ranked, expected, a.k, "item").join(category, "query_id"), "category").show(100, False)
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="folioscope")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name, f, *options):
        c = sub.add_parser(name, help=f.__doc__)
        c.set_defaults(run=f)
        for flag, kw in options:
            c.add_argument(flag, **kw)

    root, out = ("--root", {"required": True}), ("--out", {"required": True})
    congresses = ("--congresses", {"type": int, "nargs": "*", "default": []})
    dry, run_id, previous = ("--dry-run", {"action": "store_true"}), ("--run-id", {"required": True}), ("--has-previous", {"action": "store_true"})
    size = lambda tokens=512, overlap=64: [("--max-tokens", {"type": int, "default": tokens}), ("--overlap", {"type": int, "default": overlap})]
    dims = ("--dimensions", {"type": int, "default": 1536})
    command("hash", hash_, root, out, congresses, run_id, previous)
    command("chunk", chunk, root, out, congresses, dry, *size(), ("--min-tokens", {"type": int, "default": 30}), ("--max-chunks-per-bill", {"type": int, "default": 200}), ("--shard-bills", {"type": int, "default": 500}), ("--shard-chunks", {"type": int, "default": 40_000}), ("--bill-ids-file", {}), ("--tokenizer", {}), ("--tail", {"choices": ["clean", "parity"], "default": "clean"}))
    command("votes", votes, root, out, congresses, *size(), ("--shard-size", {"type": int, "default": 2000}))
    command("embed", embed, root, out, dry, previous, dims, ("--batch-size", {"type": int, "default": 500}), ("--checkpoint-every", {"type": int, "default": 0}))
    command("upsert", upsert, ("--mode", {"choices": ["bills", "votes"], "default": "bills"}), root, ("--embeddings", {"required": True}), out, run_id, dry, previous, dims, ("--model", {"default": "hash"}))
    command("reconcile", reconcile, ("--desired", {"required": True}), out, run_id, dry, previous, dims, ("--max-delete-frac", {"type": float, "default": 0.2}))
    command("query", query, ("query", {}), ("--bills", {}), ("--votes", {}), ("--index", {"choices": ["bills", "votes", "both"], "default": "both"}), ("--top-k", {"type": int, "default": 5}), ("--congress-min", {"type": int, "default": 0}), ("--congress-max", {"type": int, "default": 999}), ("--snippet-len", {"type": int, "default": 400}), dims)
    command("eval", evaluate, ("--eval-set", {"required": True}), ("--bills", {"required": True}), ("--k", {"type": int, "default": 10}), ("--only-fixtures", {"action": "store_true"}), dims)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    return a.run(session("folioscope-" + a.command), a)


if __name__ == "__main__":
    raise SystemExit(main())
