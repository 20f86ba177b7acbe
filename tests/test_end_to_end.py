"""Raw files to chunks, embeddings, a reconciled snapshot, queries and metrics, through the command line."""

import json
import os

import pytest
from pyspark.sql import functions as F

from folioscope import __main__ as cli
from folioscope.operators import documents, embedding, rows, search, state
from folioscope.sources import files


def put(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(content if isinstance(content, bytes) else json.dumps(content).encode())


def bill(body):
    return f"<bill><section><enum>1.</enum><header>Purpose</header><text>{body}</text></section></bill>".encode()


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    body = "word " * 60
    for kind, n, version, content in (("hr", 1, "ih", bill(body)), ("s", 2, "enr", bill(body)), ("hr", 3, "ih", bill("other " * 900 + ". ")), ("hr", 4, "ih", b"<broken")):
        stem = f"{root}/bills_119/{kind}{n}"
        put(stem + ".meta.json", {"bill_id": f"{kind}{n}-119", "congress": 119, "type": kind, "number": str(n), "version": version, "format": "xml", "short_title": "T", "status": "S", "bytes": 1})
        put(stem + ".xml", content)
    put(f"{root}/bills_119/hr5.meta.json", {"bill_id": "hr5-119", "congress": 119, "type": "hr", "number": "5", "version": "ih", "format": "html", "short_title": "", "status": ""})
    put(f"{root}/bills_119/hr5.htm", ("<pre>SECTION 1. Aim\n" + "html text here " * 20 + "\nSEC. 2. Definitions\nskip\n</pre>").encode())
    return root


def test_chunk_stage(spark, root):
    joined = files.with_content(files.sidecars(spark, root), files.contents(spark, root))
    docs = documents.load(joined)
    assert {r["bill_id"] for r in docs.collect()} == {"hr1-119", "s2-119", "hr3-119", "hr5-119"}
    canon = documents.canonical_documents(docs)
    assert {(r["bill_id"], r["n_duplicates"]) for r in canon.collect()} == {("s2-119", 1), ("hr3-119", 0), ("hr5-119", 0)}
    assert documents.document_aliases(docs).count() == 4
    out = documents.process(joined, most=200, overlap=20, cap=3).collect()
    by = {b: [r for r in out if r["bill_id"] == b] for b in {r["bill_id"] for r in out}}
    assert set(by) == {"s2-119", "hr3-119", "hr5-119"} and len(by["hr3-119"]) == 3
    assert by["s2-119"][0]["text"].startswith("[S. 2, 119th Congress] Section 1: Purpose — word")
    assert sorted(r["chunk_index"] for r in by["hr3-119"]) == [0, 1, 2] and len({r["source_hash"] for r in out}) == len(out)


def test_commands(spark, root, tmp_path, capsys):
    t = str(tmp_path)
    assert cli.main(["hash", "--root", root, "--out", t, "--run-id", "a"]) == 0
    files.promote(spark, f"{t}/manifest", "a")
    assert cli.main(["hash", "--root", root, "--out", t, "--run-id", "b", "--has-previous"]) == 1
    assert cli.main(["chunk", "--root", root, "--out", f"{t}/chunks", "--max-tokens", "200", "--overlap", "20"]) == 0
    n = spark.read.option("recursiveFileLookup", True).json(f"{t}/chunks").count()
    assert n > 5
    assert cli.main(["embed", "--root", f"{t}/chunks", "--out", f"{t}/vectors", "--dimensions", "8"]) == 0
    assert cli.main(["embed", "--root", f"{t}/chunks", "--out", f"{t}/vectors", "--dimensions", "8", "--has-previous"]) == 0
    assert spark.read.parquet(f"{t}/vectors").count() == n
    load = ["upsert", "--root", f"{t}/chunks", "--embeddings", f"{t}/vectors", "--out", f"{t}/loaded", "--dimensions", "8"]
    assert cli.main([*load, "--run-id", "u1", "--dry-run"]) == 0 and "replace" in capsys.readouterr().out
    assert cli.main([*load, "--run-id", "u1"]) == 0 and cli.main([*load, "--run-id", "u2", "--has-previous"]) == 0
    loaded = files.current(spark, f"{t}/loaded")
    assert loaded.count() == n and loaded.where("size(embedding) = 8 and model = 'hash'").count() == n
    with pytest.raises(ValueError, match="incomplete"):
        cli.main([*load[:-1], "9", "--run-id", "u3"])
    chunks = [json.loads(x) for x in spark.read.option("recursiveFileLookup", True).text(f"{t}/chunks").toPandas()["value"]]
    for c in chunks:
        c["congress"] = 119
    put(f"{t}/desired.json", chunks)
    go = ["reconcile", "--desired", f"{t}/desired.json", "--out", f"{t}/table", "--dimensions", "8"]
    assert cli.main([*go, "--run-id", "r1"]) == 0 and cli.main([*go, "--run-id", "r2", "--has-previous"]) == 0
    table = files.current(spark, f"{t}/table")
    assert table.count() == n and table.where("size(embedding) = 8").count() == n
    stored = rows.chunk_rows(table.withColumn("embedding", F.col("embedding")), "hash")
    stored.write.parquet(f"{t}/bills")
    assert cli.main(["query", "anything", "--bills", f"{t}/bills", "--index", "bills", "--dimensions", "8", "--top-k", "2"]) == 0
    assert capsys.readouterr().out.count("§") >= 2
    put(f"{t}/eval.json", {"queries": [{"id": "q", "category": "c", "query": "x", "expected_bill_ids": ["hr3-119"], "fixture": True}]})
    assert cli.main(["eval", "--eval-set", f"{t}/eval.json", "--bills", f"{t}/bills", "--dimensions", "8"]) == 0
    assert "OVERALL" in capsys.readouterr().out


def test_a_partial_scrape_is_refused(spark, tmp_path):
    t = str(tmp_path)
    many = [{"bill_id": f"hr{k}-119", "congress": 119, "chunk_index": 0, "text": "x", "tokens": 1, "document_text_hash": str(k), "section_text_hash": "s"} for k in range(10)]
    put(f"{t}/all.json", many)
    put(f"{t}/few.json", many[:5])
    go = ["--out", f"{t}/table", "--dimensions", "4"]
    cli.main(["reconcile", "--desired", f"{t}/all.json", *go, "--run-id", "a"])
    with pytest.raises(ValueError, match="deletes 5 of 10"):
        cli.main(["reconcile", "--desired", f"{t}/few.json", *go, "--run-id", "b", "--has-previous"])


def test_votes_command(spark, tmp_path):
    t = str(tmp_path)
    for k in range(5):
        put(f"{t}/data/119/votes/2024/h{k}/data.json", {"vote_id": f"h{k}", "congress": 119, "number": k, "date": f"2024-01-0{k + 1}", "chamber": "h", "question": "Q", "result": "Passed"})
    assert cli.main(["votes", "--root", f"{t}/data", "--out", f"{t}/out", "--shard-size", "2"]) == 0
    got = spark.read.json(f"{t}/out")
    assert got.count() == 5 and got.select("shard_id").distinct().count() == 3
    stored = rows.vote_rows(got.withColumn("bill_id", F.lit("")), "m")
    assert stored.where("bill_id is null and vote_date is not null").count() == 5


def test_embedding_halves_and_retries():
    calls = []

    def embed(texts):
        calls.append(len(texts))
        if len(texts) > 2:
            raise embedding.TooLarge
        if len(calls) == 4:
            raise embedding.Retryable
        return [[1.0]] * len(texts)

    assert embedding.embed_batch(embed, list("abcdefg"), wait=0) == [[1.0]] * 7
    with pytest.raises(embedding.TooLarge):
        embedding.embed_batch(lambda t: (_ for _ in ()).throw(embedding.TooLarge()), ["a"])


def test_requests_merge_back(spark):
    df = spark.createDataFrame([(f"h{k}", "d", "s", k, "b", "1", f"t{k}") for k in range(5)], "source_hash string, document_text_hash string, section_text_hash string, chunk_index int, bill_id string, section_enum string, text string")
    req = rows.request_map(df, ["source_hash"], 2, "m", 3)
    assert {(r["custom_id"], r["file"]) for r in req.collect()} == {(f"chunk-{k + 1:09d}", k // 2 + 1) for k in range(5)}
    results = req.where("file < 3").select("custom_id", F.array(F.lit(1.0)).alias("embedding"))
    assert rows.merge_results(df, req, results).where("embedding is not null").count() == 4


def test_audit(spark):
    a = rows.audit_event(spark, "r1", "running", model="m", counts={"n": 1}).unionByName(rows.audit_event(spark, "r2", "running"))
    a = a.unionByName(rows.audit_event(spark, "r2", "success").withColumn("at", F.current_timestamp() + F.expr("interval 1 second")))
    assert [r["run_id"] for r in rows.superseded(a, "r3").collect()] == ["r1"]
    assert {r["run_id"]: r["status"] for r in state.latest(a, "run_id", ["at"], ["status"]).collect()} == {"r1": "running", "r2": "success"}


def test_hits_within_groups_and_details(spark):
    e = spark.createDataFrame([(k, k % 2, [1.0, float(k)]) for k in range(6)], "id int, bill int, embedding array<double>")
    top = search.top_k(e, [1.0, 0.0], 1, "id")
    assert {(r["bill"], r["id"]) for r in search.within_groups(e, top, [1.0, 0.0], 2, "bill", "id").collect()} == {(0, 0), (0, 2)}
    details = spark.createDataFrame([(1, "x")], "id int, name string")
    assert [r["name"] for r in search.hydrated(top, details, "id").collect()] == [None]
    rows.require_columns(e, "id int, bill int")
    with pytest.raises(ValueError):
        rows.require_columns(e, "id string")
    assert not rows.table_exists(spark, "no_such_table")
    unified = rows.hits(top.withColumn("congress", F.lit(119)), "bill").unionByName(rows.hits(top.withColumn("vote_id", F.lit("v")), "vote"))
    assert {(r["source_kind"], r["congress"], r["vote_id"]) for r in unified.collect()} == {("bill", 119, ""), ("vote", 0, "v")}


def test_errors_are_classified():
    for said, kind in (
        ("HTTP 429", embedding.Retryable), ("Rate limit reached", embedding.Retryable), ("Connection reset by peer", embedding.Retryable), ("max_tokens_per_request", embedding.TooLarge),
        ("Requested 400000 tokens, max 300000", embedding.TooLarge), ("bad key", RuntimeError),
    ):
        assert type(embedding.classified(RuntimeError(said))) is kind
    assert type(embedding.classified(TimeoutError("x"))) is embedding.Retryable
    calls = []

    def embed(texts):
        calls.append(len(texts))
        if len(texts) > 2:
            raise RuntimeError("max tokens per request")
        if len(calls) == 3:
            raise ConnectionError("connection error")
        return [[1.0]] * len(texts)

    assert embedding.embed_batch(embedding.checked(embed), list("abcd"), wait=0) == [[1.0]] * 4
    assert embedding.query_vector("q", lambda: lambda texts: [[float(len(texts[0]))]], "search: ") == [9.0]


def test_embedding_in_rounds_can_be_repeated(spark, tmp_path):
    out = f"file://{tmp_path}/v"
    todo = spark.createDataFrame([(f"h{k}", "t") for k in range(40)], "source_hash string, text string")
    done = []

    def make():
        return lambda texts: [[1.0]] * len(texts)

    embedding.embed_in_rounds(todo.where("source_hash < 'h2'"), "source_hash", "text", make, out, 3, "m")
    have = spark.read.parquet(out)
    done.append(have.count())
    embedding.embed_in_rounds(embedding.pending(todo, have, ["source_hash"]), "source_hash", "text", make, out, 2, "m")
    rows_ = spark.read.parquet(out).collect()
    assert 0 < done[0] < 40 and len(rows_) == 40 and len({r["source_hash"] for r in rows_}) == 40


def test_tokens_of_a_library_file(spark):
    pytest.importorskip("public_tokenizers")
    import public_tokenizers
    from tokenizers import Tokenizer

    from folioscope.operators import chunking

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    size = lambda t: max(1, len(library.encode(t, add_special_tokens=False).ids))
    texts = ["", "Hello, wörld. " * 40, "a  b\n\nc", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(chunking.token_count_udf(path)("t").alias("n")).collect()
    assert [r["n"] for r in got] == [size(t or "") for t in texts]
    body = " ".join(f"Sentence number {k} is here." for k in range(60))
    df = spark.createDataFrame([("[P]", body, []), ("[P]", body, [" ".join(body.split()[k : k + 70]) for k in range(0, 300, 70)]), ("[P]", "short", [])], "p string, b string, s array<string>")
    for r, b in zip(df.select(chunking.section_chunk_udf(100, 10, tokenizer=path)("p", "b", "s").alias("c")).collect(), (body, body, "short")):
        pieces = [x["text"] for x in r["c"]]
        assert all(x["tokens"] == size(x["text"]) <= 101 for x in r["c"]) and pieces[0].startswith("[P]")
        assert all(w in " ".join(pieces) for w in b.split())
    windows = chunking.sentence_windows(body, 100, 10, units=chunking.codec(path))
    assert all(w.endswith(".") for _, w in windows) and len(windows) > 3


def test_a_tree_shows_where_manifests_differ(spark):
    a = spark.createDataFrame([("c", f"{k:02x}" + "0" * 62) for k in range(20)], "k string, h string")
    b = a.where("h not like '05%'").union(spark.createDataFrame([("c", "07" + "1" * 62), ("d", "00" * 32)], "k string, h string"))
    trees = [state.manifest_tree(x, "k", "h") for x in (a, b)]
    assert {tuple(r) for r in state.manifest_mismatches(*trees, "k").collect()} == {("c", "05"), ("c", "07"), ("d", "00")}
    assert state.manifest_mismatches(trees[0], trees[0], "k").count() == 0
    with pytest.raises(ValueError):
        state.require_counts(1, 2, "x")
