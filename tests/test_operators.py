import random

import pytest
from pyspark.sql import functions as F

from folioscope.functions import text as T
from folioscope.operators import chunking, dedup, evaluation, folds, packing, search, state


def plain_windows(text, most, overlap, parity):
    w, out, start = text.split(), [], 0
    if len(w) <= most:
        return [text]
    while start < len(w):
        end = min(start + most, len(w))
        piece = " ".join(w[start:end])
        if end < len(w) and (at := piece.rfind(". ")) > len(piece) // 2:
            piece = piece[: at + 1]
            end = start + len(piece.split())
        out.append(piece.strip())
        if end == len(w) and not parity:
            break
        start = max(end - overlap, start + 1)
    return out


def test_sentence_windows():
    rng = random.Random(1)
    for _ in range(200):
        text = " ".join(rng.choice(["a", "bb.", "ccc", "d,"]) for _ in range(rng.randint(0, 60)))
        for parity in (False, True):
            assert [p for _, p in chunking.sentence_windows(text, 10, 3, "parity" if parity else "clean")] == plain_windows(text, 10, 3, parity)


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 17, 18, 40])
@pytest.mark.parametrize("tail", ["clean", "parity"])
def test_sliding_windows_native(spark, n, tail):
    text = " ".join(f"w{k}" for k in range(n))
    got = spark.createDataFrame([(text,)], "t string").select(chunking.sliding_windows(F.col("t"), 10, 3, tail).alias("x")).first()["x"]
    assert [r["text"] for r in got] == plain_windows(text, 10, 3, tail == "parity")


def test_section_chunks_keep_limits_and_prefix():
    subs = [" ".join("w" * 20) for _ in range(6)]
    whole = chunking.section_chunks("[p]", "short", [], 50, 8)
    assert whole == [("[p] short", 1)]
    packed = chunking.section_chunks("[p]", " ".join(subs), subs, 50, 8)
    assert all(t.startswith("[p]") and n <= 50 for t, n in packed) and len(packed) == 2
    assert chunking.section_chunks("[p]", "", [], 50, 8) == []
    slid = chunking.section_chunks("[p]", " ".join("w" * 300), [], 50, 8)
    assert slid[0][0].startswith("[p]") and not slid[1][0].startswith("[p]")
    lead = chunking.section_chunks("[p]", "lead in " + " ".join(subs), subs, 50, 8, keep_lead=True)
    assert "lead in" in lead[0][0]


def test_numbered_sections(spark):
    text = "preamble\nSECTION 1. Short title.\nx\nSEC. 2A. Purpose\n body  one\nmore\nsec. 3. Empty\n\n"
    got = spark.createDataFrame([(text,), ("tiny",), ("x" * 60,)], "t string").select(chunking.numbered_sections(F.col("t")).alias("s")).collect()
    assert [tuple(s) for s in got[0]["s"]] == [("2A", "Purpose", "body one more")]
    assert got[1]["s"] == [] and [tuple(s) for s in got[2]["s"]] == [("", "", "x" * 60)]


def test_vote_chunks_repeat_the_prefix(spark):
    row = ("v1", "h", "2024-01-01", "passage", "vote", "word " * 200, "", "Passed", "hr1-1")
    votes = spark.createDataFrame([row], "vote_id string, chamber string, date string, category string, type string, question string, subject string, result string, bill_id string")
    got = chunking.vote_chunks(votes, 64, 8).orderBy("chunk_index").collect()
    assert len(got) > 2 and all(r["text"].startswith("[Vote v1, House, 2024-01-01]") and r["token_count"] <= 64 for r in got)
    assert len({r["source_hash"] for r in got}) == len(got)


def test_cap_keeps_best_of_each_section(spark):
    rows = [("b", f"s{k % 4}", k, 10 + k) for k in range(12)]
    df = spark.createDataFrame(rows, "bill string, section string, chunk_index int, tokens int")
    got = {(r["section"], r["chunk_index"]) for r in chunking.capped(df, "bill", ["section"], 6).collect()}
    assert got == {("s0", 8), ("s1", 9), ("s2", 10), ("s3", 11), ("s3", 7), ("s2", 6)}
    assert chunking.capped(df, "bill", ["section"], 0).count() == 12


def test_first_per_key_is_deterministic(spark):
    df = spark.createDataFrame([("k", "es", "b"), ("k", "enr", "c"), ("k", "enr", "a"), (None, None, "z")], "k string, v string, b string")
    out = dedup.first_per_key(df, ["k"], T.alias_key(F.col("v"), F.col("b"), F.lit(""), F.lit(""))).collect()
    assert {(r["k"], r["b"]) for r in out} == {("k", "a"), (None, "z")}


def test_number_within(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "hot", "x", None]), k) for k in range(500)]
    df = spark.createDataFrame(rows, "g string, v int")
    got = {(r["g"], r["v"]): r["rn"] for r in folds.number_within(df, ["g"], ["v"]).collect()}
    seen = {}
    for g, v in sorted(rows, key=lambda r: r[1]):
        seen[g] = seen.get(g, 0) + 1
        assert got[(g, v)] == seen[g]


def test_greedy_shards_never_split_a_bill(spark):
    rng = random.Random(3)
    rows = [("c", k, rng.randint(1, 30)) for k in range(100)]
    got = packing.greedy_shards(spark.createDataFrame(rows, "c string, bill int, n int"), "c", ["bill"], "bill", "n", 7, 60).orderBy("bill").collect()
    shard, bills, chunks = 1, 0, 0
    for (_, b, n), r in zip(rows, got):
        if bills >= 7 or bills and chunks + n > 60:
            shard, bills, chunks = shard + 1, 0, 0
        bills, chunks = bills + 1, chunks + n
        assert (r["bill"], r["shard_id"]) == (b, shard)


def test_pack_batches_refuses_an_oversize_item(spark):
    df = spark.createDataFrame([("k", 1, 50)], "k string, i int, n int")
    with pytest.raises(Exception, match="over the limit"):
        packing.pack_batches(df, "k", ["i"], "i", "n", 5, 40).collect()
    with pytest.raises(ValueError):
        packing.pack_batches(df, "k", ["i"], "i", "n", 0, 40)


def test_fixed_shards(spark):
    df = spark.createDataFrame([("a", k) for k in range(7)], "g string, v int")
    assert sorted((r["v"], r["shard_id"]) for r in packing.fixed_shards(df, ["g"], ["v"], 3).collect()) == [(k, k // 3 + 1) for k in range(7)]
    assert {r["shard_id"] for r in packing.fixed_shards(df, ["g"], ["v"], 0).collect()} == {1}


def test_changes_and_plan(spark):
    now = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "k string, h string")
    was = spark.createDataFrame([("a", "1"), ("b", "9"), ("d", "4"), ("c", None)], "k string, h string")
    assert {tuple(r) for r in state.detect_changes(now, was, "k", "h").collect()} == {("a", "unchanged"), ("b", "modified"), ("d", "deleted"), ("c", "unchanged")}
    want = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3"), ("n", "4")], "bill_uid string, source_hash string")
    have = spark.createDataFrame([("a", "1"), ("a", "9"), ("b", "3"), ("g", "5")], "bill_uid string, source_hash string")
    plan = state.reconcile_plan(want, have)
    assert {(r["bill_uid"], r["action"]) for r in plan.collect()} == {("a", "replace"), ("b", "keep"), ("n", "new"), ("g", "delete")}
    assert state.delete_fraction(plan).first()["fraction"] == pytest.approx(1 / 3)
    with pytest.raises(ValueError):
        state.guard_deletes(plan, 0.2)
    state.guard_deletes(plan, 0.34)
    again = state.reconcile_plan(want, want)
    assert {r["action"] for r in again.collect()} == {"keep"}


def test_count_equal_upsert_leaves_old_rows_and_sets_do_not(spark):
    live = spark.createDataFrame([("b", "h1", "old"), ("b", "h2", "old")], "bill string, h string, body string")
    staged = spark.createDataFrame([("b", "h3", "new"), ("b", "h4", "new")], "bill string, h string, body string")
    assert state.upsert_snapshot(staged, live, "bill", "h", ["body"]).count() == 4
    plan = state.reconcile_plan(staged.withColumnsRenamed({"bill": "bill_uid", "h": "source_hash"}), live.withColumnsRenamed({"bill": "bill_uid", "h": "source_hash"}))
    assert plan.first()["action"] == "replace"
    assert {r["h"] for r in state.replace_by_key(staged, live, "bill").collect()} == {"h3", "h4"}


def test_manifest_md5(spark):
    import hashlib

    df = spark.createDataFrame([("a", "2"), ("a", "1"), ("b", "3")], "k string, h string")
    assert {tuple(r) for r in state.manifest_md5(df, "k", "h").collect()} == {("a", 2, hashlib.md5(b"1,2").hexdigest()), ("b", 1, hashlib.md5(b"3").hexdigest())}
    assert state.manifest_md5(df.where("false"), "k", "h").count() == 0
    assert state.manifest_tree(df, "k", "h").agg(F.sum("n")).first()[0] == 3


def test_merged_prefers_the_earlier_index_on_ties(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0])], "id int, embedding array<double>")
    got = search.merged([("bill", df), ("vote", df), ("gone", None)], [1.0, 0.0], 2, "id").collect()
    assert [(r["id"], r["source_kind"]) for r in got] == [(1, "bill"), (1, "vote")]


def test_fuse(spark):
    a = spark.createDataFrame([("x", 0), ("y", 1)], "id string, rank int")
    b = spark.createDataFrame([("y", 0)], "id string, rank int")
    got = {r["id"]: r["score"] for r in search.fuse([a, b], "id").collect()}
    assert got == pytest.approx({"x": 1 / 60, "y": 1 / 61 + 1 / 60})
    assert {r["id"]: r["score"] for r in search.fuse([b], "id", first=1).collect()} == pytest.approx({"y": 1 / 61})


def test_metrics(spark):
    got = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "c", 3), (2, "z", 1)], "query_id int, item string, rank int")
    want = spark.createDataFrame([(1, "b"), (1, "c"), (1, "q"), (2, "y"), (3, "n")], "query_id int, item string")
    m = {r["query_id"]: (r["recall"], r["precision"], r["mrr"]) for r in evaluation.metrics(got, want, 2, "item").collect()}
    assert m[1] == pytest.approx((1 / 3, 1 / 2, 1 / 2)) and m[2] == (0, 0, 0) and m[3] == (0, 0, 0)


def test_index_percentiles(spark):
    df = spark.createDataFrame([("a", float(k)) for k in range(10)] + [("b", 5.0), ("b", None)], "k string, v double")
    assert {r["k"]: (r["n"], r["p50"], r["p95"]) for r in evaluation.index_percentiles(df, "k", "v").collect()} == {"a": (10, 5.0, 9.0), "b": (1, 5.0, 5.0)}


def _vectors(rng, n, size=16, centers=12):
    import numpy as np

    middle = rng.normal(size=(centers, size))
    return (middle[rng.integers(0, centers, n)] + 0.4 * rng.normal(size=(n, size))).astype(np.float32)


def test_index_search_is_exact_and_its_short_form_recalls_nine_in_ten(spark, tmp_path):
    import numpy as np

    from folioscope.operators import search

    rng = np.random.default_rng(4)
    x = _vectors(rng, 3000)
    rows = [(k, "t", v.tolist()) for k, v in enumerate(x)] + [(5000, "t", None), (5001, "t", [0.0] * 16), (5002, "t", [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, label string, embedding array<float>")
    index = search.build_index(df, f"file://{tmp_path}/index", "vec_id", cells=24)
    found = 0
    unit = x / np.linalg.norm(x, axis=1, keepdims=True).astype(np.float64)
    for q in x[:6] + 0.1 * rng.normal(size=(6, 16)):
        sim = unit @ (q / np.linalg.norm(q))
        want = np.lexsort((np.arange(len(x)), -sim))[:20].tolist()
        got = search.indexed_top_k(spark, index, q.tolist(), 20, "vec_id").collect()
        assert [r["vec_id"] for r in got] == want and got[0]["similarity"] == pytest.approx(sim[want[0]])
        short = search.indexed_top_k(spark, index, q.tolist(), 20, "vec_id", probes=6, exact=False).collect()
        found += len({r["vec_id"] for r in short} & set(want))
    assert found >= 0.9 * 6 * 20
    assert spark.read.parquet(index.path).count() == 3000
    # more rows asked for than there are, and an empty table
    assert search.indexed_top_k(spark, index, x[0].tolist(), 4000, "vec_id").count() == 3000
    none = search.build_index(df.limit(0), f"file://{tmp_path}/none", "vec_id")
    assert search.indexed_top_k(spark, none, [1.0], 3, "vec_id").count() == 0


def test_exact_search_reads_fewer_cells(spark, tmp_path):
    import numpy as np

    from folioscope.operators import search

    x = _vectors(np.random.default_rng(5), 2000, 16, 8) / 1.0
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    index = search.build_index(df, f"file://{tmp_path}/index", "vec_id", cells=8)
    read = []
    rows = search.Index.rows
    search.Index.rows = lambda self, s, cells: (read.append(len(cells)), rows(self, s, cells))[1]
    try:
        search.indexed_top_k(spark, index, x[0].tolist(), 5, "vec_id", probes=1).collect()
    finally:
        search.Index.rows = rows
    assert read[0] == 1 and read[1] < 8


def test_top_k_keeps_ties_by_key_across_batches(spark):
    from folioscope.operators import search

    df = spark.createDataFrame([(k, [1.0, float(k % 2)]) for k in range(40)], "vec_id long, embedding array<double>").repartition(5)
    assert [r["vec_id"] for r in search.top_k(df, [1.0, 0.0], 6, "vec_id").collect()] == [0, 2, 4, 6, 8, 10]


def test_vote_chunks_cut_only_what_does_not_fit(spark):
    from folioscope.functions import text as T
    from folioscope.operators import chunking
    from folioscope.sources.xml import clean

    words = " ".join(f"word{k}. and" if k % 9 == 0 else f"word{k}" for k in range(300))
    rows = [("v1", "h", "2001-02-03", "c", "t", "short", "", "", ""), ("v2", "s", "2001-02-03", "c", "t", words, "other", "Passed", "hr1-110"), ("v3", "h", None, "c", "t", "", "", "", "")]
    votes = spark.createDataFrame(rows, "vote_id string, chamber string, date string, category string, type string, question string, subject string, result string, bill_id string")
    got = sorted(chunking.vote_chunks(votes, 64, 8).collect(), key=lambda r: (r["vote_id"], r["chunk_index"]))
    prefix = "[Vote v2, Senate, 2001-02-03] c: t"
    narrative = f"Question: {clean(words)}\nSubject: other\nResult: Passed\nRelated bill: hr1-110"
    pieces = chunking.sentence_windows(narrative, 56 - chunking.estimated_tokens(len(prefix.split())), 8)
    want = ["[Vote v1, House, 2001-02-03] c: t Question: short"] + [clean(f"{prefix}\n{p}") for _, p in pieces] + ["[Vote v3, House, ] c: t"]
    assert [r["text"] for r in got] == want and len(pieces) > 4
    assert all(r["token_count"] <= 64 for r in got) and T.vote_text


def test_pointer_flip_never_leaves_no_pointer(spark, tmp_path):
    from folioscope.sources import files

    root = f"file://{tmp_path}/state"
    for name in ("a", "b"):
        files.write_snapshot(spark.range(3 if name == "a" else 5).toDF("x"), root, name)
        files.promote(spark, root, name)
    assert files.current(spark, root).count() == 5
    # a flip that stopped before its rename leaves the old pointer in force
    (tmp_path / "state" / "CURRENT.next").write_text("c")
    assert files.current(spark, root).count() == 5
    files.promote(spark, root, "a")
    assert files.current(spark, root).count() == 3
    with pytest.raises(ValueError):
        files.promote(spark, root, "missing")


def test_greedy_segments_against_a_loop(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["hot"] * 6 + ["b", None]), k, rng.choice([0, 1, 5, 9, 30, None])) for k in range(900)]
    df = spark.createDataFrame(rows, "c string, k int, n int").repartition(5)
    for most_rows, most, width in ((7, 40, 10), (4, 0, 4), (25, 25, 50), (1, 9, 3), (500, 100, 1)):
        got = {(r["c"], r["k"]): r["s"] for r in folds.greedy_segments(df, "c", ["k"], "n", most_rows, most, "s", width).collect()}
        want = {}
        for c in ("hot", "b", None):
            now, items, total = 1, 0, 0
            for _, k, n in sorted((r for r in rows if r[0] == c), key=lambda r: r[1]):
                if items and (items >= most_rows or 0 < most < total + (n or 0)):
                    now, items, total = now + 1, 0, 0
                items, total = items + 1, total + (n or 0)
                want[c, k] = now
        assert got == want, (most_rows, most, width)
    assert folds.greedy_segments(df.limit(0), "c", ["k"], "n", 3, 9, "s").count() == 0


VOTE = "vote_id string, chamber string, date string, category string, type string, question string, subject string, result string, bill_id string"


def test_vote_chunks_do_not_multiply_unused_columns(spark):
    # 586 pieces of each of 36 votes: with the question beside each piece, 2.5 GB in one batch
    question = F.repeat(F.lit("word "), 24_000)
    text = {"chamber": "h", "date": "2001-02-03", "category": "c", "type": "t", "subject": "", "result": "", "bill_id": ""}
    votes = spark.range(0, 36, 1, 1).select(F.concat(F.lit("v"), "id").alias("vote_id"), question.alias("question"), *(F.lit(v).alias(k) for k, v in text.items()))
    got = chunking.vote_chunks(votes, 64, 8).groupBy("vote_id").agg(F.count("*").alias("n"), F.max("chunk_index").alias("last"), F.sum("token_count").alias("tokens")).collect()
    pieces = chunking.sentence_windows("Question: " + "word " * 24_000, 56 - chunking.estimated_tokens(6), 8)
    assert len(got) == 36 and {(r["n"], r["last"] + 1) for r in got} == {(len(pieces), len(pieces))}
    assert {r["tokens"] for r in got} == {sum(chunking.estimated_tokens(6 + len(p.split())) for _, p in pieces)}


def test_vote_chunks_keep_the_votes_columns(spark):
    rows = [("v1", "h", "2001-02-03", "c", "t", "word " * 200, None, "Passed", "hr1-110"), ("v2", "s", None, None, None, "short", "s", None, None), ("v3", None, None, None, None, None, None, None, None)]
    got = chunking.vote_chunks(spark.createDataFrame(rows, VOTE), 64, 8).orderBy("vote_id", "chunk_index").collect()
    assert [r["chunk_index"] for r in got] == [*range(len(got) - 2), 0, 0] and len(got) > 5
    assert {tuple(r)[:9] for r in got} == set(rows) and all(r["text"] == " ".join(r["text"].split()) for r in got)


LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_section_chunks_run_in_bounded_batches(spark):
    import pyarrow as pa

    spark.conf.set(LIMIT, str((1 << 31) - 1))
    bodies = spark.range(0, 4000, 1, 1).select("id", F.repeat(F.concat("id", F.lit(" word ")), 400).alias("b"))
    c = chunking.section_chunk_udf(100, 16)(F.lit("[p]"), "b", F.array(F.substring("b", 1, 1000), F.substring("b", 1001, 9000)))
    got = bodies.select("id", F.explode(c).alias("c")).select("id", "c.*").where("id % 1000 = 7").collect()
    b = {k: f"{k} word " * 400 for k in (7, 1007, 2007, 3007)}
    want = [(k, i, t, n) for k, x in b.items() for i, (t, n) in enumerate(chunking.section_chunks("[p]", x, [x[:1000], x[1000:10000]], 100, 16))]
    assert sorted(map(tuple, got)) == want and len(want) > 20

    @F.arrow_udf("long")
    def size(x: pa.Array) -> pa.Array:
        return pa.array([x.nbytes] * len(x))

    assert bodies.select(size("b").alias("n")).agg(F.max("n")).first()[0] < 5 << 20  # 16 MB of bodies in all


def test_sentence_chunks_run_in_bounded_batches(spark):
    import pyarrow as pa

    texts = [None, "", "short", *(f"Sentence {k} is here. " * 300 for k in range(400))]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["k", "t"])
    made = list(chunking._sentence_batches(iter([batch, batch.slice(0, 0), batch.slice(0, 3)]), 128, 16, "clean", ["k", "chunk_index", "text"]))
    want = [(k, i, p) for k, t in [*enumerate(texts), *enumerate(texts[:3])] for i, (_, p) in enumerate(chunking.sentence_windows(t or "", 128, 16))]
    assert [r for b in made for r in zip(*(c.to_pylist() for c in b.columns))] == want
    assert len(made) > 3 and max(b.nbytes for b in made) < 3 << 19

    spark.conf.set(LIMIT, str((1 << 31) - 1))
    rows = spark.range(0, 3000, 1, 1).select("id", F.repeat(F.concat("id", F.lit(" word. ")), 600).alias("t"))
    got = chunking.sentence_chunks(rows, "id", "t", 128, 16)
    assert int(spark.conf.get(LIMIT).rstrip("b")) <= 4 << 20
    n = {k: len(chunking.sentence_windows(f"{k} word. " * 600, 128, 16)) for k in (0, 2999)}
    assert {r["id"]: r["count"] for r in got.where("id in (0, 2999)").groupBy("id").count().collect()} == n
