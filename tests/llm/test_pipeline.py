"""The pipeline and every registered query on awkward tables: nulls, empty and long texts, ties, clashing columns."""

import random

import pytest

import corpus_pipeline
from folioscope.llm import registry

EXTRA = ["n", "k", "size", "rep", "bands", "whole", "p", "part", "file", "salt", "text1", "refers_to", "n_words", "comp", "_row"]


def write(spark, path, rows, schema):
    df = spark.createDataFrame(rows, schema)
    for c in EXTRA:
        if c not in df.columns:
            df = df.selectExpr("*", f"'x' as {c}")
    df.coalesce(2).write.parquet(path)


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("awkward"))
    rng = random.Random(1)
    word = lambda: rng.choice(["the", "and", "ing", "thon", "er"]) + rng.choice(["a", "st", "nd", "le"]) + str(rng.randrange(40))
    item = " ".join(f"bench{k}" for k in range(20))
    docs = [(k, " ".join(word() for _ in range(rng.randint(1, 120))), rng.choice(["en", "de", None]), rng.choice(["hot", "hot", "a", None]), 1) for k in range(150)]
    docs += [(500, None, "en", "hot", 0), (501, "", "de", None, 0), (502, " \n\t ", None, "a", 3), (503, "123 !!", "en", "a", 5), (504, item, "en", "hot", 9), (505, "word " * 200_000, "en", "hot", 9)]
    docs += [(506, docs[3][1], "en", "a", 1), (507, docs[3][1], "en", "a", 1), (508, docs[4][1], "en", None, 1), (508, docs[4][1], "en", None, 1), (None, docs[5][1], "en", "a", 1), (None, None, None, None, None)]
    write(spark, f"{d}/documents.parquet", docs, "doc_id long, text string, lang string, source string, n_chars long")
    write(spark, f"{d}/benchmark.parquet", [(1, item), (2, None), (3, ""), (None, "alone"), (1, item)], "item_id long, text string")
    write(spark, f"{d}/pages.parquet", [(1, "u", "<p>x</p>"), (1, "u", "<p>x</p>"), (None, None, None), (2, "u", ""), (3, "u", "<p>" + "y" * 300_000)], "page_id long, url string, html string")
    write(spark, f"{d}/conversations.parquet", [(1, 0, "user", None), (1, 0, "user", None), (None, None, None, None), (2, 1, "assistant", "</s>" * 1000)], "conv_id long, turn long, role string, text string")
    return d


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    write(spark, f"{d}/documents.parquet", [], "doc_id long, text string, lang string, source string, n_chars long")
    write(spark, f"{d}/benchmark.parquet", [], "item_id long, text string")
    write(spark, f"{d}/pages.parquet", [], "page_id long, url string, html string")
    write(spark, f"{d}/conversations.parquet", [], "conv_id long, turn long, role string, text string")
    return d


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_on_awkward_rows(spark, awkward, name):
    got = registry.QUERIES[name](spark, awkward).collect()
    table = {"op6": "conversations", "op9": "pages", "op10": "pages"}.get(name.split("_")[0], "documents")
    rows = spark.read.parquet(f"{awkward}/{table}.parquet").count()
    assert len(got) == (4 if table == "conversations" else rows)


#: What the rows without text, with empty text, of white space, and without anything give, by query.
DEFINED = {
    "op1_quality_rules": {d: {"n_words": 0, "word_chars": 0, "n_dup_lines": 0, "base_failed": True, "kept": False} for d in (500, 501, 502, None)},
    "op2_decontamination": {500: {"n_words": 0, "n_hit": 0, "contaminated": False}, 501: {"n_words": 0, "n_items": 0}, 502: {"n_words": 0}, 504: {"n_words": 20, "n_hit": 20, "n_items": 1, "contaminated": True}},
    "op3_mixing": {500: {"size": 0, "taken": 0}, 501: {"size": 0, "taken": 0, "source": None}, 502: {"size": 0, "taken": 0}},
    "op4_token_output": {500: {"n_tokens": 1}, 501: {"n_tokens": 1}, 505: {"n_tokens": 200_002}},
    "op5_language_id": {500: {"lang_pred": "und", "score": 0.0}, 501: {"lang_pred": "und", "score": 0.0}, 502: {"lang_pred": "und"}, 503: {"lang_pred": "und", "score": 0.0}},
    "op7_pii": {d: {"n_email": 0, "n_spans": 0, "spans": ""} for d in (500, 501, 502)},
    "op8_near_dedup": {500: {"n_shingles": 0, "component_id": 500, "kept": True}, 501: {"n_shingles": 0, "component_id": 501}, 506: {"component_id": 3, "kept": False}, 507: {"component_id": 3}, 508: {"component_id": 4, "kept": False}},
}


@pytest.mark.parametrize("name", sorted(DEFINED))
def test_defined_results(spark, awkward, name):
    got = registry.QUERIES[name](spark, awkward).collect()
    for doc_id, want in DEFINED[name].items():
        rows = [r for r in got if r["doc_id"] == doc_id]
        if name == "op1_quality_rules" and doc_id is None:
            rows = [r for r in rows if r["n_words"] == 0]
        assert rows and all(r[c] == v for r in rows for c, v in want.items()), (name, doc_id, rows)
    if name == "op4_token_output":  # nulls first; each document begins where the one before ends
        assert [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])][:2] == [None, None]
        ends = sorted((r["start"], r["start"] + r["n_tokens"]) for r in got)
        assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    if name == "op8_near_dedup":
        assert all(r["component_id"] is None and r["kept"] for r in got if r["doc_id"] is None)


def test_defined_results_of_pages_and_conversations(spark, awkward):
    text = {r["page_id"]: (r["text"], r["n_chars"]) for r in registry.op9_html_extraction(spark, awkward).collect()}
    assert text == {1: ("x", 1), None: ("", 0), 2: ("", 0), 3: ("y" * 300_000, 300_000)}
    warc = {(r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in registry.op10_warc(spark, awkward).collect()}
    assert warc == {(1, 8, "response", None), (None, 0, "response", None), (2, 0, "response", None), (3, 300_003, "response", None)}
    chat = {r["conv_id"]: (r["n_turns"], r["loss_chars"]) for r in registry.op6_chat_formatting(spark, awkward).collect()}
    assert chat == {1: (2, 0), None: (1, 0), 2: (1, 4000), -7: (2, 21)}


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_on_empty_tables(spark, empty, name):
    assert registry.QUERIES[name](spark, empty).count() == (1 if name.startswith("op6") else 0)


def test_pipeline_on_empty_tables(spark, empty):
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_stages_take_effect(spark, awkward, tmp_path):
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    columns, kept = docs.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, awkward)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append([r["doc_id"] for r in docs.select("doc_id").collect()])
    assert not {500, 501, 502, 503} & set(kept[0]) and {504, 505, 506, 0} <= set(kept[0])
    assert not {506, 507} & set(kept[1]) and 3 in kept[1]
    assert 504 in kept[1] and 504 not in kept[2]
    assert set(kept[3]) <= set(kept[2]) and max(kept[3].count(x) for x in set(kept[3])) <= 4
    assert sorted(map(str, kept[4])) == sorted(map(str, kept[3]))
    assert len(kept[4]) == corpus_pipeline.run(spark, awkward).count()


def test_pipeline_on_given_tables(spark, data):
    assert corpus_pipeline.run(spark, data).count() > 0
