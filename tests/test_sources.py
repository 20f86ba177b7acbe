import json
import os

import pytest

from folioscope import schemas
from folioscope.sources import files, xml
from folioscope.streaming import incremental

BILL = b"""<bill bill-stage="Enrolled" xmlns:dc="%s"><form><legis-num> H.R. 1 </legis-num><congress>119th</congress>
<official-title>To  do <em>things</em> .</official-title></form><dc:title>T</dc:title><dc:date> 2024-01-02 </dc:date>
<section><enum>1.</enum><header>Short title</header><text>x</text></section>
<section>lead<enum>2.</enum> tail <header>Purpose</header><subsection><text>One,</text></subsection> mid <subsection><text>two .</text></subsection></section>
<section><enum>3.</enum><header>Outer</header><text>body <quote><section><enum>9.</enum><text>inner</text></section></quote> end</text></section></bill>""" % xml._DC[1:-1].encode()


def put(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(content if isinstance(content, bytes) else json.dumps(content).encode())


def test_bill_tree(spark, tmp_path):
    root = str(tmp_path)
    put(f"{root}/119/bills/hr/hr42/data.json", {"bill_id": "hr42-119", "short_title": "S", "status": "X"})
    put(f"{root}/119/bills/s/s7/data.json", b"{broken")
    put(f"{root}/90/bills/hr/hr1/data.json", {})
    rows = {r["bill_id"]: r for r in files.bill_tree(spark, root, least_congress=103).collect()}
    assert set(rows) == {"hr42-119", "s7-119"} and rows["s7-119"]["status"] == "" and rows["hr42-119"]["short_title"] == "S"


def test_sidecars_and_contents(spark, tmp_path):
    root = str(tmp_path)
    put(f"{root}/bills_119/hr1.meta.json", {"bill_id": "hr1-119", "congress": 119, "format": "xml"})
    put(f"{root}/bills_119/hr1.xml", BILL)
    put(f"{root}/bills_119/s2.meta.json", {"bill_id": "s2-119", "congress": 119, "format": "text"})
    put(f"{root}/bills_119/s2.txt", b"SECTION 1. A\nbody\n")
    put(f"{root}/.hidden/x.meta.json", {"bill_id": "no"})
    meta = files.sidecars(spark, root)
    joined = files.with_content(meta, files.contents(spark, root))
    assert {r["bill_id"] for r in joined.collect()} == {"hr1-119", "s2-119"}
    ids = spark.createDataFrame([("hr1-119",)], "bill_id string")
    assert files.pruned_scan(meta, ids).count() == 1
    assert files.pruned_scan(meta, ids.union(spark.createDataFrame([("gone",)], "bill_id string"))).count() == 2


def test_xml(spark):
    df = spark.createDataFrame([("a", BILL), ("b", b"<bill><x>text</bill>"), ("c", None)], "k string, c binary")
    rows = {r["doc_key"]: r for r in xml.parsed(df, "k", "c").collect()}
    a = rows["a"]
    assert (a["bill_stage"], a["legis_num"], a["official_title"], a["congress_text"], a["dc_title"], a["date"]) == ("Enrolled", "H.R. 1", "To do things.", "119th", "T", "2024-01-02")
    assert [(s["enum"], s["header"], s["sub_texts"]) for s in a["sections"]] == [("2.", "Purpose", ["One,", "two."]), ("3.", "Outer", []), ("9.", "", [])]
    assert a["sections"][0]["body_text"] == "tail One, mid two." and a["sections"][1]["body_text"] == "body 9. inner end"
    assert rows["b"]["ok"] is False and rows["b"]["hash_text"] == "text" and rows["c"]["ok"] is False


def test_hash_text_puts_tails_before_children():
    import xml.etree.ElementTree as ET

    assert xml.hash_text(ET.fromstring("<a>1<b>2<c>3</c>4</b>5</a>")) == "1 2 5 3 4"


def test_votes(spark, tmp_path):
    root = str(tmp_path)
    put(f"{root}/119/votes/2024/h1/data.json", {"vote_id": "h1-119.2024", "congress": 119, "number": 1, "question": "Q", "bill": {"type": "hr", "number": 1, "congress": 119}, "votes": {"Aye": [1]}})
    put(f"{root}/119/votes/2024/h2/data.json", {"vote_id": "h2", "question": " ", "subject": ""})
    put(f"{root}/119/votes/2024/h3/data.json", b"nope")
    got = files.votes(spark, root).collect()
    assert [(r["vote_id"], r["bill_id"], r["congress"]) for r in got] == [("h1-119.2024", "hr1-119", 119)]


def test_id_lists(spark, tmp_path):
    for name, value in (("a.json", ["x", "y"]), ("b.json", {"changed_bill_ids": ["x", "y"]})):
        put(str(tmp_path / name), value)
        assert sorted(r[0] for r in files.id_list(spark, str(tmp_path / name)).collect()) == ["x", "y"]
    put(str(tmp_path / "c.json"), {"other": 1})
    with pytest.raises(Exception, match="id list"):
        files.id_list(spark, str(tmp_path / "c.json")).collect()


def test_shards_checksums_and_completed(spark, tmp_path):
    put(str(tmp_path / "shard-00001.jsonl"), b'{"bill_id":"a","chunk_index":0}\n\n{"bill_id":"b","chunk_index":1}\n')
    put(str(tmp_path / "shard-1.jsonl"), b'{"bill_id":"no"}\n')
    assert sorted(r["bill_id"] for r in files.shards(spark, str(tmp_path), schemas.CHUNK).collect()) == ["a", "b"]
    sums = files.checksums(spark, str(tmp_path))
    file, sha = sums.select("file", "sha256").first()
    manifest = spark.createDataFrame([(file, sha, 0, "m", 3)], "file string, sha256 string, to_embed int, model string, dimensions int")
    assert files.completed_shards(manifest, sums, "m", 3).count() == 1 and files.completed_shards(manifest, sums, "m", 4).count() == 0


def test_eval_set(spark, tmp_path):
    put(str(tmp_path / "e.json"), {"queries": [{"id": "1", "expected_bill_ids": ["a"], "fixture": True}, {"id": "2", "expected_bill_ids": []}, {"id": "3", "expected_bill_ids": ["b"], "fixture": False}]})
    assert files.eval_set(spark, str(tmp_path / "e.json")).count() == 2
    assert files.eval_set(spark, str(tmp_path / "e.json"), only_fixtures=True).count() == 1


def test_desired_state_must_not_be_empty(spark, tmp_path):
    put(str(tmp_path / "d.json"), [])
    with pytest.raises(ValueError):
        files.desired_state(spark, str(tmp_path / "d.json"))


def test_snapshot_promotion(spark, tmp_path):
    root = f"file://{tmp_path}"
    files.write_snapshot(spark.range(3), root, "v1")
    files.promote(spark, root, "v1")
    files.write_snapshot(spark.range(5), root, "v2")
    assert files.current(spark, root).count() == 3
    files.promote(spark, root, "v2")
    assert files.current(spark, root).count() == 5
    os.makedirs(tmp_path / "v3")
    with pytest.raises(ValueError):
        files.promote(spark, root, "v3")
    assert files.current(spark, root).count() == 5


def test_congresses(spark):
    df = spark.createDataFrame([("/d/119/bills/hr",), ("/d/x/bills/hr",), ("/d/110/bills/s",), ("/d/111/votes/s",)], "path string")
    assert [r["congress"] for r in files.congresses(df).collect()] == [110, 119]


def test_incremental(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string").coalesce(1).write.parquet(src)
    schema = spark.read.parquet(src).schema
    take = lambda: incremental.run_available(incremental.stream_files(spark, src, schema, "*.parquet"), out, "k", "v")
    assert take() == 1
    before = spark.createDataFrame(incremental.snapshot(spark, out, "k").select("k", "_digest").collect())
    spark.createDataFrame([(2, "c"), (3, "d")], "k long, v string").coalesce(1).write.mode("append").parquet(src)
    assert take() == 1 and take() == 0
    assert {(r["k"], r["v"]) for r in incremental.snapshot(spark, out, "k").collect()} == {(1, "a"), (2, "c"), (3, "d")}
    assert {tuple(r) for r in incremental.changed_since(spark, out, "k", before).collect()} == {(1, "unchanged"), (2, "modified"), (3, "new")}


def test_choose_path():
    assert [incremental.choose_path(*a) for a in ((5, 0), (0, 3), (0, 0), (1001, 0))] == ["delta", "retry", "nothing", "full"]
