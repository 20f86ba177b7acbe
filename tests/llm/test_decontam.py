import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from folioscope.llm import decontam


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def plain(text, items):
    w, hit, found = words(text), set(), set()
    for name, item in items:
        x = words(item)
        m = min(13, len(x))
        for a in range(len(x) - m + 1 if m else 0):
            for k in range(len(w) - m + 1):
                if w[k : k + m] == x[a : a + m]:
                    hit.update(range(k, k + m))
                    found.add(str(name))
    return len(w), len(hit), sorted(found)


def test_search_against_brute_force(tmp_path):
    rng = random.Random(7)
    vocabulary = ["the", "The", "of", "É", "x1", "and"]
    make = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, make(n)) for k, n in enumerate([1, 2, 3, 5, 12, 13, 14, 30, 40])] + [(20, ""), (21, None), (10, "the"), (22, "of - of!")]
    texts = [make(rng.randint(0, 60)) + items[rng.randrange(9)][1] * rng.randint(0, 1) for _ in range(120)] + [None, "", "...", items[8][1] * 30]
    paths = []
    for part, chosen in (("a", items[:5]), ("b", items[5:])):
        paths.append(str(tmp_path / f"{part}.parquet"))
        pq.write_table(pa.table({"item_id": [i for i, _ in chosen], "text": pa.array([t for _, t in chosen], pa.string())}), paths[-1])
    v = decontam._hits(pa.array(texts, pa.string()), paths)
    got = list(zip(np.concatenate(v["n_words"]).tolist(), np.concatenate(v["n_hit"]).tolist(), v["items"]))
    assert got == [plain(t, items) for t in texts]


def test_long_items_skip(tmp_path):
    rng = random.Random(8)
    item = [f"q{rng.randrange(300)}" for _ in range(60)]
    text = [f"z{k}" for k in range(5000)]
    text[2000:2020] = item[10:30]
    path = str(tmp_path / "c.parquet")
    pq.write_table(pa.table({"item_id": [5], "text": [" ".join(item)]}), path)
    v = decontam._hits(pa.array([" ".join(text)]), [path])
    assert v["n_hit"][0].tolist() == [20] and v["items"] == [["5"]]


def test_words_whose_hashes_collide_are_told_apart(tmp_path, monkeypatch):
    real = decontam.scan.span_hash
    monkeypatch.setattr(decontam.scan, "span_hash", lambda *a: real(*a) & np.uint64(3))
    rng = random.Random(9)
    make = lambda n: " ".join(rng.choice(["ab", "ba", "abc", "b", "É", "q9"]) for _ in range(n))
    items = [(k, make(n)) for k, n in enumerate([2, 4, 13, 20])]
    texts = [make(rng.randint(0, 40)) + " " + items[k % 4][1] for k in range(60)]
    path = str(tmp_path / "d.parquet")
    pq.write_table(pa.table({"item_id": [i for i, _ in items], "text": [t for _, t in items]}), path)
    v = decontam._hits(pa.array(texts), [path])
    got = list(zip(np.concatenate(v["n_words"]).tolist(), np.concatenate(v["n_hit"]).tolist(), v["items"]))
    assert got == [plain(t, items) for t in texts]


def test_more_blocks_than_are_kept_are_built_once_a_group(tmp_path, monkeypatch):
    monkeypatch.setattr(decontam, "SLICE", 2000)
    monkeypatch.setattr(decontam, "GROUP", 100)
    built = []

    class Counted(decontam.Matcher):
        def __init__(self, items):
            built.append(1)
            super().__init__(items)

    monkeypatch.setattr(decontam, "Matcher", Counted)
    items = [(k, " ".join(f"i{k}w{j}" for j in range(20))) for k in range(9)]
    paths = []
    for k, t in items:
        paths.append(str(tmp_path / f"{k}.parquet"))
        pq.write_table(pa.table({"item_id": [k], "text": [t]}), paths[-1])
    texts = [f"x{k} " * 50 + items[k % 9][1] for k in range(120)]
    v = decontam._hits(pa.array(texts), paths)
    assert v["items"] == [[str(k % 9)] for k in range(120)] and len(v["n_hit"]) > 10
    assert len(built) == 9


def test_blocks_and_verdict(spark):
    item = " ".join(f"b{k}" for k in range(40))
    bench = spark.createDataFrame([(k, item if k == 3 else "of the" if k == 4 else f"other {k} " * 9) for k in range(30)], "item_id long, text string")
    rows = [(1, "x " * 100 + item), (2, "x " * 900 + item), (3, "clean " * 50), (4, None), (5, "x " * 900 + "of the"), (6, "x of the"), (7, ""), (2, "x " * 900 + item), (None, item[: item.index("b13")]), (8, item[: item.index("b12")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for size in (1 << 20, 200):
        got = {r["doc_id"]: (r["n_hit"], r["n_items"], r["contaminated"]) for r in decontam.decontaminate(docs, bench, size).collect()}
        assert got == {1: (40, 1, True), 2: (40, 1, False), 3: (0, 0, False), 4: (0, 0, False), 5: (2, 1, False), 6: (2, 1, True), 7: (0, 0, False), None: (13, 1, True), 8: (0, 0, False)}
        # a whole passage goes however long its text is; a phrase of an item under 13 words does not condemn a long text
        assert {r["doc_id"] for r in decontam.clean_documents(docs, bench, size).collect()} == {3, 4, 5, 7, 8}


def test_empty_benchmark_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a", 7, "z"), (None, None, None, None)], "doc_id long, text string, n_hit long, item_id string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert sorted((r["n_words"], r["n_hit"]) for r in decontam.decontaminate(docs, none).collect()) == [(0, 0), (1, 0)]
    assert sorted(map(str, decontam.clean_documents(docs, none).collect())) == sorted(map(str, docs.collect()))
