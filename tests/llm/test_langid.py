import random
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from folioscope.llm import langid, scan


def parse(train, x):
    i = n = 0
    while i < len(x):
        k = 0
        while i + k < len(x) and x[i : i + k + 1] in train:
            k += 1
        i += max(k, 1)
        n += 1
    return n


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=60).map(lambda b: bytes(97 + c % 3 for c in b)), st.lists(st.binary(max_size=50).map(lambda b: bytes(97 + c % 4 for c in b)), min_size=1, max_size=4))
def test_phrases_against_brute_force(train, texts):
    model = langid.Model({"x": train or b"a", "y": b"abcabc"})
    offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = model.phrases(np.frombuffer(b"".join(texts), np.uint8), offs)
    assert got.tolist() == [[parse(train or b"a", t), parse(b"abcabc", t)] for t in texts]


def test_segments_add_at_most_one_phrase_each():
    rng = random.Random(1)
    train, x = (bytes(rng.choice(b"abc ") for _ in range(n)) for n in (3000, 9000))
    got = langid.Model({"x": train}).phrases(np.frombuffer(x, np.uint8), np.array([0, len(x)]))[0, 0]
    assert parse(train, x) <= got <= parse(train, x) + 4


def test_clean():
    data, offs = langid.clean(*scan.texts(pa.array(["ab, c!!", "", None, "  1é2 ", "x"])))
    raw = data.tobytes()
    assert [raw[a:b].decode() for a, b in zip(offs, offs[1:])] == ["ab c ", "", "", "é ", "x"]


def corpus(n=400):
    rng = random.Random(2)
    sounds = {"aa": ["the", "ing", "and", "wh"], "bb": ["sch", "ein", "ung", "ß"], "cc": ["ción", "que", "ll", "ñ"]}
    rows = []
    for k in range(n):
        lang = rng.choice(list(sounds))
        rows.append((k, " ".join("".join(rng.choice(sounds[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(8, 60))), lang))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus() + [(9001, None, "aa"), (9002, "123 !!", "bb"), (9003, "", "cc"), (9004, "the and", None)]
    got = {r["doc_id"]: r for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 3 == 1) for k, r in got.items())
    held = [(lang, got[k]["lang_pred"]) for k, _, lang in rows[:400] if got[k]["held_out"]]
    assert len(held) > 80 and sum(a == b for a, b in held) / len(held) > 0.97
    assert all(got[k]["lang_pred"] == "und" and got[k]["score"] == 0 for k in (9001, 9002, 9003))
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_labels_of_held_out_rows_are_not_used(spark):
    rows = corpus(120)
    wrong = [(k, t, "zz" if zlib.crc32(str(k).encode()) % 3 == 1 else lang) for k, t, lang in rows]
    a, b = ([tuple(r) for r in langid.identify(spark.createDataFrame(x, "doc_id long, text string, lang string")).orderBy("doc_id").collect()] for x in (rows, wrong))
    assert a == b


def test_nothing_to_learn_from(spark):
    got = langid.identify(spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")).first()
    assert (got["lang_pred"], got["score"]) == ("und", 0.0)
