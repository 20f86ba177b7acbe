import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioscope.llm import scan, simple8b, tokens


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60000), st.integers(0, 2**64 - 1)), max_size=700), st.integers(1, 300))
def test_simple8b_round_trip(values, block):
    v = np.array(values, np.uint64)
    words, offsets = simple8b.encode(v, block)
    assert simple8b.decode(words, offsets, len(v), block).tolist() == values
    if len(offsets) > 2:  # a block decodes on its own
        one = simple8b.decode(words[offsets[1] : offsets[2]], offsets[1:3] - offsets[1], min(block, len(v) - block), block)
        assert one.tolist() == values[block : 2 * block]


def test_simple8b_packs():
    assert len(simple8b.encode(np.zeros(960, np.uint64))[0]) == 4
    assert len(simple8b.encode(np.full(400, 1000, np.uint64))[0]) == 67


@pytest.fixture(scope="module")
def enc():
    pytest.importorskip("public_tokenizers")
    return tokens.Encoder(tokens.default_tokenizer())


def ids_of(enc, texts, size=1 << 20):
    column, out = pa.array(texts, pa.string()), []
    for lo, hi in scan.slices(column, size):
        ids, number = enc.encode(*scan.texts(column, lo, hi))
        out += [x.tolist() for x in np.split(ids, np.cumsum(number)[:-1])]
    return out


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.sampled_from("ab'srtelvmdS \n\t\u0085é1²_.,!中’ \x1c😀"), max_size=40), min_size=1, max_size=5))
def test_ids_equal_the_library(enc, texts):
    want = [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert ids_of(enc, texts) == want
    assert ids_of(enc, texts, 1) == want


@settings(max_examples=100, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", "<|", " ", "ab", "é", "’"]), max_size=6).map("".join), min_size=1, max_size=6))
def test_added_tokens_are_those_of_the_unswitched_library(enc, texts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.default_tokenizer())
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids_of(enc, texts) == want and ids_of(enc, texts, 1) == want
    assert ids_of(enc, ["a<|endoftext|>b"])[0].count(50256) == 1


def test_forgetting_changes_nothing(enc):
    small = tokens.Encoder(tokens.default_tokenizer(), most=10)
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randrange(99)}" for _ in range(50)) for _ in range(40)] + [None, ""]
    want = [e.ids for e in enc.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert ids_of(small, texts, 100) == want


def test_files(spark, enc):
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice(["alpha", "beta", "it's", "1234"]) for _ in range(rng.randint(0, 400)))) for k in rng.sample(range(10_000), 300)]
    rows += [(20_000, None), (20_001, ""), (5, "same"), (5, "same"), (20_002, "long " * 100_000), (None, "no id")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = tokens.write_token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), tokens.default_tokenizer())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = tokens.read_token_files(manifest).orderBy("start").collect()
    assert manifest.count() > 1 and len(got) == len(rows)
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))
    start = 0
    want = {i: t or "" for i, t in rows}
    for r in got:
        x = np.array([*enc.tokenizer.encode(want[r["doc_id"]], add_special_tokens=False).ids, 0], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(x), zlib.crc32(x.tobytes()))
        start += len(x)
