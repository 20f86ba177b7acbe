import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from folioscope.llm import quality, scan


def plain_repeats(w):
    """Longest prefix of each position that also begins elsewhere."""
    out = []
    for i in range(len(w)):
        best = 0
        for j in range(len(w)):
            k = 0
            while i != j and i + k < len(w) and j + k < len(w) and w[i + k] == w[j + k]:
                k += 1
            best = max(best, k)
        out.append(best)
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=25), min_size=1, max_size=4))
def test_longest_repeats(texts):
    keys, bounds = [], [0]
    for k, t in enumerate(texts):
        keys += [(k << 8) + x for x in t]
        bounds.append(len(keys))
    got = quality.longest_repeats(scan.mix(np.array(keys, np.uint64)))
    for k, t in enumerate(texts):
        assert got[bounds[k] : bounds[k + 1]].tolist() == plain_repeats(t)


def plain(text, least):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    five = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    in_five = {p for k in range(len(w) - 4) if five[tuple(w[k : k + 5])] > 1 for p in range(k, k + 5)}
    rep = plain_repeats(w)
    covered = {p for k, r in enumerate(rep) if r >= least for p in range(k, k + r)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(in_five), len(covered), max(rep, default=0)


def test_measures_against_brute_force():
    rng = random.Random(5)
    texts = [None, "", " \n ", "a", "é ß x\x0bz", "x" * 5000]
    texts += ["".join(rng.choice(["a ", "b ", "ç ", "\n", "# ", "\x85", "dd\t"]) for _ in range(rng.randint(0, 80))) for _ in range(150)]
    for size in (1 << 20, 64):
        column = pa.array(texts, pa.string())
        parts = [quality.measure(*scan.texts(column, lo, hi), 3) for lo, hi in scan.slices(column, size)]
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered", "longest_repeat")
        got = list(zip(*(np.concatenate([p[n] for p in parts]).tolist() for n in names)))
        assert got == [plain(t, 3) for t in texts]


def test_verdicts(spark):
    fresh = " ".join(f"w{k}" for k in range(400))
    passage = " ".join(f"p{k}" for k in range(70))
    rows = [(1, fresh), (2, fresh + " " + passage + " mid " + passage), (3, "a b " * 50), (4, None), (5, "one two three"), (6, fresh * 3 + " " + passage + " x " + passage)]
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality.repetition_quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == (False, True) and got[3] == (True, False) and got[4] == (True, False) and got[5] == (True, False)
    long = " ".join(f"u{k}" for k in range(3000)) + " " + passage + " mid " + passage
    r = quality.repetition_quality(spark.createDataFrame([(7, long)], "doc_id long, text string")).first()
    assert not r["base_failed"] and not r["kept"] and r["longest_repeat"] == 70
