import random

import numpy as np
import pytest

from folioscope.llm import neardup, skew


def shingles(t):
    w = (t or "").encode().lower().split()
    return frozenset(tuple(w[k : k + 3]) for k in range(len(w) - 2)) if len(w) >= 3 else frozenset([tuple(w)] if w else [])


def plain(rows):
    sets, parent = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def mutated(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"m{rng.randrange(10**6)}"
    return " ".join(w)


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 7)  # several blocks a bucket
    rng = random.Random(1)
    base = [" ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randint(30, 300))) for _ in range(12)]
    texts = list(base)
    for b in base[:6]:
        texts += [mutated(rng, b, rng.randint(1, 6)) for _ in range(25)]
    step = base[6]
    for _ in range(30):  # a chain: neighbours are alike, its ends are not
        step = mutated(rng, step, 2)
        texts.append(step)
    texts += [base[7]] * 40 + [base[7].upper(), "a b", "A  b", "a", "", None, "a b c", "x y z x y z x y z", "  q w e"]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain(rows)


def test_different_texts_of_one_id_all_take_part(spark):
    rng = random.Random(5)
    make = lambda: " ".join(f"w{rng.randrange(5000)}" for _ in range(60))
    a, b, c, d = make(), make(), make(), make()
    rows = [(7, a), (7, b), (7, ""), (7, None), (9, a.upper()), (8, mutated(rng, b, 1)), (3, c), (3, c), (4, c + " x"), (5, d), (6, ""), (None, a), (2, "A b"), (2, "a  B")]
    for parts in (1, 5):
        got = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()}
        n = {t: len(shingles(t)) for _, t in rows}
        want = {(7, n[a], 7, True), (7, n[b], 7, True), (7, 0, 7, True), (9, n[a], 7, False), (8, n[rows[5][1]], 7, False), (3, n[c], 3, True), (4, n[c + " x"], 3, False), (5, n[d], 5, True), (6, 0, 6, True), (None, n[a], None, True), (2, 1, 2, True)}
        assert got == want


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    b = np.concatenate([a[:360], rng.integers(0, 1 << 63, 40).astype(np.uint64)])
    one = np.array([7], np.uint64)
    s = np.concatenate([a, b, one])
    text = np.repeat([0, 1, 2], [400, 400, 1])
    t = 512
    x = neardup.sketch(s, text, 4, t)
    assert (x[:3] != np.iinfo(np.uint64).max).all() and (x[3] == np.iinfo(np.uint64).max).all()
    assert abs((x[0] == x[1]).mean() - 360 / 440) < 0.08


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(0, 40)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)] + [(5, 5)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = {r["node"]: r["comp"] for r in skew.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}


def test_lookup_with_a_hot_key(spark):
    left = spark.createDataFrame([("hot" if k % 3 else f"k{k}", k) for k in range(3000)], "key string, v long")
    right = left.groupBy("key").count().withColumnRenamed("count", "n")
    out = skew.lookup(left, right, ["key"], "n", 3000)
    assert out.count() == 3000 and out.where("n is null").count() == 0


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, "a b c d"), (None, "a b c d"), (3, "a b c d"), (3, "a b c d")]])
def test_edges(spark, rows):
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows) and all(r["kept"] and r["component_id"] == r["doc_id"] for r in got)
    # in the pipeline's stage rows without doc_id take part, and one of equal rows stays
    left = neardup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(left) == min(1, len(rows)) and all(r["doc_id"] == rows[-1][0] for r in left)


def test_repeated_and_missing_ids_leave_one_row_of_a_group(spark):
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(1, "a b c d"), (1, "a b c d"), (1, "A  b c d"), (1, "other words of one id"), (2, "e f g h"), (None, "E f g h"), (None, "i j k l"), (None, "i j k l"), (3, long), (None, long + " more")]
    rows += [(None, None), (None, None), (4, ""), (4, "")]
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], "doc_id long, text string, __id_0 int, __same_0 int")
    out = neardup.deduplicated(df)
    got = sorted(((r["doc_id"], (r["text"] or "").lower().split()) for r in out.collect()), key=str)
    want = [(1, "a b c d"), (1, "other words of one id"), (2, "e f g h"), (None, "i j k l"), (3, long), (None, ""), (None, ""), (4, ""), (4, "")]
    assert out.columns == df.columns and got == sorted(((i, t.split()) for i, t in want), key=str)
