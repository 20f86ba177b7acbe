import random

import duckdb
import pytest

from folioscope.llm import mixing


def fill(sizes, weights, percent, most):
    """Targets by sharing the excess again and again."""
    total = sum(sizes) * percent / 100
    target = [0.0] * len(sizes)
    free = set(range(len(sizes)))
    rest = total
    while free and rest > 1e-9:
        share = rest / sum(weights[k] for k in free)
        rest = 0.0
        for k in list(free):
            target[k] += share * weights[k]
            if target[k] >= most * sizes[k]:
                rest += target[k] - most * sizes[k]
                target[k] = most * sizes[k]
                free.discard(k)
    return target


def test_targets(spark):
    rng = random.Random(3)
    for _ in range(3):
        sizes = [rng.choice([0, 1, 50, 700, 9000]) for _ in range(rng.randint(1, 9))]
        names = sorted(f"s{k}" for k in range(len(sizes)))
        df = spark.createDataFrame([(n, "s" + n, s) for n, s in zip(names, sizes)], "source string, sk string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
        want = fill(sizes, [(3, 1, 2)[k % 3] for k in range(len(sizes))], 150, 2)
        assert [got[n] for n in names] == pytest.approx(want, abs=1e-6)


def documents(spark):
    rng = random.Random(4)
    rows = [(k, rng.choice(["hot"] * 5 + ["a", "b", "c", None]), "w " * rng.randint(0, 300)) for k in range(600)]
    rows += [(1000, "a", None), (1001, "only", ""), (1002, "Ω", "x"), (1003, "a", "dup dup"), (1003, "a", "dup dup"), (None, "b", "no id")]
    return spark.createDataFrame([(*r, "extra", 1, 2.0) for r in rows], "doc_id long, source string, text string, size string, k int, whole double")


def test_mix_against_sql(spark):
    docs = documents(spark)
    got = mixing.mix(docs)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "source", "text").toPandas().astype({"doc_id": "Int64"}))
    want = con.execute(mixing.SQL)
    names = [d[0] for d in want.description]
    key = lambda r: tuple("~" if v is None else f"{v:020.6f}" if isinstance(v, float) else str(v) for v in r)
    assert sorted(map(key, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(key, want.fetchall()))


def test_mix_is_near_its_targets_and_repeatable(spark):
    docs = documents(spark)
    rows = mixing.mix(docs).collect()
    for s in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 300
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))
    taken = sum(r["taken"] for r in rows)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.agg({"text": "count"}).first() and mixed.select(mixing.size_of(mixed["text"]).alias("n")).agg({"n": "sum"}).first()[0] == taken


def test_inclusion_follows_the_odds(spark):
    """201 sources alike but for their ids: the mean number of copies of a document follows its expectation."""
    sizes = [4, 16, 36, 100, 225, 400]
    rows = [(s * 100 + d, f"s{s:03d}", "w " * sizes[d % 6]) for s in range(201) for d in range(60)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    for turn in (1, 2):  # sources that weigh 1 and 2 are below their caps
        own = [r for r in got if int(r["source"][1:]) % 3 == turn]
        goal = own[0]["target"]
        low, high = 0.0, 10.0
        for _ in range(100):
            lam = (low + high) / 2
            total = sum(10 * n * min(2, lam * int(n**0.5)) for n in sizes)
            low, high = (lam, high) if total < goal else (low, lam)
        means = {n: [r["taken"] / n for r in own if r["size"] == n] for n in sizes}
        for n, copies in means.items():
            assert sum(copies) / len(copies) == pytest.approx(min(2, lam * int(n**0.5)), abs=0.08)
        assert means[4] and sum(means[400]) > 1.5 * sum(means[4])
        for s in {r["source"] for r in own}:
            assert abs(sum(r["taken"] for r in own if r["source"] == s) - goal) <= 200


def test_own_weights(spark):
    rows = [(k, "a" if k % 2 else "b", "w " * 10, (None, -3, 0, 1, 4)[k % 5], k % 5) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, quality int, w int")
    got = {r["doc_id"]: r["taken"] // 10 for r in mixing.mix(docs, 30, weight=docs["quality"]).collect()}
    assert all(got[k] == 0 for k in got if k % 5 < 3)
    assert sum(got[k] for k in got if k % 5 == 4) > 2 * sum(got[k] for k in got if k % 5 == 3)
    assert mixing.mixed_documents(docs, 30, weight=docs["quality"]).count() == sum(got.values())


def test_more_sources_than_are_broadcast(spark, monkeypatch):
    docs = documents(spark)
    want = sorted(map(str, mixing.mix(docs).collect()))
    copies = mixing.mixed_documents(docs).count()
    monkeypatch.setattr(mixing, "MOST_SOURCES", 0)
    assert sorted(map(str, mixing.mix(docs).collect())) == want and mixing.mixed_documents(docs).count() == copies
