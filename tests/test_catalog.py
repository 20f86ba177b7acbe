"""Every named query against the SQL that an independent engine answers, on whole tables."""

import os

import duckdb
import pytest

from folioscope.plans import catalog


def rows(names, values):
    order = sorted(range(len(names)), key=lambda k: names[k])

    def norm(v):
        if isinstance(v, float):
            return "nan" if v != v else f"{v:.6f}"
        return str(v)

    return sorted(tuple(norm(r[k]) for k in order) for r in values)


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for f in os.listdir(data):
        con.execute(f"create view {f.split('.')[0]} as select * from '{data}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_matches_sql(spark, data, duck, name):
    got = catalog.QUERIES[name](spark, data)
    want = duck.execute(catalog.SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(names, want.fetchall())


def test_queries_without_sql_run(spark, data):
    for name in set(catalog.QUERIES) - set(catalog.SQL):
        assert catalog.QUERIES[name](spark, data).count() > 0


def test_fake_embedding_against_a_plain_implementation(spark, data):
    import hashlib
    import math
    import struct

    for r in catalog.fake_embedding(spark, data).limit(20).collect():
        chain = [r["source_hash"].encode()]
        for _ in range(8):
            chain.append(hashlib.sha256(chain[-1]).digest())
        v = [x / 2**31 for x in struct.unpack(">64i", b"".join(chain[1:]))]
        n = math.sqrt(sum(x * x for x in v))
        assert r["embedding"] == pytest.approx([x / n for x in v])


def test_top_k_plan_is_one_scan_and_take_ordered(spark, data):
    plan = catalog.vec_topk(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan and "BatchEvalPython" not in plan


def test_filter_reaches_the_scan(spark, data):
    plan = catalog.vec_topk_filtered(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(label,2)" in plan and "LessThanOrEqual(label,6)" in plan


def test_status_counts_reads_one_column(spark, data):
    plan = catalog.status_counts(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_type:string>" in plan
