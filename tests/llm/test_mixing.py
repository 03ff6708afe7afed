import hashlib
import math
from collections import Counter

import pytest

from terrace.llm.mixing import mix, rates
from terrace.llm.queries import ORACLE, QUERIES
from tests.oracle import connect, differences


def copies(rate, seed, key):
    draws = max(1, math.ceil(rate / 256))
    total = 0
    for j in range(1, draws + 1):
        u = int(hashlib.md5(f"{seed}|{key}|{j}".encode()).hexdigest()[:13], 16) / 2**52
        mean = rate / draws
        p = below = math.exp(-mean)
        n = 0
        while below <= u:
            n += 1
            p *= mean / n
            below += p
        total += n
    return total


def test_copies_are_the_inverted_distribution(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rated, _ = rates(docs)
    rate = {r.source: r.rate for r in rated.collect()}
    got = Counter(r.doc_id for r in mix(docs, seed=3).collect())
    for r in docs.collect():
        assert got[r.doc_id] == copies(rate[r.source], 3, r.doc_id)


def test_shares_follow_the_weights(spark):
    docs = spark.range(30_000).selectExpr(
        "id AS doc_id", "'t' AS text", "CASE WHEN id % 3 = 0 THEN 'a' ELSE 'b' END AS source"
    )
    got = Counter(r.source for r in mix(docs, {"a": 0.75, "b": 0.25}).select("source").collect())
    assert got["a"] == pytest.approx(22_500, rel=0.03) and got["b"] == pytest.approx(7_500, rel=0.05)
    assert set(Counter(r.source for r in mix(docs, {"a": 1.0}).collect())) == {"a"}
    assert mix(docs, {"zz": 1.0}).count() == 0


def test_large_rates_are_sums(spark):
    docs = spark.createDataFrame([(n, "t", "a") for n in range(200)] , "doc_id long, text string, source string")
    got = Counter(r.doc_id for r in mix(docs, size=1000.0).select("doc_id").collect())
    assert all(got[n] == copies(1000.0, 0, n) for n in range(200))
    assert sum(got.values()) / 200 == pytest.approx(1000, rel=0.01)


def test_order_is_global_and_odd_rows_stay(spark):
    docs = spark.createDataFrame(
        [(1, "x", "a", "k"), (1, "x", "a", "k"), (None, None, None, "k"), (2, "", None, "k"), (None, "y", "a", "k")],
        "doc_id long, text string, source string, mix_key string",
    )
    rows = mix(docs, size=4.0).collect()
    keys = [r.mix_key for r in rows]
    assert keys == sorted(keys) and {len(k) for k in keys} == {32}
    seen = Counter((r.doc_id, r.text) for r in rows)
    assert seen[(1, "x")] % 2 == 0 and set(seen) <= {(1, "x"), (None, None), (2, ""), (None, "y")}
    assert mix(docs.limit(0)).count() == 0


def test_agrees_with_sql(spark):
    folder = "/root/testdata/sf0.01"
    sql = ORACLE["op2_mixing"]
    assert differences(QUERIES["op2_mixing"](spark, folder), connect(folder), sql) is None
