import math
import random

import pytest
from pyspark.sql import functions as F

from terrace.llm.queries import ORACLE, QUERIES
from terrace.llm.top_products import Settings, top_products
from tests.oracle import connect, differences

SCHEMA = "vec_id long, embedding array<float>"


def expected(rows, every=50, k=5):
    good = []
    for row, (vec_id, v) in enumerate(rows):
        if vec_id is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((row, vec_id, [math.floor(256 * x) for x in v]))
    out = []
    for row, query, a in good:
        if query % every == 0:
            scored = sorted(
                (-sum(x * y for x, y in zip(a, b)), vec_id) for other, vec_id, b in good if other != row
            )
            out += [(query, n + 1, vec_id, -s) for n, (s, vec_id) in enumerate(scored[:k])]
    return sorted(out)


def got(spark, rows, settings=Settings(), parts=3):
    table = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    out = top_products(table, F.col("vec_id") % 50 == 0, settings)
    return sorted(map(tuple, out.select("query_id", "rank", "vec_id", "score").collect()))


@pytest.mark.parametrize("seed", range(3))
def test_blocks_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    common = [rng.gauss(0, 0.3) for _ in range(12)]
    rows = []
    for n in range(700):
        v = common if n % 3 == 0 else [rng.gauss(0, rng.choice([0.1, 1, 3])) for _ in range(12)]
        rows.append((n, [float(f) for f in map(lambda x: round(x * 64) / 64, v)]))
    small = Settings(block=40, queries=6, step=16, first=4)
    assert got(spark, rows, small) == expected(rows)


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0]), (50, None), (100, [None, 1.0]), (150, [float("nan"), 1.0]), (200, [float("inf"), 0.0]),
        (None, [1.0, 1.0]), (1, [0.5, -0.001]), (2, []), (3, [0.0, 0.0]), (250, [1.0]), (250, [2.0, -1.0]),
    ]
    assert got(spark, rows) == expected(rows)
    assert got(spark, rows[:1]) == [] and got(spark, []) == []


def test_other_columns_of_the_same_names(spark):
    rows = [(n * 10, [float(n % 4), 1.0 - n]) for n in range(12)]
    names = ("row", "v", "squares", "part", "place", "score", "rank", "query_id")
    table = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit(n) for n in names})
    out = top_products(table, F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, out.collect())) == expected(rows)


def test_large_components_stay_exact(spark):
    rows = [(n * 25, [float(2**22 + n), float(2**22 - 3 * n), 1.0]) for n in range(20)]
    assert got(spark, rows) == expected(rows)


def test_agrees_with_sql(spark):
    folder = "/root/testdata/sf0.01"
    out = QUERIES["op9_top_products"](spark, folder)
    assert differences(out, connect(folder), ORACLE["op9_top_products"]) is None
