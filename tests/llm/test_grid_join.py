"""Near vectors against brute force and SQL."""

import math

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from terrace.llm.grid_join import Settings, near_vectors
from terrace.llm.queries import ORACLE, QUERIES
from tests.oracle import connect, differences

SMALL = Settings(interval=16, leaf=4, axes=3)


def brute(rows, similar=0.9):
    """{(vec_id, n_links, component_id, kept): times} of (vec_id, vector) rows."""
    width = max((len(v) for _, v in rows if v), default=0)
    usable = [
        bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows
    ]
    units = []
    for (_, v), good in zip(rows, usable, strict=True):
        unit = np.zeros(width)
        if good:
            unit[: len(v)] = np.asarray(v, dtype=np.float64) / np.abs(v).max()
            unit /= np.sqrt(unit @ unit)
        units.append(unit)
    near = [
        [j for j in range(len(rows)) if i != j and usable[i] and usable[j] and units[i] @ units[j] >= similar]
        for i in range(len(rows))
    ]
    found = []
    for i, (vec_id, _) in enumerate(rows):
        seen, open_ones = {i}, [i]
        while open_ones:
            for j in near[open_ones.pop()]:
                if j not in seen:
                    seen.add(j)
                    open_ones.append(j)
        name = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        found.append((vec_id, len(near[i]), name, vec_id == name))
    return sorted(found, key=str)


def table_of(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


def check(spark, rows, settings=SMALL, kind="float"):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows]
    if kind == "float":
        rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    found = near_vectors(table_of(spark, rows, kind), settings)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows)


def clustered(count, width=6, spread=0.25, seed=3):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(12, width))
    return [
        (n, ((centres[n % 12] + spread * random.normal(size=width)) * random.uniform(0.1, 9)).tolist())
        for n in range(count)
    ]


@pytest.mark.parametrize("settings", [SMALL, Settings(), Settings(interval=7, leaf=2, axes=6)])
def test_clusters(spark, settings):
    rows = clustered(150)
    assert 0 < sum(n > 0 for _, n, _, _ in brute(rows)) < 150
    check(spark, rows, settings)


def test_chains_and_provably_near_parts(spark):
    turned = [(n, [math.cos(0.05 * n), math.sin(0.05 * n), 0.0]) for n in range(90)]
    tight = [(1000 + n, [1e-3 * n, 1e-4 * n, 5.0]) for n in range(60)]
    check(spark, turned + tight, Settings(interval=16, leaf=2, axes=2))


def test_copies_of_one_vector_and_a_large_group(spark):
    copies = [(n, [1.0, 2.0, 2.0]) for n in range(40)] + [(100, [2.0, 4.0, 4.0]), (101, [-1.0, -2.0, -2.0])]
    check(spark, copies, Settings(interval=16, leaf=2, axes=2, heavy=4))


def test_nulls_zeros_repeats_and_extreme_numbers(spark):
    rows = [
        (None, [1.0, 0.0]), (1, [1.0, 0.01]), (1, [1.0, 0.02]), (2, None), (3, []), (4, [0.0, -0.0]),
        (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [0.0, 3.0]),
        (9, [0.0, 1e-30]), (10, [0.0, 1e30]), (None, None), (11, [-0.0, 2.0]), (12, [5.0]), (2, [1.0, 0.0]),
    ]
    check(spark, rows)
    check(spark, [*rows, (13, [0.0, 1e300]), (14, [0.0, 1e-300])], kind="double")
    check(spark, [(None, [1.0]), (None, [2.0])])


def test_empty_table_single_row_and_other_columns(spark):
    assert near_vectors(table_of(spark, []), SMALL).count() == 0
    check(spark, [(1, None)])
    check(spark, [(1, [1.0])])
    rows = table_of(spark, [(1, [1.0, 0.0]), (2, [1.0, 0.1])])
    for clash in ("node", "weight", "x", "interval", "kept", "n_links", "at"):
        rows = rows.selectExpr("*", f"7 AS {clash}")
    assert sorted(tuple(r) for r in near_vectors(rows, SMALL).collect()) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_query_agrees_with_sql(spark, sf_dir, tmp_path):
    query, sql = QUERIES["op11_embedding_duplicates"], ORACLE["op11_embedding_duplicates"]
    assert differences(query(spark, sf_dir), connect(sf_dir), sql) is None
    ids, vectors = zip(*clustered(80), strict=True)
    kinds = pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32()))])
    pq.write_table(pa.table([ids, vectors], schema=kinds), tmp_path / "embeddings.parquet")
    assert differences(query(spark, str(tmp_path)), connect(str(tmp_path)), sql) is None
