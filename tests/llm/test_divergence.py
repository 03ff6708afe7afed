"""Differences of sources against SQL, on given and odd documents."""

import pandas as pd
import pytest

from terrace.llm.divergence import Settings, source_divergence
from terrace.llm.queries import ORACLE, QUERIES
from tests.oracle import connect, differences

NAME = "op13_source_divergence"
SCHEMA = "doc_id long, text string, lang string, source string"


def check(spark, tmp_path, rows, settings=Settings()):
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source"])
    frame = frame.astype({"doc_id": "Int64", "text": "string", "lang": "string", "source": "string"})
    path = str(tmp_path / "documents.parquet")
    frame.to_parquet(path)
    found = source_divergence(spark.read.parquet(path), settings)
    assert differences(found, connect(str(tmp_path)), ORACLE[NAME]) is None
    return found


@pytest.mark.parametrize("terms_per_fit", [2_000_000, 100])
def test_query_agrees_with_sql(spark, sf_dir, terms_per_fit):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = source_divergence(documents, Settings(terms_per_fit=terms_per_fit))
    assert differences(found, connect(sf_dir), ORACLE[NAME]) is None
    assert found.columns == QUERIES[NAME](spark, sf_dir).columns


def odd_rows():
    words = ["Apple", "éCOLE", "ÀB", "日本", "x1y", "a-b", "\x01mark", "\U0001f600", "don't", "Z"]
    rows = []
    for n in range(60):
        text = " ".join(words[(n * k) % 10] * (1 + n % 2) for k in range(1, 2 + n % 9))
        rows.append((n, text, ["en", "de", None, ""][n % 4], ["s1", "s2", None, "S1", "s\x01"][n % 5]))
    rows += [(100 + n, t, "en", "only") for n, t in enumerate([None, "", "1 2 3"])]
    rows += [(200, "rare words here", "fr", "a"), (201, "rare", "fr", "b"), (None, "Apple", "en", "s1")]
    return rows + rows[:20]


@pytest.mark.parametrize("terms_per_fit", [2_000_000, 2])
def test_nulls_empty_texts_ties_and_repeated_rows(spark, tmp_path, terms_per_fit):
    found = check(spark, tmp_path, odd_rows(), Settings(terms_per_fit=terms_per_fit))
    assert found.where("lang = 'fr' AND part = 'pair' AND value = 0").count() == 2
    assert found.where("lang = 'en' AND source = 'only' AND part = 'pair' AND value > 0").count() > 0


def test_no_kept_term_and_no_document(spark, tmp_path):
    assert check(spark, tmp_path, [(1, "a b", "en", "s"), (2, "b", "en", "t")]).count() == 2
    assert check(spark, tmp_path, []).count() == 0


def test_long_text(spark, tmp_path):
    rows = [(n, "long " * 200_000 + "tail", "en", "s" if n else "t") for n in range(12)]
    assert check(spark, tmp_path, rows).where("part = 'term'").count() > 0


def test_counts_beyond_64_bits_times_scale(spark):
    from pyspark.sql import functions as F

    from terrace.llm.divergence import _share

    row = spark.range(1).select(
        _share(F.lit(10**13), F.lit(3 * 10**15), F.lit(10**9), 10**9).alias("p")
    ).first()
    assert row["p"] == 1 + 10**9 * (10**13 + 2) // (3 * 10**15 + 2 * 10**9)


def test_other_columns(spark):
    rows = spark.createDataFrame([(n, "same words", "en", f"s{n % 2}") for n in range(20)], SCHEMA)
    plain = sorted(map(tuple, source_divergence(rows).collect()))
    for clash in ("term", "count", "value", "rank", "row", "part", "terms", "vector"):
        rows = rows.selectExpr("*", f"'7' AS {clash}")
    assert sorted(map(tuple, source_divergence(rows).collect())) == plain
