import math
from collections import defaultdict

import numpy as np
import pytest

from terrace.llm.site_quality import Model, Settings, classify, measures

FOLDER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    train = labels.where("doc_id % 2 = 0")
    held = {r.doc_id: r.quality for r in labels.where("doc_id % 2 = 1").collect()}
    rows = [(held[r.doc.doc_id], r.kept) for r in classify(docs, train).collect() if r.doc.doc_id in held]
    good = [k for q, k in rows if q == 1]
    junk = [k for q, k in rows if q == 0]
    assert len(junk) > 150 and np.mean(good) > 0.998 and np.mean(junk) < 0.02


def strength(mean, variance):
    return min(max(mean * (1 - mean) / max(variance, 1e-9) - 1, 1.0), Settings().strongest)


def odds(rate):
    rate = min(max(rate, 1e-6), 1 - 1e-6)
    return math.log(rate / (1 - rate))


def test_posteriors_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = classify(docs, labels).collect()
    paths, hosts = defaultdict(list), defaultdict(list)
    for r in rows:
        p = 1 / (1 + math.exp(-r.evidence))
        paths[r.doc.source, r.doc.lang].append(p)
        hosts[r.doc.source].append(p)
    n = len(rows)
    overall = sum(map(sum, hosts.values())) / n
    rates = {h: (len(v), sum(v) / len(v)) for h, v in hosts.items()}
    spread = sum(k * r * r - r * (1 - r) for k, r in rates.values()) / n - overall**2
    s = strength(overall, spread)
    host_rate = {h: (sum(v) + overall * s) / (len(v) + s) for h, v in hosts.items()}
    inner = sum(
        len(v) * (sum(v) / len(v) - host_rate[h]) ** 2 - sum(v) / len(v) * (1 - sum(v) / len(v))
        for (h, _), v in paths.items()
    ) / n
    t = strength(overall, inner)
    for r in rows:
        h, v = host_rate[r.doc.source], paths[r.doc.source, r.doc.lang]
        p = 1 / (1 + math.exp(-r.evidence))
        path_rate = (sum(v) - p + h * t) / (len(v) - 1 + t)
        final = r.evidence + 0.5 * (odds(path_rate) - odds(overall))
        assert r.host_rate == pytest.approx(h) and r.path_rate == pytest.approx(path_rate)
        assert r.probability == pytest.approx(1 / (1 + math.exp(-final)))
        assert r.kept == (r.probability >= 0.5)


def test_sites_move_what_texts_leave_open(spark):
    model_rows = [(n, "good words here " * 3 if n % 2 else "BAD!! BAD!! BAD!!", "s", "l") for n in range(200)]
    sites = [(1000 + n, "BAD!! BAD!! BAD!!", "bad", "l") for n in range(300)] + [(2000, "some text", "bad", "l")]
    docs = spark.createDataFrame(model_rows + sites, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(n, n % 2) for n in range(200)], "doc_id long, quality int")
    rows = {r.doc.doc_id: r for r in classify(docs, labels).collect()}
    assert rows[2000].path_rate < 0.1 < 0.4 < rows[1].path_rate
    assert not rows[1000].kept and rows[1].kept


def test_odd_tables(spark):
    schema = "doc_id long, text string, source string, lang string, p int, kept string"
    rows = [(1, None, None, None, 1, "k"), (2, "", "a", None, 1, "k"), (None, "text " * 50_000, None, "l", 1, "k"),
            (3, "B!! " * 9, "a", "l", 1, "k"), (3, "B!! " * 9, "a", "l", 1, "k"), (4, "good words here", "a", "l", 1, "k")]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(3, 0), (4, 1), (None, 1), (5, 0), (4, None)], "doc_id long, quality int")
    got = classify(docs, labels).collect()
    assert sorted(map(str, (r.doc.doc_id for r in got))) == ["1", "2", "3", "3", "4", "None"]
    assert all(r.kept for r in got if not r.doc.text) and len({r.probability for r in got if r.doc.doc_id == 3}) == 1
    assert all(r.kept for r in classify(docs, labels.limit(0)).collect())
    assert classify(docs.limit(0), labels).count() == 0


def test_model_of_one_kind_knows_nothing():
    model = Model(np.array([measures("a b")] * 3), np.ones(3))
    assert model.log_odds(np.zeros((2, 18))).tolist() == [0, 0]
