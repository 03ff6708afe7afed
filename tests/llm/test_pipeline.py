import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from terrace.llm.decontaminate import plain
from tests.llm.test_minhash import roots_of
from tests.llm.test_mixing import copies
from tests.llm.test_token_output import expected as token_rows
from terrace.llm.mixing import rates

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input of each stage and the output of the last, as written."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    seen = {"documents": docs}
    for name, stage in cp.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        seen[name] = docs
    return seen


def texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_columns_stay(stages):
    for name in ("quality", "near_duplicates", "decontamination", "mixing"):
        assert stages[name].columns == stages["documents"].columns


def test_quality_keeps_clean_and_drops_junk(spark, stages):
    kept = set(texts(stages["quality"]))
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    good = [r.doc_id in kept for r in labels if r.quality == 1]
    junk = [r.doc_id in kept for r in labels if r.quality == 0]
    assert sum(good) / len(good) > 0.99 and sum(junk) / len(junk) < 0.05


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_near_duplicates_keep_one_of_each_group(stages):
    sets = {d: shingles(t) for d, t in texts(stages["quality"]).items()}
    holders = {}
    for d, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(d)
    pairs = {(a, b) for h in holders.values() for a in h for b in h if a < b}
    linked = [(a, b) for a, b in pairs if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
    roots = roots_of(linked)
    assert sorted(texts(stages["near_duplicates"])) == sorted(d for d in sets if roots.get(d, d) == d)


def least_errors(items, text):
    """The least edit distance of each item to a part of ``text``, by dynamic programming over its letters."""
    width = max(map(len, items))
    letters = np.zeros((len(items), width), dtype=np.int32)
    for n, item in enumerate(items):
        letters[n, : len(item)] = [ord(c) for c in item]
    steps = np.arange(width + 1)
    column = np.tile(steps, (len(items), 1))
    ends = np.array([len(i) for i in items])
    best = column[np.arange(len(items)), ends].copy()
    for letter in map(ord, text):
        found = np.empty_like(column)
        found[:, 0] = 0
        found[:, 1:] = np.minimum(column[:, :-1] + (letters != letter), column[:, 1:] + 1)
        column = np.minimum.accumulate(found - steps, axis=1) + steps
        best = np.minimum(best, column[np.arange(len(items)), ends])
    return best


def test_decontamination_drops_what_holds_an_item(spark, stages):
    items = [plain(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    allowed = np.array([int(len(i) * 0.1) for i in items])
    before, after = texts(stages["near_duplicates"]), texts(stages["decontamination"])
    whole = {d: plain(t or "") for d, t in before.items()}
    long = [d for d in whole if len(whole[d]) > 20_000][:1]
    gone = sorted(set(before) - set(after))
    assert gone
    for doc_id in long + gone[:15] + sorted(d for d in after if len(whole[d]) < 3000)[:40]:
        held = bool((least_errors(items, whole[doc_id]) <= allowed).any())
        assert held == (doc_id not in after)
    assert all(not any(i in plain(t) for i in items) for t in after.values())


@pytest.mark.parametrize("ids", [[5, 5, 7, None, None], [None] * 5, [8, 8, 8, 8, 8], [None, 3, None, 3, 2]])
def test_near_duplicates_without_and_with_repeated_ids(spark, ids):
    words = [f"w{n}" for n in range(60)]
    near = [" ".join([*words[:-1], f"end{n}"]) for n in range(5)]
    other = " ".join(reversed(words))
    rows = [(i, t, "en", "s", 1) for i, t in zip(ids, near, strict=True)]
    rows += [rows[0], (rows[1][0], rows[1][1], "de", "r", 1), (None, other, "en", "s", 1), (None, other, "de", "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    kept = {tuple(cp.near_duplicates(spark, spark.createDataFrame(rows, schema).repartition(n), FOLDER)
            .orderBy("text").collect()) for n in (1, 3)}
    assert len(kept) == 1
    alike, alone = sorted(next(iter(kept)), key=lambda r: r.text == other)
    assert alone.lang == "de" and alone.doc_id is None
    assert alike.doc_id == min((i for i in ids if i is not None), default=None) and alike.text in near


def test_mixing_draws_every_document(stages):
    before = stages["decontamination"]
    rate = {r.source: r.rate for r in rates(before)[0].collect()}
    got = Counter(r.doc_id for r in stages["mixing"].collect())
    assert got == Counter({r.doc_id: n for r in before.collect() if (n := copies(rate[r.source], 0, r.doc_id))})


def test_token_output_holds_every_copy(stages):
    rows = [(r.doc_id, r.text) for r in stages["mixing"].collect()]
    got = sorted(map(tuple, stages["token_output"].select("doc_id", "start", "n_tokens", "ids_crc32").collect()))
    assert got == sorted(token_rows(rows))


def test_run_is_the_stages(spark, stages):
    got = sorted(map(tuple, cp.run(spark, FOLDER).select("doc_id", "start", "n_tokens", "ids_crc32").collect()))
    assert got == sorted(map(tuple, stages["token_output"].select("doc_id", "start", "n_tokens", "ids_crc32").collect()))


def test_odd_rows_go_through(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(30).withColumn("evidence", F.lit("k"))
    odd = spark.createDataFrame(
        [(None, None, None, None, None, "k"), (None, "", None, None, 0, "k"), (10**9, "", "en", "s", 0, "k"),
         (10**9, "", "en", "s", 0, "k"), (10**9 + 1, "word " * 30_000, None, None, None, "k")],
        docs.schema,
    )
    for frame in (docs.union(odd), docs.limit(0)):
        for name, stage in cp.STAGES:
            found = stage(spark, frame, FOLDER)
            if name != "token_output":
                assert found.columns == docs.columns
            if name == "near_duplicates" and frame.count():
                assert found.where("doc_id >= 1000000000").count() == 2
            found.collect()


def test_crc_is_over_little_endian_longs():
    assert zlib.crc32(b"\x01\x00\x00\x00") == token_rows([(1, "")])[0][3]
