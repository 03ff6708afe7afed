import heapq
import uuid
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from terrace.llm import token_output as t

PATH = public_tokenizers.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(PATH)


def huffman_cost(counts):
    heap, cost = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 10**9), min_size=2, max_size=300))
def test_lengths_are_a_best_code(counts):
    counts = np.array(counts)
    free = t.code_lengths(counts, 40)
    assert sum(0.5**n for n in free) == 1 and (free * counts).sum() == huffman_cost(counts.tolist())
    short = t.code_lengths(counts, 9)
    assert short.max() <= 9 and sum(0.5**n for n in short) <= 1


@pytest.mark.parametrize("size", [1, 2, 127, 128, 129, 5000])
@pytest.mark.parametrize("kinds", [1, 2, 500])
def test_round_trip(size, kinds):
    rng = np.random.default_rng(size * kinds)
    ids = (rng.zipf(1.3, size) % kinds * 7).astype(np.int64)
    present, counts = np.unique(ids, return_counts=True)
    code = t.Code(present, t.code_lengths(counts, 18))
    checkpoints, bits = code.encode(ids)
    assert t.decode(checkpoints, bits, size, code.table(), code.bits).tolist() == ids.tolist()
    # canonical: codes ascend with (length, id)
    order = np.lexsort((present, code.length_of[present]))
    left = code.code_of[present[order]] << (code.bits - code.length_of[present[order]]).astype(np.uint64)
    assert (np.diff(left.astype(np.int64)) > 0).all()


def test_bits_of_a_block_are_its_codes_in_order():
    """Also where one code fills whole words and the last one ends with a word; one look-up has id and length."""
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 200, 4096).astype(np.int64)
    present, counts = np.unique(ids, return_counts=True)
    code = t.Code(present, t.code_lengths(counts, 16))
    checkpoints, bits = code.encode(ids)
    want = "".join(format(int(code.code_of[i]), f"0{int(code.length_of[i])}b") for i in ids)
    assert "".join(format(b, "08b") for b in bits)[: len(want)] == want
    entries = code.table()
    first = int(want[: code.bits], 2)
    assert (entries[first] >> np.uint64(8), entries[first] & np.uint64(255)) == (ids[0], code.length_of[ids[0]])
    assert t.decode(checkpoints, bits, len(ids), entries, code.bits).tolist() == ids.tolist()


def ids_of(text):
    return np.array([*LIB.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")


def expected(rows):
    at, out = 0, []
    for doc_id, ids in sorted(((d, ids_of(x)) for d, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32(r[1].astype('<u2').tobytes()))):
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def write(spark, tmp_path, docs):
    path = str(tmp_path / uuid.uuid4().hex)
    t.write_tokens(docs, path, PATH, 1)
    return path


ODD = ["", None, " ", "A\tB\n\nC", "x\u001cy", "é ́e", "Σ ΟΔΟΣ", "<|endoftext|> a<|startoftext|>b",
       "it's we'll 'S", "日本語 テキスト", "🙂" * 30, "a" * 5000, " b c", "İ ﬁ ①", "word " * 40_000,
       "Word, WORD. Ünder! ÀÉ?! İstanbul. ΣΑΣ. it's. 'S, a.b. \x01 x\x01y \u0149a. ß. ẞ! µ, ﬀ. ª: ... ,", ",", "a,;:!?",
       "x\u00a0y\u2003z\u3000w\u0085v\u2028u\x0bt\x0cs\rr", "a\x1db \x1e c\x1f", "\u2000\u0301a \u0301b"]


def test_odd_texts(spark, tmp_path):
    rows = [(None if i == 5 else i // 2, x) for i, x in enumerate(ODD)] + [(0, "")] * 3
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, ids string")
    path = write(spark, tmp_path, docs.repartition(3))
    got = [tuple(r) for r in t.token_digest(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert sorted(got, key=lambda r: r[1]) == expected(rows)
    whole = {r.start: r.ids for r in t.read_tokens(spark, path).collect()}
    assert {s: zlib.crc32(whole[s]) for s in whole} == {r[1]: r[3] for r in got}


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert t.token_digest(spark, write(spark, tmp_path, docs)).count() == 0


def test_given_documents(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = t.token_digest(spark, write(spark, tmp_path, docs)).collect()
    assert sorted(map(tuple, got)) == expected([(r.doc_id, r.text) for r in docs.collect()])
