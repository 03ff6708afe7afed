import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from terrace.llm.token_count import PairCounter, count_tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def counter():
    return PairCounter(MODEL)


ODD = ["", " ", "  ", "a", "\n", "a\n\nb", "▁", "a ▁ b", "<s> </s> <unk> <0x0A>", "日本語のテキスト",
       "x" * 3000, "a  b   c", "\t tab", "é" * 50, "\u0000z", "🙂🙂", "ﬁ Ⅷ", " " * 500, "ab" * 2000]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text, library, counter):
    assert counter.count(text) == len(library.encode(text))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n▁abetnoi<>0x,."), st.characters(exclude_categories=["Cs"]))))
def test_any_text(text):
    assert PAIR.count(text) == len(LIB.encode(text))


PAIR, LIB = PairCounter(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_query_counts_as_the_library(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: r for r in count_tokens(docs, MODEL).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.doc_id].n_tokens == len(library.encode(r.text))
        assert got[r.doc_id].n_bytes == len(r.text.encode())
        assert got[r.doc_id].over_limit == (got[r.doc_id].n_tokens > 4096)


def test_nulls_repeats_and_clashing_columns(spark):
    docs = spark.createDataFrame(
        [(1, None, 5), (1, None, 5), (None, "a b", 6), (2, "", 7)], "doc_id long, text string, n_tokens int"
    )
    got = sorted(map(tuple, count_tokens(docs, MODEL).collect()), key=str)
    assert got == sorted([(1, 0, 0, False)] * 2 + [(None, 3, 2, False), (2, 0, 0, False)], key=str)
    assert count_tokens(docs.limit(0), MODEL).count() == 0
