import re

import pytest
import regex

from terrace.llm.license_scan import NOTICES, PHRASES, Scanner, pieces, scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def expected(text):
    words = WORD.findall((text or "").translate(LOWER))
    places = []
    for phrase, label in PHRASES.items():
        want = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(want)] == want]
    starts = [p for p, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in places})))


def check(docs, texts):
    rows = scan(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = expected(texts[r.doc_id])
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score == 1 or not r.n_base)
    return {r.doc_id: r for r in rows}


TEXTS = [
    None, "", "...", "MIT License", "the-MIT_license. Apache\nLicense, CC BY-NC; cc  by cc by", "mit licenses",
    "émit license mit licenseé", "gnu general public license gnu general public license", "cc by by cc cc by",
    "mit license " * 5000, "x" * 100_000, "All rigths reserved.", "All rights re-served", "tall rights reserved",
    "Permission is herby granted, free of charge, to any person obtaning a copy", "nothing of that kind here",
    "ALL RIGHTS RESERVED all rights reserved",
]


def test_odd_texts(spark):
    docs = spark.createDataFrame([(n, t, 1) for n, t in enumerate(TEXTS)], "doc_id long, text string, score int")
    rows = check(docs, TEXTS)
    assert [rows[n].labels for n in (11, 12, 13, 14, 15)] == ["proprietary"] * 3 + ["mit", ""]
    assert rows[11].score == pytest.approx(1 - rows[11].spans[0].errors / 19)
    assert [(s.first_word, s.last_word) for s in rows[16].spans] == [(0, 2), (3, 5)]
    assert scan(docs.limit(0)).count() == 0


def test_null_and_repeated_rows(spark):
    docs = spark.createDataFrame([(None, "mit license"), (1, "x"), (1, "x")], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.labels) for r in scan(docs).collect()) == [("1", ""), ("1", ""), ("None", "mit")]


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check(docs, {r.doc_id: r.text for r in docs.collect()})


def test_pieces_cover_the_notice():
    for notice in NOTICES:
        for errors in (1, 4):
            parts = pieces(notice, errors)
            assert "".join(p for _, p in parts) == notice and len(parts) == errors + 1


def test_no_place_is_missed_by_the_seeds(spark):
    """Labels equal a fuzzy search over the whole text without seeds."""
    scanner = Scanner(PHRASES, NOTICES)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    texts = [r.text[:400] for r in docs] + [t[:400] for t in TEXTS if t]
    for text in texts:
        plain = b" ".join([b"", *scanner.words(text), b""]).decode()
        whole = {label for notice, label in NOTICES.items()
                 if regex.search(rf"(?<= )(?:{regex.escape(notice)}){{e<={len(notice) // 9}}}(?= )", plain)}
        assert {f.label for f in scanner.notices(plain)} == whole
