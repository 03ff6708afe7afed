import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from terrace.llm.pii import report

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def expected(text):
    spans = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            if passes(kind, m.group()):
                spans.append((m.start(), order, m.end(), kind))
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(spans)]


def check(row, text):
    base = expected(text)
    assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest(), (text, row.spans)
    spans = row.spans.split(",") if row.spans else []
    assert [s for s in spans if s.split(":")[0] in BASE] == base
    for kind in BASE:
        assert row[f"n_{kind}"] == sum(s.startswith(kind + ":") for s in base)


def run(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in report(rows).collect()}


TEXTS = [
    None, "", "a@b.c_d@e.f", "a@b", "x.y@z.co.uk.", "@a.b", "a@b..c d@e.f-", "..%@a.b",
    "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.1", "0001.02.3.255", "1.2.3", "99999999999999999999.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "5 4111111111111111", "4111  1111 1111 1111",
    "41111111111111111111111111111", "x4111 1111 1111 1111y", "+1 (555) 123-4567.", "+12", "+1++44 20 7946 0958",
    "🙂 a@b.c 🙂 +44 20 7946 0958", "日本a@b.cd", "1 " * 3000, "a" * 200_000, "a.b@" * 2000, "1" * 100_000,
    "a@" + "b." * 20_000 + "c", "+1" + "-" * 50_000, "12 " * 30_000, "7.7.7.7 " * 400,
]


def test_odd_texts(spark):
    for n, row in run(spark, TEXTS).items():
        check(row, TEXTS[n])


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aZ09412.-+@ ()_%é🙂", max_size=60), min_size=50, max_size=200))
def test_any_text(spark, texts):
    for n, row in run(spark, texts).items():
        check(row, texts[n])


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = report(docs).collect()
    assert len(rows) == len(texts)
    for row in rows:
        check(row, texts[row.doc_id])


@pytest.mark.parametrize(
    ("text", "spans", "score"),
    [
        ("IBAN DE89 3704 0044 0532 0130 00 ok", "iban:5:32", 1.0),
        ("xx DE88 3704 0044 0532 0130 00 ok", "", 0.0),
        ("IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX", "iban:5:32", 1.0),
        ("DE89370400440532013000 EUR 500", "iban:0:22", 0.7),
        ("GB82 WEST 1234 5698 7654 32 A note", "iban:0:27", 0.7),
        ("DE89370400440532013000 GB82WEST12345698765432", "iban:0:22,iban:23:45", 0.7),
        ("FR14 2004 1010 0505 0001 3M02 606 NO93 8601 1117 947", "iban:0:33,iban:34:52", 0.7),
        ("DE89370400440532013000X GB82WEST1234569876543", "", 0.0),
        ("my SSN is 123-45-6789", "ssn:10:21", 0.6),
        ("part 123-45-6789", "", 0.0),
        ("pay by card 4111 1111 1111 1111", "card:12:31", 0.9),
        ("4111 1111 1111 1111", "card:0:19", 0.6),
    ],
)
def test_checksums_and_context(spark, text, spans, score):
    row = run(spark, [text])[0]
    assert (row.spans, row.score) == (spans, score)


def test_native_and_odd_tables(spark):
    docs = spark.createDataFrame(
        [(None, "a@b.c", 1), (1, None, 2), (1, None, 2)], "doc_id long, text string, spans int"
    )
    out = report(docs)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.doc_id, r.spans) for r in out.collect() if r.doc_id) == [(1, ""), (1, "")]
    assert report(docs.limit(0)).count() == 0
