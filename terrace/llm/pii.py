"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Everything is a column expression.  ``find_spans`` gives each text its spans as an array; a
pattern is run once for the matches and, where there are any, once more to split the text at them, so
that the lengths of pieces and matches add up to positions (code points, end exclusive).

Patterns keep no groups and never give back what they took, so they run in linear time and
without deep recursion on any text; each finds the same matches as the plain pattern
beside it.  Null and empty texts have no spans.  Repeated rows give repeated results; a null
doc_id stays null.  Other columns, whatever their names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LOCAL = "[A-Za-z0-9._%+-]"
_BYTE = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
# Letters of an account number by country, from the public register of IBAN formats.
_ACCOUNTS = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH CR HR LI LV",
    22: "BG BH DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}
# End of fixed values.
_ACCOUNT = "|".join(
    rf"(?:{names.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{size - 4}}}" for size, names in _ACCOUNTS.items()
)
_SPANS = "array<struct<start:int,stop:int,match:string>>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _length_between(text: Column, low: int, high: int) -> Column:
    return F.length(text).between(low, high)


def luhn(digits: Column) -> Column:
    """Whether a text of a few digits passes the Luhn check."""

    def doubled(i: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 0, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    places = F.transform(F.sequence(F.lit(0), F.length(digits) - 1), doubled)
    return F.aggregate(places, F.lit(0), lambda total, d: total + d) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number (country, check digits, rest; no spaces) leaves 1 modulo 97."""
    turned = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))

    def step(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substr(turned, i, F.lit(1)))
        return F.when(code >= 65, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _card(match: Column) -> Column:
    digits = _digits(match)
    return F.when(_length_between(digits, 12, 19), luhn(digits)).otherwise(F.lit(False))


def _account(match: Column) -> Column:
    return mod97(F.regexp_replace(match, " ", ""))


@dataclass(frozen=True)
class Kind:
    """One kind of personal data.

    ``hint`` is a text that every match holds ("" for none).  Spans that pass ``valid``
    score ``score``, and ``lift`` more near one of ``words``; spans of a kind that is not
    ``base`` need ``least``.
    """

    name: str
    pattern: str
    hint: str
    valid: Callable[[Column], Column]
    score: float
    words: str
    base: bool = True
    lift: float = 0.3
    least: float = 0.5


KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+, begun where a run or the last match ends
    Kind(
        "email",
        rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        lambda match: F.lit(True),
        0.6,
        "e-?mail|contact|write|mailto|reach",
    ),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), begun at the first digit of a run
    Kind(
        "ip",
        r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
        ".",
        lambda match: F.rlike(match, F.lit(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")),
        0.4,
        "ip|address|host|server|login",
    ),
    # [0-9]([\x20-]?[0-9])+, only runs of 12 digits and more; the first digit of a run has the most after it
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9]){11,}+",
        "",
        _card,
        0.6,
        "card|credit|visa|payment|debit",
    ),
    # \+[0-9][\x20().0-9-]+[0-9]
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        "+",
        lambda match: _length_between(_digits(match), 9, 15),
        0.4,
        "phone|call|tel|mobile|fax",
    ),
    # of the length of its country, so that it ends before an upper-case word or number that follows
    Kind(
        "iban",
        rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_ACCOUNT})(?![A-Za-z0-9])",
        "",
        _account,
        0.7,
        "iban|account|bank|konto|compte|cuenta",
        base=False,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        "-",
        lambda match: ~F.rlike(match, F.lit("^(?:000|666|9)|-00-|-0000$")),
        0.3,
        "ssn|social security|insurance",
        base=False,
    ),
)


def _placed(text: Column, found: Column, pattern: str) -> Column:
    """Positions of the matches ``found`` of a pattern in a text."""
    pieces = F.slice(F.split(text, pattern, -1), 1, F.size(found))
    steps = F.zip_with(
        pieces, found, lambda p, m: F.struct(F.length(p).alias("skip"), m.alias("match"))
    )

    def add(state: Column, step: Column) -> Column:
        start = state["at"] + step["skip"]
        stop = start + F.length(step["match"])
        span = F.struct(start.alias("start"), stop.alias("stop"), step["match"].alias("match"))
        spans = F.concat(state["spans"], F.array(span))
        return F.struct(stop.alias("at"), spans.alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))
    return F.when(F.size(found) == 0, F.array().cast(_SPANS)).otherwise(
        F.aggregate(steps, begin, add, lambda state: state["spans"])
    )


def _scored(text: Column, number: int, kind: Kind, around: int) -> Callable[[Column], Column]:
    def score(span: Column) -> Column:
        first = F.greatest(span["start"] - around, F.lit(0))
        near = F.concat_ws(
            " ",
            F.substr(text, first + 1, span["start"] - first),
            F.substr(text, span["stop"] + 1, F.lit(around)),
        )
        lifted = F.rlike(near, F.lit(rf"(?i)\b(?:{kind.words})\b"))
        value = F.lit(kind.score) + F.when(lifted, F.lit(kind.lift)).otherwise(F.lit(0.0))
        return F.struct(
            span["start"].alias("start"),
            F.lit(number).alias("kind"),
            span["stop"].alias("stop"),
            F.round(value, 3).alias("score"),
        )

    return score


def _passes(kind: Kind) -> Callable[[Column], Column]:
    return lambda span: kind.valid(span["match"])


def _scores_at_least(least: float) -> Callable[[Column], Column]:
    return lambda span: span["score"] >= least


def _is_kind(number: int) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == number


def find_spans(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS, around: int = 40) -> DataFrame:
    """doc_id and ``spans``: an array of start, kind (place in ``kinds``), stop and score."""
    text = F.col("text")

    def matches(kind: Kind) -> Column:
        found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
        if not kind.hint:
            return found
        return F.when(F.contains(text, F.lit(kind.hint)), found).otherwise(
            F.array().cast("array<string>")
        )

    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", "text", *(matches(k).alias(f"found_{k.name}") for k in kinds)
    )
    placed = found.select(
        "doc_id",
        "text",
        *(
            F.filter(
                _placed(text, F.col(f"found_{k.name}"), k.pattern),
                _passes(k),
            ).alias(f"placed_{k.name}")
            for k in kinds
        ),
    )
    scored = [
        F.transform(F.col(f"placed_{k.name}"), _scored(text, n, k, around))
        for n, k in enumerate(kinds)
    ]
    kept = [
        s if k.base else F.filter(s, _scores_at_least(k.least))
        for s, k in zip(scored, kinds, strict=True)
    ]
    return placed.select("doc_id", F.array_sort(F.concat(*kept)).alias("spans"))


def _joined(spans: Column, kinds: tuple[Kind, ...]) -> Column:
    names = F.array(*(F.lit(k.name) for k in kinds))
    text = F.transform(
        spans,
        lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"]),
    )
    return F.array_join(text, ",")


def report(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, all spans, and the highest score."""
    base = [n for n, k in enumerate(kinds) if k.base]
    spans = F.col("spans")
    of_base = F.filter(spans, lambda s: s["kind"].isin(base))
    highest = F.array_max(F.transform(spans, lambda s: s["score"]))
    return find_spans(docs, kinds).select(
        "doc_id",
        *(
            F.size(F.filter(spans, _is_kind(n)))
            .cast("long")
            .alias(f"n_{kinds[n].name}")
            for n in base
        ),
        F.sha2(_joined(of_base, kinds), 256).alias("base_sha256"),
        _joined(spans, kinds).alias("spans"),
        F.coalesce(highest, F.lit(0.0)).alias("score"),
    )
