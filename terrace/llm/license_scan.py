"""License scans: exact phrases, and short notices with a bounded number of errors.

Words are runs of letters, digits and bytes above ASCII.  A phrase is found where its words
stand one after another.  A notice is searched fuzzily: with at most e errors at least one of
e + 1 pieces of it stands in the text unchanged, so exact pieces (found by one automaton over
all notices) give the places where it may be, and the regex library's bounded-error
matching decides there and reports the span.

Both run on the words of a text joined by single spaces, lower-cased (A-Z).  Null and empty
texts have no words, no labels and score 0.  Very long texts are looked at in one pass;
repeated rows give repeated results; a null doc_id stays null.  Other columns, whatever their names,
are not read; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Short notices by label.
NOTICES = {
    "all rights reserved": "proprietary",
    "licensed under the apache license version 2 0": "apache",
    "licensed under cc by": "cc-by",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "creative commons attribution": "cc-by",
    "this work is licensed under the gnu general public license version 3": "gpl",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "released under the mit license": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "this program is free software you can redistribute it": "gpl",
    "mozilla public license": "mpl",
    "dedicated to the public domain": "public-domain",
    "spdx license identifier": "spdx",
}

_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_TO_WORDS = bytes.maketrans(
    _SEPARATORS + bytes(range(0x41, 0x5B)), b" " * len(_SEPARATORS) + bytes(range(0x61, 0x7B))
)
_SPAN = "struct<label:string,first_word:bigint,last_word:bigint,errors:int>"


@dataclass(frozen=True)
class Found:
    """A notice in a text: its label, its first and last word, and its errors."""

    label: str
    first_word: int
    last_word: int
    errors: int
    length: int


def pieces(notice: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of a notice that cover it, with their places."""
    bounds = [len(notice) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, notice[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]


class Scanner:
    """Looks for phrases and notices; ``per_error`` letters allow one error."""

    def __init__(self, phrases: dict[str, str], notices: dict[str, str], per_error: int = 9):
        import ahocorasick
        import regex

        self._phrases = {f" {p} ".encode(): label for p, label in phrases.items()}
        self._notices = []
        self._seeds = ahocorasick.Automaton()
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, (notice, label) in enumerate(notices.items()):
            errors = len(notice) // per_error
            # the errors must not spoil the ends: a match starts and ends at a word
            pattern = regex.compile(rf"(?b)(?<= )(?:{regex.escape(notice)}){{e<={errors}}}(?= )")
            self._notices.append((notice, label, errors, pattern))
            for place, piece in pieces(notice, errors):
                seeds.setdefault(piece, []).append((number, place))
        for piece, places in seeds.items():
            self._seeds.add_word(piece, (len(piece), places))
        self._seeds.make_automaton()

    @staticmethod
    def words(text: str) -> list[bytes]:
        return text.encode().translate(_TO_WORDS).split()

    def base(self, plain: bytes) -> list[tuple[int, str]]:
        """First word and label of every place of a phrase; ``plain``: " word word "."""
        found = []
        for phrase, label in self._phrases.items():
            at, word, counted = plain.find(phrase), 0, 0
            while at >= 0:
                word += plain.count(b" ", counted, at)
                found.append((word, label))
                counted = at
                at = plain.find(phrase, at + 1)
        return found

    def candidates(self, plain: str) -> dict[int, list[tuple[int, int]]]:
        """Windows, merged where they overlap, in which each notice may stand."""
        windows: dict[int, list[tuple[int, int]]] = {}
        for last, (size, places) in self._seeds.iter(plain):
            for number, place in places:
                notice, _, errors, _ = self._notices[number]
                start = last + 1 - size - place - errors - 1
                windows.setdefault(number, []).append((start, start + len(notice) + 2 * errors + 2))
        merged = {}
        for number, all_windows in windows.items():
            kept: list[tuple[int, int]] = []
            for a, b in sorted(all_windows):
                if kept and a <= kept[-1][1] - len(self._notices[number][0]) // 2:
                    kept[-1] = (kept[-1][0], max(b, kept[-1][1]))
                else:
                    kept.append((a, b))
            merged[number] = kept
        return merged

    def notices(self, plain: str) -> list[Found]:
        """Notices in " word word ", the best match in each window."""
        found: dict[tuple[int, int], Found] = {}
        starts: list[int] | None = None
        for number, windows in self.candidates(plain).items():
            notice, label, _, pattern = self._notices[number]
            for a, b in windows:
                for match in pattern.finditer(plain, max(a, 0), min(b, len(plain))):
                    if starts is None:
                        starts = [i + 1 for i, c in enumerate(plain) if c == " "]
                    first = bisect_right(starts, match.start()) - 1
                    last = bisect_right(starts, match.end() - 1) - 1
                    one = Found(label, first, last, sum(match.fuzzy_counts), len(notice))
                    found[(number, first)] = one
        return sorted(found.values(), key=lambda f: (f.first_word, f.label))


def scan(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    notices: dict[str, str] = NOTICES,
) -> DataFrame:
    """Per row: doc_id, n_words, places of phrases, labels, score, and the notices' spans.

    ``score`` is 1 where a phrase stands, else the share of letters of the best notice
    that are free of errors, else 0.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(phrases, notices)
        for batch in batches:
            out = []
            for text in batch["text"]:
                words = scanner.words(text)
                plain = b" " + b" ".join(words) + b" "
                base = scanner.base(plain)
                fuzzy = scanner.notices(plain.decode())
                labels = {label for _, label in base}
                closeness = max((1 - f.errors / f.length for f in fuzzy), default=0.0)
                out.append(
                    (
                        len(words),
                        len(base),
                        str(min(base)[0]) if base else None,
                        str(max(base)[0]) if base else None,
                        ",".join(sorted(labels)),
                        ",".join(sorted(labels | {f.label for f in fuzzy})),
                        1.0 if base else closeness,
                        [(f.label, f.first_word, f.last_word, f.errors) for f in fuzzy],
                    )
                )
            names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
            frame = pd.DataFrame(out, columns=names)
            frame.insert(0, "doc_id", batch["doc_id"])
            yield frame

    # nullable longs travel as text, since pandas would make doubles of them
    schema = (
        "doc_id string, n_words long, n_base long, first_word string, last_word string, "
        f"base_labels string, labels string, score double, spans array<{_SPAN}>"
    )
    named = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    numbers = {n: F.col(n).cast("long") for n in ("doc_id", "first_word", "last_word")}
    return named.mapInPandas(rows, schema).withColumns(numbers)
