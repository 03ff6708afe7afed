"""Benchmark decontamination by pigeonhole edit matching.

With at most e errors, at least one of e + 1 pieces of a test item stands in the document
unchanged.  One automaton over all pieces finds those places.  A window around one is left if more
than e of the item's blocks, half as long as pieces, are missing in it; Myers' bit-parallel distance
decides in the others.  Items and documents are compared as lower-case words joined by
single spaces, so case, punctuation and line breaks do not matter.

The automaton holds at most ``group_letters`` letters of items.  A larger benchmark is cut into
groups by hash, and the documents are passed once for each group; nothing else grows with the
benchmark.  Documents are never shuffled.

Null, empty and wordless texts or items match nothing.  Very long texts are looked at whole.
Repeated rows give repeated results; a null doc_id or item_id stays null.  Other columns, whatever their
names, are not read; an empty table on either side matches nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.session import scratch_path

_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_TO_WORDS = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS))


def plain(text: str) -> str:
    """Lower-case words with a space before, between and after; "" without words."""
    words = text.lower().encode().translate(_TO_WORDS).split()
    return f" {b' '.join(words).decode()} " if words else ""


class Item:
    """A test item: its plain text, the errors it allows, and bit masks of its letters."""

    def __init__(self, text: str, error_rate: float):
        self.text = text
        self.errors = int(len(text) * error_rate)
        self._forward, self._backward = self._masks(text), self._masks(text[::-1])
        size = max(1, len(text) // (2 * self.errors + 2))
        self._blocks = [text[a : a + size] for a in range(0, len(text) - size + 1, size)]

    @staticmethod
    def _masks(text: str) -> dict[str, int]:
        masks: dict[str, int] = {}
        for place, letter in enumerate(text):
            masks[letter] = masks.get(letter, 0) | 1 << place
        return masks

    def pieces(self) -> list[tuple[int, str]]:
        parts = self.errors + 1
        bounds = [len(self.text) * i // parts for i in range(parts + 1)]
        return [(a, self.text[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]

    def may_hold(self, text: str) -> bool:
        """False where no part of ``text`` is within the errors: each error spoils one block at most."""
        spoilt = 0
        for block in self._blocks:
            if block not in text:
                spoilt += 1
                if spoilt > self.errors:
                    return False
        return True

    def _distances(self, masks: dict[str, int], text: str) -> Iterator[int]:
        """Distance of the item to the best part of ``text`` that ends at each letter."""
        full = (1 << len(self.text)) - 1
        top = 1 << len(self.text) - 1
        up, down, score = full, 0, len(self.text)
        for letter in text:
            equal = masks.get(letter, 0)
            vertical = equal | down
            horizontal = (((equal & up) + up) ^ up) | equal
            plus = down | (full & ~(horizontal | up))
            minus = up & horizontal
            score += bool(plus & top) - bool(minus & top)
            plus, minus = plus << 1, minus << 1
            up = (minus | ~(vertical | plus)) & full
            down = plus & vertical & full
            yield score

    def best(self, text: str) -> tuple[int, int, int] | None:
        """(distance, start, stop) of the best part of ``text`` if within the errors; first of equals."""
        distance, stop = min(
            ((d, i + 1) for i, d in enumerate(self._distances(self._forward, text))),
            default=(self.errors + 1, 0),
        )
        if distance > self.errors:
            return None
        back = text[:stop][::-1][: len(self.text) + self.errors]
        size = next(
            i + 1
            for i, d in enumerate(self._distances_from_start(back))
            if d == distance
        )
        return distance, stop - size, stop

    def _distances_from_start(self, text: str) -> Iterator[int]:
        """Distance of the reversed item to each prefix of ``text``."""
        # a leading shift-in of 1 anchors the start
        full = (1 << len(self.text)) - 1
        top = 1 << len(self.text) - 1
        up, down, score = full, 0, len(self.text)
        for letter in text:
            equal = self._backward.get(letter, 0)
            vertical = equal | down
            horizontal = (((equal & up) + up) ^ up) | equal
            plus = down | (full & ~(horizontal | up))
            minus = up & horizontal
            score += bool(plus & top) - bool(minus & top)
            plus, minus = plus << 1 | 1, minus << 1
            up = (minus | ~(vertical | plus)) & full
            down = plus & vertical & full
            yield score


class Matcher:
    """Finds items in plain texts."""

    def __init__(self, items: list[tuple[str | None, str]], error_rate: float):
        import ahocorasick

        self._items = [(item_id, Item(text, error_rate)) for item_id, text in items]
        self._pieces = ahocorasick.Automaton()
        places: dict[str, list[tuple[int, int]]] = {}
        for number, (_, item) in enumerate(self._items):
            for place, piece in item.pieces():
                places.setdefault(piece, []).append((number, place))
        for piece, where in places.items():
            self._pieces.add_word(piece, (len(piece), where))
        if places:
            self._pieces.make_automaton()

    def find(self, text: str) -> list[tuple[str | None, int, int, int]]:
        """(item_id, distance, start, stop): the best place of each item in a plain text."""
        if not self._items or not text:
            return []
        windows: dict[int, list[tuple[int, int]]] = {}
        for last, (size, where) in self._pieces.iter(text):
            for number, place in where:
                item = self._items[number][1]
                start = last + 1 - size - place - item.errors
                windows.setdefault(number, []).append((start, start + len(item.text) + 2 * item.errors))
        found = []
        for number, all_windows in sorted(windows.items()):
            item_id, item = self._items[number]
            best, seen = None, None
            for a, b in sorted(set(all_windows)):
                a = max(a, 0)
                if seen is not None and b <= seen or not item.may_hold(text[a:b]):
                    continue
                if seen is not None and a < seen and a - begun <= 2 * item.errors:
                    a = begun  # pieces of one place: look at it once more as a whole
                begun, seen = a, b
                match = item.best(text[a:b])
                if match and (best is None or match[0] < best[0]):
                    best = (match[0], a + match[1], a + match[2])
            if best:
                found.append((item_id, *best))
        return found


def find_items(
    docs: DataFrame,
    benchmark: DataFrame,
    error_rate: float = 0.1,
    group_letters: int = 4_000_000,
) -> DataFrame:
    """doc_id, item_id, distance and the words (from 0) of each item's best place in each document."""
    cleaned, groups = _cleaned(benchmark, group_letters)
    if groups == 1:
        return _found(docs, _group(cleaned), error_rate)
    path = scratch_path(docs.sparkSession, "decontaminate")
    for number in range(groups):
        part = _group(cleaned.where(F.col("part") == number))
        _found(docs, part, error_rate).write.mode("append").parquet(path)
    return docs.sparkSession.read.parquet(path)


def without_items(
    docs: DataFrame,
    benchmark: DataFrame,
    error_rate: float = 0.1,
    group_letters: int = 4_000_000,
) -> DataFrame:
    """The rows of ``docs`` that hold no item; rows stay where they are, nothing is shuffled.

    With several groups of items, the rows that are left are written after each but the last, so that a
    task holds the automaton of one group only, whatever the benchmark's size.
    """
    cleaned, groups = _cleaned(benchmark, group_letters)
    path = scratch_path(docs.sparkSession, "without-items")
    for number in range(groups):
        items = _group(cleaned.where(F.col("part") == number))
        docs = docs.where(~_holds(items, error_rate, F.coalesce("text", F.lit(""))))
        if number < groups - 1:
            docs.write.parquet(f"{path}/{number}")
            docs = docs.sparkSession.read.parquet(f"{path}/{number}")
    return docs


def _holds(items: list[tuple[str | None, str]], error_rate: float, text: Column) -> Column:
    @F.pandas_udf("boolean")
    def holds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(items, error_rate)
        for texts in batches:
            yield pd.Series([bool(matcher.find(plain(t))) for t in texts], dtype=bool)

    return holds(text)


def _cleaned(benchmark: DataFrame, group_letters: int) -> tuple[DataFrame, int]:
    """Items with the group (``part``) each is in, and the number of groups."""
    cleaned = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    letters = cleaned.agg(F.sum(F.length("text"))).first()[0] or 0
    groups = letters // group_letters + 1
    return cleaned.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(groups))), groups


def _group(items: DataFrame) -> list[tuple[str | None, str]]:
    texts = [(r.item_id, plain(r.text)) for r in items.select("item_id", "text").collect()]
    return [(item_id, text) for item_id, text in texts if text]


def _found(docs: DataFrame, items: list[tuple[str | None, str]], error_rate: float) -> DataFrame:
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(items, error_rate)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                text = plain(text)
                for item_id, distance, start, stop in matcher.find(text):
                    first = text.count(" ", 0, start + 1) - (text[start] == " ")
                    last = text.count(" ", 0, stop - 1) - 1
                    out.append((doc_id, item_id, distance, first, max(first, last)))
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "distance", "first_word", "last_word"])

    # ids travel as text: a nullable long would turn into double in pandas
    named = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    schema = "doc_id string, item_id string, distance long, first_word long, last_word long"
    ids = {n: F.col(n).cast("long") for n in ("doc_id", "item_id")}
    return named.mapInPandas(rows, schema).withColumns(ids)
