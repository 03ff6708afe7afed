"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut where no piece of the vocabulary can reach across, and each unit is merged
on its own: its symbols form a linked list, a heap hands out the adjacent pair that the
vocabulary ranks lowest (leftmost first), and every merge takes one symbol away.  The count is
what is left; no identifiers are made.  A symbol that is no piece counts its UTF-8 bytes, as
byte fallback writes them.

Null and empty texts have 0 tokens.  Very long units (text without spaces) take n log n
steps.  Rows keep their doc_id, null or repeated; other columns are not read.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
_CACHED_UNITS = 150_000
_CACHED_LENGTH = 48
_LIST_BELOW = 1_000_000


def count_after_merges(unit: str, ranks: dict[str, float]) -> int:
    """Symbols left of one unit once no adjacent pair is in ``ranks`` any more."""
    symbols = list(unit)
    last = len(symbols) - 1
    before = list(range(-1, last))
    after = list(range(1, last + 2))
    heap = []
    for i in range(last):
        pair = symbols[i] + symbols[i + 1]
        if pair in ranks:
            heap.append((ranks[pair], i, i + 1, pair))
    heapq.heapify(heap)
    while heap:
        _, left, right, pair = heapq.heappop(heap)
        if not symbols[left] or not symbols[right] or symbols[left] + symbols[right] != pair:
            continue  # one of both has been merged since
        symbols[left], symbols[right] = pair, ""
        after[left] = after[right]
        if after[right] <= last:
            before[after[right]] = left
        for a, b in ((before[left], left), (left, after[left])):
            if a >= 0 and b <= last:
                merged = symbols[a] + symbols[b]
                if merged in ranks:
                    heapq.heappush(heap, (ranks[merged], a, b, merged))
    return sum(1 if s in ranks else len(s.encode()) for s in symbols if s)


class _Units(dict):
    """Counts of short units seen lately: a bounded number, and as many from before."""

    def __init__(self, ranks: dict[str, float]):
        super().__init__()
        self.ranks = ranks
        self._older: dict[str, int] = {}

    def __missing__(self, unit: str) -> int:
        count = self._older.get(unit)
        if count is None:
            count = count_after_merges(unit.replace(" ", SPACE), self.ranks)
        if len(unit) <= _CACHED_LENGTH:
            if len(self) >= _CACHED_UNITS:
                self._older = dict(self)
                self.clear()
            self[unit] = count
        return count


def _openers(pieces: list[str], letters: set[str]) -> set[str]:
    """Signs that no piece holds right after a letter or another sign that is no opener."""
    signs = {c for c in letters if not c.isalnum()}
    while True:
        late = {b for p in pieces for a, b in zip(p, p[1:], strict=False) if a not in signs}
        if not signs & late:
            return signs
        signs -= late


@lru_cache(maxsize=2)
def _counter(model_path: str) -> PairCounter:
    """One counter for all tasks of a Python worker."""
    return PairCounter(model_path)


class PairCounter:
    """Counts the tokens of texts for one vocabulary file."""

    def __init__(self, model_path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_path)
        ids = range(model.get_piece_size())
        plain = [
            i for i in ids if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))
        ]
        ranks = {model.id_to_piece(i): -model.get_score(i) for i in plain}
        self._units = _Units(ranks)
        longer = [p for p in ranks if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in longer):
            raise ValueError("pieces that hold a space after a letter are not supported")
        bare = [p.lstrip(SPACE) for p in longer]
        joining = {c for p in bare for c in p}
        openers = _openers(bare, joining)
        signs, rest = (
            f"[{re.escape(''.join(sorted(c)))}]" if c else "(?!)" for c in (openers, joining - openers)
        )
        alone = f"[^ {re.escape(''.join(sorted(joining)))}]"
        # no piece reaches from a letter to a space or an opener, nor over a character that no longer
        # piece has
        self._cut = re.compile(f" +{signs}*{rest}*|{signs}+{rest}*|{rest}+|{alone}")

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        text = " " + text.replace(SPACE, " ")
        if len(text) < _LIST_BELOW:
            return sum(map(self._units.__getitem__, self._cut.findall(text)))
        return sum(self._units[m.group()] for m in self._cut.finditer(text))


def token_count(text: Column, model_path: str) -> Column:
    """The number of tokens of a text column."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(model_path)
        for texts in batches:
            yield pd.Series([counter.count(t) for t in _present(texts)], dtype="int64")

    return count(text)


def _present(texts: pd.Series) -> Iterable[str | None]:
    return (t if isinstance(t, str) else None for t in texts)


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether the count is over ``limit``, for each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return (
        docs.select("doc_id", text.alias("text"))
        .select(
            "doc_id",
            F.octet_length("text").cast("long").alias("n_bytes"),
            token_count(F.col("text"), model_path).alias("n_tokens"),
        )
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
