"""Token ids of whole texts, written as canonical length-limited Huffman blocks and read back.

``write_tokens`` makes three Parquet tables below one path, so that it works on every store
that Spark writes to:

* ``ids``: per document its ids, little-endian, 2 or 4 bytes each, the end id last;
* ``code``: the code length of every id that occurs, fitted to the counts over all documents;
* ``blocks``: whole documents in ascending doc_id order.  A block holds the doc_ids, the
  lengths, the bits (big-endian 32-bit words, first code in the highest bits) and the bit
  offset of every ``CHECKPOINT``-th id, so it is decoded on its own and all its checkpoints at once.

Documents are dealt out by ranges of (doc_id, crc32, a seeded number), so copies of one row
may go to several tasks.  Null texts count as empty and hold just the end id; a null doc_id comes
first; rows of one doc_id are ordered by the crc32 of their ids, then by the ids.  An empty table
gives an empty file set.  Very long texts are encoded whole, and a block holds at least one document.
Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CHECKPOINT = 128
BLOCK_IDS = 1 << 17
_CACHED_WORDS = 300_000
_NO_SPACE = "\x1c\x1d\x1e\x1f"
_CACHED_LENGTH = 48
_TEXTS_AT_ONCE = 500
#: Letters that stand for bytes: printable Latin-1 for itself, the others from U+0100 on in order.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_LETTERS = {
    byte: chr(0x100 + n) for n, byte in enumerate(b for b in range(0x100) if b not in _PRINTABLE)
}
_BLOCK = (
    "part int, block int, start long, n_ids long, doc_ids array<long>, "
    "lengths array<int>, checkpoints binary, bits binary"
)


# ---- ids ----


class _Words(dict):
    """Ids of short words seen lately, as bytes: a bounded number, and as many from before.

    A new word that is letters of Latin-1 and signs after them is lower-cased here and goes straight
    to the library's merging; every other word goes through all its steps.
    """

    def __init__(self, tokenizer_path: str):
        super().__init__()
        self.tokenizer = _load(tokenizer_path)
        self.dtype = _dtype(self.tokenizer)
        self._older: dict[str, bytes] = {}
        self._signs: dict[str, bytes] = {}
        self._model = self.tokenizer.model
        self._kind = "H" if self.dtype == "<u2" else "I"
        self._straight = self._merges_as_whole()

    def ids_of(self, texts: list[list[str]]) -> list[bytes]:
        """The ids of texts that are cut into words."""
        self._learn(set().union(*texts).difference(self))
        out = [b"".join(map(self.__getitem__, words)) for words in texts]
        if len(self) >= _CACHED_WORDS:  # start anew, and keep these as older
            self._older = {w: ids for w, ids in self.items() if len(w) <= _CACHED_LENGTH}
            self.clear()
        return out

    def _learn(self, words: set[str]) -> None:
        """Encode words that are not held; those of one call are all held until it is done."""
        others, older, straight = [], self._older, self._straight
        for word in words:
            ids = older.get(word)
            if ids is None:
                letters = word.rstrip(".,;:!?")
                low = letters.lower()
                if not (straight and low.isalpha() and (low.isascii() or max(low) < "\u0100")):
                    others.append(word)
                    continue
                ids = self.get(low) or older.get(low)
                if ids is None:
                    ids = self[low] = self._merged(low)
                if len(letters) < len(word):
                    ids += self._sign_ids(word[len(letters) :])
            self[word] = ids
        self.update(zip(others, self._encoded(others), strict=True))

    def _encoded(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [array(self._kind, e.ids).tobytes() for e in found]

    def _merged(self, low: str) -> bytes:
        mapped = low if low.isascii() else low.encode().decode("latin-1").translate(_BYTE_LETTERS)
        ids = [token.id for token in self._model.tokenize(mapped)]
        return array(self._kind, ids).tobytes()

    def _sign_ids(self, signs: str) -> bytes:
        if signs not in self._signs:
            if len(self._signs) >= 1_000:
                self._signs.clear()
            self._signs[signs] = self._encoded([signs])[0]
        return self._signs[signs]

    def _merges_as_whole(self) -> bool:
        """Whether the vocabulary lower-cases letters and takes signs after them apart."""
        letters = [chr(c) for c in range(0x100) if chr(c).isalpha()]
        words = [*letters, *(a + b for a in "aZé" for b in letters), "Über", "STRASSE"]
        whole = self._encoded([*words, *(w + ",." for w in words)])
        apart = [self._merged(w.lower()) if max(w.lower()) < "\u0100" else b"" for w in words]
        apart += [ids + self._sign_ids(",.") for ids in apart]
        return whole == apart


def _cut(text: str) -> list[str]:
    """A text at its white space, over which no form of a letter reaches."""
    if any(sign in text for sign in _NO_SPACE):  # white space to Python, but not to the vocabulary
        return text.split(" ")
    return text.split()


def _load(tokenizer_path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks fill the cores
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def _dtype(tokenizer) -> str:
    return "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


@lru_cache(maxsize=2)
def _words(tokenizer_path: str) -> _Words:
    """One store for all tasks of a Python worker."""
    return _Words(tokenizer_path)


def _drops_white_space(tokenizer_path: str) -> bool:
    """Whether the vocabulary's words end at white space and white space has no ids."""
    tokenizer = _load(tokenizer_path)
    ids = [tokenizer.encode(t, add_special_tokens=False).ids for t in ("a b", "a", "b", " \n\t")]
    return ids[0] == ids[1] + ids[2] and not ids[3]


def token_ids(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """doc_id and ``ids`` (little-endian) of every row, the end id last, with their crc32.

    Each task adds one row of ``counted`` ids and how often it wrote each, at most the vocabulary.
    """
    by_word = _drops_white_space(tokenizer_path)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _words(tokenizer_path)
        end = np.array([end_id], dtype=words.dtype).tobytes()
        total = np.zeros(words.tokenizer.get_vocab_size(), dtype=np.int64)
        for batch in batches:
            found: list[bytes] = []
            for at in range(0, len(batch), _TEXTS_AT_ONCE):
                some = batch["text"].iloc[at : at + _TEXTS_AT_ONCE].tolist()
                texts = list(dict.fromkeys(some))  # equal ones are encoded once
                ids = words.ids_of([_cut(t) if by_word else [t] for t in texts])
                ids_of = {t: i + end for t, i in zip(texts, ids, strict=True)}
                found += [ids_of[t] for t in some]
            for at in range(0, len(found), 500):
                some = np.frombuffer(b"".join(found[at : at + 500]), dtype=words.dtype)
                counts = np.bincount(some)
                total[: len(counts)] += counts
            crc = [zlib.crc32(f) for f in found]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "ids": found, "crc": crc}).assign(
                counted=None, n=None
            )
        counted = np.flatnonzero(total)
        if len(counted):
            row = {"doc_id": None, "ids": None, "crc": None, "counted": [counted], "n": [total[counted]]}
            yield pd.DataFrame(row)

    texts = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    # a nullable long would turn into double in pandas
    schema = "doc_id string, ids binary, crc long, counted array<long>, n array<long>"
    return texts.mapInPandas(encode, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


def id_counts(ids: DataFrame) -> DataFrame:
    """id and its number of places over all documents."""
    counts = ids.where("counted IS NOT NULL").select(F.arrays_zip("counted", "n").alias("pairs"))
    return (
        counts.select(F.inline("pairs").alias("id", "n")).groupBy("id").agg(F.sum("n").alias("n"))
    )


# ---- code ----


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits, by merging packages of two."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, dtype=np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need codes of over {limit} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    packages = np.zeros(0, dtype=np.int64)
    from_leaf = []
    for _ in range(limit):
        merged = np.concatenate([leaves, packages])
        place = np.argsort(merged, kind="stable")
        from_leaf.append(place < n)
        merged = merged[place]
        even = len(merged) // 2 * 2
        packages = merged[0:even:2] + merged[1:even:2]
    lengths = np.zeros(n, dtype=np.int64)
    taken = 2 * n - 2
    for leaf in reversed(from_leaf):
        used = int(leaf[:taken].sum())
        lengths[order[:used]] += 1
        taken = 2 * (taken - used)
    return lengths


class Code:
    """Canonical codes of ids: ordered by length, then id."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        self.ids, self.lengths = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        self.bits = int(self.lengths[-1]) if len(order) else 1
        steps = np.int64(1) << (self.bits - self.lengths)
        starts = np.cumsum(steps) - steps
        top = int(self.ids.max()) + 1 if len(order) else 1
        self.code_of = np.zeros(top, dtype=np.uint64)
        self.length_of = np.zeros(top, dtype=np.int64)
        self.code_of[self.ids] = (starts >> (self.bits - self.lengths)).astype(np.uint64)
        self.length_of[self.ids] = self.lengths
        self._steps = steps

    def table(self) -> np.ndarray:
        """For every window of ``bits`` bits, 256 times the id and the code length."""
        entries = np.ones(1 << self.bits, dtype=np.uint64)
        both = (self.ids << 8 | self.lengths).astype(np.uint64)
        entries[: int(self._steps.sum())] = np.repeat(both, self._steps)
        return entries

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """Checkpoints and bits of one block."""
        lengths = self.length_of[ids]
        ends = np.cumsum(lengths)
        starts = ends - lengths
        word = starts >> 5
        # each code lies within two 32-bit words; codes never overlap, so those of a word are or'ed
        framed = self.code_of[ids] << (64 - (starts & 31) - lengths).view(np.uint64)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        both = np.bitwise_or.reduceat(framed, first)
        words = np.zeros(int(ends[-1] >> 5) + 2, dtype=np.uint64)
        words[word[first]] = both >> np.uint64(32)
        words[word[first] + 1] |= both & np.uint64(0xFFFFFFFF)
        return starts[::CHECKPOINT].astype("<u4").tobytes(), words.astype(">u4").tobytes()


def decode(checkpoints: bytes, bits: bytes, n_ids: int, code_table: np.ndarray, width: int) -> np.ndarray:
    """The ids of one block: all checkpoints advance together, one table look-up per id."""
    # the last checkpoint may run past its end: its table entries advance by ``width`` bits at most
    beyond = np.zeros(CHECKPOINT * width // 32 + 3, dtype=np.uint64)
    words = np.concatenate([np.frombuffer(bits, dtype=">u4").astype(np.uint64), beyond])
    framed = (words[:-1] << np.uint64(32)) | words[1:]
    at = np.frombuffer(checkpoints, dtype="<u4").astype(np.uint64)
    out = np.empty((CHECKPOINT, len(at)), dtype="<u4")
    mask, room = np.uint64((1 << width) - 1), np.uint64(64 - width)
    word_bits, five, size = np.uint64(31), np.uint64(5), np.uint64(0xFF)
    for step in range(CHECKPOINT):
        window = framed[(at >> five).view(np.int64)] >> (room - (at & word_bits))
        entry = code_table[(window & mask).view(np.int64)]
        out[step] = entry >> np.uint64(8)
        at += entry & size
    return out.T.reshape(-1)[:n_ids]


# ---- files ----


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int) -> None:
    """Write the ids of every row of ``docs`` below ``path``."""
    spark = docs.sparkSession
    token_ids(docs, tokenizer_path, end_id).write.parquet(f"{path}/ids")
    ids = spark.read.parquet(f"{path}/ids")
    # one row for each id of the vocabulary at most
    counted = id_counts(ids).toPandas().sort_values("id")
    limit = max(16, int(len(counted)).bit_length() + 2)
    lengths = code_lengths(counted["n"].to_numpy(np.int64), limit)
    pairs = [(int(i), int(n)) for i, n in zip(counted["id"], lengths, strict=True)]
    spark.createDataFrame(pairs, "id long, length int").coalesce(1).write.parquet(f"{path}/code")
    code = Code(counted["id"].to_numpy(np.int64), lengths)
    dtype = _dtype(_load(tokenizer_path))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, block, start = TaskContext.get().partitionId(), 0, 0
        doc_ids, values, held = [], [], 0

        def close() -> pd.DataFrame:
            ids = np.concatenate(values)
            checkpoints, bits = code.encode(ids)
            row = (part, block, start, len(ids), doc_ids, [len(v) for v in values], checkpoints, bits)
            return pd.DataFrame([row], columns=[c.split()[0] for c in _BLOCK.split(", ")])

        for batch in batches:
            for doc_id, value in zip(batch["doc_id"], batch["ids"], strict=True):
                doc_ids.append(None if pd.isna(doc_id) else int(doc_id))
                values.append(np.frombuffer(value, dtype=dtype))
                held += len(values[-1])
                if held >= BLOCK_IDS:
                    yield close()
                    block, start, doc_ids, values, held = block + 1, start + held, [], [], 0
        if values:
            yield close()

    # a nullable long turns into double in pandas; text keeps it exact
    rows = ids.where("ids IS NOT NULL").select("doc_id", "crc", "ids")
    dealt = rows.repartitionByRange("doc_id", "crc", F.rand(7)).sortWithinPartitions(
        "doc_id", "crc", "ids"
    )
    packed = dealt.select(F.col("doc_id").cast("string").alias("doc_id"), "ids").mapInPandas(pack, _BLOCK)
    packed.write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, ``start`` (ids of all documents before it) and ``ids`` (little-endian 32-bit)."""
    return _read(spark, path, digest=False)


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, ``start``, ``n_tokens`` and the crc32 of the ids, of every document in the files."""
    return _read(spark, path, digest=True)


def _read(spark: SparkSession, path: str, digest: bool) -> DataFrame:
    # one row for each id of the vocabulary at most
    lengths = spark.read.parquet(f"{path}/code").toPandas()
    code = Code(lengths["id"].to_numpy(np.int64), lengths["length"].to_numpy(np.int64))
    value = "n_tokens long, ids_crc32 long" if digest else "ids binary"

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = code.table()
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids = decode(row.checkpoints, row.bits, row.n_ids, table, code.bits)
                ends = np.cumsum(np.asarray(row.lengths, dtype=np.int64))
                starts = ends - row.lengths
                values = [ids[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
                out = {"part": row.part, "doc_id": pd.array(list(row.doc_ids), dtype="Int64")}
                out["start"] = row.start + starts
                if digest:
                    out["n_tokens"] = ends - starts
                    out["ids_crc32"] = np.array([zlib.crc32(v) for v in values], dtype=np.int64)
                else:
                    out["ids"] = values
                yield pd.DataFrame(out)

    blocks = spark.read.parquet(f"{path}/blocks")
    documents = blocks.withColumn("doc_ids", F.col("doc_ids").cast("array<string>")).mapInPandas(
        unpack, f"part int, doc_id long, start long, {value}"
    )
    # one row for each written partition
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(
        F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    offsets = totals.select("part", before.alias("before"))
    names = [c.split()[0] for c in value.split(", ")]
    return documents.join(offsets, "part").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), *names
    )
