"""The trie of conversations against brute force and SQL."""

import hashlib
import random
import zlib

import pytest

from terrace.llm.prefix_trie import (
    ROOT,
    Settings,
    ZFastTrie,
    fattest,
    prefix_nodes,
    rebuilt,
    turn_table,
)
from terrace.llm.queries import ORACLE, QUERIES
from tests.oracle import connect, differences

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]


def brute(conversations):
    """Rows of the nodes of {conv_id: [(role, text), ...]}."""
    members = {}
    for conv, turns in conversations.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(conv)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        leaves = [p for p in below if not any(len(q) > len(p) and q[: len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = sorted(c for c in convs if len(conversations[c]) == len(path))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        out.append((
            min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs),
            sum(len(p) == len(path) + 1 for p in below), len(leaves), saved, digest,
        ))
    return sorted(out, key=str)


def again(conversations):
    """The rebuilt conversations."""
    out = {}
    for conv, own in conversations.items():
        h = zlib.crc32(str(conv).encode()) % 9
        base = conv - int(abs(conv) % 5) * (1 if conv >= 0 else -1)
        out[conv] = conversations.get(base, [])[:h] + own[h:]
    return out


def rows_of(conversations):
    return [(c, n, role, text) for c, turns in conversations.items() for n, (role, text) in enumerate(turns)]


def found(frame):
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()), key=str)


def made(seed, count=60, longest=12):
    pick = random.Random(seed)
    texts = ["", "a", "bé", "c" * 20]
    return {
        c * pick.choice([1, 1, 1, -1]): [
            (pick.choice("xy"), pick.choice(texts if n > 2 else texts[:1])) for n in range(pick.randint(1, longest))
        ]
        for c in range(count)
    }


@pytest.mark.parametrize(
    "settings", [Settings(), Settings(turns=7, ends_per_piece=1, heavy=3), Settings(turns=30, ends_per_piece=2)]
)
def test_rebuilt_conversations(spark, settings):
    conversations = made(1)
    rows = spark.createDataFrame(rows_of(conversations), SCHEMA).repartition(5)
    nodes = prefix_nodes(rebuilt(turn_table(rows)), settings)
    assert found(nodes) == brute(again(conversations))


def test_plain_conversations_copies_and_long_chains(spark):
    conversations = made(2, 30) | {c: [("x", "a")] * 40 for c in range(100, 140)} | {200: [("x", "a")] * 97}
    rows = spark.createDataFrame(rows_of(conversations), SCHEMA)
    for settings in (Settings(), Settings(turns=25, ends_per_piece=3, heavy=2)):
        assert found(prefix_nodes(turn_table(rows), settings)) == brute(conversations)


def test_trie_of_one_task():
    pick = random.Random(5)
    for _ in range(200):
        trie, members = ZFastTrie(), {}
        for conv in range(pick.randint(1, 25)):
            path = [bytes([pick.randint(0, 1)]) for _ in range(pick.choice([0, 1, 3, 9, 33]))]
            keys = [ROOT, *(b"".join(path[: n + 1]) for n in range(len(path)))]
            edge, depth = trie.exit(keys)
            assert depth == max(d for d in range(len(keys)) if d == 0 or keys[d] in members)
            assert edge.keys[depth] == keys[depth]
            trie.add(keys, [0] * len(keys), conv)
            for key in keys:
                members.setdefault(key, []).append(conv)
        rows = {r[0]: (r[4], r[5]) for r in trie.expanded()}
        assert rows == {k: (len(v), min(v)) for k, v in members.items()}


def test_fattest():
    assert [fattest(a, b) for a, b in ((0, 1), (0, 7), (4, 7), (-1, 0), (5, 9), (8, 9))] == [1, 4, 6, 0, 8, 9]


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (1, None, "u", "first"), (1, 0, None, None), (1, 1, "u", "x"), (1, 1, "u", "x"), (None, 0, "u", "x"),
        (2, None, "u", "first"), (2, 5, "", ""), (3, 0, "", "u|first"), (3, 1, "u", None),
    ]
    expected = {
        1: [("u", "first"), ("", ""), ("u", "x"), ("u", "x")], 2: [("u", "first"), ("", "")],
        3: [("", "u|first"), ("u", "")],
    }
    table = spark.createDataFrame(rows, SCHEMA)
    assert found(prefix_nodes(turn_table(table))) == brute(expected)
    assert found(prefix_nodes(rebuilt(turn_table(table)))) == brute(again(expected))


def test_turnless_conversations(spark):
    conversations = {c: [("u", "x")] for c in (1, 2, 3, 4, 6, 7, 8, 9)}
    nodes = again(conversations)
    assert any(not turns for turns in nodes.values())
    rows = spark.createDataFrame(rows_of(conversations), SCHEMA)
    assert found(prefix_nodes(rebuilt(turn_table(rows)))) == brute(nodes)


def test_empty_table_long_text_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_nodes(rebuilt(turn_table(empty))).count() == 0
    rows = spark.createDataFrame([(1, 0, "u", "é" * 1_000_000), (2, 0, "u", "é" * 1_000_000)], SCHEMA)
    for clash in ("key", "place", "symbol", "bytes", "depth", "parent", "n", "least", "base", "h"):
        rows = rows.selectExpr("*", f"7 AS {clash}")
    text = ("u", "é" * 1_000_000)
    assert found(prefix_nodes(turn_table(rows))) == brute({1: [text], 2: [text]})


def test_query_agrees_with_sql(spark, sf_dir):
    name = "op12_conversation_trie"
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE[name]) is None
