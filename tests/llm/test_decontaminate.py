import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from terrace.llm.decontaminate import Item, Matcher, find_items, plain, without_items


def brute(item, text):
    """Least distance of the item to any part of the text."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for letter in text:
        new = [0]
        for i, own in enumerate(item):
            new.append(min(row[i] + (own != letter), row[i + 1] + 1, new[i] + 1))
        row, best = new, min(best, new[-1])
    return best


def levenshtein(a, b):
    row = list(range(len(a) + 1))
    for letter in b:
        new = [row[0] + 1]
        for i, own in enumerate(a):
            new.append(min(row[i] + (own != letter), row[i + 1] + 1, new[i] + 1))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("ab c", min_size=1, max_size=30), st.text("ab c", max_size=60))
def test_best_is_least_distance(item, text):
    one = Item(item, 1.0)
    found = one.best(text)
    least = brute(item, text)
    if not text:
        return
    assert found[0] == least == levenshtein(item, text[found[1] : found[2]])


def edited(text, errors, rng):
    text = list(text)
    for _ in range(errors):
        at = rng.randrange(len(text))
        text[at : at + 1] = rng.choice([[], [text[at], "q"], ["z"]])
    return "".join(text)


@pytest.mark.parametrize("seed", range(5))
def test_matcher_equals_brute_force(seed):
    rng = random.Random(seed)
    letters = "aeinrst  "
    items = [plain("".join(rng.choice(letters) for _ in range(rng.randrange(20, 200)))) for _ in range(6)]
    matcher = Matcher([(str(n), t) for n, t in enumerate(items)], 0.1)
    for _ in range(40):
        parts = ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(3)]
        for _ in range(2):
            item = rng.choice(items)
            parts.insert(rng.randrange(4), edited(item, rng.randrange(len(item) // 6), rng))
        text = plain("".join(parts))
        found = {int(i): d for i, d, _, _ in matcher.find(text)}
        wanted = {n: brute(t, text) for n, t in enumerate(items)}
        assert found == {n: d for n, d in wanted.items() if d <= int(len(items[n]) * 0.1)}


def test_given_documents_hold_their_items(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    texts = [(r.doc_id, plain(r.text)) for r in docs.collect()]
    items = [(r.item_id, plain(r.text)) for r in benchmark.collect()]
    found = {(r.doc_id, r.item_id): r for r in find_items(docs, benchmark).collect()}
    exact = {(d, i) for d, text in texts for i, item in items if item and item in text}
    assert exact and exact == {k for k, r in found.items() if r.distance == 0}
    words = dict(texts)
    for (d, i), r in found.items():
        if r.distance == 0:
            assert words[d].split()[r.first_word : r.last_word + 1] == dict(items)[i].split()
    left = {r.doc_id for r in without_items(docs, benchmark).collect()}
    assert left == {d for d, _ in texts} - {d for d, _ in found}
    assert without_items(docs, benchmark, group_letters=500).count() == len(left)
    grouped = find_items(docs, benchmark, group_letters=500)
    assert sorted(map(tuple, grouped.collect())) == sorted(map(tuple, found.values()))


@pytest.mark.parametrize(("edits", "share"), [(1, 0.95), (2, 0.85), (3, 0.6)])
def test_items_with_edited_words_are_found(spark, sf_dir, edits, share):
    rng = random.Random(edits)
    folder = sf_dir.replace("sf0.001", "sf0.01")
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    items = {r.item_id: plain(r.text) for r in benchmark.collect()}
    fill = [plain(r.text)[:300] for r in spark.read.parquet(f"{folder}/documents.parquet").limit(9).collect()]
    words = [w for text in items.values() for w in text.split()]
    rows = []
    for n, text in items.items():
        own = text.split()
        for at in rng.sample(range(len(own)), edits):
            own[at] = rng.choice(words)
        rows.append((n, f"{rng.choice(fill)} {' '.join(own)} {rng.choice(fill)}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.item_id): r.distance for r in find_items(docs, benchmark).collect()}
    held = [(d, n, plain(t)) for d, t in rows for n in items if n == d or (d, n) in found]
    least = {(d, n): Item(items[n], 1.0).best(t)[0] for d, n, t in held}
    assert found == {k: v for k, v in least.items() if v <= int(len(items[k[1]]) * 0.1)}
    assert sum((n, n) in found for n in items) >= share * len(items)
    left = {r.doc_id for r in without_items(docs, benchmark).collect()}
    assert left == set(items) - {d for d, _ in found}


def test_odd_tables(spark):
    docs = spark.createDataFrame(
        [(1, "Some test, item\nHERE", 1), (1, "Some test, item\nHERE", 1), (None, "x some test item here y", 2),
         (2, None, 3), (3, "", 4), (4, "sometest item here", 5), (5, "w " * 50_000 + "some test item here", 6)],
        "doc_id long, text string, item_id int",
    )
    items = spark.createDataFrame([(7, "some TEST item, here!"), (8, ""), (9, None), (None, "other")], "item_id long, text string")
    got = sorted(map(tuple, find_items(docs, items).collect()), key=str)
    assert got == sorted([(1, 7, 0, 0, 3)] * 2 + [(None, 7, 0, 1, 4), (4, 7, 1, 0, 2), (5, 7, 0, 50_000, 50_003)], key=str)
    assert find_items(docs.limit(0), items).count() == 0
    assert find_items(docs, items.limit(0)).count() == 0


def test_groups_never_share_a_stage(spark):
    """Seven groups: one Python node in the plan of each written step, the same rows as in one."""
    items = [(n, f"item {n} " + " ".join(f"w{n}x{k}" for k in range(12))) for n in range(30)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    texts = [(n, f"before {items[n % 40][1] if n % 40 < 30 else 'clean words'} after") for n in range(80)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    letters = sum(len(t) for _, t in items)
    left = without_items(docs, benchmark, group_letters=letters // 6)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("ArrowEvalPython", plan)) == 1
    assert sorted(map(tuple, left.collect())) == sorted(map(tuple, without_items(docs, benchmark).collect()))
    assert left.count() == 20
