"""Edit matching against dynamic programming over whole texts."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from sentilode.llm import decontaminate as d
from sentilode.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def fewest_edits(pattern, text):
    """(edits, first end) of the best substring, row by row."""
    row = list(range(len(pattern) + 1))
    best, end = row[-1], 0
    for j, c in enumerate(text, 1):
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (p != c)))
        row = new
        if row[-1] < best:
            best, end = row[-1], j
    return best, end


@settings(max_examples=300, deadline=None)
@given(st.text("abc", min_size=1, max_size=12), st.text("abcd", max_size=40))
def test_myers(pattern, text):
    assert d.myers(d.masks(pattern), len(pattern), text) == fewest_edits(pattern, text)


def edited(draw, text, edits):
    text = list(text)
    for _ in range(edits):
        at, kind = draw.randrange(len(text)), draw.randrange(3)
        text[at:at + (kind < 2)] = [draw.choice("xyz ")] * (kind > 0)
    return "".join(text)


def test_short_items_occur_exactly_on_word_bounds(spark, make_docs):
    bench = spark.createDataFrame([(1, "Blue whale?"), (2, "42"), (3, " "), (4, "c++")], "item_id bigint, text string")
    rows = [(1, "the blue  WHALE? yes"), (2, "the blue whales"), (3, "1420 or 42nd"), (4, "it is 42."), (5, "bluewhale? c++"), (6, "")]
    found = d.find_items(make_docs(rows), bench).collect()
    assert sorted(tuple(r) for r in found) == [(1, 1, 0, 4, 15), (4, 2, 0, 6, 8), (5, 4, 0, 11, 14)]
    assert sorted(r.doc_id for r in d.drop_contaminated(make_docs(rows), bench).collect()) == [2, 3, 6]


def test_like_dynamic_programming(spark, make_docs):
    draw = random.Random(8)
    prose = lambda n: " ".join("".join(draw.choice("aeioustrn") for _ in range(draw.randint(1, 8))) for _ in range(n))
    items = [(k, prose(draw.randint(5, 25)).capitalize()) for k in range(12)] + [(90, "Too short"), (91, None), (92, "")]
    rows = []
    for k in range(60):
        text = prose(draw.randint(0, 60))
        if k % 3:
            item = draw.choice(items[:12])[1]
            text += " " + edited(draw, item, draw.randint(0, int(len(item) * 0.14))) + "\n" + prose(5)
        rows.append((k, text))
    rows += [(100, None), (101, ""), (None, items[0][1]), (7, items[1][1]), (7, items[1][1]), (102, "x " * 50_000 + items[2][1].upper())]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = d.find_items(make_docs(rows), bench).collect()
    want = []
    for doc_id, text in rows:
        for item_id, item in items:
            text_n, item_n = d.normal(text)[-3_000:], d.normal(item)
            if len(item_n) >= d.MIN_CHARS:
                edits, _ = fewest_edits(item_n, text_n)
                if edits <= d.budget(len(item_n), d.ERROR_RATE):
                    want.append((doc_id, item_id, edits))
    assert sorted(((r.doc_id, r.item_id, r.distance) for r in found), key=str) == sorted(want, key=str)
    texts, patterns = dict(rows[:100]), dict(items)
    for r in found:
        if r.doc_id is not None and r.doc_id < 60 and r.doc_id != 7:
            place = d.normal(texts[r.doc_id])[r.start:r.end]
            assert fewest_edits(d.normal(patterns[r.item_id]), place)[0] == r.distance
    hit = {r.doc_id for r in found}
    kept = d.drop_contaminated(make_docs(rows), bench)
    assert kept.columns == make_docs(rows).columns
    assert sorted((str(r.doc_id) for r in kept.collect())) == sorted(str(i) for i, _ in rows if i not in hit)


def test_blocks_give_the_same(spark, make_docs, monkeypatch):
    items = [(k, f"item number {k} has some words of its own {k * 77}") for k in range(9)]
    docs = make_docs([(k, f"see: {items[k][1]}.") for k in range(9)])
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    whole = sorted(map(tuple, d.find_items(docs, bench).collect()))
    monkeypatch.setattr(d.blocks, "__defaults__", (100,))
    assert sorted(map(tuple, d.find_items(docs, bench).collect())) == whole and len(whole) >= 9


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    docs = make_docs([(1, "some text that is long enough")])
    assert d.find_items(docs, none).collect() == []
    assert d.drop_contaminated(docs, none).count() == 1
    some = spark.createDataFrame([(1, "some text that is long enough")], "item_id bigint, text string")
    assert d.find_items(docs.limit(0), some).collect() == []


def test_query_finds_every_item_in_a_text(spark):
    texts = {r.doc_id: d.normal(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: d.normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    exact = {(i, k) for i, t in texts.items() for k, p in items.items() if p in t}
    found = {(r.doc_id, r.item_id): r.distance for r in QUERIES["op9_benchmark_leaks"](spark, SF).collect()}
    assert exact == {pair for pair, edits in found.items() if edits == 0}
