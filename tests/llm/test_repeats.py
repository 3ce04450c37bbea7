"""Repeated bytes against every window of the corpus, maximal repeats against all pairs of places."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sentilode.llm import repeats
from sentilode.llm.chunks import Corpus
from sentilode.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(rows, length=100):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            window = data[s:s + length]
            if window in seen:
                gone[s:s + length] = b"\1" * length
            seen.add(window)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(x for x, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows_with_copies(seed, n=60):
    draw = random.Random(seed)
    text = lambda k: "".join(draw.choice("abcdé \n") for _ in range(k))
    sources = [text(draw.randint(150, 900)) for _ in range(4)]
    rows = []
    for k in range(n):
        parts = [text(draw.randint(0, 120))]
        for _ in range(draw.randint(0, 3)):
            source = draw.choice(sources)
            a = draw.randrange(len(source))
            parts += [source[a:a + draw.randint(60, 500)], text(draw.choice([0, 1, 40]))]
        rows.append((k, "".join(parts)))
    return rows


def test_like_every_window(spark, make_docs):
    rows = rows_with_copies(1) + [
        (None, "n" * 300), (None, None), (500, ""), (501, "a" * 2_000), (502, "ab" * 900), (503, "x" * 99), (503, "x" * 100),
        (504, "x" * 101), (505, "é" * 200), (506, "é" * 49 + "e"), (5, "again " * 60), (5, "again " * 60), (507, "long word " * 20_000),
    ]
    found = repeats.remove_repeats(make_docs(rows)).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows)


def test_no_bucket_holds_all_contexts_of_a_line(make_docs, monkeypatch):
    """One line between bytes that differ in every text: more contexts of a gram than HOT are judged by windows."""
    monkeypatch.setattr(repeats, "HOT", 20, raising=False)
    find = repeats._find_later

    def bounded(*args):
        run = find(*args)

        def held(key, table):
            n = sum(len(e) for e in table.column("entries").to_pylist()) // repeats.ENTRY.itemsize
            if n > 150:
                raise ValueError(f"a bucket holds {n} contexts")
            return run(key, table)

        return held

    monkeypatch.setattr(repeats, "_find_later", bounded)
    draw = random.Random(9)
    text = lambda k: "".join(draw.choice("abcdefgh") for _ in range(k))
    line, passage = text(80), text(300)
    rows = [(k, text(60) + line + text(60)) for k in range(400)]
    rows += [(None if k == 40 else 400 + k % 50, text(50) + passage + text(50)) for k in range(60)]
    rows += [(700, rows[3][1] + rows[410][1]), (701, passage * 3), (701, passage * 3), (2, line + "é" + line)]
    found = repeats.remove_repeats(make_docs(rows)).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows)


@pytest.mark.parametrize("hot", [1, 3])
def test_hot_grams_like_every_window(make_docs, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = rows_with_copies(3, 40) + [(None, "n" * 300), (501, "a" * 2_000), (502, "ab" * 900), (503, "x" * 100), (503, "x" * 101)]
    found = repeats.remove_repeats(make_docs(rows)).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows)


def test_query_on_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = QUERIES["op2_repeated_bytes"](spark, SF).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows)


def test_empty_table(make_docs):
    assert repeats.remove_repeats(make_docs([(1, "x")]).limit(0)).collect() == []


def test_maximal_repeats(make_docs):
    """Each group is a string with all its occurrences that cannot be longer, and all repeated windows are in groups."""
    rows = rows_with_copies(2, 25)
    data = {k: t.encode() for k, t in rows}
    groups = {}
    for r in repeats.maximal_repeats(make_docs(rows), 60).collect():
        groups.setdefault((r.repeat_id, r.n_bytes), set()).add((r.doc_id, r.start))
    assert groups
    covered = {k: bytearray(len(d)) for k, d in data.items()}
    for (_, size), places in groups.items():
        texts = {data[d][s:s + size] for d, s in places}
        assert len(texts) == 1 and size >= 60 and len(places) > 1
        text = texts.pop()
        assert places == {(d, s) for d in data for s in range(len(data[d])) if data[d].startswith(text, s)}
        for d, s in places:
            covered[d][s:s + size] = b"\1" * size
    counts = {}
    for d in data:
        for s in range(len(data[d]) - 59):
            counts.setdefault(data[d][s:s + 60], []).append((d, s))
    want = {k: bytearray(len(d)) for k, d in data.items()}
    for places in counts.values():
        if len(places) > 1:
            for d, s in places:
                want[d][s:s + 60] = b"\1" * 60
    assert covered == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=6), min_size=2, max_size=30))
def test_intervals(strings):
    strings = sorted(strings)
    common = [repeats.shared(a, b) for a, b in zip(strings, strings[1:])]
    found = set(repeats.intervals(common, 1))
    want = set()
    for a in range(len(strings)):
        for b in range(a + 1, len(strings)):
            low = min(common[a:b])
            outside = max(common[max(a - 1, 0):a] + common[b:b + 1], default=-1)
            if low >= 1 and outside < low:
                want.add((low, a, b))
    assert found == want


@pytest.mark.parametrize("seed", range(5))
def test_anchors_depend_on_the_window_alone(seed):
    draw = np.random.default_rng(seed)
    texts = [bytes(draw.integers(97, 99 + seed, size)).decode() for size in (0, 99, 100, 101, 700, 3_000)]
    corpus = Corpus(pa.array(texts))
    start, last, owner, _ = repeats.anchors(corpus, 100)
    grams = repeats.gram_hashes(corpus.data)
    windows = {}
    for s, e, a in zip(start.tolist(), last.tolist(), owner.tolist()):
        windows |= {w: a for w in range(s, e + 1)}
    want = {}
    for row in range(len(texts)):
        for w in range(corpus.bounds[row], corpus.bounds[row + 1] - 99):
            want[int(w)] = int(w + grams[w:w + 69].argmin())
    assert windows == want
