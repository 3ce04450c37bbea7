"""Runs against a search of all periods; the suffix order; texts of every kind."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings, strategies as st

from sentilode.llm import periodic as pe


def brute_runs(words):
    """Every (start, length, period): stretches of equal words q apart, for each q, with no smaller period."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            smaller = any(all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text, alter):
    words = [w for w in (text or "").translate({k: " " for k in range(9, 14)}).split(" ") if w]
    n = len(words)
    if alter and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(words)
    best = sorted(runs, key=lambda r: (-r[1], r[0], r[2]))[0] if runs else (None, None, None)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        digest(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def check(make_docs, rows, alter=False):
    got = [tuple(r) for r in pe.periodic_runs(make_docs(rows), alter).collect()]
    order = lambda r: tuple(map(str, r))
    assert sorted(got, key=order) == sorted((brute_row(i, t, alter) for i, t in rows), key=order)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=4))
def test_runs_of_short_alphabets(texts):
    assert pe.find_runs([np.array(t, np.int64) for t in texts]) == [brute_runs(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 12)), max_size=6))
def test_runs_of_runs(parts):
    text = [w for part, times in parts for w in part * times]
    assert pe.find_runs([np.array(text, np.int64)]) == [brute_runs(text)]


def test_suffixes_are_in_order():
    rng = random.Random(1)
    texts = [[rng.randrange(2) for _ in range(80)] for _ in range(3)]
    array = pe.SuffixArray([np.array(t, np.int64) for t in texts])
    suffixes = [array.words[p:].tolist() for p in array.order]
    for k in range(1, len(suffixes)):
        shared = 0
        while suffixes[k][shared] == suffixes[k - 1][shared] != 0:
            shared += 1
        same_text = np.searchsorted(array.starts, array.order[k - 1:k + 1], side="right")
        want = shared if shared >= pe.SEED and same_text[0] == same_text[1] else 0
        assert array.shared[k] == want


def test_long_runs_take_no_quadratic_time():
    n = 60_000
    for text in (np.zeros(n, np.int64), np.arange(n) % 7, np.r_[np.arange(n // 8)].repeat(1).tolist() * 8):
        runs = pe.find_runs([np.array(text, np.int64)])[0]
        assert len(runs) == 1 and runs[0][1] == len(text)
    # One phrase after ever new words: a node with as many left words as places.
    text = [w for k in range(6000) for w in (10 + k, 1, 2, 3, 4, 5, 6)]
    assert pe.find_runs([np.array(text, np.int64)]) == [[]]


def test_texts(make_docs):
    rng = random.Random(3)
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "a b c"), (5, "x " * 5), (6, "x " * 6), (7, "a b " * 4), (8, "a b " * 3 + "a"),
        (9, "q " + "a b c " * 5 + "a a a a a a a z"), (9, "q " + "a b c " * 5 + "a a a a a a a z"), (None, "y " * 9),
        (10, "é  é \x0b" * 8), (11, "line one\n" * 7), (12, "a\x1fb " * 6),
    ]
    rows += [(100 + k, " ".join(rng.choice("abc") for _ in range(rng.randrange(90)))) for k in range(60)]
    check(make_docs, rows)
    check(make_docs, rows, alter=True)


def test_altered_texts(make_docs):
    rng = random.Random(4)
    rows = [(k, " ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(1, 120)))) for k in range(300)]
    assert sum(zlib.crc32(str(k).encode()) % 10 == 0 for k, _ in rows) > 10
    check(make_docs, rows, alter=True)


def test_no_rows(make_docs):
    assert pe.periodic_runs(make_docs([])).count() == 0


def test_whole_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60)
    rows = [(r[0], r[1]) for r in docs.collect() if len(r[1]) < 12_000]
    kept = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(tuple(r) for r in pe.periodic_runs(kept, True).collect())
    assert got == sorted(brute_row(i, t, True) for i, t in rows)
