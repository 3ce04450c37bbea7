"""Components against all pairs of sets, estimates against the truth, mergeable sketches."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from sentilode.llm import graph, near
from sentilode.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute(rows, percent=75):
    sets = [shingles(t) for _, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    posted = defaultdict(list)
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is None:
            continue
        shared = defaultdict(int)
        for s in sets[k]:
            for j in posted[s]:
                shared[j] += 1
            posted[s].append(k)
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[k]) + len(sets[j]) - n):
                a, b = sorted((find(doc_id), find(rows[j][0])))
                parent[b] = a
    return sorted(
        ((i, len(s), None if i is None else find(i), i is None or find(i) == i) for (i, _), s in zip(rows, sets)), key=str
    )


def rows_with_copies(seed):
    draw = random.Random(seed)
    text = lambda n: [f"w{draw.randrange(3_000)}" for _ in range(n)]
    sources = [text(n) for n in (6, 30, 120, 400)]
    rows = [(k, " ".join(text(draw.randint(0, 80)))) for k in range(40)]
    for k in range(160):
        words = list(draw.choice(sources))
        for _ in range(draw.randrange(0, max(2, len(words) // 12))):
            words[draw.randrange(len(words))] = f"z{draw.randrange(99)}"
        rows.append((1000 + k, " ".join(words)))
    return rows + [
        (None, " ".join(sources[2])), (None, None), (5_000, ""), (5_001, None), (5_002, "a b"), (5_003, "A  b"), (5_004, "one two three four five"),
        (5_005, "one two three four"), (5_006, " ".join(sources[2])), (5_006, " ".join(sources[3])), (5_006, " ".join(sources[3])),
        (5_007, "É " + "x " * 30_000), (5_008, "é " + "x " * 20_000),
    ]


@pytest.mark.parametrize("block", [4_096, 25])
def test_like_all_pairs(make_docs, monkeypatch, block):
    """Also where a group is far larger than a block."""
    monkeypatch.setattr(near, "BLOCK_SETS", block)
    monkeypatch.setattr(near, "SPINE", 4)
    rows = rows_with_copies(4)
    found = near.near_duplicates(make_docs(rows)).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows)


def test_no_task_holds_a_chained_group(make_docs, monkeypatch):
    """Unlinked texts that share a passage are one candidate group; each pair is compared, two blocks in a task at most."""
    block, seen = 25, []

    def bounded(factory):
        def make(percent):
            run = factory(percent)
            seen.append(factory.__name__)

            def held(*args):
                if args[-1].num_rows > 4 * block:  # blocks are dealt by hash, so they vary in size
                    raise ValueError(f"a task holds {args[-1].num_rows} sets")
                return run(*args)

            # Arrow functions are told apart by their number of arguments.
            return (lambda key, table: held(key, table)) if factory.__name__ == "_ask" else (lambda table: held(table))

        return make

    monkeypatch.setattr(near, "BLOCK_SETS", block)
    monkeypatch.setattr(near, "_link", bounded(near._link))
    monkeypatch.setattr(near, "_ask", bounded(near._ask))
    draw = random.Random(7)
    passage = " ".join(f"p{k}" for k in range(40))
    own = lambda n: " ".join(f"w{draw.randrange(10**6)}" for _ in range(n))
    rows = [(k, f"{passage} {own(20)}") for k in range(300)]
    rows += [(k, rows[k - 300][1] + " more") for k in range(300, 330)]
    found = near.near_duplicates(make_docs(rows)).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows)
    assert "_ask" in seen


def test_likely_is_the_estimate_at_a_threshold():
    draw = np.random.default_rng(6)
    pool = draw.integers(0, 2**63, 1_500, dtype=np.uint64)
    sets = [np.unique(pool[k:k + 1_000]) for k in range(0, 500, 5)]
    rows, sizes = near.sketch(sets), np.array([len(s) for s in sets], np.float64)
    guess = near.estimate(rows[0], len(sets[0]), rows, sizes)
    clear = abs(guess - 0.55) > 1e-4
    assert ((guess >= 0.55) == near.likely(rows[0], len(sets[0]), rows, sizes, 0.55))[clear].all()


def test_query_on_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = QUERIES["op4_near_duplicates"](spark, SF).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows)


def test_empty_table(make_docs):
    assert near.near_duplicates(make_docs([(1, "x")]).limit(0)).collect() == []
    alone = near.near_duplicates(make_docs([(3, None)])).collect()
    assert [tuple(r) for r in alone] == [(3, 0, 3, True)]


def test_sets_have_the_size_of_the_shingles():
    texts = ["", " ", "a", "a b c d", "a b c d e", "a b c d e f", "x " * 50, "A b c d e a B c d e a b c d e"]
    assert [len(s) for s in near.shingle_sets(pa.array(texts))] == [len(shingles(t)) for t in texts]


def test_sketches_merge_and_estimate():
    draw = np.random.default_rng(5)
    for size, shared in ((1000, 900), (1000, 750), (300, 200), (2000, 100)):
        pool = draw.integers(0, 2**63, 2 * size, dtype=np.uint64)
        a, b = np.unique(pool[:size]), np.unique(pool[size - shared:2 * size - shared])
        sa, sb, both = near.sketch([a, b, np.union1d(a, b)])
        assert (near.merged(sa, sb) == both).all()
        truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(near.estimate(sa, len(a), sb[None, :], np.array([len(b)]))[0] - truth) < 0.1


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 480)] + [(9, 9)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    found = graph.components(spark.createDataFrame(edges, "a bigint, b bigint"), "test").collect()
    assert sorted(tuple(r) for r in found) == sorted((x, find(x)) for x in list(parent))
