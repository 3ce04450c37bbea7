"""Repeated word windows against counting tuples of words."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

from sentilode.llm import windows
from sentilode.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(rows, window=35):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    counts = Counter(tuple(w[k:k + window]) for w in texts for k in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, texts):
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if counts[tuple(w[k:k + window])] > 1:
                gone[k:k + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def test_like_counting_windows(make_docs):
    draw = random.Random(3)
    text = lambda n: draw.choice([" ", "\n", " \t "]).join(draw.choice("ab é 😀 word x\x1cy".split(" ")) + str(draw.randrange(40)) for _ in range(n))
    passage, rows = text(90), []
    for k in range(60):
        rows.append((k, " ".join([text(draw.randint(0, 60)), " ".join(passage.split()[draw.randrange(40):])][:draw.randint(0, 2)])))
    rows += [(None, passage), (None, None), (3, passage), (3, passage), (200, ""), (201, "a " * 34), (202, "a " * 35), (203, "b " * 36), (204, "w" * 100_000), (205, text(20_000))]
    found = windows.remove_repeated_windows(make_docs(rows)).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows)


def test_query_on_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = QUERIES["op8_repeated_windows"](spark, SF).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows)


def test_empty_table(make_docs):
    assert windows.remove_repeated_windows(make_docs([(1, "x")]).limit(0)).collect() == []
