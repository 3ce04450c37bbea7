"""Models against Kneser-Ney counts by hand, slices, held-out accuracy, texts of every kind."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sentilode.llm import language as la

ROWS = [
    ("the cat and the hat sat there", "en"), ("that is the thing, thing 4", "en"), ("die katze und der hut", "de"),
    ("das ist das ding Über", "de"), ("the the the", "en"), ("x", "de"),
]


def brute_models(rows, order=la.ORDER):
    """{lang: probability(context, symbol)} straight from the definition, over padded words."""
    grams = defaultdict(Counter)
    for text, lang in rows:
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            padded = la.PAD * (order - 1) + word + la.END
            for k in range(order - 1, len(padded)):
                grams[lang][padded[k - order + 1:k + 1]] += 1
    out = {}
    for lang, counts in grams.items():
        levels = {order: dict(counts)}
        for k in range(order - 1, 0, -1):
            levels[k] = Counter(g[1:] for g in levels[k + 1])
        discount = {}
        for k, level in levels.items():
            n1, n2 = (sum(c == n for c in level.values()) for n in (1, 2))
            discount[k] = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5

        def p(context, symbol, levels=levels, discount=discount):
            k = len(context) + 1
            lower = p(context[1:], symbol, levels, discount) if k > 1 else 1 / la.CODE_POINTS
            after = {g: c for g, c in levels[k].items() if g[:-1] == context}
            if not after:
                return lower
            total = sum(after.values())
            return max(after.get(context + symbol, 0) - discount[k], 0) / total + discount[k] * len(after) / total * lower

        out[lang] = p
    return out


@pytest.fixture(scope="module")
def small_models(spark):
    docs = spark.createDataFrame(ROWS, "text string, lang string").repartition(2)
    return la.gram_counts(docs), brute_models(ROWS)


@pytest.mark.parametrize("slice_bytes", [la.SLICE_BYTES, 400])
def test_sums_are_those_of_the_definition(spark, small_models, slice_bytes):
    counts, brute = small_models
    models = la.pack(la.kneser_ney(counts), slice_bytes)
    assert models[0].langs == ["de", "en"] and (len(models) > 1) == (slice_bytes == 400)
    for own in models:
        for keys, values in own.arrays.values():
            assert (np.diff(keys.astype(object)) > 0).all() and values.dtype == np.int32
    texts = ["the thing", "Katze? katzen", "zzz ñandú", "", "4 5", "dx", None]
    detector = la.Detector(models[0].langs, models)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in la.totals(docs, detector, ["doc_id"]).collect()}
    for k, text in enumerate(texts):
        words = [la.PAD * 4 + w + la.END for w in re.findall(r"[^\W\d_]+", (text or "").lower())]
        assert found[k]["n"] == sum(len(w) - 4 for w in words) and found[k]["letters"] == bool(words)
        for lang, total in zip(("de", "en"), found[k]["sums"]):
            want = sum(math.log(brute[lang](w[j - 4:j], w[j])) for w in words for j in range(4, len(w)))
            # Each of up to five parts of a symbol is rounded.
            assert abs(total / la.UNIT - want) <= 3 * found[k]["n"] / la.UNIT


def test_models_add_up_to_one():
    brute = brute_models(ROWS)
    symbols = {c for text, _ in ROWS for c in text.lower()} | {la.END}
    for p in brute.values():
        for context in (la.PAD * 4, "the" + "r", "zzzz", la.PAD * 3 + "d"):
            seen = sum(p(context, s) for s in symbols)
            assert seen + (la.CODE_POINTS - len(symbols)) * p(context, "☃") == pytest.approx(1)


def test_slices_give_the_same_answers(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one, many = la.learn(docs), la.learn(docs, slice_bytes=200_000)
    assert len(one.slices) == 1 and len(many.slices) > 2
    rows = [sorted(map(tuple, la.detect(docs, d).collect())) for d in (one, many)]
    assert rows[0] == rows[1]


def test_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("score", F.lit("x"))
    found = la.detect(docs, la.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(found) > 150
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.97 * len(found)
    assert sum(r["rejected"] for r in found) <= 0.1 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_strange_texts_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(5)
    odd = [(90_000 + k, " ".join("".join(rng.choice("qxzwkжбя") for _ in range(6)) for _ in range(80)), None) for k in range(20)]
    both = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    found = la.detect(both, la.learn(both)).filter("doc_id >= 90000").collect()
    assert len(found) == 20 and all(r["rejected"] and r["lang_pred"] != "und" for r in found)


def test_odd_rows(spark):
    rows = [(k, f"the one and the other {k}", "en") for k in range(40)] + [(100 + k, f"der eine und der andere {k}", "de") for k in range(40)]
    rows += [
        (900, None, "en"), (901, "", "en"), (902, "12 !? 3", "de"), (903, "the other", None), (None, "der andere", None),
        (904, "the " * 200_000, "en"), (903, "the other", None), (905, "日本語", None),
    ]
    docs = spark.createDataFrame([(*r, 1.0, "s") for r in rows], "doc_id bigint, text string, lang string, score double, rejected string")
    found = la.detect(docs, la.learn(docs)).collect()
    assert len(found) == len(rows)
    answers = defaultdict(set)
    for r in found:
        answers[r["doc_id"]].add((r["lang_pred"], r["score"]))
    assert answers[900] == answers[901] == answers[902] == {("und", 0.0)}
    assert {a for a, _ in answers[903] | answers[904]} == {"en"} and {a for a, _ in answers[None]} == {"de"}
    assert len(answers[903]) == 1 and {a for a, _ in answers[905]} <= {"de", "en"}
    assert not [r for r in found if r["doc_id"] is None and r["held_out"]]


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id bigint, text string, lang string")
    found = la.detect(docs, la.learn(docs)).collect()
    assert {(r["lang_pred"], r["score"], r["rejected"]) for r in found} == {("und", 0.0, True)}
    assert la.detect(docs.limit(0), la.learn(docs.limit(0))).count() == 0


def test_hashes_of_symbols_depend_on_those_alone():
    a, b = la.hashes(la._symbols("xxabcde")), la.hashes(la._symbols("yabcde"))
    for k in range(5):
        assert a[k][-1] == b[k][-1]
    codes, words, bounds = la.words_of(pa.array(["A b, a", None, "c3d"]))
    assert [words[c] for c in codes] == ["a", "b", "a", "c", "d"] and bounds.tolist() == [0, 3, 3, 5]
