"""Tags against a search of all tag sequences; a word that has two tags; lemmas by tag."""

from __future__ import annotations

import math
import random
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from sentilode.operators import tagging

SENTENCES = [
    ("they run home", "PR VB NN"), ("the run ended", "DT NN VB"), ("the dog ran", "DT NN VB"), ("they saw the saw", "PR VB DT NN"),
    ("we run", "PR VB"), ("the long run", "DT JJ NN"), ("the better dog ran better", "DT JJ NN VB RB"), ("they left", "PR VB"),
    ("the left paw", "DT JJ NN"), ("we saw a dog", "PR VB DT NN"),
]


@pytest.fixture(scope="module")
def tagger(spark):
    rows = [(s.split(), t.split()) for s, t in SENTENCES] + [([], []), (None, None), (["x", None], ["NN", "NN"]), (["x"], ["NN", "VB"])]
    return tagging.learn(spark.createDataFrame(rows, "tokens array<string>, tags array<string>"))


def brute(sentence):
    """The best of all tag sequences by counts; of equal ones the one whose last tags come first."""
    words, follow, classes = Counter(), Counter(), {}
    for s, t in SENTENCES:
        s, t = s.split(), t.split()
        follow.update(zip(["", *t], t))
        words.update(zip(s, t))
    tags = sorted({t for _, t in follow})
    seen = {w: "|".join(sorted({t for v, t in words if v == w})) for w, _ in words}
    endings = {w[-3:]: "|".join(sorted({t for v, t in words if v[-3:] == w[-3:] and len(v) >= 3})) for w in seen if len(w) >= 3}
    classes = sorted({*seen.values(), *endings.values(), "*"})
    emit = Counter()
    for (w, t), n in words.items():
        emit[seen[w], t] += n
    log = lambda n, total, kinds: round(math.log((n + 1) / (total + kinds)) * tagging.UNIT)
    begun = {b: sum(n for (c, _), n in follow.items() if c == b) for b in [*tags, ""]}
    said = {t: sum(n for (_, u), n in emit.items() if u == t) for t in tags}
    best = None
    for path in product(tags, repeat=len(sentence)):
        score = sum(log(follow[b, t], begun[b], len(tags)) for b, t in zip(["", *path], path))
        score += sum(
            log(emit[seen.get(w) or endings.get(w[-3:]) or "*", t], said[t], len(classes)) for w, t in zip(sentence, path)
        )
        key = (-score, path[::-1])
        best = min(best, key) if best else key
    return list(best[1][::-1])


@pytest.mark.parametrize("in_row", [100_000, 0])
def test_best_of_all_sequences(spark, tagger, in_row):
    rng = random.Random(1)
    vocabulary = [w for s, _ in SENTENCES for w in s.split()] + ["unknown", "sun", "zzz", "q"]
    rows = [(k, [rng.choice(vocabulary) for _ in range(rng.randrange(1, 6))]) for k in range(30)]
    found = tagging.with_tags(spark.createDataFrame(rows, "k int, words array<string>"), "words", tagger, in_row=in_row)
    got = {r["k"]: r["tags"] for r in found.collect()}
    assert got == {k: brute(words) for k, words in rows}


def test_one_word_two_tags(spark, tagger):
    rows = [("they run".split(),), ("the run".split(),), ("they saw the saw".split(),), ([],), (None,)]
    found = [r["tags"] for r in tagging.with_tags(spark.createDataFrame(rows, "words array<string>").coalesce(1), "words", tagger).collect()]
    assert found == [["PR", "VB"], ["DT", "NN"], ["PR", "VB", "DT", "NN"], [], None]


def test_lemmas_by_tag(spark, tagger):
    rows = [("they saw the saw".split(), ["PR", "VB", "DT", "NN"]), ("the better dog ran better".split(), ["DT", "JJ", "NN", "VB", "RB"])]
    df = spark.createDataFrame(rows, "words array<string>, tags array<string>").coalesce(1)
    lexicon = spark.createDataFrame(
        [("n", "saw"), ("v", "see"), ("a", "good"), ("r", "well"), ("v", "run"), ("n", "dog")], "pos string, lemma string"
    )
    exceptions = spark.createDataFrame(
        [("v", "saw", "see"), ("a", "better", "good"), ("r", "better", "well"), ("v", "ran", "run")], "pos string, form string, lemma string"
    )
    found = tagging.lemmatize_in_context(df, "words", "tags", lexicon, exceptions).collect()
    assert sorted(r["lemmatized"] for r in found) == [["the", "good", "dog", "run", "well"], ["they", "see", "the", "saw"]]


def test_nothing_learned(spark):
    none = tagging.learn(spark.createDataFrame([], "tokens array<string>, tags array<string>"))
    df = spark.createDataFrame([(["a", "b"],)], "words array<string>")
    assert tagging.with_tags(df, "words", none).first()["tags"] == [None, None]


def test_long_sentence(spark, tagger):
    df = spark.createDataFrame([(["they", "run"] * 2000,)], "words array<string>")
    assert len(tagging.with_tags(df, "words", tagger).first()["tags"]) == 4000


def test_long_sentence_and_rare_words(spark, tagger):
    """A sentence of 30,000 words is tagged in time in proportion to it, alike with all, some and no words looked up in the batch."""
    rng = random.Random(2)
    vocabulary = [w for s, _ in SENTENCES for w in s.split()] + ["unknown", "sun", "q", "", None]
    rows = [(0, [rng.choice(vocabulary) for _ in range(30_000)]), (1, []), (2, None), (3, ["run"]), (4, [None])]
    df = spark.createDataFrame(rows, "k int, words array<string>").coalesce(1)
    every, some, none = ({r["k"]: r["tags"] for r in tagging.with_tags(df, "words", tagger, in_row=n).collect()} for n in (100_000, 5, 0))
    assert every == some == none
    assert [len(every[k]) if every[k] is not None else None for k in range(5)] == [30_000, 0, None, 1, 1]
    cut = tagging.with_tags(spark.createDataFrame([(rows[0][1][:5],)], "words array<string>"), "words", tagger).first()["tags"]
    assert cut == brute([w if w is not None else "" for w in rows[0][1][:5]])


LEXICON = [("n", "saw"), ("v", "see"), ("a", "good"), ("r", "well"), ("v", "run"), ("n", "dog"), ("n", "run"), ("n", "paw"), ("v", "end"), ("n", "end")]
EXCEPTIONS = [("v", "saw", "see"), ("a", "better", "good"), ("r", "better", "well"), ("v", "ran", "run")]


@pytest.mark.parametrize("in_row, most", [(100_000, None), (3, None), (0, 0)])
def test_documents_as_their_sentences(spark, tagger, in_row, most, monkeypatch):
    """Documents give what a row per sentence gives, with all, some and no words looked up in the batch, and write none of their words in order."""
    rng = random.Random(3)
    vocabulary = [w for s, _ in SENTENCES for w in s.split()] + ["unknown", "dogs", "saws", "zings", "q"]
    texts = [". ".join(" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(5))) for _ in range(rng.randrange(1, 6))) for _ in range(40)]
    rows = [(k % 30 if k % 7 else None, t) for k, t in enumerate(texts)] + [(50, None), (51, ""), (52, "..."), (None, None)]
    docs = spark.createDataFrame(rows, "k bigint, body string").repartition(3)
    lexicon = spark.createDataFrame(LEXICON, "pos string, lemma string")
    exceptions = spark.createDataFrame(EXCEPTIONS, "pos string, form string, lemma string")
    words = lambda sentence: F.regexp_extract_all(sentence, F.lit("[a-z]+"), F.lit(0))
    cut = docs.select("k", F.posexplode(F.split("body", "[.]")).alias("at", "s")).select("k", "at", words("s").alias("tokens")).filter(F.size("tokens") > 0)
    want = tagging.lemmatize_in_context(tagging.with_tags(cut, "tokens", tagger), "tokens", "tags", lexicon, exceptions)
    columns = ["k", "at", "tokens", "tags", "lemmatized"]
    if most is not None:
        monkeypatch.setattr(tagging, "lookup_join", lambda *a, join=tagging.lookup_join, **b: join(*a, **b, max_bytes=most))
    written = []
    keep = tagging.materialize
    monkeypatch.setattr(tagging, "materialize", lambda df, name: written.append(df.columns) or keep(df, name))
    found = tagging.lemmatize_documents(
        docs, "k", "body", lambda text: F.transform(F.split(text, "[.]"), words), tagger, lexicon, exceptions, in_row
    )
    assert not [c for c in written if {"tokens", "tags", "_text"} & set(c)]
    assert found.columns == columns and found.count() == docs.select("k").distinct().count()
    flat = found.select("k", F.inline(F.arrays_zip("at", "tokens", "tags", "lemmatized")))
    known = lambda df: sorted((str(r["k"]), r["at"], r["tokens"], r["tags"], r["lemmatized"]) for r in df.collect())
    assert known(flat) == known(want) and known(want)


def test_documents_and_nothing_learned(spark):
    none = tagging.learn(spark.createDataFrame([], "tokens array<string>, tags array<string>"))
    lexicon = spark.createDataFrame(LEXICON, "pos string, lemma string")
    exceptions = spark.createDataFrame(EXCEPTIONS, "pos string, form string, lemma string")
    docs = spark.createDataFrame([(1, "dogs ran")], "k int, body string")
    found = tagging.lemmatize_documents(docs, "k", "body", lambda t: F.array(F.split(t, " ")), none, lexicon, exceptions).first()
    assert (found["tags"], found["lemmatized"]) == ([[None, None]], [["dog", "ran"]])


def test_sentences_in_parts(tagger, monkeypatch):
    rng = random.Random(4)
    model = tagging.Tagger(tagger.tags, tagger.classes, tagger.transitions, tagger.emissions, None, None)
    numbers = np.array([rng.randrange(len(tagger.classes)) for _ in range(60)])
    starts = np.array([0, 1, 1, 20, 29, 60])
    whole = tagging.viterbi(numbers, starts, model).tolist()
    for n in (1, 7, 30, 1000):
        monkeypatch.setattr(tagging, "TOGETHER", n)
        assert tagging._in_parts(numbers, starts, model).tolist() == whole
    assert tagging._in_parts(numbers[:0], np.array([0]), model).tolist() == []
