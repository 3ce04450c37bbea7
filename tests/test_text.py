"""Literal rows for the edge cases of cleaning and tokenising."""

from __future__ import annotations

import pytest
from pyspark.ml.feature import NGram, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from sentilode.functions import patterns as P, text as tx
from sentilode.functions.arrays import count_terms, ngrams, word_map, word_set
from sentilode.functions.labels import recode_label, replace_label, sentiment_name
from sentilode.plans.denoise import denoise_tokens


def one(spark, expression, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "raw, cleaned",
    [
        ("don't go http://x.y/z,hello @bob.smith, hi", "dont go   hi"),
        ("@bob,hello @123 a@b.com", " @ a"),
        ("😀 hi ❤ café @élève_1 www.a.com next httpfoo", " hi  café   next "),
        ("a ½ @x½y", "a ½ "),
        ("http www", "http www"),
        ("#tag 12:30 it's", "tag : its"),
        ("", ""),
        (None, None),
    ],
)
def test_clean(spark, raw, cleaned):
    assert one(spark, tx.clean, raw) == cleaned


@pytest.mark.parametrize(
    "raw, tokens",
    [
        (" A  b\tC ", ["", "a", "", "b", "c"]),
        ("", [""]),
        ("   ", []),
        ("x\n\ny z", ["x", "", "y z"]),
        (None, None),
    ],
)
def test_tokenize(spark, raw, tokens):
    assert one(spark, tx.tokenize, raw) == tokens
    if raw is not None:
        frame = spark.createDataFrame([(raw,)], "v string")
        assert Tokenizer(inputCol="v", outputCol="t").transform(frame).first()["t"] == tokens


def test_stopwords(spark):
    words = ["A", "The", "", "b"]
    assert one(spark, tx.remove_stopwords, words, "array<string>") == ["", "b"]
    assert one(spark, tx.remove_stopwords_exact, words, "array<string>") == words
    assert one(spark, lambda c: tx.remove_stopwords_exact(c, ["b"]), words, "array<string>") == ["A", "The", ""]


def test_stopword_list_is_sparks(spark):
    assert P.ENGLISH_STOPWORDS == StopWordsRemover.loadDefaultStopWords("english")
    assert len(P.ENGLISH_STOPWORDS) == 181


def test_contractions(spark):
    words = "I'm  sure you\tcan't, dont WE'RE were"
    assert one(spark, tx.expand_contractions_words, words) == "I am sure you can't, do not We are were"
    text = "I'm  sure you\tcan't, dont!"
    assert one(spark, tx.expand_contractions_text, text) == "I am  sure you\tcannot, do not!"
    assert one(spark, tx.expand_contractions_words, None) is None
    assert one(spark, tx.expand_contractions_text, None) is None


def test_words_and_denoise(spark):
    assert one(spark, tx.word_tokenize, "Ab-c, d2!") == ["Ab", "-", "c", ",", "d2", "!"]
    assert one(spark, tx.keep_alphabetic, ["a", "b2", "é", ""], "array<string>") == ["a", "é"]
    assert one(spark, denoise_tokens, "It's 2 Dogs, don't run!") == ["dogs", "run"]
    assert one(spark, tx.vector_words, "A bb, C_3 d") == ["bb", "c_3"]


@pytest.mark.parametrize("words", [["a", "b", "c"], ["a"], []])
def test_ngrams(spark, words):
    frame = spark.createDataFrame([(words,)], "v array<string>")
    for n in (1, 2, 3):
        want = NGram(n=n, inputCol="v", outputCol="g").transform(frame).first()["g"]
        assert frame.select(ngrams(F.col("v"), n)).first()[0] == want


def test_count_terms(spark):
    assert [tuple(r) for r in one(spark, count_terms, list("baab") + ["c"], "array<string>")] == [
        ("a", 2), ("b", 2), ("c", 1)
    ]
    assert one(spark, count_terms, [], "array<string>") == []


def test_word_set(spark):
    words = [f"w{i}é" for i in range(500)] + ["it's", "back\\slash"]
    test = word_set(words)
    asked = words + ["", "w500é", "it"]
    got = one(spark, lambda c: F.transform(c, test), asked, "array<string>")
    assert got == [True] * len(words) + [False] * 3
    assert one(spark, lambda c: F.transform(c, word_set([])), ["a", ""], "array<string>") == [False, False]


def test_word_map(spark):
    texts = {f"w{i}é": f"t{i}'" for i in range(300)} | {"it's": "back\\slash"}
    find = word_map(texts)
    asked = list(texts) + ["", "none"]
    got = one(spark, lambda c: F.transform(c, find), asked, "array<string>")
    assert got == list(texts.values()) + [None, None]
    assert one(spark, lambda c: F.transform(c, word_map({})), ["a", ""], "array<string>") == [None, None]


def test_labels(spark):
    rows = spark.createDataFrame([(4,), (0,), (2,), (None,)], "t int")
    assert [r[0] for r in rows.select(recode_label(F.col("t"))).collect()] == [1, 0, 0, 0]
    assert [r[0] for r in rows.select(replace_label(F.col("t"))).collect()] == [1, 0, 2, None]
    said = spark.createDataFrame([(1.0,), (0.0,), (None,)], "p double")
    assert [r[0] for r in said.select(sentiment_name(F.col("p"))).collect()] == [
        "positive", "negative", "negative"
    ]


TREEBANK = [
    ("Good muffins cost $3.88\nin New York.  Please buy me\ntwo of them.\nThanks.",
     "Good muffins cost $ 3.88 in New York . Please buy me two of them . Thanks ."),
    ("They'll save and invest more.", "They 'll save and invest more ."),
    ("hi, my name can't hello,", "hi , my name ca n't hello ,"),
    ("On a $50,000 mortgage of 30 years at 8 percent, the monthly payment would be $366.88.",
     "On a $ 50,000 mortgage of 30 years at 8 percent , the monthly payment would be $ 366.88 ."),
    ('"We beat some pretty good teams to get here," Slocum said.',
     "`` We beat some pretty good teams to get here , '' Slocum said ."),
    ('Well, we couldn\'t have this predictable, cliche-ridden, "Touched by an Angel" (a show creator John Masius worked on) '
     "wanna-be if she didn't.",
     "Well , we could n't have this predictable , cliche-ridden , `` Touched by an Angel '' ( a show creator John Masius "
     "worked on ) wanna-be if she did n't ."),
    ("I cannot cannot work under these conditions!", "I can not can not work under these conditions !"),
    ("Mr. Smith's dogs' food -- wait... what?", "Mr. Smith 's dogs ' food -- wait ... what ?"),
    ("I'm gonna; 'Tis 3:30. We've GOTTA go [now].", "I 'm gon na ; 'T is 3:30 . We 've GOT TA go [ now ] ."),
    ("", ""),
    ("  \n ", ""),
]


def test_treebank_tokens(spark):
    rows = [(k, text) for k, (text, _) in enumerate(TREEBANK)] + [(len(TREEBANK), None)]
    df = spark.createDataFrame(rows, "k int, text string").select("k", tx.treebank_tokens(F.col("text")).alias("w"))
    found = {r["k"]: r["w"] for r in df.collect()}
    assert found.pop(len(TREEBANK)) is None
    assert [" ".join(found[k]) for k in range(len(TREEBANK))] == [want for _, want in TREEBANK]


def test_symbol_runs_are_the_class_that_sql_has(spark):
    """Every code point goes or stays as the class says."""
    points = spark.range(0x110000).filter("id < 55296 or id > 57343")
    units = points.select("id", F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "utf-32").alias("c")).select("id", F.concat(F.lit("a"), "c", F.lit("b")).alias("t"))
    assert units.filter(~tx.strip_symbols(F.col("t")).eqNullSafe(F.regexp_replace("t", P.SYMBOLS, ""))).count() == 0
    assert units.filter(tx.strip_symbols(F.col("t")) == "ab").count() > 600


def test_texts_without_links_or_mentions_skip_the_patterns(spark):
    """Only texts that can match are searched, with the results of the plain patterns."""
    texts = ["", "a b", "http", "see http://x.y and www.z", "xhttpx y", "@", "@me you", "a@b @ c", "httwww @é_1!", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.filter(~tx.strip_links(F.col("t")).eqNullSafe(F.regexp_replace("t", P.LINK, ""))).count() == 0
    assert df.filter(~tx.strip_mentions(F.col("t")).eqNullSafe(F.regexp_replace("t", P.MENTION, ""))).count() == 0
    plan = df.select(tx.strip_links(F.col("t")))._jdf.queryExecution().toString()
    assert "http" in plan and "CASE WHEN" in plan
