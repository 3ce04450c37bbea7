"""The relational lemmas and the pipeline stage against the rules in plain Python."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sentilode.operators import lemma
from sentilode.operators.stages import Lemmatizer

LEXICON = {
    "n": ["dog", "box", "boss", "bus", "church", "wish", "city", "wolf", "wolve", "man", "woman", "foot", "as",
          "lens", "glass", "axe", "quiz", "ass", "child"],
    "v": ["run", "make", "mak", "try", "go", "be", "agree", "see", "use"],
    "a": ["good", "big", "nice", "bigg"],
    "r": ["well", "fast"],
}
WORDS = [
    "dogs", "dog", "boxes", "bosses", "boss", "buses", "busses", "churches", "wishes", "cities", "wolves", "men",
    "women", "feet", "as", "ass", "asses", "lenses", "glasses", "axes", "quizzes", "dogss", "dogsss", "s", "ss",
    "xyz", "menss", "children", "running", "making", "tries", "goes", "agreed", "uses", "used", "was", "seeing",
    "bigger", "nicer", "nicest", "best", "better", "fast", "faster", "é", "unknowns",
]


def by_hand(word, pos):
    """The published algorithm, word by word."""
    known = set(LEXICON[pos])

    def reduce(forms):
        return [
            f[: -len(old)] + new
            for f in forms
            for old, new in lemma.SUFFIX_RULES[pos]
            if f.endswith(old) and f[: -len(old)] + new
        ]

    def fitting(forms):
        return [f for f in forms if f in known]

    irregular = sorted(l for p, f, l in lemma.IRREGULAR if p == pos and f == word)
    if irregular:
        found = fitting([word, *irregular])
    else:
        forms = reduce([word])
        found = fitting([word, *forms])
        while forms and not found:
            forms = reduce(forms)
            found = fitting(forms)
    return min(found, key=len) if found else word


@pytest.mark.parametrize("pos", list("nvar"))
def test_lemmas(spark, pos):
    want = {w: by_hand(w, pos) for w in WORDS}
    words = spark.createDataFrame([(w,) for w in WORDS], "term string")
    lexicon = spark.createDataFrame([(p, w) for p, ws in LEXICON.items() for w in ws], "pos string, lemma string")
    changed = lemma.changed_lemmas(words, lexicon, lemma.irregular_table(spark), pos).collect()
    assert {r["term"]: r["lemma"] for r in changed} == {w: l for w, l in want.items() if w != l}

    tokens = spark.createDataFrame([(1, [""] + WORDS), (2, []), (3, ["dogs", "dogs"])], "id int, t array<string>")
    stage = Lemmatizer(
        inputCol="t", outputCol="l", lexicon=LEXICON[pos], pos=pos,
        irregular=[f"{f} {l}" for p, f, l in lemma.IRREGULAR if p == pos],
    )
    in_row = {r["id"]: r["l"] for r in stage.transform(tokens).collect()}
    assert in_row == {1: [want[w] for w in WORDS], 2: [], 3: [want["dogs"]] * 2}

    table = spark.createDataFrame([(r["term"], r["lemma"]) for r in changed], "term string, lemma string")
    no_empty = tokens.select("id", F.filter("t", lambda w: w != "").alias("t"))
    for limit in (lemma.IN_ROW_LEMMAS, -1):  # inside the row, and by a join
        applied = lemma.lemmatize_tokens(no_empty, ["id"], "t", table, in_row=limit)
        assert {r["id"]: r["lemmatized"] for r in applied.collect()} == in_row


def test_tags_choose_the_rules(spark):
    words = spark.createDataFrame([("makes",), ("bigger",), ("dogs",), ("untagged",)], "term string")
    tags = spark.createDataFrame(
        [("makes", "VBZ"), ("bigger", "JJR"), ("dogs", "NNS"), ("dogs", "VBZ")], "token string, tag string"
    )
    lexicon = spark.createDataFrame([(p, w) for p, ws in LEXICON.items() for w in ws], "pos string, lemma string")
    changed = lemma.tagged_changes(words, tags, lexicon, lemma.irregular_table(spark)).collect()
    assert {tuple(r) for r in changed} == {
        ("makes", by_hand("makes", "v")), ("bigger", by_hand("bigger", "a")), ("dogs", by_hand("dogs", "n"))
    }


def test_stage_is_saved_with_its_lexicon(spark, tmp_path):
    stage = Lemmatizer(inputCol="a", outputCol="b", lexicon=["dog"], pos="n")
    stage.write().overwrite().save(str(tmp_path / "stage"))
    again = Lemmatizer.load(str(tmp_path / "stage"))
    frame = spark.createDataFrame([(["dogs", "cats", "feet"],)], "a array<string>")
    assert again.transform(frame).first()["b"] == ["dog", "cats", "feet"]
    assert again.getInputCol() == "a"


def test_stage_takes_its_table_along(spark, tmp_path):
    table = spark.createDataFrame([("dog",)] + [(f"word{k}",) for k in range(20_000)], "lemma string")
    table.write.parquet(str(tmp_path / "table"))
    stage = Lemmatizer(inputCol="a", outputCol="b", lexiconPath=str(tmp_path / "table"))
    stage.write().overwrite().save(str(tmp_path / "stage"))
    again = Lemmatizer.load(str(tmp_path / "stage"))
    assert again.getOrDefault("lexiconPath") == str(tmp_path / "stage" / "lexicon")
    frame = spark.createDataFrame([(["dogs", "word19999s", "feet", ""],), (None,)], "a array<string>")
    assert [r["b"] for r in again.transform(frame).collect()] == [["dog", "word19999", "feet"], None]


@pytest.mark.parametrize("limit", [lemma.IN_ROW_LEMMAS, -1])
def test_same_rows_inside_the_row_and_by_a_join(spark, limit):
    """Rows that share a key stay apart, null tokens and null arrays stay null."""
    rows = [(1, ["dogs", None]), (1, ["x", "dogs"]), (None, ["dogs"]), (2, None), (3, [])]
    changed = spark.createDataFrame([("dogs", "dog")], "term string, lemma string")
    got = lemma.lemmatize_tokens(spark.createDataFrame(rows, "id int, t array<string>"), ["id"], "t", changed, in_row=limit)
    want = [(1, ["dog", None]), (1, ["x", "dog"]), (None, ["dog"]), (2, None), (3, [])]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_a_long_token_takes_no_memory_per_pass(spark):
    word = "s" * 20_000
    words = spark.createDataFrame([(word,), ("dogs",)], "term string")
    lexicon = spark.createDataFrame([("n", "dog"), ("n", "ss")], "pos string, lemma string")
    changed = lemma.changed_lemmas(words, lexicon, lemma.irregular_table(spark), "n").collect()
    assert {(r["term"][:4], r["lemma"]) for r in changed} == {("ssss", "ss"), ("dogs", "dog")}


def test_only_changed_tokens_come_back_to_their_row(spark):
    """Changes at the begin, the end, side by side, none, and beside null tokens; words that stay are not in the shuffled groups."""
    rows = [(["b", "a", "b"],), (["a", "a"],), (["b"],), ([],), (None,), ([None, "a", None],), (["b", None, "c", "a"],)]
    df = spark.createDataFrame(rows, "words array<string>").coalesce(1)
    changed = spark.createDataFrame([("a", "x y"), ("c", "z")], "term string, lemma string")
    found = lemma.with_lemmas(df, "words", changed, in_row=0)
    new = {"a": "x y", "c": "z"}
    want = [[new.get(w, w) for w in r[0]] if r[0] is not None else None for r in rows]
    assert sorted(map(str, ((r["words"], r["lemmatized"]) for r in found.collect()))) == sorted(map(str, ((r[0], w) for r, w in zip(rows, want))))
    places = spark.createDataFrame([(["a", None, "c"], [(2, "z")])], "t array<string>, w array<struct<_at:int,w:string>>")
    assert places.select(lemma.replaced(F.col("t"), F.col("w"))).first()[0] == ["a", None, "z"]
