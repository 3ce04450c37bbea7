"""Lemmas by suffix rules over a lexicon table and a table of exceptions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sentilode.functions.arrays import let, word_map
from sentilode.operators.scale import lookup_join
from sentilode.session import materialize

# Up to this many changed words are looked up inside the row instead of being joined.
IN_ROW_LEMMAS = 100_000

# The published suffix rules per part of speech (noun, verb, adjective, adverb).
SUFFIX_RULES = {
    "n": [("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"),
          ("shes", "sh"), ("men", "man"), ("ies", "y")],
    "v": [("s", ""), ("ies", "y"), ("es", "e"), ("es", ""), ("ed", "e"), ("ed", ""),
          ("ing", "e"), ("ing", "")],
    "a": [("er", ""), ("est", ""), ("er", "e"), ("est", "e")],
    "r": [],
}

# Common irregular forms (part of speech, form, lemma).
IRREGULAR = [
    ("n", "children", "child"), ("n", "feet", "foot"), ("n", "geese", "goose"),
    ("n", "knives", "knife"), ("n", "lives", "life"), ("n", "men", "man"),
    ("n", "mice", "mouse"), ("n", "oxen", "ox"), ("n", "teeth", "tooth"),
    ("n", "wives", "wife"), ("n", "women", "woman"),
    ("v", "ate", "eat"), ("v", "began", "begin"), ("v", "bought", "buy"),
    ("v", "came", "come"), ("v", "did", "do"), ("v", "found", "find"), ("v", "gave", "give"),
    ("v", "gone", "go"), ("v", "got", "get"), ("v", "knew", "know"), ("v", "made", "make"),
    ("v", "ran", "run"), ("v", "said", "say"), ("v", "saw", "see"), ("v", "took", "take"),
    ("v", "was", "be"), ("v", "went", "go"), ("v", "were", "be"), ("v", "written", "write"),
    ("a", "best", "good"), ("a", "better", "good"), ("a", "worse", "bad"),
    ("a", "worst", "bad"), ("r", "better", "well"), ("r", "best", "well"),
]


def candidates(word: Column, irregular: Column, pos: str, longest: int) -> Column:
    """All that `word` may reduce to: array<struct<pass, length, rank, form>>.

    `irregular` holds the lemmas of an irregular form, or null. Such a form is
    not reduced further. Any other word goes through the rules, and the
    results go through them again for as long as a rule applies; a word never
    gets longer, so its length bounds the passes. Forms longer than `longest`,
    the length of the longest known lemma, are reduced further but not listed.
    """
    rules = SUFFIX_RULES[pos]

    def entry(n, form: Column, rank) -> Column:
        return F.struct(
            n.cast("int").alias("pass"),
            F.length(form).alias("length"),
            rank.cast("int").alias("rank"),
            form.alias("form"),
        )

    def reduced(form: Column) -> Column:
        kept = F.length(form)
        made = [
            F.when(
                form.endswith(old) & (kept > len(old) - len(new)),
                F.concat(F.substr(form, F.lit(1), kept - len(old)), F.lit(new)),
            )
            for old, new in rules
        ]
        return F.filter(F.array(*made), lambda f: f.isNotNull() & (F.length(f) > 0))

    def one_pass(state: Column, n: Column) -> Column:
        return let(
            F.flatten(F.transform(state["open"], reduced)),
            lambda forms: F.struct(
                forms.alias("open"),
                F.concat(
                    state["found"],
                    F.filter(
                        F.transform(forms, lambda f, i: entry(n, f, i + 1)), lambda e: e["length"] <= longest
                    ),
                ).alias("found"),
            ),
        )

    itself = F.array(entry(F.lit(1), word, F.lit(0)))
    listed = F.concat(
        itself, F.transform(irregular, lambda f, i: entry(F.lit(1), f, i + 1))
    )
    if not rules:
        return F.when(irregular.isNotNull(), listed).otherwise(itself)
    ruled = F.aggregate(
        F.sequence(F.lit(1), F.length(word)),
        F.struct(F.array(word).alias("open"), itself.alias("found")),
        one_pass,
        lambda state: state["found"],
    )
    return (
        F.when(irregular.isNotNull(), listed)
        .when(word.rlike(rule_ending(pos)), ruled)
        .otherwise(itself)
    )


def rule_ending(pos: str) -> str:
    """A pattern for the words that a suffix rule applies to; of an adverb none does."""
    endings = sorted({old for old, _ in SUFFIX_RULES[pos]})
    return "(" + "|".join(endings) + ")$" if endings else "(?!)"


def changed_lemmas(
    vocabulary: DataFrame,
    lexicon: DataFrame,
    exceptions: DataFrame,
    pos: str | None = None,
    term: str = "term",
    longest: int | None = None,
) -> DataFrame:
    """(term, lemma) for the distinct terms whose lemma is another word.

    All terms have the part of speech `pos`, or each the one in its column
    `pos`. Of a term's candidates those in the lexicon count: the earliest
    pass, then the shortest, then the first wins. A term without any keeps its form.
    `longest`, the length of the longest lemma, is looked up in the lexicon unless it is given.
    """
    words = vocabulary.select(term, F.lit(pos).alias("pos") if pos else F.col("pos"))
    if pos:
        lexicon, exceptions = (t.filter(F.col("pos") == pos) for t in (lexicon, exceptions))
    irregular = exceptions.groupBy("pos", F.col("form").alias(term)).agg(
        F.sort_array(F.collect_set("lemma")).alias("_irregular")
    )
    known = lexicon.select("pos", F.col("lemma").alias("form")).distinct()
    if longest is None:
        longest = known.agg(F.coalesce(F.max(F.length("form")), F.lit(0))).first()[0]
    tried = candidates(F.col(term), F.col("_irregular"), pos or "n", longest)
    if pos is None:
        for other in ("v", "a", "r"):
            tried = F.when(
                F.col("pos") == other, candidates(F.col(term), F.col("_irregular"), other, longest)
            ).otherwise(tried)
    best = (
        words.join(irregular, ["pos", term], "left")
        .select("pos", term, F.inline_outer(tried))
        .join(known, ["pos", "form"], "left_semi")
        .groupBy(term)
        .agg(F.min_by("form", F.struct("pass", "length", "rank")).alias("lemma"))
    )
    return best.filter(F.col("lemma") != F.col(term))


def with_lemmas(
    df: DataFrame, tokens: str, changed: DataFrame, name: str = "lemmatized", in_row: int = IN_ROW_LEMMAS
) -> DataFrame:
    """`df` with the lemmas of each row's tokens in their order, by the table `changed` (term, lemma) of distinct terms.

    Up to `in_row` changes go into the plan and are looked up inside the row,
    without a shuffle. Beyond it the tokens are joined with the changes, and only those that change
    come back to their row, by a number that each row gets; such a group is at most the tokens of one
    row. Both give the same rows: a null token and a null array stay null.
    """
    few = changed.limit(in_row + 1).collect()
    if len(few) <= in_row and not any(" " in r["term"] + r["lemma"] for r in few):
        lemma_of = word_map({r["term"]: r["lemma"] for r in few})
        return df.withColumn(name, F.transform(tokens, lambda w: F.coalesce(lemma_of(w), w)))
    numbered = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    words = numbered.select("_row", F.posexplode(tokens).alias("_at", "term"))
    words = lookup_join(words, changed, "term", "inner").select("_row", F.struct("_at", F.col("lemma").alias("w")).alias("_word"))
    in_order = words.groupBy("_row").agg(F.sort_array(F.collect_list("_word")).alias("_words"))
    return (
        numbered.join(in_order, "_row", "left")
        .withColumn(name, F.when(F.col("_words").isNull(), F.col(tokens)).otherwise(replaced(F.col(tokens), F.col("_words"))))
        .drop("_row", "_words")
    )


def replaced(tokens: Column, words: Column) -> Column:
    """`tokens` with some of them replaced: array<struct<_at, w>> in order of their places, from 0. The stretches between stay as they are."""

    def from_last(word: Column, k: Column) -> Column:
        start = F.when(k > 0, F.get(words, k - 1)["_at"] + 1).otherwise(0)
        return F.concat(F.slice(tokens, start + 1, word["_at"] - start), F.array(word["w"]))

    rest = F.element_at(words, -1)["_at"] + 1
    return F.concat(F.flatten(F.transform(words, from_last)), F.slice(tokens, rest + 1, F.size(tokens) - rest))


def lemmatize_tokens(
    df: DataFrame,
    key: Sequence[str],
    tokens: str,
    changed: DataFrame,
    name: str = "lemmatized",
    in_row: int = IN_ROW_LEMMAS,
) -> DataFrame:
    """(key, lemmas) of every row; rows that share a key stay apart."""
    wide = df.select(*key, F.col(tokens).alias("_tokens"))
    return with_lemmas(wide, "_tokens", changed, name, in_row).select(*key, name)


def tagged_changes(
    vocabulary: DataFrame, tags: DataFrame, lexicon: DataFrame, exceptions: DataFrame
) -> DataFrame:
    """(term, lemma) by part of speech (the first tag of a token): J adjective, V verb, R adverb, anything else noun."""
    initial = F.substring("tag", 1, 1)
    pos = F.when(initial == "J", "a").when(initial == "V", "v").when(initial == "R", "r").otherwise("n")
    one_tag = tags.groupBy(F.col("token").alias("term")).agg(F.min("tag").alias("tag"))
    tagged = vocabulary.select("term").join(one_tag, "term", "left").select("term", pos.alias("pos"))
    return changed_lemmas(tagged, lexicon, exceptions)


def irregular_table(spark) -> DataFrame:
    return spark.createDataFrame(IRREGULAR, "pos string, form string, lemma string")
