"""Part-of-speech tags in context: a hidden Markov model over tags whose output is a word's class, the set of tags it can have.

Counts of tags in a row and of classes per tag come from a tagged corpus by group-bys. A sentence is tagged by a fold over its
array of tokens (Viterbi), for a batch of rows at once. What the fold needs is as small as the tag set; only the table of word
classes grows with the vocabulary: its most frequent words are looked up in the batch, the others by a join.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from sentilode.operators.lemma import IN_ROW_LEMMAS, SUFFIX_RULES, changed_lemmas, rule_ending, with_lemmas
from sentilode.operators.scale import BROADCAST_BYTES, lookup_join, measured_bytes, top_k
from sentilode.session import materialize, passing_tables, scratch_path, ship_package

# Logarithms as integers of this part, so that sums and ties do not depend on rounding.
UNIT = 1_000_000
# The class of a word that the corpus does not have is that of words with the same last letters.
ENDING = 3
START, ANY = "", "*"
# Sentences of a batch are tagged together up to about so many words.
TOGETHER = 200_000
WORDS = "array<struct<term:string,number:int,lemmas:array<string>>>"


@dataclass
class Tagger:
    """Tags and classes in order; transitions[j][k] from the j-th tag (the last row: from a sentence's begin); emissions[c][k].

    `words` is (term, class, n), with how often the corpus has a word; `endings` is (term, class).
    """

    tags: list[str]
    classes: list[str]
    transitions: list[list[int]]
    emissions: list[list[int]]
    words: DataFrame
    endings: DataFrame


def _logarithm(n: Column, total: Column, kinds: Column) -> Column:
    """ln((n + 1) / (total + kinds)), so that nothing is impossible."""
    return F.round(F.log((n + 1) / (total + kinds)) * UNIT).cast("bigint")


def transition_counts(tagged: DataFrame, tags: str = "tags") -> DataFrame:
    """(before, tag, n): how often a tag follows another one, or begins a sentence."""
    pairs = F.transform(
        tags, lambda tag, i: F.struct(F.when(i > 0, F.get(tags, i - 1)).otherwise(START).alias("before"), tag.alias("tag"))
    )
    return tagged.select(F.inline(pairs)).groupBy("before", "tag").agg(F.count("*").alias("n"))


def word_tags(tagged: DataFrame, tokens: str = "tokens", tags: str = "tags") -> DataFrame:
    """(term, tag, n): how often a word has a tag."""
    pairs = F.zip_with(tokens, tags, lambda w, tag: F.struct(w.alias("term"), tag.alias("tag")))
    return tagged.select(F.inline(pairs)).groupBy("term", "tag").agg(F.count("*").alias("n"))


def _class_of(tags: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(tags)), "|")


def learn(tagged: DataFrame, tokens: str = "tokens", tags: str = "tags") -> Tagger:
    """The tagger of a corpus of sentences: two arrays of equal length per row. A sentence with a null or of no words teaches nothing."""
    usable = tagged.filter((F.size(tokens) > 0) & (F.size(tokens) == F.size(tags))).select(tokens, tags)
    usable = usable.filter(~F.exists(tokens, lambda w: w.isNull()) & ~F.exists(tags, lambda w: w.isNull()))
    spark, path = tagged.sparkSession, scratch_path(tagged.sparkSession, "tagged-words")
    with passing_tables(spark):
        usable = materialize(usable, "tagged-corpus")
        follow = {(r["before"], r["tag"]): r["n"] for r in transition_counts(usable, tags).collect()}  # a square of tags
        counted = word_tags(usable, tokens, tags)
        counted.write.parquet(path)
    counted = spark.read.schema(counted.schema).parquet(path)
    uses = F.collect_list(F.struct("tag", F.col("n").alias("uses")))  # at most a tag set per word
    words = counted.groupBy("term").agg(_class_of(F.col("tag")).alias("class"), F.sum("n").alias("n"), uses.alias("tags"))
    words = materialize(words, "word-classes")
    ending = F.right("term", F.lit(ENDING))
    endings = counted.filter(F.length("term") >= ENDING).groupBy(ending.alias("term")).agg(_class_of(F.col("tag")).alias("class"))
    endings = materialize(endings, "ending-classes")
    emitted = words.select("class", F.inline("tags")).groupBy("class", "tag").agg(F.sum("uses").alias("n"))
    words = words.drop("tags")
    emit = {(r["class"], r["tag"]): r["n"] for r in emitted.collect()}  # sets of tags
    more = {r["class"] for r in endings.select("class").distinct().collect()}
    names = sorted({tag for _, tag in follow})
    classes = sorted({c for c, _ in emit} | more | {ANY})

    def logarithms(counts: dict, rows: list[str], by_row: bool) -> list[list[int]]:
        """Per row and tag; a row's counts, or a tag's, are its whole."""
        total: dict[str, int] = {}
        for (row, tag), n in counts.items():
            whole = row if by_row else tag
            total[whole] = total.get(whole, 0) + n
        kinds = len(names) if by_row else len(rows)
        cells = [(counts.get((row, tag), 0), total.get(row if by_row else tag, 0), kinds) for row in rows for tag in names]
        if not cells:
            return [[] for _ in rows]
        found = tagged.sparkSession.createDataFrame(cells, "n bigint, total bigint, kinds bigint").coalesce(1)
        logs = [r[0] for r in found.select(_logarithm(F.col("n"), F.col("total"), F.col("kinds"))).collect()]
        return [logs[k:k + len(names)] for k in range(0, len(logs), len(names))]

    return Tagger(names, classes, logarithms(follow, [*names, START], True), logarithms(emit, classes, False), words, endings)


def viterbi(numbers: np.ndarray, starts: np.ndarray, tagger: Tagger) -> np.ndarray:
    """The places of the likeliest tags of sentences, from the numbers of their words' classes; of equal ones the first by tag, from its end.

    A sentence has the numbers from its start to the next one; the last start is the end of all. All sentences go on by one word at a time,
    the longest first: forward with the best sum per tag and where each came from, and back along these.
    """
    own = np.array(tagger.emissions, np.int64)[numbers]
    into = np.array(tagger.transitions[:-1], np.int64).T  # into[k][j]
    sizes = np.diff(starts)
    order = np.argsort(-sizes, kind="stable")
    first, sizes = starts[:-1][order], sizes[order]
    longest = int(sizes[0]) if len(sizes) else 0
    still = np.searchsorted(-sizes, -np.arange(longest), side="left")  # sentences with more than so many words
    before = np.zeros((len(numbers), len(tagger.tags)), np.int32)
    sums = np.array(tagger.transitions[-1], np.int64) + own[first[: still[0]]] if longest else None
    last = np.zeros(len(first), np.int32)
    for at in range(1, longest):
        n = still[at]
        last[n : len(sums)] = sums[n:].argmax(axis=1)
        through = sums[:n, None, :] + into
        came = through.argmax(axis=2)
        places = first[:n] + at
        before[places] = came
        sums = np.take_along_axis(through, came[:, :, None], axis=2)[:, :, 0] + own[places]
    if longest:
        last[: len(sums)] = sums.argmax(axis=1)
    found = np.zeros(len(numbers), np.int32)
    for at in range(longest - 1, -1, -1):
        places = first[: still[at]] + at
        found[places] = last[: still[at]]
        last[: still[at]] = before[places, last[: still[at]]]
    return found


def _in_parts(numbers: np.ndarray, starts: np.ndarray, tagger: Tagger) -> np.ndarray:
    """As viterbi, but a part of the sentences at a time, so what it holds is bounded by `TOGETHER` words or the longest sentence."""
    cuts = np.unique(np.append(np.searchsorted(starts, np.arange(0, starts[-1], TOGETHER)), len(starts) - 1))
    parts = [viterbi(numbers[starts[a] : starts[b]], starts[a : b + 1] - starts[a], tagger) for a, b in zip(cuts, cuts[1:])]
    return np.concatenate([np.zeros(0, np.int32), *parts])


def _tag_sentences(tagger: Tagger, words: list, endings: list, documents: bool = False) -> Callable:
    """A function of batches: tokens and the (place, number) of the classes that a join has found, to tags.

    For rows that are documents: their sentences' tokens, and their words beyond `words`, an array of (term, number, lemmas).
    """
    number = {c: k for k, c in enumerate(tagger.classes)}
    any_tag, tags = number[ANY], tagger.tags
    tables = [
        ([r["term"] for r in table], np.array([number[r["class"]] for r in table] + [any_tag], np.int64)) for table in (words, endings)
    ]
    model = Tagger(tags, tagger.classes, tagger.transitions, tagger.emissions, None, None)

    def classes(terms: pa.Array, table: tuple) -> tuple[np.ndarray, np.ndarray]:
        known, numbers = table
        at = pc.index_in(terms, value_set=pa.array(known, terms.type)).fill_null(len(known)).to_numpy(zero_copy_only=False)
        return numbers[at], at < len(known)

    def run(tokens: pa.Array, joined: pa.Array) -> pa.Array:
        sizes = pc.list_value_length(tokens).fill_null(0).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        terms = tokens.flatten()
        numbers, found = classes(terms, tables[0])
        rare = joined.flatten()
        if len(rare):
            rows = pc.list_parent_indices(joined).to_numpy(zero_copy_only=False)
            places = starts[rows] + rare.field("_at").to_numpy(zero_copy_only=False)
            numbers[places], found[places] = rare.field("number").to_numpy(zero_copy_only=False), True
        left = np.flatnonzero(~found)
        numbers[left] = classes(pc.utf8_slice_codeunits(terms.take(pa.array(left)), start=-ENDING), tables[1])[0]
        named = pa.array(tags, pa.string()).take(pa.array(viterbi(numbers, starts, model)))
        offsets = pa.array(starts.astype(np.int32), mask=np.append(pc.is_null(tokens).to_numpy(zero_copy_only=False), False))
        return pa.ListArray.from_arrays(offsets, named)

    def run_documents(tokens: pa.Array, known: pa.Array) -> pa.Array:
        sentences = tokens.flatten()
        terms = sentences.flatten()
        starts = np.concatenate([[0], np.cumsum(pc.list_value_length(sentences).to_numpy(zero_copy_only=False))]).astype(np.int64)
        numbers, found = classes(terms, tables[0])
        rare = known.flatten()
        rare = dict(zip(rare.field("term").to_pylist(), rare.field("number").to_pylist()))
        rare = {term: n for term, n in rare.items() if n is not None}
        for table in ((list(rare), np.array([*rare.values(), any_tag], np.int64)), tables[1]):
            left = np.flatnonzero(~found)
            own = terms.take(pa.array(left))
            numbers[left], found[left] = classes(pc.utf8_slice_codeunits(own, start=-ENDING) if table is tables[1] else own, table)
        named = pa.array(tags, pa.string()).take(pa.array(_in_parts(numbers, starts, model)))
        return _as_nested(named, tokens, starts)

    return run_documents if documents else run


def _as_nested(values: pa.Array, like: pa.Array, starts: np.ndarray) -> pa.Array:
    """A value per word as an array per sentence, which begin at `starts`, and an array of these per row of `like`."""
    inner = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), values)
    sizes = np.concatenate([[0], np.cumsum(pc.list_value_length(like).fill_null(0).to_numpy(zero_copy_only=False))])
    offsets = pa.array(sizes.astype(np.int32), mask=np.append(pc.is_null(like).to_numpy(zero_copy_only=False), False))
    return pa.ListArray.from_arrays(offsets, inner)


def with_tags(df: DataFrame, tokens: str, tagger: Tagger, name: str = "tags", in_row: int = IN_ROW_LEMMAS) -> DataFrame:
    """`df` with the tags of each row's tokens in their context; a row is a sentence.

    A word unknown to the tagger has the class of its ending, or any tag. A null or empty array stays as it is; a null token may have any tag.
    The `in_row` most frequent words are looked up with the batch; only tokens beyond them are joined, and come back to their row by its number.
    """
    if not tagger.tags:
        return df.withColumn(name, F.transform(tokens, lambda w: F.lit(None).cast("string")))
    ship_package(df.sparkSession)
    frequent = _frequent(tagger, in_row)
    words, endings = frequent.collect(), tagger.endings.collect()  # `in_row` words; endings of three letters
    tag = F.arrow_udf(_tag_sentences(tagger, words, endings), "array<string>")
    none = F.array().cast("array<struct<_at:int,number:int>>")
    if tagger.words.count() <= len(words):
        return df.withColumn(name, tag(tokens, none))
    rare = tagger.words.join(F.broadcast(frequent.select("term")), "term", "left_anti")
    rare = materialize(rare.select("term", F.element_at(_numbers(tagger), F.col("class")).alias("number")), "rare-words")
    numbered = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    facts = numbered.select("_row", F.posexplode(tokens).alias("_at", "term")).filter(F.col("term").isNotNull())
    facts = facts.join(F.broadcast(frequent.select("term")), "term", "left_anti")
    found = lookup_join(facts, rare, "term", "inner").groupBy("_row").agg(F.collect_list(F.struct("_at", "number")).alias("_rare"))
    return (
        numbered.join(found, "_row", "left").withColumn(name, tag(tokens, F.coalesce("_rare", none))).drop("_row", "_rare")
    )


def _frequent(tagger: Tagger, in_row: int) -> DataFrame:
    """(term, class) of the `in_row` most frequent words."""
    first = top_k(tagger.words, in_row, F.col("n"), [F.desc("n"), F.col("term")])
    return materialize(first.select("term", "class"), "frequent-words")


def _numbers(tagger: Tagger) -> Column:
    """The number of each class."""
    return F.map_from_arrays(F.array(*map(F.lit, tagger.classes)), F.array(*map(F.lit, range(len(tagger.classes)))))


def pos_of(tag: Column) -> Column:
    """The part of speech of a tag by its first letter: J adjective, V verb, R adverb, anything else noun."""
    initial = F.substring(tag, 1, 1)
    return F.when(initial == "J", "a").when(initial == "V", "v").when(initial == "R", "r").otherwise("n")


def lemmatize_in_context(
    df: DataFrame, tokens: str, tags: str, lexicon: DataFrame, exceptions: DataFrame, name: str = "lemmatized",
    in_row: int = IN_ROW_LEMMAS,
) -> DataFrame:
    """`df` with the lemma of each token by the tag that it has there; one word can have several lemmas."""
    keyed = F.zip_with(tokens, tags, lambda w, tag: F.concat(pos_of(tag), F.lit(":"), w))
    rows = materialize(df.withColumn("_keyed", keyed), "tagged-tokens")
    terms = rows.select(F.explode("_keyed").alias("key")).distinct()
    terms = materialize(
        terms.select(F.substring("key", 1, 1).alias("pos"), F.substr("key", F.lit(3)).alias("term")), "tagged-terms"
    )
    changed = None
    for pos in "nvar":
        own = changed_lemmas(terms.filter(F.col("pos") == pos).select("term"), lexicon, exceptions, pos)
        own = own.select(F.concat(F.lit(f"{pos}:"), "term").alias("term"), F.concat(F.lit(f"{pos}:"), "lemma").alias("lemma"))
        changed = own if changed is None else changed.unionByName(own)
    found = with_lemmas(rows, "_keyed", materialize(changed, "context-lemmas"), "_found", in_row)
    return found.withColumn(name, F.transform("_found", lambda w: F.substr(w, F.lit(3)))).drop("_keyed", "_found")


def lemmas_by_pos(words: DataFrame, lexicon: DataFrame, exceptions: DataFrame) -> DataFrame:
    """(term, lemmas) of the words, column `term`, that have another lemma as some part of speech: `pos:lemma` for each of these, written.

    Only words that a rule's ending or an exception could change are shuffled.
    """
    forms = materialize(exceptions.select(F.col("form").alias("term"), F.lit(True).alias("_irregular")).distinct(), "exception-forms")
    forms = F.broadcast(forms) if measured_bytes(forms) <= BROADCAST_BYTES else forms
    endings = "|".join(rule_ending(pos) for pos in "nvar" if SUFFIX_RULES[pos])
    needed = words.join(forms, "term", "left").filter(F.col("_irregular").isNotNull() | F.col("term").rlike(endings))
    terms = materialize(needed.select("term").distinct(), "context-terms")
    changed = None
    for pos in "nvar":
        own = changed_lemmas(terms, lexicon, exceptions, pos).select("term", F.concat(F.lit(f"{pos}:"), "lemma").alias("lemma"))
        changed = own if changed is None else changed.unionByName(own)
    return materialize(changed.groupBy("term").agg(F.collect_list("lemma").alias("lemmas")), "context-lemmas")


def lemmatize_documents(
    df: DataFrame, key: str, text: str, sentences: Callable[[Column], Column], tagger: Tagger, lexicon: DataFrame,
    exceptions: DataFrame, in_row: int = IN_ROW_LEMMAS,
) -> DataFrame:
    """(key, at, tokens, tags, lemmatized): a row per document with arrays of its sentences, each with its number in its text.

    `sentences` gives the tokens of each sentence of a text; those without tokens are left out. Tags and lemmas are those of `with_tags` and
    `lemmatize_in_context` on a row per sentence, but only texts are shuffled, once, and no sentence is written. What is looked up for
    a word (its class, its lemma as each part of speech) does not depend on its place: the `in_row` most frequent words are looked up with the
    batch, the others are joined with the distinct words of each key. The texts of rows that share a key are one document; a null key is one, a null text has no sentence.
    """
    ship_package(df.sparkSession)
    keyed = df.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key"), key, F.col(text).alias("_text"))
    words = F.flatten(sentences(F.col("_text")))
    changed = lemmas_by_pos(keyed.select(F.explode(words).alias("term")), lexicon, exceptions)
    frequent = _frequent(tagger, in_row)
    near = F.broadcast(frequent.select("term"))
    common = changed.join(near, "term", "left_semi").collect()  # `in_row` words at most
    number = F.element_at(_numbers(tagger), F.col("class")) if tagger.classes else F.lit(None)
    classes = tagger.words.join(near, "term", "left_anti").select("term", number.cast("int").alias("number"), "n")
    rare = classes.join(changed.join(near, "term", "left_anti"), "term", "full").select("term", "number", "lemmas", "n")
    rare = materialize(rare, "rare-words")
    whole = keyed.groupBy("_key").agg(F.first(key).alias(key), F.collect_list("_text").alias("_texts"))
    none = F.array().cast(WORDS)
    if rare.isEmpty():
        whole = whole.withColumn("_words", none)
    else:
        facts = keyed.select("_key", F.explode(F.array_distinct(words)).alias("term")).join(near, "term", "left_anti")
        found = lookup_join(facts, rare.drop("n"), "term", "inner", counts=rare.filter(F.col("n").isNotNull()).select("term", "n"))
        found = found.groupBy("_key").agg(F.collect_list(F.struct("term", "number", "lemmas")).alias("_words"))
        whole = whole.join(found.hint("merge"), "_key", "left").withColumn("_words", F.coalesce("_words", none))
    parts = F.transform("_texts", lambda t: F.transform(sentences(t), lambda w, i: F.struct(i.alias("at"), w.alias("tokens"))))
    cut = whole.select(key, "_words", F.filter(F.flatten(parts), lambda p: F.size(p["tokens"]) > 0).alias("_parts"))
    cut = cut.select(key, "_words", F.col("_parts.at").alias("at"), F.col("_parts.tokens").alias("tokens"))
    if tagger.tags:
        frequent, endings = frequent.collect(), tagger.endings.collect()  # `in_row` words; endings of three letters
        tag = F.arrow_udf(_tag_sentences(tagger, frequent, endings, True), "array<array<string>>")
        tagged = cut.withColumn("tags", tag("tokens", "_words"))
    else:
        unknown = F.transform("tokens", lambda sentence: F.transform(sentence, lambda w: F.lit(None).cast("string")))
        tagged = cut.withColumn("tags", unknown)
    lemma = F.arrow_udf(_lemmas_of(common), "array<array<string>>")
    return tagged.withColumn("lemmatized", lemma("tokens", "tags", "_words")).drop("_words")


def _lemmas_of(words: list) -> Callable:
    """A function of batches of documents: tokens, tags and their rarer words, to lemmas. `words` has (term, lemmas) known to all."""
    ours = {f"{lemma[:2]}{r['term']}": lemma[2:] for r in words for lemma in r["lemmas"]}
    common = pa.array(list(ours), pa.string()), pa.array(list(ours.values()), pa.string())

    def looked_up(keys: pa.Array, known: pa.Array, lemmas: pa.Array) -> pa.Array:
        return lemmas.take(pc.index_in(keys, value_set=known))

    def run(tokens: pa.Array, tags: pa.Array, known: pa.Array) -> pa.Array:
        sentences = tokens.flatten()
        terms, said = sentences.flatten(), tags.flatten().flatten()
        starts = np.concatenate([[0], np.cumsum(pc.list_value_length(sentences).to_numpy(zero_copy_only=False))]).astype(np.int64)
        initial = pc.utf8_slice_codeunits(said.fill_null(""), start=0, stop=1)
        letters = pc.index_in(initial, value_set=pa.array(["J", "V", "R"])).fill_null(3)
        keys = pc.binary_join_element_wise(pa.array(["a", "v", "r", "n"]).take(letters), terms, ":")
        rare = known.flatten()
        own = {
            f"{lemma[:2]}{term}": lemma[2:]
            for term, lemmas in zip(rare.field("term").to_pylist(), rare.field("lemmas").to_pylist()) for lemma in lemmas or ()
        }
        mine = looked_up(keys, pa.array(list(own), pa.string()), pa.array(list(own.values()), pa.string()))
        return _as_nested(pc.coalesce(mine, looked_up(keys, *common), terms), tokens, starts)

    return run
