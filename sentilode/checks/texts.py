"""Cleaning, tokens and lemmas."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sentilode.checks import sql as S
from sentilode.checks.registry import query
from sentilode.checks.tables import (
    LEXICON_COUNT, corpus_lexicon, decorated, document_terms, documents,
)
from sentilode.functions import patterns as P, text as tx
from sentilode.functions.arrays import ngrams
from sentilode.operators import lemma, sampling
from sentilode.operators.features import term_stats, with_counts
from sentilode.plans.denoise import denoise
from sentilode.session import materialize

DECORATED = f"decorated AS (SELECT doc_id, {S.DECORATED} AS text FROM documents)"


def _of_decorated(name: str, expression, sql: str) -> None:
    """Register a text expression over the decorated documents."""

    @query(name, f"WITH {DECORATED} SELECT doc_id, {sql} AS out FROM decorated")
    def run(spark, sf_dir):
        return decorated(spark, sf_dir).select("doc_id", expression(F.col("text")).alias("out"))


def _joined(tokens: Column) -> Column:
    return F.array_join(tokens, "|")


def _sql_joined(tokens: str) -> str:
    return f"array_to_string({tokens}, '|')"


_of_decorated("strip_emoji", tx.strip_symbols, S.replace_all("text", P.SYMBOLS))
_of_decorated("strip_url", tx.strip_links, S.replace_all("text", P.LINK))
_of_decorated("strip_mention", tx.strip_mentions, S.replace_all("text", P.MENTION))
_of_decorated("clean_text", tx.clean, S.clean("text"))
_of_decorated("expand_contractions_words", tx.expand_contractions_words, S.expand_words("text"))
_of_decorated("expand_contractions_text", tx.expand_contractions_text, S.expand_text("text"))
_of_decorated("tokenize", lambda t: _joined(tx.tokenize(t)), _sql_joined(S.tokenize("text")))
_of_decorated(
    "word_tokenize", lambda t: _joined(tx.word_tokenize(t)), _sql_joined(S.word_tokenize("text"))
)
_of_decorated(
    "treebank_tokens", lambda t: _joined(tx.treebank_tokens(t)), _sql_joined(S.treebank_tokens("text"))
)
_of_decorated(
    "lower_tokens",
    lambda t: _joined(tx.lower_tokens(tx.word_tokenize(t))),
    _sql_joined(f"list_transform({S.word_tokenize('text')}, lambda w: lower(w))"),
)
_of_decorated(
    "keep_alpha",
    lambda t: _joined(tx.keep_alphabetic(tx.word_tokenize(t))),
    _sql_joined(
        f"list_filter({S.word_tokenize('text')}, lambda w: regexp_matches(w, {S.quoted(P.ALPHABETIC)}))"
    ),
)
_of_decorated(
    "remove_stopwords_exact",
    lambda t: _joined(tx.remove_stopwords_exact(tx.word_tokenize(t))),
    _sql_joined(f"list_filter({S.word_tokenize('text')}, lambda w: w NOT IN {S.stop_list()})"),
)
_of_decorated(
    "remove_stopwords",
    lambda t: _joined(tx.remove_stopwords(tx.word_tokenize(t))),
    _sql_joined(f"list_filter({S.word_tokenize('text')}, lambda w: lower(w) NOT IN {S.stop_list()})"),
)
_of_decorated(
    "drop_empty_tokens",
    lambda t: _joined(tx.drop_empty(tx.tokenize(t))),
    _sql_joined(f"list_filter({S.tokenize('text')}, lambda w: length(w) > 0)"),
)
_of_decorated(
    "ngrams",
    lambda t: _joined(ngrams(tx.model_tokens(t), 2)),
    _sql_joined(
        f"(SELECT list_transform(range(1, len(k)), lambda i: k[i] || ' ' || k[i + 1]) "
        f"FROM (SELECT {S.model_tokens('text')} AS k))"
    ),
)

# Lemmas: the lexicon is the words that the documents use often.
TERMS = f"{S.pairs(S.model_tokens('text'), 'documents')}"
LEXICON = (
    f"common AS (SELECT term FROM pairs GROUP BY term HAVING sum(tf) >= {LEXICON_COUNT}), "
    "lexicon AS (SELECT pos, term AS lemma FROM common, (VALUES ('n'), ('v'), ('a'), ('r')) p(pos))"
)
NOUNS = "nouns AS (SELECT DISTINCT term, 'n' AS pos FROM pairs)"
TAG = (
    "CASE WHEN term LIKE '%ly' THEN 'RB' WHEN term LIKE '%ing' OR term LIKE '%ed' THEN 'VB' "
    "WHEN term LIKE '%er' OR term LIKE '%est' THEN 'JJ' ELSE 'NN' END"
)
POS_OF_TAG = "CASE substr(tag, 1, 1) WHEN 'J' THEN 'a' WHEN 'V' THEN 'v' WHEN 'R' THEN 'r' ELSE 'n' END"


def _tags(terms):
    """(token, tag) of each term by its ending."""
    return terms.select(F.col("term").alias("token"), F.expr(TAG).alias("tag"))


@query(
    "lemmatize_noun",
    f"WITH RECURSIVE {TERMS}, {LEXICON}, {NOUNS}, {S.lemma_ctes('nouns', 'lexicon')} "
    "SELECT term, lemma FROM lemma_of",
)
def lemmatize_noun(spark, sf_dir):
    """The lemma of every term of the documents."""
    stats = document_terms(spark, sf_dir)
    changed = lemma.changed_lemmas(
        stats, corpus_lexicon(spark, stats), lemma.irregular_table(spark), "n"
    )
    return stats.join(changed, "term", "left").select("term", F.coalesce("lemma", "term").alias("lemma"))


@query(
    "lemmatize_pos",
    f"WITH RECURSIVE {TERMS}, {LEXICON}, tags AS (SELECT DISTINCT term, {TAG} AS tag FROM pairs), "
    f"tagged AS (SELECT term, {POS_OF_TAG} AS pos FROM tags), {S.lemma_ctes('tagged', 'lexicon')} "
    "SELECT term, tag, lemma FROM lemma_of JOIN tags USING (term)",
)
def lemmatize_pos(spark, sf_dir):
    stats = document_terms(spark, sf_dir)
    changed = lemma.tagged_changes(
        stats, _tags(stats), corpus_lexicon(spark, stats), lemma.irregular_table(spark)
    )
    return stats.select("term", F.expr(TAG).alias("tag")).join(changed, "term", "left").select(
        "term", "tag", F.coalesce("lemma", "term").alias("lemma")
    )


JOINED_LEMMAS = (
    "SELECT d.doc_id, coalesce(string_agg(coalesce(l.lemma, u.term), ' ' ORDER BY u.at), '') AS {name} "
    "FROM {docs} d LEFT JOIN (SELECT doc_id, unnest(toks) AS term, generate_subscripts(toks, 1) AS at FROM {toks}) u "
    "USING (doc_id) LEFT JOIN lemma_of l ON l.term = u.term GROUP BY d.doc_id"
)


@query(
    "token_chain",
    f"WITH RECURSIVE {TERMS}, {LEXICON}, {NOUNS}, {S.lemma_ctes('nouns', 'lexicon')} "
    + JOINED_LEMMAS.format(name="lemmatized", docs="documents", toks="toks"),
)
def token_chain(spark, sf_dir):
    """Clean, tokens, stop words, lemmas: the whole text of every document."""
    docs = documents(spark, sf_dir).select("doc_id", tx.model_tokens(F.col("text")).alias("tokens"))
    docs = materialize(docs, "chain-tokens")
    stats = materialize(term_stats(with_counts(docs, F.col("tokens"))), "document-terms")
    changed = materialize(
        lemma.changed_lemmas(stats, corpus_lexicon(spark, stats), lemma.irregular_table(spark), "n"),
        "noun-lemmas",
    )
    return lemma.lemmatize_tokens(docs, ["doc_id"], "tokens", changed).select(
        "doc_id", F.array_join("lemmatized", " ").alias("lemmatized")
    )


@query(
    "denoise",
    f"WITH RECURSIVE {DECORATED}, {TERMS}, {LEXICON}, "
    f"words AS (SELECT doc_id, {S.denoise_tokens('text')} AS toks FROM decorated), "
    "word AS (SELECT DISTINCT unnest(toks) AS term FROM words), "
    f"tags AS (SELECT DISTINCT term, {TAG} AS tag FROM pairs), "
    f"tagged AS (SELECT term, {POS_OF_TAG} AS pos FROM word LEFT JOIN tags USING (term)), "
    f"{S.lemma_ctes('tagged', 'lexicon')} "
    + JOINED_LEMMAS.format(name="denoised", docs="documents", toks="words"),
)
def denoise_documents(spark, sf_dir):
    stats = document_terms(spark, sf_dir)
    return denoise(
        decorated(spark, sf_dir), "doc_id", "text",
        _tags(stats), corpus_lexicon(spark, stats), lemma.irregular_table(spark),
    )


ONE = "one AS (SELECT doc_id, text FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id LIMIT 1)"


@query(
    "inspect_one",
    f"WITH RECURSIVE {TERMS}, {LEXICON}, {NOUNS}, {S.lemma_ctes('nouns', 'lexicon')}, {ONE}, "
    f"lemmas AS ({JOINED_LEMMAS.format(name='lemmatized', docs='one', toks='toks')}) "
    f"SELECT doc_id, {S.clean('text')} AS tweet, {_sql_joined(S.tokenize(S.clean('text')))} AS words, "
    f"{_sql_joined(S.model_tokens('text'))} AS filtered, lemmatized FROM one JOIN lemmas USING (doc_id)",
)
def inspect_one(spark, sf_dir):
    """One row through all the stages."""
    tweet = tx.clean(F.col("text"))
    one = sampling.sample_n(documents(spark, sf_dir), 1, "doc_id").select(
        "doc_id",
        tweet.alias("tweet"),
        tx.tokenize(tweet).alias("words"),
        tx.model_tokens(F.col("text")).alias("filtered"),
    )
    one = materialize(one, "one")
    words = one.select(F.explode("filtered").alias("term")).distinct()
    lexicon = corpus_lexicon(spark, document_terms(spark, sf_dir))
    changed = materialize(
        lemma.changed_lemmas(words, lexicon, lemma.irregular_table(spark), "n"), "noun-lemmas"
    )
    lemmas = lemma.lemmatize_tokens(one, ["doc_id", "tweet", "words", "filtered"], "filtered", changed)
    return lemmas.select(
        "doc_id", "tweet", _joined(F.col("words")).alias("words"),
        _joined(F.col("filtered")).alias("filtered"),
        F.array_join("lemmatized", " ").alias("lemmatized"),
    )
