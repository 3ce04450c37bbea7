"""The single-machine path's text cleaning as one job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from sentilode.functions import text as tx
from sentilode.operators.lemma import lemmatize_tokens, tagged_changes
from sentilode.session import materialize


def denoise_tokens(text: Column, stopwords: Iterable[str] | None = None) -> Column:
    """Contractions, words, lower case, alphabetic words only, no stop words."""
    words = tx.lower_tokens(tx.word_tokenize(tx.expand_contractions_text(text)))
    return tx.remove_stopwords_exact(tx.keep_alphabetic(words), stopwords)


def denoise(
    docs: DataFrame,
    key: str,
    text: str,
    tags: DataFrame,
    lexicon: DataFrame,
    exceptions: DataFrame,
) -> DataFrame:
    """(key, denoised): the lemmas by part of speech, joined with a space."""
    words = materialize(docs.select(key, denoise_tokens(F.col(text)).alias("words")), "denoise-words")
    terms = words.select(F.explode("words").alias("term")).distinct()
    changed = materialize(tagged_changes(terms, tags, lexicon, exceptions), "denoise-lemmas")
    return lemmatize_tokens(words, [key], "words", changed).select(
        key, F.array_join("lemmatized", " ").alias("denoised")
    )
