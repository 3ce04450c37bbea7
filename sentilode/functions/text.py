"""Cleaning and tokenising as Column expressions; null in, null out."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, functions as F

from sentilode.functions import patterns as P
from sentilode.functions.arrays import let


def strip_symbols(text: Column) -> Column:
    """Drop emoji, symbols, and the ASCII range # to 9 (apostrophe, comma, digits, ...)."""
    return F.regexp_replace(text, P.SYMBOL_RUN, "")


def _without(text: Column, pattern: str, *needed: str) -> Column:
    """`text` without the matches of a pattern; a text that holds none of the `needed` strings has no match and is left as it is."""
    holds = lambda t: reduce(lambda a, b: a | b, [t.contains(n) for n in needed])
    return let(text, lambda t: F.when(holds(t), F.regexp_replace(t, pattern, "")).otherwise(t))


def strip_links(text: Column) -> Column:
    return _without(text, P.LINK, "http", "www")


def strip_mentions(text: Column) -> Column:
    return _without(text, P.MENTION, "@")


def clean(text: Column) -> Column:
    """Symbols, then links, then mentions: links are looked for after dots and slashes went."""
    return strip_mentions(strip_links(strip_symbols(text)))


def _expand(word: Column, table: dict[str, str]) -> Column:
    forms = list(table)
    texts = F.map_from_arrays(
        F.array(*map(F.lit, forms)), F.array(*[F.lit(table[f]) for f in forms])
    )

    def cased(full: Column) -> Column:
        first = F.substring(word, 1, 1)
        upper = F.concat(F.upper(F.substring(full, 1, 1)), F.substr(full, F.lit(2)))
        return F.when(first != F.lower(first), upper).otherwise(full)

    return F.when(F.lower(word).isin(forms), cased(F.element_at(texts, F.lower(word)))).otherwise(
        word
    )


def expand_contractions_words(text: Column, table: dict[str, str] | None = None) -> Column:
    """Expand word by word; runs of white space become one space."""
    table = table or P.contraction_table()
    words = F.filter(F.split(text, f"[{P.SPACE}]+"), lambda w: F.length(w) > 0)
    return F.array_join(F.transform(words, lambda w: _expand(w, table)), " ")


def expand_contractions_text(text: Column, table: dict[str, str] | None = None) -> Column:
    """Expand inside the running text; spacing and punctuation stay."""
    table = table or P.contraction_table()
    runs = F.regexp_extract_all(text, F.lit(P.CONTRACTION_RUN), F.lit(1))
    return F.array_join(F.transform(runs, lambda w: _expand(w, table)), "")


def tokenize(text: Column) -> Column:
    """Lower-case and split on each white-space character; trailing empty tokens are dropped.

    Gives what the ML Tokenizer gives: leading and inner empty tokens stay.
    """
    return let(
        F.lower(text),
        lambda t: let(
            F.rtrim(t, F.lit(P.TOKEN_SPACE_CHARS)),
            lambda r: F.when(
                (F.length(r) == 0) & (F.length(t) > 0), F.array().cast("array<string>")
            ).otherwise(F.split(r, P.TOKEN_SPACE)),
        ),
    )


def word_tokenize(text: Column) -> Column:
    """Words, and each punctuation mark as a token of its own."""
    return F.regexp_extract_all(text, F.lit(P.WORD_OR_MARK), F.lit(1))


def treebank_tokens(text: Column) -> Column:
    """Words as the Penn Treebank has them: `do n't`, `they 'll`, a sentence's last period and each mark apart, quotes as `` and ''.

    A sentence ends at a mark before a capital letter, unless an abbreviation stands there, and at the text's end.
    """
    text = F.concat(F.lit(" "), F.regexp_replace(text, f"[{P.SPACE}]+", " "), F.lit(" "))
    for pattern, new in P.TREEBANK_RULES:
        text = F.regexp_replace(text, pattern, re.sub(r"\\(\d)", r"$\1", new))
    return F.filter(F.split(text, "[ \n]+"), lambda w: F.length(w) > 0)


def lower_tokens(tokens: Column) -> Column:
    return F.transform(tokens, lambda w: F.lower(w))


def keep_alphabetic(tokens: Column) -> Column:
    return F.filter(tokens, lambda w: w.rlike(P.ALPHABETIC))


def drop_empty(tokens: Column) -> Column:
    return F.filter(tokens, lambda w: F.length(w) > 0)


def remove_stopwords_exact(tokens: Column, words: Iterable[str] | None = None) -> Column:
    listed = list(words) if words is not None else P.ENGLISH_STOPWORDS
    return F.filter(tokens, lambda w: ~w.isin(listed))


def remove_stopwords(tokens: Column, words: Iterable[str] | None = None) -> Column:
    """Without regard to case."""
    listed = [w.lower() for w in (words if words is not None else P.ENGLISH_STOPWORDS)]
    return F.filter(tokens, lambda w: ~F.lower(w).isin(listed))


def model_tokens(text: Column) -> Column:
    """The tokens a model counts: clean, split, without stop words and empty tokens.

    One pass over the array: the tokens are lower-case already.
    """
    stop = P.ENGLISH_STOPWORDS
    words = F.split(F.lower(clean(text)), P.TOKEN_SPACE)
    return F.filter(words, lambda w: (F.length(w) > 0) & ~w.isin(stop))


def vector_words(text: Column) -> Column:
    """Lower-case runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(P.VECTOR_WORD), F.lit(1))
