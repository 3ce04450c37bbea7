"""Array helpers."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row, also inside nested lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def count_terms(tokens: Column) -> Column:
    """array<struct<term, tf>> of one row's tokens, in term order.

    A document is one row, so its counts need no shuffle: sort the tokens and
    take the length of each run. A null token is no term; nulls are sorted before the first run.
    """

    def runs(words: Column) -> Column:
        starts = F.filter(
            F.transform(words, lambda w, i: F.when(w.isNotNull() & ((i == 0) | ~w.eqNullSafe(F.get(words, i - 1))), i)),
            lambda p: p.isNotNull(),
        )
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda p, j: F.struct(
                    F.get(words, p).alias("term"),
                    (F.coalesce(F.get(at, j + 1), F.size(words)) - p).cast("bigint").alias("tf"),
                ),
            ),
        )

    return let(F.sort_array(tokens), runs)


def ngrams(tokens: Column, n: int) -> Column:
    """Runs of `n` tokens joined by a space; no run gives an empty array."""
    if n == 1:
        return tokens
    return let(
        tokens,
        lambda words: F.filter(
            F.transform(
                words,
                lambda _, i: F.when(
                    i + n <= F.size(words), F.array_join(F.slice(words, i + 1, n), " ")
                ),
            ),
            lambda g: g.isNotNull(),
        ),
    )


def _groups(words: list[str]) -> tuple[list[list[str]], Callable[[Column], Column]]:
    """Short lists of words, and the number of the list that a word would be in."""
    count = max(1, len(words) // 16)
    groups: list[list[str]] = [[] for _ in range(count)]
    for word in words:
        groups[zlib.crc32(word.encode()) % count].append(word)
    return groups, lambda word: (F.crc32(word.cast("binary")) % count).cast("int")


def _literal(groups: Iterable[list[str]]) -> Column:
    """array<array<string>> as one literal; the words must not contain a space."""

    def cell(group: list[str]) -> str:
        if not group:
            return "cast(array() AS array<string>)"
        text = " ".join(group).replace("\\", "\\\\").replace("'", "\\'")
        return f"split('{text}', ' ')"

    return F.expr("array(" + ", ".join(map(cell, groups)) + ")")


def word_set(words: Iterable[str]) -> Callable[[Column], Column]:
    """A test for membership in a list of words, for use inside lambdas.

    The list becomes one literal: short arrays, of which the checksum of the
    word picks one. That stays quick for lists on which isin() takes seconds
    to build.
    """
    groups, group_of = _groups(sorted({w for w in words if w and " " not in w}))
    table = _literal(groups)
    return lambda word: F.array_contains(F.get(table, group_of(word)), word)


def word_map(texts: dict[str, str]) -> Callable[[Column], Column]:
    """The text listed for a word, or null; the same way as word_set."""
    groups, group_of = _groups(sorted(texts))
    keys, values = _literal(groups), _literal([[texts[w] for w in g] for g in groups])

    def find(word: Column) -> Column:
        at = F.array_position(F.get(keys, group_of(word)), word).cast("int") - 1
        return F.get(F.get(values, group_of(word)), at)

    return find
