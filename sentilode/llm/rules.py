"""Quality rules as a short-circuit cascade, in column expressions only.

Each rule is a condition that rejects a text. On a sample, the time a rule takes and the part it
rejects are measured; rules with the most rejections per second come first, and a CASE expression
stops at the first rule that rejects.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sentilode.llm.common import spread_texts, words
from sentilode.session import materialize

# Fixed value: characters that count as symbols.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
# Rows of the sample on which costs and rejections are measured.
SAMPLE_ROWS = 2_000


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0).cast("bigint"), lambda a, x: a + x)


def word_chars(text: Column) -> Column:
    """Code points in words."""
    return F.length(F.translate(text, SPACES, "")).cast("bigint")


def n_symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint")


def n_repeat_words(tokens: Column) -> Column:
    """Words in 3-word windows found twice or more in the text.

    Windows are sorted with their places; the places of equal neighbours, sorted again, cover up to
    three words each, up to the next such place. So the work is n log n. A text whose windows
    are all distinct, the usual case, ends after one hash set.
    """
    n = F.size(tokens)
    grams = F.when(
        n >= 4,
        F.zip_with(
            F.slice(tokens, F.lit(1), n - 2),
            F.zip_with(
                F.slice(tokens, F.lit(2), n - 2),
                F.slice(tokens, F.lit(3), n - 2),
                lambda b, c: F.concat(b, F.lit(" "), c),
            ),
            lambda a, b: F.concat(a, F.lit(" "), b),
        ),
    )

    def covered(grams: Column) -> Column:
        placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def places(rows: Column) -> Column:
            same = F.filter(
                rows,
                lambda r, i: (r["g"] == F.get(rows, i + 1)["g"]) | (r["g"] == F.get(rows, i - 1)["g"]),
            )
            return F.sort_array(F.transform(same, lambda r: r["i"]))

        def total(at: Column) -> Column:
            return _sum(
                F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3))).cast("bigint"))
            )

        return _bound(_bound(placed, places), total)

    def count(grams: Column) -> Column:
        return F.when(F.size(F.array_distinct(grams)) < F.size(grams), covered(grams)).otherwise(F.lit(0).cast("bigint"))

    return F.coalesce(_bound(grams, count), F.lit(0).cast("bigint"))


def _bound(value: Column, body) -> Column:
    """`body` of a value that is computed once per row: a lambda over an array of one element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def measures(rows: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words to (doc_id, text)."""
    text = F.col("text")
    counted = rows.select("doc_id", "text", words(text).alias("words"))
    return counted.select(
        "doc_id",
        "text",
        "words",
        F.size("words").cast("bigint").alias("n_words"),
        word_chars(text).alias("word_chars"),
        n_symbols(text).alias("n_symbols"),
        n_dup_lines(text).alias("n_dup_lines"),
        n_repeat_words(F.col("words")).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def default_rules() -> list[Rule]:
    """Rules over `measures`; thresholds are meant to leave clean prose of any language alone."""
    text, n = F.col("text"), F.col("n_words")
    upper = F.length(text) - F.length(F.regexp_replace(text, "\\p{Lu}", ""))
    letters = F.length(text) - F.length(F.regexp_replace(text, "\\p{L}", ""))
    lines = F.length(text) - F.length(F.translate(text, "\n", "")) + 1
    return [
        Rule("few_words", n < 50),
        Rule("repeated_windows", 100 * F.col("n_repeat_words") > 50 * n),
        Rule("many_symbols", 10 * F.col("n_symbols") > n),
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n)),
        Rule("repeated_lines", 10 * F.col("n_dup_lines") > 3 * lines),
        Rule("few_letters", 10 * letters < 6 * F.col("word_chars")),
        Rule("upper_case", 2 * upper > letters),
        Rule("exclamation", 10 * (F.length(text) - F.length(F.translate(text, "!?", ""))) > 3 * n),
    ]


def learn_order(sample: DataFrame, rules: list[Rule]) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, rejected part) by rejections per second, most first; ties by name.

    The sample is a written table of `measures`. Seconds are those of one aggregate with the rule less those of
    one without it. The order decides on work alone: which texts are rejected does not depend on it.
    """

    def run(condition: Column) -> tuple[float, int]:
        start = time.perf_counter()
        found = sample.agg(F.count_if(condition).alias("n"), F.count("*").alias("all")).first()
        return time.perf_counter() - start, found["n"] / max(found["all"], 1)

    run(F.lit(False))
    floor = min(run(F.lit(False))[0] for _ in range(2))
    learned = [(r, max(seconds - floor, 1e-4), part) for r in rules for seconds, part in [run(r.rejects)]]
    return sorted(learned, key=lambda x: (-x[2] / x[1], x[0].name))


def cascade(rules: list[Rule]) -> Column:
    """The name of the first rule that rejects, null if none does; later rules are then not evaluated."""
    rejected = None
    for rule in rules:
        rejected = F.when(rule.rejects, F.lit(rule.name)) if rejected is None else rejected.when(rule.rejects, F.lit(rule.name))
    return rejected if rejected is not None else F.lit(None).cast("string")


def judge(
    docs: DataFrame,
    rules: list[Rule] | None = None,
    sample_rows: int = SAMPLE_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: the measures, base_failed, kept, and `rejected_by`.

    All texts are judged whole; only the order of the rules is learned from a sample of about
    `sample_rows` rows drawn by a hash of the id. `rejected_by` names the first rule of that order
    that rejects, so it can differ between runs; `kept` cannot. A null or empty text has no words and is
    rejected; a null id is kept; repeated rows are judged alike; an empty table gives an empty one.
    Columns other than the two named are ignored. Nothing is shuffled but small inputs, to spread them.
    """
    rules = default_rules() if rules is None else rules
    rows = spread_texts(docs, id_col, text_col)
    total = docs.count()
    part = min(1.0, sample_rows / max(total, 1))
    drawn = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit("rules")), F.lit(1_000_000)) < int(part * 1_000_000) + 1)
    sample = materialize(measures(drawn).drop("words"), "rules-sample")
    order = [rule for rule, _, _ in learn_order(sample, rules)]
    return measures(rows).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        cascade(order).alias("rejected_by"),
    ).withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull())
