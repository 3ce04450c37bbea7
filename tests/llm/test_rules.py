"""Measures against plain Python, verdicts against all rules at once, the learned order."""

from __future__ import annotations

import re
from collections import Counter

from oracle import connect, difference
from sentilode.llm import rules
from sentilode.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[k:k + 3]) for k in range(len(words) - 2))
    covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)
    )


CASES = [
    "", "a", "a b c", "a b c a b c", "a a a a a", "a b a b a b x y z", "x\nx\n\n \nx\r\ny", "# é😀 <|>\x0b*\x1c",
    "a b c d " * 30, "one two three four " + "five six " * 20, " \n ".join(["l1", "l2", "l1"]), "w " * 20_000,
    " ".join(str(k) for k in range(5_000)),
]


def test_measures(spark, make_docs):
    rows = [(k, t) for k, t in enumerate(CASES)] + [(100, None), (None, "a b c a b c"), (5, CASES[5])]
    found = rules.judge(make_docs(rows)).collect()
    assert len(found) == len(rows)
    want = sorted((str(i), *brute(t or "")) for i, t in rows)
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found)
    assert got == want
    for r in found:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (r.rejected_by is None)
    assert rules.judge(make_docs([(1, "x")]).limit(0)).collect() == []


def test_order_is_by_rejections_per_second(spark, make_docs):
    sample = rules.measures(make_docs([(k, "w " * (k * 10)) for k in range(20)]).select("doc_id", "text")).drop("words").cache()
    order = rules.learn_order(sample, rules.default_rules())
    rates = [part / seconds for _, seconds, part in order]
    assert rates == sorted(rates, reverse=True)
    assert {r.name for r, _, _ in order} == {r.name for r in rules.default_rules()}


def test_same_as_sql(spark):
    assert difference(QUERIES["op6_quality_rules"](spark, SF), ORACLES["op6_quality_rules"], connect(SF)) is None


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op6_quality_rules"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
