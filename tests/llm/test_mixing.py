"""Targets and samples against the SQL, sums near targets, the edge cases."""

from __future__ import annotations

import random

import pytest

from oracle import connect, difference
from sentilode.llm import mixing
from sentilode.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def targets(sizes, most=3):
    """By the rule as it is told: cap, share the excess by weight, again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        out = {s: most * sizes[s] for s in capped} | {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if out[s] > most * sizes[s]}
        if not over:
            return out
        capped |= over


@pytest.mark.parametrize("seed", range(6))
def test_targets(spark, seed):
    draw = random.Random(seed)
    sizes = {s: draw.choice([0, 1, 5, 50, 1000, 20_000]) + 1 for s in ["a", "B", "é", None, "d", "e", "f"][: seed + 1]}
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size bigint")
    found = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    want = targets(sizes)
    assert found.keys() == want.keys()
    assert all(found[s] == pytest.approx(want[s]) for s in want)


def test_same_as_sql(spark):
    con = connect(SF)
    assert difference(QUERIES["op10_mixing"](spark, SF), ORACLES["op10_mixing"], con) is None


@pytest.mark.parametrize("bins", [4, 65_536])
def test_sums_are_near_targets(spark, make_docs, bins):
    draw = random.Random(bins)
    rows = [(k, "w " * draw.randint(0, 40), draw.choice(["a"] * 5 + ["b", "c", None])) for k in range(600)]
    rows += [(9_000, "w " * 70, "c"), (9_001, None, "a"), (None, "w w", "b")]
    found = mixing.mix(make_docs(rows), bins=bins).selectExpr("doc.source as source", "size", "source_size", "target", "copies", "taken").collect()
    assert len(found) == len(rows)
    for source in ("a", "b", "c", None):
        own = [r for r in found if r.source == source]
        assert own[0].source_size == sum(r.size for r in own)
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own) / 2 + 1e-6
        assert all(r.taken == r.copies * r.size and r.copies <= 3 for r in own)


def test_reruns_agree(spark, make_docs):
    rows = [(k, "w " * (k % 17), "ab"[k % 2]) for k in range(200)]
    read = lambda d: sorted((r[0].doc_id, r.taken) for r in mixing.mix(d).collect())
    assert read(make_docs(rows)) == read(make_docs(rows[::-1]).repartition(7))


def test_edges(spark, make_docs):
    assert mixing.mix(make_docs([(1, "x")]).limit(0)).collect() == []
    none = mixing.mix(make_docs([(1, None, "a"), (2, "", None)])).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in none] == [(0, 0, 0.0, 0)] * 2
    same = mixing.mix(make_docs([(1, "w w w", "a")] * 4 + [(2, "w", "b")])).collect()
    assert len({r.taken for r in same if r.size == 3}) == 1
