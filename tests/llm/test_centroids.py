"""Clusters against plain Lloyd rounds, cells and intervals, fetched rows."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pytest

from sentilode.llm import centroids as ce

SCHEMA = "vec_id bigint, embedding array<float>, cluster int, place string, distance double"


@pytest.fixture(scope="module")
def make_vectors(spark):
    """(vec_id, embedding) with columns named like results."""

    def make(rows):
        return spark.createDataFrame([(i, v, 7, "x", 0.5) for i, v in rows], SCHEMA).repartition(3)

    return make


def lloyd(rows, k=ce.CENTROIDS, rounds=ce.ROUNDS, dims=ce.DIMS):
    """Every row (id, ...) of the result, by the definition."""
    kept = [
        (i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)
    ]
    ids = lambda i: "" if i is None else str(i)
    kept.sort(key=lambda r: (hashlib.sha256(f"1:{ids(r[0])}".encode()).hexdigest(), r[1]))
    at = [list(v) for _, v in kept[:k]]

    def near(v):
        far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in at]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        own = [near(v)[0] for _, v in kept]
        for c in range(len(at)):
            mine = [v for (_, v), o in zip(kept, own) if o == c]
            if mine:
                at[c] = [sum(x) // len(mine) for x in zip(*mine)]
    last = [near(v) for _, v in kept]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    inertia = sum(d for _, d in last)
    return sorted(
        (str(i), c, d, sum(e for o, e in last if o == c), inertia, digest[c]) for (i, _), (c, d) in zip(kept, last)
    )


def same(df, want):
    assert sorted((str(r[0]), *r[1:]) for r in df.collect()) == want


def gathered(n, dims=64, seed=1):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 0.2, (20, dims))
    return (middles[rng.integers(0, 20, n)] + rng.normal(0, 0.08, (n, dims))).astype(np.float32)


def test_same_as_plain_rounds(make_vectors):
    rows = [(i, v.tolist()) for i, v in enumerate(gathered(400))]
    rows += [(1000 + i, [0.1 * i] * 64) for i in range(3)]
    odd = [0.5] * 63
    rows += [
        (7, odd), (8, odd + [None]), (9, odd + [float("nan")]), (10, odd + [float("inf")]), (11, None), (12, []),
        (3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1]), (13, [-0.25] * 64), (13, [-0.25] * 64),
    ]
    same(ce.cluster(make_vectors(rows)), lloyd(rows))


def test_shuffled_fetch_gives_the_same(make_vectors):
    rows = [(i, v.tolist()) for i, v in enumerate(gathered(300, seed=2))]
    same(ce.cluster(make_vectors(rows), most_bytes=0), lloyd(rows))


def test_few_equal_or_no_vectors(make_vectors):
    same(ce.cluster(make_vectors([(1, [0.5] * 64), (2, [0.25] * 64)])), lloyd([(1, [0.5] * 64), (2, [0.25] * 64)]))
    # All centroids are equal: the first one gets all, the others stay empty.
    rows = [(i, [0.125] * 64) for i in range(40)]
    same(ce.cluster(make_vectors(rows)), lloyd(rows))
    empty = ce.cluster(make_vectors([(1, [0.5])]))
    assert empty.count() == 0 and empty.columns[0] == "vec_id"
    assert ce.cluster(make_vectors([])).count() == 0


def test_other_sizes(make_vectors):
    rows = [(i, v.tolist()) for i, v in enumerate(gathered(120, dims=5, seed=3))]
    same(ce.cluster(make_vectors(rows), k=4, rounds=5, dims=5), lloyd(rows, 4, 5, 5))


def test_intervals_hold_distances():
    rng = np.random.default_rng(4)
    vectors = rng.integers(-40, 40, (500, 7))
    inner = np.sort(rng.integers(-30, 30, (7, (1 << ce.BITS) - 1)), axis=1)
    va = ce.VaFile(inner, vectors.min(axis=0), vectors.max(axis=0))
    centroids = rng.integers(-60, 60, (6, 7))
    cells = ce.encode(vectors, inner)
    assert cells.shape == (500, -(-7 * ce.BITS // 8))
    numbers = ce.decode(cells, 7)
    assert (numbers == (inner[None] <= vectors[:, :, None]).sum(axis=2)).all()
    tables = va.tables(centroids)
    bounds = sum(tables[d][numbers[:, d]] for d in range(7))
    real = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (bounds[:, :6] <= real).all() and (real <= bounds[:, 6:]).all()
    possible = ce.candidates(cells, tables)
    assert possible[np.arange(500), real.argmin(axis=1)].all()
    # Of equally near centroids the first stays possible.
    assert (ce.nearest(vectors, possible, centroids)[0] == real.argmin(axis=1)).all()


def test_rounds_fetch_few_vectors(spark, make_vectors):
    """Only undecided and moved rows leave the table of vectors."""
    vectors = gathered(2000, seed=5)
    rows = make_vectors([(i, v.tolist()) for i, v in enumerate(vectors)])
    source = rows.selectExpr("vec_id", "cast(embedding as array<double>) as embedding")
    va = ce.fit_cells(source)
    table = ce.materialize(
        source.mapInArrow(ce._build(va, "vec_id", "embedding", 64, 64), "vec_id bigint, cells binary, vector array<int>")
        .withColumn("place", ce.F.monotonically_increasing_id()), "t"
    )
    centroids = ce.start_centroids(table, 16)
    first = ce.materialize(table.select("place", "cells", "vector").mapInArrow(ce._first_round(va, centroids), ce.STATE), "s")
    moved = ce.moved_centroids(centroids, ce.added_up(first, 16, 64))
    second, fetched = ce.next_round(first, table, va, moved)
    assert second.filter("place is not null").count() == 2000
    assert fetched.filter("place is not null").count() < 500


def test_large_components_are_left_out():
    column = pa.array([[1e30, 0.0], [1.0, -1.0], [float(1 << 21), 0.0]], pa.list_(pa.float64()))
    kept, rows = ce.integers(column, 2)
    assert kept.tolist() == [False, True, False] and rows.tolist() == [[64, -64]]
