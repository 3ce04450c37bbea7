"""Ranks, top-k and joins give the same rows as the plain operators, with hot keys too."""

from __future__ import annotations

import pytest
from pyspark.sql import Window, functions as F

from sentilode.operators import sampling, scale
from sentilode.session import checkpoint_root, materialize, scratch_path


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def skewed(spark):
    """A third of the rows has one key; some have none."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40)
    return spark.range(3000).select(F.col("id"), key.cast("bigint").alias("k"))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot", [1, 3])
def test_lookup_join_beyond_the_bound(spark, skewed, monkeypatch, how, hot):
    monkeypatch.setattr(scale, "HOT_KEYS", hot)
    table = spark.range(30).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    want = skewed.join(table, "k", how)
    assert rows(scale.lookup_join(skewed, table, "k", how)) == rows(want)
    split = scale.lookup_join(skewed, table, "k", how, max_bytes=0)
    assert rows(split) == rows(want.select(split.columns))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_takes_known_counts(spark, skewed, monkeypatch, how):
    """Given counts, even wrong or missing ones, change no row, and the facts are not counted again."""
    written = []
    own = scale.materialize
    monkeypatch.setattr(scale, "materialize", lambda df, name: written.append(name) or own(df, name))
    monkeypatch.setattr(scale, "HOT_KEYS", 2)
    table = spark.range(30).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    want = skewed.join(table, "k", how)
    for counts in (table.select("k", (F.col("k") + 1).alias("n")), table.limit(0).select("k", F.col("k").alias("n"))):
        split = scale.lookup_join(skewed, table, "k", how, max_bytes=0, counts=counts)
        assert rows(split) == rows(want.select(split.columns))
    assert written and "key-counts" not in written


def test_measured_bytes_grows(spark):
    small = spark.range(10).select(F.col("id").cast("string").alias("s"))
    assert 0 < scale.measured_bytes(small) < scale.measured_bytes(small.union(small))
    assert scale.measured_bytes(small.filter("false")) == 0
    arrays = small.select("s", F.array("s").alias("a"))
    assert scale.measured_bytes(arrays) > scale.measured_bytes(small)
    assert scale.measured_bytes(arrays, 100) == scale.measured_bytes(small) + 10 * 100


@pytest.mark.parametrize("largest", [True, False])
@pytest.mark.parametrize("k", [1, 7, 100, 2999, 3000, 5000])
def test_top_k(spark, k, largest):
    df = spark.range(3000).select(F.col("id"), F.expr("id * id % 97").alias("n"))
    order = [F.col("n").desc() if largest else F.col("n"), F.col("id")]
    got = scale.top_k(df, k, F.col("n"), order, largest).collect()
    assert got == df.orderBy(*order).limit(k).collect()


def test_top_k_zero_keys(spark):
    df = spark.range(20).select(F.lit(0).cast("bigint").alias("n"), "id")
    assert scale.top_k(df, 5, F.col("n"), [F.desc("n"), F.col("id")]).count() == 5


def test_ranked_splits_hot_groups(spark, skewed):
    want = skewed.withColumn("r", (F.row_number().over(Window.partitionBy("k").orderBy("id")) - 1).cast("bigint"))
    assert rows(scale.ranked(skewed, ["id"], ["k"], "r")) == rows(want)
    flat = scale.ranked(skewed, ["k", "id"], name="r")
    want = skewed.withColumn("r", (F.row_number().over(Window.orderBy("k", "id")) - 1).cast("bigint"))
    assert rows(flat) == rows(want)


def test_spread(spark, skewed):
    assert scale.spread(skewed, "id").rdd.getNumPartitions() == skewed.rdd.getNumPartitions()
    one = skewed.coalesce(1)
    assert scale.spread(one, "id").rdd.getNumPartitions() > 1
    assert rows(scale.spread(one, "id")) == rows(skewed)


def test_folds_and_splits(spark, skewed):
    labelled = skewed.select("id", F.when(F.col("k") == 7, 1).otherwise(0).alias("label"))
    folds = sampling.assign_folds(labelled, 5, "id")
    sizes = folds.groupBy("label").pivot("fold").count().collect()
    assert all(max(r[1:]) - min(r[1:]) <= 1 for r in sizes) and folds.count() == 3000
    for options in ({"key": "id"}, {"seed": 3}):
        a, b = sampling.split(skewed, 0.8, **options)
        assert rows(a.union(b)) == rows(skewed) and 2200 < a.count() < 2600
    with pytest.raises(ValueError):
        sampling.split(skewed, 0.8)
    assert 100 < sampling.sample_fraction(skewed, 0.05, seed=1).count() < 200
    assert sampling.sample_fraction(skewed, 1, "id").count() == 3000
    assert sorted(sampling.sample_n(skewed, 50, "id").collect()) == sorted(sampling.sample_n(skewed, 50, "id").collect())


def test_scratch_tables_lie_in_the_shared_folder(spark):
    assert scratch_path(spark, "t").startswith(checkpoint_root(spark))
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert checkpoint_root(spark) == configured.rstrip("/")
    kept = materialize(spark.range(5), "t")
    assert kept.inputFiles()[0].replace("file://", "").startswith(checkpoint_root(spark).replace("file:", ""))


@pytest.mark.parametrize("n", [0, 1, 37, 400, 900])
def test_sample_has_the_smallest_hashes(spark, n):
    import hashlib

    rows = spark.range(400).select(F.col("id"))
    first = sorted(range(400), key=lambda k: (hashlib.md5(str(k).encode()).hexdigest(), k))[:n]
    assert sorted(r["id"] for r in sampling.sample_n(rows, n, "id").collect()) == sorted(first)
