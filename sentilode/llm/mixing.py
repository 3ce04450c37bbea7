"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sentilode.session import materialize

# Ranks are first counted in so many bins of a source; only the bin with the cut is sorted.
BINS = 65_536
# No document is taken more often than this.
MOST_COPIES = 3


def n_words(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text; 0 if it is null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, size), one row per source.

    Sources in code-point order, null last, weigh 1, 2, 3 and so on again, and share the sum of all
    sizes. A target stops at `most` times its source's size and what is over goes to the others by
    weight, until none is above. That is solved in one pass: in order of cap per weight, a source is
    capped while its cap is below its part of what the sources before it have left. The windows hold
    one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    rows = (
        totals.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1)
        .withColumn("cap", F.col("source_size") * F.lit(most))
        .withColumn("left_size", F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(earlier), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
        .withColumn(
            "open",
            F.col("cap") / F.col("weight") >= F.col("left_size") / F.col("left_weight"),
        )
        # The first open source in this order and all after it share what is left then.
        .withColumn("open_size", F.max(F.when(F.col("open"), F.col("left_size"))).over(whole))
        .withColumn("open_weight", F.max(F.when(F.col("open"), F.col("left_weight"))).over(whole))
    )
    share = F.col("open_size").cast("double") * F.col("weight") / F.col("open_weight")
    return rows.select(
        "source",
        "source_size",
        F.when(F.col("open"), share).otherwise(F.col("cap").cast("double")).alias("target"),
    )


def uniform(doc_id: Column, digest: Column, seed: str) -> Column:
    """A number strictly between 0 and 1 that depends on id, text digest and seed alone."""
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), digest))
    return (F.conv(F.substring(key, 1, 12), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 48))


def _with_rank(rows: DataFrame) -> DataFrame:
    """Adds certain copies, inclusion probability of one more, and the rank that decides on it."""
    expected = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(F.lit(0.0))
    p = F.col("_p")
    return (
        rows.withColumn("_expected", expected)
        .withColumn("_certain", F.floor("_expected").cast("bigint"))
        .withColumn("_p", F.col("_expected") - F.col("_certain"))
        .withColumn("_rank", F.when(p > 0, (F.col("_u") / (1 - F.col("_u"))) / (p / (1 - p))))
    )


def plan_cuts(rows: DataFrame, bins: int = BINS) -> DataFrame:
    """(_source, _source_size, _target, _all, _cut) per source, from (_id, _source, _size, _digest, _u).

    `_cut` is the (rank, id, size, digest) of the last row that gets one more copy, null if none does;
    `_all` says that all do. Rows are taken in this order while at least half of a row's words still
    fit, so that the words taken miss the target by half a row at most.
    """
    targets = source_targets(rows.select(F.col("_source").alias("source"), F.col("_size").alias("size")))
    targets = materialize(targets.toDF("_s", "_source_size", "_target"), "mix-targets")
    same = F.col("_source").eqNullSafe(F.col("_s"))
    ranked = (
        _with_rank(rows.join(targets, same).drop("_s"))
        .filter(F.col("_rank").isNotNull())
        .withColumn("_bin", F.floor(F.col("_rank") / (1 + F.col("_rank")) * bins).cast("bigint"))
        .withColumn("_open", F.col("_target") - F.col("_certain") * F.col("_source_size"))
    )
    before = Window.partitionBy("_source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    binned = (
        ranked.groupBy("_source", "_bin", "_open")
        .agg(F.sum("_size").alias("_bin_size"))
        .withColumn("_before", F.coalesce(F.sum("_bin_size").over(before), F.lit(0)))
        .filter((F.col("_before") <= F.col("_open")) & (F.col("_before") + F.col("_bin_size") > F.col("_open")))
    )
    # The first bin in which a source's words pass what is open; none if all of them fit.
    cut_bins = binned.groupBy(F.col("_source").alias("_s")).agg(F.min(F.struct("_bin", "_before")).alias("_edge"))
    cut_bins = materialize(cut_bins.select("_s", F.col("_edge._bin").alias("_cut_bin"), "_edge._before"), "mix-bins")
    inside = Window.partitionBy("_source").orderBy("_rank", "_id", "_size", "_digest").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    place = F.struct("_rank", "_id", "_size", "_digest")
    in_bin = (
        ranked.join(cut_bins, same & (F.col("_bin") == F.col("_cut_bin")))
        .withColumn("_sum", F.col("_before") + F.sum("_size").over(inside))
        .filter(F.col("_sum") - F.col("_size") / 2 <= F.col("_open"))
        .groupBy(F.col("_source").alias("_s"))
        .agg(F.max(place).alias("_last"))
    )
    # Without such a row in the bin, the cut is at the lower end of the bin.
    low = F.col("_cut_bin").cast("double") / bins
    bare = F.struct(
        (low / (1 - low)).alias("_rank"), F.lit(None).cast("bigint").alias("_id"),
        F.lit(None).cast("bigint").alias("_size"), F.lit(None).cast("string").alias("_digest"),
    )
    cuts = (
        targets.join(cut_bins.withColumnRenamed("_s", "_b"), F.col("_s").eqNullSafe(F.col("_b")), "left")
        .join(in_bin.withColumnRenamed("_s", "_i"), F.col("_s").eqNullSafe(F.col("_i")), "left")
    )
    return cuts.select(
        F.col("_s").alias("_source"),
        "_source_size",
        "_target",
        F.col("_cut_bin").isNull().alias("_all"),
        F.coalesce("_last", F.when(F.col("_cut_bin").isNotNull(), bare)).alias("_cut"),
    )


def mix(
    docs: DataFrame,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    bins: int = BINS,
) -> DataFrame:
    """One row per input row: its columns as the struct `doc`, and size, source_size, target, copies, taken.

    Each row of a source is to appear target / source_size times: the whole part of that is certain,
    the rest is the inclusion probability of one more copy. The rows of a source are ranked by the
    odds of a random number over the odds of inclusion (Pareto order sampling) and get their further
    copy in this order up to a cut. The cut is found from words counted per bin of the rank; only the
    rows of the bin with the cut are sorted, so no window and no task holds a source. The last step
    joins the rows with one cut per source.

    A null text has no words; a null source is a source, the last in order; a source without words has
    target 0; a null id is a value like another. Ties of rank are broken by id, size and digest of the
    text; rows that are equal in all of these stay or go together. An empty table gives an empty one.
    The struct keeps columns of any name.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.struct(*docs.columns).alias("doc"),
        F.col(id_col).cast("bigint").alias("_id"),
        F.col(source_col).cast("string").alias("_source"),
        n_words(text).alias("_size"),
        F.md5(text).alias("_digest"),
    ).withColumn("_u", uniform(F.col("_id"), F.col("_digest"), seed))
    counted = materialize(rows.drop("doc"), "mix-rows")
    cuts = materialize(plan_cuts(counted, bins), "mix-cuts").withColumnRenamed("_source", "_s")
    rows = _with_rank(rows.join(cuts, F.col("_source").eqNullSafe(F.col("_s"))))
    place = F.struct("_rank", "_id", "_size", "_digest")
    more = F.when(F.col("_rank").isNull(), F.lit(False)).otherwise(F.col("_all") | F.coalesce(place <= F.col("_cut"), F.lit(False)))
    copies = F.col("_certain") + more.cast("bigint")
    return rows.select(
        "doc",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        copies.alias("copies"),
        (copies * F.col("_size")).alias("taken"),
    )
