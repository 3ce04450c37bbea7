"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sentilode.llm import (
    centroids, decontaminate, language, mixing, near, ordinal, periodic, pii, repeats, rules, sql, tokens, toxicity, windows,
)
from sentilode.llm.common import load
from sentilode.llm.registry import ORACLES, QUERIES, query  # noqa: F401  (for the driver's contract)


@query("op1_pii")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(load(spark, sf_dir, "documents"))


@query("op2_repeated_bytes")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(load(spark, sf_dir, "documents"))


@query("op3_ordinal_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return ordinal.grade(docs, ordinal.train(docs, ordinal.grades_of(load(spark, sf_dir, "labels"))))


@query("op4_near_duplicates")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(load(spark, sf_dir, "documents"))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, load(spark, sf_dir, "labels")))


@query("op6_quality_rules", sql.QUALITY_RULES)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The first rejecting rule depends on the learned order; the verdict does not.
    return rules.judge(load(spark, sf_dir, "documents")).drop("rejected_by")


def public_vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


@query("op7_token_files")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.round_trip(load(spark, sf_dir, "documents"), public_vocabulary())


@query("op8_repeated_windows")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.remove_repeated_windows(load(spark, sf_dir, "documents"))


@query("op9_benchmark_leaks")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


@query("op10_mixing", sql.MIXING)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(load(spark, sf_dir, "documents"))
    return mixed.selectExpr("cast(doc.doc_id as bigint) as doc_id", "size", "source_size", "target", "taken")


@query("op11_centroids", sql.CENTROIDS)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(load(spark, sf_dir, "embeddings"))


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(load(spark, sf_dir, "documents"), alter=True)


@query("op13_language")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return language.detect(docs, language.learn(docs))
