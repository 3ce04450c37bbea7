"""Scored results: JSON events, the results table, reports and saved models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The fields of a result event.
RESULT_SCHEMA = "key string, value string, sentiment string"


def to_event(df: DataFrame) -> DataFrame:
    """(key, event): the result as JSON text."""
    return df.select("key", F.to_json(F.struct("key", "value", "sentiment")).alias("event"))


def double_encode(event: Column) -> Column:
    """The JSON text as a JSON string, the way a client posts an already dumped object."""
    return F.regexp_extract(F.to_json(F.struct(event.alias("e"))), r"(?s)^\{\"e\":(.*)\}$", 1)


def from_event(df: DataFrame, payload: str = "event") -> DataFrame:
    """(key, value, sentiment) from JSON that may be encoded once or twice."""
    text = F.col(payload)
    inner = F.when(text.startswith('"'), F.get_json_object(text, "$")).otherwise(text)
    return df.select(F.from_json(inner, RESULT_SCHEMA).alias("r")).select("r.*")


def arrival() -> list[Column]:
    """The order in which results came: batch, the key as a number, the key."""
    return [F.col("batch_id"), F.col("key").try_cast("bigint"), F.col("key")]


def snapshot(results: DataFrame, latest: int | None = None) -> DataFrame:
    """All results in order of arrival, or the `latest` ones, last first."""
    if latest is None:
        return results.orderBy(*arrival())
    return results.orderBy(*[c.desc() for c in arrival()]).limit(latest)


def write_report(path: str, **reports: DataFrame) -> None:
    """One JSON folder per report (accuracy, confusion matrix, ...); each has a few rows."""
    for name, report in reports.items():
        report.coalesce(1).write.mode("overwrite").json(f"{path}/{name}")


def save_model(model, path: str) -> None:
    """A fitted pipeline, a bare classifier or a cross-validated model."""
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{RESULT_SCHEMA}, batch_id bigint").parquet(path)
