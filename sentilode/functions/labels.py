"""Label columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def recode_label(target: Column) -> Column:
    """4 is positive (1); any other value and null are negative (0)."""
    return F.when(target == 4, 1).otherwise(0).cast("int")


def replace_label(target: Column) -> Column:
    """4 becomes 1; any other value stays."""
    return F.when(target == 4, 1).otherwise(target).cast("int")


def sentiment_name(prediction: Column) -> Column:
    return F.when(prediction == 1.0, "positive").otherwise("negative")
