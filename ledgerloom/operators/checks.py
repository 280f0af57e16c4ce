"""Data-quality checks. Each returns the failing rows, so an empty result means passed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values held by more than one row; nulls are not values."""
    return unique_combination(df.where(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.where(F.col("n_records") > 1)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-null key the parent lacks."""
    keys = parent.select(F.col(field).alias(column))
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Nulls pass, as in a SQL ``not in``."""
    return df.where(~F.col(column).isin(*values))


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None) -> DataFrame:
    c, outside = F.col(column), F.lit(False)
    if min_value is not None:
        outside = outside | (c < min_value)
    if max_value is not None:
        outside = outside | (c > max_value)
    return df.where(outside)
