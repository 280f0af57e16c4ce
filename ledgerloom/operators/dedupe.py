"""One row per key.

Both operators rank inside the key and keep rank one. Spark turns ``row_number() = 1`` into a
group limit that runs *before* the shuffle, so a key holding a third of all rows reaches the
reducer as at most one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None
) -> DataFrame:
    """Latest loaded version of each (tenant, key)."""
    order = order or [F.col("_loaded_at").desc(), F.col("_source_row").desc()]
    return best_per_key(df, ["tenant_id", *keys], order)


def first_copy(copies: DataFrame) -> DataFrame:
    """The earliest received copy of each event, upload id breaking ties."""
    return best_per_key(copies, ["event_id"], [F.col("received_at").asc(), F.col("upload_id").asc()])
