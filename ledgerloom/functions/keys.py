"""Surrogate keys and natural record keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands in for a null part, so that keys equal those already stored downstream.
NULL_PART = "_dbt_utils_surrogate_key_null_"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*parts: Column | str) -> Column:
    """Hash of the natural key. It never depends on load order, so facts can be keyed
    before the dimension row exists."""
    return F.md5(
        F.concat_ws("-", *[F.coalesce(_col(p).cast("string"), F.lit(NULL_PART)) for p in parts])
    )


def nullable_key(tenant: Column | str, code: Column | str) -> Column:
    """Surrogate key that stays null when the code is null."""
    return F.when(_col(code).isNotNull(), surrogate_key(tenant, code))


def record_key(*parts: Column | str) -> Column:
    """Primary-key parts joined by ``|``; null when any part is null (``concat`` is null-strict)."""
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit("|"))
        pieces.append(_col(p).cast("string"))
    return F.concat(*pieces)
