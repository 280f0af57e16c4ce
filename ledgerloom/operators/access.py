"""Tenant scoping of marts.

Open-source Spark has no row-level security, so this is a *view contract*: whoever hands out
DataFrames hands out scoped ones. It does not stop a user who can read the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ADMIN = "platform_admin"


class TenantScopeError(ValueError):
    pass


def tenant_view(
    df: DataFrame,
    role: str,
    access: DataFrame,
    *,
    is_admin: bool = False,
    tenant_scoped: bool = True,
) -> DataFrame:
    """Rows a role may read: everything for an admin, its mapped tenants for a reader, nothing
    for a role without a mapping. Role names match exactly.

    A table without ``tenant_id`` must opt out with ``tenant_scoped=False``; forgetting to is an
    error rather than a leak.
    """
    if not tenant_scoped:
        return df
    if "tenant_id" not in df.columns:
        raise TenantScopeError("no tenant_id column; pass tenant_scoped=False for shared tables")
    if is_admin or role == ADMIN:
        return df
    granted = access.where(F.col("role_name") == role).select("tenant_id")
    return df.join(granted, "tenant_id", "left_semi")
