"""Conformed dimensions. A member that events mention before its list row arrives is inferred;
the hash key is the same either way, so facts never have to change."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from .staging import NUMERIC

CALENDAR_START = dt.date(2024, 1, 1)


def dim_tenant(seed: DataFrame) -> DataFrame:
    return seed.select("tenant_id", "camp_name", "country", "region", "timezone", "onboarded_on")


def calendar_attributes(day: Column) -> dict[str, Column]:
    """Year, month and day of week (Sunday = 0) of a date."""
    dow = F.dayofweek(day) - 1
    return {
        "year": F.year(day),
        "month": F.month(day),
        "day_of_week": dow,
        "is_weekend": dow.isin(0, 6),
    }


def dim_date(spark: SparkSession, as_of: dt.date) -> DataFrame:
    """Days from the calendar start up to, and excluding, two years after ``as_of``."""
    end = F.date_add(F.add_months(F.lit(as_of), 24), -1)
    days = spark.range(1).select(F.explode(F.sequence(F.lit(CALENDAR_START), end)).alias("date_day"))
    return days.withColumns(calendar_attributes(F.col("date_day")))


def _known_tenants(df: DataFrame, tenants: DataFrame) -> DataFrame:
    return df.join(tenants.select("tenant_id"), "tenant_id", "left_semi")


def _null(type_: str) -> Column:
    return F.lit(None).cast(type_)


def _missing(referenced: DataFrame, reported: DataFrame, code: str) -> DataFrame:
    return referenced.join(reported.select("tenant_id", code), ["tenant_id", code], "left_anti")


def dim_building(reported: DataFrame, events: DataFrame, tenants: DataFrame) -> DataFrame:
    code = F.col("building_code")
    referenced = events.where(code.isNotNull()).select("tenant_id", "building_code").distinct()
    inferred = _missing(referenced, reported, "building_code").select(
        "tenant_id",
        "building_code",
        F.concat(F.lit("Unknown building "), code).alias("building_name"),
        F.lit("unknown").alias("building_type"),
        _null("int").alias("capacity"),
        _null("int").alias("year_built"),
        F.lit(True).alias("is_inferred"),
    )
    listed = reported.select(
        "tenant_id",
        "building_code",
        "building_name",
        "building_type",
        "capacity",
        "year_built",
        F.lit(False).alias("is_inferred"),
    )
    members = _known_tenants(listed.unionByName(inferred), tenants)
    return members.select(surrogate_key("tenant_id", "building_code").alias("building_key"), "*")


def dim_asset(reported: DataFrame, events: DataFrame, tenants: DataFrame) -> DataFrame:
    referenced = (
        events.where(F.col("asset_tag").isNotNull())
        .groupBy("tenant_id", "asset_tag")
        .agg(F.max("building_code").alias("building_code"))
    )
    inferred = _missing(referenced, reported, "asset_tag").select(
        "tenant_id",
        "asset_tag",
        F.concat(F.lit("Unknown asset "), "asset_tag").alias("asset_name"),
        F.lit("unknown").alias("asset_category"),
        F.lit("unknown").alias("asset_status"),
        "building_code",
        _null("date").alias("purchased_on"),
        _null(NUMERIC).alias("purchase_cost"),
        F.lit(True).alias("is_inferred"),
    )
    listed = reported.select(
        "tenant_id",
        "asset_tag",
        "asset_name",
        "asset_category",
        "asset_status",
        "building_code",
        "purchased_on",
        F.col("purchase_cost").cast(NUMERIC).alias("purchase_cost"),
        F.lit(False).alias("is_inferred"),
    )
    members = _known_tenants(listed.unionByName(inferred), tenants)
    return members.select(
        surrogate_key("tenant_id", "asset_tag").alias("asset_key"),
        surrogate_key("tenant_id", "building_code").alias("building_key"),
        "*",
    )


def dim_staff(reported: DataFrame, events: DataFrame, tenants: DataFrame) -> DataFrame:
    # One pass over the events: both code columns of a row are unrolled, then made distinct.
    codes = F.explode(F.array("staff_code", "reported_by_staff_code")).alias("staff_code")
    referenced = (
        events.select("tenant_id", codes).where(F.col("staff_code").isNotNull()).distinct()
    )
    inferred = _missing(referenced, reported, "staff_code").select(
        "tenant_id",
        "staff_code",
        _null("string").alias("first_name"),
        _null("string").alias("last_name"),
        F.lit("unknown").alias("staff_role"),
        _null("string").alias("email"),
        _null("date").alias("start_date"),
        _null("boolean").alias("is_active"),
        F.lit(True).alias("is_inferred"),
    )
    listed = reported.select(
        "tenant_id",
        "staff_code",
        "first_name",
        "last_name",
        "staff_role",
        "email",
        "start_date",
        "is_active",
        F.lit(False).alias("is_inferred"),
    )
    members = _known_tenants(listed.unionByName(inferred), tenants)
    return members.select(surrogate_key("tenant_id", "staff_code").alias("staff_key"), "*")
