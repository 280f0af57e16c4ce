"""Seed tables kept as CSV next to the configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TENANTS = (
    "tenant_id string, camp_name string, country string, region string, timezone string, onboarded_on date"
)
TENANT_ACCESS = "role_name string, tenant_id string"


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
