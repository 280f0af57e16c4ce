"""Tenant headers and values to contract fields, for all files of all tenants at once.

Configuration becomes one small row per (tenant, feed). It meets the files' header rows in a
per-file table, and only the finished per-file layout is joined to the data rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ParseOptions, Tenant
from ..functions.text import normalize, normalize_py
from ..sources.delimited import same_path
from .lookup import lookup

_SEP = "\u0001"

_CONFIG_SCHEMA = """tenant_id string, feed string, contract string, timezone string, profile int,
column_headers array<string>, column_norms array<string>, column_fields array<string>,
labels map<string,string>, value_fields array<string>, value_map map<string,string>,
files string, format struct<type:string,encoding:string,delimiter:string,sheet:string,header_row:int>"""


def parse_profiles(tenants: Iterable[Tenant]) -> list[ParseOptions]:
    """The distinct parse options in use. Rows carry the index; formats stay literals."""
    found: list[ParseOptions] = []
    for t in tenants:
        for cfg in t.feeds.values():
            if cfg.parse not in found:
                found.append(cfg.parse)
    return found


def config_frame(spark: SparkSession, tenants: Iterable[Tenant]) -> DataFrame:
    """One row per (tenant, feed); its size is the size of the configuration files."""
    tenants = list(tenants)
    profiles = parse_profiles(tenants)
    rows = []
    for t in tenants:
        for cfg in t.feeds.values():
            translated = {
                f"{f}{_SEP}{normalize_py(k)}": v for f, m in cfg.values.items() for k, v in m.items()
            }
            fmt = cfg.format
            rows.append(
                (
                    t.tenant_id,
                    cfg.feed,
                    cfg.contract,
                    t.timezone,
                    profiles.index(cfg.parse),
                    list(cfg.columns),
                    [normalize_py(h) for h in cfg.columns],
                    list(cfg.columns.values()),
                    cfg.labels,
                    sorted(f for f, m in cfg.values.items() if m),
                    translated,
                    cfg.files,
                    (fmt.type, fmt.encoding, fmt.delimiter, fmt.sheet, fmt.header_row),
                )
            )
    return spark.createDataFrame(rows, _CONFIG_SCHEMA)


def _actual_header(norm: Column) -> Column:
    """The last header of the file that matches a configured header loosely."""
    return F.element_at(
        F.concat(
            F.array(F.lit(None).cast("string")),
            F.filter("headers", lambda h: (h != "") & (normalize(h) == norm)),
        ),
        -1,
    )


def file_layouts(files: DataFrame, headers: DataFrame, config: DataFrame) -> DataFrame:
    """One row per file: which cell holds which field, and which headers are missing or unused.

    ``files`` has (batch_id, tenant_id, feed, path), ``headers`` (file_path, path, headers array).
    """
    heads = headers.select("file_path", F.col("path").alias("header_path"), "headers")
    per_file = (
        files.select("batch_id", "tenant_id", "feed", "path", "source_file", "loaded_at")
        .join(heads, same_path(files["path"], heads["header_path"]))
        .join(config, ["tenant_id", "feed"])
    )
    pairs = F.arrays_zip(
        F.col("column_headers").alias("header"),
        F.col("column_fields").alias("field"),
        F.transform("column_norms", _actual_header).alias("actual"),
    )
    found = per_file.withColumn("pairs", pairs)
    present = F.filter("pairs", lambda p: p["actual"].isNotNull())
    # Of two configured headers for one field the later one counts.
    found = found.withColumn("present", present).withColumn(
        "used",
        F.filter(
            "present",
            lambda p, i: ~F.exists(
                F.slice("present", i + 2, F.greatest(F.size("present"), F.lit(1))),
                lambda q: q["field"] == p["field"],
            ),
        ),
    )
    indices = F.sequence(F.lit(0), F.size("headers") - 1)
    positions = F.transform(
        "used", lambda p: F.filter(indices, lambda i: F.get("headers", i) == p["actual"])
    )
    used_headers = F.transform("used", lambda p: p["actual"])
    return found.select(
        "file_path",
        "batch_id",
        "source_file",
        "loaded_at",
        "tenant_id",
        "feed",
        "contract",
        "timezone",
        "profile",
        "labels",
        "value_fields",
        "value_map",
        F.transform("used", lambda p: p["field"]).alias("fields"),
        positions.alias("positions"),
        F.transform(
            F.filter("pairs", lambda p: p["actual"].isNull()), lambda p: p["header"]
        ).alias("missing_columns"),
        F.filter(
            "headers", lambda h: (h != "") & ~F.array_contains(used_headers, h)
        ).alias("unmapped_columns"),
    )


def _cell(cells: str, at: Column) -> Column:
    # A header may repeat; the last cell that the (possibly short) row still has wins.
    return F.get(cells, F.array_max(F.filter(at, lambda i: i < F.size(cells))))


def map_columns(records: DataFrame, layouts: DataFrame) -> DataFrame:
    """Data rows as ``raw`` (field -> text), values translated.

    ``records`` has (file_path, source_row, cells) and, for typed cells, ``kinds``. Values without
    a translation pass through untouched so that a report can quote them.
    """
    typed = "kinds" in records.columns
    rows = lookup(records, layouts, ["file_path"], "inner")
    raw = F.map_from_arrays("fields", F.transform("positions", lambda at: _cell("cells", at)))
    rows = rows.withColumn("raw", raw)
    if typed:
        kinds = F.map_from_arrays("fields", F.transform("positions", lambda at: _cell("kinds", at)))
        rows = rows.withColumn("raw_kinds", kinds)

    def translate(field: Column, value: Column) -> Column:
        known = F.element_at("value_map", F.concat(field, F.lit(_SEP), normalize(value)))
        wanted = F.array_contains("value_fields", field)
        if typed:
            kind = F.element_at("raw_kinds", field)
            wanted = wanted & F.coalesce(kind.isin("text", "int", "float"), F.lit(True))
        return F.when(wanted, F.coalesce(known, value)).otherwise(value)

    translated = F.when(
        F.size("value_fields") > 0, F.transform_values("raw", translate)
    ).otherwise(F.col("raw"))
    keep = ["batch_id", "source_file", "loaded_at", "tenant_id", "feed", "contract", "source_row", "timezone", "profile"]
    out = rows.select(
        *keep, translated.alias("raw"), F.col("raw").alias("raw_source"), "labels", "missing_columns",
        *(["raw_kinds"] if typed else []),
    )
    if typed:
        # A translated cell is text from here on.
        kinds = F.transform_values(
            "raw_kinds",
            lambda f, k: F.when(F.element_at("raw", f) == F.element_at("raw_source", f), k).otherwise("text"),
        )
        out = out.withColumn("kinds", kinds).drop("raw_kinds")
    return out.drop("raw_source")
