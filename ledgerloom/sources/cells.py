"""Spreadsheet content that is already cells: one row per (file, sheet, row, column).

Decoding workbook files is left to whatever lands them; this is the table it lands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SourceFormat
from ..functions.text import is_blank, strip

CELL_SCHEMA = (
    "file_path string, sheet string, sheet_no int, row bigint, col int, kind string, text string"
)


def read_cells(cells: DataFrame, fmt: SourceFormat) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Same result as the delimited scan, plus ``kinds`` in the records.

    The header sits at exactly ``header_row`` of the named sheet, or of the first one.
    """
    sheets = cells.groupBy("file_path").agg(
        F.array_sort(F.collect_set(F.struct("sheet_no", "sheet"))).alias("sheets")
    )
    names = F.transform("sheets", lambda s: s["sheet"])
    wanted = F.lit(fmt.sheet) if fmt.sheet else F.get("sheets", F.lit(0))["sheet"]
    sheets = sheets.select("file_path", names.alias("names"), wanted.alias("wanted"))
    no_sheet = sheets.where(~F.array_contains("names", F.col("wanted"))).select(
        "file_path",
        F.concat(
            F.lit(f"no sheet named '{fmt.sheet}' (found: "), F.array_join("names", ", "), F.lit(")")
        ).alias("message"),
    )
    chosen = cells.join(
        sheets.select("file_path", F.col("wanted").alias("sheet")), ["file_path", "sheet"], "left_semi"
    )
    # A row has as many cells as its sheet has columns, so this group is small by nature.
    entries = F.collect_list(F.struct("col", "text", "kind"))
    by_row = chosen.groupBy("file_path", F.col("row").alias("source_row")).agg(
        entries.alias("e"), F.max("col").alias("last")
    )
    slots = F.sequence(F.lit(0), "last")
    texts = F.map_from_arrays(F.transform("e", lambda x: x["col"]), F.transform("e", lambda x: x["text"]))
    kinds = F.map_from_arrays(F.transform("e", lambda x: x["col"]), F.transform("e", lambda x: x["kind"]))
    by_row = by_row.withColumn("t", texts).withColumn("k", kinds).select(
        "file_path",
        "source_row",
        F.transform(slots, lambda i: F.element_at("t", i)).alias("cells"),
        F.transform(slots, lambda i: F.element_at("k", i)).alias("kinds"),
    )
    headers = by_row.where(F.col("source_row") == fmt.header_row).select(
        "file_path",
        F.col("file_path").alias("path"),
        F.transform("cells", lambda c: F.coalesce(strip(c), F.lit(""))).alias("headers"),
    )
    sized = sheets.select("file_path").join(no_sheet, "file_path", "left_anti")
    no_header = sized.join(headers, "file_path", "left_anti").select(
        "file_path", F.lit(f"header row {fmt.header_row} not found").alias("message")
    )
    records = by_row.where(
        (F.col("source_row") > fmt.header_row) & F.exists("cells", lambda c: ~is_blank(c))
    ).join(headers.select("file_path"), "file_path", "left_semi")
    errors = no_sheet.unionByName(no_header).withColumnRenamed("file_path", "path")
    return records, headers, errors
