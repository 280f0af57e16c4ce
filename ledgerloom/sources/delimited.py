"""Delimited files as numbered records of text cells.

Files are read line by line with the splittable text source, so a file of any size spreads over
many tasks. Lines arrive as raw bytes and are decoded in the expression (see
``functions.encodings``). Record numbers count blank records, as a spreadsheet does:

* position inside a split comes from ``monotonically_increasing_id``,
* offsets of the splits of a file come from one row per split,
* quoted cells may span lines. A line maps the quoting state before it (outside or inside a
  quoted cell) to the state after it. Only files with such lines pay for folding those maps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import SourceFormat
from ..functions.encodings import decoded, is_known, line_end
from ..functions.text import is_blank, strip
from ..session import workspace

def _field(d: str) -> tuple[str, str, str]:
    """Regular expressions of an unquoted cell, a quoted cell and an opened one."""
    plain = rf'(?:(?!")[^{d}]*+)'
    quoted = rf'(?:"[^"]*+(?:""[^"]*+)*+"(?!")[^{d}]*+)'
    opened = r'(?:"[^"]*+(?:""[^"]*+)*+)'
    return plain, quoted, opened


def _escape(delimiter: str) -> str:
    return "\\" + delimiter if delimiter in r"\^]-[&" else delimiter


def _ends_outside(text: Column, d: str) -> Column:
    """Whether a line that starts outside quotes also ends outside."""
    plain, quoted, _ = _field(d)
    whole = rf"(?s)\A(?:(?:{plain}|{quoted}){d})*+(?:{plain}|{quoted})\z"
    return ~F.contains(text, F.lit('"')) | text.rlike(whole)


def _closes_outside(text: Column, d: str) -> Column:
    """Whether a line that starts inside quotes ends outside."""
    plain, quoted, _ = _field(d)
    whole = (
        rf'(?s)\A[^"]*+(?:""[^"]*+)*+"(?!")[^{d}]*+'
        rf"(?:{d}(?:(?:{plain}|{quoted}){d})*+(?:{plain}|{quoted}))?\z"
    )
    return F.contains(text, F.lit('"')) & text.rlike(whole)


def literal_path(path: str) -> str:
    """A path that is not to be read as a glob."""
    return "".join("\\" + ch if ch in "[]{}*?" else ch for ch in path)


def _lines(spark: SparkSession, paths: Sequence[str], fmt: SourceFormat) -> DataFrame:
    # The split and the position in it identify a line. The id must be taken directly on the
    # scan, before anything can drop a row.
    reader, end = spark.read, line_end(fmt.encoding)
    if end is not None:
        reader = reader.option("lineSep", end)
    raw = reader.text([literal_path(p) for p in paths]).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").cast("binary").alias("bytes"),
    )
    # Other bytes make the file unreadable; here they only must not fail the job.
    ok, text = decoded(F.col("bytes"), fmt.encoding)
    lines = raw.select("file_path", "block", "pos", ok.alias("ok"), text.alias("line"))
    # Written once: both passes below must see the same splits, and how a scan is split depends
    # on the cores present when it is planned.
    staged = workspace(spark, "lines")
    lines.write.parquet(staged)
    return spark.read.parquet(staged)


def _number_lines(lines: DataFrame, d: str) -> tuple[DataFrame, DataFrame]:
    """Lines with their 0-based number in the file, and one row per file."""
    blocks = lines.groupBy("file_path", "block").agg(
        F.min("pos").alias("first_pos"),
        F.count(F.lit(1)).alias("n"),
        F.bool_or(~F.col("ok")).alias("bad"),
        F.bool_or(~_ends_outside(F.col("line"), d)).alias("multi"),
    )
    before = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    per_file = blocks.groupBy("file_path").agg(
        F.bool_or("bad").alias("bad"), F.bool_or("multi").alias("multi")
    )
    starts = offsets.select("file_path", "block", "first_pos", "offset").join(
        per_file.select("file_path", "multi"), "file_path"
    )
    numbered = lines.join(starts, ["file_path", "block"]).withColumn(
        "line_no", F.col("offset") + F.col("pos") - F.col("first_pos")
    )
    return numbered, per_file


def _fold_quoted(lines: DataFrame, d: str) -> tuple[DataFrame, DataFrame]:
    """Lines of files with multi-line cells -> records, numbered by record, and the files in which
    a quote is opened and never closed.

    Window groups are single splits, so they are bounded by the split size. The state at the
    start of a split follows from the composed maps of the splits before it.
    """
    text = F.col("line")
    mapped = lines.withColumn("o", F.when(_ends_outside(text, d), 0).otherwise(1)).withColumn(
        "i", F.when(_closes_outside(text, d), 0).otherwise(1)
    )
    # A line is constant (same end state from either start), a keep, or a swap.
    constant = F.col("o") == F.col("i")
    mapped = mapped.withColumn("const", F.when(constant, F.col("o"))).withColumn(
        "swap", F.when(~constant & (F.col("o") == 1), 1).otherwise(0)
    )

    def state_before(df: DataFrame, group: Sequence[str], order: str, start: Column) -> Column:
        """State before each element: that after the last constant, swapped as often as since."""
        up_to = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        swaps = F.coalesce(F.sum("swap").over(up_to), F.lit(0))
        anchor = F.last(
            F.when(F.col("const").isNotNull(), F.struct(F.col("const"), F.col("swaps_to")))
            , ignorenulls=True,
        ).over(up_to)
        base = F.coalesce(anchor["const"], start)
        since = swaps - F.coalesce(anchor["swaps_to"], F.lit(0))
        return (base + since) % 2

    def with_swaps_to(df: DataFrame, group: Sequence[str], order: str) -> DataFrame:
        through = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn("swaps_to", F.sum("swap").over(through))

    in_block = ["file_path", "block"]
    mapped = with_swaps_to(mapped, in_block, "pos")
    # The map of a whole split: its last constant and the parity of swaps after it.
    tail = mapped.groupBy(*in_block).agg(
        F.max_by("const", F.when(F.col("const").isNotNull(), F.col("pos"))).alias("const"),
        F.max(F.when(F.col("const").isNotNull(), F.col("pos"))).alias("const_pos"),
        F.max_by("swaps_to", F.when(F.col("const").isNotNull(), F.col("pos"))).alias("swaps_at_const"),
        F.sum("swap").alias("swaps"),
    )
    rest = F.col("swaps") - F.coalesce("swaps_at_const", F.lit(0))
    tail = tail.select(
        *in_block,
        F.when(F.col("const").isNotNull(), (F.col("const") + rest) % 2).alias("const"),
        F.when(F.col("const").isNotNull(), 0).otherwise(rest % 2).alias("swap"),
    )
    tail = with_swaps_to(tail, ["file_path"], "block")
    entry = tail.select(*in_block, state_before(tail, ["file_path"], "block", F.lit(0)).alias("entry"))
    staged = mapped.join(entry, in_block)
    starts = state_before(staged, in_block, "pos", F.col("entry")) == 0
    staged = staged.withColumn("starts", starts.cast("int"))
    counts = staged.groupBy(*in_block).agg(F.sum("starts").alias("records"))
    earlier = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("records_before", F.coalesce(F.sum("records").over(earlier), F.lit(0)))
    running = Window.partitionBy(*in_block).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    numbered = staged.join(counts.drop("records"), in_block).withColumn(
        "record", F.col("records_before") + F.sum("starts").over(running)
    )
    by_record = ["file_path", "record"]
    # A quote that is still open after the last line has swallowed the rest of its file.
    after = F.coalesce("const", (F.col("entry") + F.col("swap")) % 2)
    ends = tail.join(entry, in_block).groupBy("file_path").agg(F.max_by(after, "block").alias("inside"))
    runaway = ends.where("inside = 1").select("file_path")
    whole = numbered.join(runaway, "file_path", "left_anti")
    pieces = F.transform(
        F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda p: p["line"]
    )
    records = whole.groupBy(*by_record).agg(F.array_join(pieces, "\n").alias("text"))
    return records.withColumnRenamed("record", "source_row"), runaway


def _cells(text: Column, d: str, delimiter: str) -> Column:
    plain, quoted, opened = _field(d)
    # Every token ends with the delimiter; a cell left open at the end of the file takes the rest.
    token = rf"(?s)((?:{quoted}|{plain}){d}|{opened}\z)"
    tokens = F.regexp_extract_all(F.concat(text, F.lit(delimiter)), F.lit(token), F.lit(1))

    def clean(t: Column) -> Column:
        body = F.substring(t, F.lit(1), F.length(t) - 1)
        inner = F.regexp_extract(body, r'(?s)\A"([^"]*+(?:""[^"]*+)*+)"?(.*)\z', 1)
        trailing = F.regexp_extract(body, r'(?s)\A"([^"]*+(?:""[^"]*+)*+)"?(.*)\z', 2)
        unquoted = F.concat(F.replace(inner, F.lit('""'), F.lit('"')), trailing)
        return F.when(body.startswith('"'), unquoted).otherwise(body)

    simple = F.split(text, F.lit("\\" + delimiter if not delimiter.isalnum() else delimiter), -1)
    return F.when(F.contains(text, F.lit('"')), F.transform(tokens, clean)).otherwise(simple)


def unusable(spark: SparkSession, paths: Sequence[str], message: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Files of which none can be read, in the shape of :func:`read_delimited`."""
    return (
        spark.createDataFrame([], "file_path string, source_row bigint, cells array<string>"),
        spark.createDataFrame([], "file_path string, path string, headers array<string>"),
        spark.createDataFrame([(p, message) for p in paths], "path string, message string"),
    )


def read_delimited(
    spark: SparkSession, paths: Sequence[str], fmt: SourceFormat
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Read files of one format.

    Returns ``records`` (file_path, source_row, cells), ``headers`` (file_path, path, headers) and
    ``errors`` (path, message) for files that cannot be used. ``file_path`` is the scan's own,
    URL-encoded name of a file, ``path`` the plain one; decoding is left to the per-file tables.

    Blank records are dropped but numbered; the header is the first non-blank record numbered
    ``header_row`` or later; records before it are titles.
    """
    if not is_known(fmt.encoding):
        return unusable(spark, paths, f"we don't know the encoding {fmt.encoding!r}")
    d = _escape(fmt.delimiter)
    lines, per_file = _number_lines(_lines(spark, paths, fmt), d)
    text = F.when(F.col("line_no") == 0, F.regexp_replace("line", "\\A\ufeff", "")).otherwise(F.col("line"))
    lines = lines.withColumn("line", text)
    simple = lines.where(~F.col("multi")).select(
        "file_path", (F.col("line_no") + 1).alias("source_row"), F.col("line").alias("text")
    )
    folded, runaway = _fold_quoted(lines.where("multi"), d)
    cells = _cells(F.col("text"), d, fmt.delimiter)
    records = (
        simple.unionByName(folded)
        .withColumn("cells", cells)
        .where(F.exists("cells", lambda c: ~is_blank(c)))
        .drop("text")
    )
    at_header = (
        records.where(F.col("source_row") >= fmt.header_row)
        .groupBy("file_path")
        .agg(F.min_by(F.struct("source_row", "cells"), "source_row").alias("h"))
    )
    headers = at_header.select(
        "file_path",
        plain_path("file_path").alias("path"),
        F.col("h.source_row").alias("header_at"),
        F.transform("h.cells", lambda c: strip(c)).alias("headers"),
    )
    wrong = per_file.where("bad").select(
        "file_path", F.lit(f"file isn't {fmt.encoding} encoded").alias("message")
    )
    unclosed = runaway.select("file_path", F.lit("a quoted cell is never closed").alias("message"))
    # A file may be both; the first message is enough.
    bad = wrong.unionByName(unclosed).groupBy("file_path").agg(F.max("message").alias("message"))
    bad = bad.withColumn("path", plain_path("file_path"))
    found = headers.select("path").unionByName(bad.select("path"))
    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    empty = listed.join(found, same_path(listed["path"], found["path"]), "left_anti")
    errors = bad.select("path", "message").unionByName(
        empty.select("path", F.lit("file is empty").alias("message"))
    )
    good = headers.join(bad.select("file_path"), "file_path", "left_anti")
    data = records.join(good.select("file_path", "header_at"), "file_path").where(
        F.col("source_row") > F.col("header_at")
    )
    return data.drop("header_at"), good.drop("header_at"), errors


def plain_path(file_path: str) -> Column:
    return F.url_decode(F.replace(F.col(file_path), F.lit("+"), F.lit("%2B")))


def same_path(left: Column, right: Column) -> Column:
    """Scans report a path with or without its scheme's slashes; names are compared bare."""
    return bare_path(left) == bare_path(right)


def bare_path(path: Column) -> Column:
    return F.regexp_replace(path, r"\A[A-Za-z][A-Za-z0-9+.-]*:/+", "/")
