"""File discovery, content fingerprints and readability."""

from __future__ import annotations

from collections.abc import Iterable
from fnmatch import translate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import Tenant
from .delimited import bare_path, literal_path, plain_path, same_path

FILE_COLUMNS = (
    "tenant_id string, feed string, path string, source_file string, file_size bigint, "
    "modified_at timestamp"
)

def _pattern(glob: str) -> str:
    """The regular expression of a file pattern, for names as a whole."""
    return translate(glob).removesuffix("\\Z").removesuffix("\\z") + "\\z"


def discover(spark: SparkSession, landing: str, tenants: Iterable[Tenant]) -> DataFrame:
    """Files waiting under ``<landing>/<tenant>/`` that match a feed's pattern.

    Spark's file source lists the folder, in parallel where it has many sub-folders, and no content is
    read; the feeds' patterns are a table that the listing is joined to. A file that matches the patterns of
    two feeds counts for both. Names that begin with ``_`` or ``.`` are files still on their way. A landing
    folder that does not exist yet holds no files.
    """
    patterns = spark.createDataFrame(
        [(t.tenant_id, feed, _pattern(cfg.files)) for t in tenants for feed, cfg in t.feeds.items()],
        "tenant_id string, feed string, pattern string",
    )
    root = spark._jvm.org.apache.hadoop.fs.Path(landing)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return spark.createDataFrame([], FILE_COLUMNS)
    base = F.lit(fs.makeQualified(root).toString())
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(literal_path(landing))
    below = F.substr(bare_path(F.col("path")), F.length(bare_path(base)) + 2)
    found = listed.select(
        F.split(below, "/").alias("parts"),
        "path",
        F.col("length").alias("file_size"),
        F.col("modificationTime").alias("modified_at"),
    ).where(F.size("parts") == 2)
    named = found.select(
        F.col("parts")[0].alias("tenant_id"), F.col("parts")[1].alias("source_file"), "path", "file_size", "modified_at"
    )
    mine = named.join(patterns, "tenant_id").where(F.rlike("source_file", F.col("pattern")))
    return mine.select("tenant_id", "feed", "path", "source_file", "file_size", "modified_at")


def _paths(files: DataFrame) -> list[str]:
    return [r["path"] for r in files.select("path").distinct().toLocalIterator()]


def fingerprints(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``files`` with ``file_sha256``, a digest of the content alone, at any size.

    Files are scanned in splits, however large. Every line is hashed with its number in the file, by two
    seeds; the sums of these and the file's size make up the digest, wherever the splits fall.
    """
    paths = _paths(files)
    if not paths:
        return files.withColumn("file_sha256", F.lit(None).cast("string"))
    lines = spark.read.text([literal_path(p) for p in paths]).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").cast("binary").alias("line"),
    )
    split = ["file_path", "block"]
    blocks = lines.groupBy(*split).agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = blocks.select(*split, "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    number = F.col("before") + F.col("pos") - F.col("first")

    def total(seed: int) -> Column:
        return F.sum(F.xxhash64(F.lit(seed), number, "line").cast("decimal(20,0)"))

    hashed = (
        lines.join(begins, split)
        .groupBy("file_path")
        .agg(F.concat_ws("|", F.count(F.lit(1)), total(1), total(2)).alias("content"))
        .select(plain_path("file_path").alias("__path"), "content")
    )
    joined = files.join(hashed, same_path(files["path"], hashed["__path"]), "left")
    whole = F.concat_ws("|", "file_size", F.coalesce("content", F.lit("")))
    return joined.withColumn("file_sha256", F.sha2(whole, 256)).drop("content", "__path")


def new_files(files: DataFrame, batches: DataFrame | None) -> DataFrame:
    """Files whose content was not ingested before for the tenant's feed, whatever came of it
    then, and the first of identical files in this run."""
    key = ["tenant_id", "feed", "file_sha256"]
    first = Window.partitionBy(*key).orderBy("modified_at", "source_file")
    fresh = files.withColumn("rn", F.row_number().over(first)).where(F.col("rn") == 1).drop("rn")
    return fresh if batches is None else fresh.join(batches.select(*key), key, "left_anti")


def pending_tenants(fresh: DataFrame) -> DataFrame:
    return fresh.select("tenant_id").distinct()
