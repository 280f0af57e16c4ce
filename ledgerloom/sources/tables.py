"""Append-only parquet tables whose writes become visible together.

Each run writes its rows for every table under ``gen=<n>`` and finishes with one small commit
row that names the tables it wrote. Readers only look at what a commit names, so that what a run
that died half way left behind stays invisible, whichever run takes its number. One writer at a time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GEN = "gen"
COMMIT = "gen int, base int, note string, at timestamp_ntz, tables array<string>"


class Tables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._written: set[str] = set()

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def _commits(self) -> list:
        """Commit rows since the last compaction decide what is visible; older ones are few."""
        path = f"{self.root}/_commits"
        if not self._exists(path):
            return []
        return self.spark.read.schema(COMMIT).parquet(path).orderBy("gen").collect()

    def last(self) -> int:
        commits = self._commits()
        return commits[-1]["gen"] if commits else 0

    def begin(self) -> int:
        """The generation of a new run, which has written nothing yet."""
        self._written = set()
        return self.last() + 1

    def base(self) -> int:
        return max((c["base"] for c in self._commits()), default=0)

    def notes(self) -> set[str]:
        return {c["note"] for c in self._commits() if c["note"]}

    def write(self, table: str, gen: int, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        if partition_by:
            # Few files per partition; partitions beyond the target size are split again.
            df = df.hint("rebalance", *[F.col(c) for c in partition_by])
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.root}/{table}/{GEN}={gen}")
        self._written.add(table)

    def commit(self, gen: int, at: dt.datetime, note: str = "", base: int = 0) -> None:
        df = self.spark.createDataFrame([(gen, base, note, at, sorted(self._written))], COMMIT)
        df.coalesce(1).write.mode("append").parquet(f"{self.root}/_commits")

    def read(
        self, table: str, since: int = 0, history: bool = False, schema: str | None = None
    ) -> DataFrame | None:
        """Committed rows with their ``gen``, or None if there are none. With ``schema``, columns that
        older files lack are null.

        ``since`` excludes older generations. A compacted generation replaces those before it;
        ``history`` reads them all, for logs that are only ever appended to.
        """
        commits = self._commits()
        if not commits:
            return None
        base = 0 if history else max(c["base"] for c in commits)
        low = max(base, since)
        paths = [f"{self.root}/{table}/{GEN}={c['gen']}" for c in commits if c["gen"] >= low and table in c["tables"]]
        if not paths:
            return None
        reader = self.spark.read.option("basePath", f"{self.root}/{table}")
        if schema:
            reader = reader.schema(f"{schema}, {GEN} int")
        return reader.parquet(*paths)

    def written(self, table: str, gen: int, schema: str | None = None) -> DataFrame:
        """What this run wrote for a table, before its commit: reading it back cuts the lineage. Tables in
        partitions need their ``schema``: names of folders alone do not tell a column's type."""
        path = f"{self.root}/{table}"
        reader = self.spark.read.option("basePath", path)
        if schema:
            reader = reader.schema(f"{schema}, {GEN} int")
        return reader.parquet(f"{path}/{GEN}={gen}").withColumn(GEN, F.lit(gen))
