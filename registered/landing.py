"""Exports of five tenants, written from the given tables, and two onboarding runs over them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import contracts
from ledgerloom.config import Tenant
from ledgerloom.plans.onboarding import Onboarding
from ledgerloom.session import staged, workspace

from .views import table, view

FEEDS = {
    "buildings": {
        "contract": "buildings@1",
        "files": "buildings*.csv",
        "columns": {"Code": "building_code", "House": "building_name", "Used as": "building_type", "Beds": "capacity"},
        "values": {"building_type": {"Cabin": "cabin", "Camp store": "store"}},
    },
    "assets": {
        "contract": "assets@1",
        "files": "assets*.csv",
        "columns": {
            "Tag": "asset_tag", "What": "asset_name", "House": "building_code", "Bought": "purchased_on",
            "Price": "purchase_price",
        },
        "parse": {"date_formats": ["%m/%d/%Y"]},
    },
}
CELLS = {
    "buildings": {"Code": "code", "House": "name", "Used as": "kind", "Beds": "beds"},
    "assets": {"Tag": "tag", "What": "name", "House": "home", "Bought": "bought", "Price": "price"},
}


def tenants(spark: SparkSession, d: str) -> list[Tenant]:
    names = [r["r_name"] for r in table(spark, d, "region").select("r_name").collect()]
    return [Tenant.from_dict({"tenant_id": n, "timezone": "UTC", "feeds": FEEDS}) for n in sorted(names)]


def land(spark: SparkSession, d: str, landing: str, step: int) -> None:
    """The files of a step; files of 100,000 keys at most, so their number grows with the tables. With the
    second step each buildings file of the first arrives once more under another name."""
    for feed, cells in CELLS.items():
        rows = view(spark, d, f"sent_{feed}")
        sent = rows.where(F.col("step") == step)
        if step == 2 and feed == "buildings":
            copies = rows.where(F.col("step") == 1)
            sent = sent.unionByName(copies.withColumn("file", F.replace("file", F.lit("s-1-"), F.lit("s-copy-"))))
        place = ["tenant_id", "file"]
        lines = sent.select(
            *[F.coalesce(c, F.lit("")).alias(c) for c in place],
            "again",
            "k",
            *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(h) for h, c in cells.items()],
        )
        folder = workspace(spark, "exports")
        # A given number of partitions is not merged for being small: files are written side by side.
        spread = lines.repartition(spark.sparkContext.defaultParallelism, *place)
        ordered = spread.sortWithinPartitions(*place, "again", "k").drop("again", "k")
        ordered.write.partitionBy(*place).option("header", True).option("emptyValue", "").csv(folder)
        _deliver(spark, folder, landing)


def _deliver(spark: SparkSession, folder: str, landing: str) -> None:
    """Tenants name their files themselves: each written file moves to ``<landing>/<tenant>/<file>``."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    made: set[str] = set()
    for status in fs.globStatus(path(f"{folder}/tenant_id=*/file=*/part-*")):
        source = status.getPath()
        name, tenant = (p.getName().split("=", 1)[1] for p in (source.getParent(), source.getParent().getParent()))
        if tenant not in made:
            fs.mkdirs(path(landing, tenant))
            made.add(tenant)
        fs.rename(source, path(f"{landing}/{tenant}/{name}"))


class Runs:
    """Two landings, each followed by a run."""

    def __init__(self, spark: SparkSession, d: str, steps: int = 2):
        landing = workspace(spark, "landing")
        self.job = Onboarding(
            spark, workspace(spark, "raw"), contracts.registry(), tenants(spark, d), workspace(spark, "reports")
        )
        results: list[DataFrame] = []
        for step in range(1, steps + 1):
            land(spark, d, landing, step)
            self.job.ingest(landing, run_at=dt.datetime(2024, 1, step))
            results.append(self.job.results().withColumn("run", F.lit(step)))
        self.results = staged(results[0] if steps == 1 else results[0].unionByName(results[1]), "results")

    def files(self) -> DataFrame:
        return self.job.batches().select("batch_id", "source_file")


_RUNS: dict[tuple[str, str, int], Runs] = {}


def runs(spark: SparkSession, d: str, steps: int = 2) -> Runs:
    """The runs over these tables, made once a session: several queries read the tables they leave."""
    key = (spark.sparkContext.applicationId, d.rstrip("/"), steps)
    if key not in _RUNS:
        _RUNS[key] = Runs(spark, d, steps)
    return _RUNS[key]
