"""Spark side of every registered query."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import contracts
from ledgerloom.config import ParseOptions, Tenant
from ledgerloom.functions.coerce import coerce, stored
from ledgerloom.operators import access, checks, quarantine, reports
from ledgerloom.operators.dedupe import latest_per_key
from ledgerloom.operators.mapping import config_frame, file_layouts, map_columns
from ledgerloom.operators.upgrade import upgrade
from ledgerloom.operators.validate import batch_status as status_of
from ledgerloom.operators.validate import is_accepted, reference_status, validate
from ledgerloom.plans import dims, events, facts, monitoring, reporting, staging
from ledgerloom.plans.onboarding import Onboarding
from ledgerloom.sources.files import pending_tenants
from ledgerloom.session import staged, workspace
from ledgerloom.streaming.bucketed import BucketedMarts, start

from .landing import land, runs, tenants
from .views import spark_sql, table, view

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
AS_OF = dt.datetime(2024, 2, 1)


def plain(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, decimals as doubles: the same in any client."""
    casts = {}
    for name, type_ in df.dtypes:
        if type_ == "timestamp_ntz":
            casts[name] = F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif type_ == "date":
            casts[name] = F.date_format(name, "yyyy-MM-dd")
        elif type_.startswith("decimal"):
            casts[name] = F.col(name).cast("double")
    return df.withColumns(casts) if casts else df


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(fn(spark, sf_dir))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    REGISTRY[fn.__name__] = run
    return fn


def _tenants(spark: SparkSession, d: str) -> DataFrame:
    return dims.dim_tenant(view(spark, d, "tenants"))


def _stg(spark: SparkSession, d: str) -> DataFrame:
    raw = view(spark, d, "raw_app_events")
    return staging.stg_app_events(raw)


def _events(spark: SparkSession, d: str) -> DataFrame:
    return events.dedupe_events(_stg(spark, d))


def _fct(spark: SparkSession, d: str) -> DataFrame:
    return facts.fct_maintenance_events(_events(spark, d), _tenants(spark, d))


def _buildings(spark: SparkSession, d: str) -> DataFrame:
    reported = staging.stg_buildings(view(spark, d, "raw_buildings"))
    return dims.dim_building(reported, _events(spark, d), _tenants(spark, d))


def _sales(spark: SparkSession, d: str) -> DataFrame:
    stg = staging.stg_commissary_transactions(view(spark, d, "raw_sales"))
    return facts.fct_commissary_sales(stg, _tenants(spark, d))


@query
def stg_app_events(spark, d):
    return _stg(spark, d)


@query
def payload_rejects(spark, d):
    """Device payloads with a number nobody can read: here an acid pH is written out as a word."""
    raw = view(spark, d, "raw_app_events").withColumn(
        "payload", F.regexp_replace("payload", '"ph":6[.][0-9]+', '"ph":"six"')
    )
    return staging.payload_rejects(raw).select(
        "event_id", "upload_id", F.array_join("unreadable_fields", ",").alias("unreadable_fields")
    )


@query
def dedupe_events(spark, d):
    return _events(spark, d)


@query
def latest_per_key_sales(spark, d):
    return latest_per_key(view(spark, d, "raw_sales"), ["transaction_id", "line_number"])


@query
def dim_tenant(spark, d):
    return _tenants(spark, d)


@query
def dim_building(spark, d):
    return _buildings(spark, d)


@query
def dim_asset(spark, d):
    reported = staging.stg_assets(view(spark, d, "raw_assets"))
    return dims.dim_asset(reported, _events(spark, d), _tenants(spark, d))


@query
def dim_staff(spark, d):
    reported = staging.stg_staff(view(spark, d, "raw_staff"))
    return dims.dim_staff(reported, _events(spark, d), _tenants(spark, d))


@query
def maintenance_by_calendar(spark, d):
    """The date dimension joined to the event fact on the tenant-local day; events outside the
    calendar are kept without its attributes."""
    days = dims.dim_date(spark, AS_OF.date())
    return (
        _fct(spark, d)
        .join(days, F.col("event_date_local") == F.col("date_day"), "left")
        .groupBy("year", "month", "day_of_week", "is_weekend")
        .agg(F.count(F.lit(1)).alias("events"), F.sum("labor_minutes").alias("labor_minutes"))
    )


@query
def fct_maintenance_events(spark, d):
    return _fct(spark, d)


@query
def fct_work_orders(spark, d):
    return facts.fct_work_orders(_fct(spark, d))


@query
def fct_waterfront_checks(spark, d):
    return facts.fct_waterfront_checks(_events(spark, d), _tenants(spark, d))


@query
def fct_commissary_sales(spark, d):
    return _sales(spark, d)


@query
def rpt_maintenance_daily(spark, d):
    return reporting.rpt_maintenance_daily(_fct(spark, d))


@query
def rpt_commissary_daily(spark, d):
    return reporting.rpt_commissary_daily(_sales(spark, d))


@query
def rpt_work_order_backlog(spark, d):
    orders = facts.fct_work_orders(_fct(spark, d))
    return reporting.rpt_work_order_backlog(orders, _buildings(spark, d))


@query
def mon_event_delivery(spark, d):
    stg = _stg(spark, d)
    return monitoring.mon_event_delivery(stg, events.dedupe_events(stg))


@query
def source_freshness(spark, d):
    return monitoring.source_freshness(view(spark, d, "raw_app_events"), AS_OF)


@query
def tenant_view(spark, d):
    """A reader role that may see two tenants, over the event fact."""
    grants = spark_sql(
        spark,
        d,
        "select 'americas_reader' as role_name, r_name as tenant_id from {region} "
        "where r_name in ('AMERICA', 'AFRICA')",
    )
    return access.tenant_view(_fct(spark, d), "americas_reader", grants)


@query
def check_unique(spark, d):
    return checks.unique(view(spark, d, "raw_sales"), "transaction_id")


@query
def check_unique_combination(spark, d):
    sales = view(spark, d, "raw_sales")
    return checks.unique_combination(sales, ["tenant_id", "transaction_id", "line_number"])


@query
def check_not_null(spark, d):
    return checks.not_null(_stg(spark, d), "asset_tag").select("event_id", "upload_id")


@query
def check_relationships(spark, d):
    """Building keys in the facts that the reported list, without inferred members, lacks."""
    listed = _buildings(spark, d).where(~F.col("is_inferred"))
    failures = checks.relationships(_fct(spark, d), "building_key", listed, "building_key")
    return failures.select("event_id", "building_key")


@query
def check_accepted_values(spark, d):
    failures = checks.accepted_values(_fct(spark, d), "event_action", ["opened", "completed"])
    return failures.select("event_id", "event_action")


@query
def check_accepted_range(spark, d):
    every = table(spark, d, "supplier").select(
        F.concat(F.lit("SUP-"), F.col("s_suppkey").cast("string")).alias("building_code"),
        F.col("s_suppkey").cast("int").alias("capacity"),
    )
    failures = checks.accepted_range(every, "capacity", min_value=10)
    return failures.select("building_code", "capacity")


# Coercion and mapping

US = ParseOptions(("%m/%d/%Y",), ("%m/%d/%Y %H:%M",))


def _coerced(df: DataFrame, text: str, type_: str, keys: list[str], zone: str = "UTC") -> DataFrame:
    c = coerce(F.col(text), type_, US, zone)
    return df.select(*keys, stored(c.value, type_).alias("value"), c.error.alias("error"))


@query
def coerce_decimal(spark, d):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"]
    texts = view(spark, d, "amount_texts")
    return _coerced(texts, "amount", "decimal", keys)


@query
def coerce_date(spark, d):
    return _coerced(view(spark, d, "date_texts"), "day_text", "date", ["o_orderkey"])


@query
def coerce_timestamp(spark, d):
    texts = view(spark, d, "time_texts")
    return _coerced(texts, "time_text", "timestamp", ["event_id"], "America/New_York")


@query
def coerce_integer(spark, d):
    texts = view(spark, d, "sales_texts")
    return _coerced(texts, "quantity", "integer", ["batch_id", "source_row", "transaction_id", "line_number"])


@query
def coerce_boolean(spark, d):
    """Market segments as yes/no cells: most are neither."""
    sql = """select c_custkey, case c_mktsegment when 'FURNITURE' then ' Yes' when 'MACHINERY' then 'F'
             when 'BUILDING' then 'x' when 'HOUSEHOLD' then '' else c_mktsegment end as t from {customer}"""
    return _coerced(spark_sql(spark, d, sql), "t", "boolean", ["c_custkey"])


def _order_tenant(tenant_id: str) -> Tenant:
    feed = {
        "contract": "commissary_transactions@1",
        "files": "*.csv",
        "columns": {"Order no.": "transaction_id", "Urgency": "payment_method", "Shipped": "sold_at"},
        "values": {"payment_method": {"1-Urgent": "camper_account", "2-High": "cash", "5-low": "card"}},
    }
    return Tenant.from_dict(
        {"tenant_id": tenant_id, "timezone": "UTC", "feeds": {"commissary_transactions": feed}}
    )


@query
def map_values(spark, d):
    """Orders as one file per status: loose headers, translated and untranslated values."""
    files = spark_sql(
        spark,
        d,
        """select o_orderstatus as batch_id, o_orderstatus as tenant_id, 'commissary_transactions' as feed,
           '/in/' || o_orderstatus as path, o_orderstatus as source_file,
           cast('2024-01-01 00:00:00' as timestamp) as loaded_at, '/in/' || o_orderstatus as file_path,
           array('  ORDER   no. ', 'urgency', 'Clerk') as headers from {orders} group by o_orderstatus""",
    )
    records = spark_sql(
        spark,
        d,
        """select '/in/' || o_orderstatus as file_path, o_orderkey as source_row,
           array(cast(o_orderkey as string), ' ' || lower(o_orderpriority) || '  ', 'x') as cells
           from {orders}""",
    )
    config = config_frame(spark, [_order_tenant(t) for t in "FOP"])
    layouts = file_layouts(files.drop("file_path", "headers"), files.select("file_path", "path", "headers"), config)
    mapped = map_columns(records, layouts)
    return mapped.select(
        "batch_id",
        "source_row",
        F.element_at("raw", F.lit("transaction_id")).alias("transaction_id"),
        F.element_at("raw", F.lit("payment_method")).alias("payment_method"),
        F.element_at("raw", F.lit("sold_at")).isNull().alias("sold_at_missing"),
        F.array_join("missing_columns", ",").alias("missing_columns"),
    )


# Validation and quarantine

SALES = contracts.registry().get("commissary_transactions@1")


def _sales_rows(spark: SparkSession, d: str) -> DataFrame:
    texts = view(spark, d, "sales_texts")
    fields = [F.lit(n) for n in SALES.fields]
    labels = F.map_from_arrays(F.array(*fields), F.array(*fields))
    missing = F.when(F.col("lacks_payment"), F.array(F.lit("payment_method"))).otherwise(
        F.array().cast("array<string>")
    )
    return texts.select(
        "batch_id",
        "tenant_id",
        F.lit(SALES.feed).alias("feed"),
        "source_row",
        F.lit("UTC").alias("timezone"),
        F.lit(0).alias("profile"),
        F.map_from_arrays(F.array(*fields), F.array(*SALES.fields)).alias("raw"),
        labels.alias("labels"),
        missing.alias("missing_columns"),
        F.col("sent_on").alias("loaded_at"),
    )


def _reference_lists(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The two lists that sales refer to: an index of loaded keys, kept step by step, and the keys of rows
    that wait in quarantine."""
    statuses = {}
    lists = (
        ("store_building_code", "buildings", "building_code", "raw_buildings", "held_buildings"),
        ("cashier_staff_code", "staff", "staff_code", "raw_staff", "held_staff"),
    )
    for name, feed, field, loaded, waiting in lists:
        path = workspace(spark, f"keys-{feed}")
        for step in range(2):  # two loads, of which the second brings keys again
            rows = view(spark, d, loaded).where(F.col("_source_row") % 3 >= 1 - step)
            index = spark.read.schema(quarantine.INDEX).parquet(path) if step else None
            quarantine.new_keys(rows, field, index).write.mode("append").parquet(path)
        index = spark.read.schema(quarantine.INDEX).parquet(path)
        held = view(spark, d, waiting).select("tenant_id", F.lit(feed).alias("feed"), F.col("code").alias("record_key"))
        statuses[name] = reference_status(index, quarantine.held_keys(held, feed))
    return statuses


def _sales_validated(spark: SparkSession, d: str) -> DataFrame:
    return validate(
        _sales_rows(spark, d), SALES, [ParseOptions()], _reference_lists(spark, d), lambda df: staged(df, "validated")
    )


@query
def validate_rows(spark, d):
    done = _sales_validated(spark, d)
    rules = F.transform("violations", lambda v: F.concat_ws(":", v["rule"], v["field"]))
    return done.select(
        "batch_id",
        "source_row",
        "record_key",
        F.array_join(rules, ",").alias("rules"),
        F.size("file_violations").alias("file_problems"),
        F.col("record.quantity").alias("quantity"),
    )


@query
def duplicate_keys(spark, d):
    done = _sales_validated(spark, d)
    found = done.select("batch_id", "source_row", F.explode("violations").alias("v"))
    return found.where(F.col("v.rule") == "duplicate_key").select(
        "batch_id", "source_row", F.col("v.value").alias("record_key"), F.col("v.message").alias("message")
    )


@query
def reference_check(spark, d):
    done = _sales_validated(spark, d)
    found = done.select("tenant_id", F.explode("violations").alias("v"))
    wanted = found.where(F.col("v.rule").isin("unknown_reference", "held_reference"))
    return wanted.groupBy(
        "tenant_id",
        F.col("v.rule").alias("rule"),
        F.col("v.field").alias("field"),
        F.col("v.value").alias("value"),
    ).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def violation_groups(spark, d):
    held = _sales_validated(spark, d).where(~is_accepted())
    groups = reports.violation_groups(held, stage=lambda df: staged(df, "problems"))
    shown = F.transform("examples", lambda v: v["source_row"].cast("string"))
    return groups.select(
        "batch_id", "position", "rule", "column", "count", F.array_join(shown, ",").alias("example_rows"),
        F.col("more").cast("bigint").alias("more"),
    )


def _sales_batches(done: DataFrame) -> DataFrame:
    totals = done.groupBy("batch_id", "tenant_id", "feed").agg(
        F.count(F.lit(1)).alias("rows_received"),
        F.count_if(is_accepted()).alias("rows_loaded"),
        F.count_if(~is_accepted()).alias("rows_quarantined"),
        F.max(F.size("file_violations") > 0).alias("rejected"),
        F.max("loaded_at").alias("finished_at"),
    )
    status = status_of(F.col("rejected"), F.col("rows_quarantined"))
    return totals.withColumn("batch_status", status).drop("rejected")


@query
def batch_status(spark, d):
    return _sales_batches(_sales_validated(spark, d))


def _sales_outcomes(done: DataFrame) -> DataFrame:
    """What became of each row, without the words: a row is decided once, however many steps ask for it."""
    columns = ["batch_id", "tenant_id", "feed", "source_row", "record_key", "loaded_at", "accepted", "file_violations"]
    return staged(done.select(*columns), "outcomes")


def _sales_resolutions(done: DataFrame) -> tuple[DataFrame, DataFrame]:
    held = done.where(~is_accepted()).withColumnRenamed("loaded_at", "quarantined_at")
    return held, quarantine.resolutions(held, done.where(is_accepted()), lambda df: staged(df, "closed"))


@query
def quarantine_resolution(spark, d):
    """Which held sale lines a later year's file closed, and when."""
    _, closed = _sales_resolutions(_sales_outcomes(_sales_validated(spark, d)))
    return closed.select("batch_id", "source_row", "resolved_batch_id", "resolved_at")


@query
def mon_ingestion_quality(spark, d):
    done = _sales_outcomes(_sales_validated(spark, d))
    held, closed = _sales_resolutions(done)
    # Line items may share a source row, so resolutions are counted per (batch, row) first.
    closed = closed.groupBy("batch_id", "source_row").agg(
        F.min("resolved_batch_id").alias("resolved_batch_id"), F.min("resolved_at").alias("resolved_at")
    )
    rows = quarantine.with_resolution(held, closed).withColumn("source_file", F.col("batch_id"))
    return monitoring.mon_ingestion_quality(
        _sales_batches(done), staging.stg_quarantine(rows), _tenants(spark, d)
    )


@query
def contract_upgrade(spark, d):
    registry = contracts.registry()
    v1 = view(spark, d, "raw_assets").select(
        "tenant_id", "asset_tag", "asset_name", "building_code", "purchased_on",
        F.col("purchase_cost").alias("purchase_price"),
    )
    return upgrade(v1, registry.get("assets@1"), registry)


# Onboarding: files written from the given tables, ingested in two runs

@query
def pending_files(spark, d):
    """What waits in the landing folder before the first run, of files that match a pattern."""
    folder = workspace(spark, "landing")
    land(spark, d, folder, 1)
    job = Onboarding(spark, workspace(spark, "raw"), contracts.registry(), tenants(spark, d))
    fresh = staged(job.pending(folder), "pending")
    return fresh.join(pending_tenants(fresh), "tenant_id").select("tenant_id", "feed", "source_file")


@query
def results_of_runs(spark, d):
    """What came of each file in both runs, skipped files included."""
    return runs(spark, d).results.drop("file_sha256")


@query
def raw_after_ingest(spark, d):
    """Assets of both runs, typed and upgraded to the latest contract."""
    return runs(spark, d).job.raw("assets").select(
        "tenant_id", "asset_tag", "asset_name", "category", "building_code", "purchased_on", "purchase_cost",
        "status", F.col("_source_file").alias("source_file"), F.col("_source_row").alias("source_row"),
        F.col("_contract_version").alias("contract_version"),
    )


@query
def quarantine_after_ingest(spark, d):
    """Every held row, its rules and cells, and the file that closed it."""
    done = runs(spark, d)
    by = done.files().select(F.col("batch_id").alias("resolved_batch_id"), F.col("source_file").alias("resolved_by"))
    rules = F.from_json("violations", "array<struct<rule:string>>")["rule"]
    name = F.when(F.col("feed") == "buildings", F.get_json_object("record", "$.building_name"))
    return done.job.quarantine().join(by, "resolved_batch_id", "left").select(
        "tenant_id", "feed", "source_file", "source_row", "record_key", F.array_join(rules, ",").alias("rules"),
        F.coalesce(name, F.lit("")).alias("building_name"), "resolved_by",
    )


@query
def open_quarantine(spark, d):
    """Rows that still wait on a fix, of the tenant ASIA only."""
    return runs(spark, d).job.open_quarantine("ASIA").select("tenant_id", "feed", "source_file", "source_row", "record_key")


@query
def rows_to_fix(spark, d):
    """The listings for tenants as written, read back from the files."""
    done = runs(spark, d)
    files = f"{done.job.reports}/buildings/*/rows_to_fix"
    lists = spark.read.option("header", True).option("escape", '"').csv(f"{files}/*/*/*/*")
    batch = F.regexp_extract(F.input_file_name(), "batch_id=([^/]*)", 1)
    told = lists.select(
        batch.alias("batch_id"), F.col("Row in your file").cast("bigint").alias("source_row"), F.col("Code").alias("code"),
        F.coalesce("House", F.lit("")).alias("house"), F.col("What to fix").alias("fix"),
    )
    return told.join(done.job.batches().select("batch_id", "tenant_id", "source_file"), "batch_id").drop("batch_id")


@query
def run_totals(spark, d):
    """Totals of the second run."""
    job = runs(spark, d).job
    second = job.batches().where(F.col("started_at") == F.lit(dt.datetime(2024, 1, 2)).cast("timestamp_ntz"))
    closed = job.quarantine().join(
        second.select(F.col("batch_id").alias("resolved_batch_id")), "resolved_batch_id", "left_semi"
    )
    return monitoring.run_summary(second, closed)


# Incremental and streaming

def _streamed(spark: SparkSession, d: str, batches: int, wanted: list[str], by_marks: bool = False) -> BucketedMarts:
    """All copies as upload files, a file or more for each day of the month, through the streaming job in
    about so many micro-batches. Days lie apart in the files' order, so that copies received earlier land
    later."""
    raw = view(spark, d, "raw_app_events")
    shown = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    event = F.struct(
        "event_id", "device_id", "device_seq", "event_type",
        F.date_format("occurred_at", shown).alias("occurred_at"), "payload",
    )
    sent = raw.groupBy("upload_id", "tenant_id", "device_id", "received_at").agg(
        F.collect_list(event).alias("events")
    )
    folder = workspace(spark, "uploads")
    # The order in which the days are listed: 0, 5, 10, ... 1, 6, ...
    day = F.dayofmonth(F.col("received_at").cast("date"))
    part = F.format_string("%d-%02d", day % 5, day).alias("part")
    files = sent.select("*", part).withColumn("received_at", F.date_format("received_at", shown))
    files.hint("rebalance", F.col("part")).write.partitionBy("part").json(folder)
    n = len(spark.read.text(f"{folder}/*").inputFiles())
    marts = BucketedMarts(
        spark, workspace(spark, "marts"), _tenants(spark, d), buckets=16, marts=wanted, by_marks=by_marks
    )
    run = start(
        spark, f"{folder}/*", workspace(spark, "stream"), marts, max_files=-(-n // batches), refresh=bool(wanted)
    )
    run.awaitTermination()
    if run.exception() is not None:
        raise run.exception()
    return marts


@query
def incremental_work_orders(spark, d):
    return _streamed(spark, d, 3, ["fct_work_orders"]).work_orders().drop("_loaded_at")


@query
def incremental_maintenance_daily(spark, d):
    return _streamed(spark, d, 3, ["rpt_maintenance_daily"]).daily().drop("_refreshed_at")


@query
def incremental_fct_maintenance_events(spark, d):
    """Each run takes up what was stored from its own target's high-water mark on."""
    return _streamed(spark, d, 3, ["facts_by_day"], by_marks=True).maintenance_events().drop("_loaded_at")


@query
def incremental_waterfront_checks(spark, d):
    return _streamed(spark, d, 3, ["checks"], by_marks=True).waterfront_checks().drop("_loaded_at")


@query
def streamed_dedupe(spark, d):
    """At least 16 upload files in 4 micro-batches; ids are looked up in the state store."""
    return _streamed(spark, d, 4, []).events().drop("_loaded_at")
