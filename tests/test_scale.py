"""What keeps validation in proportion to its rows: cells in a plain form, plans the JVM compiles, single passes."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F
from test_validate import BERTHS, GERMAN, frame, rows_of

from ledgerloom.config import ParseOptions
from ledgerloom.functions.coerce import coerce, quick, stored
from ledgerloom.functions.text import collapse, is_collapsed
from ledgerloom.operators.reports import violation_groups
from ledgerloom.operators.validate import check_fields, is_accepted, reference_status, validate
from registered import queries

CELLS = [
    None, "", " ", "7", "007", "-0", "-12", "+5", "999999999", "1000000000", "9999999999", "1,204", "1.204", "7.0", "7.5",
    "$4.10", "€ 4.10", "£-3.5", "$", "-$5", "(5.00)", "9999999999.99", "99999999999", "0.005", "1.", ".5", "1,5", "€7,25",
    "1e3", "2024-02-29", "2023-02-29", "0000-01-01", "0001-01-01", "2024-13-01", " 2024-01-02", "2024-01-02 ",
    "2024-01-02T03:04", "2024-01-02 03:04:05", "2024-03-10T02:30", "2024-01-02T24:00", "2024-01-02 23:59:60",
    "2024-01-02T03:04:05.5", "2024-01-02T03:04:05Z", "20240102", "٣", "2024-01-02\n", "7\n",
]


@pytest.mark.parametrize("type_", ["integer", "decimal", "date", "timestamp"])
@pytest.mark.parametrize("opts", [ParseOptions(), ParseOptions(decimal_separator=",")])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_plain_cells_read_as_by_the_rules(spark, type_, opts, zone):
    cells = spark.createDataFrame([(c, zone) for c in CELLS], "t string, z string")
    slow = coerce(F.col("t"), type_, opts, F.col("z"))
    fast = quick(F.col("t"), type_, opts, F.col("z"))
    done = cells.select(
        "t", stored(slow.value, type_).cast("string").alias("slow"), fast.cast("string").alias("fast")
    ).collect()
    assert [(r.t, r.fast) for r in done if r.fast is not None] == [(r.t, r.slow) for r in done if r.fast is not None]
    assert any(r.fast is not None for r in done)


def test_tenants_formats_go_before_the_plain_form(spark):
    assert quick(F.col("t"), "date", GERMAN) is None
    assert quick(F.col("t"), "timestamp", GERMAN) is None


def test_collapsed_texts_are_told_apart(spark):
    texts = ["", "a", "a b", "a  b", " a", "a ", "a\tb", "a b", "a　b", "Käse", "a ", "a\nb", "\x1c"]
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    done = rows.select("t", is_collapsed(F.col("t")).alias("ok"), collapse(F.col("t")).alias("c")).collect()
    assert all(r.t == r.c for r in done if r.ok)
    assert [r.t for r in done if r.ok] == ["", "a", "a b"]


def test_no_projection_of_fields_is_one_method(spark, tmp_path):
    """Whole-stage code of all fields is larger than what the JVM compiles."""
    frame(spark, {"f": rows_of(1, 5, 0.1)}).write.parquet(str(tmp_path / "rows"))
    checked = check_fields(spark.read.parquet(str(tmp_path / "rows")), BERTHS, [GERMAN])
    plan = checked._jdf.queryExecution().executedPlan().toString()
    projections = re.findall(r"^[ :+-]*(\*\(\d+\) )?Project ", plan, re.M)
    assert projections and not any(projections)


def test_cells_come_back_as_they_were(spark):
    none = spark.createDataFrame([], "tenant_id string, code string")
    row = {"harbour": "  Kiel ", "berth": "007", "hull": "AB1234", "kind": "sail", "draught": "9,9", "since": None, "owner": None}
    few = {"owner": "x", "kind": "oar", "berth": "8"}
    rows = frame(spark, {"b": [row, few]})
    done = validate(rows, BERTHS, [GERMAN], {"owner": reference_status(none, none)}).orderBy("source_row").collect()
    assert [r.raw for r in done] == [row, few]


def test_problems_are_put_into_words_once(spark):
    """Groups and examples read what was staged, not the rows again."""
    none = spark.createDataFrame([], "tenant_id string, code string")
    rows = frame(spark, {f"file{i}": rows_of(i, 60, 0.4) for i in range(2)})
    held = validate(rows, BERTHS, [GERMAN], {"owner": reference_status(none, none)}).where(~is_accepted())
    taken = []

    def stage(df):
        taken.append(df.collect())
        return spark.createDataFrame(taken[-1], df.schema)

    order = ["batch_id", "position"]
    staged = violation_groups(held, stage=stage).orderBy(*order)
    assert staged.collect() == violation_groups(held).orderBy(*order).collect()
    assert len(taken) == 1


@pytest.mark.parametrize("name", ["quarantine_resolution", "mon_ingestion_quality"])
def test_outcomes_are_staged_once_without_words(spark, monkeypatch, name):
    purposes = {}

    def stage(df, purpose):
        purposes.setdefault(purpose, []).append(df.columns)
        return df

    read = spark.createDataFrame(
        [("b1", "AFRICA", "f", 2, "k", dt.datetime(2024, 1, 1), False, []), ("b2", "AFRICA", "f", 2, "k", dt.datetime(2024, 1, 2), True, [])],
        "batch_id string, tenant_id string, feed string, source_row bigint, record_key string, loaded_at timestamp_ntz, "
        "accepted boolean, file_violations array<string>",
    ).withColumn("violations", F.array(F.lit("words")))
    tenants = spark.createDataFrame([("AFRICA", "Camp")], "tenant_id string, camp_name string")
    monkeypatch.setattr(queries, "staged", stage)
    monkeypatch.setattr(queries, "_sales_validated", lambda spark, d: read)
    monkeypatch.setattr(queries, "_tenants", lambda spark, d: tenants)
    (row,) = queries.REGISTRY[name](spark, "unused").collect()
    if name == "quarantine_resolution":
        assert (row.batch_id, row.resolved_batch_id) == ("b1", "b2")
    else:
        assert (row.batches, row.rows_loaded, row.rows_resolved, row.rows_open) == (2, 1, 1, 0)
    assert [len(done) for done in purposes.values()] == [1, 1]
    assert not any("violations" in columns for done in purposes.values() for columns in done)
