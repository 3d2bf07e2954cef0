"""Shape of the physical plans."""

import re

from pyspark.sql import functions as F

from palimpsest.operators import history, watermark as wm
from palimpsest.operators.dedup import keep_first
from palimpsest.plans import silver
from palimpsest.plans.entities import SPECS
from palimpsest.sources import landing
from tests.conftest import plan_of

SF = "/root/testdata/sf0.001"


def test_first_per_key_is_cut_before_the_shuffle(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    for rows in (
        keep_first(events, ["user_id"], ["event_id"]),
        history.current_delta(events, "user_id", "ts"),
        history.current_delta(events, "user_id", "ts", "event_id"),
    ):
        plan = plan_of(rows)
        assert plan.count("WindowGroupLimit") >= 2
        assert len(re.findall(r"^\(\d+\) Exchange", plan, re.M)) == 1


def test_window_and_mark_reach_the_scan(spark):
    from datetime import date

    orders = spark.read.parquet(f"{SF}/orders.parquet")
    plan = plan_of(wm.in_window(orders, "o_orderdate", date(1997, 1, 1), date(1997, 2, 1)))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    plan = plan_of(wm.newer_than(orders, "o_orderpriority", "3").select("o_orderkey"))
    assert "GreaterThan(o_orderpriority,3)" in plan and "o_totalprice" not in plan


def test_flags_read_only_their_columns(spark, tmp_path):
    spark.read.parquet(f"{SF}/events.parquet").write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    plan = plan_of(history.flag_current(log, "user_id", "ts", "delta").select("event_id", "is_current"))
    assert "props" not in plan and "event_type" not in plan


def test_current_snapshot_reads_one_partition(spark, tmp_path):
    rows = spark.range(100).select((F.col("id") % 4).cast("string").alias("batch"), "id")
    landing.append_batches(rows, str(tmp_path / "log"))
    log = landing.read_batches(spark, str(tmp_path / "log"), rows.drop("batch").schema)
    current = history.current_snapshot(log, "batch")
    assert re.search(r"PartitionFilters: \[.*batch.* = (Subquery|ReusedSubquery)", plan_of(current))
    assert current.count() == 25


def test_transform_reads_leaves_only(spark, tmp_path):
    spec = SPECS["propositions"]
    empty = spark.createDataFrame([], spec.bronze_schema())
    empty.withColumns({"source_file": F.lit("x"), "_ordinal": F.lit(1)}).write.parquet(str(tmp_path / "b"))
    rows = silver.transform_propositions(spark.read.parquet(str(tmp_path / "b"))).select("id", "statusRegime")
    schema = re.search(r"ReadSchema: (.*)", plan_of(rows)).group(1)
    assert "regime" in schema and "ementa" not in schema and "despacho" not in schema
