"""Wide records made from narrow rows."""

import pytest
from pyspark.sql import functions as F

from palimpsest.sources import landing
from palimpsest.workload import history, silver, wide

ROWS = 400


@pytest.fixture
def tables(spark, tmp_path):
    """One file, and so one row group, per table."""
    ids = spark.range(ROWS).coalesce(1)
    ids.select(
        F.col("id").alias("c_custkey"), F.concat(F.lit("Customer#"), "id").alias("c_name"),
        (F.col("id") % 3).cast("int").alias("c_nationkey"), F.lit("BUILDING").alias("c_mktsegment"),
        F.lit(1.0).alias("c_acctbal"),
    ).write.parquet(f"{tmp_path}/customer.parquet")
    ids.select(F.col("id").alias("p_partkey")).write.parquet(f"{tmp_path}/part.parquet")
    ids.select(F.col("id").alias("s_suppkey")).write.parquet(f"{tmp_path}/supplier.parquet")
    nations = ids.limit(3).select(F.col("id").cast("int").alias("n_nationkey"), F.col("id").cast("int").alias("n_regionkey"))
    nations.withColumn("n_name", F.lit("n")).write.parquet(f"{tmp_path}/nation.parquet")
    return str(tmp_path)


def largest_task(rows):
    return rows.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


@pytest.mark.parametrize("feed", list(wide.SOURCES))
def test_wide_records_are_made_in_bounded_tasks(spark, tables, monkeypatch, feed):
    monkeypatch.setattr(landing, "WIDE_ROWS", 50, raising=False)
    records = wide.records(spark, tables, feed)
    assert records.count() == 2 * ROWS
    assert largest_task(records) <= 2 * 60


def test_deputies_are_made_in_bounded_tasks(spark, tables, monkeypatch):
    monkeypatch.setattr(landing, "WIDE_ROWS", 50, raising=False)
    records = silver.deputy_records(spark, tables)
    assert records.count() == 4 * ROWS
    assert largest_task(records) <= 4 * 60


def plan(rows):
    return rows._jdf.queryExecution().optimizedPlan().toString() + rows._jdf.queryExecution().sparkPlan().toString()


def test_dealing_holds_no_split(spark, tmp_path):
    """Rows go as they are read: a sort of a whole split, as dealing by number alone does, would hold a row group."""
    keys = spark.range(ROWS, numPartitions=1).select(F.nullif(F.col("id") % 7, F.lit(0)).alias("key"))
    keys.write.parquet(f"{tmp_path}/keys")
    rows = spark.read.parquet(f"{tmp_path}/keys").select(F.col("key").cast("string").alias("name"))
    dealt = landing.deal_rows(rows, 50)
    assert "RoundRobin" not in plan(dealt)
    assert dealt.columns == ["name"]
    assert sorted(map(str, dealt.collect())) == sorted(map(str, rows.collect()))
    assert dealt.groupBy(F.spark_partition_id()).count().agg(F.min("count"), F.max("count")).first()[:] == (50, 50)


def test_many_short_files_are_dealt_evenly(spark, tmp_path):
    """Each file begins at a task of its own."""
    spark.range(ROWS, numPartitions=80).write.parquet(f"{tmp_path}/ids")
    assert largest_task(landing.deal_rows(spark.read.parquet(f"{tmp_path}/ids"), 134)) <= 180


def test_snapshots_are_loaded_from_dealt_rows(spark, tables, monkeypatch):
    monkeypatch.setattr(landing, "WIDE_ROWS", 50)
    loaded, load = [], history.silver.load
    monkeypatch.setattr(history.silver, "load", lambda rows, *more: loaded.append(plan(rows)) or load(rows, *more))
    assert history.snapshot_replay(spark, tables).count() == ROWS
    assert "RepartitionByExpression" in loaded[0] and "RoundRobin" not in loaded[0]


def test_wide_propositions_come_of_dealt_rows(spark, tables, monkeypatch):
    monkeypatch.setattr(landing, "WIDE_ROWS", 50)
    rows = wide.silver_propositions_wide(spark, tables)
    assert "RepartitionByExpression" in plan(rows) and "RoundRobin" not in plan(rows)
    assert sorted(r["id"] for r in rows.select("id").collect()) == list(range(ROWS))


def test_wide_serving_rows_come_of_dealt_rows(spark, tables, monkeypatch):
    monkeypatch.setattr(landing, "WIDE_ROWS", 50)
    rows = wide.gold_deputies_wide(spark, tables)
    assert "RepartitionByExpression" in plan(rows) and "RoundRobin" not in plan(rows)
    assert sorted(r["id"] for r in rows.select("id").collect()) == list(range(ROWS))


def test_nested_deputies_come_of_dealt_rows(spark, tables, monkeypatch):
    monkeypatch.setattr(landing, "WIDE_ROWS", 50)
    rows = silver.silver_deputies(spark, tables)
    assert "RepartitionByExpression" in plan(rows) and "RoundRobin" not in plan(rows)
    assert sorted(r["id"] for r in rows.select("id").collect()) == [i for i in range(ROWS) for _ in range(2)]
