"""Known ids, page gaps, and what is read of batches and days."""

import random
import re
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import known, watermark as wm
from palimpsest.plans import bronze, silver
from palimpsest.plans.entities import SPECS
from palimpsest.sources import landing, ledger
from tests.conftest import plan_of, tuples

AT = datetime(2024, 2, 1, tzinfo=timezone.utc)


@pytest.mark.parametrize("bits", [known.ROW_BITS, 1 << 20])
def test_every_known_id_has_its_bit(spark, bits):
    ids = spark.range(0, 60_000, 3).select("id")
    rows = known.bitmap(ids, "id", bits)
    assert rows.count() <= bits // known.ROW_BITS
    marked = known.with_suspicion(spark.range(60_000), ids, "id", bits)
    missed = marked.where("id % 3 = 0 and not _suspected").count()
    shared = marked.where("id % 3 > 0 and _suspected").count()
    assert missed == 0
    assert shared > 5_000 if bits == known.ROW_BITS else shared < 1_500


@pytest.mark.parametrize("kind", ["long", "string"])
def test_unknown_records_are_those_of_the_plain_anti_join(spark, kind, monkeypatch):
    monkeypatch.setattr(known, "MOST_BITS", known.ROW_BITS)
    rng = random.Random(1)
    ids = [(rng.randrange(200_000),) for _ in range(40_000)] + [(None,)]
    rows = [(rng.randrange(200_000), i) for i in range(20_000)] + [(None, -1), (None, -2)]
    records = spark.createDataFrame(rows, "id long, n int").withColumn("id", F.col("id").cast(kind))
    held = spark.createDataFrame(ids, "id long")
    wanted = {(str(i) if kind == "string" and i is not None else i, n) for i, n in rows if i is None or (i,) not in set(ids)}
    assert {tuple(r) for r in known.unknown(records, held, "id").collect()} == wanted
    assert known.unknown(records, held.limit(0), "id").count() == len(rows)


def test_only_suspects_are_shuffled(spark, tmp_path):
    spark.range(1000).withColumn("payload", F.lit("x")).write.parquet(str(tmp_path / "r"))
    spark.range(500).write.parquet(str(tmp_path / "k"))
    plan = plan_of(known.unknown(spark.read.parquet(str(tmp_path / "r")), spark.read.parquet(str(tmp_path / "k")), "id"))
    union = plan.split("(1) ")[0]
    clear = union[union.index("Union") :].split(":- ")[1] if ":- " in union else union
    assert "Exchange hashpartitioning" not in clear.split("+- ")[0]


def test_runs_that_remember_take_the_rest_of_the_marks_instant(spark, tmp_path):
    root, book = str(tmp_path / "b"), str(tmp_path / "l")

    def run(name, *rows):
        frame = spark.createDataFrame(rows, "id int, stamp string")
        bronze.ingest_delta(spark, frame, "votings", "stamp", root, book, name, AT, date(2024, 1, 31), 3, remember="id")
        return tuples(landing.read_batches(spark, root, frame.schema).where(F.col("batch") == name), "id")

    assert run("d1", (1, "2024-01-01T10"), (2, "2024-01-02T10")) == [(1,), (2,)]
    assert run("d2", (2, "2024-01-02T10"), (3, "2024-01-02T10"), (4, "2024-01-02T09")) == [(3,)]
    # Repeated under its name a run takes the same again; a later one takes nothing twice.
    assert run("d2", (2, "2024-01-02T10"), (3, "2024-01-02T10"), (4, "2024-01-02T09")) == [(3,)]
    assert run("d3", (3, "2024-01-02T10"), (2, "2024-01-02T10"), (5, "2024-01-03T10")) == [(5,)]
    assert ledger.read_runs(spark, book).agg(F.sum("new_records")).first()[0] == 4


@pytest.mark.parametrize("stretch", [3, 100_000])
def test_page_gaps(spark, monkeypatch, stretch):
    monkeypatch.setattr(landing, "STRETCH", stretch)
    pages = {"a": [1, 2, 3, 7, 7, 8, 20], "b": [4], "c": [1], "d": [2, 3]}
    rows = spark.createDataFrame([(r, p) for r, ps in pages.items() for p in ps] + [("c", None), ("c", 0)], "run string, page int")
    got = tuples(landing.page_gaps(rows, "run"))
    assert got == [("a", 4, 6, 3), ("a", 9, 19, 11), ("b", 1, 3, 3), ("d", 1, 1, 1)]
    assert tuples(landing.page_gaps(rows.where("run = 'a'"))) == [g[1:] for g in got if g[0] == "a"]
    assert landing.page_gaps(rows.limit(0), "run").count() == 0


def test_pending_batches_prune_the_scan_and_no_name_is_in_the_plan(spark, tmp_path):
    rows = spark.range(400).select(F.format_string("d%04d", F.col("id") % 40).alias("batch"), "id")
    landing.append_batches(rows, str(tmp_path / "log"))
    log = landing.read_batches(spark, str(tmp_path / "log"), rows.drop("batch").schema)
    # A backlog of 10,000 batches, of which some have landed.
    spark.range(10_000).select(F.format_string("d%04d", F.col("id") + 30).alias("file_name")).write.parquet(str(tmp_path / "p"))
    pending = landing.of_batches(log, spark.read.parquet(str(tmp_path / "p")))
    plan = plan_of(pending)
    assert "dynamicpruning" in plan and "d0031" not in plan and len(plan) < 20_000
    assert pending.count() == 100
    scans = [n for n in re.findall(r"number of output rows|PartitionFilters: \[.*\]", plan) if "dynamicpruning" in n]
    assert len(scans) == 1


def test_run_batches_loads_what_the_ledgers_leave(spark, tmp_path):
    spec, at = SPECS["votings"], AT
    bronze_root, book, root, files = (str(tmp_path / p) for p in ("bronze", "runs", "silver", "files"))
    frame = lambda *ids: spark.createDataFrame([(i, "x") for i in ids], "id string, descricao string")

    def deliver(name, *ids):
        landing.write_batch(frame(*ids), bronze_root, name)
        row = ledger.delta_run(frame(*ids).withColumn("s", F.lit("1")), "votings", name, at, None, None, "s", None)
        ledger.record_run(row, book)

    def load():
        return tuples(silver.run_batches(spark, spec, bronze_root, book, root, files, at))

    deliver("d1", "a", "b")
    deliver("d2", "a")
    assert load() == [("d1", 2), ("d2", 1)]
    deliver("d3", "c")
    assert load() == [("d3", 1)]
    assert load() == []
    assert tuples(silver.current(spark, spec, root), "id", "batch") == [("a", "d2"), ("b", "d1"), ("c", "d3")]


def test_a_window_from_the_ledger_reads_its_days_only(spark, tmp_path):
    root, book = str(tmp_path / "days"), str(tmp_path / "runs")
    rows = spark.range(300).select("id", F.format_string("2024-01-%02dT10", F.col("id") % 30 + 1).alias("stamp"))
    rows.withColumn("day", F.substring("stamp", 1, 10)).write.partitionBy("day").parquet(root)
    ledger.record_run(
        ledger.delta_run(rows.where("stamp < '2024-01-21'"), "votings", "d1", AT, None, None, "stamp", None), book
    )
    start = ledger.window_start(ledger.read_runs(spark, book), "votings", 3, date(2024, 1, 25))
    landed = spark.read.schema("id long, stamp string, day string").parquet(root)
    window = wm.in_days(landed, "day", start, date(2024, 1, 25))
    assert re.search(r"PartitionFilters: \[.*day.* >= (Subquery|ReusedSubquery|cast)", plan_of(window))
    assert tuples(window.select("day").distinct()) == [(f"2024-01-{d}",) for d in range(20, 26)]
    # The same days if the window was read before: their partitions are named in the plan.
    fresh = bronze.new_records(landed, "stamp", "2024-01-20T10", 3, date(2024, 1, 25), day="day")
    assert re.search(r"PartitionFilters: \[.*day.* >= 2024-01-20", plan_of(fresh))
    assert fresh.columns == ["id", "stamp"] and fresh.count() == 50
