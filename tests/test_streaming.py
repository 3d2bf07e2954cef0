"""Streaming forms against their batch forms."""

import json
from datetime import date, datetime


from palimpsest.operators import history
from palimpsest.operators.dedup import keep_first
from palimpsest.plans import bronze
from palimpsest.plans.entities import SPECS
from palimpsest.sources import landing, ledger
from palimpsest.streaming import runs
from tests.conftest import tuples


def write(folder, name, *records):
    (folder / name).write_text(json.dumps(list(records)))


def test_streamed_log_equals_batch_whatever_the_order(spark, tmp_path):
    bronze = tmp_path / "bronze"
    bronze.mkdir()
    # Written first, although its name sorts last.
    write(bronze, "delta_3.json", {"id": "a", "descricao": "third"}, {"id": "a", "descricao": "copy"})
    write(bronze, "delta_1.json", {"id": "a", "descricao": "first"}, {"id": "b", "descricao": "only"})
    write(bronze, "delta_2.json")
    schema = SPECS["votings"].bronze_schema()
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")

    def drain():
        source = runs.stream_files(spark, str(bronze), schema, "json", 1, multiLine="true", pathGlobFilter="delta_*.json")
        runs.log_versions(source, log, checkpoint).awaitTermination()
        return tuples(runs.current_of_log(spark, log, "id", landing.SOURCE_FILE, landing.ORDINAL), "id", "descricao")

    assert drain() == [("a", "third"), ("b", "only")]
    assert drain() == [("a", "third"), ("b", "only")]
    write(bronze, "delta_4.json", {"id": "b", "descricao": "newer"})
    assert drain() == [("a", "third"), ("b", "newer")]
    records = landing.read_json_batches(spark, str(bronze), schema, "delta_*.json")
    batch = keep_first(records, [landing.SOURCE_FILE, "id"], [landing.ORDINAL])
    assert tuples(history.current_delta(batch, "id", landing.SOURCE_FILE), "id", "descricao") == drain()


def test_streamed_ingest_keeps_ledger_and_mark(spark, tmp_path):
    landed = tmp_path / "landed"
    rows = spark.createDataFrame([(1, "2024-01-01T10:00"), (2, "2024-01-02T10:00")], "id int, stamp string")
    rows.coalesce(1).write.parquet(str(landed))
    root, book = str(tmp_path / "batches"), str(tmp_path / "runs")

    def drain():
        source = runs.stream_files(spark, str(landed), rows.schema, "parquet").select("id", "stamp")
        runs.ingest_deltas(
            source, "votings", "stamp", root, book, str(tmp_path / "checkpoint"), date(2024, 1, 31), 3
        ).awaitTermination()

    drain()
    late = spark.createDataFrame([(3, "2024-01-01T12:00"), (4, "2024-01-03T10:00")], rows.schema)
    late.coalesce(1).write.mode("append").parquet(str(landed))
    drain()
    assert tuples(landing.read_batches(spark, root, rows.schema), "id") == [(1,), (2,), (4,)]
    totals = ledger.running_totals(ledger.read_runs(spark, book))
    assert tuples(totals, "total_records_known", "hwm") == [(2, "2024-01-02T10:00"), (3, "2024-01-03T10:00")]


def test_file_order_and_trigger_size_do_not_decide_what_is_taken(spark, tmp_path):
    landed = str(tmp_path / "landed")
    stamps = ["2024-01-05T10:00", "2024-01-03T10:00", "2024-01-04T10:00", "2024-01-01T10:00", "2024-01-02T10:00"]
    for i, stamp in enumerate(stamps):
        spark.createDataFrame([(i, stamp)], "id int, stamp string").coalesce(1).write.mode("append").parquet(landed)
    root, book = str(tmp_path / "batches"), str(tmp_path / "runs")
    schema = spark.read.parquet(landed).schema
    for _ in range(2):
        source = runs.stream_files(spark, landed, schema, "parquet", 1).select("id", "stamp")
        runs.ingest_deltas(source, "votings", "stamp", root, book, str(tmp_path / "c"), date(2024, 1, 31), 3)
    assert tuples(landing.read_batches(spark, root, schema), "id") == [(i,) for i in range(5)]
    ledger_rows = ledger.read_runs(spark, book)
    assert {r.kind for r in ledger_rows.collect()} == {"delta"} and ledger_rows.count() == 5
    # A second checkpoint on the same tables starts from the mark and replaces nothing.
    spark.createDataFrame([(9, "2024-01-06T10:00")], "id int, stamp string").coalesce(1).write.mode("append").parquet(landed)
    source = runs.stream_files(spark, landed, schema, "parquet", 1).select("id", "stamp")
    runs.ingest_deltas(source, "votings", "stamp", root, book, str(tmp_path / "d"), date(2024, 1, 31), 3)
    assert tuples(landing.read_batches(spark, root, schema), "id") == [(i,) for i in (0, 1, 2, 3, 4, 9)]


def test_a_drain_that_broke_off_keeps_its_mark(spark, tmp_path):
    book = str(tmp_path / "runs")
    part = ledger.delta_run(
        spark.createDataFrame([("2024-01-09",)], "stamp string"),
        "votings", "delta_1", datetime(2024, 1, 9), date(2024, 1, 1), date(2024, 1, 9), "stamp", None, part=True,
    )
    ledger.record_run(part, book)
    assert bronze.current_mark(spark, book, "votings") is None
    ledger.close_parts(spark, book, "votings")
    assert bronze.current_mark(spark, book, "votings") == "2024-01-09"
    assert ledger.read_runs(spark, book).count() == 1


def test_a_new_checkpoint_adds_to_the_log(spark, tmp_path):
    bronze_folder = tmp_path / "bronze"
    bronze_folder.mkdir()
    schema = SPECS["votings"].bronze_schema()
    log = str(tmp_path / "log")
    for k in (1, 2):
        write(bronze_folder, f"delta_{k}.json", {"id": f"r{k}"})
        source = runs.stream_files(
            spark, str(bronze_folder), schema, "json", 1, multiLine="true", pathGlobFilter=f"delta_{k}.json"
        )
        runs.log_versions(source, log, str(tmp_path / f"c{k}")).awaitTermination()
    assert tuples(spark.read.parquet(log), "id") == [("r1",), ("r2",)]
