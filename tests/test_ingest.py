"""Marks, windows, chunks, pages, merges and ledgers."""

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import watermark as wm
from palimpsest.operators.joins import (
    dimension_join,
    hot_keys_of,
    join_spreading_nulls,
    key_identity,
    salted_join,
)
from palimpsest.operators.shaping import merge_detail
from palimpsest.plans import bronze
from palimpsest.sources import landing, ledger
from tests.conftest import tuples


@pytest.fixture
def stamped(spark):
    rows = [(1, "2024-01-01T10:00"), (2, "2024-01-01T10:01"), (3, ""), (4, None), (5, "2024-01-02")]
    return spark.createDataFrame(rows, "id int, stamp string")


def test_mark_is_strict_and_textual(stamped):
    assert tuples(wm.newer_than(stamped, "stamp", "2024-01-01T10:00"), "id") == [(2,), (5,)]
    assert wm.newer_than(stamped, "stamp", None).count() == 5


def test_mark_as_subquery(spark, stamped):
    marks = spark.createDataFrame([("2024-01-01T10:01",), (None,)], "hwm string")
    assert tuples(wm.newer_than(stamped, "stamp", marks.agg(F.max("hwm")).scalar()), "id") == [(5,)]
    none = marks.filter("hwm is null").agg(F.max("hwm")).scalar()
    assert wm.newer_than(stamped, "stamp", none).count() == 5


def test_known_ids_close_the_gap_at_the_mark(spark, stamped):
    known = spark.createDataFrame([(1,)], "id int")
    more = stamped.union(spark.createDataFrame([(6, "2024-01-01T10:00")], stamped.schema))
    assert tuples(wm.newer_or_unknown(more, "stamp", "2024-01-01T10:00", known, "id"), "id") == [(2,), (5,), (6,)]


def test_candidate_and_advance(spark, stamped):
    assert stamped.agg(wm.candidate_mark("stamp")).first()[0] == "2024-01-02"
    assert stamped.filter("id in (3, 4)").agg(wm.candidate_mark("stamp")).first()[0] is None
    rows = spark.createDataFrame([("b", "a"), ("a", "b"), (None, "a"), ("a", None), (None, None)], "o string, c string")
    assert [r[0] for r in rows.select(wm.advance_mark(F.col("o"), F.col("c"))).collect()] == ["b", "b", "a", "a", None]


@pytest.mark.parametrize("days, count", [(0, 1), (89, 1), (90, 1), (91, 2), (181, 2), (182, 3), (365, 5), (-1, 0)])
def test_chunks_tile_the_range(spark, days, count):
    start = date(2024, 1, 1)
    end = start + timedelta(days=days)
    ranges = spark.createDataFrame([(start, end)], "a date, b date")
    chunks = sorted((r["chunk_start"], r["chunk_end"]) for r in wm.date_chunks(ranges, "a", "b").collect())
    assert len(chunks) == count
    covered = [c0 + timedelta(days=i) for c0, c1 in chunks for i in range((c1 - c0).days + 1)]
    assert covered == [start + timedelta(days=i) for i in range(days + 1)]
    days_df = spark.createDataFrame([(d,) for d in covered] or [(start,)], "d date")
    placed = wm.with_chunk(days_df, F.col("d"), start, end)
    assert sorted({(r["chunk_start"], r["chunk_end"]) for r in placed.collect()}) == chunks


def test_window_bounds(spark):
    assert wm.ingest_window("2024-01-05T10:00", 3, date(2024, 2, 1)) == (date(2024, 1, 5), date(2024, 2, 1))
    assert wm.ingest_window(None, 12, date(2024, 12, 31))[0] == date(2024, 12, 31) - timedelta(days=360)
    rows = spark.createDataFrame([("2024-01-05T10:00",), (None,)], "m string")
    starts = rows.select(wm.window_start(F.col("m"), 3, F.lit(date(2024, 4, 1)))).collect()
    assert [r[0] for r in starts] == [date(2024, 1, 5), date(2024, 1, 2)]


def test_window_is_inclusive_on_text_and_time(spark):
    rows = spark.createDataFrame(
        [("2024-01-01T00:00",), ("2024-01-02T23:59:59.999",), ("2024-01-03T00:00",), ("2023-12-31T23:59",)], "t string"
    )
    wanted = [("2024-01-01T00:00",), ("2024-01-02T23:59:59.999",)]
    assert tuples(wm.in_window(rows, "t", date(2024, 1, 1), date(2024, 1, 2))) == wanted
    times = rows.select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert wm.in_window(times, "t", date(2024, 1, 1), date(2024, 1, 2)).count() == 2


def test_pages(spark):
    pages = spark.createDataFrame(
        [(1, [(1, "a"), (2, "b")]), (2, [(3, "c")]), (3, []), (4, None)], "page int, dados array<struct<id:int,v:string>>"
    )
    rows = landing.unnest_pages(pages)
    assert [r["id"] for r in rows.orderBy(landing.ORDINAL).collect()] == [1, 2, 3]


def test_merge_keeps_summaries_without_detail(spark):
    summaries = spark.createDataFrame([(1, "/1", "x"), (2, "/2", "y"), (3, None, "z")], "id int, uri string, nome string")
    details = spark.createDataFrame(
        [("/1", (1, "first"), 0), ("/1", (1, "second"), 1), ("/9", (9, "other"), 0), (None, (0, "none"), 0)],
        "uri string, detail struct<id:int,nome:string>, o int",
    )
    merged = merge_detail(summaries, details, order=["o"])
    assert tuples(merged, "id", "summary.nome", "detail.nome") == [(1, "x", "first"), (2, "y", None), (3, "z", None)]


def test_salted_join_equals_plain_join(spark):
    left = spark.range(4000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 50).alias("k")
    )
    right = spark.range(40).select(F.col("id").cast("bigint").alias("k"), (F.col("id") * 10).alias("v"))
    twice = right.union(right.filter("k = 7"))
    for how in ("left", "inner"):
        salted = salted_join(left, twice, "k", how, hot_keys_of(left, "k", 20), ["id"], task_rows=10)
        assert tuples(salted, "id", "k", "v") == tuples(left.join(twice, "k", how), "id", "k", "v")
    with pytest.raises(ValueError):
        salted_join(left, right, "k", "full")


def test_salted_join_spreads_a_hot_key(spark):
    left = spark.range(2000).select("id", F.lit(7).cast("bigint").alias("k"))
    right = spark.createDataFrame([(7, 1)], "k bigint, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(left, right, "k", hot={7: 2000}, spread_by=["id"], task_rows=100)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 1 and sum(r["count"] for r in sizes) == 2000


def test_salted_join_on_two_columns(spark):
    left = spark.range(3000).select(
        "id", F.when(F.col("id") % 5 > 0, F.col("id") % 3).alias("k"), (F.col("id") % 2).alias("b")
    )
    right = left.filter("k < 2").groupBy("k", "b").agg(F.max("id").alias("v"))
    for how in ("left", "inner"):
        hot = hot_keys_of(left, key_identity(["k", "b"]), 100)
        assert len(hot) == 6
        salted = salted_join(left, right, ["k", "b"], how, hot, task_rows=50)
        assert tuples(salted, "id", "v") == tuples(left.join(right, ["k", "b"], how), "id", "v")


def test_null_keys_spread_and_match_nothing(spark):
    left = spark.range(1000).select("id", F.when(F.col("id") < 10, F.col("id")).alias("k"))
    right = spark.createDataFrame([(1, "a"), (None, "b")], "k bigint, v string")
    joined = join_spreading_nulls(left, right, ["k"])
    assert joined.count() == 1000 and tuples(joined.filter("v is not null"), "id", "v") == [(1, "a")]
    assert join_spreading_nulls(left, right, ["k"], "left_anti").count() == 999


def test_dimension_join_beyond_the_bound(spark, monkeypatch):
    from palimpsest.operators import joins

    facts = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    dimension = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    wanted = tuples(facts.join(dimension, "k"), "id", "v")
    assert tuples(dimension_join(facts, dimension, "k"), "id", "v") == wanted
    monkeypatch.setattr(joins, "fits_broadcast", lambda *side: False)
    assert tuples(joins.dimension_join(facts, dimension, "k"), "id", "v") == wanted


def test_fits_broadcast_measures(spark):
    from palimpsest.operators.joins import fits_broadcast

    assert fits_broadcast(spark.range(10), rows=10)
    assert not fits_broadcast(spark.range(11), rows=10)
    assert not fits_broadcast(spark.range(10), size=20)
    assert fits_broadcast(spark.range(0))


def run_votings(spark, tmp_path, rows, file, day, **more):
    return bronze.ingest_delta(
        spark,
        rows,
        "votings",
        "dataHoraRegistro",
        str(tmp_path / "bronze"),
        str(tmp_path / "runs"),
        file,
        datetime(2024, 1, day, 12, tzinfo=timezone.utc),
        date(2024, 1, day),
        **more,
    )


def votings(spark, *rows):
    return spark.createDataFrame(list(rows), "id int, dataHoraRegistro string")


def test_incremental_runs(spark, tmp_path):
    first = run_votings(spark, tmp_path, votings(spark, (1, "2024-01-01T10:00"), (2, "2023-01-01T10:00")), "delta_1", 2)
    assert (first["new_records"], first["hwm"], first["window_start"]) == (1, "2024-01-01T10:00", date(2023, 10, 4))
    late = votings(spark, (3, "2024-01-01T09:00"), (1, "2024-01-01T10:00"), (4, "2024-01-03T10:00"))
    second = run_votings(spark, tmp_path, late, "delta_2", 3)
    assert (second["new_records"], second["hwm"]) == (1, "2024-01-03T10:00")
    empty = run_votings(spark, tmp_path, votings(spark, (1, "2024-01-01T10:00")), "delta_3", 4)
    assert (empty["new_records"], empty["hwm"]) == (0, "2024-01-03T10:00")
    again = run_votings(spark, tmp_path, late, "delta_2", 3)
    assert (again["new_records"], again["hwm"]) == (1, "2024-01-03T10:00")
    runs = ledger.running_totals(ledger.read_runs(spark, str(tmp_path / "runs")))
    assert tuples(runs, "file", "total_records_known") == [("delta_1", 1), ("delta_2", 2), ("delta_3", 2)]


def test_repeating_the_last_run_replaces_it(spark, tmp_path):
    rows = votings(spark, (1, "2024-01-01T10:00"), (2, "2024-01-02T10:00"))
    for _ in range(2):
        row = run_votings(spark, tmp_path, rows, "delta_1", 3)
        assert (row["new_records"], row["hwm"]) == (2, "2024-01-02T10:00")
    batches = landing.read_batches(spark, str(tmp_path / "bronze"), rows.schema)
    assert tuples(batches, "id", "batch") == [(1, "delta_1"), (2, "delta_1")]


def test_capped_run_leaves_no_gap(spark, tmp_path):
    rows = votings(spark, (1, "2024-01-03T10:00"), (2, "2024-01-01T10:00"), (3, "2024-01-02T10:00"))
    capped = run_votings(spark, tmp_path, rows, "delta_1", 4, limit=2)
    assert (capped["new_records"], capped["hwm"]) == (2, "2024-01-02T10:00")
    assert run_votings(spark, tmp_path, rows, "delta_2", 5)["new_records"] == 1


def test_snapshot_of_the_same_day_replaces_the_first(spark, tmp_path):
    details = spark.createDataFrame([("/1", (1,))], "uri string, detail struct<id:int>")
    for size in (3, 2):
        listed = spark.range(1, size + 1).select("id", F.concat(F.lit("/"), "id").alias("uri"))
        row = bronze.ingest_snapshot(
            spark,
            listed,
            details,
            "deputies",
            str(tmp_path / "b"),
            str(tmp_path / "r"),
            date(2024, 1, 1),
            datetime(2024, 1, 1, 9, tzinfo=timezone.utc),
        )
        assert row["new_records"] == size
    assert spark.read.parquet(str(tmp_path / "b")).count() == 2
    assert ledger.read_runs(spark, str(tmp_path / "r")).count() == 1


def test_hot_keys_are_found_without_a_shuffle_of_keys(spark):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"))
    assert hot_keys_of(rows, "k", 1000) == {"hot": 3000}
    assert hot_keys_of(rows, "k", 5000) == {}
    assert hot_keys_of(rows.limit(0), "k", 1) == {}


def test_no_hot_key_is_left_out(spark):
    rows = spark.range(40_000).select((F.col("id") % 400).alias("k"))
    assert hot_keys_of(rows, "k", 100) == {k: 100 for k in range(400)}


def test_joins_run_nothing_while_they_are_built(spark):
    rows = spark.range(100).select("id", F.col("id").cast("string").alias("word"))
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    salted_join(rows, rows.withColumnRenamed("word", "w"), "id")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


def test_mark_misses_nothing_with_known_ids(spark):
    rows = votings(spark, (1, "2024-01-02T10:00"), (2, "2024-01-02T10:00"), (3, "2024-01-03T10:00"), (4, "2024-01-01T10:00"))
    known = spark.createDataFrame([(1,)], "id long")
    fresh = bronze.new_records(rows, "dataHoraRegistro", "2024-01-02T10:00", 3, date(2024, 1, 31), known=known)
    assert tuples(fresh, "id") == [(2,), (3,)]


def test_snapshot_has_one_record_per_summary_and_keeps_its_ids(spark, tmp_path):
    listed = spark.createDataFrame([(1, "/1"), (2, "/2")], "id long, uri string")
    details = spark.createDataFrame([("/1", (5,)), ("/1", (4,)), ("/1", (5,))], "uri string, detail struct<id:int>")
    book = str(tmp_path / "r")
    row = bronze.ingest_snapshot(
        spark, listed, details, "deputies", str(tmp_path / "b"), book, date(2024, 1, 1), datetime(2024, 1, 1, tzinfo=timezone.utc)
    )
    assert row["new_records"] == 2
    assert tuples(ledger.read_ids(spark, book), "endpoint", "file", "id") == [
        ("deputies", "snapshot_2024-01-01", "1"),
        ("deputies", "snapshot_2024-01-01", "2"),
    ]
