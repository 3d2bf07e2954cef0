"""Queries over the streaming forms."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from palimpsest.session import scratch_path
from palimpsest.sources import landing, ledger
from palimpsest.streaming import currency, runs
from palimpsest.workload.ingest import _KNOWN_SQL, _hours
from palimpsest.workload.registry import day_text, iso, query, table


@query("""
SELECT event_id, user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS batch, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC, event_id) = 1""")
def stream_delta_current(spark, sf_dir):
    """Events landed by day, streamed to one version log by two streams, and its current rows."""
    log = scratch_path(spark, "log")
    events = table(spark, sf_dir, "events").withColumn("batch", day_text("ts"))
    schema = events.drop("ts", "batch").schema.add("batch", "string")
    # Two sources with a checkpoint each append to one log, the later days first.
    for days in (F.col("batch") >= "2024-01-15", F.col("batch") < "2024-01-15"):
        landed = scratch_path(spark, "landed")
        events.filter(days).drop("ts").write.partitionBy("batch").parquet(landed)
        files = runs.stream_files(spark, landed, schema, "parquet", files_per_trigger=64)
        runs.log_versions(files, log, scratch_path(spark, "stream")).awaitTermination()
    return runs.current_of_log(spark, log, "user_id", "batch", "event_id").select(
        "event_id", "user_id", "batch", "event_type"
    )


# Rows of one landed file, about.
FILE_ROWS = 50_000


def land_in_order(rows, part, order):
    """Land rows by ``part`` in one job, as files that appear part by part in ``order``; path and files of a part."""
    spark = rows.sparkSession
    landed = scratch_path(spark, "landed")
    files = max(-(-rows.count() // (FILE_ROWS * len(order))), 1)
    bucket = F.pmod(F.xxhash64(*rows.columns), F.lit(files))
    dealt = rows.withColumns({"part": part, "bucket": bucket}).repartition("part", "bucket")
    dealt.write.partitionBy("part", "bucket").parquet(landed)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(landed).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for at, k in enumerate(order):
        for status in fs.globStatus(hadoop.Path(f"{landed}/part={k}/*/*.parquet")):
            fs.setTimes(status.getPath(), 1_700_000_000_000 + 60_000 * at, -1)
    return f"{landed}/*/*", files


@query("""
SELECT event_id, user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS batch, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY CASE WHEN event_type = 'error' THEN -event_id - 1 ELSE user_id END
                           ORDER BY CAST(ts AS DATE) DESC, event_id) = 1""")
def stream_currency(spark, sf_dir):
    """Events by day in six micro-batches, neither oldest nor latest first; currency kept by state, changes folded up.

    Versions without a key stay current, each of them.
    """
    keyed = F.when(F.col("event_type") != "error", F.col("user_id"))
    days = table(spark, sf_dir, "events").select(
        "event_id", "user_id", keyed.alias("pk"), day_text("ts").alias("batch"), "event_type"
    )
    part = F.pmod(F.dayofmonth(F.to_date("batch")), F.lit(6))
    path, files = land_in_order(days, part, [4, 1, 5, 0, 3, 2])
    stream = runs.stream_files(spark, path, days.schema, "parquet", files_per_trigger=files).select(days.columns)
    changes = scratch_path(spark, "changes")
    kept = currency.change_stream(stream, "pk", "batch", "event_id")
    currency.keep_currency(kept, changes, scratch_path(spark, "state")).awaitTermination()
    folded = currency.fold(currency.read_changes(spark, changes), days.schema)
    return folded.select("event_id", "user_id", "batch", "event_type")


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS stamp, (SELECT count(*) FROM events) AS known,
       (SELECT max(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')) FROM events) AS hwm
FROM events""")
def stream_ingest(spark, sf_dir):
    """Six parts, the latest records first, one a micro-batch: batches, ledger and mark as in the batch form."""
    root, book = (scratch_path(spark, p) for p in ("batches", "runs"))
    stamped = table(spark, sf_dir, "events").select("event_id", iso("ts").alias("stamp"))
    part = F.floor(F.dayofmonth(F.to_date(F.substring("stamp", 1, 10))) / 6)
    landed, per_part = land_in_order(stamped, part, [5, 4, 3, 2, 1, 0])
    files = runs.stream_files(spark, landed, stamped.schema, "parquet", files_per_trigger=per_part)
    runs.ingest_deltas(
        files.select("event_id", "stamp"),
        "votings",
        "stamp",
        root,
        book,
        scratch_path(spark, "stream"),
        date(2024, 2, 10),
        3,
    )
    totals = ledger.running_totals(ledger.read_runs(spark, book)).agg(
        F.max("total_records_known").alias("known"), F.max("hwm").alias("hwm")
    )
    known = totals.first()
    return landing.read_batches(spark, root, stamped.schema).select(
        "event_id", "stamp", F.lit(known["known"]).alias("known"), F.lit(known["hwm"]).alias("hwm")
    )


@query(_KNOWN_SQL)
def stream_known_ids(spark, sf_dir):
    """Two drains of one stream that remember their ids, the second with records of the mark's own instant."""
    root, book, checkpoint = (scratch_path(spark, p) for p in ("batches", "runs", "stream"))
    hours, early = _hours(spark, sf_dir)
    landed = scratch_path(spark, "landed")
    for k, rows in enumerate((hours.filter(early), hours), 1):
        rows.write.mode("append").parquet(landed)
        files = runs.stream_files(spark, landed, hours.schema, "parquet").select("event_id", "stamp")
        runs.ingest_deltas(
            files, "votings", "stamp", root, book, checkpoint, date(2024, 2, 10), 3, f"delta_{k}", remember="event_id"
        )
    return landing.read_batches(spark, root, hours.schema).select(
        "event_id", "stamp", F.substring("batch", 1, 7).alias("run")
    )
