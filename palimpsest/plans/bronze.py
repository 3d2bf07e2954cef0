"""Bronze: from landed pages to one batch and one ledger row per run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from palimpsest.operators import watermark as wm
from palimpsest.operators.shaping import merge_detail
from palimpsest.sources import landing, ledger


@dataclass
class Drain:
    """A sequence of runs that all start from one mark; it advances when the last of them has ended."""

    mark: str | None


def new_records(
    summaries: DataFrame,
    stamp: str,
    mark: str | None,
    months: int,
    today: date,
    limit: int | None = None,
    known: DataFrame | None = None,
    key: str = "id",
    day: str | None = None,
) -> DataFrame:
    """What an incremental run takes: the day window, which the scan can use, then the exact mark.

    A capped run takes the oldest records first, so that the mark passes none that was left out. ``day`` names the
    column that the landed records are partitioned by, if they are: other days are not read.
    """
    start, end = wm.ingest_window(mark, months, today)
    asked = wm.in_window(summaries, stamp, start, end)
    if day:
        asked = wm.in_days(asked, day, start, end).drop(day)
    if known is None:
        fresh = wm.newer_than(asked, stamp, mark)
    else:
        fresh = wm.newer_or_unknown(asked, stamp, mark, known, key)
    return wm.oldest(fresh, stamp, limit, key) if limit else fresh


def current_mark(spark: SparkSession, ledger_path: str, endpoint: str, before: str | None = None) -> str | None:
    """High-water mark of an endpoint: one value.

    ``before`` is the name of the run that asks. Only runs that sort before it count, so a run repeated after
    later ones takes the same records again.
    """
    runs = ledger.ended(ledger.read_runs(spark, ledger_path)).filter(F.col("endpoint") == endpoint)
    if before:
        runs = runs.filter(F.col("file") < before)
    return runs.agg(F.max("hwm")).first()[0]


def ingest_delta(
    spark: SparkSession,
    summaries: DataFrame,
    endpoint: str,
    stamp: str,
    root: str,
    ledger_path: str,
    file: str,
    ran_at: datetime,
    today: date,
    months: int | None = None,
    details: DataFrame | None = None,
    detail_order: list[str] | None = None,
    limit: int | None = None,
    file_format: str = "parquet",
    known: DataFrame | None = None,
    part_of: Drain | None = None,
    remember: str | None = None,
    day: str | None = None,
) -> Row:
    """One incremental run: window, mark, optional detail merge, batch, ledger row.

    ``file`` names the run; names sort in run order, as timestamps do. Running it again under the same name
    replaces the batch and the row. The new mark and the count are
    read from the written batch, two narrow columns. With ``known``, a table of the ids already taken, records of
    the mark's own instant that are not in it are taken as well. ``remember`` names the id column: the run keeps its
    ids beside the ledger, and those of the endpoint's other runs are its known ones.
    """
    months = months or wm.FIRST_RUN_MONTHS[endpoint]
    mark = part_of.mark if part_of else current_mark(spark, ledger_path, endpoint, before=file)
    key = remember or "id"
    if remember:
        known = ledger.ids_before(spark, ledger_path, endpoint, file).withColumnRenamed("id", key)
    fresh = new_records(summaries, stamp, mark, months, today, limit, known, key, day)
    records = fresh if details is None else merge_detail(fresh, details, order=detail_order)
    landing.write_batch(records, root, file, file_format)
    path = stamp if details is None else f"summary.{stamp}"
    written = landing.read_batches(spark, root, records.schema, file_format).filter(F.col(landing.BATCH) == file)
    if remember:
        ledger.record_ids(ledger.known_ids(written.select(key if details is None else f"summary.{key}"), key), endpoint, file, ledger_path)
    start, end = wm.ingest_window(mark, months, today)
    stamps = written.select(F.col(path).alias(stamp))
    row = ledger.delta_run(stamps, endpoint, file, ran_at, start, end, stamp, mark, part=part_of is not None)
    ledger.record_run(row, ledger_path)
    return ledger.read_runs(spark, ledger_path).filter(
        (F.col("endpoint") == endpoint) & (F.col("file") == file)
    ).first()


def ingest_snapshot(
    spark: SparkSession,
    summaries: DataFrame,
    details: DataFrame,
    endpoint: str,
    root: str,
    ledger_path: str,
    day: date,
    ran_at: datetime,
    order_by: str = "id",
    limit: int | None = None,
    file_format: str = "parquet",
) -> Row:
    """One snapshot run, named by its day: a second run on that day replaces the first.

    A summary has one record whatever the number of its detail payloads. The run's ids are kept beside the run
    ledger, see ``ledger.read_ids``.
    """
    file = f"snapshot_{day.isoformat()}"
    listed = wm.listing(summaries, order_by).limit(limit) if limit else summaries
    records = merge_detail(listed, details)
    landing.write_batch(records, root, file, file_format)
    written = landing.read_batches(spark, root, records.schema, file_format).filter(F.col(landing.BATCH) == file)
    ledger.record_ids(ledger.known_ids(written, "id"), endpoint, file, ledger_path)
    ledger.record_run(ledger.snapshot_run(written, endpoint, file, ran_at), ledger_path)
    return ledger.read_runs(spark, ledger_path).filter(
        (F.col("endpoint") == endpoint) & (F.col("file") == file)
    ).first()
