"""Run and file ledgers: append-only tables with one row per run or file, never a rewritten document."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from palimpsest.operators import watermark as wm
from palimpsest.sources.landing import read_or_empty

RUNS = (
    "endpoint string, kind string, file string, ran_at timestamp, "
    "window_start date, window_end date, new_records long, hwm string"
)
FILES = "endpoint string, file_name string, modified_at timestamp, length long, loaded_at timestamp"
KNOWN_IDS = "id string, endpoint string, file string"
# A run of a drain that has not ended: its records count, its mark does not.
PART = "part"


def _schema(spark: SparkSession, ddl: str):
    return spark.createDataFrame([], ddl).schema


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, _schema(spark, RUNS))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, _schema(spark, FILES))


def record_run(row: DataFrame, path: str) -> None:
    """Add a run. Recording the same run again replaces its row, so a repeated job does not count twice."""
    (
        row.coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("endpoint", "file")
        .parquet(path)
    )


def ended(runs: DataFrame) -> DataFrame:
    """Runs whose mark counts."""
    return runs.filter(F.col("kind") != PART)


def close_parts(spark: SparkSession, path: str, endpoint: str) -> None:
    """End a drain: its parts, one row a micro-batch, become runs like others."""
    parts = read_runs(spark, path).filter((F.col("endpoint") == endpoint) & (F.col("kind") == PART))
    rows = parts.withColumn("kind", F.lit("delta")).collect()
    if rows:
        record_run(spark.createDataFrame(rows, parts.schema), path)


def ids_path(path: str) -> str:
    return f"{path.rstrip('/')}_ids"


def record_ids(ids: DataFrame, endpoint: str, file: str, path: str) -> None:
    """Keep a run's ids beside the run ledger at ``path``; recording the run again replaces them."""
    named = ids.select(F.col(ids.columns[0]).cast("string").alias("id"))
    named.write.mode("overwrite").parquet(f"{ids_path(path)}/endpoint={endpoint}/file={file}")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Ids of all recorded runs, by endpoint and file."""
    return read_or_empty(spark, ids_path(path), _schema(spark, KNOWN_IDS))


def ids_before(spark: SparkSession, path: str, endpoint: str, file: str) -> DataFrame:
    """Ids that an endpoint's other runs have taken: what a run, or its repetition, must not take again."""
    return read_ids(spark, path).filter((F.col("endpoint") == endpoint) & (F.col("file") != file)).select("id")


def record_files(rows: DataFrame, path: str) -> None:
    """Add loaded files. The ledger is only ever anti-joined, so a row recorded twice does no harm."""
    rows.coalesce(1).write.mode("append").parquet(path)


def delta_run(
    batch: DataFrame,
    endpoint: str,
    file: str,
    ran_at: datetime,
    window_start: date,
    window_end: date,
    hwm_column: str,
    previous_hwm: str | None,
    part: bool = False,
) -> DataFrame:
    """Ledger row of an incremental run; an empty batch gives a row with no new records, for the audit."""
    candidate = F.max(F.nullif(F.col(hwm_column), F.lit("")))
    return batch.agg(F.count(F.lit(1)).alias("new_records"), candidate.alias("candidate")).select(
        F.lit(endpoint).alias("endpoint"),
        F.lit(PART if part else "delta").alias("kind"),
        F.lit(file).alias("file"),
        F.lit(ran_at).cast("timestamp").alias("ran_at"),
        F.lit(window_start).cast("date").alias("window_start"),
        F.lit(window_end).cast("date").alias("window_end"),
        "new_records",
        F.greatest(F.lit(previous_hwm).cast("string"), F.col("candidate")).alias("hwm"),
    )


def snapshot_run(batch: DataFrame, endpoint: str, file: str, ran_at: datetime) -> DataFrame:
    """Ledger row of a snapshot run: its record count. The ids are a table of their own (``known_ids``)."""
    return batch.agg(F.count(F.lit(1)).alias("new_records")).select(
        F.lit(endpoint).alias("endpoint"),
        F.lit("snapshot").alias("kind"),
        F.lit(file).alias("file"),
        F.lit(ran_at).cast("timestamp").alias("ran_at"),
        F.lit(None).cast("date").alias("window_start"),
        F.lit(None).cast("date").alias("window_end"),
        "new_records",
        F.lit(None).cast("string").alias("hwm"),
    )


def known_ids(records: DataFrame, key: str, *by: str) -> DataFrame:
    """Distinct ids, per group if given. A table rather than one array, so it may grow without bound."""
    return records.filter(F.col(key).isNotNull()).select(*by, key).distinct()


def latest_snapshot(runs: DataFrame) -> DataFrame:
    """Current pointer of each snapshot endpoint: its last run."""
    last = F.max_by(F.struct("file", "ran_at", "new_records"), F.struct("ran_at", "file"))
    return runs.filter("kind = 'snapshot'").groupBy("endpoint").agg(last.alias("last")).select("endpoint", "last.*")


def high_water_mark(runs: DataFrame, endpoint: str) -> Column:
    """Mark of an endpoint as a scalar subquery. Marks never go back, so the largest is the latest."""
    return ended(runs).filter(F.col("endpoint") == endpoint).agg(F.max("hwm")).scalar()


def window_start(runs: DataFrame, endpoint: str, months: int, today: date) -> Column:
    """First day of an endpoint's next window as a scalar subquery: the mark's day, or that of a first run."""
    mark = ended(runs).filter(F.col("endpoint") == endpoint).agg(F.max("hwm").alias("hwm"))
    return mark.select(wm.window_start(F.col("hwm"), months, F.lit(today))).scalar()


def running_totals(runs: DataFrame) -> DataFrame:
    """Records known after each run. One row per run, so the windows stay small."""
    so_far = Window.partitionBy("endpoint").orderBy("ran_at", "file")
    return runs.withColumn(
        "total_records_known", F.sum("new_records").over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    )


def file_rows(files: DataFrame, endpoint: str, loaded_at: datetime) -> DataFrame:
    return files.select(
        F.lit(endpoint).alias("endpoint"),
        "file_name",
        "modified_at",
        "length",
        F.lit(loaded_at).cast("timestamp").alias("loaded_at"),
    )


def pending_files(found: DataFrame, files: DataFrame, identity: list[str] | None = None) -> DataFrame:
    """Files not in the ledger. A file rewritten under its old name counts as new: time and length differ."""
    return found.join(files, identity or ["file_name", "modified_at", "length"], "left_anti")
