"""Silver: typed tables from bronze batches, and the three load strategies."""

from __future__ import annotations

import functools
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from palimpsest.operators import history
from palimpsest.operators.dedup import keep_first
from palimpsest.operators.shaping import project
from palimpsest.plans.entities import SPECS, TableSpec
from palimpsest.session import stored
from palimpsest.sources import arrays, landing, ledger
from palimpsest.sources.landing import BATCH, ORDINAL, SOURCE_FILE


def transform(records: DataFrame, spec: TableSpec, batch: str = SOURCE_FILE, ordinal: str = ORDINAL) -> DataFrame:
    """First record per key in each batch, flattened, renamed and typed; the batch column stays."""
    first = keep_first(records, [batch, spec.record_key], [ordinal])
    return project(first, list(spec.columns), keep=(batch,))


def transform_deputies(records: DataFrame) -> DataFrame:
    return transform(records, SPECS["deputies"])


def transform_parties(records: DataFrame) -> DataFrame:
    return transform(records, SPECS["parties"])


def transform_propositions(records: DataFrame) -> DataFrame:
    return transform(records, SPECS["propositions"])


def transform_votings(records: DataFrame) -> DataFrame:
    return transform(records, SPECS["votings"])


# Batches up to which a task of transformed rows may write a file for each.
FEW_BATCHES = 4


def load(
    rows: DataFrame,
    spec: TableSpec,
    root: str,
    loaded_at: datetime,
    batch: str = SOURCE_FILE,
    batches: int | None = None,
) -> None:
    """Write transformed rows to the table's version log, all their batches in one job.

    Snapshot and delta batches are added, or replaced if loaded before; overwrite keeps only these rows. The transform
    has dealt the rows out by batch and key: if it is known that they are of few ``batches``, they do not move again.
    """
    stamped = history.stamp(rows, F.col(batch), loaded_at).withColumn(BATCH, F.col(batch))
    if batch not in (BATCH, SOURCE_FILE):
        stamped = stamped.drop(batch)
    target = f"{root}/{spec.table}"
    if spec.strategy == "overwrite":
        stamped.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BATCH).parquet(target)
    else:
        landing.append_batches(stamped, target, spread=batches is not None and batches <= FEW_BATCHES)


# Array files up to this size are parsed whole, one task per file. Larger ones are split: at record boundaries if they
# are laid out for it, else by ranges of bytes. The sizes decide the plan, never the rows.
WHOLE_FILE_BYTES = 128 * 1024 * 1024


def versions(spark: SparkSession, spec: TableSpec, root: str) -> DataFrame:
    """The table's version log."""
    return landing.read_batches(spark, f"{root}/{spec.table}", spec.silver_schema())


def current(spark: SparkSession, spec: TableSpec, root: str) -> DataFrame:
    """The table's current rows."""
    log = versions(spark, spec, root)
    if spec.strategy == "snapshot":
        return history.current_snapshot(log, BATCH)
    if spec.strategy == "delta":
        return history.current_delta(log, spec.pk, BATCH)
    return log


def run(
    spark: SparkSession,
    spec: TableSpec,
    bronze: str,
    root: str,
    ledger_path: str,
    loaded_at: datetime,
    dry_run: bool = False,
    whole_bytes: int | None = None,
    range_bytes: int | None = None,
) -> DataFrame:
    """Load what is new under ``bronze`` and return the rows per batch; a dry run returns a preview only.

    All new files load in one job, in name order by the derivation of currency. A file with malformed JSON is set
    aside (``quarantined``) and stays pending, the others load. Overwrite tables take the last file and need no
    ledger; an empty one leaves the table as it is. The list of new files is as long as the scan's own file list.
    Files above ``whole_bytes`` are split at record boundaries, those of other layouts above ``range_bytes`` by ranges.
    """
    found = landing.discover_files(spark, bronze, spec.file_pattern)
    seen = ledger.read_files(spark, ledger_path).filter(F.col("endpoint") == spec.endpoint)
    if spec.strategy == "overwrite":
        fresh = landing.latest_batch(found, "file_name")
    else:
        fresh = ledger.pending_files(found, seen)
    known = seen.select("file_name").distinct().withColumn("again", F.lit(True))
    listed = fresh.join(known, "file_name", "left").orderBy("file_name").collect()
    nothing = spark.createDataFrame([], "batch string, rows long")
    if not listed:
        return nothing
    split, bad, texts = _checked(spark, spec, bronze, listed, whole_bytes, range_bytes)
    if bad:
        aside = [(r["file_name"], r["modified_at"], r["length"]) for r in listed if r["file_name"] in bad]
        rows = spark.createDataFrame(aside, "file_name string, modified_at timestamp, length long")
        ledger.record_files(ledger.file_rows(rows, spec.endpoint, loaded_at), quarantine_path(ledger_path))
    good = [r for r in listed if r["file_name"] not in bad]
    if not good:
        return nothing
    rows = transform(_scan(spark, spec, bronze, good, split, texts), spec)
    if dry_run:
        return landing.preview(rows)
    if spec.strategy == "overwrite" and rows.isEmpty():
        return nothing
    again = [r for r in good if r["again"] and spec.strategy != "overwrite"]
    if again:
        # A batch delivered again may now be empty: what an earlier load left of it goes.
        filled = {r[0] for r in _scan(spark, spec, bronze, again, split, texts).select(SOURCE_FILE).distinct().collect()}
        emptied = [r["file_name"] for r in again if r["file_name"] not in filled]
        landing.remove_batches(spark, f"{root}/{spec.table}", emptied)
    load(rows, spec, root, loaded_at, batches=len(good))
    done = [(r["file_name"], r["modified_at"], r["length"]) for r in good]
    done = spark.createDataFrame(done, "file_name string, modified_at timestamp, length long")
    if spec.strategy != "overwrite":
        # Times and lengths are those listed before the read: a file rewritten since loads again.
        ledger.record_files(ledger.file_rows(done, spec.endpoint, loaded_at), ledger_path)
    log = landing.of_batches(versions(spark, spec, root), done)
    return log.groupBy(BATCH).agg(F.count(F.lit(1)).alias("rows"))


def quarantine_path(ledger_path: str) -> str:
    return f"{ledger_path.rstrip('/')}_quarantine"


def quarantined(spark: SparkSession, ledger_path: str) -> DataFrame:
    """Files that were set aside as malformed, one row for each attempt; a mended file loads like a new one."""
    return ledger.read_files(spark, quarantine_path(ledger_path))


def run_batches(
    spark: SparkSession,
    spec: TableSpec,
    bronze: str,
    runs_path: str,
    root: str,
    ledger_path: str,
    loaded_at: datetime,
) -> DataFrame:
    """Load the Parquet batches that the run ledger lists and the file ledger does not, in one job.

    The form for large feeds: batches are folders of any number of files, and the scan reads only the new
    ones. These are a table from the ledgers to the scan, however long the backlog. A run without new records is marked as loaded and expires nothing.
    """
    landed = ledger.read_runs(spark, runs_path).filter(F.col("endpoint") == spec.endpoint)
    found = landed.select(
        F.col("file").alias("file_name"), F.col("ran_at").alias("modified_at"), F.col("new_records").alias("length")
    )
    seen = ledger.read_files(spark, ledger_path).filter(F.col("endpoint") == spec.endpoint)
    fresh = stored(ledger.pending_files(found, seen), "pending")
    if fresh.isEmpty():
        return spark.createDataFrame([], "batch string, rows long")
    names = fresh.select("file_name")
    schema = spec.bronze_schema()
    delivered = spark.read.parquet(bronze).schema
    if ORDINAL in delivered.fieldNames():
        schema = schema.add(delivered[ORDINAL])
    records = landing.read_batches(spark, bronze, schema)
    if ORDINAL not in schema.fieldNames():
        records = records.withColumn(ORDINAL, F.struct("_metadata.file_path", "_metadata.row_index"))
    load(transform(landing.of_batches(records, names), spec, BATCH), spec, root, loaded_at, BATCH)
    ledger.record_files(ledger.file_rows(fresh, spec.endpoint, loaded_at), ledger_path)
    counts = landing.of_batches(versions(spark, spec, root), names).groupBy(BATCH)
    return counts.agg(F.count(F.lit(1)).alias("rows"))


def _checked(
    spark: SparkSession, spec: TableSpec, bronze: str, files: list, whole_bytes: int | None, range_bytes: int | None
) -> tuple[set[str], set[str], DataFrame | None]:
    """Names of the large files whose layout allows to split them, those of all malformed files, and the records'
    texts of the other large ones.

    A file that is read in pieces is checked in pieces; only files that one task reads anyway are parsed whole. Ranges
    take two passes and a stored table, so a lower ``whole_bytes`` alone does not ask for them.
    """
    most = WHOLE_FILE_BYTES if whole_bytes is None else whole_bytes
    least = max(most, WHOLE_FILE_BYTES) if range_bytes is None else range_bytes
    paths = {f["file_name"]: f"{bronze}/{f['file_name']}" for f in files}
    large = {f["file_name"]: f["length"] for f in files if f["length"] > most}
    split = landing.indented_files(spark, [paths[n] for n in large]) if large else set()
    bad, texts = set(), None
    if split:
        bad, several = landing.checked_pieces(spark, [paths[n] for n in sorted(split)], spec.bronze_schema())
        split -= several
    ranged = {name: size for name, size in large.items() if name not in split and size > least}
    if ranged:
        texts = arrays.split_files(spark, [(paths[n], size) for n, size in ranged.items()])
        bad |= arrays.malformed(texts, spec.bronze_schema())
    whole = [path for name, path in paths.items() if name not in split and name not in ranged]
    if whole:
        bad |= landing.malformed_files(spark, whole, spec.bronze_schema())
    return split, bad, texts


def _scan(
    spark: SparkSession, spec: TableSpec, bronze: str, files: list, split: set[str], texts: DataFrame | None
) -> DataFrame:
    """Records of the listed files: those in ``split`` read in pieces, those of ``texts`` from there."""
    paths = {f["file_name"]: f"{bronze}/{f['file_name']}" for f in files}
    schema, parts = spec.bronze_schema(), []
    ranged = {r["file"] for r in texts.select("file").distinct().collect()} if texts else set()
    whole = [path for name, path in paths.items() if name not in split and name not in ranged]
    pieces = [path for name, path in paths.items() if name in split]
    if whole:
        parts.append(landing.read_json_batches(spark, whole, schema))
    if pieces:
        parts.append(landing.read_indented_batches(spark, pieces, schema))
    if ranged & set(paths):
        wanted = texts.filter(F.col("file").isin(sorted(ranged & set(paths))))
        parts.append(arrays.read_texts(wanted, schema))
    return functools.reduce(DataFrame.unionByName, parts)
