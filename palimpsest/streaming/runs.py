"""Streaming forms: file source to version log, and file source to incremental batches.

Every micro-batch writes its own partition, named by its stream and number, and overwrites it when repeated, so
the tables hold each record once. Currency is derived from batch names, so the order of arrival does not matter.
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from palimpsest.operators import history
from palimpsest.plans import bronze
from palimpsest.sources import landing, ledger

EPOCH = "epoch"
BLOCK = "_block"


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str,
    files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Records of the files under ``path`` as they appear, with file name and offset of their split."""
    reader = spark.readStream.schema(schema).format(file_format)
    for key, value in options.items():
        reader = reader.option(key, value)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path).select(
        "*", F.col("_metadata.file_name").alias(landing.SOURCE_FILE), F.col("_metadata.file_block_start").alias(BLOCK)
    )


def with_ordinal(batch: DataFrame) -> DataFrame:
    """Position of each record in its file, for a micro-batch of ``stream_files``."""
    position = F.struct(F.col(BLOCK).alias("block"), F.monotonically_increasing_id().alias("row"))
    return batch.withColumn(landing.ORDINAL, position).drop(BLOCK)


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """Name of the stream that a checkpoint belongs to: when it was made, and its id.

    Micro-batches count from 0 in every checkpoint; with this name before the number, one stream's batches never
    replace another's, and names of later streams sort after those of earlier ones.
    """
    made = F.date_format("_metadata.file_modification_time", "yyyyMMddHHmmssSSS")
    found = spark.read.text(f"{checkpoint}/metadata").select(made, F.get_json_object("value", "$.id")).first()
    return f"{found[0]}-{found[1][:8]}"


def log_versions(records: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append each micro-batch to a version log, stamped with its load time, until the source is drained.

    Several streams, each with its own checkpoint, may append to one log.
    """

    def keep(batch: DataFrame, epoch: int) -> None:
        now = datetime.now(timezone.utc)
        stamped = with_ordinal(batch).withColumn(history.LOADED_AT, F.lit(now).cast("timestamp"))
        stream = stream_name(batch.sparkSession, checkpoint)
        stamped.write.mode("overwrite").parquet(f"{path}/{EPOCH}={stream}-{epoch:012d}")

    return (
        records.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_of_log(spark: SparkSession, path: str, pk: str, batch: str, ordinal: str) -> DataFrame:
    """Current rows of a streamed delta log: first record of each key's last batch, in one shuffle.

    Whole batches may arrive spread over micro-batches, as neither the de-duplication nor the currency is
    decided on write.
    """
    return history.current_delta(spark.read.parquet(path), pk, batch, ordinal)


def ingest_deltas(
    summaries: DataFrame,
    endpoint: str,
    stamp: str,
    root: str,
    ledger_path: str,
    checkpoint: str,
    today: date,
    months: int,
    name: str = "delta",
    remember: str | None = None,
) -> StreamingQuery:
    """Drain the source through ``bronze.ingest_delta``, one run a micro-batch, and return the ended query.

    All micro-batches of a drain start from the mark it began with, so neither their number nor the order of the
    files decides what is taken. Their ledger rows count as parts until the drain ends, which advances the mark; a
    drain that broke off goes on from the same mark. A repeated micro-batch replaces its batch and ledger row.
    With ``remember``, an id column, no record of the mark's own instant is missed, and none is taken twice.
    """
    mark = bronze.current_mark(summaries.sparkSession, ledger_path, endpoint)

    def take(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        bronze.ingest_delta(
            spark,
            batch,
            endpoint,
            stamp,
            root,
            ledger_path,
            f"{name}_{stream_name(spark, checkpoint)}_{epoch:012d}",
            datetime.now(timezone.utc),
            today,
            months,
            part_of=bronze.Drain(mark),
            remember=remember,
        )

    query = (
        summaries.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    ledger.close_parts(summaries.sparkSession, ledger_path, endpoint)
    return query
