"""Currency kept by state: a stream of versions becomes a stream of changes to the current rows.

Each key's state is its current version alone. A version of a later batch ends it and takes its place; one of an
earlier batch, however late it arrives, changes nothing; of one batch's the first by ordinal stays, as in the batch
form, so a version delivered again changes nothing either.
Every version that becomes current is numbered within its key, and what ends it names that number, so the changes
fold up to the current rows by one anti-join, in whatever order they are read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from palimpsest.sources.landing import read_or_empty

INSERT, EXPIRE = "insert", "expire"
CHANGES = "pk string, number long, change string, batch string, ordinal string, row string"
STATE = "number long, batch string, ordinal string, row string"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class CurrentVersion(StatefulProcessor):
    """Turns a key's versions into inserts and expiries."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("current", STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        (pk,) = key
        before = self.held.get() if self.held.exists() else None
        best = tuple(before[1:]) if before else None
        for row in rows:  # one at a time: a key's rows may be many, the latest is one
            found = (row.batch, row.ordinal, row.row)
            if best is None or self.replaces(found, best):
                best = found
        if before and tuple(before[1:]) == best:
            return
        number = before[0] + 1 if before else 1
        if before:
            yield Row(pk=pk, number=before[0], change=EXPIRE, batch=best[0], ordinal=None, row=None)
        self.held.update((number, *best))
        yield Row(pk=pk, number=number, change=INSERT, batch=best[0], ordinal=best[1], row=best[2])

    @staticmethod
    def replaces(found: tuple, held: tuple) -> bool:
        """A later batch replaces; within a batch the first record does, as the batch form keeps it."""
        return found[0] > held[0] or (found[0] == held[0] and found[1] < held[1])

    def close(self) -> None:
        pass


def sortable(column: Column, kind: T.DataType) -> Column:
    """Text that sorts as the values do; numbers are not negative."""
    if isinstance(kind, T.StructType):
        return F.concat_ws("/", *[sortable(column.getField(f.name), f.dataType) for f in kind.fields])
    text = column.cast("string")
    return F.lpad(text, 20, "0") if isinstance(kind, T.IntegralType) else text


def change_stream(versions: DataFrame, pk: str, batch: str, ordinal: str) -> DataFrame:
    """Changes to the current rows of a stream of versions, (pk, number, change, batch, ordinal, row).

    ``ordinal`` says which record of a batch is the first of its key: whole numbers, text, or a struct of these;
    batches compare as text. ``row`` is the whole version as JSON. Versions without a key never expire: they pass by
    the state as inserts, each with the hash of its contents for a number.
    """
    row = F.to_json(F.struct("*"))
    named = versions.select(
        F.col(pk).cast("string").alias("pk"),
        F.col(batch).cast("string").alias("batch"),
        sortable(F.col(ordinal), versions.schema[ordinal].dataType).alias("ordinal"),
        row.alias("row"),
    )
    keyed = (
        named.where("pk is not null")
        .groupBy("pk")
        .transformWithState(
            statefulProcessor=CurrentVersion(),
            outputStructType=T.StructType.fromDDL(CHANGES),
            outputMode="append",
            timeMode="none",
        )
    )
    keyless = named.where("pk is null").select(
        "pk", F.xxhash64("batch", "ordinal", "row").alias("number"), F.lit(INSERT).alias("change"), "batch", "ordinal", "row"
    )
    return keyed.unionByName(keyless)


def keep_currency(changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the changes of each micro-batch to a folder of its own, which a repeated one replaces, until drained.

    The state lives in the checkpoint, kept by RocksDB: it may outgrow the executors' memory.
    """
    spark = changes.sparkSession

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch:012d}")

    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, ROCKSDB)
    try:
        return (
            changes.writeStream.foreachBatch(keep)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(provider, before)


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, T.StructType.fromDDL(CHANGES))


def fold(changes: DataFrame, schema: T.StructType) -> DataFrame:
    """The current rows: inserts that no expiry names.

    At most one insert a key is without its expiry, so both sides of the join have a row per key and number.
    """
    ended = changes.where(F.col("change") == EXPIRE).select("pk", "number")
    inserts = changes.where(F.col("change") == INSERT)
    current = inserts.where("pk is null").unionByName(inserts.where("pk is not null").join(ended, ["pk", "number"], "left_anti"))
    return current.select(F.from_json("row", schema).alias("row")).select("row.*")
