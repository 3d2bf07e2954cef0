"""History in tables bucketed by key: the log and the current rows are joined bucket by bucket, without a shuffle.

A bucketed table is Parquet files dealt out by the hash of the key, registered in the session's catalog with the
number of buckets. Versions of a key stand in the same bucket of every batch, so what is current, and what a new
batch expires, is found where the rows are read; only the new batch itself is shuffled. Rows without a key would all
share one bucket; they match nothing, never expire, and are kept in a plain table beside the bucketed one.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from palimpsest.sources import generations

KEYED, KEYLESS = "keyed", "keyless"


@dataclass(frozen=True)
class Buckets:
    """How a table is dealt out. The number of buckets is fixed when the table is made: about 256 MB each at most."""

    pk: str
    number: int


def _name() -> str:
    return f"palimpsest_{uuid.uuid4().hex}"


def register(spark: SparkSession, path: str, schema: T.StructType, buckets: Buckets, partition: str | None = None) -> str:
    """Name under which the session's catalog knows the bucketed table at ``path``; its files stay as they are.

    The name is new for each call and serves as long as its readers: a persistent catalog should drop it after them.
    """
    name = _name()
    quoted = lambda c: f"`{c.replace('`', '``')}`"
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    parted = f"PARTITIONED BY ({quoted(partition)}) " if partition else ""
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet {parted}"
        f"CLUSTERED BY ({quoted(buckets.pk)}) INTO {buckets.number} BUCKETS LOCATION '{path}'"
    )
    if partition:
        where, files = generations.file_system(spark, path)
        files.mkdirs(where)
        spark.catalog.recoverPartitions(name)
    return name


def open_table(spark: SparkSession, path: str, schema: T.StructType, buckets: Buckets, partition: str | None = None) -> DataFrame:
    """The bucketed table at ``path``: scans keep its buckets, one task each."""
    return spark.table(register(spark, path, schema, buckets, partition))


def dealt(rows: DataFrame, buckets: Buckets) -> DataFrame:
    """``rows`` shuffled as the table is dealt out, so that each task writes one bucket."""
    return rows.repartition(buckets.number, F.col(buckets.pk))


def write_table(rows: DataFrame, path: str, buckets: Buckets) -> None:
    """Write ``rows`` as a bucketed table. Tasks write their rows into the buckets they belong to; rows that come
    from buckets or from ``dealt`` make one file a bucket."""
    name = _name()
    rows.write.format("parquet").bucketBy(buckets.number, buckets.pk).option("path", path).saveAsTable(name)
    rows.sparkSession.sql(f"DROP TABLE {name}")  # the files stay: the table is known by its path


def append_batches(rows: DataFrame, path: str, buckets: Buckets, batch: str) -> None:
    """Add batches to a bucketed log, which is partitioned by batch. A batch written again replaces its rows."""
    spark, pk = rows.sparkSession, buckets.pk
    rows = rows.select(*[c for c in rows.columns if c != batch], batch)
    name = register(spark, f"{path}/{KEYED}", rows.schema, buckets, batch)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        keyed = rows.where(F.col(pk).isNotNull())
        # Dealt out by key and batch alike: a task has one file of each of its batches.
        dealt(keyed, buckets).write.mode("overwrite").insertInto(name)
        keyless = rows.where(F.col(pk).isNull()).hint("rebalance", F.col(batch))
        keyless.write.mode("overwrite").partitionBy(batch).parquet(f"{path}/{KEYLESS}")
    finally:
        spark.conf.set(mode, before)
        spark.sql(f"DROP TABLE {name}")


def open_log(spark: SparkSession, path: str, schema: T.StructType, buckets: Buckets, batch: str) -> tuple[DataFrame, DataFrame]:
    """The log's rows with a key, in buckets, and those without. ``schema`` includes the batch."""
    ordered = T.StructType([*[f for f in schema.fields if f.name != batch], schema[batch]])
    keyed = open_table(spark, f"{path}/{KEYED}", ordered, buckets, batch)
    return keyed, spark.read.schema(ordered).parquet(f"{path}/{KEYLESS}")


def current_of_log(keyed: DataFrame, keyless: DataFrame, pk: str, batch: str) -> DataFrame:
    """Rows of each key's last batch, ranked inside the buckets, and all rows without a key."""
    order = Window.partitionBy(pk).orderBy(F.desc(batch))
    last = keyed.withColumn("_rank", F.rank().over(order)).where("_rank = 1").drop("_rank")
    return last.unionByName(keyless)


def flags_of_log(keyed: DataFrame, keyless: DataFrame, pk: str, batch: str) -> DataFrame:
    """All versions with ``is_current``, compared with their key's last batch inside the buckets."""
    heads = keyed.groupBy(pk).agg(F.max(batch).alias("_head"))
    flagged = keyed.join(heads, pk).withColumn("is_current", F.col(batch) == F.col("_head")).drop("_head")
    return flagged.unionByName(keyless.withColumn("is_current", F.lit(True)))


def start_current(rows: DataFrame, root: str, buckets: Buckets) -> None:
    """Make a current table of ``rows``, its first generation."""
    _publish(dealt(rows.where(F.col(buckets.pk).isNotNull()), buckets), rows.where(F.col(buckets.pk).isNull()), root, buckets)


def _publish(keyed: DataFrame, keyless: DataFrame, root: str, buckets: Buckets) -> None:
    spark = keyed.sparkSession
    seen, generation = generations.published(spark, root), generations.new_generation()
    write_table(keyed, generations.folder(root, generation, KEYED), buckets)
    keyless.write.parquet(generations.folder(root, generation, KEYLESS))
    generations.swap(spark, root, generation, seen)


def open_current(spark: SparkSession, root: str, schema: T.StructType, buckets: Buckets) -> tuple[DataFrame, DataFrame]:
    """The current table's rows with a key, in buckets, and those without."""
    generation = generations.published(spark, root)[0]
    keyed = open_table(spark, generations.folder(root, generation, KEYED), schema, buckets)
    return keyed, spark.read.schema(schema).parquet(generations.folder(root, generation, KEYLESS))


def untouched(keyed: DataFrame, batch: DataFrame, buckets: Buckets) -> DataFrame:
    """Current rows whose key is not in the batch: an anti-join bucket by bucket, to which the batch's keys move."""
    touched = batch.where(F.col(buckets.pk).isNotNull()).select(buckets.pk)
    return keyed.join(dealt(touched, buckets), buckets.pk, "left_anti")


def advance_current(spark: SparkSession, root: str, batch: DataFrame, buckets: Buckets) -> None:
    """Move the current table on by a delta batch, as a new generation.

    The current rows are read and written bucket by bucket; the batch alone is shuffled. ``batch`` has each key's
    rows of one batch only, and is read twice: give a stored table.
    """
    keyed, keyless = open_current(spark, root, batch.schema, buckets)
    has_key = F.col(buckets.pk).isNotNull()
    kept = untouched(keyed, batch, buckets)
    _publish(
        kept.unionByName(dealt(batch.where(has_key), buckets)), keyless.unionByName(batch.where(~has_key)), root, buckets
    )
