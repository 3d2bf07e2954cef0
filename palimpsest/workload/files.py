"""Queries over landed array files: layouts, malformed and empty files."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from palimpsest.plans import silver
from palimpsest.plans.entities import SPECS
from palimpsest.session import scratch_path
from palimpsest.workload.registry import bronze_record, query, table
from palimpsest.workload.silver import voting_columns, voting_records

AT = datetime(2024, 2, 1, tzinfo=timezone.utc)


# Records of one landed file, about; a larger week lands as more files.
FILE_ROWS = 20_000


def array_text(columns, indented=False):
    """All records of a group, in the order of ``_ordinal``, as the text of one JSON array without its end."""
    plain = F.to_json(F.struct(*[c for c in columns if c != "_ordinal"]), {"pretty": str(indented).lower()})
    text = F.concat(F.lit("  "), F.regexp_replace(plain, "\n", "\n  ")) if indented else plain
    listed = F.transform(F.sort_array(F.collect_list(F.struct("_ordinal", text.alias("text")))), lambda r: r["text"])
    gap = "\n" if indented else ""
    return F.concat(F.lit("[" + gap), F.array_join(listed, "," + gap), F.lit(gap))


def move_part(spark, written, folder, name):
    """Land the one part file under ``written`` as ``name``."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(written).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop.Path(folder))
    fs.delete(hadoop.Path(f"{folder}/{name}"), False)
    part = next(s.getPath() for s in fs.listStatus(hadoop.Path(written)) if s.getPath().getName().startswith("part-"))
    if not fs.rename(part, hadoop.Path(f"{folder}/{name}")):
        raise OSError(f"could not land {name}")


def land_array(records, folder, name, indented=False):
    """Write a few records as one JSON array file of the given name."""
    written = scratch_path(records.sparkSession, "array")
    whole = F.concat(array_text(records.columns, indented), F.lit("]"))
    records.agg(whole.alias("value")).coalesce(1).write.text(written)
    move_part(records.sparkSession, written, folder, name)


def land_arrays(records, folder, stem, indented=False, cut=False):
    """Write records as JSON array files ``<stem>_<bucket>.json`` of about ``FILE_ROWS``, the first cut off if asked.

    All records of an id go to one file, which is one batch; each file's text is joined in a group of its own.
    """
    spark = records.sparkSession
    buckets = max(-(-records.count() // FILE_ROWS), 1)
    bucket = F.lpad(F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("string"), 9, "0").alias("bucket")
    found = records.groupBy(bucket).agg(array_text(records.columns, indented).alias("text"))
    written = scratch_path(spark, "arrays")
    found.select("bucket", F.concat("text", F.lit("]")).alias("value")).write.partitionBy("bucket").text(written)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(written).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = [s.getPath() for s in fs.listStatus(hadoop.Path(written))]
    names = sorted(p.getName() for p in parts if p.getName().startswith("bucket="))
    for name in names:
        part = f"{written}/{name}"
        if cut and name == names[0]:
            part = scratch_path(spark, "cut")
            whole = spark.read.option("wholetext", True).text(f"{written}/{name}")
            whole.select(F.regexp_replace("value", r"\]\s*$", "").alias("value")).write.text(part)
        move_part(spark, part, folder, f"{stem}_{name.removeprefix('bucket=')}.json")


def _weeks(spark, sf_dir):
    """Voting records by week of the month, in landing order."""
    records = voting_records(spark, sf_dir)
    week = F.floor((F.dayofmonth(F.to_date("data")) - 1) / 7)
    return [records.filter(week == k).drop("source_file") for k in range(5)]


WEEKS_SQL = """
weeks AS (
  SELECT CAST(user_id AS VARCHAR) AS id, CAST(CAST(ts AS DATE) AS VARCHAR) AS data,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS registered, upper(event_type) AS "siglaOrgao", props AS descricao,
         CASE WHEN event_type = 'error' THEN 'open' WHEN value > 10 THEN '1' ELSE '0' END AS aprovacao,
         (day(ts) - 1) // 7 AS week
  FROM events
  QUALIFY row_number() OVER (PARTITION BY (day(ts) - 1) // 7, user_id ORDER BY event_id) = 1
),
latest AS (
  SELECT id, data, registered, "siglaOrgao", descricao, aprovacao FROM weeks
  QUALIFY week = max(week) OVER (PARTITION BY id)
)"""


@query(f"WITH {WEEKS_SQL} SELECT * FROM latest")
def array_file_replay(spark, sf_dir):
    """Weekly array files, indented and compact in turn, found, split where the layout allows it, and replayed."""
    bronze, root, book = (scratch_path(spark, p) for p in ("arrays", "silver", "files"))
    for k, records in enumerate(_weeks(spark, sf_dir)):
        land_arrays(records, bronze, f"delta_{k}", indented=k % 2 == 0)
    silver.run(spark, SPECS["votings"], bronze, root, book, AT, whole_bytes=0, range_bytes=0)
    return voting_columns(silver.current(spark, SPECS["votings"], root))


@query(f"WITH {WEEKS_SQL} SELECT *, CAST(1 AS BIGINT) AS set_aside FROM latest")
def replay_with_bad_file(spark, sf_dir):
    """One file of a week is cut off: the others load, and it does once it is mended."""
    bronze, root, book = (scratch_path(spark, p) for p in ("arrays", "silver", "files"))
    weeks = _weeks(spark, sf_dir)
    for k, records in enumerate(weeks):
        land_arrays(records, bronze, f"delta_{k}", cut=k == 1)
    silver.run(spark, SPECS["votings"], bronze, root, book, AT)
    land_arrays(weeks[1], bronze, "delta_1")
    silver.run(spark, SPECS["votings"], bronze, root, book, AT)
    aside = silver.quarantined(spark, book).select("file_name").distinct().count()
    return voting_columns(silver.current(spark, SPECS["votings"], root)).withColumn("set_aside", F.lit(aside))


@query("SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS sigla FROM nation")
def overwrite_empty(spark, sf_dir):
    """An overwrite table keeps its rows when the latest file has none."""
    bronze, root, book = (scratch_path(spark, p) for p in ("arrays", "silver", "files"))
    named = table(spark, sf_dir, "nation").withColumn("_ordinal", F.col("n_nationkey"))
    values = {"id": F.col("n_nationkey"), "detail.sigla": F.col("n_name")}
    records = bronze_record(named, SPECS["parties"].bronze_schema(), values, "_ordinal")
    for day, rows in ((1, records), (2, records.limit(0))):
        land_array(rows, bronze, f"snapshot_2024-02-0{day}.json")
        silver.run(spark, SPECS["parties"], bronze, root, book, AT)
    return silver.current(spark, SPECS["parties"], root).select("id", "sigla")
