"""Queries over load strategies and history."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from palimpsest.operators import bucketed, evolution, history
from palimpsest.operators.dedup import keep_first
from palimpsest.plans import silver
from palimpsest.plans.entities import SPECS
from palimpsest.session import scratch_path, stored
from palimpsest.sources import landing, ledger
from palimpsest.workload.registry import VERSIONS_SQL, cents, query, table, time_text
from palimpsest.workload.silver import VOTINGS_SQL, deputy_records, voting_columns, voting_records

SHOWN = ["event_id", "user_id", "batch", "event_type"]
SHOWN_SQL = "event_id, user_id, CAST(batch AS VARCHAR) AS batch, event_type"
WEEKS_SQL = """
weeks AS (
  SELECT event_id, user_id, event_type, CAST(date_trunc('week', ts) AS DATE) AS batch,
         CAST(date_trunc('week', ts) + INTERVAL 7 DAY AS TIMESTAMP) AS loaded_at
  FROM events
  QUALIFY row_number() OVER (PARTITION BY date_trunc('week', ts), user_id ORDER BY event_id) = 1
)"""


def versions(spark, sf_dir, grain="day"):
    """First event per user and batch, loaded when the batch ended."""
    events = table(spark, sf_dir, "events")
    day = F.to_date("ts") if grain == "day" else F.to_date(F.date_trunc("week", "ts"))
    loaded = F.date_add("batch", 1 if grain == "day" else 7).cast("timestamp")
    first = keep_first(events.withColumn("batch", day), ["batch", "user_id"], ["event_id"])
    return history.stamp(first.drop("ts"), F.col("batch").cast("string"), loaded)


def version_table(spark, sf_dir, grain="day"):
    """The same as a table, for what reads the log more than once."""
    return stored(versions(spark, sf_dir, grain), "versions")


def shown(rows, *more):
    return rows.select("event_id", "user_id", F.col("batch").cast("string").alias("batch"), "event_type", *more)


@query(f"""WITH {VERSIONS_SQL}
SELECT event_id, strftime(loaded_at, '%Y-%m-%d %H:%M:%S') AS loaded_at, CAST(batch AS VARCHAR) AS source_file FROM versions""")
def load_metadata(spark, sf_dir):
    """Load time and file name on every version."""
    return versions(spark, sf_dir).select("event_id", time_text("loaded_at").alias("loaded_at"), "source_file")


@query(f"WITH {WEEKS_SQL} SELECT {SHOWN_SQL} FROM weeks WHERE batch = (SELECT max(batch) FROM weeks)")
def scd2_snapshot_current(spark, sf_dir):
    """Weekly snapshots: only the last one is current."""
    return shown(history.current_snapshot(version_table(spark, sf_dir, "week"), "batch"))


@query(f"""WITH {WEEKS_SQL}, loads AS (
  SELECT batch, lead(min(loaded_at)) OVER (ORDER BY batch) AS valid_to FROM weeks GROUP BY batch)
SELECT {SHOWN_SQL.replace('batch AS', 'weeks.batch AS')}, strftime(loaded_at, '%Y-%m-%d %H:%M:%S') AS valid_from,
       coalesce(strftime(valid_to, '%Y-%m-%d %H:%M:%S'), 'open') AS valid_to
FROM weeks JOIN loads ON weeks.batch = loads.batch""")
def scd2_snapshot_history(spark, sf_dir):
    """Weekly snapshots with validity: each ends at the next load, whether or not the key is in it."""
    rows = history.with_validity(version_table(spark, sf_dir, "week"), "user_id", "batch", "snapshot")
    return shown(
        rows,
        time_text("valid_from").alias("valid_from"),
        F.coalesce(time_text("valid_to"), F.lit("open")).alias("valid_to"),
    )


@query(f"""WITH {WEEKS_SQL} SELECT {SHOWN_SQL} FROM weeks
WHERE batch = (SELECT max(batch) FROM weeks WHERE loaded_at <= TIMESTAMP '2024-01-16 12:00:00')""")
def scd2_snapshot_asof(spark, sf_dir):
    """The snapshot that was current at an instant."""
    at = F.lit("2024-01-16 12:00:00").cast("timestamp")
    return shown(history.as_of(version_table(spark, sf_dir, "week"), "user_id", "batch", "snapshot", at))


@query(f"""WITH {VERSIONS_SQL} SELECT {SHOWN_SQL} FROM versions
QUALIFY batch = max(batch) OVER (PARTITION BY user_id)""")
def scd2_delta_current(spark, sf_dir):
    """Daily deltas: each user's last version is current."""
    return shown(history.current_delta(versions(spark, sf_dir), "user_id", "batch"))


@query(f"""WITH {VERSIONS_SQL} SELECT {SHOWN_SQL}, batch = max(batch) OVER (PARTITION BY user_id) AS is_current FROM versions""")
def scd2_delta_flags(spark, sf_dir):
    """Daily deltas: all versions with their flag."""
    return shown(history.flag_current(version_table(spark, sf_dir), "user_id", "batch", "delta"), "is_current")


@query(f"""WITH {WEEKS_SQL} SELECT {SHOWN_SQL}, batch = (SELECT max(batch) FROM weeks) AS is_current FROM weeks""")
def scd2_snapshot_flags(spark, sf_dir):
    """Weekly snapshots: all versions with their flag."""
    return shown(history.flag_current(version_table(spark, sf_dir, "week"), "user_id", "batch", "snapshot"), "is_current")


@query(f"""WITH {VERSIONS_SQL} SELECT {SHOWN_SQL}, strftime(loaded_at, '%Y-%m-%d %H:%M:%S') AS valid_from,
  coalesce(strftime(lead(loaded_at) OVER (PARTITION BY user_id ORDER BY batch), '%Y-%m-%d %H:%M:%S'), 'open') AS valid_to
FROM versions""")
def scd2_delta_history(spark, sf_dir):
    """Daily deltas with validity: a version ends when its key's next one loads."""
    rows = history.with_validity(version_table(spark, sf_dir), "user_id", "batch", "delta")
    return shown(
        rows,
        time_text("valid_from").alias("valid_from"),
        F.coalesce(time_text("valid_to"), F.lit("open")).alias("valid_to"),
    )


@query(f"""WITH {VERSIONS_SQL} SELECT {SHOWN_SQL} FROM versions WHERE loaded_at <= TIMESTAMP '2024-01-15 00:00:00'
QUALIFY batch = max(batch) OVER (PARTITION BY user_id)""")
def scd2_delta_asof(spark, sf_dir):
    """The versions that were current at an instant."""
    at = F.lit("2024-01-15 00:00:00").cast("timestamp")
    return shown(history.as_of(versions(spark, sf_dir), "user_id", "batch", "delta", at))


@query(f"""WITH {VERSIONS_SQL} SELECT {SHOWN_SQL} FROM versions QUALIFY batch = max(batch) OVER (PARTITION BY user_id)""")
def delta_merge(spark, sf_dir):
    """A compacted current table, advanced by the rows of later batches."""
    log = version_table(spark, sf_dir)
    split = F.lit("2024-01-20").cast("date")
    before = history.current_delta(log.filter(F.col("batch") < split), "user_id", "batch")
    after = history.current_delta(log.filter(F.col("batch") >= split), "user_id", "batch")
    return shown(history.advance_current(before, after, "user_id"))


_KEYED_SQL = f"""{VERSIONS_SQL}, keyed AS (
  SELECT *, CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS pk FROM versions)"""


def _keyed_batches(spark, sf_dir):
    """Daily versions, some without a key, with their day as text."""
    keyed = F.when(F.col("event_type") != "error", F.col("user_id"))
    rows = version_table(spark, sf_dir).select(
        "event_id", "user_id", keyed.alias("pk"), "event_type", F.col("batch").cast("string").alias("batch")
    )
    return rows, bucketed.Buckets("pk", max(8, rows.count() // 1_000_000))


@query(f"""WITH {_KEYED_SQL}
SELECT event_id, CAST(batch AS VARCHAR) AS batch, event_type,
       pk IS NULL OR batch = max(batch) OVER (PARTITION BY pk) AS is_current FROM keyed""")
def bucketed_flags(spark, sf_dir):
    """A log in buckets, appended twice: every version's flag, found without a shuffle."""
    rows, buckets = _keyed_batches(spark, sf_dir)
    path = scratch_path(spark, "bucketed-log")
    for days in (F.col("batch") < "2024-01-20", F.col("batch") >= "2024-01-20"):
        bucketed.append_batches(rows.filter(days), path, buckets, "batch")
    keyed, keyless = bucketed.open_log(spark, path, rows.schema, buckets, "batch")
    flags = bucketed.flags_of_log(keyed, keyless, "pk", "batch")
    return flags.select("event_id", "batch", "event_type", "is_current")


@query(f"""WITH {_KEYED_SQL} SELECT event_id, user_id, CAST(batch AS VARCHAR) AS batch, event_type FROM keyed
WHERE pk IS NULL OR batch = (SELECT max(k.batch) FROM keyed k WHERE k.pk = keyed.pk)""")
def bucketed_merge(spark, sf_dir):
    """A current table in buckets, moved on twice; each time the new rows alone are shuffled."""
    rows, buckets = _keyed_batches(spark, sf_dir)
    root, day = scratch_path(spark, "bucketed-current"), F.col("batch")
    bucketed.start_current(history.current_delta(rows.filter(day < "2024-01-15"), "pk", "batch"), root, buckets)
    for days in ((day >= "2024-01-15") & (day < "2024-01-22"), day >= "2024-01-22"):
        load = stored(history.current_delta(rows.filter(days), "pk", "batch"), "load")
        bucketed.advance_current(spark, root, load, buckets)
    keyed, keyless = bucketed.open_current(spark, root, rows.schema, buckets)
    return keyed.unionByName(keyless).select("event_id", "user_id", "batch", "event_type")


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS batch, CAST(round(o_totalprice * 100) AS BIGINT) AS cents
FROM orders WHERE strftime(o_orderdate, '%Y-%m') = (SELECT max(strftime(o_orderdate, '%Y-%m')) FROM orders)""")
def overwrite_latest(spark, sf_dir):
    """Overwrite strategy: two loads, of which the table keeps the second."""
    root = scratch_path(spark, "overwrite")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("batch"), cents("o_totalprice").alias("cents")
    )
    spec = SPECS["parties"]
    at = datetime(2024, 2, 1, tzinfo=timezone.utc)
    silver.load(orders.filter("batch < '2000-01'"), spec, root, at, "batch")
    silver.load(landing.latest_batch(orders, "batch"), spec, root, at, "batch")
    return landing.read_batches(spark, f"{root}/{spec.table}", orders.drop("batch").schema).select(
        "o_orderkey", "batch", "cents"
    )


@query(f"""WITH {VOTINGS_SQL}
SELECT id, data, registered, "siglaOrgao", descricao, aprovacao FROM votings
QUALIFY source_file = max(source_file) OVER (PARTITION BY id)""")
def delta_replay(spark, sf_dir):
    """All daily deltas loaded in one job; the table's current rows."""
    root = scratch_path(spark, "silver")
    rows = silver.transform_votings(voting_records(spark, sf_dir))
    silver.load(rows, SPECS["votings"], root, datetime(2024, 2, 1, tzinfo=timezone.utc))
    return voting_columns(silver.current(spark, SPECS["votings"], root))


@query("""
SELECT c_custkey AS id, c_name AS "nomeCivil", c_mktsegment AS partido, 'snapshot_2024-01-02.json' AS source_file
FROM customer WHERE c_acctbal >= 0""")
def snapshot_replay(spark, sf_dir):
    """Two snapshots loaded in one job; keys missing from the second have no current row."""
    root = scratch_path(spark, "silver")
    rows = silver.transform_deputies(deputy_records(spark, sf_dir))
    silver.load(rows, SPECS["deputies"], root, datetime(2024, 2, 1, tzinfo=timezone.utc))
    return silver.current(spark, SPECS["deputies"], root).select("id", "nomeCivil", "partido", "source_file")


@query(f"""WITH {VERSIONS_SQL}
SELECT CAST(batch AS VARCHAR) AS batch, count(*) AS records,
       count(*) FILTER (WHERE batch = first) AS new_keys,
       CAST(sum(count(*)) OVER (ORDER BY batch) AS BIGINT) AS total
FROM (SELECT *, min(batch) OVER (PARTITION BY user_id) AS first FROM versions) GROUP BY batch""")
def replay_counts(spark, sf_dir):
    """Rows, new keys and running total per loaded batch."""
    rows = versions(spark, sf_dir).select("user_id", F.col("batch").cast("string").alias("file"))
    runs = rows.groupBy("file").agg(F.count(F.lit(1)).alias("new_records"))
    firsts = rows.groupBy("user_id").agg(F.min("file").alias("file"))
    keys = firsts.groupBy("file").agg(F.count(F.lit(1)).alias("new_keys"))
    joined = runs.join(keys, "file", "left").withColumns(
        {"endpoint": F.lit("events"), "ran_at": F.to_timestamp("file")}
    )
    return ledger.running_totals(joined).select(
        F.col("file").alias("batch"),
        F.col("new_records").alias("records"),
        F.coalesce("new_keys", F.lit(0)).alias("new_keys"),
        F.col("total_records_known").alias("total"),
    )


@query(f"""WITH {VERSIONS_SQL}
SELECT event_id, CAST(batch AS VARCHAR) AS batch,
       CASE WHEN batch < DATE '2024-01-15' THEN 'none' ELSE event_type END AS tema FROM versions""")
def schema_evolution(spark, sf_dir):
    """Older batches lack a column that newer ones have."""
    log = versions(spark, sf_dir).select("event_id", "batch", F.col("event_type").alias("tema"))
    split = F.lit("2024-01-15").cast("date")
    both = history.extend_schema(log.filter(F.col("batch") < split).drop("tema"), log.filter(F.col("batch") >= split))
    return both.select(
        "event_id", F.col("batch").cast("string").alias("batch"), F.coalesce("tema", F.lit("none")).alias("tema")
    )


@query(f"""WITH {VERSIONS_SQL}, keyed AS (
  SELECT *, CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS pk FROM versions)
SELECT event_id, CAST(batch AS VARCHAR) AS batch, event_type,
       pk IS NULL OR batch = max(batch) OVER (PARTITION BY pk) AS is_current FROM keyed""")
def keyless_versions(spark, sf_dir):
    """Versions without a key never expire under the delta strategy."""
    keyed = version_table(spark, sf_dir).withColumn("pk", F.when(F.col("event_type") != "error", F.col("user_id")))
    rows = history.flag_current(keyed, "pk", "batch", "delta")
    return rows.select("event_id", F.col("batch").cast("string").alias("batch"), "event_type", "is_current")


@query(f"""WITH {VERSIONS_SQL}
SELECT count(*) AS versions, count(*) FILTER (WHERE event_type = 'error') AS without_key FROM versions""")
def keyless_count(spark, sf_dir):
    """How many versions carry no key."""
    keyed = versions(spark, sf_dir).withColumn("pk", F.when(F.col("event_type") != "error", F.col("user_id")))
    return history.keyless_count(keyed, "pk")


@query(f"""WITH {VERSIONS_SQL}
SELECT event_id, CAST(batch AS VARCHAR) AS batch,
       CASE WHEN batch < DATE '2024-01-10' THEN CAST(user_id AS VARCHAR)
            WHEN batch < DATE '2024-01-20' THEN CAST(user_id + 5000000000 AS VARCHAR)
            ELSE event_type || '-' || user_id END AS code,
       CASE WHEN batch < DATE '2024-01-10' THEN -1 ELSE CAST(round(value * 100) AS BIGINT) END AS amount
FROM versions""")
def schema_changed_types(spark, sf_dir):
    """A column that was a whole number, then a long one, then text, and one that came late; one schema for all."""
    log = version_table(spark, sf_dir).withColumn("batch", F.col("batch").cast("string"))
    root, user, day = scratch_path(spark, "evolving"), F.col("user_id"), F.col("batch")
    amount = F.round(F.col("value") * 100)
    phases = [
        (day < "2024-01-10", [user.cast("int").alias("code")]),
        ((day >= "2024-01-10") & (day < "2024-01-20"), [(user + F.lit(5_000_000_000)).alias("code"), amount.cast("int").alias("amount")]),
        (day >= "2024-01-20", [F.concat_ws("-", "event_type", user).alias("code"), amount.cast("bigint").alias("amount")]),
    ]
    # The last days are delivered as numbers first and replaced by text.
    evolution.append_batches(log.filter(phases[2][0]).select("event_id", "batch", *phases[0][1]), root)
    for days, columns in phases:
        evolution.append_batches(log.filter(days).select("event_id", "batch", *columns), root)
    return evolution.read_log(spark, root).select("event_id", "batch", "code", F.coalesce("amount", F.lit(-1)).alias("amount"))
