"""Queries over sources, ledgers and incremental ingest."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Window, functions as F

from palimpsest.operators import watermark as wm
from palimpsest.operators.shaping import merge_detail
from palimpsest.plans import bronze
from palimpsest.session import scratch_path, stored
from palimpsest.sources import landing, ledger
from palimpsest.workload.registry import cents, day_text, iso, query, table

MARK = "2024-01-15T00:00:00"


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("batch", day_text("ts"))


@query("""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS batch, count(*) AS records, count(DISTINCT user_id) AS users,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
FROM events GROUP BY 1""")
def json_batch_scan(spark, sf_dir):
    """Events landed as JSON batches, found by pattern and read back under a given schema."""
    events = _events(spark, sf_dir)
    path = scratch_path(spark, "json-batches")
    events.withColumn("ts", iso("ts")).write.partitionBy("batch").json(path)
    schema = events.drop("batch").withColumn("ts", iso("ts")).schema
    read = landing.read_json_batches(spark, path, schema, pattern="part-*.json", array_files=False)
    return read.groupBy(F.col("batch").cast("string").alias("batch")).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("user_id").alias("users"),
        F.sum(cents("value")).alias("cents"),
    )


@query("""
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderstatus FROM orders
WHERE strftime(o_orderdate, '%Y-%m') = (SELECT max(strftime(o_orderdate, '%Y-%m')) FROM orders)""")
def latest_batch(spark, sf_dir):
    """Orders in monthly batches; only the last batch by name counts."""
    orders = table(spark, sf_dir, "orders").withColumn("batch", F.date_format("o_orderdate", "yyyy-MM"))
    last = landing.latest_batch(orders, "batch")
    return last.select("o_orderkey", day_text("o_orderdate").alias("o_orderdate"), "o_orderstatus")


@query("""
WITH ledger AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events
                WHERE user_id = 1 OR CAST(ts AS DATE) < DATE '2024-01-08')
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS batch, event_id FROM events
WHERE CAST(ts AS DATE) NOT IN (SELECT day FROM ledger)""")
def pending_batches(spark, sf_dir):
    """Events of the batches that the file ledger does not list."""
    events = _events(spark, sf_dir)
    done = events.filter((F.col("user_id") == 1) | (F.col("batch") < "2024-01-08"))
    seen = done.select(F.col("batch").alias("file_name")).distinct()
    found = events.select(F.col("batch").alias("file_name")).distinct()
    pending = ledger.pending_files(found, seen, ["file_name"]).withColumnRenamed("file_name", "batch")
    return events.join(pending, "batch", "left_semi").select("batch", "event_id")


@query("""
WITH ledger AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events
                WHERE user_id = 1 OR CAST(ts AS DATE) < DATE '2024-01-08')
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS batch, event_id FROM events
WHERE CAST(ts AS DATE) NOT IN (SELECT day FROM ledger)""")
def pending_pruned(spark, sf_dir):
    """The same from landed batches: what is pending stays a table, and only its partitions are read."""
    events, root = _events(spark, sf_dir).select("batch", "event_id", "user_id"), scratch_path(spark, "batches")
    landing.append_batches(events, root)
    landed = landing.read_batches(spark, root, events.drop("batch").schema)
    done = landed.filter((F.col("user_id") == 1) | (F.col("batch") < "2024-01-08"))
    names = lambda rows: rows.select(F.col("batch").alias("file_name")).distinct()
    pending = stored(ledger.pending_files(names(landed), names(done), ["file_name"]), "pending")
    return landing.of_batches(landed, pending).select("batch", "event_id")


# Stamps to the hour, so that many records share the mark's instant.
_HOURS_SQL = "hours AS (SELECT event_id, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H') AS stamp FROM events)"
_EARLY_SQL = "event_id % 3 > 0 AND stamp <= '2024-01-15T12'"
_KNOWN_SQL = f"""WITH {_HOURS_SQL}, first AS (SELECT * FROM hours WHERE {_EARLY_SQL})
SELECT event_id, stamp, 'delta_1' AS run FROM first
UNION ALL
SELECT event_id, stamp, 'delta_2' FROM hours
WHERE stamp >= (SELECT max(stamp) FROM first) AND event_id NOT IN (SELECT event_id FROM first)"""


def _hours(spark, sf_dir):
    hours = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH").alias("stamp"))
    return hours, (F.col("event_id") % 3 > 0) & (F.col("stamp") <= "2024-01-15T12")


@query(_KNOWN_SQL)
def ingest_known_ids(spark, sf_dir):
    """Two runs that remember their ids: the second takes what the first left of the mark's own instant, and no more."""
    root, book = scratch_path(spark, "batches"), scratch_path(spark, "runs")
    hours, early = _hours(spark, sf_dir)
    at = datetime(2024, 2, 1, tzinfo=timezone.utc)
    for k, rows in enumerate((hours.filter(early), hours), 1):
        bronze.ingest_delta(
            spark, rows, "votings", "stamp", root, book, f"delta_{k}", at, date(2024, 2, 10), 3, remember="event_id"
        )
    return landing.read_batches(spark, root, hours.schema).withColumnRenamed("batch", "run")


@query(f"""WITH {_HOURS_SQL}
SELECT event_id, stamp FROM hours
WHERE stamp >= strftime(CAST((SELECT max(stamp) FROM hours WHERE {_EARLY_SQL})[1:10] AS DATE), '%Y-%m-%d')
  AND stamp < '2024-01-21'""")
def window_days_pruned(spark, sf_dir):
    """Records landed by day; the window's first day comes from the ledger when the scan runs, other days are not read."""
    root, book = scratch_path(spark, "days"), scratch_path(spark, "runs")
    hours, early = _hours(spark, sf_dir)
    hours.withColumn("day", F.substring("stamp", 1, 10)).hint("rebalance", F.col("day")).write.partitionBy("day").parquet(root)
    first = ledger.delta_run(
        hours.filter(early), "votings", "delta_1", datetime(2024, 2, 1, tzinfo=timezone.utc),
        date(2024, 1, 1), date(2024, 1, 31), "stamp", None,
    )
    ledger.record_run(first, book)
    start = ledger.window_start(ledger.read_runs(spark, book), "votings", 3, date(2024, 1, 20))
    landed = spark.read.schema(hours.withColumn("day", F.lit("")).schema).parquet(root)
    return wm.in_days(landed, "day", start, date(2024, 1, 20)).drop("day")


@query("""
WITH landed AS (SELECT page_id // 100 AS run, page_id % 100 + 1 AS page FROM pages WHERE page_id * 7 % 11 > 2),
edges AS (SELECT run, lag(page, 1, 0) OVER (PARTITION BY run ORDER BY page) AS before, page AS after FROM landed)
SELECT run, before + 1 AS first_missing, after - 1 AS last_missing, after - before - 1 AS missing
FROM edges WHERE after > before + 1""")
def page_gaps(spark, sf_dir):
    """Pages that runs left out, some of them neighbours, some before the first."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.floor(F.col("page_id") / 100).alias("run"))
    landed = pages.filter(F.col("page_id") * 7 % 11 > 2).withColumn("page", F.col("page_id") % 100 + 1)
    return landing.page_gaps(landed, "run")


@query("""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS batch, count(*) AS records,
       CAST(sum(CAST(round(value * 100) AS BIGINT) + CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN 1 ELSE 0 END)
            AS BIGINT) AS cents
FROM events GROUP BY 1""")
def batch_sink_replaced(spark, sf_dir):
    """Batches written, then the later ones delivered again with other contents: these replace their first copy."""
    events = _events(spark, sf_dir).select("batch", "event_id", cents("value").alias("cents"))
    path = scratch_path(spark, "batches")
    landing.append_batches(events, path)
    again = events.filter(F.col("batch") >= "2024-01-20").withColumn("cents", F.col("cents") + 1)
    landing.append_batches(again, path)
    read = landing.read_batches(spark, path, events.drop("batch").schema)
    return read.groupBy("batch").agg(F.count(F.lit(1)).alias("records"), F.sum("cents").alias("cents"))


@query("""
SELECT event_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS batch FROM events ORDER BY event_id LIMIT 3""")
def dry_run_preview(spark, sf_dir):
    """The first transformed rows; nothing is written."""
    rows = _events(spark, sf_dir).select("event_id", "event_type", "batch")
    return landing.preview(rows.orderBy("event_id"), 3)


@query("""
SELECT 'week ' || strftime(date_trunc('week', ts), '%Y-%m-%d') AS file, count(*) AS records,
       count(DISTINCT user_id) AS ids, CAST(min(user_id) AS BIGINT) AS first_id, CAST(max(user_id) AS BIGINT) AS last_id
FROM events GROUP BY 1""")
def snapshot_ledger(spark, sf_dir):
    """Weekly snapshots: records and distinct ids per run, the ids held as a table."""
    weeks = table(spark, sf_dir, "events").withColumn(
        "file", F.concat(F.lit("week "), F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd"))
    )
    ids = ledger.known_ids(weeks, "user_id", "file").groupBy("file")
    counted = weeks.groupBy("file").agg(F.count(F.lit(1)).alias("records"))
    return counted.join(
        ids.agg(
            F.count(F.lit(1)).alias("ids"), F.min("user_id").alias("first_id"), F.max("user_id").alias("last_id")
        ),
        "file",
    )


@query("""
WITH firsts AS (SELECT event_type AS endpoint, user_id, min(CAST(ts AS DATE)) AS day FROM events GROUP BY 1, 2),
     runs AS (SELECT event_type AS endpoint, CAST(ts AS DATE) AS day, count(*) AS new_records FROM events GROUP BY 1, 2),
     keys AS (SELECT endpoint, day, count(*) AS new_keys FROM firsts GROUP BY 1, 2)
SELECT runs.endpoint, CAST(runs.day AS VARCHAR) AS file, new_records, coalesce(new_keys, 0) AS new_keys,
       CAST(sum(new_records) OVER (PARTITION BY runs.endpoint ORDER BY runs.day) AS BIGINT) AS total_records_known
FROM runs LEFT JOIN keys USING (endpoint, day)""")
def delta_ledger(spark, sf_dir):
    """Daily runs per feed: new records, ids not seen before, and records known so far."""
    events = _events(spark, sf_dir).withColumnRenamed("event_type", "endpoint")
    runs = events.groupBy("endpoint", F.col("batch").alias("file")).agg(F.count(F.lit(1)).alias("new_records"))
    firsts = events.groupBy("endpoint", "user_id").agg(F.min("batch").alias("file"))
    keys = firsts.groupBy("endpoint", "file").agg(F.count(F.lit(1)).alias("new_keys"))
    ledger_rows = runs.join(keys, ["endpoint", "file"], "left").withColumn("ran_at", F.to_timestamp("file"))
    return ledger.running_totals(ledger_rows).select(
        "endpoint", "file", "new_records", F.coalesce("new_keys", F.lit(0)).alias("new_keys"), "total_records_known"
    )


@query("""
SELECT conv_id, turn // 100 AS page, turn, role, text FROM conversations""")
def page_unnest(spark, sf_dir):
    """Turns folded to list pages of up to 100 records, and unnested again in page order."""
    turns = table(spark, sf_dir, "conversations")
    record = F.struct("turn", "role", "text")
    pages = turns.groupBy("conv_id", F.floor(F.col("turn") / 100).alias("page")).agg(
        F.sort_array(F.collect_list(record)).alias("dados")
    )
    return landing.unnest_pages(pages).select(
        "conv_id", F.col(f"{landing.ORDINAL}.page").alias("page"), "turn", "role", "text"
    )


@query("""
WITH detail AS (SELECT l_orderkey, count(*) AS lines, CAST(sum(l_quantity) AS BIGINT) AS quantity
                FROM lineitem GROUP BY 1)
SELECT o_orderkey AS id, o_orderpriority AS priority, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
       coalesce(CAST(lines AS VARCHAR), 'none') AS lines, coalesce(CAST(quantity AS VARCHAR), 'none') AS quantity
FROM orders LEFT JOIN detail ON o_orderkey = l_orderkey""")
def list_detail_merge(spark, sf_dir):
    """Orders as list records, each with the detail record of its uri, if any."""
    merged = merge_detail(_order_summaries(spark, sf_dir), _order_details(spark, sf_dir))
    return merged.select(
        "id",
        F.col("summary.priority").alias("priority"),
        F.col("summary.cents").alias("cents"),
        F.coalesce(F.col("detail.lines").cast("string"), F.lit("none")).alias("lines"),
        F.coalesce(F.col("detail.quantity").cast("string"), F.lit("none")).alias("quantity"),
    )


def _order_summaries(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("/orders/"), "o_orderkey").alias("uri"),
        F.col("o_orderpriority").alias("priority"),
        cents("o_totalprice").alias("cents"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm").alias("dataApresentacao"),
    )


def _order_details(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").cast("bigint").alias("quantity")
    )
    return lines.select(
        F.concat(F.lit("/orders/"), "l_orderkey").alias("uri"), F.struct("lines", "quantity").alias("detail")
    )


@query(f"""
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS stamp FROM events
WHERE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') > '{MARK}'""")
def hwm_filter(spark, sf_dir):
    """Events after the mark: its day bounds the scan, the exact text comparison is left to the rest."""
    start, end = wm.ingest_window(MARK, 3, date(2024, 12, 31))
    recent = wm.in_window(table(spark, sf_dir, "events"), "ts", start, end)
    return wm.newer_than(recent.select("event_id", iso("ts").alias("stamp")), "stamp", MARK)


@query("""
WITH runs AS (
  SELECT event_type AS endpoint, CAST(CAST(ts AS DATE) AS VARCHAR) AS file,
         max(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')) AS candidate
  FROM events GROUP BY 1, 2)
SELECT endpoint, file, candidate, max(candidate) OVER (PARTITION BY endpoint ORDER BY file) AS mark FROM runs""")
def hwm_advance(spark, sf_dir):
    """Candidate mark of every daily run and the mark after it."""
    runs = (
        _events(spark, sf_dir)
        .withColumn("stamp", iso("ts"))
        .groupBy(F.col("event_type").alias("endpoint"), F.col("batch").alias("file"))
        .agg(wm.candidate_mark("stamp").alias("candidate"))
    )
    so_far = Window.partitionBy("endpoint").orderBy("file")
    before = F.max("candidate").over(so_far.rowsBetween(Window.unboundedPreceding, -1))
    return runs.withColumn("_before", before).select(
        "endpoint", "file", "candidate", wm.advance_mark(F.col("_before"), F.col("candidate")).alias("mark")
    )


@query("""
SELECT user_id, CAST(coalesce(CAST(substr(max(CASE WHEN value > 50 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END), 1, 10)
            AS DATE), DATE '2024-01-31' - 90) AS VARCHAR) AS window_start
FROM events GROUP BY user_id""")
def ingest_windows(spark, sf_dir):
    """First day to ask for, per user as a feed: the day of its mark, or three months back without one."""
    marks = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.max(F.when(F.col("value") > 50, iso("ts"))).alias("mark")
    )
    start = wm.window_start(F.col("mark"), wm.FIRST_RUN_MONTHS["votings"], F.lit(date(2024, 1, 31)))
    return marks.select("user_id", start.cast("string").alias("window_start"))


@query("""
WITH ranges AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first, max(CAST(o_orderdate AS DATE)) AS last
                FROM orders GROUP BY 1),
     starts AS (SELECT o_custkey, last, CAST(unnest(generate_series(first, last, INTERVAL 91 DAY)) AS DATE) AS start FROM ranges)
SELECT o_custkey, CAST(start AS VARCHAR) AS chunk_start, CAST(least(start + 90, last) AS VARCHAR) AS chunk_end
FROM starts""")
def date_chunks(spark, sf_dir):
    """Each customer's order period, cut into adjacent windows."""
    ranges = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min(F.to_date("o_orderdate")).alias("first"), F.max(F.to_date("o_orderdate")).alias("last")
    )
    return wm.date_chunks(ranges, "first", "last").select(
        "o_custkey", F.col("chunk_start").cast("string"), F.col("chunk_end").cast("string")
    )


@query("""
WITH windows AS (
  SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 91 DAY)) AS DATE) AS chunk_start)
SELECT CAST(chunk_start AS VARCHAR) AS chunk_start,
       CAST(least(chunk_start + 90, DATE '2001-12-31') AS VARCHAR) AS chunk_end, count(*) AS orders,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
FROM orders JOIN windows
  ON CAST(o_orderdate AS DATE) BETWEEN chunk_start AND least(chunk_start + 90, DATE '2001-12-31')
GROUP BY 1, 2""")
def chunk_totals(spark, sf_dir):
    """Orders assigned to their window, and counted per window."""
    start, end = date(1995, 1, 1), date(2001, 12, 31)
    orders = wm.in_window(table(spark, sf_dir, "orders"), "o_orderdate", start, end)
    placed = wm.with_chunk(orders, F.to_date("o_orderdate"), start, end)
    return placed.groupBy(F.col("chunk_start").cast("string"), F.col("chunk_end").cast("string")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(cents("o_totalprice")).alias("cents")
    )


@query("""
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_orderstatus FROM orders ORDER BY o_orderdate, o_orderkey""")
def ordered_listing(spark, sf_dir):
    """The whole source list in ascending order: a range-partitioned sort."""
    listed = wm.listing(table(spark, sf_dir, "orders"), "o_orderdate", "o_orderkey")
    return listed.select("o_orderkey", day_text("o_orderdate").alias("day"), "o_orderstatus")


@query("""
SELECT o_orderpriority, count(*) AS orders FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-05-30' GROUP BY 1""")
def window_pushdown(spark, sf_dir):
    """One inclusive day window, in a form the scan can use."""
    orders = wm.in_window(table(spark, sf_dir, "orders"), "o_orderdate", date(1997, 3, 1), date(1997, 5, 30))
    return orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"))


@query("""
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100""")
def trial_cap(spark, sf_dir):
    """A capped trial run takes the oldest records."""
    return wm.oldest(table(spark, sf_dir, "orders"), "o_orderdate", 100, "o_orderkey").select(
        "o_orderkey", day_text("o_orderdate").alias("day")
    )


@query("""
WITH stamped AS (SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS stamp FROM events),
     run1 AS (SELECT * FROM stamped WHERE substr(stamp, 1, 10) BETWEEN '2023-10-12' AND '2024-01-10'),
     mark AS (SELECT max(stamp) AS m FROM run1),
     run2 AS (SELECT * FROM stamped, mark WHERE stamp > m AND substr(stamp, 1, 10) BETWEEN substr(m, 1, 10) AND '2024-02-10')
SELECT 'delta_1' AS batch, event_id, 'new' AS status FROM run1
UNION ALL SELECT 'delta_2', event_id, 'new' FROM run2
UNION ALL SELECT 'delta_1', (SELECT count(*) FROM run1), 'ledger ' || (SELECT m FROM mark)
UNION ALL SELECT 'delta_2', (SELECT count(*) FROM run1) + (SELECT count(*) FROM run2),
                 'ledger ' || coalesce((SELECT max(stamp) FROM run2), (SELECT m FROM mark))""")
def ingest_votings(spark, sf_dir):
    """Two incremental runs, the second resuming at the first one's mark; batches, totals and marks."""
    root, book = scratch_path(spark, "votings"), scratch_path(spark, "runs")
    stamped = table(spark, sf_dir, "events").select("event_id", iso("ts").alias("dataHoraRegistro"))
    for file, day in (("delta_1", date(2024, 1, 10)), ("delta_2", date(2024, 2, 10))):
        ran_at = datetime(day.year, day.month, day.day, tzinfo=timezone.utc)
        bronze.ingest_delta(spark, stamped, "votings", "dataHoraRegistro", root, book, file, ran_at, day)
    batches = landing.read_batches(spark, root, stamped.schema).select("batch", "event_id", F.lit("new").alias("status"))
    totals = ledger.running_totals(ledger.read_runs(spark, book))
    return batches.unionByName(
        totals.select(
            F.col("file").alias("batch"),
            F.col("total_records_known").alias("event_id"),
            F.concat(F.lit("ledger "), "hwm").alias("status"),
        )
    )


@query("""
WITH fresh AS (SELECT * FROM orders WHERE strftime(o_orderdate, '%Y-%m-%dT%H:%M') > '1997-06-15T00:00'
                 AND CAST(o_orderdate AS DATE) BETWEEN DATE '1997-06-15' AND DATE '2001-12-31'),
     detail AS (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY 1)
SELECT o_orderkey AS id, coalesce(CAST(lines AS VARCHAR), 'none') AS lines,
       (SELECT max(strftime(o_orderdate, '%Y-%m-%dT%H:%M')) FROM fresh) AS hwm
FROM fresh LEFT JOIN detail ON o_orderkey = l_orderkey""")
def ingest_propositions(spark, sf_dir):
    """An incremental run with detail merge, after an earlier run left a mark."""
    root, book = scratch_path(spark, "propositions"), scratch_path(spark, "runs")
    first = spark.createDataFrame([("1997-06-15T00:00",)], "dataApresentacao string")
    long_ago = datetime(1997, 6, 15, tzinfo=timezone.utc)
    earlier = ledger.delta_run(
        first, "propositions", "delta_0", long_ago, date(1996, 6, 20), date(1997, 6, 15), "dataApresentacao", None
    )
    ledger.record_run(earlier, book)
    run = bronze.ingest_delta(
        spark,
        _order_summaries(spark, sf_dir),
        "propositions",
        "dataApresentacao",
        root,
        book,
        "delta_1",
        datetime(2001, 12, 31, tzinfo=timezone.utc),
        date(2001, 12, 31),
        details=_order_details(spark, sf_dir),
    )
    written = spark.read.parquet(f"{root}/batch=delta_1")
    return written.select(
        "id",
        F.coalesce(F.col("detail.lines").cast("string"), F.lit("none")).alias("lines"),
        F.lit(run["hwm"]).alias("hwm"),
    )


@query("""
WITH detail AS (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1)
SELECT 'snapshot_2024-02-01' AS file, c_custkey AS id, c_name AS nome,
       coalesce(CAST(orders AS VARCHAR), 'none') AS orders, (SELECT count(*) FROM customer) AS known,
       (SELECT count(*) FROM customer) AS ids
FROM customer LEFT JOIN detail ON c_custkey = o_custkey""")
def ingest_snapshot(spark, sf_dir):
    """A snapshot run over all customers, each with its detail record twice, run twice on one day."""
    root, book = scratch_path(spark, "deputies"), scratch_path(spark, "runs")
    listed = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.concat(F.lit("/c/"), "c_custkey").alias("uri"), F.col("c_name").alias("nome")
    )
    counted = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    once = counted.select(F.concat(F.lit("/c/"), "o_custkey").alias("uri"), F.struct("orders").alias("detail"))
    details = once.union(once)
    day = date(2024, 2, 1)
    for hour in (8, 9):
        ran_at = datetime(2024, 2, 1, hour, tzinfo=timezone.utc)
        bronze.ingest_snapshot(spark, listed, details, "deputies", root, book, day, ran_at, "nome")
    last = ledger.latest_snapshot(ledger.read_runs(spark, book)).first()
    return spark.read.parquet(f"{root}/batch={last['file']}").select(
        F.lit(last["file"]).alias("file"),
        "id",
        F.col("summary.nome").alias("nome"),
        F.coalesce(F.col("detail.orders").cast("string"), F.lit("none")).alias("orders"),
        F.lit(last["new_records"]).alias("known"),
        F.lit(ledger.read_ids(spark, book).filter(F.col("file") == last["file"]).count()).alias("ids"),
    )
