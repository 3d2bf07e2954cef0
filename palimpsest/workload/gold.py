"""Queries over the serving relations."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from palimpsest.operators import history, pivot
from palimpsest.operators.inherit import with_enrichment
from palimpsest.operators.joins import dimension_join
from palimpsest.plans import bronze, gold, silver
from palimpsest.plans.enrichment import SCORE, SUMMARY, TOPIC
from palimpsest.plans.entities import SPECS
from palimpsest.session import scratch_path
from palimpsest.sources import landing
from palimpsest.workload.history import versions
from palimpsest.workload.registry import VERSIONS_SQL, query, table, time_text
from palimpsest.workload.silver import (
    _PARTIES_SQL,
    PROPOSITIONS_SQL,
    VOTINGS_SQL,
    deputy_records,
    party_records,
    proposition_records,
    voting_columns,
    voting_records,
)

SITES = {"example": ["%EXAMPLE.com%"], "net": ["%.net/%"], "org": ["%.org/%", "%.edu/%"]}

# Four pages share a link list; some lists are missing or empty in each of the known ways.
_GROUPS_SQL = """
grouped AS (
  SELECT page_id // 4 AS id, CASE page_id // 4 % 10 WHEN 0 THEN NULL WHEN 1 THEN '[]' WHEN 2 THEN 'null' WHEN 3 THEN ''
           ELSE CAST(to_json(list(url)) AS VARCHAR) END AS links
  FROM pages GROUP BY 1),
unnested AS (
  SELECT id, url FROM grouped LEFT JOIN LATERAL (
    SELECT unnest(from_json(CASE WHEN links IS NULL OR links IN ('null', '[]', '') THEN '[]' ELSE links END,
                            '["VARCHAR"]')) AS url) ON true)"""


def _link_lists(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").groupBy(F.floor(F.col("page_id") / 4).alias("id"))
    kind = F.col("id") % 10
    links = F.when(kind == 0, None).when(kind == 1, "[]").when(kind == 2, "null").when(kind == 3, "")
    return pages.agg(F.to_json(F.collect_list("url")).alias("links")).withColumn(
        "links", links.otherwise(F.col("links"))
    )


@query(f"WITH {_GROUPS_SQL} SELECT id, coalesce(url, 'none') AS url FROM unnested")
def json_array_unnest_outer(spark, sf_dir):
    """One row per link; a list without links keeps its row."""
    rows = pivot.unnest_outer(_link_lists(spark, sf_dir), pivot.json_strings("links"))
    return rows.select("id", F.coalesce("url", F.lit("none")).alias("url"))


_PIVOT_SQL = f"""WITH {_GROUPS_SQL}
SELECT id, coalesce(max(CASE WHEN url ILIKE '%EXAMPLE.com%' THEN url END), 'none') AS example,
       coalesce(max(CASE WHEN url ILIKE '%.net/%' THEN url END), 'none') AS net,
       coalesce(max(CASE WHEN url ILIKE '%.org/%' OR url ILIKE '%.edu/%' THEN url END), 'none') AS org
FROM unnested GROUP BY id"""


@query(_PIVOT_SQL)
def conditional_max_pivot(spark, sf_dir):
    """Largest link per list and pattern: unnest, then partial and final maxima."""
    rows = pivot.unnest_outer(_link_lists(spark, sf_dir), pivot.json_strings("links"))
    return pivot.pivot_max(rows, "id", "url", SITES).na.fill("none", list(SITES))


@query(_PIVOT_SQL)
def conditional_max_per_row(spark, sf_dir):
    """The same per row of the list, joined back to all lists."""
    lists = _link_lists(spark, sf_dir)
    found = pivot.pivot_arrays(lists, "id", pivot.json_strings("links"), SITES)
    return lists.select("id").join(found, "id", "left").na.fill("none", list(SITES))


@query("""
SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%RED%' OR p_name ILIKE '%small%'""")
def ilike_any(spark, sf_dir):
    """Case-insensitive patterns, combined."""
    part = table(spark, sf_dir, "part")
    return part.filter(pivot.any_ilike(F.col("p_name"), ["%RED%", "%small%"])).select("p_partkey", "p_name")


@query("""
SELECT c_custkey AS id, c_name AS "nomeCivil", c_mktsegment AS partido, n_name AS estado,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'none' ELSE 'https://twitter.com/' || lower(replace(c_name, '#', '')) END AS twitter,
       'none' AS facebook,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'none' ELSE 'https://www.Instagram.com/' || lower(replace(c_name, '#', '')) END AS instagram
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal >= 0""")
def gold_deputies(spark, sf_dir):
    """Current deputies with one link per network."""
    rows = silver.transform_deputies(deputy_records(spark, sf_dir))
    stamped = history.stamp(rows, F.col("source_file"), F.lit("2024-02-01").cast("timestamp"))
    relation = gold.gold_deputies(history.current_snapshot(stamped, "source_file"))
    shown = relation.select("id", "nomeCivil", "partido", "estado", "twitter", "facebook", "instagram")
    return shown.na.fill("none", ["twitter", "facebook", "instagram"])


@query(f"""SELECT id, sigla, nome, "statusTotalMembros", "liderNome" FROM ({_PARTIES_SQL})
WHERE source_file = (SELECT 'snapshot_' || max(r_name) || '.json' FROM region)""")
def gold_parties(spark, sf_dir):
    """Parties of the last snapshot."""
    rows = landing.latest_batch(silver.transform_parties(party_records(spark, sf_dir)))
    stamped = history.stamp(rows, F.col("source_file"), F.lit("2024-02-01").cast("timestamp"))
    return gold.gold_parties(stamped).select("id", "sigla", "nome", "statusTotalMembros", "liderNome")


@query(f"""WITH {VOTINGS_SQL}
SELECT id, data, registered, "siglaOrgao", descricao, aprovacao FROM votings
QUALIFY source_file = max(source_file) OVER (PARTITION BY id)""")
def gold_votings(spark, sf_dir):
    """Current votings."""
    rows = silver.transform_votings(voting_records(spark, sf_dir))
    stamped = history.stamp(rows, F.col("source_file"), F.lit("2024-02-01").cast("timestamp"))
    return voting_columns(gold.gold_votings(history.current_delta(stamped, "id", "source_file")))


@query(f"""WITH {VERSIONS_SQL},
first AS (SELECT user_id, max(batch) AS batch, count(*) AS loads FROM versions WHERE batch < DATE '2024-01-16' GROUP BY 1),
whole AS (SELECT user_id, max(batch) AS batch, count(*) AS loads FROM versions GROUP BY 1)
SELECT user_id, CAST(batch AS VARCHAR) AS batch, loads, (SELECT count(*) FROM first) AS opened_before,
       (SELECT CAST(sum(loads) AS BIGINT) FROM first) AS loads_before FROM whole""")
def gold_refreshed(spark, sf_dir):
    """A serving relation refreshed twice, the second time from itself and the days since.

    A reader that opened it in between still finds the first refresh after the second.
    """
    root = scratch_path(spark, "relation")
    log = versions(spark, sf_dir).select("user_id", "batch")
    loads = [F.max("batch").alias("batch"), F.sum("loads").alias("loads")]
    for_day = F.lit("2024-01-16").cast("date")
    days = log.withColumn("loads", F.lit(1).cast("long"))
    opened = gold.refresh(days.filter(F.col("batch") < for_day).groupBy("user_id").agg(*loads), root)
    both = opened.unionByName(days.filter(F.col("batch") >= for_day))
    after = gold.refresh(both.groupBy("user_id").agg(*loads), root)
    before = opened.agg(F.count(F.lit(1)).alias("n"), F.sum("loads").alias("loads")).first()
    return after.select(
        "user_id",
        F.col("batch").cast("string").alias("batch"),
        "loads",
        F.lit(before.n).alias("opened_before"),
        F.lit(before.loads).cast("long").alias("loads_before"),
    )


@query(f"""WITH {PROPOSITIONS_SQL}
SELECT id, "siglaTipo", numero, ementa, presented, step, keywords FROM propositions WHERE source_file = 'delta_2.json'""")
def gold_propositions(spark, sf_dir):
    """Current propositions, materialised and read back."""
    rows = silver.transform_propositions(proposition_records(spark, sf_dir))
    stamped = history.stamp(rows, F.col("source_file"), F.lit("2024-02-01").cast("timestamp"))
    relation = gold.gold_propositions(history.current_delta(stamped, "id", "source_file"))
    stored = gold.refresh(relation, scratch_path(spark, "gold"))
    return stored.select(
        "id",
        "siglaTipo",
        "numero",
        "ementa",
        F.coalesce(time_text("dataApresentacao"), F.lit("unparsed")).alias("presented"),
        F.col("statusCodTipoTramitacao").alias("step"),
        "keywords",
    )


_NEVER = [
    "codTipo", "statusDataHora", "statusSequencia", "statusSiglaOrgao", "statusRegime", "statusDescricaoTramitacao",
    "statusDescricaoSituacao", "statusCodSituacao", "statusDespacho", "statusAmbito", "statusApreciacao",
    "descricaoTipo", "ementaDetalhada",
]


@query(f"""WITH {PROPOSITIONS_SQL}
SELECT CAST(id AS VARCHAR) AS id, "siglaTipo", CAST(numero AS VARCHAR) AS numero, '2024' AS ano, ementa,
       CASE presented WHEN 'unparsed' THEN 'none' ELSE presented END AS "dataApresentacao",
       step AS "statusCodTipoTramitacao", keywords, '2024-02-01 00:00:00' AS loaded_at,
       CASE WHEN id % 3 > 0 THEN "siglaTipo" ELSE 'none' END AS tema_classificado,
       CASE WHEN id % 3 > 0 THEN CAST(numero / 8.0 AS VARCHAR) ELSE 'none' END AS tema_score,
       CASE WHEN id % 2 = 0 THEN 'about ' || id ELSE 'none' END AS resumo_executivo,
       {", ".join(f"""'none' AS "{c}\"""" for c in _NEVER)}
FROM propositions WHERE source_file = 'delta_2.json'""")
def gold_propositions_enriched(spark, sf_dir):
    """All columns of the current propositions, with topics and summaries where the enrichment tables have any."""
    rows = silver.transform_propositions(proposition_records(spark, sf_dir))
    stamped = history.stamp(rows, F.col("source_file"), F.lit("2024-02-01").cast("timestamp"))
    current = history.current_delta(stamped, "id", "source_file").withColumn("batch", F.col("source_file"))
    known = current.select("id", "batch", F.lit("2024-02-02").cast("timestamp").alias("enriched_at"), "siglaTipo", "numero")
    topics = known.filter("id % 3 > 0").select(
        "id", "batch", "enriched_at", F.col("siglaTipo").alias(TOPIC), (F.col("numero") / 8).alias(SCORE)
    )
    # An older record of the same version gives way.
    older = topics.withColumns({"enriched_at": F.lit("2024-02-01").cast("timestamp"), TOPIC: F.lit("old")})
    summaries = known.filter("id % 2 = 0").select(
        "id", "batch", "enriched_at", F.concat(F.lit("about "), "id").alias(SUMMARY)
    )
    enriched = with_enrichment(with_enrichment(current, topics.union(older), "id", "batch"), summaries, "id", "batch")
    relation = gold.gold_propositions(enriched)
    return relation.select(*[F.coalesce(F.col(c).cast("string"), F.lit("none")).alias(c) for c in relation.columns])


@query("""
SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def dimension_lookup(spark, sf_dir):
    """Customers with their nation, the dimension's size checked first."""
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return dimension_join(table(spark, sf_dir, "customer"), nations, "c_nationkey").select(
        "c_custkey", "c_name", "n_name"
    )


@query("""
WITH stamped AS (SELECT *, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS stamp FROM events),
run1 AS (SELECT * FROM stamped WHERE day <= '2024-01-12'),
run2 AS (SELECT * FROM stamped WHERE stamp > (SELECT max(stamp) FROM run1)),
landed AS (SELECT 'delta_1' AS batch, * FROM run1 UNION ALL SELECT 'delta_2', * FROM run2),
versions AS (SELECT * FROM landed QUALIFY row_number() OVER (PARTITION BY batch, user_id ORDER BY event_id) = 1)
SELECT CAST(user_id AS VARCHAR) AS id, day AS data, replace(stamp, 'T', ' ') AS registered, upper(event_type) AS "siglaOrgao",
       props AS descricao, CASE WHEN event_type = 'error' THEN 'open' WHEN value > 10 THEN '1' ELSE '0' END AS aprovacao
FROM versions QUALIFY batch = max(batch) OVER (PARTITION BY user_id)""")
def bronze_to_gold_votings(spark, sf_dir):
    """Two incremental runs landed as Parquet, loaded to history together, and the serving relation."""
    spec = SPECS["votings"]
    landed, runs, root, files = (scratch_path(spark, p) for p in ("landed", "runs", "silver", "files"))
    records = voting_records(spark, sf_dir).drop("source_file")
    for file, day in (("delta_1", date(2024, 1, 12)), ("delta_2", date(2024, 2, 10))):
        at = datetime(day.year, day.month, day.day, tzinfo=timezone.utc)
        bronze.ingest_delta(spark, records, "votings", spec.mark, landed, runs, file, at, day)
    silver.run_batches(spark, spec, landed, runs, root, files, datetime(2024, 2, 11, tzinfo=timezone.utc))
    return voting_columns(gold.gold_votings(silver.current(spark, spec, root)))
