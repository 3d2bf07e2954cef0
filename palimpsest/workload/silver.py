"""Queries over shaping and the silver transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.operators import shaping
from palimpsest.operators.dedup import keep_first
from palimpsest.operators.shaping import flatten, json_text, project, typed
from palimpsest.plans import silver
from palimpsest.plans.entities import SPECS
from palimpsest.sources.landing import deal_rows
from palimpsest.workload.registry import bronze_record, day_text, query, table, time_text


@query("""
SELECT event_id, user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS batch, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id ORDER BY event_id) = 1""")
def dedup_keep_first(spark, sf_dir):
    """First event per user and day."""
    events = table(spark, sf_dir, "events").withColumn("batch", F.to_date("ts"))
    return keep_first(events, ["batch", "user_id"], ["event_id"]).select(
        "event_id", "user_id", F.col("batch").cast("string").alias("batch"), "event_type"
    )


@query("""
SELECT event_id, event_type AS "detail.kind", CAST(json_extract(props, '$.k') AS BIGINT) AS "detail.props.k" FROM events""")
def flatten_json(spark, sf_dir):
    """JSON text to a nested record, and the record to one column per leaf."""
    nested = table(spark, sf_dir, "events").select(
        "event_id",
        F.struct(
            F.col("event_type").alias("kind"), F.from_json("props", "struct<k:bigint>").alias("props")
        ).alias("detail"),
    )
    return flatten(nested, "detail", prefix="detail.")


@query("""
SELECT event_id, event_type AS "detail.kind",
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS "detail.props.k",
       CASE WHEN event_type = 'error' THEN CAST(user_id AS BIGINT) END AS "detail.failure.user",
       CASE WHEN event_type = 'error' THEN 'a,' || event_id END AS "detail.failure.tags",
       CASE WHEN event_type = 'error' THEN CAST(event_id AS VARCHAR) ELSE event_type END AS "detail.mixed"
FROM events""")
def flatten_found(spark, sf_dir):
    """JSON whose fields no schema names: found in the data, one column per leaf."""
    events, failed = table(spark, sf_dir, "events"), F.col("event_type") == "error"
    failure = F.struct(F.col("user_id").alias("user"), F.array(F.lit("a"), F.col("event_id").cast("string")).alias("tags"))
    number = F.to_json(F.struct(F.col("event_type").alias("kind"), failure.alias("failure"), F.col("event_id").alias("mixed")))
    plain = F.to_json(
        F.struct(F.col("event_type").alias("kind"), F.from_json("props", "struct<k:bigint>").alias("props"), F.col("event_type").alias("mixed"))
    )
    found = shaping.flatten_found(events.select("event_id", F.when(failed, number).otherwise(plain).alias("detail")), "detail", "detail.")
    tags = F.col("`detail.failure.tags`")
    return found.withColumn("detail.failure.tags", F.when(tags.isNotNull(), F.array_join(tags, ",")))


@query("""
SELECT c_custkey AS id, c_name AS nome, CAST(c_nationkey AS BIGINT) AS estado, c_mktsegment AS partido FROM customer""")
def project_rename(spark, sf_dir):
    """Columns chosen, renamed and typed from a listing."""
    columns = [
        ("c_custkey", "id", "bigint", False),
        ("c_name", "nome", "string", False),
        ("c_nationkey", "estado", "bigint", False),
        ("c_mktsegment", "partido", "string", False),
    ]
    return project(table(spark, sf_dir, "customer"), columns)


_STAMP_SQL = """CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%d.%m.%Y')
  WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M') ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END"""


def _stamps(spark, sf_dir):
    """Order dates as text in two good forms and one that does not parse."""
    status, day = F.col("o_orderstatus"), F.col("o_orderdate")
    text = (
        F.when(status == "P", F.date_format(day, "dd.MM.yyyy"))
        .when(status == "F", F.date_format(day, "yyyy-MM-dd'T'HH:mm"))
        .otherwise(F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("stamp"))


@query(f"""
SELECT o_orderkey, coalesce(strftime(try_cast({_STAMP_SQL} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S'), 'unparsed') AS parsed
FROM orders""")
def timestamp_or_null(spark, sf_dir):
    """Timestamps parsed value by value; text in another form becomes NULL."""
    parsed = typed(F.col("stamp"), "timestamp_ntz", lenient=True)
    return _stamps(spark, sf_dir).select(
        "o_orderkey", F.coalesce(time_text(parsed), F.lit("unparsed")).alias("parsed")
    )


@query("""
SELECT o_orderkey, coalesce(CAST(try_cast(CASE WHEN o_orderstatus = 'P' THEN 'n/a'
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS DATE) AS VARCHAR), 'unparsed') AS parsed
FROM orders""")
def date_or_null(spark, sf_dir):
    """Dates parsed value by value."""
    text = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(day_text("o_orderdate"))
    parsed = typed(text, "date", lenient=True)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.coalesce(parsed.cast("string"), F.lit("unparsed")).alias("parsed")
    )


@query("""
SELECT o_orderstatus, count(CASE WHEN o_orderstatus <> 'P' THEN substr(o_orderpriority, 1, 1) END) AS known,
       CAST(coalesce(sum(CASE WHEN o_orderstatus <> 'P' THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END), 0) AS BIGINT) AS total
FROM orders GROUP BY 1""")
def nullable_int(spark, sf_dir):
    """Integers that may be missing."""
    text = F.when(F.col("o_orderstatus") != "P", F.substring("o_orderpriority", 1, 1))
    orders = table(spark, sf_dir, "orders").withColumn("rank", typed(text, "int"))
    return orders.groupBy("o_orderstatus").agg(
        F.count("rank").alias("known"), F.coalesce(F.sum("rank"), F.lit(0)).alias("total")
    )


@query("""
SELECT conv_id, turn, CAST(to_json(string_split(text, ' ')) AS VARCHAR) AS words,
       CAST(to_json({'role': role, 'turn': turn, 'none': NULL}) AS VARCHAR) AS head
FROM conversations""")
def nested_to_json(spark, sf_dir):
    """Arrays and records as JSON text."""
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.split("text", " ").alias("words"),
        F.struct("role", "turn", F.lit(None).cast("string").alias("none")).alias("head"),
    )
    return json_text(turns)


def deputy_records(spark, sf_dir):
    """Customers as deputies in bronze shape: two snapshots, the second without customers in debt.

    Each record comes twice; the second copy has another name and must not win.
    """
    customers = deal_rows(table(spark, sf_dir, "customer")).join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    copies = customers.withColumn("_ordinal", F.explode(F.array(F.lit(1), F.lit(2))))
    both = copies.withColumn(
        "source_file",
        F.explode(
            F.when(
                F.col("c_acctbal") >= 0, F.array(F.lit("snapshot_2024-01-01.json"), F.lit("snapshot_2024-01-02.json"))
            ).otherwise(F.array(F.lit("snapshot_2024-01-01.json")))
        ),
    )
    handle = F.lower(F.regexp_replace("c_name", "#", ""))
    links = F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None)).otherwise(
        F.array(
            F.concat(F.lit("https://X.com/"), handle),
            F.concat(F.lit("https://www.Instagram.com/"), handle),
            F.concat(F.lit("https://twitter.com/"), handle),
            F.lit("https://example.org/"),
        )
    )
    values = {
        "id": F.col("c_custkey"),
        "detail.id": F.col("c_custkey"),
        "detail.nomeCivil": F.concat("c_name", F.when(F.col("_ordinal") == 2, " again").otherwise("")),
        "detail.cpf": F.concat(F.lit("cpf-"), "c_custkey"),
        "detail.redeSocial": links,
        "detail.ultimoStatus.siglaPartido": F.col("c_mktsegment"),
        "detail.ultimoStatus.siglaUf": F.col("n_name"),
        "detail.ultimoStatus.gabinete.sala": F.col("c_nationkey"),
        "detail.ultimoStatus.idLegislatura": F.col("n_regionkey"),
        "summary.id": F.col("c_custkey"),
        "summary.nome": F.col("c_name"),
    }
    return bronze_record(both, SPECS["deputies"].bronze_schema(), values, "source_file", "_ordinal")


@query("""
WITH files AS (SELECT 'snapshot_2024-01-01.json' AS source_file UNION ALL SELECT 'snapshot_2024-01-02.json')
SELECT source_file, c_custkey AS deputado_id, c_custkey AS id, c_name AS "nomeCivil", c_mktsegment AS partido,
       n_name AS estado, CAST(c_nationkey AS VARCHAR) AS "gabineteSala", CAST(n_regionkey AS BIGINT) AS "idLegislatura",
       c_name AS "resumoNome"
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey, files
WHERE c_acctbal >= 0 OR source_file = 'snapshot_2024-01-01.json'""")
def silver_deputies(spark, sf_dir):
    """Nested records flattened to the deputies' columns, first copy per id and file."""
    rows = silver.transform_deputies(deputy_records(spark, sf_dir))
    return rows.select(
        "source_file", "deputado_id", "id", "nomeCivil", "partido", "estado", "gabineteSala", "idLegislatura", "resumoNome"
    )


def party_records(spark, sf_dir):
    """Market segments as parties in bronze shape, one snapshot per region, with member counts."""
    customers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    regions = customers.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    parties = regions.groupBy("r_name", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("members"), F.min_by("c_name", "c_custkey").alias("leader"), F.min("c_custkey").alias("id")
    )
    values = {
        "id": F.col("id"),
        "detail.sigla": F.col("c_mktsegment"),
        "detail.nome": F.initcap("c_mktsegment"),
        "detail.status.totalMembros": F.col("members"),
        "detail.status.lider.nome": F.col("leader"),
    }
    records = parties.withColumns(
        {"source_file": F.concat(F.lit("snapshot_"), "r_name", F.lit(".json")), "_ordinal": F.col("id")}
    )
    return bronze_record(records, SPECS["parties"].bronze_schema(), values, "source_file", "_ordinal")


_PARTIES_SQL = """
  SELECT 'snapshot_' || r_name || '.json' AS source_file, min(c_custkey) AS id, c_mktsegment AS sigla,
         upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS nome, count(*) AS "statusTotalMembros",
         arg_min(c_name, c_custkey) AS "liderNome"
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, c_mktsegment"""


@query(f"SELECT * FROM ({_PARTIES_SQL})")
def silver_parties(spark, sf_dir):
    """Nested records flattened to the parties' columns."""
    return silver.transform_parties(party_records(spark, sf_dir)).select(
        "source_file", "id", "sigla", "nome", "statusTotalMembros", "liderNome"
    )


def proposition_records(spark, sf_dir):
    """Documents as propositions in bronze shape; the two batches carry the labelled ones and then all of them."""
    documents = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    joined = documents.join(labels, "doc_id", "left")
    both = joined.withColumn(
        "source_file",
        F.explode(
            F.when(
                F.col("quality").isNotNull(), F.array(F.lit("delta_1.json"), F.lit("delta_2.json"))
            ).otherwise(F.array(F.lit("delta_2.json")))
        ),
    )
    # Texts of the first batch change in the second one where the quality label is 0.
    changed = (F.col("source_file") == "delta_2.json") & (F.col("quality") == 0)
    values = {
        "id": F.col("doc_id"),
        "detail.siglaTipo": F.upper("lang"),
        "detail.numero": F.col("n_chars"),
        "detail.ano": F.lit(2024),
        "detail.ementa": F.when(changed, F.concat(F.lit("* "), "text")).otherwise(F.col("text")),
        "detail.dataApresentacao": F.when(F.col("lang") == "en", "2024-01-02T03:04").otherwise("soon"),
        "detail.statusProposicao.codTipoTramitacao": F.concat(F.col("n_chars").cast("string"), F.when(F.col("lang") == "fr", "x").otherwise("")),
        "detail.keywords": F.col("source"),
    }
    records = both.withColumn("_ordinal", F.col("doc_id"))
    return bronze_record(records, SPECS["propositions"].bronze_schema(), values, "source_file", "_ordinal")


PROPOSITIONS_SQL = """
propositions AS (
  SELECT f AS source_file, d.doc_id AS id, upper(lang) AS "siglaTipo", n_chars AS numero,
         CASE WHEN f = 'delta_2.json' AND quality = 0 THEN '* ' || text ELSE text END AS ementa,
         CASE WHEN lang = 'en' THEN '2024-01-02 03:04:00' ELSE 'unparsed' END AS presented,
         CAST(n_chars AS VARCHAR) || CASE WHEN lang = 'fr' THEN 'x' ELSE '' END AS step, source AS keywords, lang
  FROM documents d LEFT JOIN labels l USING (doc_id), (SELECT unnest(['delta_1.json', 'delta_2.json']) AS f)
  WHERE f = 'delta_2.json' OR quality IS NOT NULL
)"""


@query(f"""WITH {PROPOSITIONS_SQL}
SELECT source_file, id, "siglaTipo", numero, ementa, presented, step, keywords FROM propositions""")
def silver_propositions(spark, sf_dir):
    """Nested records flattened to the propositions' columns, timestamps parsed or NULL, codes as text."""
    rows = silver.transform_propositions(proposition_records(spark, sf_dir))
    return rows.select(
        "source_file",
        "id",
        "siglaTipo",
        "numero",
        "ementa",
        F.coalesce(time_text("dataApresentacao"), F.lit("unparsed")).alias("presented"),
        F.col("statusCodTipoTramitacao").alias("step"),
        "keywords",
    )


def voting_records(spark, sf_dir):
    """Events as votings: one delta per day, keyed by user, the first record of a user and day counts."""
    events = table(spark, sf_dir, "events")
    values = {
        "id": F.col("user_id"),
        "uri": F.concat(F.lit("/e/"), "event_id"),
        "data": day_text("ts"),
        "dataHoraRegistro": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        "siglaOrgao": F.upper("event_type"),
        "descricao": F.col("props"),
        "aprovacao": F.when(F.col("event_type") == "error", None).otherwise((F.col("value") > 10).cast("int")),
    }
    records = events.withColumns(
        {"source_file": F.concat(F.lit("delta_"), day_text("ts"), F.lit(".json")), "_ordinal": F.col("event_id")}
    )
    return bronze_record(records, SPECS["votings"].bronze_schema(), values, "source_file", "_ordinal")


VOTINGS_SQL = """
votings AS (
  SELECT 'delta_' || CAST(CAST(ts AS DATE) AS VARCHAR) || '.json' AS source_file, CAST(user_id AS VARCHAR) AS id,
         '/e/' || event_id AS uri, CAST(CAST(ts AS DATE) AS VARCHAR) AS data,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS registered, upper(event_type) AS "siglaOrgao", props AS descricao,
         CASE WHEN event_type = 'error' THEN 'open' WHEN value > 10 THEN '1' ELSE '0' END AS aprovacao
  FROM events
  QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id ORDER BY event_id) = 1
)"""


@query(f"""WITH {VOTINGS_SQL}
SELECT source_file, id, uri, data, registered, "siglaOrgao", descricao, aprovacao FROM votings""")
def silver_votings(spark, sf_dir):
    """Flat records typed: date, timestamp and nullable integer."""
    return voting_columns(silver.transform_votings(voting_records(spark, sf_dir)), "source_file", "uri")


def voting_columns(rows, *extra):
    return rows.select(
        *extra,
        "id",
        F.col("data").cast("string").alias("data"),
        time_text("dataHoraRegistro").alias("registered"),
        "siglaOrgao",
        "descricao",
        F.coalesce(F.col("aprovacao").cast("string"), F.lit("open")).alias("aprovacao"),
    )
