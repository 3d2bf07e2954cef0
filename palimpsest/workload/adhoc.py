"""Queries over the ad hoc SQL surface."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.functions.sqlguard import BLOCKED
from palimpsest.plans import adhoc, postings
from palimpsest.session import scratch_path
from palimpsest.sources.landing import spread_input
from palimpsest.workload.registry import query, table


@query(rf"""
WITH statements AS (
  SELECT doc_id, CASE lang WHEN 'en' THEN chr(10) || ' ;select ' || text WHEN 'fr' THEN 'SELECT * FROM t WHERE note = ''' || text || ''''
                           ELSE text || '; DROP TABLE t' END AS stmt FROM documents
  UNION ALL SELECT doc_id, CASE WHEN quality = 1 THEN 'Select replace(a, ''x'', ''y'') from updated_at' ELSE 'select deleted from t -- Merge' END FROM labels),
bodies AS (SELECT doc_id, regexp_replace(stmt, '^\s*;*\s*', '') AS body FROM statements)
SELECT doc_id, CASE WHEN NOT starts_with(upper(body), 'SELECT') THEN 'not_select'
  ELSE coalesce(nullif(upper(regexp_extract(body, '(?i)(^|[^\p{{L}}\p{{N}}_])({"|".join(BLOCKED)})($|[^\p{{L}}\p{{N}}_])', 2)), ''), 'ok') END AS verdict
FROM bodies""")
def audit_sql(spark, sf_dir):
    """Verdicts on statements made from the texts."""
    documents = spread_input(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    text, lang = F.col("text"), F.col("lang")
    made = documents.select(
        "doc_id",
        F.when(lang == "en", F.concat(F.lit("\n ;select "), text))
        .when(lang == "fr", F.concat(F.lit("SELECT * FROM t WHERE note = '"), text, F.lit("'")))
        .otherwise(F.concat(text, F.lit("; DROP TABLE t")))
        .alias("stmt"),
    )
    fixed = table(spark, sf_dir, "labels").select(
        "doc_id",
        F.when(F.col("quality") == 1, "Select replace(a, 'x', 'y') from updated_at")
        .otherwise("select deleted from t -- Merge")
        .alias("stmt"),
    )
    return adhoc.audit_sql(made.unionByName(fixed), "stmt").select("doc_id", "verdict")


@query("""
SELECT c_mktsegment AS "marketSegment", count(*) AS customers,
       CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS BIGINT) AS cents
FROM customer WHERE c_name ILIKE '%customer%' GROUP BY 1""")
def guarded_select(spark, sf_dir):
    """A checked SELECT over a registered view, mixed-case columns in double quotes."""
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "marketSegment")
    customers.createOrReplaceTempView("gold_customers")
    return adhoc.guarded_select(
        spark,
        ';SELECT "marketSegment", count(*) AS customers, sum(round(c_acctbal * 100)::bigint) AS cents '
        "FROM gold_customers WHERE c_name ILIKE '%customer%' GROUP BY \"marketSegment\";",
    )


@query("""
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 50""")
def capped_select(spark, sf_dir):
    """A checked SELECT with the result cap."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("gold_orders")
    sql = "SELECT o_orderkey, o_orderpriority FROM gold_orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey"
    return adhoc.guarded_select(spark, sql, adhoc.RESULT_ROWS)


@query("""
SELECT CAST(json_object('o_orderkey', o_orderkey, 'o_orderpriority', o_orderpriority) AS VARCHAR) AS "row"
FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 20""")
def answer_rows(spark, sf_dir):
    """Of a checked and capped result, the rows that an answer step is shown."""
    return adhoc.answer_rows(capped_select(spark, sf_dir))


@query("""
SELECT s_suppkey AS id, n_name AS partido, n_regionkey AS "party_regiao" FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def party_join(spark, sf_dir):
    """Suppliers as deputies, nations as parties, joined by acronym."""
    nations = table(spark, sf_dir, "nation")
    names = nations.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("partido"))
    deputies = table(spark, sf_dir, "supplier").join(names, "s_nationkey").select(F.col("s_suppkey").alias("id"), "partido")
    parties = nations.select(F.col("n_name").alias("sigla"), F.col("n_regionkey").alias("regiao"))
    return adhoc.with_party(deputies, parties).select("id", "partido", "party_regiao")


@query("""
SELECT doc_id, source FROM documents WHERE text ILIKE '%THE%' OR text ILIKE '%éau%' OR source ILIKE '%THE%' OR source ILIKE '%éau%'""")
def keyword_search(spark, sf_dir):
    """Whole texts and their source, searched ignoring case."""
    return adhoc.keyword_search(table(spark, sf_dir, "documents"), ["text", "source"], ["THE", "éau"]).select(
        "doc_id", "source"
    )


@query("""
SELECT doc_id, source FROM documents WHERE text ILIKE '%ThE sECRET%' OR text ILIKE '%eauxtion%' OR source ILIKE '%ThE sECRET%'
   OR source ILIKE '%eauxtion%' OR text ILIKE '%tion%ier_é%' OR source ILIKE '%tion%ier_é%'""")
def keyword_index_search(spark, sf_dir):
    """The same by an index of letter triples, for rare terms and a pattern."""
    root = scratch_path(spark, "keywords")
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    postings.index(documents, "doc_id", ["text", "source"], root, parts=64)
    found = postings.search(spark, root, "doc_id", ["text", "source"], ["ThE sECRET", "eauxtion", "tion%ier_é"])
    return found.select("doc_id", "source")


@query("""
SELECT o_orderkey AS id, o_orderstatus AS situacao FROM orders
WHERE o_orderpriority = '1-URGENT' AND year(o_orderdate) = 1997 ORDER BY o_orderkey LIMIT 50""")
def topic_year_list(spark, sf_dir):
    """Orders as propositions: one topic and year, up to the cap."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("tema_classificado"),
        F.year("o_orderdate").alias("ano"),
        F.col("o_orderstatus").alias("situacao"),
    )
    return adhoc.by_topic_and_year(rows, "1-URGENT", 1997, ["id", "situacao"])
