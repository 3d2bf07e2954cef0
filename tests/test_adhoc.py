"""The read-only check and the lookups."""

import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from palimpsest.functions.sqlguard import BLOCKED
from palimpsest.plans import adhoc
from tests.conftest import tuples

CASES = [
    ("SELECT 1", "ok"),
    (" ;select a from b", "ok"),
    ("WITH x AS (SELECT 1) SELECT * FROM x", "not_select"),
    ("SELECT replace(a,'x','y')", "REPLACE"),
    ("SELECT updated_at FROM t", "ok"),
    ("SELECT 1; DROP TABLE t", "DROP"),
    ("SELECT * INTO n FROM t", "ok"),
    ("SELECT 'please update'", "UPDATE"),
    ("SELECTx", "ok"),
    ("\n\tSELECT 1", "ok"),
    ("; ;SELECT 1", "not_select"),
    (";;  select Merge", "MERGE"),
    (" SELECT éupdate", "ok"),
    ("", "not_select"),
    (None, "not_select"),
]


def test_verdicts(spark):
    rows = spark.createDataFrame(list(enumerate(c for c, _ in CASES)), "n int, stmt string")
    got = [r["verdict"] for r in adhoc.audit_sql(rows, "stmt").orderBy("n").collect()]
    assert got == [v for _, v in CASES]


def by_hand(text):
    body = text.strip().lstrip(";").strip()
    if body[:6].upper() != "SELECT":
        return "not_select"
    words = re.findall(r"\w+", body)
    return next((w.upper() for w in words if w.upper() in BLOCKED), "ok")


pieces = st.lists(st.sampled_from(["select ", "SELECT ", ";", " ", "\n", "drop", "Update ", "_", "é", "x", "(", "call", "exec", "ute ", "1"]), max_size=8)


@settings(max_examples=1, deadline=None)
@given(st.lists(pieces.map("".join), min_size=400, max_size=400))
def test_verdicts_on_random_statements(statements):
    from palimpsest.session import build_session

    spark = build_session("tests", "local[8]")
    rows = spark.createDataFrame(list(enumerate(statements)), "n int, stmt string")
    got = [r["verdict"] for r in adhoc.audit_sql(rows, "stmt").orderBy("n").collect()]
    assert got == [by_hand(s) for s in statements]


@pytest.fixture
def relation(spark):
    rows = spark.createDataFrame([(1, "Ana", "AA"), (2, "Bia", "BB"), (3, "Caio", None)], "id int, `nomeCivil` string, partido string")
    rows.createOrReplaceTempView("gold_deputies")
    return rows


def test_guarded_select(spark, relation):
    before = spark.conf.get("spark.sql.ansi.doubleQuotedIdentifiers")
    result = adhoc.guarded_select(spark, 'SELECT "nomeCivil" FROM gold_deputies WHERE partido ILIKE \'a%\';')
    assert tuples(result) == [("Ana",)]
    assert adhoc.guarded_select(spark, "select * from gold_deputies", 2).count() == 2
    assert spark.conf.get("spark.sql.ansi.doubleQuotedIdentifiers") == before


@pytest.mark.parametrize("sql", ["DROP TABLE x", "SELECT 1; DELETE FROM gold_deputies", "WITH a AS (SELECT 1) SELECT * FROM a"])
def test_refused_statements(spark, relation, sql):
    with pytest.raises(ValueError, match="refused"):
        adhoc.guarded_select(spark, sql)


def test_two_statements_do_not_parse(spark, relation):
    with pytest.raises(Exception, match="PARSE_SYNTAX_ERROR"):
        adhoc.guarded_select(spark, "SELECT 1; SELECT 2")
    assert tuples(spark.sql('SELECT "x" AS c')) == [("x",)]


def test_lookups(spark, relation):
    parties = spark.createDataFrame([("AA", "Party A", 3), ("CC", "Party C", 1)], "sigla string, nome string, total int")
    assert tuples(adhoc.with_party(relation, parties), "id", "party_nome") == [(1, "Party A")]
    assert tuples(adhoc.keyword_search(relation, ["nomeCivil", "partido"], ["AN", "bb"]), "id") == [(1,), (2,)]
    rows = spark.range(200).select(
        "id", F.lit("Saúde").alias("tema_classificado"), (F.lit(2024) + F.col("id") % 2).alias("ano")
    )
    listed = adhoc.by_topic_and_year(rows, "Saúde", 2025, ["id"])
    assert [r["id"] for r in listed.collect()] == list(range(1, 101, 2))
