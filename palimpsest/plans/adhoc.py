"""Ad hoc read-only SQL over the serving relations, and the lookups built on them."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from palimpsest.functions.sqlguard import OK, statement_body, verdict
from palimpsest.operators.joins import dimension_join
from palimpsest.operators.pivot import any_ilike

# Rows of a result, and those of them passed on to an answer step.
RESULT_ROWS = 50
ANSWER_ROWS = 20


def audit_sql(statements: DataFrame, column: str, name: str = "verdict") -> DataFrame:
    """Verdict of the read-only check for each statement of a table."""
    return statements.withColumn(name, verdict(F.col(column)))


def guarded_select(spark: SparkSession, sql: str, rows: int | None = None) -> DataFrame:
    """Result of a SELECT over the registered views; any other statement raises ValueError.

    Double quotes mark identifiers, as its authors write mixed-case columns that way. They are rewritten before
    the statement is parsed, so no setting of the session changes.
    """
    checked = spark.range(1).select(verdict(F.lit(sql)).alias("verdict"), statement_body(F.lit(sql)).alias("body"))
    row = checked.first()
    if row["verdict"] != OK:
        raise ValueError(f"statement refused: {row['verdict']}")
    result = spark.sql(backquoted(row["body"].rstrip().rstrip(";")))
    return result.limit(rows) if rows else result


def backquoted(sql: str) -> str:
    """The statement with double-quoted identifiers in backquotes; texts and comments stay as they are."""

    def rewrite(found: re.Match) -> str:
        if found[1] is None:
            return found[0]
        return "`" + found[1].replace('""', '"').replace("`", "``") + "`"

    return re.sub(r"""'(?:[^'\\]|\\.)*'|`[^`]*`|--[^\n]*|/\*.*?\*/|"((?:[^"]|"")*)\"""", rewrite, sql, flags=re.S)


def answer_rows(result: DataFrame, rows: int = ANSWER_ROWS) -> DataFrame:
    """The rows of a result that an answer step is shown, each as JSON text with NULLs."""
    return result.limit(rows).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row"))


def with_party(deputies: DataFrame, parties: DataFrame) -> DataFrame:
    """Deputies with their party, by acronym; other columns of the party are prefixed."""
    others = [F.col(c).alias(f"party_{c}") for c in parties.columns if c != "sigla"]
    return dimension_join(deputies, parties.select(F.col("sigla").alias("partido"), *others), "partido")


def keyword_search(rows: DataFrame, columns: list[str], terms: list[str]) -> DataFrame:
    """Rows where a column contains one of the terms, ignoring case."""
    patterns = [f"%{t}%" for t in terms]
    return rows.filter(reduce(lambda a, b: a | b, [any_ilike(F.col(c), patterns) for c in columns]))


def by_topic_and_year(
    propositions: DataFrame, topic: str, year: int, columns: list[str], rows: int = RESULT_ROWS
) -> DataFrame:
    """Propositions of a topic and year, by id, up to the result cap."""
    chosen = propositions.filter((F.col("tema_classificado") == topic) & (F.col("ano") == year))
    return chosen.orderBy("id").limit(rows).select(*columns)
