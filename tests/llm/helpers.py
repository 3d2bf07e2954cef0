"""Small documents for the operators' tests, and the columns that must not confuse them."""

from __future__ import annotations


def documents(spark, rows, kind="doc_id long, text string"):
    return spark.createDataFrame(rows, kind)


def with_clashes(docs):
    """``docs`` with columns named like those the operators make up."""
    from pyspark.sql import functions as F

    names = "doc row key digest component fp score drops lines items spans kept_id group_size rank sid pos n_words held_out number"
    return docs.withColumns({name: F.lit("x") for name in names.split()})


def by_id(rows, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in rows.collect()}
