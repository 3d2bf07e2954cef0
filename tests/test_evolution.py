"""Columns that change, and fields that no schema names."""

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import evolution
from palimpsest.operators.shaping import flatten_found, found_schema
from palimpsest.plans import enrichment
from tests.conftest import tuples


@pytest.mark.parametrize(
    "kinds, wide",
    [(["int"], "int"), (["bigint", "int"], "bigint"), (["int", "double", "bigint"], "double"), (["int", "string"], "string"), (["date", "int"], "string"), (["array<int>", "array<int>"], "array<int>")],
)
def test_widest(kinds, wide):
    assert evolution.widest(kinds) == wide


def test_int_then_bigint_then_text_reads_under_one_schema(spark, tmp_path):
    root = str(tmp_path / "log")
    for batch, kind, rows in (
        ("d1", "k int, v int", [(1, 7), (2, None)]),
        ("d2", "k int, v bigint, w double", [(1, 5_000_000_000, 0.5)]),
        ("d3", "k int, v string, l array<int>", [(3, "x", [1, 2])]),
        ("d4", "k int, l string", [(4, "y")]),
    ):
        evolution.append_batches(spark.createDataFrame(rows, kind).withColumn("batch", F.lit(batch)), root)
    log = evolution.read_log(spark, root)
    assert dict(log.dtypes) == {"k": "int", "v": "string", "w": "double", "l": "string", "batch": "string"}
    assert tuples(log, "k", "v", "w", "l", "batch") == [
        (1, "5000000000", 0.5, None, "d2"),
        (1, "7", None, None, "d1"),
        (2, None, None, None, "d1"),
        (3, "x", None, "[1,2]", "d3"),
        (4, None, None, "y", "d4"),
    ]


def test_a_batch_delivered_again_with_other_types_is_replaced(spark, tmp_path):
    root = str(tmp_path / "log")
    frame = lambda rows, kind: spark.createDataFrame(rows, kind)
    evolution.append_batches(frame([(1, "d1"), (2, "d2")], "v int, batch string"), root)
    evolution.append_batches(frame([("a", "d2")], "v string, batch string"), root)
    assert tuples(evolution.read_log(spark, root), "v", "batch") == [("1", "d1"), ("a", "d2")]
    evolution.append_batches(frame([(3, "d2")], "v int, batch string"), root)
    assert tuples(evolution.read_log(spark, root), "v", "batch") == [("1", "d1"), ("3", "d2")]
    with pytest.raises(LookupError):
        evolution.read_log(spark, str(tmp_path / "none"))


def test_fields_are_found(spark):
    texts = ['{"a":1,"b":{"c":"x","d":[1,2]}}', '{"a":2.5,"e":true}', '{"b":{"c":5}}', "no json", None, "[1]", "{}"]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    flat = flatten_found(rows.where("n <> 5"), "t", "t.")
    assert sorted(flat.columns) == ["n", "t.a", "t.b.c", "t.b.d", "t.e"]
    got = {r.n: (float(r["t.a"]) if r["t.a"] is not None else None, r["t.b.c"], r["t.e"]) for r in flat.collect()}
    assert got == {0: (1.0, "x", None), 1: (2.5, None, True), 2: (None, "5", None), 3: (None,) * 3, 4: (None,) * 3, 6: (None,) * 3}
    assert flatten_found(rows.limit(0), "t").columns == ["n"]
    assert found_schema(rows.where("n = 6"), "t").fields == []


def test_slices_of_a_short_queue_share_a_job(monkeypatch):
    assert enrichment._jobs({0: 5, 1: 7, 3: 2}) == [([0, 1, 3], 14)]
    monkeypatch.setattr(enrichment, "JOB_ROWS", 10)
    assert enrichment._jobs({0: 5, 1: 7, 2: 3, 3: 50}) == [([0], 5), ([1, 2], 10), ([3], 50)]
    assert enrichment._jobs({}) == []
