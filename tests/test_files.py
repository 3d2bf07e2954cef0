"""Landing of array files."""

import json

import pytest

import __spark_entry__ as contract
from palimpsest.workload import files
from tests.compare import compare, oracle_connection
from tests.test_oracles import SF


@pytest.mark.parametrize("name", ["array_file_replay", "replay_with_bad_file"])
def test_many_files_a_week_give_the_same_rows(spark, tmp_path, monkeypatch, name):
    monkeypatch.setattr(files, "FILE_ROWS", 60)
    landed, plain = [], files.move_part
    monkeypatch.setattr(files, "move_part", lambda s, w, f, n: landed.append(n) or plain(s, w, f, n))
    rows = contract.queries()[name](spark, SF)
    assert len(set(landed)) > 5
    assert compare(spark, SF, name, lambda *_: rows, contract.oracle_sql()[name], oracle_connection(SF)) is None


def test_each_file_is_one_array(spark, tmp_path):
    records = spark.createDataFrame([(f"u{i % 7}", i) for i in range(50)], "id string, _ordinal int")
    files.FILE_ROWS, before = 10, files.FILE_ROWS
    try:
        files.land_arrays(records, str(tmp_path / "a"), "delta_0", indented=True)
    finally:
        files.FILE_ROWS = before
    found = [[r["id"] for r in json.loads(p.read_text())] for p in (tmp_path / "a").glob("*.json")]
    assert sum(map(len, found)) == 50 and 1 < len(found) <= 5
    assert sum(len(set(ids)) for ids in found) == 7
