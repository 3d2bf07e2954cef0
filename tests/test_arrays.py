"""Array files of any layout, cut at any place."""

import json
import random

import pytest

from palimpsest.plans import silver
from palimpsest.plans.entities import SPECS
from palimpsest.sources import arrays, landing
from tests.conftest import tuples

SCHEMA = "id string, what string, more struct<a:array<string>,b:struct<c:long>>"
STRINGS = ["plain", "", "}", "{", "]},{", '"', "\\", '\\"}', "a\\\\", "é}ü", "日本{", "\n}\t", "},\n  {", '{"id":"x"}', " , "]


@pytest.fixture
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def record(rng, i):
    out = {"id": str(i), "what": rng.choice(STRINGS) * rng.choice([1, 1, 40])}
    if rng.random() < 0.5:
        out["more"] = {"a": rng.choices(STRINGS, k=rng.randrange(4)), "b": {"c": i}}
    return out


def layouts(rng, records):
    yield json.dumps(records)
    yield json.dumps(records, separators=(",", ":"), ensure_ascii=False)
    yield json.dumps(records, indent=rng.choice([1, 2, 4, "\t"]), ensure_ascii=False)
    yield "\n [ \n" + "  ,\r\n".join(json.dumps(r, ensure_ascii=False) for r in records) + "\n ] \n\n"


def schema_of(spark):
    return spark.createDataFrame([], SCHEMA).schema


def test_any_layout_gives_the_records_in_order(spark, tmp_path, small_ranges):
    rng, wanted, paths = random.Random(2), {}, []
    for n in range(5):
        records = [record(rng, i) for i in range(rng.choice([0, 1, 2, 9]))]
        for k, text in enumerate(layouts(rng, records)):
            path = tmp_path / f"f{n}_{k}.json"
            path.write_text(text)
            wanted[path.name] = [(r["id"], r["what"], r.get("more", {}).get("a")) for r in records]
            paths.append(str(path))
    texts = arrays.record_texts(spark, paths)
    assert arrays.malformed(texts, schema_of(spark)) == set()
    rows = arrays.read_texts(texts, schema_of(spark)).orderBy("source_file", "_ordinal").collect()
    got = {name: [] for name in wanted}
    for r in rows:
        got[r.source_file].append((r.id, r.what, r.more.a if r.more else None))
    assert got == wanted
    assert texts.where("row > 1").count() > 10


def test_a_file_is_read_by_many_tasks(spark, tmp_path, small_ranges):
    path = tmp_path / "one.json"
    path.write_text(json.dumps([{"id": str(i), "what": "x" * 130} for i in range(200)]))
    assert arrays._pieces(spark, [str(path)]).rdd.getNumPartitions() > 20
    texts = arrays.record_texts(spark, [str(path)])
    assert texts.select("block").distinct().count() > 20
    assert arrays.read_texts(texts, schema_of(spark)).count() == 200


WRONG = {
    "cut.json": '[{"id":"1"},{"id":"2"}',
    "cut_inside.json": '[{"id":"1"},{"id":"2","what":"a}',
    "quote.json": '[{"id":"1"},{"id":"2","what":"a"b"},{"id":"3"}]',
    "comma.json": '[{"id":"1"} {"id":"2"}]',
    "value.json": '[{"id":"1"}, 5, {"id":"2"}]',
    "nested.json": '[[{"id":"1"}]]',
    "after.json": '[{"id":"1"}] x',
    "two.json": '[{"id":"1"}][{"id":"2"}]',
    "object.json": '{"id":"1"}',
    "broken.json": '[{"id":"1"},{"id":}]',
    "brace.json": '[{"id":"1"}}]',
}


def test_what_is_no_array_of_records_is_found(spark, tmp_path, small_ranges):
    for name, text in WRONG.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "good.json").write_text('[{"id":"1"},{"id":"2"}]')
    (tmp_path / "empty.json").write_text("[ ]")
    texts = arrays.record_texts(spark, [str(p) for p in sorted(tmp_path.glob("*.json"))])
    assert arrays.malformed(texts, schema_of(spark)) == set(WRONG)


def test_groups_of_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(arrays, "GROUP_BYTES", 30)
    for n in range(3):
        (tmp_path / f"f{n}.json").write_text(json.dumps([{"id": f"{n}{i}"} for i in range(n + 1)]))
    texts = arrays.split_files(spark, [(str(tmp_path / f"f{n}.json"), 20) for n in range(3)])
    assert texts.count() == 6


def test_silver_reads_large_files_of_any_layout_in_pieces(spark, tmp_path, small_ranges):
    from datetime import datetime, timezone

    bronze = tmp_path / "bronze"
    bronze.mkdir()
    compact = [{"id": f"v{i}", "descricao": "a } b", "aprovacao": i % 2} for i in range(20)]
    (bronze / "delta_1.json").write_text(json.dumps(compact, separators=(",", ":")))
    (bronze / "delta_2.json").write_text(json.dumps(compact[:5] + [{"id": "v2", "descricao": "later"}], indent=1))
    (bronze / "delta_3.json").write_text(json.dumps(compact)[:-9])
    at, spec = datetime(2024, 2, 1, tzinfo=timezone.utc), SPECS["votings"]
    results = []
    for n, whole in enumerate((0, 1 << 30)):
        root, book = str(tmp_path / f"silver{n}"), str(tmp_path / f"files{n}")
        counts = silver.run(spark, spec, str(bronze), root, book, at, whole_bytes=whole)
        assert tuples(counts) == [("delta_1.json", 20), ("delta_2.json", 5)]
        assert tuples(silver.quarantined(spark, book), "file_name") == [("delta_3.json",)]
        results.append(tuples(silver.current(spark, spec, root), "id", "descricao", "aprovacao", landing.SOURCE_FILE))
    assert results[0] == results[1] and len(results[0]) == 20


def test_ranges_are_asked_for_by_a_size_of_their_own(spark, tmp_path, small_ranges, monkeypatch):
    from datetime import datetime, timezone

    bronze = tmp_path / "bronze"
    bronze.mkdir()
    compact = [{"id": f"v{i}", "descricao": "a } b", "aprovacao": i % 2} for i in range(20)]
    (bronze / "delta_1.json").write_text(json.dumps(compact))
    (bronze / "delta_2.json").write_text(json.dumps(compact)[:-9])
    (bronze / "delta_3.json").write_text(json.dumps([{"id": "v2", "descricao": "later"}], indent=2))
    at, spec = datetime(2024, 2, 1, tzinfo=timezone.utc), SPECS["votings"]
    asked, plain, results = [], arrays.split_files, []
    monkeypatch.setattr(arrays, "split_files", lambda s, files: asked.append([n.rsplit("/", 1)[1] for n, _ in files]) or plain(s, files))
    for n, least in enumerate((None, 0)):
        root, book = str(tmp_path / f"silver{n}"), str(tmp_path / f"files{n}")
        counts = silver.run(spark, spec, str(bronze), root, book, at, whole_bytes=0, range_bytes=least)
        assert tuples(counts) == [("delta_1.json", 20), ("delta_3.json", 1)]
        assert tuples(silver.quarantined(spark, book), "file_name") == [("delta_2.json",)]
        results.append(tuples(silver.current(spark, spec, root), "id", "descricao", "aprovacao", landing.SOURCE_FILE))
    assert asked == [["delta_1.json", "delta_2.json"]]
    assert results[0] == results[1] and len(results[0]) == 20
