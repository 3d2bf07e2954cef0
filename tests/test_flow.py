"""All stages in a row, from landed pages to SQL and topics."""

import json
from datetime import date, datetime, timezone

from palimpsest.operators import history
from palimpsest.operators.inherit import with_enrichment
from palimpsest.plans import adhoc, bronze, enrichment, gold, silver
from palimpsest.plans.entities import SPECS
from palimpsest.sources import landing, ledger
from tests.conftest import tuples


def land(folder, page, *records):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"page_{page}.json").write_text(json.dumps({"page": page, "dados": list(records)}))


def vote(i, when, text):
    return {"id": i, "data": when[:10], "dataHoraRegistro": when, "descricao": text, "aprovacao": 1}


def test_votings_from_pages_to_sql(spark, tmp_path):
    spec = SPECS["votings"]
    paths = [str(tmp_path / p) for p in ("bronze", "runs", "silver", "files")]
    bronze_root, runs, root, files = paths

    def run(day, *pages):
        landed = tmp_path / f"landed_{day}"
        for number, records in enumerate(pages, start=1):
            land(landed, number, *records)
        at = datetime(2024, 1, day, tzinfo=timezone.utc)
        schema = "page int, dados array<struct<id string, data string, dataHoraRegistro string, descricao string, aprovacao int>>"
        summaries = landing.unnest_pages(spark.read.schema(schema).json(str(landed)))
        row = bronze.ingest_delta(
            spark, summaries, "votings", spec.mark, bronze_root, runs, f"delta_{day:02d}", at, date(2024, 1, day)
        )
        loaded = silver.run_batches(spark, spec, bronze_root, runs, root, files, at)
        return row["new_records"], tuples(loaded)

    first = [vote("b", "2024-01-01T09:00:00", "second page"), vote("a", "2024-01-01T10:00:00", "late copy")]
    assert run(2, [vote("a", "2024-01-01T10:00:00", "first")], first, []) == (3, [("delta_02", 2)])
    assert run(3, [vote("a", "2024-01-01T10:00:00", "again")]) == (0, [])
    assert run(4, [vote("a", "2024-01-04T10:00:00", "newer")]) == (1, [("delta_04", 1)])
    gold.publish(spark, {"gold_votings": gold.gold_votings(silver.current(spark, spec, root))}, str(tmp_path / "gold"))
    result = adhoc.guarded_select(spark, 'SELECT id, descricao FROM gold_votings ORDER BY "dataHoraRegistro"')
    assert [tuple(r) for r in result.collect()] == [("b", "second page"), ("a", "newer")]
    assert ledger.read_files(spark, files).count() == 3


def test_propositions_from_files_to_topics(spark, fixtures, tmp_path):
    spec = SPECS["propositions"]
    at = datetime(2024, 2, 1, tzinfo=timezone.utc)
    root = str(tmp_path / "silver")
    silver.run(spark, spec, f"{fixtures}/propositions", root, str(tmp_path / "files"), at)
    flagged = history.flag_current(silver.versions(spark, spec, root), "id", "batch", "delta")
    table = enrichment.classify_propositions(
        spark, flagged, str(tmp_path / "topics"), lambda texts: [[1.0, float(len(t))] for t in texts], at
    )
    made = enrichment.summarize_propositions(
        spark, flagged, str(tmp_path / "summaries"), lambda texts: [t.lower() for t in texts], at
    )
    assert tuples(table, "id") == [(1,), (2,), (5,), (6,)]
    assert tuples(made, "id", enrichment.SUMMARY) == [
        (1, "texto a"), (2, "texto b"), (3, "longo"), (4, ""), (5, "texto e"), (6, "novo"),
    ]
    current = history.current_delta(silver.versions(spark, spec, root), "id", "batch")
    enriched = with_enrichment(with_enrichment(current, table, "id", "batch"), made, "id", "batch")
    relation = gold.gold_propositions(enriched)
    assert relation.filter("tema_classificado is not null").count() == 4
    chosen = relation.first()["tema_classificado"]
    assert adhoc.by_topic_and_year(relation, chosen, 2024, ["id", "tema_score"]).count() >= 1
