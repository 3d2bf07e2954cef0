import hashlib
import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from palimpsest.llm.bpe import default_model
from palimpsest.llm.queries import ORACLES, QUERIES
from tests.compare import compare, oracle_connection

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_oracle(spark, connection, name):
    assert compare(spark, SF, name, QUERIES[name], ORACLES[name], connection) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("op11_", "op12_"))])
def test_queries_return_a_row_per_input_row(spark, name):
    source = "pages" if "page_id" in (rows := QUERIES[name](spark, SF)).columns else "documents"
    assert rows.count() == spark.read.parquet(f"{SF}/{source}.parquet").count()


def test_whitening_has_a_row_per_vector_and_component(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").count()
    assert QUERIES["op12_embedding_whitening"](spark, SF).count() == 4 * vectors


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 14))


def fixture_tables(spark, folder):
    """Documents whose way through the stages is known."""
    rng = random.Random(11)
    words = [f"{a}{b}{c}" for a in "bdfgkl" for b in "aeiou" for c in ["n", "st", "ring", "mo"]]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    good = {i: say(120) for i in range(40)}
    passage, item = say(60), say(30)
    docs = dict(good)
    docs[100] = good[3]  # an exact copy: its lines go, then it is an empty text
    docs[101] = good[5].replace(good[5].split()[50], "changed", 1)  # a near copy
    docs[102], docs[103] = f"{good[6]} a\n{passage}\nb {say(120)}", f"{say(130)}\n{passage}"
    docs[104] = f"{say(40)} {item} {say(40)}"  # contaminated
    docs |= {200 + i: " ".join(w.upper() + "!!" for w in say(80).split()) for i in range(30)}
    docs |= {105: None, 106: ""}
    labels = [(i, 1) for i in range(40)] + [(200 + i, 0) for i in range(30)]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in docs.items()]
    spark.createDataFrame(rows, kind).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, passage, item


def test_stages_on_known_documents(spark, tmp_path):
    docs, passage, item = fixture_tables(spark, tmp_path)
    sf = str(tmp_path)
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, rows, sf).write.parquet(f"{sf}/stage-{k}")
        rows = spark.read.parquet(f"{sf}/stage-{k}")
        kept.append({r["doc_id"]: r for r in rows.collect()})
        assert rows.columns == COLUMNS or k == 4
    assert set(kept[0]) == {i for i in docs if not 200 <= i < 300}
    assert set(kept[1]) == set(kept[0])
    assert kept[1][100].text == "" and kept[1][100].n_chars == 0
    assert kept[1][3].text == docs[3] and passage in kept[1][102].text
    assert kept[1][103].text == docs[103].split("\n")[0]
    assert kept[1][105].text is None
    assert set(kept[1]) - set(kept[2]) == {101, 105, 106}
    assert set(kept[2]) - set(kept[3]) == {104}
    tokenizer = Tokenizer.from_file(default_model())
    for i, row in kept[4].items():
        ids = tokenizer.encode(kept[3][i].text or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, sf).collect()) == sorted(kept[4])


def test_stages_on_empty_documents(spark, tmp_path):
    fixture_tables(spark, tmp_path)
    rows = spark.read.parquet(f"{tmp_path}/documents.parquet").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, str(tmp_path))
        assert rows.count() == 0
