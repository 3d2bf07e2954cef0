import random
import re

import pytest

from palimpsest.llm import decontaminate as module
from palimpsest.llm.decontaminate import cut_spans, decontaminate, n_hit, over_limit, search_items
from tests.llm.helpers import documents, with_clashes

ITEMS = "item_id long, text string"


def words(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def brute(text, items, window):
    doc, hit, names = words(text), set(), set()
    for name, item in items:
        item = words(item)
        n = min(window, len(item))
        for k in range(len(item) - n + 1 if n else 0):
            for i in range(len(doc) - n + 1):
                if doc[i : i + n] == item[k : k + n]:
                    hit |= set(range(i, i + n))
                    names.add(str(name))
    return len(doc), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(doc)


def found(docs, items, **options):
    rows = search_items(docs, items, **options).select("doc.doc_id", "n_words", n_hit().alias("n"), "items", over_limit().alias("bad"))
    return {r.doc_id: (r.n_words, r.n, r["items"], r.bad) for r in rows.collect()}


@pytest.mark.parametrize("shard_words, window", [(200_000, 4), (30, 4), (200_000, 13)])
def test_matches_brute_force(spark, shard_words, window, monkeypatch):
    rng = random.Random(window + shard_words)
    letters = ["a", "B", "c", "é", "7"]
    items = [(i, " ".join(rng.choice(letters) for _ in range(rng.randint(0, 16)))) for i in range(25)]
    items += [(90, items[3][1]), (91, None), (92, " - ")]
    docs = [(i, "-".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))) for i in range(60)]
    docs += [(100 + i, "x y z " + (t or "") + " q") for i, t in items]
    got = found(documents(spark, docs), spark.createDataFrame(items, ITEMS), window=window, shard_words=shard_words)
    assert got == {i: brute(t, items, window) for i, t in docs}


def test_pieces_do_not_change_the_result(monkeypatch):
    text = "alpha, Beta  GAMMA; déjà vu " * 40
    whole = module.words_of(text)
    for piece in (1, 3, 7, 64):
        assert [w for part in module.word_pieces(text, piece) for w in part] == whole


def test_cutting_and_dropping(spark):
    item = " ".join(f"w{i}" for i in range(14))
    rows = [
        (1, "Before, " + item.upper().replace(" ", " . ") + "! After"),
        (2, "clean text"),
        (3, item + " " + "own words " * 200),
        (4, None),
        (5, ""),
        (6, "long " * 100_000),
        (2, "clean text"),
    ]
    docs, items = with_clashes(documents(spark, rows)), spark.createDataFrame([(7, item), (None, "nothing")], ITEMS)
    kept = decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 2, 3, 4, 5, 6]
    cut = cut_spans(docs, items)
    assert cut.columns == docs.columns
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts == {i: t for i, t in rows[1:]} | {1: "Before, ! After"}


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    assert found(documents(spark, []), none) == {}
    assert found(documents(spark, [(1, "a b"), (2, None)]), none) == {1: (2, 0, [], False), 2: (0, 0, [], False)}
