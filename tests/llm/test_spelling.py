import random
import re
import zlib
from collections import Counter

import pytest

from palimpsest.llm import spelling
from palimpsest.llm.spelling import spelling_variants
from tests.llm.helpers import documents, with_clashes

FOLD = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows, least=7, count=2, factor=10, noise=None):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if noise and h % noise == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= count}
    form, found = {}, {}
    for w, n in words.items():
        others = sorted((-words[o], o) for o in words if near(w, o))
        found[w] = len(others)
        form[w] = others[0][1] if others and -others[0][0] >= factor * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, n, found[w], form[w], words.get(form[w]), root))
    return out


def result(rows):
    return [tuple(r) for r in rows.select("word", "n", "n_near", "form", "form_n", "root").collect()]


def sample(seed, n=250):
    rng = random.Random(seed)
    letters = "aeionrstéÉqu"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 10))) for _ in range(25)]
    rows = []
    for i in range(n):
        text = []
        for w in rng.choices(words, weights=[1 + 200 // (1 + k) for k in range(25)], k=30):
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                k = rng.randrange(len(w) + 1)
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :]])
            text.append(rng.choice([w, w.upper(), w.title()]))
        rows.append((i, rng.choice([" ", "-", "1", " × "]).join(text)))
    return rows


@pytest.mark.parametrize("node_words", [8, 1 << 14])
def test_words_are_those_of_all_pairs(spark, node_words):
    rows = sample(7, 100)
    got = result(spelling_variants(documents(spark, rows), noise=31, node_words=node_words))
    assert len(got) == len(set(got))
    assert set(got) == plain(rows, noise=31)


def test_other_limits_and_small_parts(spark, monkeypatch):
    rows = sample(8, 120)
    monkeypatch.setattr(spelling, "PIECE", 40)
    got = result(spelling_variants(documents(spark, rows), least_letters=4, least_count=1, factor=2, node_words=30, node_bytes=400))
    assert set(got) == plain(rows, 4, 1, 2)


def test_search_in_small_batches(monkeypatch):
    words = sorted({w.translate(FOLD) for _, t in sample(9, 60) for w in re.findall("[A-Za-zéÉ]{8}(?![A-Za-zéÉ])", t)})
    words = [w for w in words if len(w) == 8]
    trie = spelling.Trie(words, 0)
    codes = spelling.letter_codes(words)
    import numpy as np

    ones = np.ones(len(words), np.int8)
    every = set()
    for who, owner in trie.search(spelling.frequency_vectors(codes), ones, ones, batch=5):
        every |= {frozenset((int(a), int(b))) for a, b in zip(who, owner)}
    wanted = {frozenset((a, b)) for a in range(len(words)) for b in range(a) if near(words[a], words[b])}
    assert wanted <= every
    found = [(int(a), int(b)) for x, y in spelling.near_in_node(trie, words, ones, ones) for a, b in zip(x, y)]
    assert len(found) == len(wanted) and {frozenset(p) for p in found} == wanted


def test_chains_ties_nulls_and_long_words(spark):
    long = "ab" * 40_000
    text = "abcdefgh " * 3 + "abcdefghi " * 30 + "abcdefghij " * 300 + "zbcdefgh " * 30 + f"{long} {long}x " * 2
    rows = [(1, text), (1, None), (2, ""), (None, "Résumés résumés RÉsumés"), (None, "résumés"), (3, "abcdef abcdef once-upon")]
    docs = with_clashes(documents(spark, rows))
    got = result(spelling_variants(docs, node_bytes=1 << 17))
    assert set(got) == plain(rows) and len(got) == len(plain(rows))
    by = {r[0]: r for r in got}
    assert by["abcdefgh"][1:] == (3, 2, "abcdefghi", 30, "abcdefghij")
    assert by[long][2:4] == (1, None)


def test_crowded_leaves_are_searched_in_blocks(spark):
    rng = random.Random(1)
    words = {"".join(rng.sample("aaaqqqee", 8)) for _ in range(200)}
    rows = [(i, f"{w} {w}") for i, w in enumerate(sorted(words))]
    assert set(result(spelling_variants(documents(spark, rows), node_words=4))) == plain(rows)


def test_empty_tables(spark):
    assert result(spelling_variants(documents(spark, []))) == []
    assert result(spelling_variants(documents(spark, [(1, None), (2, "a b c")]))) == []
