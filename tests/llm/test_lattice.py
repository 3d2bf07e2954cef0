import math
import zlib
from collections import Counter

import numpy as np
import pytest

from palimpsest.llm import lattice as module
from palimpsest.llm.lattice import DISCOUNT, END, START, Lattice, default_model, lm_scores, read_pieces, zipf
from tests.llm.helpers import by_id, documents, with_clashes


def small():
    weight = {f"{START}a": 2, f"{START}": 1, "a": 3, "b": 1, "ab": 2, "bab": 1, f"{START}ab": 1, END: 1}
    weight |= {f"<0x{b:02X}>": 0.01 for b in range(256)}
    total = sum(weight.values())
    return {p: w / total for p, w in weight.items()}


def segmentations(chars, probability):
    """(probability, pieces) of every way to write ``chars``."""
    if not chars:
        yield 1.0, ()
        return
    ends = [n for n in range(1, len(chars) + 1) if chars[:n] in probability]
    if chars[0] not in probability:
        octets = [f"<0x{b:02X}>" for b in chars[0].encode()]
        for p, rest in segmentations(chars[1:], probability):
            yield math.prod(probability[o] for o in octets) * p, (*octets, *rest)
    for n in ends:
        for p, rest in segmentations(chars[n:], probability):
            yield probability[chars[:n]] * p, (chars[:n], *rest)


@pytest.mark.parametrize("word", ["a", "ab", "abab", "babab", "aébab", "é", "abababab"])
def test_marginal_is_the_sum_over_all_segmentations(word):
    probability = small()
    every = list(segmentations(START + word, probability))
    model = Lattice(probability)
    assert math.isclose(model.log_word(word), math.log(sum(p for p, _ in every)), rel_tol=1e-9)
    total, wanted, found = sum(p for p, _ in every), Counter(), Counter()
    for p, pieces in every:
        for piece in pieces:
            wanted[piece] += 3 * p / total
    model.expect(word, 3, found)
    assert found.keys() == wanted.keys()
    assert all(math.isclose(found[p], wanted[p], rel_tol=1e-9) for p in wanted)


def test_vocabulary_is_a_distribution():
    pieces, octets, end = read_pieces(default_model())
    assert len(pieces) > 30_000 and end == END
    assert math.isclose(sum(zipf(pieces, octets, end).values()), 1)


def test_long_words_have_a_finite_score():
    model = Lattice(zipf(*read_pieces(default_model())))
    assert -1e7 < model.log_word("x" * 50_000) < model.log_word("x" * 10) < 0
    found = Counter()
    model.expect("ab" * 5000, 1, found)
    assert math.isclose(sum(len(p) * n for p, n in found.items()), 10_001, rel_tol=1e-6)


ROWS = [(i, t) for i, t in enumerate(["The rain fell", "the rain the town", "a dog ran", "", None, "Rain rain É", "over the town"] * 8)]


def plain(rows):
    tokens = [(i, zlib.crc32(str("" if i is None else i).encode()) % 7 == 2, (t or "").encode().lower().split()) for i, t in rows]
    counts, ends = Counter(w for _, held, ws in tokens if not held for w in ws), sum(not held for _, held, _ in tokens)
    total, distinct = sum(counts.values()) + ends, len(counts) + (ends > 0)
    out = []
    for i, held, words in tokens:
        own = [counts[w] for w in words] + [ends]
        out.append((i, held, len(own), sum(c > 0 for c in own), total, sum(math.log10((c + 1) / (total + distinct + 1)) for c in own)))
    return out, counts, ends, total, distinct


@pytest.mark.parametrize("frequent", [100_000, 12, 1])
def test_counts_and_base_score_are_the_plain_ones(spark, frequent):
    got = lm_scores(documents(spark, ROWS), frequent=frequent, steps=0)
    wanted, counts, ends, total, distinct = plain(ROWS)
    rows = by_id(got, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    model, share = Lattice(zipf(*read_pieces(default_model()))), DISCOUNT * distinct / total
    for (i, held, n, known, tokens, base), (_, text) in zip(wanted, ROWS):
        assert rows[i][:4] == (held, n, known, tokens)
        assert math.isclose(rows[i][4], base, rel_tol=1e-9)
        edges = [(counts[w], math.exp(model.log_word(w.decode()))) for w in (text or "").encode().lower().split()]
        score = sum(math.log10(max(c - DISCOUNT, 0) / total + share * p) for c, p in [*edges, (ends, math.exp(model.end))])
        assert math.isclose(rows[i][5], score, rel_tol=1e-9)


def test_learned_pieces_raise_the_likelihood(spark):
    docs = documents(spark, ROWS + [(200 + i, f"rainfell{i % 5} doggo") for i in range(20)])
    score = lambda steps: lm_scores(docs, steps=steps).agg({"score": "sum"}).first()[0]
    assert score(1) > score(0)


def test_edges(spark):
    assert lm_scores(documents(spark, [])).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    alone = lm_scores(documents(spark, [(held, "a b")])).first()
    assert (alone.n_tokens, alone.n_known, alone.train_tokens, alone.base_score) == (3, 0, 0, 0.0) and alone.score < 0
    odd = ROWS + [(None, "the rain"), (1, "repeated id"), (500, "w" * 200_000), (501, "w " * 100_000)]
    docs = with_clashes(documents(spark, odd))
    rows = lm_scores(docs)
    assert rows.count() == len(odd)
    assert rows.where("doc_id is null").first().n_tokens == 3
    assert {r.n_tokens for r in rows.where("doc_id >= 500").collect()} == {2, 100_001}


def test_word_counts_are_handed_on(spark, monkeypatch):
    rows = module.text_rows(documents(spark, ROWS), "doc_id", "text")
    got = {bytes(r.word): r.c for r in module.word_counts(rows).collect()}
    counts = plain(ROWS)[1]
    assert {w: c for w, c in got.items() if c} == dict(counts)
    assert set(got) == {w for _, t in ROWS for w in (t or "").encode().lower().split()}


def test_many_words_at_a_time_are_each_as_alone():
    words = ["a", "ab", "abab", "aébab", "é", "x", "bab" * 40, "", "ba", "aé" * 30, "\U0001f600a"]
    model = Lattice(small())
    assert model.log_words(words).tolist() == pytest.approx([model.log_word(w) for w in words], rel=1e-9)
    alone, together = Counter(), np.zeros(len(model.pieces) + 256)
    for word in words:
        model.expect(word, 1, alone)
    model.expect_words(words, together)
    assert together.tolist() == pytest.approx([alone[p] for p in [*model.pieces, *module.BYTES]], rel=1e-9)


@pytest.mark.parametrize("frequent", [100_000, 1])
def test_long_learned_words_have_a_finite_score(spark, frequent):
    learned, held = ([i for i in range(100, 200) if (zlib.crc32(str(i).encode()) % 7 == 2) == h] for h in (False, True))
    lengths = [n for n in range(60, 501, 20)]
    long_words = ["".join(chr(0x4E00 + 7 * (i * n) % 5000) for i in range(n)) for n in lengths]
    extra = [(learned[0], " ".join(long_words)), *((held[i % len(held)] + 1000 * i, w) for i, w in enumerate(long_words))]
    rows = ROWS + extra
    _, counts, ends, total, distinct = plain(rows)
    got = by_id(lm_scores(documents(spark, rows), frequent=frequent, steps=0), "score")
    model, share = Lattice(zipf(*read_pieces(default_model()))), math.log10(DISCOUNT * distinct / total)
    assert model.log_word(long_words[-1]) / math.log(10) < -330

    def edge(c, log):
        pieces = share + log / math.log(10)
        return math.log10((c - DISCOUNT) / total + (10**pieces if pieces > -300 else 0)) if c else pieces

    for i, text in extra:
        wanted = sum(edge(counts[w], model.log_word(w.decode())) for w in text.encode().lower().split()) + edge(ends, model.end)
        assert math.isclose(got[i], wanted, rel_tol=1e-9)


def test_a_long_word_is_counted_whole():
    """A word beyond any block: the counts of the recursion in columns, and as many characters as the word has."""
    model = Lattice(zipf(*read_pieces(default_model())))
    word = "".join("abcdefghij"[(k * k) % 10] for k in range(5_000))
    found, columns = Counter(), np.zeros(len(model.pieces) + 256)
    model.expect(word, 1, found)
    chars = np.frombuffer((START + word).encode("utf-32-le"), np.uint32).reshape(1, -1)
    edges = model.edges(chars)
    alpha = model.forward(edges, *chars.shape)
    beta = np.full(chars.shape[1] + 1, -np.inf)
    beta[-1] = 0.0
    for i in range(chars.shape[1] - 1, -1, -1):
        beta[i] = np.logaddexp.reduce([edges[n - 1][1][0, i] + beta[i + n] for n in range(1, min(len(edges), chars.shape[1] - i) + 1)])
    for n, (place, logs) in enumerate(edges, 1):
        share = np.exp(alpha[0, : chars.shape[1] - n + 1] + logs[0] + beta[n:] - alpha[0, -1])
        known = place[0] >= 0
        columns[: len(model.pieces)] += np.bincount(place[0][known], share[known], len(model.pieces))
    wanted = {p: c for p, c in zip(model.pieces, columns) if c > 1e-9}
    assert all(math.isclose(found[p], c, rel_tol=1e-6, abs_tol=1e-9) for p, c in wanted.items())
    assert math.isclose(sum(len(p) * c for p, c in found.items()), chars.shape[1], rel_tol=1e-6)
