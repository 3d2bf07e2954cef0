import hashlib
import random

import pytest
from tokenizers import Tokenizer

from palimpsest.llm import bpe
from palimpsest.llm.bpe import chunks, default_model, encode_decode, parts
from tests.llm.helpers import documents, with_clashes

ODD = [
    None,
    "",
    " \n\t",
    "Hello, WORLD! it's 2024 don't",
    "a<|endoftext|>b <|startoftext|>",
    "é ́x  y z\x0bv\x0cf\x1cs\x85n",
    "İΣ ẞ ﬁ 가가 \U0001f600\U0001f468‍\U0001f469",
    "no_blank" * 30_000,
    "中文" * 20_000,
    "''s 's'S '" * 300,
]


def plain(texts):
    tokenizer = Tokenizer.from_file(default_model())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    out = []
    for text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        out.append((ids, tokenizer.decode(ids, skip_special_tokens=False)))
    return out


def check(spark, rows):
    got = {r.doc_id: r for r in encode_decode(documents(spark, rows)).collect()}
    assert len(got) == len(rows)
    for (i, _), (ids, decoded) in zip(rows, plain([t for _, t in rows])):
        assert (list(got[i].ids), got[i].decoded, got[i].n_tokens) == (ids, decoded, len(ids)), i
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_odd_texts_alone_and_in_copies(spark):
    check(spark, [(i, t) for i, t in enumerate(ODD)])
    check(spark, [(i, t) for i, t in enumerate(ODD + ODD)])


def test_shared_passages(spark):
    rng = random.Random(8)
    words = ["the", "Rain", "fell", "straße", "été", "x" * 40, "12,5", "don't", "\n", "#@!"]
    passage = " ".join(rng.choice(words) for _ in range(3000))
    rows = []
    for i in range(12):
        own = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 800))) for _ in range(2)]
        rows.append((i, own[0] + passage[rng.randint(0, 5) :] + own[1]))
    rows += [(20 + i, passage) for i in range(6)] + [(30, passage.replace(" ", "")), (31, "q" + passage.replace(" ", ""))]
    check(spark, rows)


def test_frequent_chunks_are_dealt_out(spark, monkeypatch):
    rows = [(i, "a frequent text of some words " * 100) for i in range(60)] + [(100 + i, f"own {i}") for i in range(20)]
    docs = documents(spark, rows).repartition(4)
    assert encode_decode(docs, outputs=False).select("ids_sha256").distinct().count() == 21


@pytest.mark.parametrize("piece", [64, 1 << 22])
def test_chunks_are_defined_by_content(piece, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", piece)
    rng = random.Random(1)
    data = " ".join(str(rng.random()) for _ in range(5000)).encode()
    cut = list(chunks(data))
    assert b"".join(cut) == data
    assert all(len(c) >= bpe.LEAST for c in cut[:-1])
    moved = list(chunks(b"some words before it " + data))
    assert len(set(cut) & set(moved)) >= len(cut) - 2
    assert b"".join(chunks("中".encode() * 200_000)) == "中".encode() * 200_000
    assert all(c.decode() for c in chunks("中".encode() * 200_000))
    assert list(chunks(b"")) == [b""]


@pytest.mark.parametrize("chunk", [b"", b"abc", b" ", b"a b", b" a", b"a ", b"\n\n", b"ab cd\tef"])
def test_parts_join_again(chunk):
    head, body, tail = parts(chunk)
    assert head + (body or b"") + tail == chunk
    assert body is None or (body[:1].isspace() and body[-1:].isspace())


def test_edges(spark):
    assert encode_decode(documents(spark, [])).count() == 0
    docs = with_clashes(documents(spark, [(1, "a b"), (1, "a b"), (None, "c"), (2, None)]))
    rows = encode_decode(docs, outputs=False)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(((r.doc_id, r.n_tokens) for r in rows.collect()), key=repr) == sorted([(1, 2), (1, 2), (None, 1), (2, 0)], key=repr)
