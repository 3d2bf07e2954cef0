"""Marginal likelihood of texts over all segmentations into the pieces of an existing subword vocabulary.

A piece begins a word or goes on in it and never crosses a blank, so a text's likelihood is the product of its words'
and of the end's. A word's is the sum over its segmentations of the product of unigram piece probabilities, by a
forward recursion in logarithms. The vocabulary's own scores give ranks, and ranks a first Zipf distribution; an
expectation step over all distinct learning words turns that into expected counts. A word of the learning texts has
one more edge, from its start to its end: its count less ``DISCOUNT``, over all tokens. What the discounts leave is
the share of the pieces.

Word counts are a table, never a broadcast: only words with more than 1/``FREQUENT`` of the tokens, fewer than
``FREQUENT`` by their definition, are sent to the tasks, and the other words of the texts meet their counts in a join.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from palimpsest.llm.common import fold_of, query, table
from palimpsest.llm.simhash import word_blocks
from palimpsest.session import stored

MODEL = "piece_bpe_32k.model"
FOLDS, HELD_OUT = 7, 2
FREQUENT = 200_000
DISCOUNT = 0.75
START = "▁"
END = "</s>"
HELD_WORDS = 300_000


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def read_pieces(path: str) -> tuple[list[str], list[str], str]:
    """Ordinary pieces by falling score, the byte pieces, and the end piece of a vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ordinary = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    ordinary.sort(key=lambda i: (-model.get_score(i), i))
    return [model.id_to_piece(i) for i in ordinary], BYTES, END


def zipf(pieces: list[str], octets: list[str], end: str) -> dict[str, float]:
    """Probabilities that fall with the rank; bytes and the end share the place after the last piece."""
    weight = {p: 1.0 / (r + 2) for r, p in enumerate(pieces)}
    weight |= {p: 1.0 / (len(pieces) + 2) for p in [*octets, end]}
    total = sum(weight.values())
    return {p: w / total for p, w in weight.items()}


PREFIX = 1.0
BYTES = [f"<0x{b:02X}>" for b in range(256)]
BASE, SPREAD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
# Words of fewer characters go through the recursion together, so many at a time.
LONG, TOGETHER = 48, 4096


def total_log(terms: list[float]) -> float:
    """Logarithm of the sum of exponentials."""
    if len(terms) == 1:
        return terms[0]
    top, exp = max(terms), math.exp
    return top + math.log(sum([exp(t - top) for t in terms]))


class Lattice:
    """Unigram piece logarithms and the words' marginal likelihood under them."""

    def __init__(self, probability: dict[str, float]):
        self.octets = [math.log(probability[f"<0x{b:02X}>"]) for b in range(256)]
        self.end = math.log(probability[END])
        #: Logarithms of the pieces, and ``PREFIX`` for what only begins one.
        self.table: dict[str, float] = {}
        pieces = {p: math.log(x) for p, x in probability.items() if p != END and not p.startswith("<0x")}
        for piece in pieces:
            for n in range(1, len(piece)):
                self.table[piece[:n]] = PREFIX
        self.table.update(pieces)
        self.longest = max(map(len, pieces), default=1)
        #: The same pieces by hash, for many words at a time.
        self.pieces = sorted(pieces, key=hash_of)
        self.hashes = np.array([hash_of(p) for p in self.pieces], np.uint64)
        self.logs = np.array([pieces[p] for p in self.pieces])

    def spelled(self, char: str) -> tuple[float, list[str]]:
        """A character that is no piece, in bytes."""
        data = char.encode("utf-8", "surrogatepass")
        return sum(self.octets[b] for b in data), [f"<0x{b:02X}>" for b in data]

    def leaving(self, chars: str, i: int):
        """(end, logarithm) of the pieces that start at ``i``; the character in bytes if it is no piece."""
        found, get, j = [], self.table.get, i + 1
        log = get(chars[i])
        if log is None or log == PREFIX:
            found.append((j, self.spelled(chars[i])[0]))
        while log is not None:
            if log != PREFIX:
                found.append((j, log))
            j += 1
            if j > len(chars):
                break
            log = get(chars[i:j])
        return found

    def log_word(self, word: str) -> float:
        """Natural logarithm of a word's marginal probability, summed over all segmentations.

        The forward recursion holds only as many places ahead as the longest piece reaches.
        """
        chars = START + word
        terms: dict[int, list[float]] = {0: [0.0]}
        for i in range(len(chars)):
            alpha = total_log(terms.pop(i))
            for j, log in self.leaving(chars, i):
                if j in terms:
                    terms[j].append(alpha + log)
                else:
                    terms[j] = [alpha + log]
        return total_log(terms[len(chars)])

    def expect(self, word: str, n: int, into: Counter) -> None:
        """Add the expected number of each piece in ``n`` occurrences of a word.

        Two numbers a character are held, whatever the word's length; the pieces are looked up once each way.
        """
        chars = START + word
        alpha = array("d", [-math.inf]) * (len(chars) + 1)
        beta = array("d", [-math.inf]) * (len(chars) + 1)
        alpha[0] = beta[len(chars)] = 0.0
        for i in range(len(chars)):
            for j, log in self.leaving(chars, i):
                alpha[j] = log_add(alpha[j], alpha[i] + log)
        every = alpha[len(chars)]
        for i in range(len(chars) - 1, -1, -1):
            for j, log in self.leaving(chars, i):
                beta[i] = log_add(beta[i], log + beta[j])
                share = n * math.exp(alpha[i] + log + beta[j] - every)
                piece = chars[i:j]
                if self.table.get(piece, PREFIX) != PREFIX:
                    into[piece] += share
                else:
                    for octet in self.spelled(piece)[1]:
                        into[octet] += share

    def edges(self, chars: np.ndarray):
        """For each length, the piece that starts at each place of each word (-1: none) and its logarithm."""
        found, rolling = [], None
        for n in range(1, min(self.longest, chars.shape[1]) + 1):
            last = chars[:, n - 1 :].astype(np.uint64) * SPREAD
            rolling = last if rolling is None else rolling[:, :-1] * BASE + last
            place = np.minimum(np.searchsorted(self.hashes, rolling), len(self.hashes) - 1)
            place = np.where(self.hashes[place] == rolling, place, -1)
            logs = np.where(place >= 0, self.logs[place], -np.inf)
            if n == 1:
                for i in np.unique(chars[place < 0]).tolist():
                    logs[chars == i] = self.spelled(chr(i))[0]
            found.append((place, logs))
        return found

    def forward(self, edges, width: int, length: int) -> np.ndarray:
        alpha = np.full((width, length + 1), -np.inf)
        alpha[:, 0] = 0.0
        for j in range(1, length + 1):
            terms = [alpha[:, j - n] + edges[n - 1][1][:, j - n] for n in range(1, min(j, len(edges)) + 1)]
            alpha[:, j] = log_sum(terms)
        return alpha

    def log_words(self, words: list[str]) -> np.ndarray:
        """``log_word`` of many words: those of one length run through the recursion together."""
        out = np.zeros(len(words))
        for places, chars in alike(words):
            if chars is None:
                out[places] = [self.log_word(words[i]) for i in places]
            else:
                out[places] = self.forward(self.edges(chars), *chars.shape)[:, -1]
        return out

    def expect_words(self, words: list[str], into: np.ndarray) -> None:
        """Add the expected number of each piece, and behind them of each byte, in one occurrence of each word."""
        for places, chars in alike(words):
            if chars is None:
                found: Counter = Counter()
                for i in places:
                    self.expect(words[i], 1, found)
                into += np.array([found[p] for p in [*self.pieces, *BYTES]])
                continue
            edges, (width, length) = self.edges(chars), chars.shape
            alpha = self.forward(edges, width, length)
            beta = np.full((width, length + 1), -np.inf)
            beta[:, length] = 0.0
            for i in range(length - 1, -1, -1):
                terms = [edges[n - 1][1][:, i] + beta[:, i + n] for n in range(1, min(length - i, len(edges)) + 1)]
                beta[:, i] = log_sum(terms)
            for n, (place, logs) in enumerate(edges, 1):
                share = np.exp(alpha[:, : length - n + 1] + logs + beta[:, n:] - alpha[:, -1:])
                known = place >= 0
                into[: len(self.pieces)] += np.bincount(place[known], share[known], len(self.pieces))
                if n == 1 and not known.all():
                    for i in np.unique(chars[~known]).tolist():
                        for octet in chr(i).encode("utf-8", "surrogatepass"):
                            into[len(self.pieces) + octet] += share[chars == i].sum()


def log_add(a: float, b: float) -> float:
    """The logarithm of the sum of two numbers, of their logarithms."""
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def log_sum(terms: list[np.ndarray]) -> np.ndarray:
    if len(terms) == 1:
        return terms[0]
    rows = np.stack(terms)
    top = rows.max(axis=0)
    return top + np.log(np.exp(rows - top).sum(axis=0))


def hash_of(piece: str) -> int:
    value = 0
    for char in piece:
        value = (value * int(BASE) + ord(char) * int(SPREAD)) % (1 << 64)
    return value


def alike(words: list[str]):
    """(places, code points) of words of equal length, with the mark of a word's start; None for long words."""
    lengths: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        lengths.setdefault(min(len(word), LONG), []).append(i)
    for length, places in lengths.items():
        for at in range(0, len(places), TOGETHER):
            some = places[at : at + TOGETHER]
            if length == LONG:
                yield some, None
                continue
            data = "".join([START + words[i] for i in some]).encode("utf-32-le", "surrogatepass")
            yield some, np.frombuffer(data, np.uint32).reshape(len(some), length + 1)


def words_of(text: str | None):
    """The words of a text in lists of bounded size: runs of anything but ASCII white space, A-Z lower-cased."""
    for words in word_blocks((text or "").encode("utf-8", "surrogatepass").lower()):
        yield words


def text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (fold_of(F.col(id_col), FOLDS) == HELD_OUT).alias("held_out"),
        F.col(text_col).cast("string").alias("text"),
    )


def count_task(batches):
    """Word counts of a task in the learning texts, 0 for words of other texts; handed on when many are held."""
    held: Counter = Counter()

    def flush():
        done = pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"]
        )
        held.clear()
        return done

    for batch in batches:
        for held_out, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for words in words_of(text.as_py()):
                if held_out:
                    for word in words:
                        held[word] += 0
                else:
                    held.update(words)
                if len(held) > HELD_WORDS:
                    yield flush()
    yield flush()


def word_counts(rows: DataFrame) -> DataFrame:
    """Every word (its bytes) and c, its count in the texts outside the held-out fold."""
    counts = rows.select("held_out", "text").mapInArrow(count_task, "word binary, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("c"))


def decoded(words: pa.Array) -> list[str]:
    return [w.decode("utf-8", "surrogatepass") for w in words.to_pylist()]


def expected_counts(words: DataFrame, lattice: Lattice) -> dict[str, float]:
    """Expected number of each piece over all given words: one row a piece and task, summed by Spark."""
    shared = words.sparkSession.sparkContext.broadcast(lattice)
    names = [*lattice.pieces, *BYTES]

    def run(batches):
        found = np.zeros(len(names))
        for batch in batches:
            shared.value.expect_words(decoded(batch.column(0)), found)
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(found[some])], ["piece", "n"])

    sums = words.select("word").mapInArrow(run, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n"))
    # At most one row for each piece of the vocabulary.
    return {names[r["piece"]]: r["n"] for r in sums.collect()}


def with_logs(words: DataFrame, lattice: Lattice) -> DataFrame:
    """word, c and log, the log10 of the word's marginal probability over its pieces."""
    shared = words.sparkSession.sparkContext.broadcast(lattice)

    def run(batches):
        for batch in batches:
            logs = shared.value.log_words(decoded(batch.column(0))) / math.log(10)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(logs)], ["word", "c", "log"])

    return words.select("word", "c").mapInArrow(run, "word binary, c long, log double")


def fit_lattice(counts: DataFrame, path: str, steps: int) -> Lattice:
    pieces, octets, end = read_pieces(path)
    probability = zipf(pieces, octets, end)
    for _ in range(steps):
        found = expected_counts(counts, Lattice(probability))
        # Every piece keeps a little, so that no text is impossible.
        total = sum(found.values()) + 0.01 * len(probability)
        probability = {p: (found.get(p, 0.0) + 0.01) / total for p in probability}
    return Lattice(probability)


PARTIAL = "n_tokens long, n_known long, base double, score double, rare array<struct<word:binary,tf:int>>"


def partial_scores(rows: DataFrame, frequent: dict[bytes, tuple], end: tuple) -> DataFrame:
    """Per text the sums over its end and its frequent words, and the words whose counts are still to be met.

    ``frequent`` has a word's add-one logarithm and its score, ``end`` whether it is known, and the same two.
    """
    shared = rows.sparkSession.sparkContext.broadcast(frequent)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare"]

    def pack(out, words, tfs, sizes, kind):
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32))
        pairs = pa.StructArray.from_arrays([pa.array(words, pa.binary()), pa.array(tfs, pa.int32())], ["word", "tf"])
        kinds = [kind, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        columns = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(offsets, pairs)], names)

    def run(batches):
        known = shared.value
        for batch in batches:
            kind = batch.column(0).type
            out, rare_words, tfs, sizes = [], [], [], []
            for doc_id, held_out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                n, seen, base, score = 1, *end
                rare: Counter = Counter()
                for words in words_of(text.as_py()):
                    n += len(words)
                    for word, tf in Counter(words).items():
                        found = known.get(word)
                        if found is None:
                            rare[word] += tf
                        else:
                            seen += tf
                            base += tf * found[0]
                            score += tf * found[1]
                out.append((doc_id, held_out, n, seen, base, score))
                rare_words += rare.keys()
                tfs += rare.values()
                sizes.append(len(rare))
                if len(tfs) > HELD_WORDS:
                    yield pack(out, rare_words, tfs, sizes, kind)
                    out, rare_words, tfs, sizes = [], [], [], []
            yield pack(out, rare_words, tfs, sizes, kind)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, {PARTIAL}")


def lm_scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    model_path: str | None = None,
    frequent: int = FREQUENT,
    steps: int = 1,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words and one end. ``base_score`` is the add-one word model learned from the rows outside the
    held-out fold, ``score`` the marginal probability of the text over all its segmentations, both log10. A null
    text counts as empty and has one token, its end. When nothing was learned every token has count 0. Rows that
    repeat an id are scored each by its own text; an empty table gives an empty result.
    """
    rows = text_rows(docs, id_col, text_col)
    counts = stored(word_counts(rows), "word-counts")
    learned = counts.where("c > 0")
    sums = learned.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    ends = rows.where("not held_out").count()
    total, distinct = sums[0] + ends, sums[1] + (ends > 0)
    lattice = fit_lattice(learned, model_path or default_model(), steps)
    words = stored(with_logs(counts, lattice), "words")
    smoothing = math.log10(total + distinct + 1)
    share = DISCOUNT * distinct / total if total else 1.0

    def scored(c: int, log: float) -> float:
        """log10 of a word's whole edge and its pieces together."""
        pieces = math.log10(share) + log
        if not c:
            return pieces
        edge = math.log10((c - DISCOUNT) / total)
        return max(edge, pieces) + math.log10(1 + 10 ** -abs(edge - pieces))

    most = words.where(F.col("c") * frequent > total).toArrow()
    known = {
        word: (math.log10(c + 1), scored(c, log))
        for word, c, log in zip(*[most.column(n).to_pylist() for n in ("word", "c", "log")])
    }
    end = (int(ends > 0), math.log10(ends + 1), scored(ends, lattice.end / math.log(10)))
    partial = stored(
        partial_scores(rows, known, end).withColumn("row", F.monotonically_increasing_id()), "partial-scores"
    )
    rare = partial.select("row", F.explode("rare").alias("at")).select("row", "at.*")
    # The logarithm of the sum of both edges, by what the smaller adds to the larger: a long word's pieces are below
    # the least double.
    edge = F.log10(F.greatest(F.col("c") - DISCOUNT, F.lit(1 - DISCOUNT)) / F.lit(float(max(total, 1))))
    pieces = F.col("log") + math.log10(share)
    larger = F.greatest(edge, pieces) + F.log10(F.pow(F.lit(10.0), -F.abs(edge - pieces)) + 1)
    both = F.when(F.col("c") > 0, larger).otherwise(pieces)
    met = (
        rare.join(words.where(F.col("c") * frequent <= total), "word")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("rare_known"),
            F.sum(F.col("tf") * F.log10(F.col("c") + 1)).alias("rare_base"),
            F.sum(F.col("tf") * both).alias("rare_score"),
        )
    )
    return partial.drop("rare").join(met, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0)) - F.col("n_tokens") * smoothing).alias("base_score"),
        (F.col("score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"),
    )


@query()
def op10_lm_scoring(spark, sf_dir):
    return lm_scores(table(spark, sf_dir, "documents"))
