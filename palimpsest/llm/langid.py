"""Language identification with interpolated Kneser-Ney character models.

Trigram counts of each language are taken over all learning rows: tasks count, Spark adds up, and every trigram,
three code points in 63 bits, keeps its own count. Up to ``SENT`` cells (distinct trigrams times languages) the models
are sorted arrays of trigram and bigram keys with a column of logarithms for each language, sent to every task. Beyond
it nothing that grows with the text reaches the driver: sums and logarithms are joins and aggregations, only trigrams
with more than a fixed share of all occurrences, fewer than ``SENT`` cells by their definition, are sent, and the other
trigrams of the texts meet their logarithms in a join. Both forms give the same model.
A text goes to the language with the lowest cross-entropy per character; it is rejected when that is above the
``REJECT`` quantile of the learning rows that the same language won.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from palimpsest.llm.common import fold_of, query, table
from palimpsest.session import stored

SENT = 1 << 21
DISCOUNT = 0.75
REJECT = 0.999
SHARPNESS = 10.0
FOLDS, HELD_OUT = 4, 2
PIECE = 1 << 18
HELD_KEYS = 1 << 22
HELD_PAIRS = 300_000
LOW, PAIR = 0x1FFFFF, 0x3FFFFFFFFFF
SYMBOLS = 0x110000
UNKNOWN = "und"


@functools.lru_cache(1)
def letters() -> np.ndarray:
    """For each code point, itself if it is a letter, else a blank."""
    points = np.arange(SYMBOLS, dtype=np.uint32)
    is_letter = np.fromiter((chr(c).isalpha() for c in range(SYMBOLS)), bool, SYMBOLS)
    return np.where(is_letter, points, np.uint32(32))


def symbols(text: str | None):
    """The lower-cased letters of a text, single blanks for all between, in arrays of bounded size.

    Each array begins with the two symbols before it; the text has a blank at either end.
    """
    text = text or ""
    before = np.array([32, 32], np.uint32)
    for at in range(0, len(text), PIECE):
        last = at + PIECE >= len(text)
        part = text[at : at + PIECE].lower() + (" " if last else "")
        found = letters()[np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)]
        whole = np.concatenate([before, found])
        keep = (whole[2:] != 32) | (whole[1:-1] != 32)
        row = np.concatenate([before, whole[2:][keep]])
        if len(row) > 2:
            yield row
        before = row[-2:]


def trigrams(row: np.ndarray) -> np.ndarray:
    wide = row.astype(np.int64)
    return (wide[:-2] << 42) | (wide[1:-1] << 21) | wide[2:]


class Counts:
    """Trigram counts of one language in a task, folded whenever many keys are held."""

    def __init__(self):
        self.keys, self.sums, self.held = [], [], 0

    def add(self, keys, sums=None):
        if sums is None:
            keys, sums = np.unique(keys, return_counts=True)
        self.keys.append(keys)
        self.sums.append(sums)
        self.held += len(keys)
        if self.held > HELD_KEYS:
            self.fold()

    def fold(self):
        if not self.keys:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, place = np.unique(np.concatenate(self.keys), return_inverse=True)
        sums = np.bincount(place, np.concatenate(self.sums)).astype(np.int64)
        self.keys, self.sums, self.held = [keys], [sums], len(keys)
        return keys, sums


def count_task(batches):
    """Trigram counts of a task by language, handed on when many are held."""
    counts: dict[str, Counts] = {}

    def take(rows):
        for lang, mine in rows.items():
            counts.setdefault(lang, Counts()).add(np.concatenate(mine))
        rows.clear()

    def flush():
        for lang, mine in counts.items():
            keys, sums = mine.fold()
            for at in range(0, len(keys), 100_000):
                part = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys[part])), pa.array(keys[part]), pa.array(sums[part])], ["lang", "key", "n"]
                )
        counts.clear()

    for batch in batches:
        rows: dict[str, list] = {}
        size = 0
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for row in symbols(text.as_py()):
                rows.setdefault(lang, []).append(trigrams(row))
                size += len(row)
                if size > HELD_KEYS:
                    take(rows)
                    size = 0
                    if sum(c.held for c in counts.values()) > HELD_KEYS:
                        yield from flush()
        take(rows)
        if sum(c.held for c in counts.values()) > HELD_KEYS:
            yield from flush()
    yield from flush()


def trigram_counts(rows: DataFrame) -> DataFrame:
    """lang, key, n of learning rows (lang, text): each trigram with its own count."""
    counts = rows.mapInArrow(count_task, "lang string, key long, n long")
    return counts.groupBy("lang", "key").agg(F.sum("n").alias("n"))


def grouped(keys: np.ndarray, weights: np.ndarray | None = None):
    """Sorted distinct keys with the sum of their weights, or their number."""
    found, place = np.unique(keys, return_inverse=True)
    return found, np.bincount(place, weights, minlength=len(found)).astype(np.float64)


def lookup(sorted_keys: np.ndarray, keys: np.ndarray):
    """Places of keys in a sorted array, and whether they are there."""
    place = np.minimum(np.searchsorted(sorted_keys, keys), max(len(sorted_keys) - 1, 0))
    return place, (sorted_keys[place] == keys) if len(sorted_keys) else np.zeros(len(keys), bool)


def values(sorted_keys, column, keys, default):
    place, there = lookup(sorted_keys, keys)
    return np.where(there, column[place] if len(column) else default, default)


def mixed(seen, total, kinds, shorter):
    """Discounted share of what was seen after a context, and what the discounts leave for the shorter context."""
    safe = np.maximum(total, 1)
    return np.maximum(seen - DISCOUNT, 0) / safe + np.where(total > 0, DISCOUNT * kinds / safe, 1.0) * shorter


class Symbols:
    """What a model of one language has for each single symbol: at most a row for each letter there is."""

    def __init__(self, middles, middle_total, middle_kinds, lasts, last_n, n_pairs: int):
        self.middles, self.middle_total, self.middle_kinds = middles, middle_total, middle_kinds
        self.lasts, self.last_n = lasts, last_n
        self.pair_total = max(n_pairs, 1)

    def one(self, c):
        seen = values(self.lasts, self.last_n, c, 0.0)
        rest = DISCOUNT * len(self.lasts) / self.pair_total
        return np.maximum(seen - DISCOUNT, 0) / self.pair_total + max(rest, 1e-3) / SYMBOLS

    def two_of(self, bc, seen):
        """Probability of a symbol after another, given the pair's count."""
        total = values(self.middles, self.middle_total, bc >> 21, 0.0)
        kinds = values(self.middles, self.middle_kinds, bc >> 21, 0.0)
        return mixed(seen, total, kinds, self.one(bc & LOW))


class Kneser(Symbols):
    """Interpolated Kneser-Ney model of one language."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        self.keys, self.n = keys, n.astype(np.float64)
        contexts = keys >> 21
        self.contexts, self.total = grouped(contexts, self.n)
        _, self.kinds = grouped(contexts)
        # Each bigram and symbol counts once for every symbol before it.
        self.pairs, self.pair_n = grouped(keys & PAIR)
        middles, middle_total = grouped(self.pairs >> 21, self.pair_n)
        _, middle_kinds = grouped(self.pairs >> 21)
        super().__init__(middles, middle_total, middle_kinds, *grouped(self.pairs & LOW), len(self.pairs))

    def two(self, bc):
        return self.two_of(bc, values(self.pairs, self.pair_n, bc, 0.0))

    def rest(self, ab):
        """Weight of the shorter context after ``ab``."""
        total = values(self.contexts, self.total, ab, 0.0)
        kinds = values(self.contexts, self.kinds, ab, 0.0)
        return np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)

    def three(self, abc):
        total = values(self.contexts, self.total, abc >> 21, 0.0)
        kinds = values(self.contexts, self.kinds, abc >> 21, 0.0)
        return mixed(values(self.keys, self.n, abc, 0.0), total, kinds, self.two(abc & PAIR))


@dataclass
class Models:
    """All languages' models as sorted key arrays with a column for each language."""

    langs: list[str]
    keys: np.ndarray
    logs: np.ndarray
    contexts: np.ndarray
    rest: np.ndarray
    pairs: np.ndarray
    pair_logs: np.ndarray
    lasts: np.ndarray
    last_logs: np.ndarray
    new_log: np.ndarray
    middles: np.ndarray
    middle_rest: np.ndarray

    def entropy(self, text: str | None) -> tuple[np.ndarray, int]:
        """Nats per symbol in each language, and the number of symbols; 0 for a text without letters."""
        if not self.langs:
            return np.zeros(0), 0
        total, n, seen = np.zeros(len(self.langs)), 0, False
        for row in symbols(text):
            seen = seen or bool((row[2:] != 32).any())
            keys = trigrams(row)
            place, there = lookup(self.keys, keys)
            n += len(keys)
            weight = np.bincount(place[there], minlength=len(self.keys)) if len(keys) > 4096 else None
            total += self.logs[place[there]].sum(axis=0) if weight is None else weight @ self.logs
            if not there.all():
                total += self.unseen(keys[~there])
        return (-total / n, n) if seen and n else (total * 0, 0)

    def unseen(self, keys: np.ndarray) -> np.ndarray:
        """Sum of the logarithms of trigrams that no language has."""
        at, known = lookup(self.contexts, keys >> 21)
        logs = np.where(known[:, None], self.rest[at] if len(self.rest) else 0, 0.0).sum(axis=0)
        at, known = lookup(self.pairs, keys & PAIR)
        logs += self.pair_logs[at[known]].sum(axis=0)
        new = keys[~known]
        at, known = lookup(self.middles, (new >> 21) & LOW)
        logs += np.where(known[:, None], self.middle_rest[at] if len(self.middles) else 0, 0.0).sum(axis=0)
        at, known = lookup(self.lasts, new & LOW)
        return logs + np.where(known[:, None], self.last_logs[at] if len(self.lasts) else 0, self.new_log).sum(axis=0)


def build_models(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Models:
    langs = sorted(counts)
    own = [Kneser(*counts[lang]) for lang in langs]

    def keys_of(name):
        return np.unique(np.concatenate([np.zeros(0, np.int64), *(getattr(m, name) for m in own)]))

    def column(f, keys):
        return np.log(np.stack([f(m, keys) for m in own], axis=1)) if own else np.zeros((len(keys), 0))

    keys, contexts, pairs = keys_of("keys"), keys_of("contexts"), keys_of("pairs")
    lasts, middles = keys_of("lasts"), keys_of("middles")

    def middle_rest(m, b):
        total = values(m.middles, m.middle_total, b, 0.0)
        return np.where(total > 0, DISCOUNT * values(m.middles, m.middle_kinds, b, 0.0) / np.maximum(total, 1), 1.0)

    new = np.array([-1], np.int64)
    return Models(
        langs,
        keys,
        column(Kneser.three, keys),
        contexts,
        column(Kneser.rest, contexts),
        pairs,
        column(Kneser.two, pairs),
        lasts,
        column(Kneser.one, lasts),
        column(Kneser.one, new)[0],
        middles,
        column(middle_rest, middles),
    )


def models_of(counts: DataFrame) -> Models:
    """Models from exact counts of at most ``SENT`` cells."""
    found = counts.toArrow()
    langs = np.array(found.column("lang").to_pylist(), dtype=object)
    keys, n = found.column("key").to_numpy(), found.column("n").to_numpy()
    own = {}
    for lang in set(langs.tolist()):
        mine = langs == lang
        order = np.argsort(keys[mine])
        own[lang] = (keys[mine][order], n[mine][order])
    return build_models(own)


def judged_by_arrays(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """doc_id, lang, lang_pred, score, cross_entropy of rows (doc_id, lang, text), the models sent to every task."""
    models = rows.sparkSession.sparkContext.broadcast(models_of(counts))

    def run(batches):
        m = models.value
        for batch in batches:
            langs, scores, entropies = [], [], []
            for text in batch.column(2):
                entropy, n = m.entropy(text.as_py())
                if not n:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    entropies.append(None)
                    continue
                best = int(entropy.argmin())
                langs.append(m.langs[best])
                scores.append(float(1 / np.exp(-SHARPNESS * (entropy - entropy[best])).sum()))
                entropies.append(float(entropy[best]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(entropies, pa.float64()),
                ],
                ["doc_id", "lang", "lang_pred", "score", "cross_entropy"],
            )

    schema = rows.drop("text").schema.add("lang_pred", "string").add("score", "double").add("cross_entropy", "double")
    return rows.mapInArrow(run, schema)


def symbol_tables(pairs: DataFrame, n_langs: int) -> list[Symbols]:
    """Each language's sums over single symbols, from its pairs (at, bc, pair_n); a row for each letter at most."""
    middles = pairs.groupBy("at", F.shiftright("bc", 21).alias("b")).agg(
        F.sum("pair_n").alias("total"), F.count(F.lit(1)).alias("kinds")
    )
    lasts = pairs.groupBy("at", F.col("bc").bitwiseAND(F.lit(LOW)).alias("c")).agg(F.count(F.lit(1)).alias("n"))

    def split(found, key, *columns):
        at = found.column("at").to_numpy()
        for i in range(n_langs):
            mine = np.flatnonzero(at == i)
            mine = mine[np.argsort(found.column(key).to_numpy()[mine])]
            yield [found.column(key).to_numpy()[mine], *(found.column(c).to_numpy()[mine].astype(np.float64) for c in columns)]

    middle, last = split(middles.toArrow(), "b", "total", "kinds"), split(lasts.toArrow(), "c", "n")
    return [Symbols(*m, *c, int(c[1].sum())) for m, c in zip(middle, last)]


def dense(lists: pa.Array, name: str, n_langs: int) -> np.ndarray:
    """Lists of (at, value) as rows with a column for each language, 0 where nothing is listed."""
    out = np.zeros((len(lists), n_langs))
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = lists.flatten()
    out[np.repeat(np.arange(len(lists)), sizes), flat.field("at").to_numpy()] = flat.field(name).to_numpy()
    return out


def trigram_logs(rows: DataFrame, counts: DataFrame, langs: list[str]) -> DataFrame:
    """key, n, logs of every trigram of the rows: its occurrences in them and its logarithm in each language."""
    own = counts.select(
        (F.array_position(F.array(*map(F.lit, langs)), F.col("lang")) - 1).cast("int").alias("at"), "key", "n"
    )
    ab, bc = F.shiftright("key", 21).alias("ab"), F.col("key").bitwiseAND(F.lit(PAIR)).alias("bc")
    pairs = stored(own.groupBy("at", bc).agg(F.count(F.lit(1)).alias("pair_n")), "pairs")
    contexts = own.groupBy("at", ab).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))

    def listed(found, key, name, *columns):
        return found.groupBy(key).agg(F.collect_list(F.struct("at", *columns)).alias(name))

    tables = rows.sparkSession.sparkContext.broadcast(symbol_tables(pairs, len(langs)))

    def run(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy()
            seen, total, kinds, pair_n = (
                dense(batch.column(i), name, len(langs))
                for i, name in ((2, "n"), (3, "total"), (3, "kinds"), (4, "pair_n"))
            )
            logs = np.zeros((len(keys), len(langs)))
            for i, own in enumerate(tables.value):
                shorter = own.two_of(keys & PAIR, pair_n[:, i])
                logs[:, i] = np.log(mixed(seen[:, i], total[:, i], kinds[:, i], shorter))
            offsets = np.arange(len(keys) + 1, dtype=np.int32) * len(langs)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(logs.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["key", "n", "logs"])

    every = trigram_counts(rows.select(F.lit("").alias("lang"), "text")).select("key", "n", ab, bc)
    met = (
        every.join(listed(own, "key", "seen", "n"), "key", "left")
        .join(listed(contexts, "ab", "after", "total", "kinds"), "ab", "left")
        .join(listed(pairs, "bc", "pair", "pair_n"), "bc", "left")
    )
    return met.select("key", "n", "seen", "after", "pair").mapInArrow(run, "key long, n long, logs array<double>")


def partial_sums(rows: DataFrame, keys: np.ndarray, logs: np.ndarray) -> DataFrame:
    """Per text its symbols, the sums over the trigrams that are sent, and the others, still to be met."""
    shared = rows.sparkSession.sparkContext.broadcast((keys, logs))
    n_langs = logs.shape[1]

    def pack(out, held, kinds):
        sizes = [len(k) for k, _ in held]
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32))
        pairs = [pa.array(np.concatenate([np.zeros(0, np.int64), *(h[i] for h in held)])) for i in (0, 1)]
        rare = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(pairs, ["key", "tf"]))
        columns = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([*columns, rare], ["doc_id", "lang", "heard", "symbols", "sums", "rare"])

    def run(batches):
        sent, known_logs = shared.value
        for batch in batches:
            kinds = [batch.column(0).type, pa.string(), pa.bool_(), pa.int64(), pa.list_(pa.float64())]
            out, held, size = [], [], 0
            for doc_id, lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                mine, n, heard = Counts(), 0, False
                for row in symbols(text.as_py()):
                    heard = heard or bool((row[2:] != 32).any())
                    mine.add(trigrams(row))
                    n += len(row) - 2
                found, tf = mine.fold()
                place, there = lookup(sent, found)
                out.append((doc_id, lang, heard, n, tf[there] @ known_logs[place[there]]))
                held.append((found[~there], tf[~there]))
                size += len(held[-1][0])
                if size > HELD_PAIRS:
                    yield pack(out, held, kinds)
                    out, held, size = [], [], 0
            yield pack(out, held, kinds)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"doc_id {kind}, lang string, heard boolean, symbols long, sums array<double>, rare array<struct<key:long,tf:long>>",
    )


def judged_by_joins(rows: DataFrame, counts: DataFrame, langs: list[str]) -> DataFrame:
    """The same as ``judged_by_arrays`` for counts of any size."""
    logs = stored(trigram_logs(rows, counts, langs), "trigram-logs")
    total = logs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # Fewer than this many trigrams have more than its inverse of all occurrences.
    most = max(SENT // len(langs), 1)
    frequent = logs.where(F.col("n") * most > total).orderBy("key").toArrow()
    matrix = frequent.column("logs").combine_chunks().flatten().to_numpy().reshape(-1, len(langs))
    partial = stored(
        partial_sums(rows, frequent.column("key").to_numpy(), matrix).withColumn("row", F.monotonically_increasing_id()),
        "partial-sums",
    )
    rare = partial.select("row", F.explode("rare").alias("at")).select("row", "at.*")
    met = (
        rare.join(logs.where(F.col("n") * most <= total).select("key", "logs"), "key")
        .groupBy("row")
        .agg(F.array(*(F.sum(F.col("tf") * F.col("logs")[i]) for i in range(len(langs)))).alias("more"))
    )
    added = F.when(F.col("more").isNull(), F.col("sums")).otherwise(F.zip_with("sums", "more", lambda a, b: a + b))
    entropy = F.transform(added, lambda x: -x / F.greatest("symbols", F.lit(1)))
    judged = partial.drop("rare").join(met, "row", "left").withColumn("entropy", entropy)
    judged = judged.withColumn("best", F.array_min("entropy"))
    place = F.array_position("entropy", F.col("best")).cast("int")
    shares = F.aggregate("entropy", F.lit(0.0), lambda a, e: a + F.exp(-SHARPNESS * (e - F.col("best"))))
    return judged.select(
        "doc_id",
        "lang",
        F.when(F.col("heard"), F.element_at(F.array(*map(F.lit, langs)), place)).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("heard"), 1 / shares).otherwise(0.0).alias("score"),
        F.when(F.col("heard"), F.col("best")).alias("cross_entropy"),
    )


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, cross_entropy, rejected.

    Learned from rows whose id is outside the held-out fold; the language of a row is never an input of its
    prediction. A null text, one without letters, and every text when nothing was learned are ``und`` with score 0;
    they are not rejected, as there is nothing to reject. ``score`` is the languages' softmax of the cross-entropies.
    Ties go to the first language in alphabetic order. Rows that repeat an id are judged each by its own text.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(lang_col).cast("string").alias("lang"),
        F.col(text_col).cast("string").alias("text"),
    )
    held_out = fold_of(F.col("doc_id"), FOLDS) == HELD_OUT
    learning = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out).select("lang", "text")
    counts = stored(trigram_counts(learning), "trigram-counts")
    # One row for each learned language.
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if counts.select("key").distinct().count() * len(langs) <= SENT:
        judged = judged_by_arrays(rows, counts)
    else:
        judged = judged_by_joins(rows, counts, langs)
    scored = stored(judged.withColumn("held_out", held_out), "languages")
    limits = (
        scored.where("not held_out and lang = lang_pred and cross_entropy is not null")
        .groupBy("lang_pred")
        .agg(F.percentile_approx("cross_entropy", REJECT, 10_000).alias("most"))
    )
    # One row for each learned language.
    return scored.join(F.broadcast(limits), "lang_pred", "left").select(
        "doc_id",
        "held_out",
        "lang_pred",
        "score",
        "cross_entropy",
        F.coalesce(F.col("cross_entropy") > F.col("most"), F.lit(False)).alias("rejected"),
    )


@query()
def op8_language_id(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"))
