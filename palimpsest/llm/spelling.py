"""Spelling variants by a frequency-vector trie.

Words are arranged in a trie by their length and then, level by level, by how many of their letters belong to each of
``GROUPS`` letter groups. One inserted, deleted or replaced letter raises at most one of these counts by one and
lowers at most one by one, so a search descends with a surplus and a deficit of one each to spend; the words of the
leaves it reaches are verified letter by letter. Each pair is searched from one side: from the shorter word, or, at
equal length, from the word whose first differing count is the smaller one.

The trie is dealt out by its upper levels: a node with more words than one task should hold is opened into its
children, and searches follow into those that their budget reaches. Below that a task builds the rest of its node's
trie as sorted arrays and descends depth-first with batches of searches.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from palimpsest.llm.common import query, table
from palimpsest.session import stored

LEAST_LETTERS = 7
LEAST_COUNT = 2
FACTOR = 10
NOISE = 31
GROUPS = 16
#: Levels in order: letter groups (code point modulo GROUPS) with the frequent letters e, t, a, i, n, ... first.
LEVELS = (5, 4, 1, 9, 14, 3, 2, 15, 12, 8, 7, 13, 6, 0, 11, 10)
LETTERS = "".join(map(chr, [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]))

NODE_WORDS = 1 << 14
NODE_BYTES = 1 << 25
BATCH = 1 << 16
PIECE = 1 << 20
HELD_WORDS = 200_000
HELD_CHARS = 1 << 23

STOP = re.compile("[^A-Za-zÀ-ÿ]")


def pieces(text: str):
    """The text in pieces of bounded size that cut no run of letters."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            found = STOP.search(text, end)
            end = found.start() if found else len(text)
        yield text[at:end] if at or end < len(text) else text
        at = end


def corrupted(run: str, start: int, noise: int | None) -> str:
    """The run without the letter that its checksum, continued from ``start``, names, if ``noise`` divides that."""
    if noise:
        h = zlib.crc32(run.encode(), start)
        if h % noise == 0:
            k = h % len(run)
            return run[:k] + run[k + 1 :]
    return run


def counted(batches, least: int, noise: int | None):
    """(word, n) of the documents of a task, in parts of bounded size."""
    runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % least)
    counts: dict[str, int] = {}
    chars = 0

    def part():
        nonlocal chars
        words = pa.array(counts.keys(), pa.string())
        done = pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], ["word", "n"])
        counts.clear()
        chars = 0
        return done

    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1)):
            start = zlib.crc32(((doc.as_py() or "") + ":").encode())
            for piece in pieces((text.as_py() or b"").lower().decode("utf-8", "replace")):
                for run, n in Counter(runs.findall(piece)).items():
                    word = corrupted(run, start, noise)
                    if word in counts:
                        counts[word] += n
                    elif len(word) >= least:
                        counts[word] = n
                        chars += len(word)
                if len(counts) >= HELD_WORDS or chars >= HELD_CHARS:
                    yield part()
    yield part()


def word_counts(docs: DataFrame, id_col: str, text_col: str, least: int, noise: int | None) -> DataFrame:
    """(word, n) over all documents."""
    rows = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string").cast("binary"))
    parts = rows.mapInArrow(lambda batches: counted(batches, least, noise), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def letters_of(word, level: int):
    """How many letters of the word are in the level's group."""
    members = "".join(c for c in LETTERS if ord(c) % GROUPS == LEVELS[level])
    return F.char_length(word) - F.char_length(F.translate(word, members, ""))


def deal(words: DataFrame, node_words: int, node_bytes: int) -> DataFrame:
    """(path, block, owner, word, n, surplus, deficit): what each task needs, owners and searches.

    ``path`` names a node of the trie: length and counts so far. A node stays whole if it is small enough, else it is
    opened. Words of one leaf that are too many are dealt out in blocks, and each search of that leaf visits all.
    """
    most = F.greatest(F.lit(1), F.least(F.lit(node_words), F.lit(node_bytes) / F.char_length("word")))
    room = F.min(F.floor(most)).alias("room")  # the words of a node have one length
    length = F.char_length("word").cast("string")
    longer = (F.char_length("word") + 1).cast("string")
    owners = words.select("word", "n", length.alias("path"))
    searches = words.select(
        "word",
        "n",
        F.explode(
            F.array(
                F.struct(length.alias("path"), F.lit(1).alias("surplus"), F.lit(1).alias("deficit")),
                F.struct(longer.alias("path"), F.lit(1).alias("surplus"), F.lit(0).alias("deficit")),
            )
        ).alias("s"),
    ).select("word", "n", "s.*")
    whole = []
    for level in range(len(LEVELS) + 1):
        last = level == len(LEVELS)
        sizes = owners.groupBy("path").agg(F.count(F.lit(1)).alias("size"), room)
        blocks = F.ceil(F.col("size") / F.col("room")).cast("int")
        nodes = stored(sizes.select("path", (blocks if last else F.lit(1)).alias("blocks"), (blocks > 1).alias("crowded")), "trie-nodes")
        met_owners, met_searches = owners.join(nodes, "path"), searches.join(nodes, "path")
        settled = F.lit(True) if last else ~F.col("crowded")
        whole.append(
            met_owners.where(settled)
            .withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
            .select("path", F.lit(level).alias("level"), "block", F.lit(True).alias("owner"), "word", "n", F.lit(0).alias("surplus"), F.lit(0).alias("deficit"))
        )
        whole.append(
            met_searches.where(settled)
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("path", F.lit(level).alias("level"), "block", F.lit(False).alias("owner"), "word", "n", "surplus", "deficit")
        )
        if last or nodes.where("crowded").isEmpty():
            break
        here = letters_of(F.col("word"), level)
        step = lambda count: F.concat_ws(".", "path", count.cast("string"))
        owners = met_owners.where("crowded").select("word", "n", step(here).alias("path"))
        opened = met_searches.where("crowded").withColumn("here", here)
        ways = F.array_compact(
            F.array(
                F.struct(step(F.col("here")).alias("path"), "surplus", "deficit"),
                F.when(
                    F.col("surplus") == 1,
                    F.struct(step(F.col("here") + 1).alias("path"), F.lit(0).alias("surplus"), "deficit"),
                ),
                F.when(
                    (F.col("surplus") == 0) & (F.col("deficit") == 1) & (F.col("here") > 0),
                    F.struct(step(F.col("here") - 1).alias("path"), "surplus", F.lit(0).alias("deficit")),
                ),
            )
        )
        searches = opened.select("word", "n", F.explode(ways).alias("s")).select("word", "n", "s.*")
        owners, searches = stored(owners, "trie-owners"), stored(searches, "trie-searches")
    dealt = whole[0]
    for rows in whole[1:]:
        dealt = dealt.unionByName(rows)
    return dealt


def letter_codes(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of letters."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def frequency_vectors(codes: np.ndarray) -> np.ndarray:
    """Counts of the letter groups, in the order of the levels."""
    groups = codes % GROUPS
    return np.stack([(groups == g).sum(axis=1) for g in LEVELS], axis=1).astype(np.int64)


class Trie:
    """The levels of a trie from ``depth`` on, as sorted arrays of (parent, count) keys."""

    def __init__(self, words: list[str], depth: int):
        self.codes = letter_codes(words)
        self.vectors = frequency_vectors(self.codes)
        self.order = np.lexsort(self.vectors.T[::-1])
        vectors = self.vectors[self.order]
        self.depth, self.base = depth, int(vectors.max(initial=0)) + 3
        self.keys = []
        at = np.zeros(len(vectors), np.int64)
        for level in range(depth, len(LEVELS)):
            key = at * self.base + vectors[:, level] + 1
            first = np.r_[True, key[1:] != key[:-1]]
            self.keys.append(key[first])
            at = np.cumsum(first) - 1
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        self.starts, self.sizes = starts, np.diff(np.r_[starts, len(at)])

    def search(self, vectors: np.ndarray, surplus: np.ndarray, deficit: np.ndarray, batch: int = BATCH):
        """(search, owner) arrays of the leaves within the budgets, depth-first in batches."""
        ways = [(self.depth, np.arange(len(vectors)), np.zeros(len(vectors), np.int64), surplus, deficit)]
        while ways:
            level, who, at, surplus, deficit = ways.pop()
            if level == len(LEVELS):
                ended = surplus == deficit  # a surplus alone is one letter more, both are one replaced, none is none
                who, at = who[ended], at[ended]
                sizes = self.sizes[at]
                offsets = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                yield np.repeat(who, sizes), self.order[np.repeat(self.starts[at], sizes) + offsets]
                continue
            keys = self.keys[level - self.depth]
            here = at * self.base + vectors[who, level] + 1
            more, less = surplus == 1, (surplus == 0) & (deficit == 1)
            chosen = np.concatenate([np.arange(len(who)), np.flatnonzero(more), np.flatnonzero(less)])
            wanted = np.concatenate([here, here[more] + 1, here[less] - 1])
            surplus = np.concatenate([surplus, np.zeros(more.sum(), surplus.dtype), surplus[less]])
            deficit = np.concatenate([deficit, deficit[more], np.zeros(less.sum(), deficit.dtype)])
            found = np.searchsorted(keys, wanted)
            there = keys[np.minimum(found, len(keys) - 1)] == wanted
            who, at, surplus, deficit = who[chosen][there], found[there], surplus[there], deficit[there]
            for a in range(0, len(who), batch):
                part = slice(a, a + batch)
                ways.append((level + 1, who[part], at[part], surplus[part], deficit[part]))


def one_apart(mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
    """Which rows differ by one letter: replaced at equal width, else one more in ``theirs``."""
    width = mine.shape[1]
    if theirs.shape[1] == width:
        return (mine != theirs).sum(axis=1) == 1
    front, back = mine == theirs[:, :-1], (mine == theirs[:, 1:])[:, ::-1]
    lead = np.where(front.all(axis=1), width, front.argmin(axis=1))
    tail = np.where(back.all(axis=1), width, back.argmin(axis=1))
    return lead + tail >= width


def smaller(mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
    """Which rows of ``mine`` come first, of rows that differ."""
    at = (mine != theirs).argmax(axis=1)[:, None]
    return (np.take_along_axis(mine, at, 1) < np.take_along_axis(theirs, at, 1))[:, 0]


def near_in_node(trie: Trie, searches: list[str], surplus: np.ndarray, deficit: np.ndarray):
    """(search, owner) arrays of the words that are near."""
    by_width: dict[int, list[int]] = {}
    for i, word in enumerate(searches):
        by_width.setdefault(len(word), []).append(i)
    for width, rows in by_width.items():
        rows = np.array(rows)
        codes = letter_codes([searches[i] for i in rows])
        vectors = frequency_vectors(codes)
        step = max(1, NODE_BYTES // width // 4)
        for who, owner in trie.search(vectors, surplus[rows], deficit[rows]):
            for a in range(0, len(who), step):
                mine, theirs = who[a : a + step], owner[a : a + step]
                near = one_apart(codes[mine], trie.codes[theirs])
                mine, theirs = mine[near], theirs[near]
                if width == trie.codes.shape[1]:  # words with the same counts find each other from both sides
                    same = (vectors[mine] == trie.vectors[theirs]).all(axis=1)
                    kept = ~same | smaller(codes[mine], trie.codes[theirs])
                    mine, theirs = mine[kept], theirs[kept]
                yield rows[mine], theirs


def searched(batches):
    """Near pairs (word, n, other, other_n), both ways, of rows sorted by node and block with the owners first."""
    node, owners, counts, trie = None, [], [], None
    held: list[tuple] = []

    def pairs():
        nonlocal trie
        if not owners or not held:
            return
        trie = trie or Trie(owners, node[2])
        words = [h[0] for h in held]
        budget = [np.array([h[k] for h in held], np.int8) for k in (2, 3)]
        for mine, theirs in near_in_node(trie, words, *budget):
            left = [words[i] for i in mine], [held[i][1] for i in mine]
            right = [owners[i] for i in theirs], [counts[i] for i in theirs]
            columns = [left[0] + right[0], left[1] + right[1], right[0] + left[0], right[1] + left[1]]
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["word", "n", "other", "other_n"]
            )

    chars = 0
    for batch in batches:
        for path, block, level, owner, word, n, surplus, deficit in zip(*[c.to_pylist() for c in batch.columns]):
            if (path, block, level) != node:
                yield from pairs()
                node, owners, counts, trie, held, chars = (path, block, level), [], [], None, [], 0
            if owner:
                owners.append(word)
                counts.append(n)
            else:
                held.append((word, n, surplus, deficit))
                chars += len(word)
                if len(held) >= BATCH or chars >= NODE_BYTES:
                    yield from pairs()
                    held, chars = [], 0
    yield from pairs()


def near_words(words: DataFrame, node_words: int = NODE_WORDS, node_bytes: int = NODE_BYTES) -> DataFrame:
    """(word, n, other, other_n) for all pairs of ``words`` (word, n) one letter apart, both ways."""
    dealt = deal(words, node_words, node_bytes).select(
        "path", "block", "level", "owner", "word", "n", "surplus", "deficit"
    )
    return (
        dealt.repartition("path", "block")
        .sortWithinPartitions("path", "block", F.desc("owner"))
        .mapInArrow(searched, "word string, n long, other string, other_n long")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form: where the forms (word, form) lead, by doubling.

    Each form is ``factor`` times as frequent as its word, so the ways are short and never closed.
    """
    ways = stored(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("open")), "ways")
    while not ways.where("open").isEmpty():
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = ways.join(further, "root", "left")
        ways = stored(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("open")), "ways")
    return ways.select("word", "root")


def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    factor: int = FACTOR,
    noise: int | None = None,
    node_words: int = NODE_WORDS,
    node_bytes: int = NODE_BYTES,
) -> DataFrame:
    """(word, n, n_near, form, form_n, root), one row per word.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF of at least ``least_letters`` letters, A-Z lower-cased,
    that occur at least ``least_count`` times. ``n_near`` counts the words that differ by one inserted, deleted or
    replaced letter. ``form`` is the most frequent of these (of ties the first by code point), if it is at least
    ``factor`` times as frequent as the word; ``root`` is where forms of forms end, the word itself without a form.
    With ``noise`` every run whose checksum with the document's id it divides first loses a letter.

    A null text has no words, a null id counts as empty text. Repeated rows count as often as they stand. Very long
    texts are read in pieces, very long words take part like others. An empty table gives an empty result; other
    columns of ``docs`` are ignored, whatever their names.
    """
    counts = word_counts(docs, id_col, text_col, least_letters, noise)
    words = stored(counts.where(F.col("n") >= least_count), "words")
    first = F.min(F.struct((-F.col("other_n")).alias("minus_n"), "other"))
    best = near_words(words, node_words, node_bytes).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), first.alias("best"))
    fits = -F.col("best.minus_n") >= F.col("n") * factor
    judged = stored(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(fits, F.col("best.other")).alias("form"),
            F.when(fits, -F.col("best.minus_n")).alias("form_n"),
        ),
        "forms",
    )
    led = roots(judged.where("form is not null").select("word", "form"))
    return judged.join(led, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )


@query(
    r"""
WITH RECURSIVE
bits(k, v) AS (SELECT b, b FROM range(256) t(b)
  UNION ALL
  SELECT s.k + 256, CASE WHEN s.v & 1 = 1 THEN xor(s.v >> 1, 3988292384) ELSE s.v >> 1 END FROM bits s WHERE s.k < 2048),
steps AS (SELECT list(v ORDER BY k) AS t FROM bits WHERE k >= 2048),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
long_runs AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
octets AS (SELECT doc_id, run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM long_runs),
hashed AS (SELECT run, n, xor(list_reduce(
         list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT),
         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS h FROM octets, steps),
texts AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
          ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM texts WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
shorter AS (SELECT DISTINCT word, n, spot, substr(word, 1, spot - 1) || substr(word, spot + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS spot FROM words)),
near AS (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM shorter a JOIN words b ON a.rest = b.word
  UNION
  SELECT DISTINCT b.word, b.n, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word
  UNION
  SELECT DISTINCT a.word, a.n, b.word, b.n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.spot = b.spot AND a.word <> b.word),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other,
         first(other_n ORDER BY other_n DESC, other) AS other_n FROM near GROUP BY word),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * w.n THEN other END AS form,
          CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n FROM words w LEFT JOIN best USING (word)),
led(word, root, form) AS (SELECT word, word, form FROM forms
  UNION ALL
  SELECT l.word, f.word, f.form FROM led l JOIN forms f ON l.form = f.word)
SELECT word, n, n_near, form, form_n, root
FROM forms JOIN (SELECT word, root FROM led WHERE led.form IS NULL) USING (word)
"""
)
def op11_spelling_variant_grouping(spark, sf_dir):
    return spelling_variants(table(spark, sf_dir, "documents"), noise=NOISE)
