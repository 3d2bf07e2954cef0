"""Three-line extractive summaries: the default text model when no external one is given."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from palimpsest.operators.joins import BROADCAST_BYTES, fits_broadcast, salted_join
from palimpsest.session import stored

# Fixed value: lines of a summary.
LINES = 3
SENTENCE = r"[^.!?\n]+[.!?]*"
WORD = r"[\p{L}\p{N}]+"
# Words whose weights are sent to every task, if they also pass the size check of a broadcast.
VOCABULARY_ROWS = 2_000_000


def sentences(text: str) -> Column:
    """Sentences of the whole text in order; blank ones are left out."""
    found = F.regexp_extract_all(F.col(text), F.lit(SENTENCE), F.lit(0))
    return F.filter(F.transform(found, lambda s: F.trim(s)), lambda s: s != "")


def frequent_from(spread: DataFrame) -> int:
    """The number of sentences, a power of two, from which on words are few and short enough to be broadcast.

    One row per power comes to the driver. If even the most frequent words are too many, no word has that number.
    """
    size = F.sum(F.octet_length(F.to_json(F.struct("word", "_rows"))))
    powers = spread.groupBy(F.length(F.bin("_rows")).alias("power")).agg(F.count(F.lit(1)).alias("rows"), size.alias("size"))
    found = sorted(powers.collect(), reverse=True)
    rows = size = 0
    for power in found:
        rows, size = rows + power["rows"], size + power["size"]
        if rows > VOCABULARY_ROWS or size > BROADCAST_BYTES:
            return 1 << power["power"]
    return 1


def extractive_summary(
    rows: DataFrame, key: str, text: str, value: str = "summary", lines: int = LINES, hot: dict | None = None
) -> DataFrame:
    """The ``lines`` highest-scoring sentences of each text, in text order, one per line; ``key`` is unique.

    A sentence scores, over its distinct words, floor(log2(sentences / sentences with the word)): whole
    numbers, so the result does not depend on the order of addition. A text without words gets its first
    sentences, one without sentences empty text.

    Words are made distinct inside the sentence, before any shuffle. Words in more than half of the sentences
    weigh nothing and drop out. The weights of the others are broadcast if they are few enough, so a sentence
    is summed up where it was split. Of a larger vocabulary the most frequent words are broadcast, which are nearly all
    that occur, and only the others are joined, with the ``hot`` words salted. Texts move once, to meet the positions
    picked for them.
    """
    split = rows.select(key, F.posexplode(sentences(text)).alias("position", "sentence"))
    words = F.array_distinct(F.regexp_extract_all(F.lower("sentence"), F.lit(WORD), F.lit(0)))
    split = stored(split.select(key, "position", words.alias("words")), "sentences")
    used = split.select(key, "position", F.explode("words").alias("word"))
    total = split.count()
    spread = stored(used.groupBy("word").agg(F.count(F.lit(1)).alias("_rows")), "word-counts")
    weight = F.length(F.bin(F.expr(f"{total} div _rows"))) - 1
    weighed = spread.select("word", weight.alias("weight"), "_rows")
    weights = weighed.select("word", "weight").filter("weight > 0")
    if fits_broadcast(weights, VOCABULARY_ROWS):
        weighted = used.join(F.broadcast(weights), "word")
    else:
        least = frequent_from(spread)
        # Words that weigh nothing are among the frequent ones, so that they do not move either.
        often = F.broadcast(weighed.filter(F.col("_rows") >= least).select("word", "weight"))
        rare = weighed.filter((F.col("_rows") < least) & (F.col("weight") > 0)).select("word", "weight")
        columns = [key, "position", "weight"]
        weighted = used.join(often, "word").filter("weight > 0").select(columns).unionByName(
            salted_join(used.join(often, "word", "left_anti"), rare, "word", "inner", hot, [key, "position"]).select(columns)
        )
    scored = weighted.groupBy(key, "position").agg(F.sum("weight").alias("score"))
    best_first = Window.partitionBy(key).orderBy(F.desc("score"), "position")
    best = scored.withColumn("_rank", F.row_number().over(best_first)).filter(F.col("_rank") <= lines)
    picked = best.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_rank", "position"))).alias("_picked"))
    # Sentences of score 0 fill up in text order.
    every = F.transform("_sentences", lambda s, i: i)
    order = F.array_union(F.coalesce("_picked.position", F.array().cast("array<int>")), every)
    chosen = F.array_sort(F.slice(order, 1, lines))
    return (
        rows.join(picked, key, "left")
        .withColumn("_sentences", F.coalesce(sentences(text), F.array().cast("array<string>")))
        .withColumn("_chosen", chosen)
        .select(key, F.array_join(F.transform("_chosen", lambda i: F.get("_sentences", i)), "\n").alias(value))
    )
