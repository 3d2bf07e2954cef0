"""Queries over inheritance, work queues, classification and summaries."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F, types as T

from palimpsest.operators import inherit as carry
from palimpsest.operators import history
from palimpsest.operators.models import apply_model
from palimpsest.operators.summaries import extractive_summary
from palimpsest.operators.topics import nearest_topic, similarities
from palimpsest.plans import enrichment, silver
from palimpsest.plans.entities import SPECS, TOPICS
from palimpsest.session import scratch_path
from palimpsest.sources.landing import spread_input
from palimpsest.workload.history import version_table
from palimpsest.workload.registry import VERSIONS_SQL, millionths, query, table
from palimpsest.workload.silver import PROPOSITIONS_SQL, proposition_records

# Versions with a text (the event type) and a label (props.k) that superseded versions with a value over 10 carry.
_LABELLED_SQL = f"""{VERSIONS_SQL},
flagged AS (
  SELECT *, batch = max(batch) OVER (PARTITION BY user_id) AS is_current FROM versions),
labelled AS (
  SELECT user_id AS id, batch, loaded_at, event_type AS ementa, is_current,
         CASE WHEN NOT is_current AND value > 10 THEN 'k' || json_extract_string(props, '$.k') END AS label
  FROM flagged),
latest AS (
  SELECT * FROM labelled WHERE NOT is_current AND label IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC, batch DESC) = 1)"""


def _labelled(spark, sf_dir):
    flagged = history.flag_current(version_table(spark, sf_dir), "user_id", "batch", "delta")
    label = F.concat(F.lit("k"), F.get_json_object("props", "$.k"))
    return flagged.select(
        F.col("user_id").alias("id"),
        "batch",
        "loaded_at",
        F.col("event_type").alias("ementa"),
        "is_current",
        F.when(~F.col("is_current") & (F.col("value") > 10), label).alias("label"),
    )


@query(f"WITH {_LABELLED_SQL} SELECT id, CAST(batch AS VARCHAR) AS batch, ementa, label FROM latest")
def latest_labelled(spark, sf_dir):
    """Latest superseded version with a label, per key."""
    rows = carry.latest_labelled(_labelled(spark, sf_dir), "id", ["label"], "batch")
    return rows.select("id", F.col("batch").cast("string").alias("batch"), "ementa", "label")


@query(f"""WITH {_LABELLED_SQL}
SELECT c.id, c.ementa, coalesce(CASE WHEN h.ementa = c.ementa THEN h.label END, 'none') AS label,
       coalesce(h.ementa = c.ementa, false) AS inherited
FROM labelled c LEFT JOIN latest h ON c.id = h.id WHERE c.is_current""")
def inherit_unchanged(spark, sf_dir):
    """Current rows take the label of an unchanged text."""
    rows = carry.inherit(_labelled(spark, sf_dir), "id", "ementa", ["label"], "batch")
    return rows.select("id", "ementa", F.coalesce("label", F.lit("none")).alias("label"), "inherited")


# Texts that are missing or empty, by source; those with a quality label count as enriched.
_TEXTS_SQL = """
texts AS (
  SELECT doc_id, CASE WHEN source = 'src1' THEN NULL WHEN source = 'src2' THEN '' ELSE text END AS ementa,
         CASE WHEN lang = 'fr' THEN '- ' || text WHEN source = 'src3' THEN '' END AS detailed,
         CASE quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END AS tema
  FROM documents LEFT JOIN labels USING (doc_id))"""


def _texts(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    joined = table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    source = F.col("source")
    return joined.select(
        "doc_id",
        F.when(source == "src1", None).when(source == "src2", "").otherwise(F.col("text")).alias("ementa"),
        F.when(F.col("lang") == "fr", F.concat(F.lit("- "), "text")).when(source == "src3", "").alias("detailed"),
        F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor").alias("tema"),
    )


@query(f"WITH {_TEXTS_SQL} SELECT doc_id, ementa FROM texts WHERE tema IS NULL AND ementa IS NOT NULL AND ementa <> ''")
def pending_classification(spark, sf_dir):
    """Queue of texts without a topic."""
    return carry.pending_classification(_texts(spark, sf_dir), "ementa", "tema").select("doc_id", "ementa")


@query(f"""WITH {_TEXTS_SQL} SELECT doc_id, CASE WHEN ementa IS NULL THEN 'missing' WHEN ementa = '' THEN 'empty' ELSE 'text' END AS state
FROM texts WHERE tema IS NULL""")
def pending_summary(spark, sf_dir):
    """Queue of rows without a summary; missing and empty texts are in it."""
    state = F.when(F.col("ementa").isNull(), "missing").when(F.col("ementa") == "", "empty").otherwise("text")
    return carry.pending_summary(_texts(spark, sf_dir), "tema").select("doc_id", state.alias("state"))


@query(f"""WITH {_TEXTS_SQL}
SELECT doc_id, CASE WHEN detailed IS NOT NULL AND detailed <> '' THEN detailed ELSE coalesce(ementa, '') END AS content FROM texts""")
def summary_input(spark, sf_dir):
    """The text a summary is made from."""
    return _texts(spark, sf_dir).select("doc_id", carry.summary_input("ementa", "detailed").alias("content"))


_PROTOTYPES_SQL = """
prototypes AS (
  SELECT label AS ord, 'topic ' || label AS topic, embedding AS vector FROM embeddings
  QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) = 1),
scored AS (
  SELECT vec_id, ord, topic,
         list_dot_product(embedding::DOUBLE[], vector::DOUBLE[])
         / ((sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) + 1e-10)
            * (sqrt(list_dot_product(vector::DOUBLE[], vector::DOUBLE[])) + 1e-10)) AS score
  FROM embeddings, prototypes)"""


def _prototypes(spark, sf_dir):
    """First vector of each label, as the topic dimension."""
    vectors = table(spark, sf_dir, "embeddings")
    first = F.min_by("embedding", "vec_id").alias("vector")
    return vectors.groupBy(F.col("label").alias("ord")).agg(first).select(
        "ord", F.concat(F.lit("topic "), "ord").alias("topic"), "vector"
    )


@query(f"""WITH {_PROTOTYPES_SQL}
SELECT vec_id, string_agg(CAST(CAST(round(score * 1000000) AS BIGINT) AS VARCHAR), ',' ORDER BY ord) AS scores
FROM scored GROUP BY vec_id""")
def cosine_scores(spark, sf_dir):
    """Similarity of every vector to every topic, in topic order."""
    rows = similarities(table(spark, sf_dir, "embeddings"), "embedding", _prototypes(spark, sf_dir))
    texts = F.transform("scores", lambda s: millionths(s).cast("string"))
    return rows.select("vec_id", F.array_join(texts, ",").alias("scores"))


_NEAREST_SQL = f"""WITH {_PROTOTYPES_SQL}
SELECT vec_id, topic, CAST(round(score * 1000000) AS BIGINT) AS score FROM scored
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, ord) = 1"""


@query(_NEAREST_SQL)
def classify_topics(spark, sf_dir):
    """Best topic per vector: one matrix product per Arrow batch."""
    rows = nearest_topic(table(spark, sf_dir, "embeddings"), "embedding", _prototypes(spark, sf_dir))
    return rows.select("vec_id", "topic", millionths(F.col("score")).alias("score"))


@query(_NEAREST_SQL)
def classify_topics_columns(spark, sf_dir):
    """Best topic per vector by column expressions, the topics in blocks of four."""
    rows = nearest_topic(
        table(spark, sf_dir, "embeddings"), "embedding", _prototypes(spark, sf_dir), method="columns", block=4
    )
    return rows.select("vec_id", "topic", millionths(F.col("score")).alias("score"))


@query("""
SELECT doc_id, CASE WHEN text LIKE '%@%' THEN -1 ELSE length(text) - length(replace(text, ' ', '')) END AS blanks,
       CASE WHEN text LIKE '%@%' THEN 'ValueError: address in text' ELSE 'none' END AS error
FROM documents""")
def model_hook(spark, sf_dir):
    """A model over all texts that refuses some; these keep an error and stay pending."""

    def count_blanks(texts):
        if any("@" in t for t in texts):
            raise ValueError("address in text")
        return [t.count(" ") for t in texts]

    rows = apply_model(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", count_blanks, "blanks", T.LongType())
    return rows.select(
        "doc_id", F.coalesce("blanks", F.lit(-1)).alias("blanks"), F.coalesce("error", F.lit("none")).alias("error")
    )


def _letter_model():
    """Deterministic stand-in for an embedding model: occurrences of each letter a to z."""

    def count(texts):
        return [[float(t.count(c) + t.count(c.upper())) for c in "abcdefghijklmnopqrstuvwxyz"] for t in texts]

    return count


letter_counts = _letter_model()


def _letters_sql(text: str) -> str:
    counts = [f"2 * length({text}) - length(replace({text}, '{c}', '')) - length(replace({text}, '{c.upper()}', ''))"
              for c in "abcdefghijklmnopqrstuvwxyz"]
    return "[" + ", ".join(counts) + "]::DOUBLE[]"


_TOPIC_ROWS = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(TOPICS))
_TOPICS_SQL = f"topics AS (SELECT ord, topic, {_letters_sql('description')} AS vector FROM (VALUES {_TOPIC_ROWS}) AS t(ord, topic, description))"
_COSINE_SQL = """list_dot_product(v, vector) / ((sqrt(list_dot_product(v, v)) + 1e-10) * (sqrt(list_dot_product(vector, vector)) + 1e-10))"""


@query(f"""WITH {_TOPICS_SQL},
vectors AS (SELECT doc_id, {_letters_sql('text')} AS v FROM documents),
scored AS (SELECT doc_id, ord, topic, {_COSINE_SQL} AS score FROM vectors, topics)
SELECT doc_id, topic, CAST(round(score * 1000000) AS BIGINT) AS score FROM scored
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, ord) = 1""")
def classify_documents(spark, sf_dir):
    """Texts through the model hook, and each vector to its nearest topic."""
    topics = enrichment.topic_dimension(spark, letter_counts)
    queue = spread_input(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = enrichment.classify(queue, "text", letter_counts, topics)
    return rows.select(
        "doc_id", F.col(enrichment.TOPIC).alias("topic"), millionths(F.col(enrichment.SCORE)).alias("score")
    )


def _proposition_log(spark, sf_dir):
    """Stored version log of the propositions and its flags: first the labelled documents, then all."""
    root, spec = scratch_path(spark, "silver"), SPECS["propositions"]
    rows = silver.transform_propositions(proposition_records(spark, sf_dir))
    silver.load(rows, spec, root, datetime(2024, 1, 2, tzinfo=timezone.utc), batches=2)
    log = enrichment.with_digest(silver.versions(spark, spec, root))
    return log, history.flag_current(log, "id", "batch", "delta")


@query(f"""WITH {PROPOSITIONS_SQL}, {_TOPICS_SQL},
vectors AS (SELECT id, source_file AS batch, {_letters_sql('ementa')} AS v FROM propositions),
scored AS (SELECT id, batch, ord, topic, {_COSINE_SQL} AS score FROM vectors, topics)
SELECT id, batch, topic AS tema_classificado, CAST(round(score * 1000000) AS BIGINT) AS score FROM scored
QUALIFY row_number() OVER (PARTITION BY id, batch ORDER BY score DESC, ord) = 1""")
def classify_propositions(spark, sf_dir):
    """Both batches classified as they load; in the second run unchanged texts inherit their topic."""
    path = scratch_path(spark, "topics")
    log, flagged = _proposition_log(spark, sf_dir)
    first = log.filter("batch = 'delta_1.json'").withColumn("is_current", F.lit(True))
    for day, rows in enumerate((first, flagged), start=1):
        at = datetime(2024, 1, day, tzinfo=timezone.utc)
        labels = enrichment.classify_propositions(spark, rows, path, letter_counts, at, texts=log)
    return labels.select(
        "id", "batch", enrichment.TOPIC, millionths(F.col(enrichment.SCORE)).alias("score")
    )


@query(f"""WITH {PROPOSITIONS_SQL},
done AS (SELECT * FROM propositions WHERE ementa NOT LIKE '%@%')
SELECT p.id, p.source_file AS batch, p.ementa, coalesce('lines: ' || (1 + length(d.ementa) - length(replace(d.ementa, chr(10), ''))), 'pending') AS resumo_executivo
FROM propositions p LEFT JOIN done d ON p.id = d.id AND p.source_file = d.source_file""")
def summarize_propositions(spark, sf_dir):
    """Both batches summarised as they load; rows whose call fails stay pending."""

    def describe(texts):
        if any("@" in t for t in texts):
            raise ValueError("address in text")
        return [f"  lines: {1 + t.count(chr(10))}\n" for t in texts]

    path = scratch_path(spark, "summaries")
    log, flagged = _proposition_log(spark, sf_dir)
    first = log.filter("batch = 'delta_1.json'").withColumn("is_current", F.lit(True))
    for day, rows in enumerate((first, flagged), start=1):
        at = datetime(2024, 1, day, tzinfo=timezone.utc)
        made = enrichment.summarize_propositions(spark, rows, path, describe, at, slices=2, texts=log)
    rows = carry.with_enrichment(log, made, "id", "batch")
    return rows.select(
        "id", "batch", "ementa", F.coalesce(enrichment.SUMMARY, F.lit("pending")).alias(enrichment.SUMMARY)
    )


@query(r"""
WITH split AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[^.!?\n]+[.!?]*')) AS sentence,
         generate_subscripts(regexp_extract_all(text, '[^.!?\n]+[.!?]*'), 1) AS position FROM documents),
sentences AS (SELECT doc_id, position, trim(sentence, ' ') AS sentence FROM split WHERE trim(sentence, ' ') <> ''),
words AS (SELECT doc_id, position, unnest(regexp_extract_all(lower(sentence), '[\p{L}\p{N}]+')) AS word FROM sentences),
used AS (SELECT DISTINCT * FROM words),
rarity AS (SELECT word, length(bin((SELECT count(*) FROM sentences) // count(*))) - 1 AS rarity FROM used GROUP BY 1),
scores AS (SELECT doc_id, position, sum(rarity) AS score FROM used JOIN rarity USING (word) GROUP BY 1, 2),
best AS (SELECT doc_id, position, sentence FROM sentences LEFT JOIN scores USING (doc_id, position)
         QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY coalesce(score, 0) DESC, position) <= 3)
SELECT doc_id, coalesce(string_agg(sentence, chr(10) ORDER BY position), '') AS summary
FROM documents LEFT JOIN best USING (doc_id) GROUP BY doc_id""")
def extractive_summaries(spark, sf_dir):
    """Three most telling sentences of each whole text."""
    documents = spread_input(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return extractive_summary(documents, "doc_id", "text")
