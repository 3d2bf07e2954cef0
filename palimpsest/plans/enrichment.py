"""Enrichment: topics and summaries, computed once per text and kept beside the version log."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from palimpsest.operators import inherit as carry
from palimpsest.operators.history import LOADED_AT
from palimpsest.operators.joins import fits_broadcast
from palimpsest.operators.models import apply_model
from palimpsest.operators.topics import nearest_topic
from palimpsest.plans.entities import TOPICS
from palimpsest.session import scratch_path, scratch_scope, stored
from palimpsest.sources.landing import BATCH, read_or_empty

TOPIC, SCORE, SUMMARY = "tema_classificado", "tema_score", "resumo_executivo"
_KEY = [T.StructField("id", T.LongType()), T.StructField("batch", T.StringType())]
_AT = [T.StructField("enriched_at", T.TimestampType())]
TOPIC_TABLE = T.StructType(
    _KEY + [T.StructField(TOPIC, T.StringType()), T.StructField(SCORE, T.DoubleType())] + _AT
)
SUMMARY_TABLE = T.StructType(_KEY + [T.StructField(SUMMARY, T.StringType())] + _AT)
# Jobs of a run, each of which keeps what it finished; slices of a short queue share one.
SLICES = 8
JOB_ROWS = 20_000
SLICE = "_slice"
# Rows of a model task, of which there are then enough for all cores and no long ones.
TASK_ROWS = 10_000
VECTOR = T.ArrayType(T.FloatType())
# Stands for the text where only its equality counts.
DIGEST = "_digest"


def topic_dimension(spark: SparkSession, embed: Callable[[list[str]], list]) -> DataFrame:
    """The ten topics with their vectors: one model call, on the driver, once per run."""
    vectors = embed([description for _, description in TOPICS])
    rows = [(i, name, [float(x) for x in v]) for i, ((name, _), v) in enumerate(zip(TOPICS, vectors))]
    return spark.createDataFrame(rows, "ord int, topic string, vector array<float>")


def _tasks(spark: SparkSession, rows: int) -> int:
    """Tasks for a queue: one per core, or more where a task would get over ``TASK_ROWS`` rows.

    The model is the costly part: little work is lost with an executor, and no core idles because the queue
    sits in a few files.
    """
    return max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def with_digest(log: DataFrame, text: str = "ementa") -> DataFrame:
    """The log with a SHA-256 digest of its texts. Made where the log is read, it moves in their place."""
    return log.withColumn(DIGEST, F.unhex(F.sha2(F.col(text), 256)))


def classify(
    queue: DataFrame,
    text: str,
    embed: Callable[[list[str]], list],
    topics: DataFrame,
    tasks: int | None = None,
) -> DataFrame:
    """Queue rows with topic, score and error; rows whose model call failed keep NULLs."""
    vectors = apply_model(queue, text, embed, "_vector", VECTOR, tasks=tasks)
    return nearest_topic(vectors, "_vector", topics, TOPIC, SCORE).drop("_vector")


def summarize(
    queue: DataFrame,
    model: Callable[[list[str]], list],
    short: str = "ementa",
    long: str = "ementaDetalhada",
    tasks: int | None = None,
) -> DataFrame:
    """Queue rows with summary and error. Surrounding blanks of a summary are removed."""
    texts = queue.withColumn("_text", carry.summary_input(short, long)).drop(short, long)
    made = apply_model(texts, "_text", model, SUMMARY, T.StringType(), tasks=tasks)
    return made.withColumn(SUMMARY, F.regexp_replace(SUMMARY, r"(?U)^\s+|\s+$", ""))


def _keep(rows: DataFrame, table: T.StructType, path: str, at: datetime) -> None:
    """Write back: add enriched rows that have a key and a value to the enrichment table."""
    value = table.fields[2].name
    complete = rows.filter(F.col("id").isNotNull() & F.col(value).isNotNull())
    complete.withColumn("enriched_at", F.lit(at).cast("timestamp")).select(table.fieldNames()).write.mode(
        "append"
    ).parquet(path)


def _enrich(
    spark: SparkSession,
    flagged: DataFrame,
    path: str,
    table: T.StructType,
    labels: list[str],
    queue_of: Callable[[DataFrame], DataFrame],
    apply: Callable[[DataFrame, int | None], DataFrame],
    at: datetime,
    slices: int,
    texts: DataFrame | None,
) -> None:
    """Inherit, then work off the queue in up to ``slices`` jobs.

    Inheritance and the pending keys are found without the texts, by their digests. Only then are the texts of the
    pending versions looked up, once, and stored by slice. Every job reads its
    slices alone, few of a long queue and all of a short one, and appends what it finished, so a run that is cut off resumes with what is left.
    """
    narrow = flagged if DIGEST in flagged.columns else with_digest(flagged)
    narrow = narrow.select("id", BATCH, DIGEST, LOADED_AT, "is_current")

    def labelled() -> DataFrame:
        return carry.with_enrichment(narrow, read_or_empty(spark, path, table), "id", BATCH)

    known = carry.inherit(labelled(), "id", DIGEST, labels, BATCH)
    _keep(known.filter("inherited"), table, path, at)
    with scratch_scope(spark):
        pending = carry.pending_summary(labelled().filter("is_current"), labels[0]).filter(F.col("id").isNotNull())
        pending = stored(pending.select(F.col("id").alias("_id"), F.col(BATCH).alias("_batch")).distinct(), "pending")
        queue = _of_pending(queue_of(flagged if texts is None else texts), pending)
        sliced = queue.withColumn(SLICE, F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int"))
        folder = scratch_path(spark, "queue")
        sliced.write.partitionBy(SLICE).parquet(folder)
        kept = read_or_empty(spark, folder, sliced.schema)
        sizes = {r[SLICE]: r["n"] for r in kept.groupBy(SLICE).agg(F.count(F.lit(1)).alias("n")).collect()}
        for parts, rows in _jobs(sizes):
            part = kept.filter(F.col(SLICE).isin(parts)).drop(SLICE)
            # The slices were written by many tasks: mostly a scan has the texts dealt out, and they need not move again.
            dealt = part.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
            _keep(apply(part, None if dealt else _tasks(spark, rows)), table, path, at)


def _of_pending(queue: DataFrame, pending: DataFrame) -> DataFrame:
    """Rows of the pending versions. Batches without any are left out first, if these are few enough to be listed."""
    batches = pending.select("_batch").distinct()
    if fits_broadcast(batches):
        queue = queue.join(F.broadcast(batches), F.col(BATCH).eqNullSafe(F.col("_batch")), "left_semi")
    wanted = F.broadcast(pending) if fits_broadcast(pending) else pending
    same = (F.col("id") == F.col("_id")) & F.col(BATCH).eqNullSafe(F.col("_batch"))
    return queue.join(wanted, same, "left_semi")


def _jobs(sizes: dict[int, int]) -> list[tuple[list[int], int]]:
    """Slices put together, with their rows, as long as these are no more than ``JOB_ROWS``."""
    jobs: list[tuple[list[int], int]] = []
    for part, rows in sorted(sizes.items()):
        if jobs and jobs[-1][1] + rows <= JOB_ROWS:
            jobs[-1] = ([*jobs[-1][0], part], jobs[-1][1] + rows)
        else:
            jobs.append(([part], rows))
    return jobs


def classify_propositions(
    spark: SparkSession,
    flagged: DataFrame,
    path: str,
    embed: Callable[[list[str]], list],
    at: datetime,
    slices: int = SLICES,
    texts: DataFrame | None = None,
) -> DataFrame:
    """Topic table after a run over versions with ``is_current``; only texts not seen before reach the model.

    ``texts`` is the log itself, if ``flagged`` is costly to read: texts are then taken from there by id and batch.
    """
    topics = topic_dimension(spark, embed)
    _enrich(
        spark,
        flagged,
        path,
        TOPIC_TABLE,
        [TOPIC, SCORE],
        lambda rows: rows.filter(F.col("ementa") != "").select("id", BATCH, "ementa"),
        lambda queue, tasks: classify(queue, "ementa", embed, topics, tasks),
        at,
        slices,
        texts,
    )
    return read_or_empty(spark, path, TOPIC_TABLE)


def summarize_propositions(
    spark: SparkSession,
    flagged: DataFrame,
    path: str,
    model: Callable[[list[str]], list],
    at: datetime,
    slices: int = SLICES,
    texts: DataFrame | None = None,
) -> DataFrame:
    """Summary table after a run over versions with ``is_current``; failed rows stay in the queue.

    ``texts`` as for ``classify_propositions``.
    """
    _enrich(
        spark,
        flagged,
        path,
        SUMMARY_TABLE,
        [SUMMARY],
        lambda rows: rows.select("id", BATCH, "ementa", "ementaDetalhada"),
        lambda queue, tasks: summarize(queue, model, tasks=tasks),
        at,
        slices,
        texts,
    )
    return read_or_empty(spark, path, SUMMARY_TABLE)
