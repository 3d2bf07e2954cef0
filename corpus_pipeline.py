"""A training-corpus pipeline: documents in, token digests of the clean ones out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from palimpsest.llm.bpe import encode_decode
from palimpsest.llm.common import table
from palimpsest.llm.decontaminate import decontaminate
from palimpsest.llm.line_dedup import line_dedup
from palimpsest.llm.quality import keep_good
from palimpsest.llm.simhash import simhash_dedup
from palimpsest.session import scratch_path, scratch_scope


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of line runs; ``n_chars`` follows the text."""
    cleaned = line_dedup(docs, dropped=None)
    return cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked fingerprints."""
    return simhash_dedup(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the limit of benchmark words."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding_decoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text."""
    return encode_decode(docs, outputs=False)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("BPE encoding and decoding", bpe_encoding_decoding),
]

#: Neither the classifier's vectors nor the vocabulary's merges can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        target = scratch_path(spark, name.lower().replace(" ", "-"))
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(target)
        docs = spark.read.parquet(target)
    return docs
