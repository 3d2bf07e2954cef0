"""Tables replaced as a whole: every refresh writes a folder of its own, and one pointer names the folder that counts.

``<root>/generations/<name>/<relation>`` holds the data, ``<root>/current`` the names of the published generations,
the latest first. The pointer is written aside and renamed over the old one in one step, after all relations of the
generation are complete. So a refresh may read what it replaces; who has opened a relation goes on reading the
generation it was opened at; and a refresh that breaks off leaves nothing that a reader sees.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, types as T

DATA = "data"
KEPT = 2
#: A folder that no pointer names belongs to a refresh under way until it is this old.
GRACE_SECONDS = 24 * 3600


def file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _read_text(spark: SparkSession, path: str) -> str | None:
    where, files = file_system(spark, path)
    if not files.exists(where):
        return None
    stream = files.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _swap_text(spark: SparkSession, path: str, text: str) -> None:
    """Write ``text`` aside and rename it over ``path``: readers find the old text or the new one, whole."""
    aside, files = file_system(spark, f"{path}.{uuid.uuid4().hex}")
    stream = files.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    where, _ = file_system(spark, path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    context.rename(aside, where, options)


def published(spark: SparkSession, root: str) -> list[str]:
    """Names of the published generations, the current one first."""
    text = _read_text(spark, f"{root}/current")
    return json.loads(text) if text else []


def folder(root: str, generation: str, relation: str = DATA) -> str:
    return f"{root}/generations/{generation}/{relation}"


def new_generation() -> str:
    """Names sort by the time they were made."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


class Superseded(RuntimeError):
    """Another refresh was published while this one ran."""


def swap(spark: SparkSession, root: str, generation: str, seen: list[str], kept: int = KEPT) -> None:
    """Make a complete generation the current one.

    ``seen`` is what was published when the refresh began: a refresh that was overtaken does not bring back older
    contents. Of earlier generations the ``kept`` latest stay named, for readers that have opened them.
    """
    if published(spark, root) != seen:
        raise Superseded(f"{root}: published since the refresh began")
    _swap_text(spark, f"{root}/current", json.dumps([generation, *seen][: kept + 1]))


def publish(spark: SparkSession, relations: dict[str, DataFrame], root: str, kept: int = KEPT) -> str:
    """Write all relations as one generation and publish them together; they may read the current one."""
    seen, generation = published(spark, root), new_generation()
    for name, relation in relations.items():
        relation.write.mode("overwrite").parquet(folder(root, generation, name))
    swap(spark, root, generation, seen, kept)
    return generation


def read(
    spark: SparkSession, root: str, relation: str = DATA, schema: T.StructType | None = None, back: int = 0
) -> DataFrame:
    """A relation of the current generation, or of the one ``back`` refreshes before it.

    Before the first refresh it is empty if its schema is given.
    """
    names = published(spark, root)
    if not names and schema is not None and not back:
        return spark.createDataFrame([], schema)
    if back >= len(names):
        raise LookupError(f"{root} has {len(names)} published generations")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(folder(root, names[back], relation))


def clean(spark: SparkSession, root: str, grace_seconds: float = GRACE_SECONDS) -> list[str]:
    """Delete the generations that the pointer no longer names, but none young enough to be under way."""
    where, files = file_system(spark, f"{root}/generations")
    if not files.exists(where):
        return []
    named = set(published(spark, root))
    oldest = time.time_ns() - int(grace_seconds * 1e9)
    gone = []
    for status in files.listStatus(where):
        name = status.getPath().getName()
        if name not in named and int(name.split("-")[0]) < oldest:
            files.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)
