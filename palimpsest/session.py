"""Session defaults and the shared folder that tables and checkpoints are written to."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_folders: dict[str, str] = {}
_scratch: list[str] = []


def build_session(app: str = "palimpsest", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every operator here relies on; ``conf`` keys use ``_`` for ``.``.

    On a cluster the master, memory and ``spark.checkpoint.dir`` come from the submit command.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
    }
    settings.update({key.replace("_", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``, or an own one in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _own_folders:
        folder = tempfile.mkdtemp(prefix="palimpsest-")
        context.setCheckpointDir(folder)
        _own_folders[context.applicationId] = folder
    return _own_folders[context.applicationId]


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unused path under the shared folder."""
    path = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the scratch tables made inside once they have served, that is, once the results are written."""
    before = len(_scratch)
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for path in _scratch[before:]:
            folder = hadoop.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        del _scratch[before:]


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """``rows`` written once to the shared folder and read back: later uses start from the table.

    Unlike cached blocks the table outlives the executor that wrote it.
    """
    path = scratch_path(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
