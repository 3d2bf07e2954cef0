"""Landed batches: scan, discovery, latest-batch selection, list pages and the batch sinks.

A batch is what one run delivered. API files are JSON arrays (one file per batch, read by one task unless the file
is large, see ``read_indented_batches`` and ``arrays``); larger feeds land as JSON Lines or Parquet in
``batch=<name>/`` folders, which split freely.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from palimpsest.operators.joins import fits_broadcast

ORDINAL = "_ordinal"
SOURCE_FILE = "source_file"
BATCH = "batch"


def file_ordinal():
    """Position of a record in its file: split offset first, then the order within the split."""
    return F.struct(
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_json_batches(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    pattern: str = "*.json",
    array_files: bool = True,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Records of all files matching ``pattern``, with their file name and position.

    The schema is given, never inferred: no extra pass over the data, a field that no record has becomes a
    NULL column, and an empty file gives no rows. Malformed JSON stops the read.
    """
    return (
        spark.read.schema(schema)
        .option("multiLine", array_files)
        .option("pathGlobFilter", pattern)
        .option("mode", mode)
        .json(path)
        .select("*", F.col("_metadata.file_name").alias(SOURCE_FILE), file_ordinal().alias(ORDINAL))
    )


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Texts between the records' ends and beginnings in array files indented by two."""
    return spark.read.option("lineSep", "\n  },\n  {").text(path).select(
        "value", F.col("_metadata.file_name").alias(SOURCE_FILE), file_ordinal().alias(ORDINAL)
    )


def _closed():
    return F.col("value").rlike(r"(^\s*\[\s*|\n  \}\n)\]\s*$")


def _opened():
    return F.col("value").rlike(r"^(\[\n  \{)?\n")


def _empty():
    return F.col("value").rlike(r"^\s*(\[\s*\]\s*)?$")


def _body(text):
    """A piece without the array's brackets and its record's braces."""
    return F.regexp_replace(F.regexp_replace(text, r"^\[\n  \{", ""), r"\n  \}\n\]\s*$", "")


def read_indented_batches(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """The same for large array files in the layout of the batch writer: one array, indented by two blanks.

    In it a record ends and the next begins with the same characters, which occur nowhere else, as line breaks
    inside values are escaped. Used as separator they let one file split over many tasks. A file in another
    layout or with a malformed record stops the read. So does a file that was cut off, found by a first pass
    for its closing bracket.
    """
    pieces = _pieces(spark, path)
    text = F.col("value")
    cut = pieces.groupBy(SOURCE_FILE).agg(F.max(_closed()).alias("closed")).filter("not closed").first()
    if cut:
        raise ValueError(f"not a whole array indented by two: {cut[SOURCE_FILE]}")
    checked = F.when(_opened(), text).otherwise(
        F.raise_error(F.concat(F.lit("not an array indented by two: "), SOURCE_FILE))
    )
    record = F.from_json(F.concat(F.lit("{"), _body(checked), F.lit("}")), schema, {"mode": "FAILFAST"})
    return pieces.filter(~_empty()).select(record.alias("_record"), SOURCE_FILE, ORDINAL).select(
        "_record.*", SOURCE_FILE, ORDINAL
    )


# Longest line of an array file that the layout check looks at; longer ones stand inside a record.
LAYOUT_LINE_BYTES = 64 * 1024 * 1024


def indented_files(spark: SparkSession, paths: list[str]) -> set[str]:
    """Names of the array files in the layout that ``read_indented_batches`` can split.

    One pass over the lines, which splits any file and skips the overlong lines of another layout unread: the
    array's brackets stand alone, and at two blanks there are only the braces of its records, all closed.
    """
    lines = (
        spark.read.option("mapreduce.input.linerecordreader.line.maxlength", str(LAYOUT_LINE_BYTES))
        .option("lineSep", "\n")
        .text(paths)
        .select("value", F.col("_metadata.file_name").alias("file"))
    )
    outer = lines.filter(F.col("value").rlike(r"^ {0,2}[^ ]"))

    def times(*wanted: str):
        return F.count(F.when(F.col("value").isin(*wanted), 1))

    laid_out = (
        (times("[") == 1)
        & (times("]") == 1)
        & (times("  }") == 1)
        & (times("  {") == times("  }", "  },"))
        & (F.count(F.lit(1)) == times("[", "]", "  {", "  }", "  },"))
    )
    return {r["file"] for r in outer.groupBy("file").agg(laid_out.alias("laid_out")).filter("laid_out").collect()}


def malformed_files(
    spark: SparkSession, paths: list[str], schema: T.StructType, array_files: bool = True
) -> set[str]:
    """Names of the files with a record that does not parse."""
    corrupt = "_malformed"
    records = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())]))
        .option("multiLine", array_files)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt)
        .json(paths)
    )
    # All columns are asked for: those left out would not be parsed.
    parsed = records.select(F.xxhash64(F.to_json(F.struct("*"))).alias("row"), corrupt, "_metadata.file_name")
    bad = parsed.groupBy("file_name").agg(F.max(F.col(corrupt).isNotNull()).alias("bad"), F.max("row").alias("row"))
    return {r["file_name"] for r in bad.filter("bad").select("file_name", "row").collect()}


def checked_pieces(spark: SparkSession, paths: list[str], schema: T.StructType) -> tuple[set[str], set[str]]:
    """Of files that ``indented_files`` named: those with a malformed record or cut off, and those with a piece that
    is not one record. Every piece is parsed by itself, so a file's check splits like its read.
    """
    corrupt = "_malformed"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}

    def parsed(text, kind: T.StructType):
        return F.from_json(text, T.StructType([*kind.fields, T.StructField(corrupt, T.StringType())]), options)

    body = _body(F.col("value"))
    record = parsed(F.concat(F.lit("{"), body, F.lit("}")), schema)
    # A parser stops at the end of a record: what stands behind it shows in the array around it.
    around = T.StructType().add("records", T.ArrayType(T.StringType())).add("end", T.IntegerType())
    whole = parsed(F.concat(F.lit('{"records":[{'), body, F.lit('}],"end":1}')), around)
    pieces = _pieces(spark, paths).select(
        SOURCE_FILE, _closed().alias("closed"), _opened().alias("opened"), _empty().alias("empty"),
        record.alias("record"), whole.alias("whole"),
    )
    broken = F.col(f"whole.{corrupt}").isNotNull() | F.col("whole.end").isNull()
    several = ~broken & (F.size("whole.records") != 1)
    wrong = ~F.col("opened") | broken | F.col(f"record.{corrupt}").isNotNull()
    files = pieces.groupBy(SOURCE_FILE).agg(
        (~F.max("closed") | F.max(~F.col("empty") & ~several & wrong)).alias("bad"),
        F.max(~F.col("empty") & several).alias("several"),
    )
    found = files.filter("bad or several").collect()
    several_in = {r[SOURCE_FILE] for r in found if r["several"]}
    return {r[SOURCE_FILE] for r in found} - several_in, several_in


def remove_batches(spark: SparkSession, root: str, names: list[str]) -> None:
    """Drop whole batches of a table; a file operation for each, no job."""
    jvm = spark.sparkContext._jvm
    for name in names:
        folder = jvm.org.apache.hadoop.fs.Path(f"{root}/{BATCH}={name}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def discover_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """File name, modification time and length of the files matching ``pattern``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select(
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            F.col("modificationTime").alias("modified_at"),
            F.col("length"),
        )
    )


def read_or_empty(
    spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet"
) -> DataFrame:
    """The table at ``path``, or an empty one of the same schema before its first write."""
    try:
        return spark.read.schema(schema).format(file_format).load(path)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_batches(spark: SparkSession, root: str, schema: T.StructType, file_format: str = "parquet") -> DataFrame:
    """All batches under ``root``. The batch name is the partition column and stays text."""
    with_batch = T.StructType(list(schema.fields) + [T.StructField(BATCH, T.StringType())])
    return read_or_empty(spark, root, with_batch, file_format)


def write_batch(records: DataFrame, root: str, batch: str, file_format: str = "parquet") -> None:
    """Write one batch, replacing an earlier delivery of the same name; an empty batch leaves no rows."""
    records.write.mode("overwrite").format(file_format).save(f"{root}/{BATCH}={batch}")


def append_batches(records: DataFrame, root: str, spread: bool = False) -> None:
    """Write all batches of ``records`` in one job. Batches written again are replaced, others stay.

    The rebalance gives each batch few, evenly sized files and splits a batch that is much larger than others. It moves
    every row; where the rows are ``spread`` evenly already and the batches few, they are written as they are.
    """
    (
        (records if spread else records.hint("rebalance", F.col(BATCH)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH)
        .parquet(root)
    )


def latest_batch(records: DataFrame, batch: str = SOURCE_FILE) -> DataFrame:
    """Records of the last batch by name. On a partition column this reads that one partition."""
    return records.filter(F.col(batch) == records.agg(F.max(batch)).scalar())


def unnest_pages(pages: DataFrame, records: str = "dados", page: str = "page") -> DataFrame:
    """Records of list pages in page order; a page without records gives none. There is no page cap."""
    others = [c for c in pages.columns if c not in (records, page)]
    return pages.select(*others, F.col(page), F.posexplode(records).alias("_position", "_record")).select(
        *others, "_record.*", F.struct(F.col(page).alias("page"), F.col("_position").alias("row")).alias(ORDINAL)
    )


# Page numbers are looked at in stretches of this length, so a run of any number of pages spreads.
STRETCH = 100_000


def page_gaps(pages: DataFrame, *by: str, page: str = "page", first: int = 1) -> DataFrame:
    """Page numbers that are missing among those landed, per run: ``by``, first_missing, last_missing, missing.

    Gaps lie between neighbouring numbers, or before the lowest if the run begins after ``first``. What follows the
    highest number cannot be seen. Neighbours are found within stretches of numbers, then between the stretches.
    """
    numbers = pages.select(*by, F.col(page).cast("long").alias("_at")).filter(F.col("_at") >= first).distinct()
    stretched = numbers.withColumn("_stretch", F.floor(F.col("_at") / STRETCH))
    inside = Window.partitionBy(*by, "_stretch").orderBy("_at")
    within = stretched.select(*by, F.col("_at").alias("_before"), F.lead("_at").over(inside).alias("_after"))
    ends = stretched.groupBy(*by, "_stretch").agg(F.min("_at").alias("_low"), F.max("_at").alias("_high"))
    along = Window.partitionBy(*by).orderBy("_stretch")
    between = ends.select(*by, F.lag("_high", 1, first - 1).over(along).alias("_before"), F.col("_low").alias("_after"))
    gaps = within.unionByName(between).filter("_after > _before + 1")
    return gaps.select(
        *by,
        (F.col("_before") + 1).alias("first_missing"),
        (F.col("_after") - 1).alias("last_missing"),
        (F.col("_after") - F.col("_before") - 1).alias("missing"),
    )


def of_batches(records: DataFrame, names: DataFrame, batch: str = BATCH) -> DataFrame:
    """Records of the batches that a table lists, one column. Where the list is small enough to be sent, only their
    partitions are read: the scan prunes when it runs, and neither the driver nor the plan holds a name."""
    listed = names.select(F.col(names.columns[0]).alias(batch)).filter(F.col(batch) > "")
    return records.join(F.broadcast(listed) if fits_broadcast(listed) else listed, batch, "left_semi")


def preview(records: DataFrame, rows: int = 3) -> DataFrame:
    """Dry run: a few transformed rows. Nothing is loaded and no ledger is touched."""
    return records.limit(rows)


def spread_input(rows: DataFrame) -> DataFrame:
    """For costly work per row: a scan of fewer splits than there are cores is dealt out over all of them.

    A table of any size that the scan splits as finely is left as it is.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


# Rows of a task that makes wide records from narrow ones.
WIDE_ROWS = 50_000


def deal_rows(rows: DataFrame, task_rows: int | None = None) -> DataFrame:
    """Narrow rows of Parquet files dealt out evenly, at most about ``task_rows`` to a task, before they are made into
    wide records.

    A scan does not do it: a row group of few columns is one task, and each of its rows may become a record of a
    kilobyte or more, all of which a sort then holds at once. The number of tasks follows the rows. Each row goes by its
    place in its file, from a start of the file's own, as it is read; ``repartition`` by number alone would first sort
    all rows of a split, that is, of a row group of any length.
    """
    tasks = -(-rows.count() // (task_rows or WIDE_ROWS))
    if tasks <= 1:
        return rows
    task = F.pmod(F.col("_metadata.row_index") + F.hash("_metadata.file_path"), F.lit(tasks)).cast("int")
    return rows.withColumn("_task", task).repartitionById(tasks, "_task").drop("_task")
