"""Reading raw records from JSONL, JSON, plain text and Parquet files.

Every reader yields ``text`` and the columns of the place it was read from;
``numbered`` turns the latter into ``seq``, the order of the records.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce
from pathlib import PurePosixPath

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.mixture import MAX_BROADCAST_ROWS, head
from ..session import PACKED, write_table

log = logging.getLogger(__name__)

PLACE = ("file", "block", "line")
SUFFIXES = (".jsonl", ".json", ".txt", ".text", ".parquet")


def record_text(record: Column) -> Column:
    """Text of one parsed JSON value: its ``text`` field, or itself if a string."""
    return F.when(
        F.schema_of_variant(record) == "STRING", F.try_variant_get(record, "$", "string")
    ).otherwise(F.try_variant_get(record, "$.text", "string"))


def is_record(record: Column) -> Column:
    """Whether a parsed JSON value is a string or an object with a ``text`` field."""
    return (F.schema_of_variant(record) == "STRING") | F.try_variant_get(record, "$.text", "variant").isNotNull()


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Adds ``text`` and ``malformed``; JSON values of other kinds are skipped.

    A malformed line is flagged and the rest of its file still read.
    """
    parsed = lines.filter(F.length(F.trim(column)) > 0).withColumn("_json", F.try_parse_json(column))
    return (
        parsed.filter(F.col("_json").isNull() | is_record(F.col("_json")))
        .withColumn("malformed", F.col("_json").isNull())
        .withColumn("text", record_text(F.col("_json")))
        .drop("_json")
    )


def _placed(df: DataFrame) -> DataFrame:
    return df.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def read_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Raw lines and their places."""
    return _placed(spark.read.text(list(paths)))


def read_jsonl(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    lines = parse_lines(read_lines(spark, paths))
    return lines.filter(~F.col("malformed")).select("text", *PLACE)


def malformed_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The lines ``read_jsonl`` leaves out because they are no JSON."""
    return parse_lines(read_lines(spark, paths)).filter("malformed").select("value", *PLACE)


def read_json(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Files holding one array of records or a single object."""
    whole = _placed(spark.read.text(list(paths), wholetext=True)).withColumn("_json", F.try_parse_json("value"))
    items = F.try_variant_get("_json", "$", "array<variant>")
    single = F.when(F.try_variant_get("_json", "$.text", "variant").isNotNull(), F.array("_json"))
    exploded = whole.select("file", "block", F.posexplode(F.coalesce(items, single)).alias("line", "_item"))
    return exploded.filter(is_record(F.col("_item"))).select(
        record_text(F.col("_item")).alias("text"), "file", "block", F.col("line").cast("long").alias("line")
    )


def read_txt(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Each file is one document."""
    return _placed(spark.read.text(list(paths), wholetext=True)).withColumnRenamed("value", "text")


def read_parquet(spark: SparkSession, paths: Sequence[str], text: str = "text") -> DataFrame:
    table = spark.read.parquet(*paths)
    return _placed(table.select(F.col(text).alias("value"), "_metadata")).withColumnRenamed("value", "text")


READERS = {
    ".jsonl": read_jsonl,
    ".json": read_json,
    ".txt": read_txt,
    ".text": read_txt,
    ".parquet": read_parquet,
}


def resolve(spark: SparkSession, urls: Sequence[str] = (), local_files: Sequence[str] = ()) -> list[str]:
    """Source paths, remote ones first; missing ones are logged and skipped.

    Remote sources are whatever file systems Spark has a connector for.
    """
    found = []
    for path in [*urls, *local_files]:
        try:
            spark.read.format("binaryFile").load(path).limit(0).collect()
            found.append(path)
        except AnalysisException:
            log.error("source not found: %s", path)
    if not found:
        raise FileNotFoundError("no data files to process")
    return found


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Path, size and time of what a folder has by names that match.

    A table that was written as a folder counts as one file, with the size of
    all its files and the time of the last.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found = system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(place, pattern))
    if not found:
        return spark.createDataFrame([], "path string, length long, modificationTime timestamp")
    # Contents are not read, nor are they looked for among the partitions of a table.
    leaves = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([f.getPath().toString() for f in found])
    top = system.makeQualified(place).toString().rstrip("/") + "/"
    name = F.substring_index(F.substring("path", len(top) + 1, 1 << 20), "/", 1)
    listing = leaves.groupBy(F.concat(F.lit(top), name).alias("path"))
    return listing.agg(F.sum("length").alias("length"), F.max("modificationTime").alias("modificationTime"))


def load_texts(spark: SparkSession, paths: Sequence[str], sample_size: int | None = None) -> DataFrame:
    """All records of all files as ``seq``, ``text``, in order of the paths given.

    Files of other kinds are logged and skipped, as are unreadable ones.
    """
    frames = []
    for at, path in enumerate(paths):
        suffix = PurePosixPath(path).suffix.lower()
        reader = READERS.get(suffix)
        if reader is None:
            log.warning("unsupported file format: %s", suffix)
            continue
        try:
            frames.append(reader(spark, [path]).withColumn("source_no", F.lit(at)))
        except AnalysisException as problem:
            log.error("cannot read %s: %s", path, problem)
    if not frames:
        raise ValueError("no texts loaded from files")
    rows = numbered(reduce(DataFrame.unionByName, frames))
    return rows.filter(F.col("seq") < sample_size).orderBy("seq") if sample_size else rows


def numbered(records: DataFrame, text: str = "text") -> DataFrame:
    """``seq`` from the place of a record: source, file, block, line.

    The records are written once, with a running number of their task.  A file
    block is read by one task from start to end, so a record's number is its
    place in its block plus the records of all blocks before, a table of one
    row per block; no text is shuffled and nothing depends on the splits of a
    second reading.
    """
    block = [c for c in ("source_no", "file", "block") if c in records.columns]
    placed = write_table(records.select(*block, text, F.monotonically_increasing_id().alias("_id")), options=PACKED)
    sizes = placed.groupBy(*block).agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = Window.partitionBy(F.lit(1)).orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    starts = write_table(sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))))
    if starts.count() <= MAX_BROADCAST_ROWS:
        starts = F.broadcast(starts)
    rows = placed.join(starts, block)
    return rows.select((F.col("_before") + F.col("_id") - F.col("_first")).alias("seq"), text, "file")


def head_sample(df: DataFrame, size: int | None, seq: str = "seq") -> DataFrame:
    """The first ``size`` records; all of them for 0 or None."""
    return head(df, size, seq) if size else df


def nonempty(df: DataFrame) -> DataFrame:
    """Records with a text to work on."""
    return df.filter(F.col("text") != "")
