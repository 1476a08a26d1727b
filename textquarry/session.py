"""Session building and cutting of lineage."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "textquarry", cores: int | None = None, **settings: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    n = cores or os.cpu_count() or 4
    builder = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Texts are long: keep Arrow batches at a few megabytes.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
        # Checkpoints no plan refers to any more may go.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


TABLE = "table-"  # folders of written tables

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on the executors, once per application.

    Not needed where it is installed there or given by ``--py-files``.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    target = str(Path(tempfile.mkdtemp(prefix="textquarry-")) / "textquarry_package")
    sc.addPyFile(shutil.make_archive(target, "zip", package.parent, package.name))
    _shipped.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Where the setting is missing a local session gets a scratch folder of its
    own; on a cluster a machine-local folder would lose data with its machine,
    so there the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    scratch = tempfile.mkdtemp(prefix="textquarry-")
    spark.conf.set("spark.checkpoint.dir", scratch)
    return scratch


def shuffles_go(spark: SparkSession):
    """While it holds, the shuffle files of a query are removed as soon as the query has ended."""
    return settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings of the session that hold for a while; dots are spelled as double underscores."""
    named = {key.replace("__", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in named}
    try:
        for key, value in named.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


# Options of tables that are kept for long: sorted words and places take a byte or two each.
COMPACT = {"compression": "zstd", "parquet.writer.version": "v2"}
# Texts, and token ids, that lie beside other tables of the same run.
PACKED = {"compression": "zstd"}


def write_table(df: DataFrame, by: str | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Write wide rows to the shared folder as a table and go on from there.

    Unlike a checkpoint a table is read column by column, so whatever comes
    after pays for the columns it uses and not for the texts beside them.
    Once it is written nothing needs the shuffles that led to it, so Spark is
    told to remove their files then and not when the driver collects garbage.
    Rows can be written ``by`` a column of few values, in a folder for each.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{TABLE}{uuid.uuid4()}"
    writer = df.write.options(**(options or {}))
    held = {"spark__sql__classic__shuffleDependency__fileCleanup__enabled": "true"}
    if by is not None:
        # The few files are written side by side, without sorting the rows first.
        writer, held["spark__sql__maxConcurrentOutputFileWriters"] = writer.partitionBy(by), "8"
    with settings(spark, **held):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame, part: str = "") -> None:
    """Removes a table of ``write_table``, or one that reads such tables alone, when others have replaced it; or a folder of it."""
    spark = table.sparkSession
    folders = set()
    for name in table.inputFiles():
        steps = name.split("/")
        found = [i for i, step in enumerate(steps[:-1]) if step.startswith(TABLE)]
        if found:
            folders.add("/".join([*steps[: found[-1] + 1], *([part] if part else [])]))
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write narrow rows to the shared folder once and go on from there; the shuffles that led to them go."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    with shuffles_go(spark):
        # What becomes of the shuffles is settled when a frame is made.
        return df.select("*").checkpoint(eager=True)
