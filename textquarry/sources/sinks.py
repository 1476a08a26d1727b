"""Writing records, shards, mixtures and reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import mixture
from ..session import shuffles_go, write_table


def export_jsonl(df: DataFrame, path: str, compression: str = "none") -> None:
    """One JSON object per row, in as many files as the frame has partitions."""
    with shuffles_go(df.sparkSession):
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(path, compression=compression)


def export_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def export_shards(df: DataFrame, path: str, shard_size: int = 10_000, seq: str = "seq") -> None:
    """Folders ``shard=00000`` onwards with ``shard_size`` consecutive rows each.

    The numbered rows lie in order, so each task writes its own run of shards;
    a shard on the border of two tasks has a file from each.
    """
    _write_shards(mixture.with_shard(df, shard_size, seq), path, seq)


def _write_shards(sharded: DataFrame, path: str, seq: str, compression: str = "none") -> None:
    named = sharded.withColumn("shard", F.lpad(F.col("shard").cast("string"), 5, "0"))
    (
        named.sortWithinPartitions("shard", seq)
        .write.mode("overwrite")
        .partitionBy("shard")
        .json(path, compression=compression)
    )


def export_tokenized(
    df: DataFrame, path: str, shard_size: int = 10_000, seq: str = "seq", compression: str = "none"
) -> bool:
    """All rows as JSON lines, and as shards as well if one would not hold them.

    Rows with their places, as ``mixture.in_order`` writes them, go to their
    shards from where they lie; others are exchanged and written once more.
    """
    rows = df.drop(mixture.PLACE)
    export_jsonl(rows, f"{path}/tokenized_data", compression)
    several = rows.limit(shard_size + 1).count() > shard_size
    if several:
        _write_shards(mixture.with_shard(df, shard_size, seq), f"{path}/shards", seq, compression)
    return several


def export_mixture(
    df: DataFrame, path: str, weights: Mapping[str, float] | None = None, seed: int = 0, key: str = "seq"
) -> None:
    """The mixture as JSON lines and its metadata as one JSON object."""
    source = write_table(df)
    export_jsonl(mixture.mix(source, weights, seed, key), f"{path}/mixture")
    export_object(mixture.mixture_metadata(source, weights), f"{path}/mixture_metadata")


def export_object(one_row: DataFrame, path: str) -> None:
    """A frame of a single row as a single JSON object."""
    one_row.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
