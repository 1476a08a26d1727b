"""Row numbering, shards and weighted mixtures of datasets."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import PACKED, cut_lineage, write_table

# Sampling looks at the leading 16 bits of the hash first.
BUCKET_DIGITS = 4
ROW_BITS = 33  # rows within a partition in monotonically_increasing_id()
MAX_BROADCAST_ROWS = 100_000
PLACE = "_id"  # of a row that was written in order: its partition and its number there


def in_order(df: DataFrame, order: str = "seq", work=None) -> DataFrame:
    """The rows in order, written once, each with its ``PLACE``; one range exchange of whole rows.

    ``work`` is done on the rows after the exchange, so that what it adds isn't exchanged.
    """
    rows = df.orderBy(order).withColumn(PLACE, F.monotonically_increasing_id())
    return write_table(rows if work is None else work(rows), options=PACKED)


def _places(df: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """The rows in order, written once, with their place in their partition; and the rows before each partition.

    One range exchange of whole rows, unless they have their places already.
    The second frame has a row per partition, and only the numbers of rows are
    read for it.
    """
    numbered = df if PLACE in df.columns else in_order(df, order)
    placed = numbered.withColumns(
        {"_part": F.shiftright(PLACE, ROW_BITS), "_row": F.col(PLACE).bitwiseAND((1 << ROW_BITS) - 1)}
    ).drop(PLACE)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return placed, cut_lineage(offsets)


def with_index(df: DataFrame, seq: str = "seq") -> DataFrame:
    """Adds ``index``: the position of the row in the order of ``seq``, from 0.

    Whole rows are exchanged once, by range; a row's index is its place in its
    partition plus the rows of all partitions before, a table of one row per
    partition, which is broadcast.
    """
    placed, offsets = _places(df, seq)
    joined = placed.join(F.broadcast(offsets.select("_part", "_before")), "_part")
    return joined.select(*[c for c in df.columns if c != PLACE], (F.col("_before") + F.col("_row")).alias("index"))


def head(df: DataFrame, size: int, seq: str = "seq") -> DataFrame:
    """The first ``size`` rows in the order of ``seq``, a unique number.

    Only ``seq`` is sorted, in ranges.  Ranges that end before the cut are
    whole; in the one on the border the last row wanted is found by its place.
    Its ``seq`` then cuts the rows where they are.
    """
    placed, offsets = _places(df.select(seq), seq)
    border = offsets.filter((F.col("_before") < size) & (F.col("_before") + F.col("_n") >= size)).first()
    if border is None:
        return df
    last = placed.filter((F.col("_part") == border["_part"]) & (F.col("_row") == size - 1 - border["_before"])).first()
    return df.filter(F.col(seq) <= F.lit(last[seq]))


def with_shard(df: DataFrame, shard_size: int = 10_000, seq: str = "seq") -> DataFrame:
    """Adds ``shard``: contiguous runs of ``shard_size`` rows in order."""
    indexed = with_index(df, seq)
    return indexed.withColumn("shard", F.floor(F.col("index") / shard_size).cast("int")).drop("index")


def labelled(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """One frame of all datasets, each row labelled with its ``dataset``."""
    frames = [df.withColumn("dataset", F.lit(name)) for name, df in datasets.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def sample_sizes(
    df: DataFrame, weights: Mapping[str, float] | None = None, mode: str = "own", total: int | None = None
) -> DataFrame:
    """``dataset``, ``weight``, ``available``, ``samples``.

    Weights are divided by the sum over the mapping given, 1.0 each by
    default; a dataset it lacks has weight 0.  With mode ``own`` each dataset
    contributes that fraction of its own size, rounded down.  With
    ``proportional`` it contributes that fraction of ``total``, or of all
    rows, by largest remainders (ties to the first name), so that the samples
    add up to the total; none gives more than it has.
    """
    if mode not in ("own", "proportional"):
        raise ValueError(f"unknown mode of sample sizes: {mode}")
    sizes = df.groupBy("dataset").agg(F.count(F.lit(1)).alias("available"))
    # One row per dataset is all these windows ever see.
    everything = Window.partitionBy(F.lit(1))
    if weights is None:
        weight = 1.0 / F.count(F.lit(1)).over(everything)
    else:
        whole = float(sum(weights.values()))
        table = F.create_map(*[F.lit(x) for name, w in weights.items() for x in (name, w / whole)])
        weight = F.coalesce(F.try_element_at(table, F.col("dataset")), F.lit(0.0))
    sized = sizes.withColumn("weight", weight)
    if mode == "own":
        wanted = F.floor(F.col("available") * F.col("weight")).cast("long")
        return sized.withColumn("samples", F.least("available", wanted))
    rows = F.sum("available").over(everything) if total is None else F.lit(total)
    shared = sized.withColumn("_share", rows * F.col("weight")).withColumn("_whole", F.floor("_share").cast("long"))
    left = F.round(F.sum("_share").over(everything)).cast("long") - F.sum("_whole").over(everything)
    place = F.row_number().over(everything.orderBy((F.col("_whole") - F.col("_share")), "dataset"))
    given = shared.withColumns({"_left": left, "_place": place})
    samples = F.col("_whole") + F.when(F.col("_place") <= F.col("_left"), 1).otherwise(0)
    return given.select("dataset", "available", "weight", F.least("available", samples.cast("long")).alias("samples"))


def _draw(seed: int, *parts: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def sample(
    df: DataFrame,
    weights: Mapping[str, float] | None = None,
    seed: int = 0,
    key: str = "seq",
    mode: str = "own",
    total: int | None = None,
) -> DataFrame:
    """Uniform sample without replacement, exactly ``samples`` rows per dataset.

    A row's draw is a hash of seed, dataset and key; the smallest win.  Rows
    are first counted by the leading digits of their draw, which settles all
    but one such group per dataset; only that group is ranked, so no dataset
    is ever sorted by one task.
    """
    drawn = df.withColumn("_draw", _draw(seed, F.col("dataset"), F.col(key))).withColumn(
        "_bucket", F.substring("_draw", 1, BUCKET_DIGITS)
    )
    by_bucket = drawn.groupBy("dataset", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    sizes = sample_sizes(df, weights, mode, total).select("dataset", "samples")
    w = Window.partitionBy("dataset").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    cuts = cut_lineage(
        by_bucket.join(sizes, "dataset")
        .withColumn("_upto", F.sum("_n").over(w))
        .filter((F.col("_upto") >= F.col("samples")) & (F.col("_upto") - F.col("_n") < F.col("samples")))
        .select(
            "dataset",
            F.col("_bucket").alias("_cut"),
            (F.col("samples") - F.col("_upto") + F.col("_n")).alias("_need"),
        )
    )
    if cuts.count() <= MAX_BROADCAST_ROWS:
        cuts = F.broadcast(cuts)
    split = drawn.join(cuts, "dataset")
    whole = split.filter(F.col("_bucket") < F.col("_cut"))
    place = F.row_number().over(Window.partitionBy("dataset").orderBy("_draw", key))
    partial = (
        split.filter(F.col("_bucket") == F.col("_cut"))
        .withColumn("_place", place)
        .filter(F.col("_place") <= F.col("_need"))
        .drop("_place")
    )
    return whole.unionByName(partial).drop("_draw", "_bucket", "_cut", "_need")


def mix(df: DataFrame, weights: Mapping[str, float] | None = None, seed: int = 0, key: str = "seq") -> DataFrame:
    """The sample in a random but repeatable order."""
    chosen = sample(df, weights, seed, key)
    return chosen.orderBy(_draw(seed + 1, F.col("dataset"), F.col(key)), key)


def mixture_metadata(df: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """One row: names, weights, samples per dataset, all samples."""
    sizes = sample_sizes(df, weights)
    return sizes.agg(
        F.sort_array(F.collect_list("dataset")).alias("datasets"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("dataset", "weight")))).alias("mixture_weights"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("dataset", "samples")))).alias("samples_per_dataset"),
        F.sum("samples").alias("total_samples"),
    )
