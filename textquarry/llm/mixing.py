"""Mixing sources to target weights by Sainte-Laguë apportionment of equal blocks.

The words of a source form a stream: its documents in a seeded order, one after another.  The
stream is cut into blocks of equal length.  All sources compete for the blocks of the mix: the
next one always goes to the source of the highest quotient ``v / (2 a + 1)``, where ``v`` is its
target in blocks and ``a`` what it has got so far, as long as that quotient is at least 1/2.  By
then a source has ``floor(v + 1/2)`` blocks, so its quota needs no turns to be taken.  Its stream
is divided into shards of ``SHARD_BLOCKS`` blocks, whose votes are their blocks: up to the end of
each shard the source has ``floor(q e / n + 1/2)`` of its ``q`` blocks, for ``e`` of its ``n``
blocks, which makes an integer quota for each shard.  Within a shard the quota is spent on whole
passes over its blocks first, the rest on blocks picked by a seeded permutation.

A target is a share by weight of what the mix shall hold, but at most ``limit`` times what the
source has; what is above goes to the others by weight, until none is above.

Defined results: a text that is null or has no word has size 0, and nothing is taken of it.  A
null source is one of its own, the last.  Rows with equal ids and sizes in one source share what
is taken of them in any order; rows without an id are taken like others.  An empty table gives an
empty one, and without any word all targets are 0.  Columns but the three named aren't looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.mixture import with_index
from ..session import cut_lineage, write_table

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 256
LEAST_BLOCKS = 1024  # of a source with so many words: small ones are cut finer, to come near their targets
SHARD_BLOCKS = 4096
PART_WORDS = 1 << 19  # words of a part of a stream, about; parts are sorted one by one
BROADCAST_SOURCES = 100_000
SALTS = 32
_PLAN = "taken long, firsts array<long>, words array<long>, copies array<int>, blocks array<long>"


def n_words(text: Column) -> Column:
    """How many words a text has; 0 if it is null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def block_count(size: int, block_words: int | None = None, least: int | None = None) -> int:
    """How many blocks a source of ``size`` words is cut into."""
    return min(size, max(least or LEAST_BLOCKS, -(-size // (block_words or BLOCK_WORDS))))


# --------------------------------------------------------------------------
# sources


def weighed_sources(sized: DataFrame, weights: Sequence[float] | Mapping[str, float]) -> DataFrame:
    """``source, sid, source_size, weight``: a row for each source, numbered by code point, null last.

    ``weights`` belong to the sources by name, or in their order, and are repeated.
    """
    totals = cut_lineage(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    named = with_index(totals.filter(F.col("source").isNotNull()), "source").withColumnRenamed("index", "sid")
    unnamed = totals.filter(F.col("source").isNull()).withColumn("sid", F.lit(named.count()).cast("long"))
    sources = named.select("source", "sid", "source_size").unionByName(unnamed.select("source", "sid", "source_size"))
    if isinstance(weights, Mapping):
        items = [x for name, weight in weights.items() for x in (F.lit(name), F.lit(float(weight)))]
        weight = F.coalesce(F.try_element_at(F.create_map(*items), F.col("source")), F.lit(0.0)) if items else F.lit(0.0)
    else:
        weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    return cut_lineage(sources.withColumn("weight", weight))


def with_targets(sources: DataFrame, ratio: float, limit: float) -> DataFrame:
    """Adds ``target``, in words.

    ``level`` is what a unit of weight gets.  Sources above their limit leave the sharing, which
    raises the level for the others, until no further one is above.  Each turn sums over one row
    per source.
    """
    most = F.col("source_size") * F.lit(float(limit))
    level, full = 0.0, -1
    while True:
        above = most <= F.col("weight") * F.lit(level)
        sums = sources.agg(
            F.count_if(above).alias("full"),
            F.sum("source_size").alias("all"),
            F.sum(F.when(above, most)).alias("held"),
            F.sum(F.when(~above, F.col("weight"))).alias("weight"),
        ).first()
        if sums["full"] == full or not sums["weight"]:
            return sources.withColumn("target", F.least(most, F.col("weight") * F.lit(level)))
        full = sums["full"]
        level = (ratio * sums["all"] - (sums["held"] or 0.0)) / sums["weight"]


def with_quotas(sources: DataFrame) -> DataFrame:
    """Adds ``n_blocks`` and ``quota``, the blocks that a source gets by highest quotients."""
    size = F.col("source_size")
    cut = F.greatest(F.lit(LEAST_BLOCKS), F.ceil(size / BLOCK_WORDS)).cast("long")
    blocks = F.least(size, cut).alias("n_blocks")
    votes = F.col("target") * F.col("n_blocks") / size
    quota = F.when(size > 0, F.floor(votes + 0.5)).otherwise(0).cast("long")
    return sources.select("*", blocks).withColumn("quota", quota)


def _join_sources(docs: DataFrame, sources: DataFrame, count: int) -> DataFrame:
    """Each document with the row of its source.

    Sources are counted: up to ``BROADCAST_SOURCES`` rows are broadcast; more are repeated for
    each salt, so that no source's documents meet in one task.
    """
    docs = docs.withColumn("_named", F.col("source").isNotNull()).withColumn("_name", F.coalesce("source", F.lit("")))
    keyed = sources.select(
        F.col("source").isNotNull().alias("_named"),
        F.coalesce("source", F.lit("")).alias("_name"),
        *[c for c in sources.columns if c != "source"],
    )
    if count <= BROADCAST_SOURCES:
        return docs.join(F.broadcast(keyed), ["_named", "_name"]).drop("_named", "_name")
    salted = docs.withColumn("_salt", F.pmod("draw", F.lit(SALTS)).cast("int"))
    repeated = keyed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated, ["_named", "_name", "_salt"]).drop("_named", "_name", "_salt")


# --------------------------------------------------------------------------
# streams, blocks and shards


def _placed(docs: DataFrame) -> DataFrame:
    """Adds ``start``: the words before the document in the stream of its source.

    The stream goes part by part, each in the order of the draws.  Only sums of parts are added
    up over a whole source.
    """
    parts = F.greatest(F.ceil(F.col("source_size") / PART_WORDS), F.lit(1))
    docs = docs.withColumn("part", F.pmod("draw", parts.cast("long")))
    sums = docs.groupBy("sid", "part").agg(F.sum("size").alias("part_size"))
    before = Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("sid", "part", F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("sid", "part").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = docs.withColumn("_before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    return placed.join(offsets, ["sid", "part"]).withColumn("start", F.col("_offset") + F.col("_before"))


def shard_copies(seed: int, sid: int, shard: int, n_blocks: int, quota: int) -> np.ndarray:
    """How often each block of a shard is taken."""
    first, end = shard * SHARD_BLOCKS, min(n_blocks, (shard + 1) * SHARD_BLOCKS)
    upto = [(2 * quota * x + n_blocks) // (2 * n_blocks) for x in (first, end)]
    passes, rest = divmod(upto[1] - upto[0], end - first)
    copies = np.full(end - first, passes, dtype=np.int64)
    copies[np.random.default_rng([seed, sid, shard]).permutation(end - first)[:rest]] += 1
    return copies


def _blocks_of(words: np.ndarray, size: np.ndarray, n_blocks: np.ndarray) -> np.ndarray:
    """The blocks in which words of a stream lie; the first ``size % n_blocks`` are longer by one."""
    base, longer = size // n_blocks, size % n_blocks
    head = longer * (base + 1)
    return np.where(words < head, words // (base + 1), longer + (words - head) // base)


def _block_starts(blocks: np.ndarray, size: np.ndarray, n_blocks: np.ndarray) -> np.ndarray:
    return blocks * (size // n_blocks) + np.minimum(blocks, size % n_blocks)


def _taken(batches: Iterator[tuple[pd.Series, ...]], seed: int) -> Iterator[pd.DataFrame]:
    shards: dict[tuple[int, ...], np.ndarray] = {}

    def copies_of(sid: int, shard: int, n_blocks: int, quota: int) -> np.ndarray:
        key = (sid, shard)
        if key not in shards:
            if len(shards) >= 64:
                shards.clear()
            shards[key] = shard_copies(seed, sid, shard, n_blocks, quota)
        return shards[key]

    for batch in batches:
        start, size, sid, total, n_blocks, quota = (x.to_numpy(dtype=np.int64) for x in batch)
        rows = np.flatnonzero(size > 0)
        start, end = start[rows], start[rows] + size[rows]
        sid, total, n_blocks, quota = sid[rows], total[rows], n_blocks[rows], quota[rows]
        first = _blocks_of(start, total, n_blocks)
        count = _blocks_of(end - 1, total, n_blocks) - first + 1
        row = np.repeat(np.arange(len(rows)), count)
        block = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]
        begins = np.maximum(_block_starts(block, total[row], n_blocks[row]), start[row])
        ends = np.minimum(_block_starts(block + 1, total[row], n_blocks[row]), end[row])
        copies = np.zeros(len(row), dtype=np.int64)
        shard = block // SHARD_BLOCKS
        edges = np.flatnonzero(np.diff(sid[row], prepend=-1) | np.diff(shard, prepend=-1))
        for a, b in zip(edges, [*edges[1:], len(row)]):
            d = row[a]
            held = copies_of(int(sid[d]), int(shard[a]), int(n_blocks[d]), int(quota[d]))
            copies[a:b] = held[block[a:b] - shard[a] * SHARD_BLOCKS]
        used = np.flatnonzero(copies)
        row, block, copies = row[used], block[used], copies[used]
        firsts, words = begins[used] - start[row], ends[used] - begins[used]
        out = {"taken": np.zeros(len(size), dtype=np.int64)}
        np.add.at(out["taken"], rows[row], words * copies)
        cuts = np.searchsorted(rows[row], np.arange(len(size) + 1)).tolist()
        for name, values in (("firsts", firsts), ("words", words), ("copies", copies), ("blocks", block)):
            values = values.tolist()
            out[name] = [values[a:b] for a, b in zip(cuts, cuts[1:])]
        yield pd.DataFrame(out)


def mix(
    docs: DataFrame,
    weights: Sequence[float] | Mapping[str, float] = (3.0, 1.0, 2.0),
    ratio: float = 1.5,
    limit: float = 2.0,
    seed: int = 11,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """What a mix of ``ratio`` times all words takes of each document, none above ``limit`` times.

    ``doc_id, source, size, source_size, target, taken`` and the runs taken: word places
    ``firsts`` in the document, lengths ``words``, ``copies``, and ``blocks`` of the source's
    stream.  A block's shard is its number divided by ``SHARD_BLOCKS``.
    """
    named = docs.select(F.col(key).alias("doc_id"), F.col(source).cast("string").alias("source"), n_words(F.col(text)).alias("size"))
    sized = write_table(named.withColumn("draw", F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), "size")))
    sources = cut_lineage(with_quotas(with_targets(weighed_sources(sized, weights), ratio, limit)))
    placed = _placed(_join_sources(sized, sources, sources.count()))

    @F.pandas_udf(_PLAN)
    def taken(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        yield from _taken(batches, seed)

    plan = taken("start", "size", "sid", "source_size", "n_blocks", "quota").alias("plan")
    return placed.select("doc_id", "source", "size", "source_size", "target", plan).select(
        "doc_id", "source", "size", "source_size", "target", "plan.*"
    )


def pieces(text: Column, firsts: Column, words: Column) -> Column:
    """The texts of the runs of a document that ``mix`` names, as they stand there."""

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series, firsts: pd.Series, words: pd.Series) -> pd.Series:
        import re

        word = re.compile(WORD)
        out = []
        for value, a, n in zip(texts, firsts, words):
            spans = [m.span() for m in word.finditer(value)] if value is not None and len(a) else []
            out.append([value[spans[i][0] : spans[i + k - 1][1]] for i, k in zip(a, n)])
        return pd.Series(out)

    return cut(text, firsts, words)
