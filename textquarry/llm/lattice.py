"""Near-duplicate vectors by lattice hashing.

Random projections of a unit vector are decoded, eight dimensions at a time, to the nearest
point of the E8 lattice; the points of ``BLOCKS`` such blocks are a cell.  Each of ``TABLES``
independent tables holds a vector in its own cell and in the ``PROBES`` neighbouring cells that
lie closest to it.  Two vectors meet where the own cell of one holds the other.  All that meet
are verified by their cosine, block by block, so a cell of any size is split over many tasks.
A pair that meets in several cells counts in the first only, which the lists of cells that
vectors carry tell, so pairs are never written out to remove repetitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_table
from .bytewords import mix
from .graph import components

TABLES = 6
BLOCKS = 2
PROBES = 4
SCALE = 0.6
SIDE = 512  # vectors on either side of a block of comparisons
COSINE = 0.98


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of the E8 lattice."""
    rows = []
    for i, j in combinations(range(8), 2):
        for a, b in product((-1.0, 1.0), repeat=2):
            rows.append([a if k == i else b if k == j else 0.0 for k in range(8)])
    rows += [s for s in product((-0.5, 0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(rows)


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum: rounded, the worst coordinate the other way if need be."""
    rounded = np.rint(x)
    error = x - rounded
    worst = np.abs(error).argmax(axis=-1)[..., None]
    step = np.where(np.take_along_axis(error, worst, -1) >= 0, 1.0, -1.0)
    step *= (rounded.sum(axis=-1) % 2 != 0)[..., None]
    np.put_along_axis(rounded, worst, np.take_along_axis(rounded, worst, -1) + step, -1)
    return rounded


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest point of E8 to each row of eight numbers."""
    whole, half = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(axis=-1) <= ((x - half) ** 2).sum(axis=-1)
    return np.where(closer[..., None], whole, half)


def cells(units: np.ndarray, group: np.ndarray, table: int, blocks: int, probes: int, scale: float) -> np.ndarray:
    """Hashes of each vector's own cell in a table and of the ``probes`` closest neighbours of it."""
    rng = np.random.default_rng([table, units.shape[1], blocks])
    directions = rng.normal(size=(units.shape[1], 8 * blocks))
    places = (units @ directions) * scale + rng.uniform(0, 2, size=8 * blocks)
    places = places.reshape(len(units), blocks, 8)
    points = decode(places)
    steps = minimal_vectors()
    # Of equally long steps that with the largest inner product leads closest.
    gain = ((places - points) @ steps.T).reshape(len(units), -1)
    best = np.argsort(-gain, axis=1, kind="stable")[:, :probes]
    out = []
    for k in range(-1, probes):
        moved = points.copy()
        if k >= 0:
            moved[np.arange(len(units)), best[:, k] // len(steps)] += steps[best[:, k] % len(steps)]
        key = mix(group.astype(np.uint64) ^ mix(np.full(len(units), table, dtype=np.uint64)))
        for column in np.rint(2 * moved).astype(np.int64).reshape(len(units), -1).T:
            key = mix(key ^ column.astype(np.uint64))
        out.append(key)
    return np.stack(out, axis=1).astype(np.int64)


def coded(vectors: DataFrame, tables: int, blocks: int, probes: int, scale: float) -> DataFrame:
    """``node, group, copies, unit, cells``: unit vectors as bytes; per table the own cell, then the neighbours."""

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["embedding"].map(len)
            for size in sizes.unique():
                own = batch[sizes == size]
                raw = np.stack(own["embedding"].to_numpy()).astype(np.float64)
                raw /= np.abs(raw).max(axis=1, keepdims=True)
                units = raw / np.linalg.norm(raw, axis=1, keepdims=True)
                group = own["group"].to_numpy()
                found = np.concatenate([cells(units, group, t, blocks, probes, scale) for t in range(tables)], axis=1)
                yield pd.DataFrame(
                    {"node": own["node"].values, "group": group, "copies": own["copies"].values, "unit": [u.tobytes() for u in units], "cells": list(found)}
                )

    schema = "node long, group long, copies long, unit binary, cells array<long>"
    return vectors.select("node", "group", "copies", "embedding").mapInPandas(code, schema)


# --------------------------------------------------------------------------
# comparison


def first_meetings(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The cell in which each pair of cell lists (pair, table, own and neighbours) counts.

    Of the first table in which the own cell of one holds the other, the smaller such cell.
    """
    most = np.iinfo(np.int64).max
    first = np.full(len(left), most)
    found = np.zeros(len(left), dtype=bool)
    for t in range(left.shape[1]):
        one = np.where((right[:, t] == left[:, t, :1]).any(axis=1), left[:, t, 0], most)
        two = np.where((left[:, t] == right[:, t, :1]).any(axis=1), right[:, t, 0], most)
        here = np.minimum(one, two)
        first = np.where(found, first, here)
        found |= here != most
    return first


def _local_roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest place that each place is connected with by the pairs."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(rows: pd.DataFrame, cell: int, tables: int, cosine: float) -> pd.DataFrame:
    """Links among the rows of one block of one cell: per vector its number of links and a vector it is connected with."""
    nodes, copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
    lists = np.stack(rows["cells"].to_numpy()).reshape(len(rows), tables, -1)
    own, group = rows["is_own"].to_numpy(), rows["group"].to_numpy()
    sizes = rows["unit"].map(len)
    if sizes.nunique() > 1:
        parts = [_compare(rows[sizes == s], cell, tables, cosine) for s in sizes.unique()]
        return pd.concat(parts)
    units = np.frombuffer(b"".join(rows["unit"]), dtype=np.float64).reshape(len(rows), -1)
    side = rows["side"].to_numpy()
    l, r = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if side.any() else (np.arange(len(rows)),) * 2
    a, b = np.nonzero(units[l] @ units[r].T >= cosine)
    a, b = l[a], r[b]
    kept = (group[a] == group[b]) & (own[a] | own[b]) & (nodes[a] != nodes[b])
    if not side.any():
        kept &= a < b
    a, b = a[kept], b[kept]
    here = np.concatenate([first_meetings(lists[a[k : k + 20_000]], lists[b[k : k + 20_000]]) == cell for k in range(0, len(a), 20_000)] or [np.empty(0, bool)])
    a, b = a[here], b[here]
    links = np.bincount(a, weights=copies[b], minlength=len(rows)) + np.bincount(b, weights=copies[a], minlength=len(rows))
    linked = np.flatnonzero(links)
    root = _local_roots(a, b, len(rows))
    return pd.DataFrame({"a": nodes[linked], "b": nodes[root[linked]], "links": links[linked].astype(np.int64)})


def _runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Sorted rows as one frame for each value of the keys, which batches may cut."""
    rest = None
    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        changes = (rows[keys] != rows[keys].shift()).any(axis=1).to_numpy()
        starts = np.flatnonzero(changes)
        for a, b in zip(starts, starts[1:]):
            yield rows.iloc[a:b]
        rest = rows.iloc[starts[-1] :].reset_index(drop=True) if len(starts) else None
    if rest is not None:
        yield rest


def found_links(codes: DataFrame, tables: int, cosine: float) -> DataFrame:
    """``a, b, links`` from all blocks of all cells: ``a`` is connected with ``b``; written."""
    entries = codes.select("node", F.posexplode("cells").alias("at", "cell"))
    entries = entries.select("node", "cell", (F.col("at") % (F.lit(1) + PROBES) == 0).alias("is_own"))
    held = entries.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("is_own").alias("owned"))
    busy = held.filter((F.col("n") > 1) & F.col("owned")).select("cell", F.ceil(F.col("n") / SIDE).cast("int").alias("parts"))
    members = entries.join(busy, "cell").withColumn("part", F.pmod(F.xxhash64("node", "cell"), F.col("parts")).cast("int"))
    # A part is compared with itself and, from either side, with each other part.
    blocks = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "node",
        "cell",
        "is_own",
        F.least("part", "other").alias("one"),
        F.greatest("part", "other").alias("two"),
        (F.col("part") > F.col("other")).cast("int").alias("side"),
    )
    rows = blocks.join(codes, "node").repartition("cell", "one", "two").sortWithinPartitions("cell", "one", "two")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for run in _runs(batches, ["cell", "one", "two"]):
            # Two parts of one side each have nothing to compare if one is empty.
            if len(run) > 1 and (run["one"].iat[0] == run["two"].iat[0] or run["side"].nunique() > 1):
                held.append(_compare(run, run["cell"].iat[0], tables, cosine))
                size += len(held[-1])
            if size > 50_000:
                yield pd.concat(held)
                held, size = [], 0
        if held:
            yield pd.concat(held)

    return write_table(rows.mapInPandas(compare, "a long, b long, links long"))


def near_vectors(
    vectors: DataFrame,
    cosine: float = COSINE,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    tables: int = TABLES,
    blocks: int = BLOCKS,
    scale: float = SCALE,
) -> DataFrame:
    """``key, n_links, component_id, kept`` of every vector.

    Vectors of one label and length link when their cosine, in double precision, is at least
    ``cosine``.  Null labels and vectors, zero vectors and such with null or non-finite components
    link with nothing.  Equal vectors are compared once and count as often as they occur; of rows
    that repeat a key each is a vector of its own.  A component of rows without a key has none;
    other columns are ignored; an empty table gives no rows.
    """
    numbers = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), numbers.alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("node", F.when(usable, F.xxhash64("label", "embedding")))
    distinct = rows.filter(F.col("node").isNotNull()).withColumn("group", F.xxhash64("label", F.size("embedding")))
    # Copies are combined before the shuffle.
    distinct = distinct.groupBy("node", "group", "embedding").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    distinct = write_table(distinct)
    codes = write_table(coded(distinct, tables, blocks, PROBES, scale))
    found = found_links(codes, tables, cosine)
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    label_of = write_table(components(found.select("a", "b")))
    known = distinct.select("node", "copies", "least").join(links, "node", "left").join(label_of, "node", "left")
    known = known.withColumn("label", F.coalesce("label", "node")).withColumn("n", F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
    least = known.groupBy("label").agg(F.min("least").alias("component_id"))
    reached = write_table(known.join(least, "label").select("node", "n", "component_id"))
    out = rows.select("vec_id", "node").join(reached, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("vec_id").alias(key),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
