"""Bloom filters of tables of 64-bit keys, sized by the tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytewords as B

FILTER_BITS = (1 << 20, 1 << 27)  # least and most


def bloom(keys: DataFrame) -> np.ndarray:
    """A Bloom filter of a table of 64-bit ``key``, as 64-bit words.

    About 16 bits a key, 16 megabytes at most; built in Spark, so that only the filter itself
    reaches the driver.
    """
    bits, count = FILTER_BITS[0], keys.count()
    while bits < min(16 * count, FILTER_BITS[1]):
        bits *= 2

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = _places(batch["key"].to_numpy().astype(np.uint64), bits)
            yield pd.DataFrame({"place": np.concatenate(found).astype(np.int64)})

    words = (
        keys.mapInPandas(places, "place long")
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
    )
    filled = np.zeros(bits >> 6, dtype=np.uint64)
    for batch in words.toArrow().to_batches():
        filled[batch.column(0).to_numpy()] = batch.column(1).to_numpy().astype(np.uint64)
    return filled


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mixed = B.mix(hashes)
    return mixed & np.uint64(bits - 1), (mixed >> np.uint64(32)) & np.uint64(bits - 1)


def in_bloom(filled: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    there = np.ones(len(hashes), dtype=bool)
    for place in _places(hashes, len(filled) << 6):
        there &= (filled[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
    return there
