"""Small helpers on whole DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add or replace columns whose expressions must not be evaluated twice.

    The optimizer may copy an expression into every filter and projection
    above it; for a chain of regular expressions over long texts that costs
    more than all else.  It never copies the input of a generator, so the
    values are taken from a one-element array.
    """
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))
