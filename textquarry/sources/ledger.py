"""Which sources have been acquired already."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def target_name(url: Column) -> Column:
    """A source is stored under the last segment of its URL."""
    return F.element_at(F.split(url, "/"), -1)


def pending(sources: DataFrame, ledger: DataFrame) -> DataFrame:
    """Sources whose target name is not in the ledger's ``name`` column yet.

    Names are reduced to one row each first, so the join has at most one match
    per source whatever the ledger holds.
    """
    named = sources.withColumn("name", target_name(F.col("url")))
    return named.join(ledger.select("name").distinct(), "name", "left_anti")
