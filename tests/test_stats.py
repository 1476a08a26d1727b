import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textquarry.operators import stats


@pytest.mark.parametrize("values", [[random.Random(1).randrange(500) for _ in range(301)], list(range(100)), [7, 7, 7], [3, 9]])
def test_lengths_equal_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    counts = stats.value_counts(df, text=F.col("v"))
    got = stats.length_stats(counts).first()
    want = [len(values), min(values), max(values), np.mean(values), np.median(values), np.std(values)]
    want += [np.percentile(values, p) for p in (25, 75, 90, 95, 99)]
    assert np.allclose([float(x) for x in got[1:]], want)
    assert stats.upper_median(counts).first().upper_median == sorted(values)[len(values) // 2]
    bins = stats.histogram(counts).orderBy("bin").collect()
    n, edges = np.histogram(values, bins=50)
    assert [b.n for b in bins] == n.tolist()
    assert np.allclose([b.bin_low for b in bins] + [bins[-1].bin_high], edges)


def test_language_figures(spark):
    rows = [("en", 0.9), ("en", 0.5), ("en", 1.0), ("en", 0.0), (None, None), ("fr", 0.7), ("en", 0.95), ("en", 0.93), ("en", 0.91)]
    df = spark.createDataFrame(rows, "language string, language_score double")
    got = {r.language: r for r in stats.language_stats(df).collect()}
    en = [s for l, s in rows if l == "en" and s]
    assert got["en"].records == 6 and np.isclose(got["en"].mean_score, np.mean(en)) and np.isclose(got["en"].median_score, np.median(en))
    box = {r.language: r for r in stats.language_box(df).collect()}["en"]
    assert np.allclose([box.q1, box.med, box.q3], np.percentile(en, [25, 50, 75])) and box.outliers == 1
    assert [r.language for r in stats.ranked_languages(df).collect()] == ["en", "fr"]


def test_duplicate_population(spark):
    df = spark.createDataFrame([("en", True), ("en", False), ("fr", None), (None, None)], "language string, is_duplicate boolean")
    assert tuple(stats.duplicate_stats(df).first())[:3] == (3, 1, 2)
    assert tuple(stats.duplicate_stats(df, checked_only=True).first())[:3] == (2, 1, 1)
    assert stats.duplicate_stats(df.limit(0)).first().duplicate_rate == 0.0
