"""Benchmark passages in documents: a prefix-filtered join that ends in exact containment.

A window is a run of consecutive words of a benchmark item.  It occurs in a document only
if all shingles of the window occur, so any one of them is a sufficient prefix: windows are
keyed by the shingle that is rarest in the corpus (ties by hash).  Documents are probed
with their shingles; a hit fixes where the window would have to lie, which must be inside
the document, and its words are then compared one by one.

The windows are a query set that is held against all documents.  They are dealt into blocks
of at most ``BLOCK_WINDOWS``, so what is sent to the executors at once has a fixed bound,
and a larger benchmark takes more passes over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settings, write_table
from . import bytewords as B

WINDOW = 10
SHINGLE = 3
BLOCK_WINDOWS = 500_000  # about 100 MB
COUNTED_TEXTS = "500"  # that a task holds at a time while shingles are counted
COUNTED_BYTES = "4m"
HITS = "n_words long, firsts array<int>, afters array<int>, items array<string>"


@dataclass
class WindowIndex:
    """The windows of one block, sorted by the hash of their key shingle."""

    size: np.ndarray  # words of the window
    words: np.ndarray  # hashes of its words, one row each, zero beyond the size
    item: np.ndarray  # place in ``items``
    items: list[str]
    key: np.ndarray
    key_at: np.ndarray  # where in the window the key shingle starts

    def shingle_sizes(self) -> list[int]:
        return sorted({int(min(SHINGLE, s)) for s in np.unique(self.size)})


def window_rows(items: list[tuple[str, str | None]], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes, word hashes and item places of all distinct windows of an item."""
    sizes, words, owners = [], [], []
    for place, (_, text) in enumerate(items):
        hashes, _ = B.word_hashes([(text or "").encode()], B.SYMBOLS)
        n = min(window, len(hashes))
        if not n:
            continue
        rows = np.lib.stride_tricks.sliding_window_view(hashes, n)
        padded = np.zeros((len(rows), window), dtype=np.uint64)
        padded[:, :n] = rows
        padded = np.unique(padded, axis=0)
        sizes.append(np.full(len(padded), n))
        words.append(padded)
        owners.append(np.full(len(padded), place))
    if not sizes:
        return np.empty(0, dtype=np.int64), np.empty((0, window), dtype=np.uint64), np.empty(0, dtype=np.int64)
    return np.concatenate(sizes), np.concatenate(words), np.concatenate(owners)


def window_shingles(sizes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of the shingles of each window, one row each; zero where there is none."""
    out = np.zeros((len(sizes), max(1, words.shape[1] - SHINGLE + 1)), dtype=np.uint64)
    for n in np.unique(sizes):
        own, k = np.flatnonzero(sizes == n), min(SHINGLE, int(n))
        for at in range(int(n) - k + 1):
            out[own, at] = B.combine([words[own, at + place] for place in range(k)])
    return out


def _doc_shingles(hashes: np.ndarray, counts: np.ndarray, sizes: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes and places of all shingles of the texts, for each shingle size."""
    for k in sizes:
        places, _ = B.whole_runs(counts, k)
        yield B.rolling(hashes, k)[places], places


def _found(sorted_keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values are among the keys."""
    at = np.minimum(np.searchsorted(sorted_keys, values), len(sorted_keys) - 1)
    return sorted_keys[at] == values


def shingle_frequencies(docs: DataFrame, shingles: np.ndarray, sizes: list[int]) -> dict[int, int]:
    """How often each of the given shingles occurs in the whole corpus."""
    known = docs.sparkSession.sparkContext.broadcast(np.sort(shingles))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = known.value
        totals = np.zeros(len(keys), dtype=np.int64)
        for batch in batches:
            for _, raws in B.slices(batch["text"].tolist()):
                for hashes, _ in _doc_shingles(*B.word_hashes(raws, B.SYMBOLS), sizes):
                    hits = hashes[_found(keys, hashes)]
                    totals += np.bincount(np.searchsorted(keys, hits), minlength=len(keys))
        own = np.flatnonzero(totals)
        yield pd.DataFrame({"shingle": keys[own].astype(np.int64), "n": totals[own]})

    counted = docs.select("text").mapInPandas(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    small = {"spark__sql__execution__arrow__maxRecordsPerBatch": COUNTED_TEXTS, "spark__sql__execution__arrow__maxBytesPerBatch": COUNTED_BYTES}
    with settings(docs.sparkSession, **small):
        # At most as many rows as the block has shingles.
        return {r["shingle"] & 0xFFFFFFFFFFFFFFFF: r["n"] for r in counted.collect()}


def build_index(docs: DataFrame, items: list[tuple[str, str | None]], window: int) -> WindowIndex | None:
    """Keys every window by its rarest shingle; windows with a shingle that no document has are left out."""
    sizes, words, owners = window_rows(items, window)
    if not len(sizes):
        return None
    shingles = window_shingles(sizes, words)
    distinct = np.setdiff1d(np.unique(shingles), np.zeros(1, dtype=np.uint64))
    kinds = sorted({int(min(SHINGLE, s)) for s in np.unique(sizes)})
    known = shingle_frequencies(docs, distinct, kinds)
    often = np.array([known.get(int(s), 0) for s in distinct], dtype=np.int64)
    rows = np.where(shingles == 0, np.iinfo(np.int64).max, often[np.searchsorted(distinct, shingles) % len(distinct)])
    # Rarity first, then the hash: the same order for all windows.
    least = rows.min(axis=1)
    tied = np.where(rows == least[:, None], shingles, np.uint64(0xFFFFFFFFFFFFFFFF))
    at = tied.argmin(axis=1)
    key = shingles[np.arange(len(sizes)), at]
    kept = np.flatnonzero(least > 0)
    kept = kept[np.argsort(key[kept], kind="stable")]
    if not len(kept):
        return None
    return WindowIndex(sizes[kept], words[kept], owners[kept], [i for i, _ in items], key[kept], at[kept])


# --------------------------------------------------------------------------
# documents


def window_hits(index: WindowIndex, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, size and item of every occurrence of a window in the texts."""
    ends = np.cumsum(counts)
    of_word = np.repeat(np.arange(len(counts)), counts)
    firsts, windows = [], []
    for values, places in _doc_shingles(hashes, counts, index.shingle_sizes()):
        lo = np.searchsorted(index.key, values, side="left")
        hit = np.flatnonzero(_found(index.key, values))
        lo, places = lo[hit], places[hit]
        n = np.searchsorted(index.key, values[hit], side="right") - lo
        window = np.repeat(lo, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        place = np.repeat(places, n)
        first = place - index.key_at[window]
        text = of_word[place]
        # Where the window would lie must be inside the text.
        inside = (first >= (ends - counts)[text]) & (first + index.size[window] <= ends[text])
        first, window = first[inside], window[inside]
        for at in range(index.words.shape[1]):
            beyond = at >= index.size[window]
            same = beyond | (hashes[np.minimum(first + at, len(hashes) - 1)] == index.words[window, at])
            first, window = first[same], window[same]
        firsts.append(first)
        windows.append(window)
    first, window = np.concatenate(firsts), np.concatenate(windows)
    return first, index.size[window], index.item[window]


def _merged(first: np.ndarray, after: np.ndarray) -> tuple[list[int], list[int]]:
    """The union of spans as disjoint ones."""
    firsts: list[int] = []
    afters: list[int] = []
    for a, b in sorted(zip(first, after)):
        if afters and a <= afters[-1]:
            afters[-1] = max(b, afters[-1])
        else:
            firsts.append(int(a))
            afters.append(int(b))
    return firsts, afters


def _prober(spark: SparkSession, index: WindowIndex | None):
    """A function of a text column: the hits of one block of windows."""
    known = spark.sparkContext.broadcast(index)

    def probe(texts: pd.Series) -> pd.DataFrame:
        index = known.value
        rows = []
        for _, raws in B.slices(texts.tolist()):
            hashes, counts = B.word_hashes(raws, B.SYMBOLS)
            found: list[tuple] = [([], [], [])] * len(raws)
            if index is not None and len(hashes):
                first, size, item = window_hits(index, hashes, counts)
                starts = np.cumsum(counts) - counts
                # Texts without words start where the next text does; the last such start counts.
                text = np.searchsorted(starts, first, side="right") - 1
                for k in np.unique(text):
                    own = np.flatnonzero(text == k)
                    places = first[own] - starts[k]
                    found[k] = (*_merged(places, places + size[own]), sorted({index.items[i] for i in item[own]} - {None}))
            rows += [(n, *f) for n, f in zip(counts.tolist(), found)]
        return pd.DataFrame(rows, columns=["n_words", "firsts", "afters", "items"])

    return F.pandas_udf(probe, HITS)


def _merge_spans(firsts: pd.Series, afters: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_merged(a, b) for a, b in zip(firsts, afters)], columns=["firsts", "afters"])


def _blocks(docs: DataFrame, benchmark: DataFrame, window: int, text: str, item: str) -> Iterator[WindowIndex | None]:
    """The index of each block of the benchmark, built when it is asked for."""
    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    items = items.filter(F.col("text").isNotNull())
    # No item has more windows than half its bytes, rounded up.
    bound = items.agg(F.sum(F.floor(F.octet_length("text") / 2) + 1)).first()[0] or 0
    blocks = max(1, -(-bound // BLOCK_WINDOWS))
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        yield build_index(docs.select(F.col(text).alias("text")), [(r["item"], r["text"]) for r in own.collect()], window)


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text", item: str = "item_id"
) -> DataFrame:
    """``key, n_words, firsts, afters, items`` of every document: words inside an item's windows, and those items.

    ``firsts`` and ``afters`` bound disjoint spans of words; ``items`` are sorted as strings.  Null and
    empty texts have no words, items without words no windows.  The windows of an item without an id
    hit like others, but the item isn't listed.  Items that share an id count as one; repeated
    documents give a row each; empty tables and columns of other names are fine.
    """
    spark = docs.sparkSession
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias(key), whole.alias("text"))
    parts = [
        rows.withColumn("hits", _prober(spark, index)("text")).select(key, F.xxhash64("text").alias("text_hash"), "hits.*")
        for index in _blocks(rows, benchmark.withColumnRenamed(text, "text"), window, "text", item)
    ]
    if len(parts) == 1:
        return parts[0].drop("text_hash")
    # Copies are counted in the first block's rows; the hits of all blocks come together by document.
    hits = parts[0].withColumn("copies", F.lit(1))
    for part in parts[1:]:
        hits = hits.unionByName(part.withColumn("copies", F.lit(0)))
    found = hits.groupBy(key, "text_hash", "n_words").agg(
        F.sum("copies").alias("copies"),
        F.collect_set(F.struct("firsts", "afters")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    merge = F.pandas_udf(_merge_spans, "firsts array<int>, afters array<int>")
    merged = merge(F.flatten("spans.firsts"), F.flatten("spans.afters"))
    return found.select(key, "n_words", merged.alias("spans"), "items", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        key, "n_words", "spans.firsts", "spans.afters", "items"
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", item: str = "item_id") -> DataFrame:
    """The documents in which no window of the benchmark occurs, with all their columns and copies."""
    blocks = _blocks(docs, benchmark, window, text, item)
    index = next(blocks)
    while True:
        hits = _prober(docs.sparkSession, index)(F.coalesce(F.col(text).cast("string"), F.lit("")))
        docs = docs.filter(F.size(hits["firsts"]) == 0)
        index = next(blocks, False)
        if index is False:
            return docs
        docs = write_table(docs)
