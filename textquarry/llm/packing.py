"""Best-two-fit packing of tokenized documents into sequences of a fixed capacity.

A bin is filled greedily with the largest pieces that fit; then its smallest
piece is replaced by two unpacked pieces that fill the gap it leaves better.
What the method decides depends on lengths alone, so it runs on the histogram
of lengths (at most ``capacity`` numbers, whatever the size of the corpus): a
bin that the method would build again and again is planned once, with the
number of its repetitions.  The pieces themselves stay distributed.  They get
a rank among the pieces of their length, and the plan says for each rank which
sequence and offset it stands for.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_table
from .bpe import piece_encoder

SALTS = 64  # parts that the pieces of one length are ranked in
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# --------------------------------------------------------------------------
# tokens


def token_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, key: str = "doc_id", with_ids: bool = False
) -> DataFrame:
    """Token pieces of at most ``capacity`` ids: every document whole, or cut if it is longer.

    A document is the ids of its text and ``end_id``; null counts as empty.  Of a longer
    document all pieces but the first have ``capacity`` ids.  ``with_ids`` adds the ids.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = piece_encoder(tokenizer)
        end = np.uint32(end_id).tobytes()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["key"], batch["text"]):
                raw = encoder.encode(text) + end
                n = len(raw) // 4
                first = n % capacity or capacity
                bounds = [0, *range(first, n + 1, capacity)]
                for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    ids = np.frombuffer(raw, dtype=np.uint32, count=b - a, offset=4 * a)
                    row = (doc_id, piece, a, b - a, zlib.crc32(ids.astype("<u4", copy=False)))
                    rows.append((*row, ids.astype(np.int32)) if with_ids else row)
            names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = pd.array([None if pd.isna(x) else int(x) for x in out["doc_id"]], dtype="Int64")
            yield out

    schema = PIECES + (", ids array<int>" if with_ids else "")
    # Ids as text: a column of longs with nulls would come as floats.
    return docs.select(F.col(key).cast("long").cast("string").alias("key"), F.col("text")).mapInPandas(cut, schema)


# --------------------------------------------------------------------------
# plan


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Best-two-fit on a histogram: bins as lists of lengths, each with how often it is built."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in counts.items():
        left[length] = count
    plan = []
    while left.any():
        free = left.copy()
        lengths, gap = [], capacity
        while True:
            fitting = np.flatnonzero(free[: gap + 1])
            if not len(fitting):
                break
            # As many as fit of the largest at once.
            largest = int(fitting[-1])
            n = min(gap // largest, int(free[largest]))
            lengths += [largest] * n
            free[largest] -= n
            gap -= n * largest
        if gap:
            lengths = _two_for_one(lengths, gap, free)
        used = np.bincount(lengths, minlength=capacity + 1)
        own = np.flatnonzero(used)
        times = int((left[own] // used[own]).min())
        left -= used * times
        plan.append((lengths, times))
    return plan


def _two_for_one(lengths: list[int], gap: int, free: np.ndarray) -> list[int]:
    """The bin with its smallest piece replaced by the two free ones that fit best, if they fit better."""
    smallest = min(lengths)
    room = smallest + gap
    sizes = np.flatnonzero(free[:room])
    if not len(sizes):
        return lengths
    best = (smallest, None)
    for a in sizes[::-1]:
        # The other is no larger than the first; the same length needs two pieces.
        if 2 * a <= best[0]:
            break
        most = min(room - a, a if free[a] > 1 else a - 1)
        at = np.searchsorted(sizes, most, side="right") - 1
        if most > 0 and at >= 0 and a + sizes[at] > best[0]:
            best = (int(a + sizes[at]), (int(a), int(sizes[at])))
    if best[1] is None:
        return lengths
    kept = list(lengths)
    kept.remove(smallest)
    return kept + list(best[1])


def plan_slots(plan: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, list[int]]]:
    """For every planned bin and length: (length, first rank, rank after the last, first sequence, offsets)."""
    taken: dict[int, int] = {}
    slots, sequence = [], 0
    for lengths, times in plan:
        offsets: dict[int, list[int]] = {}
        at = 0
        for length in lengths:
            offsets.setdefault(length, []).append(at)
            at += length
        for length, places in offsets.items():
            first = taken.get(length, 0)
            taken[length] = first + times * len(places)
            slots.append((length, first, taken[length], sequence, places))
        sequence += times
    return slots


# --------------------------------------------------------------------------
# placing


def ranked_by_length(pieces: DataFrame) -> DataFrame:
    """Adds ``rank``, counted from 0 without gaps among the pieces of a length.

    The pieces of a length are ranked in ``SALTS`` parts, each of which starts where the one
    before ends, so that a length that a third of all pieces have isn't ranked by one task.
    """
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALTS)))
    sizes = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    placed = salted.withColumn("nth", F.row_number().over(own) - 1)
    # At most capacity x SALTS rows.
    return placed.join(F.broadcast(starts), ["length", "salt"]).withColumn("rank", F.col("first") + F.col("nth")).drop("salt", "first", "nth")


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 1024, key: str = "doc_id", with_ids: bool = False
) -> DataFrame:
    """Packs all documents into sequences of at most ``capacity`` tokens.

    One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and, if
    asked for, ``ids``.  Null and empty texts are one ``end_id``.  Repeated rows are packed as
    often as they occur; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    pieces = write_table(token_pieces(docs, tokenizer, end_id, capacity, key, with_ids))
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    slots = plan_slots(plan_bins(counts, capacity))
    # Bounded by the number of distinct bins, a few times the capacity.
    table = spark.createDataFrame(slots, "length long, lo long, hi long, first_sequence long, offsets array<long>")
    ranked = ranked_by_length(pieces)
    inside = (F.col("p.length") == F.col("s.length")) & (F.col("p.rank") >= F.col("s.lo")) & (F.col("p.rank") < F.col("s.hi"))
    nth = F.col("p.rank") - F.col("s.lo")
    per_bin = F.size("s.offsets")
    return ranked.alias("p").join(F.broadcast(table.alias("s")), inside).select(
        "p.doc_id",
        "p.piece",
        "p.start",
        "p.length",
        "p.ids_crc32",
        (F.col("s.first_sequence") + F.floor(nth / per_bin)).cast("long").alias("sequence_id"),
        F.element_at("s.offsets", (F.pmod(nth, per_bin) + 1).cast("int")).alias("offset"),
        *(["p.ids"] if with_ids else []),
    )
