"""Training of BPE and WordPiece vocabularies, encoding, decoding.

Training works on the table of distinct words and their counts, each word an
array of symbol ids.  The pairs of neighbours are put in the order in which
they would be merged: by count, then by ids.  Merging never makes a pair more
frequent, and a new pair has a place after the one that it stems from, so all
merges before the first pair outside of a leading part of that order concern
that part and its descendants alone.  A round takes such a part, the heavy
pairs, and cuts all words at other pairs.  What remains are segments, few of
them distinct, as a frequent pair comes in few surroundings of frequent pairs.
Spark counts them; which merges follow is worked out on the segments, whose
number is bounded; then one pass applies the merges to the words that hold any.
The size of the part changes with the number of segments and has no influence
on the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import words as W
from ..functions.frames import compute_once
from ..functions.merges import Contest, Merges, merge_rows, pair_keys
from ..session import cut_lineage

HEAVY_PAIRS = (4096, 65_536)  # to start with, and at most
PAIRS_A_MERGE = 4  # at most, for each merge that is still to make
SEGMENT_SYMBOLS = 300_000  # of the distinct segments that a round works on, some tens of megabytes


def words_of(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``words``, the normalised and split text."""
    return compute_once(df, words=W.pretokenize(W.normalize(F.col(text))))


def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """How often each distinct word occurs."""
    return (
        words_of(df.select(text), text)
        .select(F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _characters(kind: str) -> Column:
    """Initial symbols of a word: its characters, marked as continuing or not."""
    chars = F.regexp_extract_all("word", F.lit("(?s)."), F.lit(0))
    if kind == "bpe":
        return chars
    return F.transform(chars, lambda c, i: F.when(i == 0, c).otherwise(F.concat(F.lit(P.CONTINUATION), c)))


def _alphabet(counts: DataFrame, kind: str) -> list[str]:
    """Single characters in code point order, then continuing ones.

    At most as many as Unicode has characters, twice for WordPiece.
    """
    rows = (
        counts.select(F.explode(_characters(kind)).alias("c"))
        .groupBy("c")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    seen = {r["c"] for r in rows}
    if kind == "bpe":
        return sorted(seen)
    bare = sorted({c.removeprefix(P.CONTINUATION) if len(c) > 1 else c for c in seen})
    continuing = sorted(c for c in seen if len(c) > 1)
    return bare + continuing


def start(counts: DataFrame, kind: str) -> list[str]:
    """The vocabulary before any merge: special tokens, then characters."""
    return list(P.SPECIAL_TOKENS) + [c for c in _alphabet(counts, kind) if c not in P.SPECIAL_TOKENS]


def spell(counts: DataFrame, kind: str, ids: dict[str, int]) -> DataFrame:
    """``n``, ``symbols``: each word as the array of its characters' ids."""
    first = {c: i for c, i in ids.items() if len(c) == 1}
    lead = P.CONTINUATION
    further = first if kind == "bpe" else {c[len(lead) :]: i for c, i in ids.items() if c.startswith(lead) and len(c) == len(lead) + 1}
    handed = counts.sparkSession.sparkContext.broadcast((W.Characters(first), W.Characters(further)))
    spelled = compute_once(counts.select("word", "n"), symbols=W.spell_words(F.col("word"), handed))
    return spelled.filter(F.size("symbols") > 0).select("n", "symbols")


def pair_counts(words: DataFrame) -> DataFrame:
    """Adjacent symbol pairs over all words, weighted by word count."""
    rest = F.greatest(F.size("symbols") - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice("symbols", F.lit(1), rest), F.slice("symbols", F.lit(2), rest))
    return words.select("n", F.inline(pairs).alias("left", "right")).groupBy("left", "right").agg(F.sum("n").alias("n"))


def _joined(left: str, right: str, kind: str) -> str:
    return left + (right if kind == "bpe" else right.removeprefix(P.CONTINUATION))


def _segments(words: DataFrame, heavy: np.ndarray) -> DataFrame:
    """``segment``, ``n``: the distinct runs of heavy pairs in all words; ``heavy`` has their keys in order."""
    handed = words.sparkSession.sparkContext.broadcast(heavy)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols, sizes, at = W.rows_of(batch.column("symbols")).segments(handed.value)
            segments = W.lists(np.cumsum(sizes), pa.array(symbols))
            yield pa.RecordBatch.from_arrays([batch.column("n").take(pa.array(at)), segments], ["n", "segment"])

    # Counted by Spark, which adds up what a task finds before it is exchanged.
    return words.mapInArrow(cut, "n long, segment array<int>").groupBy("segment").agg(F.sum("n").alias("n"))


def _apply(words: DataFrame, merges: list[tuple[int, int, int]]) -> DataFrame:
    """The words after the merges (left, right, new), in order; a word of one symbol has no pairs left and goes."""
    ranked = Merges({(left, right): (rank, new) for rank, (left, right, new) in enumerate(merges)})
    handed = words.sparkSession.sparkContext.broadcast(ranked)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols, sizes = merge_rows(W.rows_of(batch.column("symbols")), handed.value)
            kept = sizes > 1
            rows = W.lists(np.cumsum(sizes[kept]), pa.array(symbols[np.repeat(kept, sizes)]))
            yield pa.RecordBatch.from_arrays([batch.column("n").filter(pa.array(kept)), rows], ["n", "symbols"])

    return words.mapInArrow(merge, "n long, symbols array<int>")


class _Naming:
    """Tokens by id, and the merges as made."""

    def __init__(self, tokens: list[str], kind: str):
        self.tokens, self.kind = tokens, kind
        self.known = {t: i for i, t in enumerate(tokens)}
        self.merges: list[tuple[int, str, str]] = []

    def name(self, left: int, right: int) -> tuple[int, bool]:
        """The symbol of a merged pair, and whether it is new."""
        one, two = self.tokens[left], self.tokens[right]
        token = _joined(one, two, self.kind)
        self.merges.append((len(self.merges), one, two))
        new = token not in self.known
        if new:
            self.known[token] = len(self.tokens)
            self.tokens.append(token)
        return self.known[token], new


def _next_merges(contest: Contest, border: tuple[int, int, int] | None, names: _Naming, vocab_size: int) -> list[tuple[int, int, int]]:
    """The merges that come before ``border``, the place of the first pair that isn't heavy.

    A merge that spells a known token makes pairs of that token more frequent, also where the
    segments don't show it; it is the last of its round.
    """
    made = []
    while len(names.tokens) < vocab_size:
        best = contest.best()
        if best is None or (border is not None and best >= border):
            break
        _, left, right = best
        symbol, new = names.name(left, right)
        made.append((left, right, symbol))
        if not new:
            break
        contest.merge(left, right, symbol)
    return made


def _rounds(words: DataFrame, names: _Naming, vocab_size: int) -> Iterator[list[tuple[int, int, int]]]:
    """The merges of one round after the other."""
    size = HEAVY_PAIRS[0]
    while len(names.tokens) < vocab_size:
        # The last merges need no more pairs than a few times their number.
        size = min(size, PAIRS_A_MERGE * (vocab_size - len(names.tokens)))
        top = pair_counts(words).orderBy(F.desc("n"), "left", "right").limit(size + 1).collect()
        if not top:
            return
        while True:
            heavy = np.sort(pair_keys(*(np.array([r[side] for r in top[:size]]) for side in ("left", "right"))))
            segments = cut_lineage(_segments(words, heavy))
            symbols = segments.agg(F.sum(F.size("segment"))).first()[0]
            if symbols <= SEGMENT_SYMBOLS or size == 1:
                break
            size = max(1, min(size, len(top)) // 4)
        border = (-top[size]["n"], top[size]["left"], top[size]["right"]) if size < len(top) else None
        made = _next_merges(Contest(map(tuple, segments.collect())), border, names, vocab_size)
        yield made
        if len(names.tokens) >= vocab_size:
            return  # nothing reads the words after the last merge
        if symbols < SEGMENT_SYMBOLS / 4:
            size = min(4 * size, HEAVY_PAIRS[1])
        words = cut_lineage(_apply(words, made))


def train(counts: DataFrame, kind: str = "bpe", vocab_size: int = 30_000) -> tuple[DataFrame, DataFrame]:
    """Vocabulary (``id``, ``token``) and merges (``rank``, ``left``, ``right``).

    Ids: special tokens, characters in code point order, merges as made.  The
    most frequent pair is merged first, of equally frequent ones that with the
    lower ids.
    """
    if kind not in ("bpe", "wordpiece"):
        raise ValueError(f"unsupported tokenizer type: {kind}")
    spark = counts.sparkSession
    counts = cut_lineage(counts)
    names = _Naming(start(counts, kind), kind)
    if len(names.tokens) < vocab_size:
        # Small next to the work each round does on it: keep it on all cores.
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        words = cut_lineage(spell(counts, kind, names.known).repartition(parts, "symbols"))
        for _ in _rounds(words, names, vocab_size):
            pass
    vocab = spark.createDataFrame(list(enumerate(names.tokens)), "id int, token string")
    return vocab, spark.createDataFrame(names.merges, "rank int, left string, right string")


def save(vocab: DataFrame, merges: DataFrame, path: str) -> None:
    vocab.coalesce(1).write.mode("overwrite").parquet(f"{path}/vocab")
    merges.coalesce(1).write.mode("overwrite").parquet(f"{path}/merges")


def load(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/vocab"), spark.read.parquet(f"{path}/merges")


def broadcast_vocabulary(vocab: DataFrame, merges: DataFrame, kind: str):
    """Hand a vocabulary to the executors; ``vocab_size`` bounds it."""
    ids = {r["token"]: r["id"] for r in vocab.collect()}
    ranks: dict[tuple[str, str], int] = {}
    for r in merges.orderBy("rank").collect():
        ranks.setdefault((r["left"], r["right"]), r["rank"])
    return vocab.sparkSession.sparkContext.broadcast(W.Vocabulary(kind, ids, ranks))


def encode(df: DataFrame, vocabulary, text: str = "text", unk_policy: str = "unk") -> DataFrame:
    """Adds ``tokens``, ``token_ids``, ``token_length``; rows that cannot be
    encoded under ``unk_policy='drop'`` are left out."""
    coded = encode_ids(df, vocabulary, text, unk_policy)
    # Tokens that nobody selects are not looked up.
    return named(coded, vocabulary).select(*df.columns, "tokens", "token_ids", "token_length")


def encode_ids(df: DataFrame, vocabulary, text: str = "text", unk_policy: str = "unk") -> DataFrame:
    """``encode`` without the tokens, which ``named`` adds: tables of ids are half the size."""
    if unk_policy not in ("unk", "drop", "error"):
        raise ValueError(f"unknown unk_policy: {unk_policy}")
    words = W.split_words(W.normalize(W.shield_specials(F.col(text))))
    coded = compute_once(df, _ids=W.encode_words(words, vocabulary, unk_policy)).filter(F.col("_ids").isNotNull())
    return coded.select(*df.columns, F.col("_ids").alias("token_ids"), F.size("_ids").alias("token_length"))


def named(coded: DataFrame, vocabulary) -> DataFrame:
    """Adds ``tokens`` to rows of ``encode_ids``, before their ids."""
    at = coded.columns.index("token_ids")
    tokens = W.tokens_of(F.col("token_ids"), vocabulary).alias("tokens")
    return coded.select(*coded.columns[:at], tokens, *coded.columns[at:])


def decode(df: DataFrame, vocabulary, ids: str = "token_ids", skip_special: bool = True) -> DataFrame:
    """Adds ``decoded``: tokens joined by one space, special tokens skipped."""
    return df.withColumn("decoded", W.decode_ids(F.col(ids), vocabulary, len(P.SPECIAL_TOKENS) if skip_special else 0))


def token_totals(df: DataFrame) -> DataFrame:
    """One row: sequences, tokens, mean length."""
    total, rows = F.coalesce(F.sum(F.col("token_length").cast("long")), F.lit(0)), F.count(F.lit(1))
    return df.agg(
        rows.alias("total_sequences"),
        total.alias("total_tokens"),
        F.when(rows > 0, total / rows).otherwise(F.lit(0.0)).alias("avg_sequence_length"),
    )


def project_ids(df: DataFrame) -> DataFrame:
    return df.select("token_ids")


def size_report(df: DataFrame) -> DataFrame:
    """Size as JSON lines of whole rows and of their ids alone, and the saving."""
    mb = F.lit(1024.0 * 1024.0)
    whole = F.sum(F.octet_length(F.to_json(F.struct(*df.columns))) + 1)
    ids = F.sum(F.octet_length(F.to_json(F.struct("token_ids"))) + 1)
    return df.agg(whole.alias("input_bytes"), ids.alias("output_bytes")).select(
        "input_bytes",
        "output_bytes",
        (F.col("input_bytes") / mb).alias("input_mb"),
        (F.col("output_bytes") / mb).alias("output_mb"),
        (100.0 * (F.col("input_bytes") - F.col("output_bytes")) / F.col("input_bytes")).alias("reduction_pct"),
    )
