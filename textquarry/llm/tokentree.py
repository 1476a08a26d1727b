"""Token counts that follow edits: a segment tree over each document's pre-tokens.

A document is cut where its pre-tokenizer is bound to cut, before a space that follows a
non-space, into segments of a few hundred characters.  A tree over them sums up characters and
tokens.  An edit finds its segments by descending the tree, takes in a neighbour on either side
as long as the cut between them is no longer certain, encodes the text of that region alone and
updates the sums on the paths from it to the root.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import piece_encoder

SEGMENT_CHARS = 256
EDITS = "array<struct<start:long,length:long,insert:string>>"
COUNTED = "n_tokens long, n_tokens_after long, n_chars_after long, n_chars_encoded long"
TREE = "segments array<string>, counts array<int>"


def is_cut(before: str, after: str) -> bool:
    """Whether a pre-tokenizer cuts between two texts, whatever else they hold."""
    return before == "" or after == "" or (after[0] == " " and not before[-1].isspace())


def segments_of(text: str, least: int = SEGMENT_CHARS) -> list[str]:
    """The text in segments of at least ``least`` characters, the last one excepted, at certain cuts."""
    out, start = [], 0
    while start < len(text):
        at = text.find(" ", start + least)
        while at > 0 and text[at - 1].isspace():
            at = text.find(" ", at + 1)
        end = len(text) if at < 0 else at
        out.append(text[start:end])
        start = end
    return out


class TokenTree:
    """The segments of one text and a binary tree of their characters and tokens."""

    def __init__(self, segments: list[str], counts: list[int] | None, count: Callable[[str], int]):
        self._count = count
        self.encoded = 0
        self._build(segments, counts)

    def _build(self, segments: list[str], counts: list[int] | None) -> None:
        self.segments = list(segments)
        self.size = 1 << max(0, len(self.segments) - 1).bit_length()
        self.sums = np.zeros((2 * self.size, 2), dtype=np.int64)
        n = len(self.segments)
        if n:
            self.sums[self.size : self.size + n, 0] = [len(s) for s in self.segments]
            self.sums[self.size : self.size + n, 1] = [self._fresh(s) for s in self.segments] if counts is None else counts
        width = self.size
        while width > 1:
            level = self.sums[width : 2 * width]
            self.sums[width // 2 : width] = level[0::2] + level[1::2]
            width //= 2

    def _fresh(self, text: str) -> int:
        self.encoded += len(text)
        return self._count(text)

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def counts(self) -> list[int]:
        return self.sums[self.size : self.size + len(self.segments), 1].tolist()

    def _find(self, at: int) -> tuple[int, int]:
        """The segment that holds a character's place, and where the segment starts."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if at >= start + self.sums[node, 0]:
                start += int(self.sums[node, 0])
                node += 1
        return node - self.size, start

    def _set(self, segment: int, text: str, tokens: int) -> None:
        self.segments[segment] = text
        node = self.size + segment
        change = np.array([len(text), tokens]) - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2

    def _neighbour(self, segment: int, step: int) -> int | None:
        """The next segment in a direction that isn't empty."""
        segment += step
        while 0 <= segment < len(self.segments):
            if self.segments[segment]:
                return segment
            segment += step
        return None

    def edit(self, start: int, length: int, insert: str) -> None:
        """Puts ``insert`` in place of ``length`` characters from ``start``, as far as the text has them."""
        start = min(max(start, 0), self.chars)
        length = min(max(length, 0), self.chars - start)
        if not self.chars:
            return self._build(segments_of(insert), None)
        first, begins = self._find(min(start, self.chars - 1))
        last, _ = self._find(max(start, start + length - 1)) if start + max(length, 1) <= self.chars else (first, 0)
        old = "".join(self.segments[first : last + 1])
        text = old[: start - begins] + insert + old[start - begins + length :]
        left, right = self._neighbour(first, -1), self._neighbour(last, 1)
        while left is not None and not is_cut(self.segments[left], text or (self.segments[right] if right is not None else "")):
            text, first, left = self.segments[left] + text, left, self._neighbour(left, -1)
        while right is not None and not is_cut(text, self.segments[right]):
            text, last, right = text + self.segments[right], right, self._neighbour(right, 1)
        new = segments_of(text)
        if len(new) > last - first + 1:
            # The region outgrew its segments: the tree is laid out anew; other counts are kept.
            counts = self.counts()
            kept = [(s, c) for s, c in zip(self.segments[:first], counts[:first]) if s]
            after = [(s, c) for s, c in zip(self.segments[last + 1 :], counts[last + 1 :]) if s]
            fresh = [(s, self._fresh(s)) for s in new]
            rows = kept + fresh + after
            return self._build([s for s, _ in rows], [c for _, c in rows])
        for k in range(first, last + 1):
            part = new[k - first] if k - first < len(new) else ""
            self._set(k, part, self._fresh(part) if part else 0)


# --------------------------------------------------------------------------
# tables


def _counter(tokenizer: str) -> Callable[[str], int]:
    encode = piece_encoder(tokenizer).encode
    return lambda text: len(encode(text)) // 4


def _apply(tree: TokenTree, edits) -> None:
    for e in edits if edits is not None else ():
        tree.edit(int(e["start"] or 0), int(e["length"] or 0), e["insert"] or "")


def counts_after_edits(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", edits: str = "edits") -> DataFrame:
    """``key`` and the tokens of every whole text before and after its edits.

    ``edits`` is an array of ``start, length, insert`` in code points, applied in order, each to what
    the one before left; places beyond the text are moved to its end.  Null texts are empty, null
    edits none, null fields 0 or empty.  ``n_chars_encoded`` is what the edits made encode anew.
    Repeated rows give a row each; other columns are ignored; an empty table gives no rows.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = _counter(tokenizer)
        for batch in batches:
            rows = []
            for doc_id, text, edits in zip(batch["key"], batch["text"], batch["edits"]):
                tree = TokenTree(segments_of(text or ""), None, tokens)
                before, tree.encoded = tree.tokens, 0
                _apply(tree, edits)
                rows.append((doc_id, before, tree.tokens, tree.chars, tree.encoded))
            yield pd.DataFrame(rows, columns=["key", "n_tokens", "n_tokens_after", "n_chars_after", "n_chars_encoded"])

    # Ids as text: a column of longs with nulls would come as floats.
    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"), F.col(edits).cast(EDITS).alias("edits"))
    return rows.mapInPandas(count, "key string, " + COUNTED).withColumn("key", F.col("key").cast("long")).withColumnRenamed("key", key)


def build_trees(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, segments, counts``: the trees of all documents, to be kept between rounds of edits."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = _counter(tokenizer)
        for batch in batches:
            trees = [TokenTree(segments_of(t or ""), None, tokens) for t in batch["text"]]
            yield pd.DataFrame({"key": batch["key"], "segments": [t.segments for t in trees], "counts": [t.counts() for t in trees]})

    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInPandas(build, "key string, " + TREE).withColumn("key", F.col("key").cast("long")).withColumnRenamed("key", key)


def update_trees(trees: DataFrame, edits: DataFrame, tokenizer: str, key: str = "doc_id") -> DataFrame:
    """The trees after a table of edits ``key, seq, start, length, insert``, applied by ``seq``; each with its total.

    The edits of a document are applied one after the other by nature; those of others run beside them.
    """

    def update(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = _counter(tokenizer)
        for batch in batches:
            rows = []
            for doc_id, segments, counts, edits in zip(batch["key"], batch["segments"], batch["counts"], batch["edits"]):
                tree = TokenTree(list(segments), list(counts), tokens)
                _apply(tree, edits)
                kept = [(s, c) for s, c in zip(tree.segments, tree.counts()) if s]
                rows.append((doc_id, [s for s, _ in kept], [c for _, c in kept], tree.tokens))
            yield pd.DataFrame(rows, columns=["key", "segments", "counts", "n_tokens"])

    listed = F.sort_array(F.collect_list(F.struct("seq", "start", "length", "insert")))
    by_doc = edits.groupBy(F.col(key).alias("edited")).agg(listed.alias("listed"))
    by_doc = by_doc.select("edited", F.transform("listed", lambda e: F.struct(e["start"], e["length"], e["insert"])).cast(EDITS).alias("edits"))
    rows = trees.join(by_doc, F.col(key) == F.col("edited"), "left")
    rows = rows.select(F.col(key).cast("string").alias("key"), "segments", "counts", "edits")
    return rows.mapInPandas(update, f"key string, {TREE}, n_tokens long").withColumn("key", F.col("key").cast("long")).withColumnRenamed("key", key)
