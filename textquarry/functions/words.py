"""Normalisation, word splitting and the encoding of single words."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .merges import Merges, Rows, merge_ranked, merge_rows

MEMO_WORDS = 250_000
BULK_WORDS = 8_000  # that are spelled at a time
SLICE_BYTES = 1 << 21  # of texts, and
SLICE_ITEMS = 200_000  # words or ids of a batch that are worked on and handed back at a time
MAX_WORD_CHARS = 100  # longer words are unknown to WordPiece

# Stand-ins for the special tokens during normalisation: code points set aside
# by Unicode as never being characters.
_STAND_INS = {token: chr(0xFDD0 + i) for i, token in enumerate(P.SPECIAL_TOKENS)}
_FIRST, _LAST = chr(0xFDD0), chr(0xFDD0 + len(P.SPECIAL_TOKENS) - 1)
_WORD_OR_SPECIAL = rf"(?U)[{_FIRST}-{_LAST}]|\w+|[^\w\s{_FIRST}-{_LAST}]+"


def slices(batch: pa.Array) -> Iterator[pa.Array]:
    """A batch in parts of bounded size, so that a task's memory doesn't follow the length of its rows."""
    if pa.types.is_list(batch.type) or pa.types.is_large_list(batch.type):
        sizes, limit = pc.list_value_length(batch), SLICE_ITEMS
    else:
        sizes, limit = pc.binary_length(batch), SLICE_BYTES
    ends = np.cumsum(sizes.fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = before = 0
    while start < len(batch):
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start, before = stop, int(ends[stop - 1])


def normalize(text: Column) -> Column:
    """Decomposed, lower-cased, accents removed.

    Spark has no canonical decomposition, so that one step is done in Python.
    """

    def decomposed(text: str | None) -> str | None:
        return text if text is None or text.isascii() else unicodedata.normalize("NFD", text)

    @F.arrow_udf("string")
    def decompose(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for part in slices(batch):
                yield pa.array([decomposed(text) for text in part.to_pylist()], pa.string())

    return F.regexp_replace(F.lower(decompose(text)), r"\p{Mn}", "")


def pretokenize(normalized: Column) -> Column:
    """Runs of word characters and runs of other non-blank characters."""
    return F.regexp_extract_all(normalized, F.lit(P.WORD), F.lit(0))


def shield_specials(text: Column) -> Column:
    """Special tokens spelled out in a text become single stand-ins."""
    shielded = text
    for token, mark in _STAND_INS.items():
        shielded = F.replace(shielded, F.lit(token), F.lit(mark))
    return F.when(F.contains(text, F.lit("<")), shielded).otherwise(text)


def split_words(normalized: Column) -> Column:
    """Like ``pretokenize`` with each stand-in a word of its own."""
    return F.regexp_extract_all(normalized, F.lit(_WORD_OR_SPECIAL), F.lit(0))


class Characters:
    """Numbers of single characters, and words spelled by them."""

    def __init__(self, numbers: dict[str, int]):
        known = sorted((ord(c), n) for c, n in numbers.items())
        self.codes = np.array([code for code, _ in known] + [-1], dtype=np.int64)
        self.numbers = np.array([n for _, n in known] + [-1], dtype=np.int32)

    def of(self, codes: np.ndarray) -> np.ndarray:
        """Numbers of code points, -1 for others."""
        at = np.searchsorted(self.codes[:-1], codes)
        return np.where(self.codes[at] == codes, self.numbers[at], np.int32(-1))

    def rows(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all words one after the other, and how many each has; characters without one are left out."""
        numbers, sizes = self.of(code_points(words)), word_sizes(words)
        known = numbers >= 0
        return numbers[known], np.diff(_counted(np.cumsum(sizes), known), prepend=0)


def code_points(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)


def word_sizes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(len, words), dtype=np.int64, count=len(words))


class Vocabulary:
    """Token ids and, for BPE, the rank of each merge."""

    def __init__(self, kind: str, ids: dict[str, int], ranks: dict[tuple[str, str], int]):
        self.kind = kind
        self.ids = ids
        self.unknown = ids[P.SPECIAL_TOKENS[3]]
        self.special = {mark: token for token, mark in _STAND_INS.items()}
        # Merging is done on the places of tokens in this list: those with ids, then others that merges name.
        parts = (token for left, right in ranks for token in (left, right, left + right))
        self.tokens = list(dict.fromkeys([*ids, *parts]))
        place = {token: i for i, token in enumerate(self.tokens)}
        self.token_ids = np.array(list(ids.values()), dtype=np.int32)
        self.merges = Merges({(place[left], place[right]): (rank, place[left + right]) for (left, right), rank in ranks.items()})
        self.characters = Characters({c: place[c] for c in ids if len(c) == 1})

    def pieces(self, word: str) -> list[str] | None:
        """Tokens of one word; None if WordPiece cannot spell it."""
        if word in self.special:
            return [self.special[word]]
        return self._merge(word) if self.kind == "bpe" else self._longest(word)

    def _merge(self, word: str) -> list[str]:
        return [self.tokens[i] for i in merge_ranked(self.characters.rows([word])[0].tolist(), self.merges.merged)]

    def coded(self, words: list[str]) -> list[bytes | None]:
        """Ids of the tokens of each word; None if WordPiece cannot spell it."""
        if self.kind != "bpe":
            return [None if parts is None else self._ids(parts) for parts in map(self.pieces, words)]
        symbols, sizes = merge_rows(Rows(*self.characters.rows(words)), self.merges)
        if len(symbols) and symbols.max() >= len(self.token_ids):
            raise KeyError(self.tokens[symbols.max()])
        ids, ends = self.token_ids[symbols].tobytes(), np.cumsum(sizes) * 4
        found = [ids[end - size : end] for size, end in zip((sizes * 4).tolist(), ends.tolist())]
        for i, word in enumerate(words):
            if word in self.special:
                found[i] = self._ids([self.special[word]])
        return found

    def _ids(self, parts: list[str]) -> bytes:
        return np.array([self.ids[p] for p in parts], dtype=np.int32).tobytes()

    def _longest(self, word: str) -> list[str] | None:
        if len(word) > MAX_WORD_CHARS:
            return None
        parts, at = [], 0
        while at < len(word):
            lead = P.CONTINUATION if at else ""
            end = next((e for e in range(len(word), at, -1) if lead + word[at:e] in self.ids), None)
            if end is None:
                return None
            parts.append(lead + word[at:end])
            at = end
        return parts


def lists(ends: np.ndarray, values: pa.Array, null: np.ndarray | None = None) -> pa.Array:
    """Rows that end at ``ends`` in the values."""
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=None if null is None else pa.array(null))


def rows_of(symbols: pa.Array) -> Rows:
    """Rows of a column of symbol arrays."""
    return Rows(symbols.flatten().to_numpy(), pc.list_value_length(symbols).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))


def _row_ends(rows: pa.Array) -> np.ndarray:
    return np.cumsum(pc.list_value_length(rows).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)


def _counted(ends: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ends of rows whose items have turned into so many each."""
    return np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))[ends]


def encode_words(words: Column, vocabulary, unk_policy: str) -> Column:
    """Ids of word arrays, by a broadcast ``Vocabulary``.

    A word is worked out once per task and then looked up, once for each part
    of a batch.  ``unk_policy`` decides about words WordPiece cannot spell:
    ``unk`` writes the unknown token, ``drop`` makes the whole row null,
    ``error`` raises.
    """

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocab: Vocabulary = vocabulary.value
        memo: dict[str, bytes | None] = {}
        unknown = np.array([vocab.unknown], dtype=np.int32).tobytes()

        def look_up(words: list[str]) -> list[bytes | None]:
            fresh = [w for w in words if w not in memo]
            if len(memo) + len(fresh) > MEMO_WORDS:
                memo.clear()
                fresh = words
            found = vocab.coded(fresh)
            if unk_policy == "unk":
                found = [unknown if c is None else c for c in found]
            if unk_policy == "error" and None in found:
                raise ValueError(f"word not in the vocabulary: {fresh[found.index(None)]!r}")
            memo.update(zip(fresh, found))
            return [memo[w] for w in words]

        for batch in batches:
            for rows in slices(batch):
                distinct = rows.flatten().dictionary_encode()
                words = distinct.dictionary.to_pylist()
                coded = [c for i in range(0, len(words), BULK_WORDS) for c in look_up(words[i : i + BULK_WORDS])]
                sizes = np.array([len(c or b"") // 4 for c in coded], dtype=np.int64)
                table = np.frombuffer(b"".join(c or b"" for c in coded), dtype=np.int32)
                at = distinct.indices.to_numpy()
                ends, counts = _row_ends(rows), sizes[at]
                # Place k of a word's ids in the table: where they start there, plus k.
                shift = (np.cumsum(sizes) - sizes)[at] - (np.cumsum(counts) - counts)
                ids = table[np.repeat(shift, counts) + np.arange(int(counts.sum()))]
                unspelled = np.array([c is None for c in coded], dtype=bool)[at]
                null = rows.is_null().to_numpy(zero_copy_only=False) | (np.diff(_counted(ends, unspelled), prepend=0) > 0)
                yield lists(_counted(ends, counts), pa.array(ids), null)

    return encode(words)


def spell_words(word: Column, alphabet) -> Column:
    """Numbers of the characters of words, by broadcast ``Characters`` of first and of further places; others are left out."""

    @F.arrow_udf("array<int>")
    def spell(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        first, further = alphabet.value
        for batch in batches:
            for part in slices(batch):
                words = [w or "" for w in part.to_pylist()]
                codes, sizes = code_points(words), word_sizes(words)
                ends, numbers = np.cumsum(sizes), further.of(codes)
                starts = (ends - sizes)[sizes > 0]
                numbers[starts] = first.of(codes[starts])
                known = numbers >= 0
                yield lists(_counted(ends, known), pa.array(numbers[known]))

    return spell(word)


def _names(vocab: Vocabulary, first: int) -> pa.Array:
    """Tokens by id, null for ids below ``first`` and unused ones."""
    names: list[str | None] = [None] * (max(vocab.ids.values(), default=-1) + 1)
    for token, i in vocab.ids.items():
        if i >= first:
            names[i] = token
    return pa.array(names, pa.string())


def _named(rows: pa.Array, names: pa.Array) -> pa.Array:
    """The tokens of ids; ids without one are left out."""
    ids = rows.flatten().fill_null(-1).to_numpy()
    used = np.append(names.is_valid().to_numpy(zero_copy_only=False), False)
    known = used[np.where((ids >= 0) & (ids < len(names)), ids, len(names))]
    null = rows.is_null().to_numpy(zero_copy_only=False)
    return lists(_counted(_row_ends(rows), known), names.take(pa.array(ids[known])), null)


def tokens_of(ids: Column, vocabulary) -> Column:
    """Tokens of ids, by a broadcast ``Vocabulary``."""

    @F.arrow_udf("array<string>")
    def name(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = _names(vocabulary.value, 0)
        for batch in batches:
            for rows in slices(batch):
                yield _named(rows, names)

    return name(ids)


def decode_ids(ids: Column, vocabulary, first: int) -> Column:
    """Tokens of ids from ``first`` on, joined by one space, by a broadcast ``Vocabulary``; others are left out."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = _names(vocabulary.value, first)
        for batch in batches:
            for rows in slices(batch):
                yield pc.binary_join(_named(rows, names), " ")

    return decode(ids)
