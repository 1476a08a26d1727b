"""Words and word shingles of whole texts as numpy arrays of 64-bit hashes.

Texts are worked on as UTF-8 bytes, many at a time: a byte belongs to a word
or separates words, the hash of a word is the sum of random values drawn for
(place in the word, byte), and the hash of a shingle is the sum of random
values drawn for (place in the shingle, word hash).  Every value is a fixed
function of its arguments, so hashes agree between tasks and runs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# Bytes that separate words: ASCII white space, or whatever in ASCII is neither letter nor digit.
SPACES = frozenset(b" \t\n\v\f\r")
SYMBOLS = frozenset(c for c in range(128) if not chr(c).isalnum())
SLICE_BYTES = 1 << 20
_TABLE_PLACES = 128


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: a bijection that scatters 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_TABLE = mix(np.arange(_TABLE_PLACES << 8, dtype=np.uint64))


def slices(texts: Sequence[str | None], limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive runs of encoded texts of about ``limit`` bytes, with the place of the first."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        if held and size + len(raw) > limit:
            yield first, held
            first, held, size = i, [], 0
        held.append(raw)
        size += len(raw)
    if held:
        yield first, held


def word_hashes(raws: Sequence[bytes], separators: frozenset[int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lower-cased words, and how many words each text has."""
    # A newline after each text keeps words of neighbours apart.
    joined = b"\n".join(raws) + b"\n"
    data = np.frombuffer(joined.translate(LOWER), dtype=np.uint8)
    is_word = np.ones(256, dtype=bool)
    is_word[list(separators)] = False
    inside = is_word[data]
    edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0))
    starts, ends = edges[0::2], edges[1::2]
    lengths = np.fromiter(map(len, raws), dtype=np.int64, count=len(raws))
    text_ends = np.cumsum(lengths + 1)
    counts = np.diff(np.searchsorted(starts, text_ends), prepend=0)
    if not len(starts):
        return np.empty(0, dtype=np.uint64), counts
    spans = ends - starts
    firsts = np.cumsum(spans) - spans
    small = np.int32 if len(data) < 1 << 23 else np.int64
    keys = np.arange(int(spans.sum()), dtype=small)
    keys -= np.repeat(firsts.astype(small), spans)
    keys <<= 8
    keys |= data[inside]
    values = _TABLE[keys] if int(spans.max()) <= _TABLE_PLACES else mix(keys)
    sums = np.add.reduceat(values, firsts)
    return mix(sums ^ spans.astype(np.uint64)), counts


def combine(columns: Sequence[np.ndarray]) -> np.ndarray:
    """Hashes of runs of words, given the hashes of their first, second, ... words."""
    total = np.full(len(columns[0]), len(columns), dtype=np.uint64)
    for place, column in enumerate(columns):
        total += mix(column ^ np.uint64((0xA0761D6478BD642F * (place + 1)) & 0xFFFFFFFFFFFFFFFF))
    return mix(total)


def rolling(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` consecutive words, whichever texts they lie in."""
    n = max(0, len(words) - size + 1)
    return combine([words[place : place + n] for place in range(size)])


def whole_runs(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the runs of ``size`` words, those that lie in one text: their places and texts."""
    texts = np.repeat(np.arange(len(counts)), counts)
    n = max(0, len(texts) - size + 1)
    inside = np.flatnonzero(texts[:n] == texts[size - 1 : size - 1 + n])
    return inside, texts[inside]
