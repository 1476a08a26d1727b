"""MinHash signatures of character shingles, computed batch by batch in numpy.

Spark partitions the texts; each Arrow batch is hashed with array operations.
A shingle that recurs within a batch, and most do, is hashed once.

A SHA-1 digest is least in a text only if it is small, so of a shingle's
digests the small ones alone are remembered, and they are few; a permutation
in which a short text has none is worked out from all shingles of that text.
Which digests are small is told by their first words, which are computed for
many shingles and permutations at a time; what a task remembers is there for
the next task of the same worker.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import LSH_BANDS

# Fixed values of the affine family; signatures stored earlier depend on them.
PRIME = 2_147_483_647
RADIX = 911_382_323
MIXER = 739_982_445

CHUNK_CODE_POINTS = 250_000  # tables of a chunk stay in the processor's cache
SHA1_CODE_POINTS = 120_000  # whose tables of digests are larger
MEMO_SHINGLES = 500_000  # about 130 MB with their small digests
HASHED_DIGESTS = 1 << 16  # whose first words are computed at a time, in arrays that stay in the processor's cache
FEW_SHINGLES = 16  # for which arrays don't pay
BLOCK_BYTES = 55  # of a message that SHA-1 works on in one block
SHA1_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476, 0xC3D2E1F0)
SHA1_ROUNDS = (0x5A827999, 0x6ED9EBA1, 0x8F1BBCDC, 0xCA62C1D6)  # added in a quarter of the rounds each
DIGEST = np.dtype([("high", ">u8"), ("middle", ">u8"), ("low", ">u4")])  # the 20 bytes of SHA-1
SMALL = np.dtype([("perm", "<u2"), ("digest", DIGEST)])
SMALL_BELOW = np.uint64((1 << 64) // 24)  # the high word of digests that count as small
SMALLEST_BELOW = np.uint64((1 << 64) // 96)  # of those that suffice for most texts of a thousand shingles


def affine_coefficients(num_perm: int) -> tuple[list[int], list[int]]:
    """Multipliers and offsets of the permutations, derived from their number."""

    def draw(label: str, i: int) -> int:
        return int(hashlib.md5(f"{label}{i}".encode()).hexdigest()[:8], 16)

    a = [1 + draw("a", i) % (PRIME - 1) for i in range(num_perm)]
    b = [draw("b", i) % PRIME for i in range(num_perm)]
    return a, b


def _mod_prime(x: np.ndarray) -> np.ndarray:
    """x mod 2^31 - 1 for 0 <= x < 2^62, without a division."""
    x = (x & PRIME) + (x >> 31)
    x = (x & PRIME) + (x >> 31)
    return np.where(x == PRIME, 0, x)


def _shingle_keys(codes: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """A number per shingle that is equal exactly for equal shingles."""
    present = np.zeros(int(codes.max()) + 1, dtype=bool)
    present[codes] = True
    dense = (np.cumsum(present) - 1)[codes]
    width = max(1, int(present.sum() - 1).bit_length())
    key = dense[starts]
    for j in range(1, n):
        if width * (j + 1) > 62:
            # Too wide to pack further: number the prefixes seen so far.
            key = pd.factorize(key)[0]
        key = (key << width) | dense[starts + j]
    return key


def _base_hashes(codes: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """A 31-bit polynomial hash of the n code points at each start, mixed."""
    h = np.zeros(len(starts), dtype=np.int64)
    for j in range(n):
        h = _mod_prime(h * RADIX + codes[starts + j])
    h = _mod_prime((h ^ (h >> 15)) * MIXER)
    return h ^ (h >> 13)


def _affine_table(h: np.ndarray, num_perm: int) -> np.ndarray:
    """(h * a + b) mod 2^31 - 1 for each permutation, as ``_mod_prime`` does it, in two buffers."""
    table = np.empty((num_perm, len(h)), dtype=np.uint32)
    x, high = np.empty_like(h), np.empty_like(h)
    for i, (a, b) in enumerate(zip(*affine_coefficients(num_perm))):
        np.multiply(h, a, out=x)
        x += b
        for _ in range(2):
            np.right_shift(x, 31, out=high)
            x &= PRIME
            x += high
        x[x == PRIME] = 0
        table[i] = x
    return table


def _stem(gram: bytes) -> bytes:
    return gram.decode("utf-32-le").encode() + b"_"


@cache
def _memo(n: int, num_perm: int) -> dict[bytes, bytes]:
    """The small digests that this process remembers, from one task to the next."""
    return {}


def _schedule(blocks: np.ndarray) -> np.ndarray:
    """The 80 words of each 64-byte block; of two blocks combined by exclusive or they are those of the parts, so combined."""
    words = [*np.ascontiguousarray(blocks).view(">u4").astype(np.uint32).T]
    for t in range(16, 80):
        x = words[t - 3] ^ words[t - 8] ^ words[t - 14] ^ words[t - 16]
        words.append((x << 1) | (x >> 31))
    return np.array(words)


@cache
def _suffix_schedule(length: int, num_perm: int) -> np.ndarray:
    """Of what follows a stem of so many bytes in its block: the permutation's number and SHA-1's padding."""
    blocks = np.zeros((num_perm, 64), dtype=np.uint8)
    for i, block in enumerate(blocks):
        suffix = str(i).encode()
        end = length + len(suffix)
        block[length : end + 1] = [*suffix, 0x80]
        block[62:] = divmod(8 * end, 256)
    return _schedule(blocks)


def _first_words(stems: list[bytes], num_perm: int) -> np.ndarray:
    """The first word of SHA-1 over ``stem + i``: a row for each permutation, a column for each of the stems, which are equally long."""
    length = len(stems[0])
    blocks = np.zeros((len(stems), 64), dtype=np.uint8)
    blocks[:, :length] = np.frombuffer(b"".join(stems), dtype=np.uint8).reshape(len(stems), length)
    ours, theirs = _schedule(blocks), _suffix_schedule(length, num_perm)
    a, b, c, d, e = (np.full((num_perm, len(stems)), h, dtype=np.uint32) for h in SHA1_START)
    x, y = np.empty_like(a), np.empty_like(a)
    for t in range(80):
        np.left_shift(a, 5, out=x)
        e += np.bitwise_or(x, np.right_shift(a, 27, out=y), out=x)
        if t < 20:
            np.bitwise_and(b, np.bitwise_xor(c, d, out=x), out=x)
            x ^= d
        elif 40 <= t < 60:
            np.bitwise_and(d, np.bitwise_or(b, c, out=x), out=x)
            x |= np.bitwise_and(b, c, out=y)
        else:
            np.bitwise_xor(b, c, out=x)
            x ^= d
        e += x
        e += np.bitwise_xor(theirs[t][:, None], ours[t], out=x)
        e += np.uint32(SHA1_ROUNDS[t // 20])
        np.left_shift(b, 30, out=x)
        np.right_shift(b, 2, out=b)
        b |= x
        a, b, c, d, e = e, a, b, c, d
    return a + np.uint32(SHA1_START[0])


def _small_of(stems: list[bytes], suffixes: list[bytes]) -> Iterator[bytes]:
    """For each of the stems, which are equally long, its small digests and their permutations."""
    if len(stems) < FEW_SHINGLES or len(stems[0]) + len(suffixes[-1]) > BLOCK_BYTES:
        row, perm = (x.ravel() for x in np.indices((len(stems), len(suffixes))))
    else:
        row, perm = np.nonzero(_first_words(stems, len(suffixes)).T <= SMALL_BELOW >> np.uint64(32))
    raw = b"".join([hashlib.sha1(stems[i] + suffixes[j]).digest() for i, j in zip(row.tolist(), perm.tolist())])
    small = np.empty(len(row), dtype=SMALL)
    small["perm"], small["digest"] = perm, np.frombuffer(raw, dtype=DIGEST)
    below = small["digest"]["high"].astype(np.uint64) < SMALL_BELOW
    small = small[below]
    cuts = np.searchsorted(row[below], np.arange(len(stems) + 1)).tolist()
    return (small[i:j].tobytes() for i, j in zip(cuts, cuts[1:]))


def _small_digests(grams: list[bytes], suffixes: list[bytes], memo: dict[bytes, bytes]) -> list[bytes]:
    """For each shingle the small ones of its digests, SHA-1 over ``shingle_i``, with their permutations."""
    found = [memo.get(g) for g in grams]
    fresh = [g for g, known in zip(grams, found) if known is None]
    if not fresh:
        return found
    if len(memo) + len(fresh) > MEMO_SHINGLES:
        memo.clear()
        fresh = grams
    by_length: dict[int, list[tuple[bytes, bytes]]] = {}
    for gram in fresh:
        stem = _stem(gram)
        by_length.setdefault(len(stem), []).append((gram, stem))
    size = max(1, HASHED_DIGESTS // len(suffixes))
    for alike in by_length.values():
        for first in range(0, len(alike), size):
            some, stems = zip(*alike[first : first + size])
            memo.update(zip(some, _small_of(stems, suffixes)))
    return [memo[g] if known is None else known for g, known in zip(grams, found)]


def _sha1_signatures(
    codes: np.ndarray, starts: np.ndarray, text: np.ndarray, texts: int, n: int, num_perm: int, memo: dict[bytes, bytes]
) -> np.ndarray:
    """The least digests of the shingles at ``starts``: a row for each text, a column for each permutation."""
    which, distinct = pd.factorize(_shingle_keys(codes, starts, n))
    at = np.empty(len(distinct), dtype=np.int64)
    at[which] = starts
    raw = codes[at[:, None] + np.arange(n)].astype("<u4").tobytes()
    grams = [raw[i : i + 4 * n] for i in range(0, len(raw), 4 * n)]
    suffixes = [str(i).encode() for i in range(num_perm)]
    table = _small_digests(grams, suffixes, memo)
    sizes = np.array([len(x) // SMALL.itemsize for x in table])
    table = np.frombuffer(b"".join(table), dtype=SMALL)
    # A shingle that recurs in a text has no part in its minima; the texts stay in order.
    text, which = np.divmod(pd.unique(text * len(distinct) + which), len(distinct))
    out = np.empty(texts * num_perm, dtype=DIGEST)
    missing = np.ones(len(out), dtype=bool)
    # Long texts need the smallest digests only.
    least = table["digest"]["high"].astype(np.uint64) < SMALLEST_BELOW
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _fill(out, missing, text, which, table[least], np.bincount(owner[least], minlength=len(sizes)), num_perm)
    short = missing.reshape(texts, num_perm).any(axis=1)[text]
    _fill(out, missing, text[short], which[short], table, sizes, num_perm)
    ends = np.searchsorted(text, np.arange(texts + 1))
    for cell in np.flatnonzero(missing).tolist():
        k, perm = divmod(cell, num_perm)
        stems = [_stem(grams[g]) for g in which[ends[k] : ends[k + 1]].tolist()]
        out[cell] = np.frombuffer(min(hashlib.sha1(stem + suffixes[perm]).digest() for stem in stems), dtype=DIGEST)[0]
    return out.reshape(texts, num_perm)


def _fill(
    out: np.ndarray, missing: np.ndarray, text: np.ndarray, which: np.ndarray, table: np.ndarray, sizes: np.ndarray, num_perm: int
) -> None:
    """Writes what is ``missing`` of the least digests, as far as the table has them: so many for each shingle, one after the other."""
    counts = sizes[which]
    shift = (np.cumsum(sizes) - sizes)[which] - (np.cumsum(counts) - counts)
    entries = np.repeat(shift, counts) + np.arange(int(counts.sum()))
    cells = np.repeat(text * num_perm, counts) + table["perm"].astype(np.int64)[entries]
    high = table["digest"]["high"].astype(np.uint64)[entries]
    least = np.full(len(out), np.iinfo(np.uint64).max)
    np.minimum.at(least, cells, high)
    # Of each cell the digests with the least first word, as a rule one.
    won = np.flatnonzero((high == least[cells]) & missing[cells])
    if not len(won):
        return
    won = won[np.argsort(cells[won], kind="stable")]
    offsets = np.flatnonzero(np.diff(cells[won], prepend=-1))
    filled = cells[won][offsets]
    out[filled] = _least_digests(table["digest"][entries[won]], offsets)
    missing[filled] = False


def _least_digests(digests: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The least digest of each run: by the first word, ties by the second, then by the third."""
    runs = np.diff(np.append(offsets, len(digests)))
    out = np.empty(len(offsets), dtype=DIGEST)
    tied = np.ones(len(digests), dtype=bool)
    for word in DIGEST.names:
        values = digests[word].astype(np.uint64)
        values[~tied] = np.iinfo(np.uint64).max
        out[word] = least = np.minimum.reduceat(values, offsets)
        tied &= values == np.repeat(least, runs)
    return out


def _signatures(texts: list[str], n: int, num_perm: int, family: str, memo: dict) -> list:
    """One signature per text; every text has at least one shingle."""
    lengths = np.array([len(t) for t in texts])
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4").astype(np.int64)
    counts = lengths - n + 1
    offsets = np.concatenate(([0], np.cumsum(counts)[:-1]))
    # Start of shingle k of text d: start of d plus k.
    starts = np.arange(counts.sum()) + np.repeat(np.cumsum(lengths) - lengths - offsets, counts)
    if family == "affine":
        which, distinct = pd.factorize(_base_hashes(codes, starts, n))
        table = _affine_table(distinct, num_perm)
        # A shingle that recurs in a text has no part in its minima.
        cells = pd.unique(np.repeat(np.arange(len(texts)) * len(distinct), counts) + which)
        text, which = np.divmod(cells, len(distinct))
        offsets = np.searchsorted(text, np.arange(len(texts)))
        out = np.empty((num_perm, len(texts)), dtype=table.dtype)
        values = np.empty(len(which), dtype=table.dtype)
        for i in range(num_perm):
            np.take(table[i], which, out=values, mode="clip")
            np.minimum.reduceat(values, offsets, out=out[i])
        return list(np.ascontiguousarray(out.T).astype(np.int64))
    text = np.repeat(np.arange(len(texts)), counts)
    raw = _sha1_signatures(codes, starts, text, len(texts), n, num_perm, memo).tobytes()
    width = DIGEST.itemsize
    digests = [raw[i : i + width] for i in range(0, len(raw), width)]
    return [digests[i : i + num_perm] for i in range(0, len(digests), num_perm)]


def _chunks(texts: list[str], limit: int) -> Iterator[list[int]]:
    part: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        if part and size + len(text) > limit:
            yield part
            part, size = [], 0
        part.append(i)
        size += len(text)
    if part:
        yield part


def signature(text: Column, n: int, num_perm: int, family: str = "affine") -> Column:
    """Signature of a text already lower-cased and collapsed; null if shorter than n.

    Numbers for the affine family, whole digests of 20 bytes, which order like
    the numbers that they spell, for ``sha1``.
    """
    limit = CHUNK_CODE_POINTS if family == "affine" else SHA1_CODE_POINTS

    @F.pandas_udf("array<bigint>" if family == "affine" else "array<binary>")
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo = _memo(n, num_perm) if family == "sha1" else {}
        for batch in batches:
            result: list = [None] * len(batch)
            usable = [(i, t) for i, t in enumerate(batch) if t is not None and len(t) >= n]
            texts = [t for _, t in usable]
            for part in _chunks(texts, limit):
                rows = _signatures([texts[k] for k in part], n, num_perm, family, memo)
                for k, row in zip(part, rows):
                    result[usable[k][0]] = row
            yield pd.Series(result, dtype=object)

    return sign(text)


def signature_sha1_builtin(grams: Column, num_perm: int) -> Column:
    """The SHA-1 signature from built-ins alone, as full hexadecimal digests.

    Fixed-width lower-case hexadecimal orders like the number it spells.
    """
    return F.transform(
        F.sequence(F.lit(0), F.lit(num_perm - 1)),
        lambda i: F.coalesce(
            F.array_min(F.transform(grams, lambda g: F.sha1(F.concat(g, F.lit("_"), i.cast("string"))))),
            F.lit("0" * 40),
        ),
    )


def band_keys(sig: Column, num_perm: int) -> Column:
    """One bucket key per band; permutations left over after banding are unused."""
    rows = num_perm // LSH_BANDS
    return F.array(
        *[F.xxhash64(F.lit(b), F.slice(sig, b * rows + 1, rows)) for b in range(LSH_BANDS)]
    )


def last_bytes(sig: Column) -> Column:
    """The last byte of each digest, as a number."""
    return F.transform(sig, lambda x: F.conv(F.hex(F.substring(x, 20, 1)), 16, 10).cast("bigint"))


def fingerprint(sig: Column, num_perm: int) -> Column:
    """The two lowest bits of every position, packed 64 positions to a number:
    first the lowest bits of all positions, then the next ones."""

    def packed(bit: int, at: int) -> Column:
        return F.aggregate(
            F.slice(sig, at + 1, min(64, num_perm - at)),
            F.lit(0).cast("bigint"),
            lambda done, x: F.shiftleft(done, 1).bitwiseOR(F.shiftright(x, bit).bitwiseAND(1)),
        )

    return F.array(*[packed(bit, at) for bit in (0, 1) for at in range(0, num_perm, 64)])


def at_most_matching(left: Column, right: Column, num_perm: int) -> Column:
    """Upper bound of ``matching`` from two fingerprints, at next to no cost."""
    half = -(-num_perm // 64)
    unlike = [
        F.bit_count(left[i].bitwiseXOR(right[i]).bitwiseOR(left[half + i].bitwiseXOR(right[half + i])))
        for i in range(half)
    ]
    return F.lit(num_perm) - sum(unlike[1:], unlike[0])


def matching(left: Column, right: Column) -> Column:
    """Number of positions at which two signatures agree."""
    return F.size(F.filter(F.zip_with(left, right, lambda x, y: x == y), lambda same: same))


def first_shared_band(left: Column, right: Column) -> Column:
    """Lowest band in which two key arrays agree, from 0; -1 if none."""
    same = F.zip_with(left, right, lambda x, y: x == y)
    return (F.array_position(same, F.lit(True)) - 1).cast("int")
