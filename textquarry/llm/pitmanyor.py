"""Language-model scores by a hierarchical Pitman-Yor process.

Each word is drawn from the restaurant of the word before it.  Those restaurants share one parent,
that of words without context, whose dishes are spelled by restaurants of characters: the one for
a context of three characters shares its parent, that of two, with its siblings, and so on down to
a uniform choice.  Customers of a word after another are the training tokens; the tables of all
contexts are the customers of the words, and the customers that their spellings send to the
character restaurants are the tables of the words.  A text starts after the token that ends texts.
Seatings are sampled by Gibbs: each sweep reseats the customers of every dish by the Chinese
restaurant rule, given the predictive probability of its parent and the tables of its restaurant
from the sweep before.  Predictive probabilities are averaged over the sweeps that follow the
burn-in.  Words that training has not seen are one outcome: what the dishes seen leave over.

Words that occur more than once are dealt into buckets, and pairs of a word and the one before,
by both, into others.  Buckets exchange packed arrays: those of pairs ask for the probabilities of
their words and the tables of their contexts, and answer with the tables of their pairs.  A pair or a
word that occurs once has one table whatever the seating, so it takes no part in the sweeps.  The
character restaurants have a size that the alphabet of bytes bounds, whatever the corpus, and
are seated on the driver.  Tables that others have replaced are removed.  Texts are read once: chunks
of documents are written as words by their places in a dictionary of their own, and what comes back to
a chunk are the seatings of its pairs and the counts and probabilities of its words.
"""

from __future__ import annotations

import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import COMPACT, discard, settings, write_table

CHUNK_BYTES = 1 << 24
BATCH_ROWS = "1000"  # of texts that a task is handed at a time
BUCKET_BYTES = 1 << 25  # of text for each bucket of pairs
LEAST_BUCKETS = 12
BURN_IN = 1
SAMPLES = 3
SMOOTHING = 0.1  # of the base score
END = b""  # the token that ends a text; no word is empty
SYMBOLS = 257  # bytes and the end of a word
_START, _STOP = 257, 256
_BEFORE = 258  # characters that can stand before another: bytes, the end and the start of a word
STRENGTH = 1.0  # concentration of all restaurants
EXACT_SEATS = 48  # customers of a dish that are seated one by one; further ones in growing groups
LEVELS = 4


# --------------------------------------------------------------------------
# restaurants


def discount(customers: np.ndarray) -> float:
    """The usual estimate of the discount from how many dishes have one and two customers."""
    one, two = int((customers == 1).sum()), int((customers == 2).sum())
    return float(np.clip(one / (one + 2 * two), 0.05, 0.95)) if one else 0.5


def seat(customers: np.ndarray, new_weight: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish after its customers were seated anew.

    The next customer of a dish that has k at t tables opens one with odds ``new_weight`` to
    ``k - d t``; the first always does.  Beyond ``EXACT_SEATS`` customers, groups of a quarter of
    those seated share their odds.
    """
    tables = (customers > 0).astype(np.float64)
    seated, group = 1, 1
    active = np.flatnonzero(customers > 1)
    while len(active):
        n = np.minimum(customers[active] - seated, group)
        odds = new_weight[active]
        tables[active] += rng.binomial(n, odds / (odds + seated - d * tables[active] + (n - 1) / 2))
        seated += group
        if seated >= EXACT_SEATS:
            group = max(1, seated // 4)
        active = active[customers[active] > seated]
    return tables.astype(np.int64)


@dataclass
class Spelling:
    """Character restaurants: per level the seen (context, symbol) keys and their probabilities."""

    keys: list[np.ndarray]
    probabilities: list[np.ndarray]
    contexts: list[np.ndarray]
    back_off: list[np.ndarray]  # weight of the parent in each seen context

    def probability(self, level: int, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        if level < 0:
            return np.full(len(context), 1.0 / SYMBOLS)
        found, at = _look_up(self.keys[level], context * SYMBOLS + symbol)
        out = np.empty(len(context))
        out[found] = self.probabilities[level][at[found]]
        if len(missing := np.flatnonzero(~found)):
            known, place = _look_up(self.contexts[level], context[missing])
            weight = np.ones(len(missing))
            weight[known] = self.back_off[level][place[known]]
            out[missing] = weight * self.probability(level - 1, context[missing] // _BEFORE, symbol[missing])
        return out


def _look_up(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), dtype=bool), np.zeros(len(wanted), dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, at


def seat_spelling(keys: np.ndarray, customers: np.ndarray, before: Spelling | None, tables_before: list, rng: np.random.Generator) -> tuple[Spelling, list]:
    """Seats all levels, from the longest contexts down; returns their probabilities and tables."""
    levels = []
    for level in range(LEVELS - 1, -1, -1):
        context, symbol = keys // SYMBOLS, keys % SYMBOLS
        contexts, own = np.unique(context, return_inverse=True)
        d = discount(customers)
        if before is None:
            parent, held = np.full(len(keys), 1.0 / SYMBOLS), np.bincount(own, minlength=len(contexts)).astype(float)
        else:
            parent = before.probability(level - 1, context // _BEFORE, symbol)
            known, at = _look_up(before.contexts[level], contexts)
            held = np.where(known, tables_before[level][at] if len(tables_before[level]) else 0, 0)
        tables = seat(customers, (STRENGTH + d * held[own]) * parent, d, rng)
        levels.append((keys, customers, tables, contexts, own, d))
        # The tables of siblings are the customers of their parent.
        up = (context // _BEFORE) * SYMBOLS + symbol
        keys, place = np.unique(up, return_inverse=True)
        customers = np.bincount(place, weights=tables, minlength=len(keys)).astype(np.int64)
    spelling, held = Spelling([], [], [], []), []
    for level, (keys, customers, tables, contexts, own, d) in enumerate(reversed(levels)):
        total = STRENGTH + np.bincount(own, weights=customers, minlength=len(contexts))
        all_tables = np.bincount(own, weights=tables, minlength=len(contexts))
        back_off = (STRENGTH + d * all_tables) / total
        parent = spelling.probability(level - 1, (keys // SYMBOLS) // _BEFORE, keys % SYMBOLS)
        spelling.keys.append(keys)
        spelling.probabilities.append((customers - d * tables) / total[own] + back_off[own] * parent)
        spelling.contexts.append(contexts)
        spelling.back_off.append(back_off)
        held.append(all_tables)
    return spelling, held


def spelled(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Longest contexts and symbols of all characters of the words, and where each word starts."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    starts = np.cumsum(sizes) - sizes
    symbols = np.full(int(sizes.sum()), _STOP, dtype=np.int64)
    inside = np.ones(len(symbols), dtype=bool)
    inside[starts + sizes - 1] = False
    symbols[inside] = np.frombuffer(b"".join(words), dtype=np.uint8)
    place = np.arange(len(symbols)) - np.repeat(starts, sizes)

    def before(k: int) -> np.ndarray:
        shifted = np.concatenate([np.full(k, _START), symbols[:-k]])[: len(symbols)]
        return np.where(place >= k, shifted, _START)

    context = before(1)
    for level in range(2, LEVELS):
        context = context * _BEFORE + before(level)
    return context, symbols, starts


def log_spelling(model: Spelling, words: list[bytes]) -> np.ndarray:
    context, symbols, starts = spelled(words)
    return np.add.reduceat(np.log(model.probability(LEVELS - 1, context, symbols)), starts)


# --------------------------------------------------------------------------
# texts

ENTRY, DICTIONARY, PAIR_BAG, CHUNK = range(4)  # kinds of rows
BAGS = "kind int, chunk long, place int, word binary, n long, bucket int, packed binary"
_ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}


def _fields(schema: str) -> list[list[str]]:
    return [column.split() for column in schema.split(", ")]


def _rows(schema: str, **columns) -> pa.RecordBatch:
    """Rows of the schema with these columns, a single value for all or one for each; the others are null."""
    size = max(len(x) for x in columns.values() if isinstance(x, (list, np.ndarray)))
    arrays = []
    for name, kind in _fields(schema):
        values = columns.get(name)
        if isinstance(values, (list, np.ndarray)):
            arrays.append(pa.array(values, _ARROW[kind]))
        else:
            arrays.append(pa.nulls(size, _ARROW[kind]) if values is None else pa.repeat(pa.scalar(values, _ARROW[kind]), size))
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in _fields(schema)])


def _by(df: DataFrame, key: str, parts, schema: str) -> DataFrame:
    """What ``parts`` yields from the rows of each group."""
    fields = pa.schema([(name, _ARROW[kind]) for name, kind in _fields(schema)])
    return df.groupBy(key).applyInArrow(lambda rows: pa.Table.from_batches(list(parts(rows)), fields), schema)


def bags_of_pairs(docs: DataFrame, buckets: int) -> DataFrame:
    """Chunks of documents as words by their places in a dictionary, and the dictionary and pairs of each chunk; written by kind.

    ``docs`` has ``doc_id, train, held_out, text``.  Rows with a ``word`` are entries of a dictionary
    with their training tokens, the next kind are parts of that dictionary by buckets of words, whose
    number is their ``place``, then come the pairs of a chunk by buckets of pairs, and chunks.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        size = 0
        for batch in batches:
            flags = (batch.column(c).to_pylist() for c in ("doc_id", "train", "held_out"))
            for doc_id, train, out, text in zip(*flags, batch.column("text").cast(pa.binary())):
                raw = text.as_py() or b""
                words = raw.lower().split()
                words.append(END)
                held.append((doc_id, train, out, np.fromiter(map(numbers.__getitem__, words), dtype=np.int32, count=len(words))))
                size += len(raw)
                if size >= CHUNK_BYTES:
                    yield from _chunk(held, numbers, buckets)
                    held, size = [], 0
                    numbers.clear()
                    numbers.default_factory = count().__next__
        if held:
            yield from _chunk(held, numbers, buckets)

    bags = docs.withColumn("doc_id", F.col("doc_id").cast("string")).mapInArrow(read, BAGS)
    with settings(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=BATCH_ROWS):
        return write_table(bags, by="kind", options=COMPACT)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words))


def _dealt(words: list[bytes], hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """Words by buckets of words, and their places."""
    of = hashes % np.uint32(buckets)
    for b in np.unique(of).tolist():
        places = np.flatnonzero(of == b)
        yield b, [words[i] for i in places], places


def _bucket_of(hashes: np.ndarray, before: np.ndarray, after: np.ndarray, buckets: int) -> np.ndarray:
    """Pairs are dealt by both words, so that no context is in one bucket as a whole."""
    mixed = (hashes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))[before]
    mixed ^= (hashes.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9))[after]
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)


def _pairs_of(after: np.ndarray, end: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of the words of texts, as the first times ``words`` plus the second, and the place of each pair among them."""
    codes = np.empty(len(after), dtype=np.int64)
    codes[0], codes[1:] = end, after[:-1]
    codes *= words
    codes += after
    return np.unique(codes, return_inverse=True)


def _chunk(held: list[tuple], numbers: dict[bytes, int], buckets: int) -> Iterator[pa.RecordBatch]:
    chunk = uuid.uuid4().int >> 65
    # Words in their order, so that pairs are in the same order everywhere.
    words = sorted(numbers)
    place = np.empty(len(words), dtype=np.int32)
    place[np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))] = np.arange(len(words))
    after = place[np.concatenate([row[3] for row in held])]
    sizes = np.array([len(row[3]) for row in held])
    trained = np.repeat(np.array([row[1] for row in held]), sizes)
    n = np.bincount(after[trained], minlength=len(words))
    yield _rows(BAGS, kind=ENTRY, word=words, n=n)

    hashes = _hashes(words)
    for b, own, places in _dealt(words, hashes, buckets):
        yield _rows(BAGS, kind=DICTIONARY, chunk=chunk, place=buckets, bucket=b, packed=[_pack((_joined(own), _steps(places)))])

    end = int(place[numbers[END]])
    hashes = hashes.astype(np.uint16)
    content = ([row[0] for row in held], np.array([row[2] for row in held]), sizes.astype(np.uint32), after.astype(np.uint32), end, hashes, buckets)
    yield _rows(BAGS, kind=CHUNK, chunk=chunk, packed=[_pack(content)])

    codes, pair = _pairs_of(after, end, len(words))
    times = np.bincount(pair[trained], minlength=len(codes)).astype(np.uint32)
    del pair, after, trained, content
    first, second = (codes // len(words)).astype(np.int32), (codes % len(words)).astype(np.int32)
    del codes
    bucket = _bucket_of(hashes, first, second, buckets)
    for b in np.unique(bucket):
        own = np.flatnonzero(bucket == b)
        used, one, two = _numbered(first[own], second[own], len(words))
        content = (_joined([words[w] for w in used]), _steps(one), two.astype(np.uint32), times[own])
        yield _rows(BAGS, kind=PAIR_BAG, chunk=chunk, bucket=int(b), packed=[_pack(content)])


def _numbered(first: np.ndarray, second: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbers below ``size`` that occur, and each of both columns as the place of its number among them."""
    occurs = np.zeros(size, dtype=bool)
    occurs[first] = occurs[second] = True
    place = np.cumsum(occurs) - 1
    return np.flatnonzero(occurs), place[first], place[second]


def _joined(words: list[bytes]) -> bytes:
    """Words of texts as one; they have no blanks, and one at least is there."""
    return b" ".join(words)


def _steps(ascending: np.ndarray) -> np.ndarray:
    """Differences, which are small numbers and compress."""
    return np.diff(ascending.astype(np.uint32), prepend=np.uint32(0))


def _pack(content: tuple) -> bytes:
    """Arrays of numbers byte by byte, all lowest bytes first, so that the high ones compress."""
    import pickle

    import zstandard

    def planes(x):
        if isinstance(x, np.ndarray) and x.dtype.itemsize > 2:
            return _Planes(np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.dtype.itemsize).T), x.dtype)
        return [planes(y) for y in x] if isinstance(x, list) and x and isinstance(x[0], np.ndarray) else x

    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(tuple(map(planes, content)), protocol=5))


@dataclass
class _Planes:
    planes: np.ndarray
    kind: np.dtype

    def whole(self) -> np.ndarray:
        return np.ascontiguousarray(self.planes.T).view(self.kind).reshape(-1)


def _unpack(packed: bytes) -> tuple:
    import pickle

    import zstandard

    def whole(x):
        if isinstance(x, _Planes):
            return x.whole()
        return [whole(y) for y in x] if isinstance(x, list) and x and isinstance(x[0], _Planes) else x

    return tuple(map(whole, pickle.loads(zstandard.ZstdDecompressor().decompress(packed))))


# --------------------------------------------------------------------------
# pairs


PAIRS = "bucket int, chunk long, to int, packed binary, one long, two long"
SWEPT = "bucket int, to int, packed binary"


def _merge(bags: pa.Table, buckets: int) -> Iterator[pa.RecordBatch]:
    """The pairs of a bucket that training has, where each chunk's pairs are, and their dictionary, dealt to the buckets of words.

    With each word are its tables as word and as context, in all pairs, with one table each, and in
    those that occur once.  Those pairs have one table whatever the seating; the words of the others
    are asked for in each sweep.
    """
    bucket = bags["bucket"][0].as_py()
    parts = [_unpack(p) for p in bags["packed"].to_pylist()]
    # Dictionaries are taken apart one at a time: as objects their words need several times the room.
    words: set[bytes] | list[bytes] = set()
    for part in parts:
        words.update(part[0].split(b" "))
    words = sorted(words)
    at = {w: i for i, w in enumerate(words)}
    sizes, times = [len(part[1]) for part in parts], np.concatenate([part[3] for part in parts])
    coded, start = np.empty(len(times), dtype=np.int64), 0
    for joined, first, second, _ in parts:
        place = np.array([at[w] for w in joined.split(b" ")], dtype=np.int64)
        np.multiply(place[np.cumsum(first, dtype=np.int64)], len(words), out=coded[start : start + len(first)])
        coded[start : start + len(first)] += place[second]
        start += len(first)
    del parts, at
    codes, pair = np.unique(coded, return_inverse=True)
    del coded
    c = np.bincount(pair, weights=times, minlength=len(codes)).astype(np.int64)
    seen = c > 0
    number = np.cumsum(seen) - 1
    first, second, c = codes[seen] // len(words), codes[seen] % len(words), c[seen]
    used, first, second = _numbered(first, second, len(words))
    start = 0
    for chunk, size in zip(bags["chunk"].to_pylist(), sizes):
        own = pair[start : start + size]
        start += size
        yield _rows(PAIRS, bucket=bucket, chunk=chunk, packed=[_pack((seen[own], _steps(number[own[seen[own]]])))])
    packed = _pack((_steps(first), second.astype(np.uint32), c.astype(np.uint32)))
    yield _rows(PAIRS, bucket=bucket, packed=[packed], one=[int((c == 1).sum())], two=[int((c == 2).sum())])
    own = [words[w] for w in used]
    once, asked = c == 1, np.zeros(len(used), dtype=bool)
    asked[first[~once]] = asked[second[~once]] = True
    sums = [np.bincount(side, minlength=len(used)).astype(np.uint32) for side in (second, first, second[once], first[once])]
    for to, theirs, places in _dealt(own, _hashes(own), buckets):
        yield _rows(PAIRS, bucket=bucket, to=to, packed=[_pack((_joined(theirs), _steps(places), asked[places], *(x[places] for x in sums)))])


def _pair_columns(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and second words and customers of the pairs of a bucket."""
    first, second, c = _unpack(packed)
    return np.cumsum(first.astype(np.int64)), second.astype(np.int64), c.astype(np.int64)


class Pairs:
    """Restaurants of words after another word, in buckets.

    ``known`` has the pairs of each bucket.  A sweep writes the tables of those that occur more than
    once, in all samples and at present, and for the buckets of words what they add up to.
    """

    def __init__(self, bags: DataFrame, seed: int):
        self.buckets = buckets = bags.filter(F.col("kind") == DICTIONARY).agg(F.max("place")).first()[0] or 1  # of words
        merged = bags.filter(F.col("kind") == PAIR_BAG).select("chunk", "bucket", "packed")
        self.table = write_table(_by(merged, "bucket", lambda rows: _merge(rows, buckets), PAIRS), options=COMPACT)
        self.chunks = self.table.filter("chunk IS NOT NULL").select("bucket", "chunk", "packed")
        self.asking = self.table.filter("to IS NOT NULL").select("bucket", "to", "packed")
        self.known = self.table.filter("chunk IS NULL AND to IS NULL").select("bucket", "packed")
        one, two = self.table.agg(F.sum("one"), F.sum("two")).first()
        self.d = float(np.clip(one / (one + 2 * two), 0.05, 0.95)) if one else 0.5
        self.seed = seed
        self.swept: DataFrame | None = None
        self.kept = 0  # samples

    def reseat(self, asked: DataFrame, sweep: int, sample: bool) -> DataFrame:
        """Given ``bucket, of, packed``, the probabilities and tables of the words asked for; keeps the seating before as a sample.

        Returns ``to, bucket, packed``, the tables of these words.
        """
        d, seed, kept = self.d, self.seed, self.kept

        def seat_bucket(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            words = [(of, _unpack(packed)) for of, packed in zip(rows["of"].to_pylist(), rows["packed"].to_pylist()) if of is not None]
            if not words:
                return
            first, second, c, samples, t = _present(rows.filter(rows["of"].is_null()), kept)
            many = c > 1
            first, second, c = first[many], second[many], c[many]
            size = int(max(first.max(), second.max())) + 1
            p, held = np.empty(size), np.empty(size)
            for _, (steps, own_p, own_held) in words:
                places = np.cumsum(steps.astype(np.int64))
                p[places], held[places] = own_p, own_held
            if sample:
                samples = [*samples, t]
            bucket = rows["bucket"][0].as_py()
            rng = np.random.default_rng([seed, 1, sweep, bucket])
            t = seat(c, (STRENGTH + d * held[first]) * p[second], d, rng)
            yield _rows(SWEPT, bucket=bucket, packed=[_pack((samples, t.astype(np.uint32)))])
            sums = [np.bincount(side, weights=t, minlength=size).astype(np.uint32) for side in (second, first)]
            for of, (steps, _, _) in words:
                places = np.cumsum(steps.astype(np.int64))
                yield _rows(SWEPT, bucket=bucket, to=of, packed=[_pack(tuple(x[places] for x in sums))])

        rows = self._state().withColumn("of", F.lit(None).cast("int")).unionByName(asked.withColumn("tables", F.lit(False)))
        swept = write_table(_by(rows, "bucket", seat_bucket, SWEPT))
        if self.swept is not None:
            discard(self.swept)
        self.swept = swept
        self.kept += sample
        return swept.filter("to IS NOT NULL").select("to", "bucket", "packed")

    def _state(self) -> DataFrame:
        """``bucket, packed, tables``: the pairs of each bucket and, after a sweep, their tables."""
        known = self.known.withColumn("tables", F.lit(False))
        if self.swept is None:
            return known
        return known.unionByName(self.swept.filter("to IS NULL").select("bucket", "packed", F.lit(True).alias("tables")))

    @property
    def words(self) -> DataFrame:
        """``bucket, place, word``: the dictionary of each bucket."""
        schema = "bucket int, place int, word binary"

        def unfold(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            for packed in rows["packed"].to_pylist():
                own, steps, *_ = _unpack(packed)
                yield _rows(schema, bucket=rows["bucket"][0].as_py(), place=np.cumsum(steps).astype(np.int32), word=own.split(b" "))

        return _by(self.asking, "bucket", unfold, schema)

    @property
    def state(self) -> DataFrame:
        """``bucket, packed``: words, customers, tables and samples of all pairs of each bucket."""
        kept, schema = self.kept, "bucket int, packed binary"

        def whole(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            first, second, c, samples, t = _present(rows, kept)
            packed = _pack((first, second, c, _among(c, t), [_among(c, x) for x in samples]))
            yield _rows(schema, bucket=rows["bucket"][0].as_py(), packed=[packed])

        return _by(self._state(), "bucket", whole, schema)

    def back_to_chunks(self) -> DataFrame:
        """For the pairs of each chunk and bucket in their order: the customers, and the tables in each sample; written."""
        kept, schema = self.kept, "chunk long, bucket int, packed binary"

        def answer(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            _, _, c, samples, t = _present(rows.filter(rows["chunk"].is_null()), kept)
            values = [c.astype(np.uint32), *(_among(c, x) for x in (*samples, t))]
            asking = rows.filter(rows["chunk"].is_valid())
            for chunk, packed in zip(asking["chunk"].to_pylist(), asking["packed"].to_pylist()):
                seen, steps = _unpack(packed)
                own = np.cumsum(steps.astype(np.int64))
                every = []
                for x in values:
                    every.append(np.zeros(len(seen), dtype=np.uint32))
                    every[-1][seen] = x[own]
                yield _rows(schema, chunk=chunk, bucket=rows["bucket"][0].as_py(), packed=[_pack(tuple(every))])

        rows = self.chunks.withColumn("tables", F.lit(False)).unionByName(self._state().withColumn("chunk", F.lit(None).cast("long")))
        return write_table(_by(rows, "bucket", answer, schema))

    def discard(self) -> None:
        discard(self.table)
        if self.swept is not None:
            discard(self.swept)


def _present(rows: pa.Table, kept: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """First and second words and customers of all pairs of a bucket; samples and tables of those with more than one customer.

    Buckets without such pairs have no tables written; ``kept`` is the number of samples.
    """
    packed = dict(zip(rows["tables"].to_pylist(), rows["packed"].to_pylist()))
    first, second, c = _pair_columns(packed[False])
    if True in packed:
        return first, second, c, *_unpack(packed[True])
    ones = np.ones(int((c > 1).sum()), dtype=np.uint32)
    return first, second, c, [ones] * kept, ones


def _among(c: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """The tables of all pairs, given those of the ones with more than one customer."""
    every = np.ones(len(c), dtype=np.uint32)
    every[c > 1] = tables
    return every


# --------------------------------------------------------------------------
# sweeps


@dataclass
class WordRestaurant:
    customers: int
    tables: int
    d: float

    def probability(self, c, t, log_spelling):
        """Of words with these customers and tables."""
        return (c - self.d * t + (STRENGTH + self.d * self.tables) * np.exp(log_spelling)) / (STRENGTH + self.customers)


WORDS = "of int, what int, packed binary, letter int, sum long, c long, t long, one long, two long"
ROSTER, PRESENT, TABLES = range(3)  # what the rows of a bucket of words hold


class Words:
    """The restaurant of words without context: words that occur more than once, in buckets.

    ``roster`` has what stays: the words, their tokens, their tables in pairs that occur once, the
    buckets of pairs that ask for them, and their characters as places among ``keys``.  ``present``
    has customers, tables as contexts, tables, and the samples of probabilities and tables as contexts.
    """

    def __init__(self, words: DataFrame, keys: np.ndarray, settled: int, pairs: Pairs | None, seed: int):
        self.spark, self.pairs, self.settled, self.seed = words.sparkSession, pairs, settled, seed
        buckets = LEAST_BUCKETS if pairs is None else pairs.buckets
        handed = self.spark.sparkContext.broadcast(keys)
        paired = pairs is not None

        def enrol(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            asking = rows.filter(rows["bucket"].is_valid())
            rows = rows.filter(rows["bucket"].is_null())
            if not rows.num_rows:
                return
            own, tokens = rows["word"].to_pylist(), rows["tokens"].to_numpy()
            at = {w: i for i, w in enumerate(own)}
            c, held, c_once, held_once = np.zeros((4, len(own)), dtype=np.int64)
            routes = {}
            for bucket, packed in zip(asking["bucket"].to_pylist(), asking["packed"].to_pylist()):
                theirs, steps, asked, *sums = _unpack(packed)
                theirs = theirs.split(b" ")
                found = np.fromiter((at.get(w, -1) for w in theirs), dtype=np.int64, count=len(theirs))
                there = found >= 0
                for total, part in zip((c, held, c_once, held_once), sums):
                    total[found[there]] += part[there]
                if asked.any():
                    routes[bucket] = (_steps(np.cumsum(steps.astype(np.int64))[asked]), found[asked].astype(np.uint32))
            context, symbols, starts = spelled(own)
            letters = np.searchsorted(handed.value, context * SYMBOLS + symbols).astype(np.uint32)
            of = rows["of"][0].as_py()
            yield _rows(WORDS, of=of, what=ROSTER, packed=[_pack((own, tokens, c_once, held_once, routes, letters, starts))])
            yield _present_words(of, c if paired else tokens, held, np.ones(len(own), dtype=np.int64), [])

        none = F.lit(None)
        own = words.select((F.crc32("word") % buckets).cast("int").alias("of"), "word", "tokens", none.cast("int").alias("bucket"), none.cast("binary").alias("packed"))
        if paired:
            asking = pairs.asking.select(F.col("to").alias("of"), none.cast("binary").alias("word"), none.cast("long").alias("tokens"), "bucket", "packed")
            own = own.unionByName(asking)
        self.table = write_table(_by(own, "of", enrol, WORDS))
        self.roster = self.table.filter(F.col("what") == ROSTER).select("of", "what", "packed")
        self.present = self.table

    def _rows(self) -> DataFrame:
        present = self.present.filter(F.col("what") == PRESENT).select("of", "what", "packed")
        return self.roster.unionByName(present).withColumn("bucket", F.lit(None).cast("int"))

    def _replace(self, present: DataFrame) -> None:
        if self.present is not self.table:
            discard(self.present)
        self.present = present

    def restaurant(self) -> WordRestaurant:
        c, t, one, two = self.present.agg(*[F.coalesce(F.sum(x), F.lit(0)) for x in ("c", "t", "one", "two")]).first()
        one += self.settled
        return WordRestaurant(c + self.settled, t + self.settled, float(np.clip(one / (one + 2 * two), 0.05, 0.95)) if one else 0.5)

    def reseat(self, model: Spelling, root: WordRestaurant, sweep: int) -> pd.DataFrame:
        """Seats all words anew; returns ``letter, sum``, by place of the character the tables of its words."""
        handed, seed = self._handed(model), self.seed

        def seat_words(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            words, c, held, _, samples = _enrolled(rows)
            of = rows["of"][0].as_py()
            log_p = handed.value
            t = seat(c, (STRENGTH + root.d * root.tables) * np.exp(words.spelling(log_p)), root.d, np.random.default_rng([seed, 2, sweep, of]))
            yield _present_words(of, c, held, t, samples)
            sums = np.bincount(words.letters, weights=np.repeat(t, np.diff(np.append(words.starts, len(words.letters)))), minlength=len(log_p))
            letters = np.flatnonzero(sums)
            yield _rows(WORDS, letter=letters.astype(np.int32), sum=sums[letters].astype(np.int64))

        self._replace(write_table(_by(self._rows(), "of", seat_words, WORDS)))
        # As many rows as there are contexts and symbols, not words.
        return self.present.filter("letter IS NOT NULL").groupBy("letter").agg(F.sum("sum").alias("sum")).toPandas()

    def reseat_pairs(self, model: Spelling, root: WordRestaurant, sweep: int, sample: bool) -> None:
        """Seats the pairs anew, by the words' present probabilities, which a sample keeps; their tables are the customers."""
        handed = self._handed(model)
        tables = None
        if self.pairs is not None:

            def answer(rows: pa.Table) -> Iterator[pa.RecordBatch]:
                words, c, held, t, _ = _enrolled(rows)
                p = root.probability(c, t, words.spelling(handed.value))
                for bucket, (steps, own) in words.routes.items():
                    yield _rows("bucket int, of int, packed binary", bucket=bucket, of=rows["of"][0].as_py(), packed=[_pack((steps, p[own], held[own]))])

            tables = self.pairs.reseat(_by(self._rows(), "of", answer, "bucket int, of int, packed binary"), sweep, sample)

        def sum_up(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            words, c, held, t, samples = _enrolled(rows)
            if sample:
                samples = [*samples, (root.probability(c, t, words.spelling(handed.value)), held)]
            if paired:
                c, held = words.c_once.copy(), words.held_once.copy()
                rows = rows.filter(rows["bucket"].is_valid())
                for bucket, packed in zip(rows["bucket"].to_pylist(), rows["packed"].to_pylist()):
                    _, own = words.routes[bucket]
                    as_word, as_context = _unpack(packed)
                    c[own] += as_word
                    held[own] += as_context
            yield _present_words(words.of, c, held, t, samples)

        paired = tables is not None
        rows = self._rows()
        if paired:
            rows = rows.unionByName(tables.select(F.col("to").alias("of"), F.lit(TABLES).alias("what"), "packed", "bucket"))
        self._replace(write_table(_by(rows, "of", sum_up, WORDS)))

    def learned(self, model: Spelling, root: WordRestaurant, samples: int) -> DataFrame:
        """``word, c`` and by sample ``p`` and ``held``, the last by the present state; written."""
        handed, schema = self._handed(model), _learned_schema(samples)

        def unfold(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            words, c, held, t, kept = _enrolled(rows)
            kept = [*kept, (root.probability(c, t, words.spelling(handed.value)), held)]
            values = {f"{x}{k}": part for k, one in enumerate(kept) for x, part in zip(("p", "held"), one)}
            yield _rows(schema, word=words.words, c=words.tokens, **values)

        learned = write_table(_by(self._rows(), "of", unfold, schema), options=COMPACT)
        self._replace(self.table)
        discard(self.table)
        return learned

    def _handed(self, model: Spelling):
        """The log of the probability of each character of the roster."""
        return self.spark.sparkContext.broadcast(np.log(model.probabilities[-1]))


def _learned_schema(samples: int) -> str:
    return "word binary, c long, " + ", ".join(f"p{k} double, held{k} long" for k in range(samples))


@dataclass
class Enrolled:
    of: int
    words: list[bytes]
    tokens: np.ndarray
    c_once: np.ndarray
    held_once: np.ndarray
    routes: dict[int, tuple[np.ndarray, np.ndarray]]
    letters: np.ndarray
    starts: np.ndarray

    def spelling(self, log_p: np.ndarray) -> np.ndarray:
        return np.add.reduceat(log_p[self.letters], self.starts)


def _enrolled(rows: pa.Table) -> tuple[Enrolled, np.ndarray, np.ndarray, np.ndarray, list]:
    """Of a bucket the words, and their present customers, tables as contexts, tables and samples."""
    packed = dict(zip(rows["what"].to_pylist(), rows["packed"].to_pylist()))
    c, held, t, samples = _unpack(packed[PRESENT])
    return Enrolled(rows["of"][0].as_py(), *_unpack(packed[ROSTER])), c, held, t, samples


def _present_words(of: int, c: np.ndarray, held: np.ndarray, t: np.ndarray, samples: list) -> pa.RecordBatch:
    sums = {"c": c.sum(), "t": t.sum(), "one": (c == 1).sum(), "two": (c == 2).sum()}
    return _rows(WORDS, of=of, what=PRESENT, packed=[_pack((c, held, t, samples))], **{name: int(x) for name, x in sums.items()})


def _characters(words: DataFrame) -> DataFrame:
    """By context and symbol: in how many words that occur once, and in how many others."""

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, sums = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        for batch in batches:
            for start in range(0, len(batch), 20_000):
                rows = batch.iloc[start : start + 20_000]
                context, symbols, starts = spelled(rows["word"].tolist())
                once = np.repeat(rows["c"].to_numpy() == 1, np.diff(np.append(starts, len(symbols))))
                block, n = np.unique((context * SYMBOLS + symbols) * 2 + once, return_counts=True)
                keys, place = np.unique(np.concatenate([keys, block]), return_inverse=True)
                sums = np.bincount(place, weights=np.concatenate([sums, n]), minlength=len(keys)).astype(np.int64)
        yield pd.DataFrame({"key": keys // 2, "once": np.where(keys % 2, sums, 0), "more": np.where(keys % 2, 0, sums)})

    found = words.select("word", "c").mapInPandas(add_up, "key long, once long, more long")
    return found.groupBy("key").agg(F.sum("once").alias("once"), F.sum("more").alias("more")).orderBy("key")


def _sampled(words: DataFrame, burn_in: int, samples: int, seed: int, pairs: Pairs | None = None) -> tuple[DataFrame, list[float]]:
    """From ``word, c``, all ``c`` above 0: ``word, c``, and by sample ``p`` and ``held``; by sample, what is left for other words.

    The customers of words are the tables of ``pairs``, and their tokens where there are none.  A
    word that occurs once has one customer and one table, whatever the seating, and as a context one
    table; its probabilities are worked out once, by the models of all samples.
    """
    rng = np.random.default_rng(seed)
    characters = _characters(words).toPandas()  # as many rows as there are contexts and symbols, not words
    keys, settled, counts = (characters[name].to_numpy(dtype=np.int64) for name in ("key", "once", "more"))
    once = words.filter("c = 1")
    table = Words(words.filter("c > 1").select("word", F.col("c").alias("tokens")), keys, once.count(), pairs, seed)
    model, tables, known = None, [], []
    for sweep in range(burn_in + samples):
        if sweep:
            sums = table.reseat(model, root, sweep)  # noqa: F821
            counts = np.zeros(len(keys), dtype=np.int64)
            counts[sums["letter"].to_numpy()] = sums["sum"]
        model, tables = seat_spelling(keys, settled + counts, model, tables, rng)
        root = table.restaurant()
        if sample := sweep >= burn_in:
            known.append((model, root))
        if sweep < burn_in + samples - 1:
            table.reseat_pairs(model, root, sweep, sample)
            root = table.restaurant()
    learned = table.learned(model, root, samples).unionByName(_predict_settled(once, known, 0 if pairs is None else 1))
    sums = learned.agg(*[F.coalesce(F.sum(f"p{k}"), F.lit(0.0)) for k in range(samples)]).first()
    # The probabilities of all words sum to 1.
    others = [max(1e-12 * root.probability(0, 0, 0.0), 1 - seen) for (_, root), seen in zip(known, sums)]
    return learned, others


def _predict_settled(once: DataFrame, known: list[tuple[Spelling, WordRestaurant]], held: int) -> DataFrame:
    """Words with one customer: ``word, c`` and by model and restaurant ``p`` and the tables ``held``; written."""
    schema = _learned_schema(len(known))
    handed = once.sparkSession.sparkContext.broadcast((known[0][0].keys[-1], [(np.log(model.probabilities[-1]), root) for model, root in known]))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, models = handed.value
        for batch in batches:
            for start in range(0, batch.num_rows, 20_000):
                words = batch.column("word")[start : start + 20_000].to_pylist()
                context, symbols, starts = spelled(words)
                letters = np.searchsorted(keys, context * SYMBOLS + symbols)
                values = {f"held{k}": held for k in range(len(models))}
                for k, (log_p, root) in enumerate(models):
                    values[f"p{k}"] = root.probability(1, 1, np.add.reduceat(log_p[letters], starts))
                yield _rows(schema, word=words, c=1, **values)

    return write_table(once.select("word").mapInArrow(predict, schema), options=COMPACT)


def learn(words: DataFrame, burn_in: int, samples: int, seed: int) -> tuple[DataFrame, int, int, float]:
    """The words without context: ``word, c, log_p``, the tokens, the words, and the log of what is left for others."""
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    sampled, others = _sampled(words, burn_in, samples, seed)
    mean = sum(F.col(f"p{k}") for k in range(samples)) / samples
    return sampled.select("word", "c", F.log(mean).alias("log_p")), n, v, float(np.log(np.mean(others)))


def _scored(bags: DataFrame, pairs: Pairs, learned: DataFrame, others: list[float], n: int, v: int) -> DataFrame:
    """Each text of the chunks by the sampled seatings."""
    samples = len(others)
    back = pairs.back_to_chunks().select("chunk", "bucket", "packed", F.lit(None).cast("int").alias("words"))
    values = _values_of_chunks(bags, learned, samples, pairs.buckets)
    whole = bags.filter(F.col("kind") == CHUNK).select("chunk", "packed")
    least = np.log10(n + SMOOTHING * (v + 1))
    d = pairs.d

    def score(rows: pd.DataFrame) -> pd.DataFrame:
        of_bucket, of_words = rows["bucket"].notna(), rows["words"].notna()
        ids, outs, sizes, after, end, hashes, buckets = _unpack(rows.loc[~of_bucket & ~of_words, "packed"].iat[0])
        tokens = np.zeros(len(hashes), dtype=np.int64)
        held, p = np.zeros((samples, len(hashes))), np.empty((samples, len(hashes)))
        p[:] = np.array(others)[:, None]
        for packed in rows.loc[of_words, "packed"]:
            places, c, part_p, part_held = _unpack(packed)
            tokens[places] = c
            for k in range(samples):
                p[k, places], held[k, places] = part_p[k], part_held[k]
        codes, pair = _pairs_of(after, end, len(hashes))
        first, second = codes // len(hashes), codes % len(hashes)
        bucket = _bucket_of(hashes, first, second, buckets)
        seated = np.zeros((1 + samples, len(codes)), dtype=np.uint32)
        for b, packed in rows.loc[of_bucket, ["bucket", "packed"]].itertuples(index=False):
            seated[:, bucket == b] = _unpack(packed)
        # Every token is the context of one other, the end that of the first in the next text.
        total = np.zeros(len(codes))
        for k in range(samples):
            total += seated[0] - d * seated[1 + k] + (STRENGTH + d * held[k][first]) * p[k][second]
        log_p = np.log10(total / (STRENGTH + tokens[first]) / samples)
        base = np.log10(tokens + SMOOTHING) - least
        starts = np.cumsum(sizes.astype(np.int64)) - sizes
        return pd.DataFrame(
            {
                "doc_id": ids,
                "held_out": outs,
                "n_tokens": sizes.astype(np.int64),
                "n_known": np.add.reduceat((tokens > 0).astype(np.int64)[after], starts),
                "base_score": np.add.reduceat(base[after], starts),
                "score": np.add.reduceat(log_p[pair], starts),
            }
        )

    none = F.lit(None).cast("int")
    rows = whole.select("chunk", none.alias("bucket"), "packed", none.alias("words")).unionByName(back)
    rows = rows.unionByName(values.select("chunk", none.alias("bucket"), "packed", F.lit(1).alias("words")))
    schema = "doc_id string, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    return rows.groupBy("chunk").applyInPandas(score, schema)


def _values_of_chunks(bags: DataFrame, learned: DataFrame, samples: int, buckets: int) -> DataFrame:
    """The dictionaries of chunks: ``chunk, packed``, the places of words that training has, their tokens, probabilities and tables; written."""
    names = [f"p{k}" for k in range(samples)], [f"held{k}" for k in range(samples)]
    schema = "chunk long, packed binary"

    def answer(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        asking = rows.filter(rows["packed"].is_valid())
        rows = rows.filter(rows["packed"].is_null())
        at = {w: i for i, w in enumerate(rows["word"].to_pylist())}
        c, p, held = rows["c"].to_numpy(), [rows[x].to_numpy() for x in names[0]], [rows[x].to_numpy() for x in names[1]]
        for chunk, packed in zip(asking["chunk"].to_pylist(), asking["packed"].to_pylist()):
            words, steps = _unpack(packed)
            words = words.split(b" ")
            found = np.fromiter((at.get(w, -1) for w in words), dtype=np.int64, count=len(words))
            there = found >= 0
            found = found[there]
            content = (np.cumsum(steps.astype(np.int64))[there].astype(np.uint32), c[found], [x[found] for x in p], [x[found] for x in held])
            yield _rows(schema, chunk=chunk, packed=[_pack(content)])

    asking = bags.filter(F.col("kind") == DICTIONARY).select(F.col("bucket").alias("of"), "chunk", "packed")
    known = learned.withColumn("of", (F.crc32("word") % buckets).cast("int"))
    return write_table(_by(known.unionByName(asking, allowMissingColumns=True), "of", answer, schema))


def scores(
    docs: DataFrame, train, held_out, key: str = "doc_id", text: str = "text", burn_in: int = BURN_IN, samples: int = SAMPLES, seed: int = 7
) -> DataFrame:
    """Scores of every whole text by the model and by smoothed word counts.

    ``train`` and ``held_out`` are boolean columns of ``docs``; null counts as false.  Returns ``key,
    held_out, n_tokens, n_known, train_tokens, base_score, score``, scores as log10.  Null and empty
    texts are the end token alone; without training tokens all words are unknown and certain;
    repeated rows count and are scored each; other columns are ignored.
    """
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(train, F.lit(False)).alias("train"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col(text).cast("string").alias("text"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bags = bags_of_pairs(rows, max(LEAST_BUCKETS, -(-size // BUCKET_BYTES)))
    words = write_table(bags.filter(F.col("kind") == ENTRY).groupBy("word").agg(F.sum("n").alias("c")).filter("c > 0"), options=COMPACT)
    discard(bags, f"kind={ENTRY}")
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    pairs = Pairs(bags, seed)
    discard(bags, f"kind={PAIR_BAG}")
    learned, others = _sampled(words, burn_in, samples, seed, pairs)
    discard(words)
    scored = _scored(bags, pairs, learned, others, n, v)
    pairs.discard()
    discard(learned)
    discard(bags, f"kind={DICTIONARY}")
    return scored.select(
        F.col("doc_id").cast("long").alias(key), "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score"
    )
