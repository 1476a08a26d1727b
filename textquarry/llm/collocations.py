"""Phrase collocations: counts of word sequences in burst tries, scored where they hold together least.

Texts are split into pieces and words; phrases lie within a piece, and everything is per language.
A phrase is frequent only if all its parts are.  So a first pass counts words; a second one adds up
the counts of pairs of frequent words by hash alone, which takes a few bytes a pair; the third pass
counts the phrases of two to four words all pairs of which may be frequent.  The passes hand on
Bloom filters sized by what they hold.  A hash or a filter can only let through too much, which
costs time and is dropped by its count in the end.

In the third pass a task counts in a ``BurstTrie``: below the number of a phrase's first word lies a hash container
of the phrases' rests, and a container of more than ``BURST`` entries bursts into one for each
next word.  When the trie has ``TRIE_ENTRIES`` entries its heaviest subtrees are spilled whole, as
sorted runs of phrases and counts.  Runs are exchanged, packed, by prefix, the first two words of a
phrase, and merged in each partition of prefixes.

The score of a phrase is that of its worst cut in two: ``scale * a / (l + r)``, rounded down, with
the counts of the phrase and of both parts.  All of it is computed in whole decimal numbers.

Defined results: null texts have no words; a null language is ``und``, like a language of that
name.  Repeated rows count each.  Ties end in the order of the phrases' bytes.  Empty tables give
empty ones; other columns aren't looked at.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import bytewords as B
from .blooms import bloom, in_bloom
from .jaccard import written

UNDETERMINED = "und"
LONGEST = 4
LEAST = 30
SCALE = 2_000_000
KEPT_PERCENT = 80
TOP = 2000
BURST = 2048
TRIE_ENTRIES = 300_000
TASK_WORDS = 400_000  # words that a task numbers at a time
SLICE_BYTES = 1 << 21
PAIR_BITS = 40  # of the hash of a pair of words
TASK_PAIRS = 6_000_000  # that a task adds up at a time, some 50 MB
RANGE_PAIRS = 2_000_000  # of all words to a range of hashes, about
HOT_SHARE = 1000  # a part with more than one in so many occurrences of all words is salted
SALTS = 32

_BREAK = 0xFF  # never in UTF-8
_DIGIT = 20  # bits of a word's number in a packed phrase
_CLEAN = bytearray(B.LOWER)
for _c in b".,;:!?\n\x0b\x0c\r":
    _CLEAN[_c] = _BREAK
_CLEAN[9] = 32
_CLEAN = bytes(_CLEAN)


# --------------------------------------------------------------------------
# words of a task


def cleaned(raw: bytes, limit: int | None = None) -> Iterator[bytes]:
    """A lower-cased text with a break byte between pieces, in parts that end with one."""
    data, limit = raw.translate(_CLEAN), limit or SLICE_BYTES
    at = 0
    while at < len(data):
        end = data.find(b"\xff", at + limit) if len(data) - at > limit else -1
        end = len(data) if end < 0 else end + 1
        yield data[at:end]
        at = end


def parts_by_language(batch: pd.DataFrame) -> Iterator[tuple[str, list[bytes]]]:
    """Words of a language, breaks among them, some megabytes of text at a time."""
    for lang, texts in batch.groupby("lang", sort=True)["text"]:
        held, size = [], 0
        for text in texts:
            for part in cleaned((text or "").encode("utf-8", "surrogatepass")):
                held.append(part)
                size += len(part)
                if size >= SLICE_BYTES:
                    yield lang, b"\xff".join(held).replace(b"\xff", b" \xff ").split(b" ")
                    held, size = [], 0
        if held:
            yield lang, b"\xff".join(held).replace(b"\xff", b" \xff ").split(b" ")


class Numbers(dict):
    """Numbers words as they come; a break is -1 and the empty bytes between separators -2."""

    def __init__(self):
        super().__init__({b"\xff": -1, b"": -2})
        self.words: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.words)
        self.words.append(word)
        return n

    def of(self, words: list[bytes]) -> np.ndarray:
        found = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        return found[found != -2]


def word_hash(lang: str, word: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(lang.encode() + b"\0" + word)


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of ``PAIR_BITS`` bits of pairs of words."""
    return B.combine([left, right]) >> np.uint64(64 - PAIR_BITS)


class Vocabulary:
    """Words of one language as a task meets them, with their hashes."""

    def __init__(self, lang: str):
        self.lang, self.numbers, self.hashes = lang, Numbers(), np.empty(0, dtype=np.uint64)

    def read(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and hashes of words; a break is -1, with any hash."""
        ids = self.numbers.of(words)
        new = self.numbers.words[len(self.hashes) :]
        if new:
            self.hashes = np.concatenate([self.hashes, np.array([word_hash(self.lang, w) for w in new], dtype=np.uint64)])
        if not len(self.hashes):
            return ids, np.zeros(len(ids), dtype=np.uint64)
        return ids, self.hashes[np.maximum(ids, 0)]


# --------------------------------------------------------------------------
# filters


def word_keys(words: DataFrame) -> DataFrame:
    """``key`` of ``lang, phrase`` rows of one word."""

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [word_hash(lang, w.encode("utf-8", "surrogatepass")) for lang, w in zip(batch["lang"], batch["phrase"])]
            yield pd.DataFrame({"key": np.array(found, dtype=np.uint64).astype(np.int64)})

    return words.select("lang", "phrase").mapInPandas(keys, "key long")


# --------------------------------------------------------------------------
# pairs by hash


def pack_counts(keys: np.ndarray, counts: np.ndarray) -> tuple[int, bytes, bytes]:
    """Sorted distinct keys as the first one and the bytes of the steps, plane by plane, and counts up to 255."""
    steps = np.diff(keys).astype("<u8").view(np.uint8).reshape(-1, 8)[:, : PAIR_BITS // 8]
    return int(keys[0]), np.ascontiguousarray(steps.T).tobytes(), np.minimum(counts, 255).astype(np.uint8).tobytes()


def unpack_counts(first: int, steps: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(steps, dtype=np.uint8).reshape(PAIR_BITS // 8, -1).astype(np.uint64)
    total = np.zeros(planes.shape[1] + 1, dtype=np.uint64)
    total[0] = first
    for k, plane in enumerate(planes):
        total[1:] += plane << np.uint64(8 * k)
    return np.cumsum(total), np.frombuffer(counts, dtype=np.uint8)


def frequent_pairs(docs: DataFrame, filled: np.ndarray, least: int, total: int) -> DataFrame:
    """``key`` of each pair of frequent words, and of what shares its hash, that may be frequent.

    Tasks add up their pairs and exchange them by ranges of the hash, packed: a count of 255 stands
    for more.
    """
    handed = docs.sparkSession.sparkContext.broadcast(filled)
    ranges = 1
    while (1 << ranges) * RANGE_PAIRS < total:
        ranges += 1
    shift = np.uint64(PAIR_BITS - ranges)

    def packed(held: list[np.ndarray]) -> Iterator[pd.DataFrame]:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        cuts = np.flatnonzero(np.diff(keys >> shift)) + 1
        rows = [(int(k[0] >> shift), *pack_counts(k, n)) for k, n in zip(np.split(keys, cuts), np.split(counts, cuts)) if len(k)]
        yield pd.DataFrame(rows, columns=["part", "first", "steps", "counts"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filled = handed.value
        known: dict[str, Vocabulary] = {}
        held, size = [], 0
        for batch in batches:
            for lang, words in parts_by_language(batch):
                vocabulary = known.setdefault(lang, Vocabulary(lang))
                ids, hashes = vocabulary.read(words)
                word = ids >= 0
                word[word] = in_bloom(filled, hashes[word])
                at = np.flatnonzero(word[:-1] & word[1:])
                held.append(pair_keys(hashes[at], hashes[at + 1]))
                size += len(at)
                if size >= TASK_PAIRS:
                    yield from packed(held)
                    held, size = [], 0
                if len(vocabulary.hashes) >= TASK_WORDS:
                    del known[lang]
        if size:
            yield from packed(held)

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        blocks = [unpack_counts(*r) for r in zip(rows["first"], rows["steps"], rows["counts"])]
        keys, place = np.unique(np.concatenate([k for k, _ in blocks]), return_inverse=True)
        sums = np.bincount(place, weights=np.concatenate([n for _, n in blocks]))
        return pd.DataFrame({"key": keys[sums >= least].astype(np.int64)})

    if least > 255:
        raise ValueError("counts of pairs are kept up to 255")
    blocks = docs.mapInPandas(count, "part int, first long, steps binary, counts binary")
    return blocks.groupBy("part").applyInPandas(merge, "key long")


# --------------------------------------------------------------------------
# counting


class BurstTrie:
    """Counts of phrases: a node for each prefix that burst, hash containers of packed rests below.

    A rest is packed as the numbers of its words plus one, the first one in the highest digit.
    """

    def __init__(self):
        self.root: dict[int, dict] = {}
        self.entries = 0

    def add(self, firsts: np.ndarray, rests: np.ndarray, counts: np.ndarray) -> None:
        """Adds distinct phrases, sorted by their first word."""
        edges = np.flatnonzero(np.diff(firsts, prepend=-1)).tolist()
        heads = firsts[edges].tolist()
        rests, counts = rests.tolist(), counts.tolist()
        root = self.root
        for head, a, b in zip(heads, edges, [*edges[1:], len(rests)]):
            top = root.get(head)
            if top is None:
                top = root[head] = {}
            if isinstance(top, Node):
                for rest, n in zip(rests[a:b], counts[a:b]):
                    self.entries += top.add(rest, n)
                continue
            before = len(top)
            for rest, n in zip(rests[a:b], counts[a:b]):
                top[rest] = top.get(rest, 0) + n
            self.entries += len(top) - before
            if len(top) > BURST:
                root[head] = Node(top)

    def spill(self, share: float) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """Takes whole subtrees out, the heaviest first, until so much of the entries has gone; each as a sorted run."""
        weights = sorted(((len(t) if isinstance(t, dict) else t.size(), head) for head, t in self.root.items()), reverse=True)
        left = self.entries * (1 - share)
        for size, head in weights:
            if self.entries <= left:
                return
            tree = self.root.pop(head)
            self.entries -= size
            yield head, sorted(tree.items())


class Node:
    """A burst container: one container, or node, for each next word, and the phrase that ends here."""

    __slots__ = ("below", "own")

    def __init__(self, container: dict[int, int]):
        self.below: dict[int, dict] = {}
        self.own = 0
        for rest, n in container.items():
            self.add(rest, n)

    def add(self, rest: int, n: int) -> int:
        """Returns how many entries are new."""
        if not rest:
            new, self.own = not self.own, self.own + n
            return int(new)
        shift = (rest.bit_length() - 1) // _DIGIT * _DIGIT
        head, rest = rest >> shift, rest & ((1 << shift) - 1)
        below = self.below.get(head)
        if below is None:
            below = self.below[head] = {}
        if isinstance(below, Node):
            return below.add(rest, n)
        before = len(below)
        below[rest] = below.get(rest, 0) + n
        if len(below) > BURST:
            self.below[head] = Node(below)
        return len(below) - before

    def size(self) -> int:
        return bool(self.own) + sum(len(t) if isinstance(t, dict) else t.size() for t in self.below.values())

    def items(self) -> Iterator[tuple[int, int]]:
        if self.own:
            yield 0, self.own
        for head, tree in self.below.items():
            for rest, n in tree.items():
                digits = -(-rest.bit_length() // _DIGIT)
                yield head << (digits * _DIGIT) | rest, n


def phrase_rows(ids: np.ndarray, kept: np.ndarray, sizes: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """First words, packed rests and counts of the phrases of some sizes, distinct and sorted by first word.

    ``kept[i]``: may the words i and i + 1 stand in a phrase together?
    """
    for size in sizes:
        n = len(ids) - size + 1
        if n <= 0:
            continue
        fine = kept[:n].copy()
        for k in range(1, size - 1):
            fine &= kept[k : k + n]
        at = np.flatnonzero(fine)
        if not len(at):
            continue
        rests = np.zeros(len(at), dtype=np.int64)
        for k in range(1, size):
            rests = (rests << _DIGIT) | (ids[at + k] + 1)
        firsts = ids[at]
        order = np.lexsort((rests, firsts))
        firsts, rests = firsts[order], rests[order]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(firsts) != 0) | (np.diff(rests) != 0)]))
        yield firsts[new], rests[new], np.diff(np.append(new, len(firsts)))


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang, phrase, n`` of all words."""

    def rows(seen: dict[str, Counter]) -> Iterator[pd.DataFrame]:
        for lang, counts in seen.items():
            counts.pop(b"\xff", None)
            counts.pop(b"", None)
            if counts:
                words = [w.decode("utf-8", "surrogatepass") for w in counts]
                yield pd.DataFrame({"lang": lang, "phrase": words, "n": list(counts.values())})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, Counter] = {}
        for batch in batches:
            for lang, words in parts_by_language(batch):
                seen.setdefault(lang, Counter()).update(words)
                if sum(map(len, seen.values())) >= TASK_WORDS:
                    yield from rows(seen)
                    seen = {}
        yield from rows(seen)

    counted = docs.mapInPandas(count, "lang string, phrase string, n long")
    return counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def pack_run(run: list[tuple[bytes, int]]) -> tuple[bytes, bytes]:
    """Phrases in order, which have much in common with their neighbours, and their counts; no word holds a line feed."""
    import zstandard

    run.sort()
    pack = zstandard.ZstdCompressor(level=1).compress
    return pack(b"\n".join([phrase for phrase, _ in run])), pack(np.array([n for _, n in run], dtype=np.int64).tobytes())


def unpack_run(phrases: bytes, counts: bytes) -> Iterator[tuple[bytes, int]]:
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    return zip(unpack(phrases).split(b"\n"), np.frombuffer(unpack(counts), dtype=np.int64).tolist())


def phrase_counts(docs: DataFrame, filled: np.ndarray, sizes: tuple[int, ...], least: int, total: int) -> DataFrame:
    """``lang, phrase, n`` of phrases that are frequent; a filter holds all their pairs of words.

    Runs go to parts by the first two words of their phrases; the number of parts grows with the
    words, so that a part has no more than a task can merge.
    """
    parts = max(1, -(-total // RANGE_PAIRS))
    handed = docs.sparkSession.sparkContext.broadcast(filled)

    def runs(lang: str, words: list[bytes], trie: BurstTrie, share: float) -> Iterator[pd.DataFrame]:
        """What the trie spills, as a sorted run for each part."""
        held: dict[int, list[tuple[bytes, int]]] = {}
        mask = (1 << _DIGIT) - 1
        for head, run in trie.spill(share):
            first = words[head]
            for rest, n in run:
                digits = -(-rest.bit_length() // _DIGIT)
                own = [words[(rest >> k * _DIGIT & mask) - 1] for k in range(digits - 1, -1, -1)]
                part = zlib.crc32(own[0], zlib.crc32(first)) % parts
                held.setdefault(part, []).append((b" ".join([first, *own]), n))
        rows = [(part, lang, *pack_run(run)) for part, run in held.items()]
        yield pd.DataFrame(rows, columns=["part", "lang", "phrases", "counts"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filled = handed.value
        held: dict[str, tuple[Vocabulary, BurstTrie]] = {}
        for batch in batches:
            for lang, words in parts_by_language(batch):
                vocabulary, trie = held.setdefault(lang, (Vocabulary(lang), BurstTrie()))
                ids, hashes = vocabulary.read(words)
                pairs = (ids[:-1] >= 0) & (ids[1:] >= 0)
                at = np.flatnonzero(pairs)
                pairs[at] = in_bloom(filled, pair_keys(hashes[at], hashes[at + 1]))
                for found in phrase_rows(ids, pairs, sizes):
                    trie.add(*found)
                    # The tries of all languages have TRIE_ENTRIES entries together at most.
                    while sum(t.entries for _, t in held.values()) > TRIE_ENTRIES:
                        heaviest = max(held, key=lambda x: held[x][1].entries)
                        yield from runs(heaviest, held[heaviest][0].numbers.words, held[heaviest][1], 0.5)
                if len(vocabulary.hashes) >= TASK_WORDS:
                    yield from runs(lang, vocabulary.numbers.words, trie, 1.0)
                    del held[lang]
        for lang, (vocabulary, trie) in held.items():
            yield from runs(lang, vocabulary.numbers.words, trie, 1.0)

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        sums: dict[tuple[str, bytes], int] = {}
        for lang, phrases, counts in zip(rows["lang"], rows["phrases"], rows["counts"]):
            for phrase, n in unpack_run(phrases, counts):
                key = (lang, phrase)
                sums[key] = sums.get(key, 0) + n
        frequent = [(lang, phrase.decode("utf-8", "surrogatepass"), n) for (lang, phrase), n in sums.items() if n >= least]
        return pd.DataFrame(frequent, columns=["lang", "phrase", "n"])

    spilled = docs.mapInPandas(count, "part int, lang string, phrases binary, counts binary")
    return spilled.groupBy("part").applyInPandas(merge, "lang string, phrase string, n long")


# --------------------------------------------------------------------------
# scores


def _part(phrase_words: Column, first: Column, size: Column) -> Column:
    return F.array_join(F.slice(phrase_words, first, size), " ")


def _part_counts(candidates: DataFrame, frequent: DataFrame, total: int) -> DataFrame:
    """``lang, phrase, cut, left, n``: the counts of both parts of each cut of each candidate.

    At most ``LONGEST * HOT_SHARE`` parts can have more than one in ``HOT_SHARE`` of all
    occurrences.  They are the only ones which many candidates can have in common; their rows are
    repeated for each salt.
    """
    words = F.split("phrase", " ")
    cut = candidates.select("lang", "phrase", words.alias("w"), F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("cut"))
    left = F.struct(F.lit(True).alias("left"), _part(F.col("w"), F.lit(1), F.col("cut")).alias("part"))
    right = F.struct(F.lit(False).alias("left"), _part(F.col("w"), F.col("cut") + 1, F.size("w") - F.col("cut")).alias("part"))
    asked = cut.select("lang", "phrase", "cut", F.inline(F.array(left, right)))
    counts = frequent.select("lang", F.col("phrase").alias("part"), "n", (F.col("n") > total // HOT_SHARE).alias("hot"))
    hot = F.broadcast(counts.filter("hot").select("lang", "part", "hot"))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).otherwise(0).cast("int")
    salted = asked.join(hot, ["lang", "part"], "left").withColumn("salt", salt).drop("hot")
    repeated = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.when(F.col("hot"), SALTS - 1).otherwise(0)))).drop("hot")
    return salted.join(repeated, ["lang", "part", "salt"]).select("lang", "phrase", "cut", "left", "n")


def scored(candidates: DataFrame, frequent: DataFrame, total: int, scale: int, longest: int) -> DataFrame:
    """``lang, phrase, a, cut, l, r, score`` by the worst cut of each candidate, ties to the earliest."""
    parts = _part_counts(candidates, frequent, total)
    sides = [
        F.max(F.when((F.col("cut") == k) & (F.col("left") == side), F.col("n"))).alias(f"{'l' if side else 'r'}{k}")
        for k in range(1, longest)
        for side in (True, False)
    ]
    found = parts.groupBy("lang", "phrase").agg(*sides).join(candidates.withColumnRenamed("n", "a"), ["lang", "phrase"])
    cuts = [
        F.when(
            F.col(f"l{k}").isNotNull(),
            F.struct(
                F.expr(f"(cast(a as decimal(20,0)) * {scale}) div (cast(l{k} as decimal(20,0)) + r{k})").alias("score"),
                F.lit(k).alias("cut"),
                F.col(f"l{k}").alias("l"),
                F.col(f"r{k}").alias("r"),
            ),
        )
        for k in range(1, longest)
    ]
    worst = F.array_min(F.filter(F.array(*cuts), lambda c: c.isNotNull()))
    return found.select("lang", "phrase", "a", worst.alias("worst")).select("lang", "phrase", "a", "worst.*")


def covered(candidates: DataFrame, longest: int) -> DataFrame:
    """``lang, phrase, cover``: the count of the most frequent longer candidate that holds the phrase."""
    words = F.split("phrase", " ")
    longer = candidates.select("lang", "n", words.alias("w")).filter(F.size("w") > 2)
    runs = [
        F.when(F.size("w") > size, F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1))), lambda i: _part(F.col("w"), i, F.lit(size))))
        for size in range(2, longest)
    ]
    inside = F.explode(F.flatten(F.filter(F.array(*runs), lambda r: r.isNotNull())))
    return longer.select("lang", "n", inside.alias("phrase")).groupBy("lang", "phrase").agg(F.max("n").alias("cover"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, scale: int = SCALE, kept_percent: int = KEPT_PERCENT, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` and ``cut``: the first phrases of each language."""
    named = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNDETERMINED)).alias("lang"), F.col(text).cast("string").alias("text"))
    # With small Arrow batches, as a task holds a batch of whole texts.
    words = written(word_counts(named))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    singles = words.filter(F.col("n") >= least)
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    pairs = written(frequent_pairs(named, bloom(word_keys(singles)), least, total))
    candidates = written(phrase_counts(named, bloom(pairs), tuple(range(2, LONGEST + 1)), least, total))
    known = scored(candidates, singles.unionByName(candidates), total, scale, LONGEST)
    hidden = covered(candidates, LONGEST)
    big = "decimal(20,0)"
    shown = (
        known.join(hidden, ["lang", "phrase"], "left")
        .filter(F.col("cover").isNull() | (F.col("cover").cast(big) * 100 < F.col("a").cast(big) * kept_percent))
        .drop("cover")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = cut_lineage(shown.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top))
    # Languages are few, but nothing bounds them: joined by what is small, the totals or the first phrases.
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", F.col("cut").cast("long"))
