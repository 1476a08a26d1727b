"""Spelling variants: words one insertion, deletion or replacement apart, by a frequency-vector trie.

Every word has a vector: how often each of ``GROUPS`` groups of letters occurs in it.  The trie
arranges the words by these counts, one group a level.  One edit changes a vector by a surplus of
one in a group, a deficit of one in a group, or both, so the search for the neighbours of a word
descends to the child with the word's own count, to that with one more while the surplus isn't
spent, and to that with one less while the deficit isn't.  The words at the leaves reached are
verified letter by letter.  Of the two words of a pair only the shorter one, or for equal lengths
the smaller one, finds the other, so no search spends a deficit for a longer word.

The trie is spread over the cluster by cells: the length of a word and its first ``depth``
counts, where ``depth`` grows until no cell has more than ``CELL_WORDS`` words.  A word is a
member of its cell and asks in all cells that the budget reaches.  Cells which remain larger are
dealt over salts, at each of which their words ask.  Within a task many words descend together,
in blocks on a stack: the deepest block first, so that memory stays bounded.

Defined results: null texts have no words; a null id counts as an empty one.  Repeated rows count
each.  Of near words equally frequent the first in code-point order is the form.  Empty tables
give empty ones; other columns aren't looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, write_table
from . import bytewords as B

LEAST_LENGTH = 7
NOISE = 31  # one in so many pairs of document and run loses a letter
TASK_WORDS = 400_000  # distinct words that a task counts at a time
GROUPS = 24
SINGLE = 20  # letters with a group of their own; the others share the rest
FREQUENT = "eainrtsoludcmpgbfhvqyjkwxz"  # letters by their frequency, roughly
DEPTHS = (2, 3, 4, 6)
CELL_WORDS = 40_000
TASK_ROWS = 500_000
BLOCK = 100_000  # places of the trie that descend together
TABLE_CELLS = 4_000_000  # of a level of the trie that is laid out as a table
PAIRS = 500_000  # words at the leaves that are verified together
PAIR_CELLS = 2_000_000  # letters compared together
PRINT_BITS = 4  # that one edit changes in the print of a word, at most: two neighbours go, two come

_GROUP = np.array([SINGLE + c % (GROUPS - SINGLE) for c in range(256)], dtype=np.int64)
for _i, _c in enumerate(FREQUENT):
    _GROUP[ord(_c)] = _i if _i < SINGLE else SINGLE + _i % (GROUPS - SINGLE)


# --------------------------------------------------------------------------
# words


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", noise: int = NOISE, least: int = LEAST_LENGTH, twice: int = 2) -> DataFrame:
    """``word, n``: lower-cased runs of letters, one letter deleted where the checksum says so.

    Counts of a task are added up before they are exchanged.
    """
    run = re.compile("[A-Za-zÀ-ÿ]{%d,}" % least)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for key, value in zip(batch["key"], batch["text"]):
                if value is None:
                    continue
                # On bytes only A to Z are lower-cased.
                lowered = value.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
                prefix = zlib.crc32(f"{'' if key is None else key}:".encode())
                for found, n in Counter(run.findall(lowered)).items():
                    h = zlib.crc32(found.encode(), prefix)
                    if h % noise == 0:
                        at = h % len(found)
                        found = found[:at] + found[at + 1 :]
                        if len(found) < least:
                            continue
                    seen[found] += n
                if len(seen) >= TASK_WORDS:
                    yield pd.DataFrame(seen.items(), columns=["word", "n"])
                    seen.clear()
        if seen:
            yield pd.DataFrame(seen.items(), columns=["word", "n"])

    named = docs.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"))
    counted = named.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= twice)


# --------------------------------------------------------------------------
# vectors and cells


class Letters:
    """Words as one array of code points, with their lengths and vectors."""

    def __init__(self, words: Sequence[str]):
        self.lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int32)
        groups = np.where(self.codes < 256, _GROUP[self.codes & 255], SINGLE + self.codes % (GROUPS - SINGLE))
        row = np.repeat(np.arange(len(words)), self.lengths)
        self.vectors = np.bincount(row * GROUPS + groups, minlength=len(words) * GROUPS).reshape(len(words), GROUPS).astype(np.int32)
        self.row = row

    def prints(self) -> np.ndarray:
        """64 bits for the neighbouring letters of each word: one is set if an odd number of pairs falls on it."""
        before = np.where(np.diff(self.row, prepend=-1) == 0, np.roll(self.codes, 1), 0)
        last = np.flatnonzero(np.diff(self.row, append=-1))
        left = np.concatenate([before, self.codes[last]]).astype(np.uint64)
        right = np.concatenate([self.codes, np.zeros(len(last), dtype=np.int32)]).astype(np.uint64)
        row = np.concatenate([self.row, self.row[last]])
        place = B.mix((left << np.uint64(32)) | right) >> np.uint64(58)
        out = np.zeros(len(self.lengths), dtype=np.uint64)
        order = np.argsort(row, kind="stable")
        if len(order):
            firsts = np.flatnonzero(np.diff(row[order], prepend=-1))
            out[row[order][firsts]] = np.bitwise_xor.reduceat(np.uint64(1) << place[order], firsts)
        return out

    def rows(self, words: np.ndarray, width: int) -> np.ndarray:
        """Code points in rows of equal width, 0 and more after the end of a word."""
        at = self.starts[words][:, None] + np.arange(width)
        return self.codes[np.minimum(at, len(self.codes) - 1)]


def cell_keys(lengths: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """A number for a length and the first counts of a vector.

    Cells that happen to share a number are searched together, which changes no result.
    """
    columns = [x.astype(np.uint64) for x in (lengths, *heads.T)]
    return B.combine(columns).astype(np.int64)


def reached(lengths: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, cells and whether a deficit may be spent there, of all cells that the budget reaches."""
    n, depth = heads.shape
    words, cells, deficits = [], [], []

    def visit(change: np.ndarray, longer: int) -> None:
        moved = heads + change
        fine = np.flatnonzero((moved >= 0).all(axis=1))
        words.append(fine)
        cells.append(cell_keys(lengths[fine] + longer, moved[fine]))
        deficits.append(np.full(len(fine), not longer))

    unit = np.eye(depth, dtype=np.int64)
    none = np.zeros(depth, dtype=np.int64)
    for up in (none, *unit):
        visit(up, 1)
        for down in (none, *unit):
            if not (up == down).all() or not up.any():
                visit(up - down, 0)
    words, cells, deficits = map(np.concatenate, (words, cells, deficits))
    # A word asks once in a cell, with the larger budget.
    order = np.lexsort((~deficits, cells, words))
    words, cells, deficits = words[order], cells[order], deficits[order]
    first = np.ones(len(words), dtype=bool)
    first[1:] = (np.diff(words) != 0) | (np.diff(cells) != 0)
    return words[first], cells[first], deficits[first]


def _cell_sizes(words: DataFrame) -> DataFrame:
    """``depth, cell, n`` for each of ``DEPTHS``."""

    def sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            letters = Letters(batch["word"].tolist())
            for depth in DEPTHS:
                cells, n = np.unique(cell_keys(letters.lengths, letters.vectors[:, :depth]), return_counts=True)
                yield pd.DataFrame({"depth": depth, "cell": cells, "n": n})

    return words.select("word").mapInPandas(sizes, "depth int, cell long, n long").groupBy("depth", "cell").agg(F.sum("n").alias("n"))


def _routes(words: DataFrame, depth: int, salts: dict[int, int]) -> DataFrame:
    """``bucket, role, word, n``: members (0) and askers, without (1) and with (2) a deficit to spend."""

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            word, n = batch["word"].to_numpy(), batch["n"].to_numpy()
            letters = Letters(word.tolist())
            heads = letters.vectors[:, :depth]
            own = cell_keys(letters.lengths, heads)
            salt = np.zeros(len(word), dtype=np.int64)
            for i in np.flatnonzero(np.isin(own, list(salts))) if salts else ():
                salt[i] = zlib.crc32(word[i].encode("utf-8", "surrogatepass")) % salts[own[i]]
            yield pd.DataFrame({"bucket": _bucket(own, salt), "role": 0, "word": word, "n": n})
            at, cells, deficits = reached(letters.lengths, heads)
            times = np.fromiter((salts.get(c, 1) for c in cells.tolist()), dtype=np.int64, count=len(cells)) if salts else np.ones(len(cells), dtype=np.int64)
            salt = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            at, cells, deficits = (np.repeat(x, times) for x in (at, cells, deficits))
            yield pd.DataFrame({"bucket": _bucket(cells, salt), "role": 1 + deficits, "word": word[at], "n": n[at]})

    return words.mapInPandas(route, "bucket long, role int, word string, n long")


def _bucket(cells: np.ndarray, salt: np.ndarray) -> np.ndarray:
    return np.where(salt == 0, cells, B.mix(cells.astype(np.uint64) + salt.astype(np.uint64)).astype(np.int64))


# --------------------------------------------------------------------------
# the trie


class VectorTrie:
    """Members below the root of their bucket, by the counts of one group after another.

    Nodes of a level are numbered in order of the node above and the count.  A level is a table
    of both, or, if that were large, the sorted array of the keys made of both.
    """

    def __init__(self, buckets: np.ndarray, vectors: np.ndarray):
        self.roots, node = np.unique(buckets, return_inverse=True)
        self.levels = []
        nodes = len(self.roots)
        for group in range(GROUPS):
            width = int(vectors[:, group].max()) + 1
            keys, below = np.unique(node * width + vectors[:, group], return_inverse=True)
            table = None
            if nodes * width <= TABLE_CELLS:
                table = np.full(nodes * width, -1, dtype=np.int32)
                table[keys] = np.arange(len(keys))
            self.levels.append((width, table, keys))
            node, nodes = below, len(keys)
        self.members = np.argsort(node, kind="stable")
        self.ends = np.cumsum(np.bincount(node, minlength=nodes))

    def child(self, level: int, node: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The children of nodes by count, -1 where there is none."""
        width, table, keys = self.levels[level]
        fits = (count >= 0) & (count < width)
        wanted = np.where(fits, node.astype(np.int64) * width + count, 0)
        if table is not None:
            found = table[wanted]
        else:
            found = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            found[keys[found] != wanted] = -1
        found[~fits] = -1
        return found

    def leaves(self, buckets: np.ndarray, vectors: np.ndarray, deficit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Askers and the leaves they reach: depth first, block by block."""
        root = np.searchsorted(self.roots, buckets)
        at = np.flatnonzero((root < len(self.roots)) & (self.roots[np.minimum(root, len(self.roots) - 1)] == buckets))
        at = at[np.argsort(root[at], kind="stable")]
        stack = [(0, at, root[at].astype(np.int32), np.ones(len(at), dtype=bool), deficit[at])]
        while stack:
            level, asker, node, more, less = stack.pop()
            if len(asker) > BLOCK:
                half = len(asker) // 2
                stack += [(level, *(x[:half] for x in (asker, node, more, less))), (level, *(x[half:] for x in (asker, node, more, less)))]
                continue
            if level == GROUPS:
                yield asker, node
                continue
            count = vectors[asker, level]
            found = []
            for step, may in ((0, None), (1, more), (-1, less)):
                if may is None:
                    child = self.child(level, node, count)
                    kept = np.flatnonzero(child >= 0)
                    child = child[kept]
                else:
                    kept = np.flatnonzero(may)
                    child = self.child(level, node[kept], count[kept] + step)
                    kept, child = kept[child >= 0], child[child >= 0]
                found.append((asker[kept], child, more[kept] & (step != 1), less[kept] & (step != -1)))
            merged = [np.concatenate(x) for x in zip(*found)]
            if len(merged[0]):
                stack.append((level + 1, *merged))


def one_edit(a: np.ndarray, a_length: np.ndarray, b: np.ndarray, b_length: np.ndarray) -> np.ndarray:
    """Are words b one replacement away from words a, or one insertion longer?

    Rows of code points; ``b`` has one column more than ``a``.
    """
    place = np.arange(a.shape[1])
    inside = place < a_length[:, None]
    unlike = (a != b[:, :-1]) & inside
    shifted = (a != b[:, 1:]) & inside
    # The first unlike letter; from there on b must be a, one place later.
    first = np.where(unlike.any(axis=1), unlike.argmax(axis=1), a_length)
    inserted = ~(shifted & (place >= first[:, None])).any(axis=1)
    return np.where(a_length == b_length, unlike.sum(axis=1) == 1, (a_length + 1 == b_length) & inserted)


class Members:
    """The members of some buckets, ready to be asked."""

    def __init__(self, rows: pd.DataFrame):
        self.words, self.n = rows["word"].to_numpy(), rows["n"].to_numpy()
        self.letters = Letters(self.words.tolist())
        self.prints = self.letters.prints()
        self.trie = VectorTrie(rows["bucket"].to_numpy(), self.letters.vectors)

    def near(self, rows: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of askers in ``rows`` (bucket, role, word) and of the members one edit away, each pair once."""
        words = rows["word"].to_numpy()
        letters = Letters(words.tolist())
        prints = letters.prints()
        trie = self.trie
        for who, leaf in trie.leaves(rows["bucket"].to_numpy(), letters.vectors, rows["role"].to_numpy() == 2):
            last = trie.ends[leaf]
            size = last - np.where(leaf > 0, trie.ends[leaf - 1], 0)
            upto = np.cumsum(size)
            for begin in range(0, int(upto[-1]) if len(upto) else 0, PAIRS):
                # Some of the words at the leaves, as a running number over all leaves.
                number = np.arange(begin, min(begin + PAIRS, int(upto[-1])))
                at = np.searchsorted(upto, number, side="right")
                x, y = who[at], trie.members[last[at] - upto[at] + number]
                alike = np.bitwise_count(prints[x] ^ self.prints[y]) <= PRINT_BITS
                yield from self._verified(words, letters, x[alike], y[alike])

    def _verified(self, words: np.ndarray, letters: Letters, x: np.ndarray, y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if not len(x):
            return
        width = int(letters.lengths[x].max()) + 1
        step = max(1, PAIR_CELLS // width)
        for some in range(0, len(x), step):
            a, b = x[some : some + step], y[some : some + step]
            near = one_edit(letters.rows(a, width), letters.lengths[a], self.letters.rows(b, width + 1), self.letters.lengths[b])
            a, b = a[near], b[near]
            # Of two words of one length the smaller one finds the other.
            right = (letters.lengths[a] < self.letters.lengths[b]) | (words[a] < self.words[b])
            yield a[right], b[right]


def near_words(words: DataFrame) -> DataFrame:
    """``word, near, near_n`` for all words (``word, n``, distinct) and those one edit away."""
    sizes = cut_lineage(_cell_sizes(words))
    found = sizes.groupBy("depth").agg(F.max("n").alias("largest"), F.sum("n").alias("words")).orderBy("depth").collect()
    if not found:
        return words.select("word", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    depth = next((r["depth"] for r in found if r["largest"] <= CELL_WORDS), DEPTHS[-1])
    # At most one cell for each CELL_WORDS words is on this list.
    large = sizes.filter((F.col("depth") == depth) & (F.col("n") > CELL_WORDS)).collect()
    salts = {r["cell"]: -(-r["n"] // CELL_WORDS) for r in large}
    spark = words.sparkSession
    rows = found[0]["words"] * (3 + 2 * depth + depth * depth)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, members = [], None
        for batch in batches:
            asks = batch["role"].to_numpy() > 0
            if not asks.all():
                held.append(batch[~asks])
            if not asks.any() or not held:
                continue
            if members is None:
                # Members come first, so all of them are here.
                members = Members(pd.concat(held, ignore_index=True))
            rows = batch[asks]
            word, n = rows["word"].to_numpy(), rows["n"].to_numpy()
            for a, b in members.near(rows):
                yield pd.DataFrame(
                    {
                        "word": np.concatenate([word[a], members.words[b]]),
                        "near": np.concatenate([members.words[b], word[a]]),
                        "near_n": np.concatenate([members.n[b], n[a]]),
                    }
                )

    routed = _routes(words, depth, salts).repartition(parts, "bucket").sortWithinPartitions("role")
    return routed.mapInPandas(find, "word string, near string, near_n long")


def roots(links: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form``: forms followed to the last.

    Each turn doubles the steps taken.  A form is ten times as frequent as its word, so chains
    are short and never close.
    """
    found = cut_lineage(links.select("word", F.col("form").alias("root")))
    while True:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = cut_lineage(found.join(further, "root", "left").select("word", "root", "next"))
        moved = step.filter(F.col("next").isNotNull())
        if moved.isEmpty():
            return found
        found = step.select("word", F.coalesce("next", "root").alias("root"))


def variant_groups(words: DataFrame, ratio: int = 10) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of distinct words with their counts ``n``."""
    words = write_table(words.select("word", "n"))
    # The most frequent near word, of equally frequent ones the first.
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    has = -F.col("best.less") >= ratio * F.col("n")
    formed = write_table(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has, F.col("best.form")).alias("form"),
            F.when(has, -F.col("best.less")).alias("form_n"),
        )
    )
    ends = roots(formed.filter(F.col("form").isNotNull()))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
