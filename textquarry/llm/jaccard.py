"""Near-duplicate documents: a blocked sparse product of the document by shingle incidence matrix.

Rows of the matrix are distinct shingle sets (documents with equal sets are one row), columns
are shingles.  Two rows of similarity t share a column within their prefixes: the first
``n - ceil(t n) + 1`` of a row's n columns, in any order that is the same for all rows.  The
order puts columns that many rows have last, then goes by hash, so that common passages hardly
ever are in a prefix.  Only prefix columns are multiplied out, and a product that the sizes of
two rows and the places of the shared column bound below the threshold is discarded at once.

Columns are worked on in blocks of rows, and overlaps are accumulated per pair of rows.  Similar
rows share many columns of their prefixes, how many at least follows from their sizes, and pairs
with less are discarded, as are those whose sketches, a bit or two for each column, differ in too
many bits; the others are compared in full, from their texts.  The first block of
a column is one row: each row is compared with the one that it shares most columns with.  That
joins most groups of near copies, whose members needn't be compared with each other any more.
The next blocks hold 8, 64, 512, ... rows of a column, and only rows of different components are
multiplied, until the largest column that still has any is exhausted.  No column is capped and
no link between components can be missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_table
from . import bytewords as B
from .blooms import bloom, in_bloom
from .graph import components

SHINGLE = 5
PERCENT = 80
LOCAL_COMMON = 4  # times that a shingle must occur in a task to be counted as perhaps common
LOCAL_SHINGLES = 4_000_000  # that a task counts at a time, 32 MB
COMMON = 64  # documents in which a shingle counts as common
COMMON_BITS = 1 << 22  # half a megabyte, whatever the size of the corpus
SALTS = 16  # over which the rows that are compared with one row are spread
BLOCK_GROWTH = 8
ARROW_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}
BROADCAST_ROWS = 1_000_000  # of ids, about 16 MB


def shingle_sets(texts, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Place and sorted distinct shingle hashes of each text; a shorter text is one shingle."""
    for first, raws in B.slices(texts):
        hashes, counts = B.word_hashes(raws, B.SPACES)
        rolled = B.rolling(hashes, size)
        ends = np.cumsum(counts)
        for k, (start, end) in enumerate(zip(ends - counts, ends)):
            n = end - start
            if n >= size:
                yield first + k, np.unique(rolled[start : end - size + 1])
            elif n:
                yield first + k, B.rolling(hashes[start:end], int(n))
            else:
                yield first + k, rolled[:0]


def sketch_of(shingles: np.ndarray) -> np.ndarray:
    """A bit for each place, about as many as shingles: set if an odd number of them falls on it.

    Two sets differ in at least as many shingles as their sketches in bits.  The number of bits is
    a power of two; a sketch of half as many is the exclusive or of both halves.
    """
    bits = max(64, 1 << (len(shingles) - 1).bit_length())
    places = (B.mix(shingles) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(places, minlength=bits).astype(np.uint8) & 1, bitorder="little").view(np.int64)


def set_id(shingles: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


# --------------------------------------------------------------------------
# passes over the texts


def written(df: DataFrame) -> DataFrame:
    """Written with small Arrow batches: rows hold one or two whole texts, and a worker holds a batch of them."""
    conf = df.sparkSession.conf
    before = {key: conf.get(key) for key in ARROW_BATCH}
    try:
        for key, value in ARROW_BATCH.items():
            conf.set(key, value)
        return write_table(df)
    finally:
        for key, value in before.items():
            conf.set(key, value)


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def repeated(values: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The values that occur ``least`` times or more, and how often; sorts in place and copies those only."""
    values.sort()
    far = least - 1
    often = values[far:] == values[: max(0, len(values) - far)]
    found = np.unique(values[: len(often)][often])
    return found, np.searchsorted(values, found, side="right") - np.searchsorted(values, found, side="left")


def digests(docs: DataFrame, size: int) -> DataFrame:
    """Per document ``doc_id, node, n``, and rows ``shingle, n`` of what a task has often."""

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, held = np.empty(LOCAL_SHINGLES, dtype=np.uint64), 0
        for batch in batches:
            nodes, sizes = [], []
            for _, shingles in shingle_sets(batch["text"].tolist(), size):
                nodes.append(set_id(shingles))
                sizes.append(len(shingles))
                while len(shingles):
                    part = shingles[: len(seen) - held]
                    seen[held : held + len(part)] = part
                    held, shingles = held + len(part), shingles[len(part) :]
                    if held == len(seen):
                        yield often(seen)
                        held = 0
            yield pd.DataFrame({"doc_id": batch["doc_id"], "node": nodes, "n": sizes, "shingle": None})
        if held:
            yield often(seen[:held])

    def often(seen: np.ndarray) -> pd.DataFrame:
        shingles, counts = repeated(seen, LOCAL_COMMON)
        return pd.DataFrame({"doc_id": None, "node": None, "n": counts, "shingle": shingles.astype(np.int64)})

    # Ids as text: a column of longs with nulls would come as floats.
    named = docs.withColumn("doc_id", F.col("doc_id").cast("string"))
    found = named.mapInPandas(digest, "doc_id string, node long, n long, shingle long")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def filter_places(shingles: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places of each shingle in the filter of common shingles."""
    mixed = B.mix(shingles)
    return (mixed % np.uint64(bits)).astype(np.int64), ((mixed >> np.uint64(32)) % np.uint64(bits)).astype(np.int64)


def shingle_filter(shingles: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter, as booleans, of a table of shingles.

    Its size is fixed, whatever the table's.  It only decides what is looked at first or at all
    without need: what it holds wrongly costs time, no link.
    """

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"place": np.concatenate(filter_places(batch["shingle"].to_numpy().astype(np.uint64), bits))})

    filled = np.zeros(bits, dtype=bool)
    for batch in shingles.select("shingle").mapInPandas(places, "place int").distinct().toArrow().to_batches():
        filled[batch.column(0).to_numpy()] = True
    return filled


def common_shingles(rows: DataFrame, least: int) -> DataFrame:
    """The shingles that tasks together have seen in at least ``least`` documents."""
    return rows.filter(F.col("shingle").isNotNull()).groupBy("shingle").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def prefixes(docs: DataFrame, size: int, percent: int, common: np.ndarray) -> DataFrame:
    """``node, n, prefix, sketch``: the prefix of each document's shingles in the common order, and their sketch."""
    packed = docs.sparkSession.sparkContext.broadcast(np.packbits(common))
    bits = len(common)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        common = np.unpackbits(packed.value, count=bits).view(bool)
        for batch in batches:
            rows = []
            for place, shingles in shingle_sets(batch["text"].tolist(), size):
                if n := len(shingles):
                    one, two = filter_places(shingles, bits)
                    often = common[one] & common[two]
                    p = prefix_size(n, percent)
                    first = shingles[~often][:p]
                    if len(first) < p:
                        first = np.concatenate([first, shingles[often][: p - len(first)]])
                    rows.append((set_id(shingles), n, first.astype(np.int64), sketch_of(shingles)))
            yield pd.DataFrame(rows, columns=["node", "n", "prefix", "sketch"])

    return docs.select("text").mapInPandas(cut, "node long, n long, prefix array<long>, sketch array<long>")


def in_filter(rows: DataFrame, filled: np.ndarray) -> DataFrame:
    """``node, n, place, shingle`` of the prefixes, without the columns that aren't in a filter."""
    handed = rows.sparkSession.sparkContext.broadcast(filled)

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filled = handed.value
        for batch in batches:
            if not len(batch):
                continue
            prefixes = batch["prefix"].tolist()
            sizes = np.fromiter(map(len, prefixes), dtype=np.int64, count=len(prefixes))
            shingles = np.concatenate(prefixes)
            of = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(shingles)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            own = np.flatnonzero(in_bloom(filled, shingles.astype(np.uint64)))
            yield pd.DataFrame(
                {"node": batch["node"].to_numpy()[of[own]], "n": batch["n"].to_numpy()[of[own]], "place": place[own], "shingle": shingles[own]}
            )

    return rows.select("node", "n", "prefix").mapInPandas(explode, "node long, n long, place int, shingle long")


# --------------------------------------------------------------------------
# products


def size_checked(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast if it has few rows; otherwise the join is left to a shuffle."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def linked(overlap: Column, n: Column, m: Column, percent: int) -> Column:
    """100 x intersection >= percent x union."""
    return (100 + percent) * overlap >= percent * (n + m)


def least_shared(n: Column, m: Column, percent: int) -> Column:
    """Columns that similar rows of these sizes share within their prefixes.

    They share at least o columns.  A prefix leaves out at most ``n - o`` of its columns, and the
    first columns that are shared lie in both prefixes.
    """
    up = lambda x, y: F.floor((x + (y - 1)) / y)
    o = up(percent * (n + m), 100 + percent)
    prefix = lambda k: k - up(percent * k, 100) + 1
    return F.greatest(F.lit(1), F.least(prefix(n) - n + o, prefix(m) - m + o))


def _links_of(size: int, percent: int):
    """A function of nodes and their texts: whether the rows are similar.

    Texts are looked up by document; one that isn't the node's, as happens with repeated keys, has no links.
    """

    def similar(a: pd.Series, left: pd.Series, b: pd.Series, right: pd.Series) -> pd.Series:
        def rows(nodes: pd.Series, texts: pd.Series) -> Iterator[np.ndarray | None]:
            # Rows come by their right text, which is cut up once.
            last, found = None, None
            for node, text in zip(nodes, texts):
                if found is None or text != last:
                    ((_, found),) = shingle_sets([text], size)
                    last, own = text, set_id(found)
                yield found if own == node else None

        def is_link(x: np.ndarray | None, y: np.ndarray | None) -> bool:
            if x is None or y is None:
                return False
            x, y = (x, y) if len(x) <= len(y) else (y, x)
            overlap = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
            return (100 + percent) * overlap >= percent * (len(x) + len(y))

        return pd.Series([is_link(x, y) for x, y in zip(rows(a, left), rows(b, right))], dtype=bool)

    return F.pandas_udf(similar, "boolean")


def _compare(pairs: DataFrame, docs: DataFrame, ids: DataFrame, size: int, percent: int) -> DataFrame:
    """``a, b, is_link`` of the pairs, from the whole texts of their documents; written."""
    by_a, by_b = ids.select(F.col("node").alias("a"), F.col("doc_id").alias("doc_a")), ids.select(F.col("node").alias("b"), F.col("doc_id").alias("doc_b"))
    pairs = write_table(pairs.join(by_a, "a").join(by_b, "b").select("a", "b", "doc_a", "doc_b"))
    n = pairs.count()
    # One row may be compared with a third of all: its text is repeated for the salts of those.
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(SALTS)).cast("int"))
    left = docs.join(size_checked(pairs, n), F.col("doc_id") == F.col("doc_a")).select("a", "b", "salt", F.col("text").alias("left"))
    right = docs.join(size_checked(pairs.select("b", "doc_b", "salt").distinct(), n), F.col("doc_id") == F.col("doc_b"))
    rows = left.join(right.select("b", "salt", F.col("text").alias("right")), ["b", "salt"])
    judged = rows.select("a", "b", _links_of(size, percent)("a", "left", "b", "right").alias("is_link"))
    return written(judged.groupBy("a", "b").agg(F.max("is_link").alias("is_link")))


def _can_link(n: Column, at: Column, m: Column, place: Column, percent: int) -> Column:
    """Before a shared column at most as many columns are shared as either row has, and so after it."""
    most = F.least(at, place) + 1 + F.least(n - at - 1, m - place - 1)
    return linked(most, n, m, percent)


def unlike(left: Column, right: Column) -> Column:
    """Bits in which two sketches differ; null if one has over twice as many, which no link allows."""

    def folded(x: Column, other: Column) -> Column:
        half = F.floor(F.size(x) / 2).cast("int")
        halves = F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(x) > F.size(other), halves).otherwise(x)

    bits = F.zip_with(folded(left, right), folded(right, left), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.aggregate(bits, F.lit(0), lambda total, n: total + n)


def may_link(left: Column, right: Column, n: Column, m: Column, percent: int) -> Column:
    """Rows that differ in d columns share ``(n + m - d) / 2``, and d is at least the bits in which their sketches differ."""
    return (100 + percent) * (n + m - unlike(left, right)) >= 2 * percent * (n + m)


def _alike(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` of a written table that their sketches leave.

    One row may be in many pairs: its sketch is repeated for the salts that those have.
    """
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(SALTS)).cast("int"))
    left = rows.select(F.col("node").alias("a"), "n", "sketch")
    right = rows.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("other"))
    right = salted.select("b", "salt").distinct().join(right, "b")
    fetched = salted.join(right, ["b", "salt"]).join(left, "a")
    return fetched.filter(may_link(F.col("sketch"), F.col("other"), F.col("n"), F.col("m"), percent)).select("a", "b")


def _first_pairs(members: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Each row with the head of its columns that it shares most of them with, of those it may link with: ``a, b``."""
    shared = members.filter(F.col("node") != F.col("head")).groupBy("node", "n", "head").agg(F.count(F.lit(1)).alias("shared"))
    heads = rows.select(F.col("node").alias("head"), F.col("n").alias("m"), F.col("sketch").alias("head_sketch"))
    fitting = shared.join(heads, "head").filter(F.col("shared") >= least_shared(F.col("n"), F.col("m"), percent))
    sketched = fitting.join(rows.select("node", "sketch"), "node")
    alike = sketched.filter(may_link(F.col("sketch"), F.col("head_sketch"), F.col("n"), F.col("m"), percent))
    return alike.groupBy("node").agg(F.max(F.struct("shared", "head")).alias("best")).select(F.col("node").alias("a"), F.col("best.head").alias("b"))


def in_block(node: Column, columns: Column, block: int) -> Column:
    """Whether a row is among the ``block`` or so of a column's rows that are compared with all of it; surely if there are no more.

    Rows are taken by one number of their own, so those of a column are also among the first of any
    smaller one: a pair with such a row is counted in all columns that it shares, at once.
    """
    number = F.shiftrightunsigned(F.xxhash64(node), 33)
    return number * columns < F.lit(block << 31)


def _block_pairs(members: DataFrame, block: int, percent: int) -> DataFrame:
    """Pairs ``a < b`` of different components that share enough columns in whose block of rows one of them is."""
    rows = members.withColumn("in_block", in_block(F.col("node"), F.col("columns"), block))
    pairs = rows.filter("in_block").alias("l").join(rows.alias("r"), "shingle").filter(
        (F.col("l.label") != F.col("r.label"))
        # Neither row shares more columns than it has left.
        & (F.least("l.held", "r.held") >= least_shared(F.col("l.n"), F.col("r.n"), percent))
        # Each pair once for each column.
        & (~F.col("r.in_block") | (F.col("l.node") < F.col("r.node")))
        & _can_link(F.col("l.n"), F.col("l.place"), F.col("r.n"), F.col("r.place"), percent)
    )
    ordered = F.col("l.node") < F.col("r.node")
    sides = [F.when(ordered, F.col(f"{x}.{c}")).otherwise(F.col(f"{y}.{c}")).alias(name) for x, y, c, name in (("l", "r", "node", "a"), ("r", "l", "node", "b"), ("l", "r", "n", "n"), ("r", "l", "n", "m"))]
    counted = pairs.select(*sides).groupBy("a", "b", "n", "m").agg(F.count(F.lit(1)).alias("shared"))
    return counted.filter(F.col("shared") >= least_shared(F.col("n"), F.col("m"), percent)).select("a", "b")


def _with_links(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The components ``node, label`` after further links ``a, b``; written.

    Only what the links connect is looked at: the components of their ends are the nodes of a graph.
    """
    ends = links
    for side in ("a", "b"):
        known = labels.select(F.col("node").alias(side), F.col("label").alias("of"))
        ends = ends.join(known, side, "left").withColumn(side, F.coalesce("of", side)).drop("of")
    moves = write_table(components(ends))
    n = moves.count()
    if not n:
        return labels
    moved = labels.join(size_checked(moves.select(F.col("node").alias("label"), F.col("label").alias("to")), n), "label", "left")
    moved = moved.select("node", F.coalesce("to", "label").alias("label"))
    return write_table(moved.unionByName(moves.join(labels, "node", "left_anti")))


def linked_components(docs: DataFrame, ids: DataFrame, size: int, percent: int, common: np.ndarray) -> DataFrame:
    """The components ``node, label`` of all sets that link with any.

    ``docs`` has ``doc_id, text``; ``ids`` one ``doc_id`` for each ``node``.
    """
    n = ids.count()
    if n <= BROADCAST_ROWS:
        rows = prefixes(docs.join(F.broadcast(ids.select("doc_id")), "doc_id", "left_semi"), size, percent, common)
    else:
        rows = prefixes(docs, size, percent, common).dropDuplicates(["node"])
    rows = written(rows)
    # Rows of a column are counted before the shuffle; columns of one row are dropped.
    entries = rows.select("node", F.explode("prefix").alias("shingle"))
    heads = entries.groupBy("shingle").agg(F.count(F.lit(1)).alias("columns"), F.min("node").alias("head"))
    heads = write_table(heads.filter(F.col("columns") > 1))
    members = write_table(in_filter(rows, bloom(heads.select(F.col("shingle").alias("key")))).join(heads, "shingle"))

    tried = _compare(_first_pairs(members, rows, percent), docs, ids, size, percent)
    tried = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "is_link")
    labels = write_table(components(tried.filter("is_link").select("a", "b")))
    tried = tried.select("a", "b")
    members, block = members.drop("head"), BLOCK_GROWTH
    while True:
        moved = labels.filter(F.col("node") != F.col("label"))
        own = members.drop("label", "held").join(size_checked(moved, moved.count()), "node", "left").withColumn("label", F.coalesce("label", "node"))
        mixed = own.groupBy("shingle").agg(F.min("label").alias("one"), F.max("label").alias("other")).filter(F.col("one") != F.col("other"))
        left = own.join(mixed.select("shingle"), "shingle", "left_semi")
        # As many rows as a prefix has columns at most.
        members = write_table(left.withColumn("held", F.count(F.lit(1)).over(Window.partitionBy("node"))))
        largest = members.agg(F.max("columns")).first()[0]
        if largest is None:
            return labels
        pairs = write_table(_block_pairs(members, block, percent).join(tried, ["a", "b"], "left_anti"))
        judged = _compare(_alike(pairs, rows, percent), docs, ids, size, percent)
        labels = _with_links(labels, judged.filter("is_link").select("a", "b"))
        if block >= largest:
            return labels
        tried = tried.unionByName(pairs)
        block *= BLOCK_GROWTH


def classes(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_shingles, component_id`` of every document.

    Documents link when ``100 x intersection >= percent x union`` of their sets of distinct
    ``size``-word shingles; ``component_id`` is the smallest key that links reach.  A text of fewer
    words is one shingle; null and empty texts have none and link with nothing, nor do documents
    without a key, whose ``component_id`` is null.  Documents with equal sets are linked; repeated
    rows give a row each; other columns are ignored; an empty table gives no rows.
    """
    docs = _texts(docs, key, text)
    rows = written(digests(docs, size))
    found = rows.filter(F.col("node").isNotNull()).select("doc_id", "node", "n")
    nodes = write_table(found.filter((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("doc_id")))
    common = shingle_filter(common_shingles(rows, COMMON), COMMON_BITS)
    linked_nodes = linked_components(docs.filter(F.col("doc_id").isNotNull()), nodes, size, percent, common)
    labelled = nodes.join(linked_nodes, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    reached = write_table(labelled.join(least, "label").select("node", "component_id"))
    out = found.join(reached, "node", "left")
    lone = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), lone.alias("component_id"))


def one_of_each(docs: DataFrame, key: str = "doc_id", **settings) -> DataFrame:
    """The documents without those that are not the first of their component; all columns are kept.

    Of rows that repeat a key one stays, if one of them is first.  Documents without a key all stay.
    """
    rows = classes(docs, key=key, **settings)
    is_first = rows.groupBy(F.col(key).alias("gone")).agg(F.max(F.col("component_id") == F.col(key)).alias("first"))
    gone = write_table(is_first.filter(~F.col("first")).select("gone"))
    kept = docs.join(size_checked(gone, gone.count()), F.col(key).cast("long") == F.col("gone"), "left_anti")
    repeated = write_table(docs.groupBy(F.col(key).alias("again")).count().filter("count > 1 AND again IS NOT NULL").select("again"))
    n = repeated.count()
    if not n:
        return kept
    is_again = F.broadcast(repeated) if n <= BROADCAST_ROWS else repeated
    once = kept.join(is_again, F.col(key) == F.col("again"), "left_anti")
    more = kept.join(is_again, F.col(key) == F.col("again"), "left_semi").dropDuplicates([key])
    return once.unionByName(more)
