"""Exact and near-duplicate removal under a deterministic keep-first rule.

Near duplicates: records are taken in the order of ``seq``; a record is a
duplicate when it shares a band with an earlier *kept* record and their
signatures agree in at least ``threshold`` of the positions.  Dropped records
never match anything, so similarity is not transitive and connected components
would give another answer.

How it stays linear in the size of a bucket: members of a bucket are compared
only with its first few undecided members (its leaders), never all with all.
A leader that is kept drops its copies at once, so a bucket holding a third of
all rows mostly empties in one round; what is left gets twice as many leaders
in the next.  Buckets beyond ``HOT_ROWS`` are spread over salted partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import CorpusConfig
from ..functions import minhash as M
from ..functions.frames import compute_once
from ..functions.text import shingle_text
from ..session import PACKED, cut_lineage, discard, write_table
from .components import components

SMALL_BUCKET = 32
HOT_ROWS = 500_000
MAX_HOT_BUCKETS = 10_000
MAX_LEADERS = 512
PARALLEL_TURNS = 3  # before what is still undecided is settled group by group
LOCAL_EDGES = 200_000  # pairs of a group that are settled at a time, a few megabytes
TASK_PAIRS = 50_000  # of small groups that a task settles together
BROADCAST_ROWS = 1_000_000  # of record numbers, about 16 MB


def content_hash(text) -> F.Column:
    """SHA-256 of the UTF-8 text, hexadecimal."""
    return F.sha2(text, 256)


# --------------------------------------------------------------------------
# exact


def _flag(df: DataFrame, seqs: DataFrame, column: str, seq: str) -> DataFrame:
    """Adds a boolean: is the record's ``seq`` among ``seqs``?

    The numbers are written and counted first.  Up to ``BROADCAST_ROWS`` of
    them are broadcast, so that no text is shuffled for the sake of a flag;
    more are joined by a shuffle, which ``seq``, being unique, cannot skew.
    """
    hits = cut_lineage(seqs.select(seq)).withColumn(column, F.lit(True))
    if hits.count() <= BROADCAST_ROWS:
        hits = F.broadcast(hits)
    marked = df.join(hits, seq, "left")
    return marked.withColumn(column, F.coalesce(F.col(column), F.lit(False)))


def mark_exact(df: DataFrame, text: str = "text", seq: str = "seq") -> DataFrame:
    """Adds ``is_duplicate``: null for null texts, else true for all but the first copy."""
    flagged = _flag(df, _later_copies(df.select(seq, F.unhex(content_hash(F.col(text))).alias("_hash")), seq), "_later", seq)
    return flagged.withColumn(
        "is_duplicate", F.when(F.col(text).isNotNull(), F.col("_later"))
    ).drop("_later")


def _later_copies(hashes: DataFrame, seq: str) -> DataFrame:
    """``seq`` of all rows but the first of each hash; null hashes have no copies."""
    hashes = cut_lineage(hashes.filter(F.col("_hash").isNotNull()))
    # Copies are combined before the shuffle, so a large group of them does no harm.
    firsts = hashes.groupBy("_hash").agg(F.min(seq).alias(seq)).select(seq)
    return hashes.select(seq).join(firsts, seq, "left_anti")


# --------------------------------------------------------------------------
# near duplicates


def signatures(df: DataFrame, cfg: CorpusConfig, text: str = "text", seq: str = "seq") -> DataFrame:
    """``seq``, ``sig``, ``keys``, ``print`` of all texts that have at least one shingle."""
    grams = _shingled(df, cfg, text, seq)
    return _sign(grams, cfg, seq)


def _shingled(df: DataFrame, cfg: CorpusConfig, text: str, seq: str) -> DataFrame:
    lowered = compute_once(df.select(seq, text), _s=shingle_text(F.col(text)))
    return lowered.select(seq, "_s").filter(F.length("_s") >= cfg.ngram_size)


def _sign(grams: DataFrame, cfg: CorpusConfig, seq: str) -> DataFrame:
    signed = grams.select(
        F.col(seq).alias("seq"),
        M.signature(F.col("_s"), cfg.ngram_size, cfg.num_perm, cfg.hash_family).alias("sig"),
    )
    numbers = F.col("sig") if cfg.hash_family == "affine" else M.last_bytes(F.col("sig"))
    return compute_once(
        signed,
        keys=M.band_keys(F.col("sig"), cfg.num_perm),
        print=M.fingerprint(numbers, cfg.num_perm),
    )


def bucket_rows(nodes: DataFrame) -> DataFrame:
    """One row per record and band."""
    return nodes.select("seq", "keys", "print", F.posexplode("keys").alias("band", "key"))


def with_candidate_flag(sigs: DataFrame) -> DataFrame:
    """``seq``, ``has_candidate``: does the record share a band with an earlier one?

    It does unless it is the first of all its buckets, so no pairs are formed.
    """
    firsts = (
        sigs.select("seq", F.posexplode("keys").alias("band", "key"))
        .groupBy("band", "key")
        .agg(F.min("seq").alias("seq"))
        .groupBy("seq")
        .agg(F.count(F.lit(1)).alias("led"))
    )
    return sigs.select("seq").join(firsts, "seq", "left").select(
        "seq", (F.coalesce("led", F.lit(0)) < M.LSH_BANDS).alias("has_candidate")
    )


def bucket_sizes(nodes: DataFrame) -> DataFrame:
    """Buckets of two or more members."""
    return (
        nodes.select(F.posexplode("keys").alias("band", "key"))
        .groupBy("band", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )


class _Buckets:
    """The shared buckets of one round and how their rows are spread."""

    def __init__(self, nodes: DataFrame):
        self.sizes = cut_lineage(bucket_sizes(nodes))
        total, self.largest = self.sizes.agg(
            F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))
        ).first()
        # At most MAX_HOT_BUCKETS buckets can exceed this size, which bounds
        # the broadcast below whatever the data.
        self.hot_rows = max(HOT_ROWS, total // MAX_HOT_BUCKETS)
        self.hot = None
        self.on = ["band", "key"]
        if self.largest > self.hot_rows:
            salts = F.ceil(F.col("n") / self.hot_rows).cast("int")
            self.hot = F.broadcast(
                self.sizes.filter(F.col("n") > self.hot_rows).select("band", "key", salts.alias("salts"))
            )
            self.on.append("salt")

    def one_salt(self, rows: DataFrame) -> DataFrame:
        """Sends each row of a hot bucket to one of its partitions."""
        if self.hot is None:
            return rows
        salted = rows.join(self.hot, ["band", "key"], "left")
        pick = F.pmod(F.xxhash64("seq"), F.coalesce(F.col("salts"), F.lit(1))).cast("int")
        return salted.withColumn("salt", pick).drop("salts")

    def all_salts(self, rows: DataFrame) -> DataFrame:
        """Repeats each row for every partition of its bucket."""
        if self.hot is None:
            return rows
        salted = rows.join(self.hot, ["band", "key"], "left")
        every = F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1)
        return salted.withColumn("salt", F.explode(every)).drop("salts")


def _members_and_leaders(
    nodes: DataFrame, buckets: _Buckets, leaders: int, small: int
) -> tuple[DataFrame, DataFrame]:
    slim = bucket_rows(nodes).drop("keys", "print")
    shared = buckets.one_salt(slim).join(buckets.all_salts(buckets.sizes), buckets.on)
    # Most buckets have one member: keys and fingerprints, the bulk of a record, go to the others alone.
    members = write_table(shared.join(nodes.select("seq", "keys", "print").distinct(), "seq"), options=PACKED)
    place = F.row_number().over(Window.partitionBy("band", "key").orderBy("seq"))
    # The constant bound lets Spark cut each bucket down before the shuffle.
    first = members.withColumn("place", place).filter(F.col("place") <= max(leaders, small))
    if leaders < small:
        first = first.filter((F.col("place") <= leaders) | (F.col("n") <= small))
    return members, first.select(
        "band", "key", "n", F.col("seq").alias("a"), F.col("keys").alias("a_keys"), F.col("print").alias("a_print")
    )


def _compare(
    members: DataFrame,
    leaders: DataFrame,
    sigs: DataFrame,
    buckets: _Buckets,
    limit: tuple[int, float] | None = None,
) -> DataFrame:
    """``a``, ``b``, ``matches`` for members b and earlier leaders a.

    ``limit`` is the number of permutations and the threshold.  Pairs whose
    fingerprints rule the threshold out never leave the join.  A pair is
    formed in the first band it shares, so each appears once; a record that
    leads one bucket but not another is missed where the band of the other
    comes first, which does no harm: a record is only kept in a round in which
    it leads all of its buckets.  Without ``limit`` all pairs are found, some
    of them more than once.
    """
    a_sigs = sigs.select(F.col("seq").alias("a"), F.col("sig").alias("a_sig"))
    b_sigs = sigs.select(F.col("seq").alias("b"), F.col("sig").alias("b_sig"))
    with_sig = buckets.all_salts(leaders.drop("n").join(a_sigs, "a"))
    pairs = (
        members.withColumnRenamed("seq", "b").join(with_sig, buckets.on).filter(F.col("a") < F.col("b"))
    )
    if limit is not None:
        num_perm, threshold = limit
        bound = M.at_most_matching(F.col("a_print"), F.col("print"), num_perm)
        pairs = pairs.filter(bound / num_perm >= threshold).filter(
            M.first_shared_band(F.col("a_keys"), F.col("keys")) == F.col("band")
        )
    compared = pairs.select("a", "b", "a_sig").join(b_sigs, "b")
    return compared.select("a", "b", M.matching(F.col("a_sig"), F.col("b_sig")).alias("matches"))


def leader_pairs(sigs: DataFrame) -> DataFrame:
    """Every record against the first record of each bucket it is in."""
    nodes = sigs.select("seq", "keys", "print")
    buckets = _Buckets(nodes)
    members, leaders = _members_and_leaders(nodes, buckets, 1, 1)
    return _compare(members, leaders, sigs, buckets).distinct()


def _settle(edges: DataFrame, waiting: DataFrame | None) -> tuple[list[DataFrame], DataFrame]:
    """Keep-first over verified pairs (a earlier than b).

    In a turn every record with no earlier undecided match is kept and drops
    all later records it matches.  Chains of revisions, each similar to the
    one before, would take a turn for each link; so after a few turns the
    undecided records are settled by ``_settle_groups`` as well.  Records in
    ``waiting`` have not met all their leaders yet and cannot be kept.
    Returns the dropped records and the pairs still undecided.
    """
    dropped: list[DataFrame] = []
    turn = 0
    while True:
        blocked = edges.select(F.col("b").alias("a")).distinct()
        if waiting is not None:
            blocked = blocked.unionByName(waiting.select(F.col("seq").alias("a"))).distinct()
        tagged = cut_lineage(
            edges.join(blocked.withColumn("held", F.lit(True)), "a", "left").select(
                "a", "b", F.col("held").isNull().alias("kept")
            )
        )
        if tagged.filter("kept").isEmpty():
            return dropped, tagged.drop("kept")
        gone = tagged.filter("kept").select(F.col("b").alias("seq")).distinct()
        dropped.append(gone)
        edges = _without(tagged.filter("not kept").select("a", "b"), gone)
        turn += 1
        if turn >= PARALLEL_TURNS:
            edges = cut_lineage(edges)
            left = edges.count()
            if not left:
                return dropped, edges
            settled = _settle_groups(edges, waiting, left)
            kept, gone = settled.filter("kept"), settled.filter("not kept").select("seq")
            # A kept record also drops those that its group's share did not hold.
            hit = edges.join(kept.select(F.col("seq").alias("a")), "a", "left_semi").select(F.col("b").alias("seq"))
            gone = cut_lineage(gone.unionByName(hit).distinct())
            dropped.append(gone)
            edges = _without(_without(edges, gone), kept.select("seq"))


def _without(edges: DataFrame, seqs: DataFrame) -> DataFrame:
    """The pairs neither end of which is among ``seqs``."""
    return edges.join(seqs.withColumnRenamed("seq", "a"), "a", "left_anti").join(
        seqs.withColumnRenamed("seq", "b"), "b", "left_anti"
    ).select("a", "b")


def _settle_groups(edges: DataFrame, waiting: DataFrame | None, count: int) -> DataFrame:
    """``seq``, ``kept``: what can be decided of undecided records, connected group by connected group.

    A group's pairs are taken in the order of the later record, ``LOCAL_EDGES``
    at a time, and worked off in that order by one task; all earlier pairs of
    a record are among them but for the last record, which can only be
    dropped.  Groups differ in nothing the result depends on, so if all pairs
    fit into one share they are not told apart.  The number of turns grows
    with the largest group divided by that share, not with its longest chain.
    """
    if count <= LOCAL_EDGES:
        grouped = edges.withColumn("group", F.lit(0).cast("long"))
    else:
        labels = components(edges).select(F.col("node").alias("a"), F.col("label").alias("group"))
        place = F.row_number().over(Window.partitionBy("group").orderBy("b", "a"))
        grouped = edges.join(labels, "a").withColumn("place", place).filter(F.col("place") <= LOCAL_EDGES).drop("place")
    for end in ("a", "b"):
        if waiting is None:
            grouped = grouped.withColumn(f"{end}_held", F.lit(False))
        else:
            flags = waiting.select(F.col("seq").alias(end), F.lit(True).alias("_held")).distinct()
            grouped = grouped.join(flags, end, "left").withColumn(f"{end}_held", F.coalesce("_held", F.lit(False))).drop("_held")
    # Small groups share a task: one call for each partition, not for each group.
    parts = max(1, min(count // LOCAL_EDGES + 1, int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    dealt = grouped.repartition(parts, "group").sortWithinPartitions("group", "b", "a")

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if held and sum(map(len, held)) >= TASK_PAIRS:
                # What has been held is settled up to its last group, which may go on.
                rows = pd.concat(held)
                last = rows["group"] == rows["group"].iat[-1]
                if not last.all():
                    yield settle_in_order(rows[~last])
                held = [rows[last]]
            held.append(batch)
        if held:
            yield settle_in_order(pd.concat(held))

    return cut_lineage(dealt.mapInPandas(settle, "seq long, kept boolean"))


def settle_in_order(rows: pd.DataFrame) -> pd.DataFrame:
    """``seq``, ``kept`` of the records that pairs sorted by ``group, b`` decide.

    In a group with ``LOCAL_EDGES`` pairs the last record may have more of
    them, and is not kept.
    """
    KEPT, GONE, OPEN = 1, 2, 3
    state: dict[int, int] = {}
    ends, groups = rows["b"].to_numpy(), rows["group"].to_numpy()
    if not len(ends):
        return pd.DataFrame({"seq": [], "kept": []}).astype({"seq": "int64", "kept": "bool"})
    starts = np.flatnonzero(np.concatenate([[True], np.diff(ends) != 0]))
    borders = np.flatnonzero(np.concatenate([[True], np.diff(groups) != 0, [True]]))
    cuts = {int(end) for start, end in zip(borders, borders[1:]) if end - start >= LOCAL_EDGES}
    earlier, a_held, b_held = rows["a"].tolist(), rows["a_held"].tolist(), rows["b_held"].tolist()
    for first, last in zip(starts.tolist(), [*starts[1:].tolist(), len(ends)]):
        # A record that is the later one of no pair has no earlier match.
        found = {state.setdefault(earlier[k], OPEN if a_held[k] else KEPT) for k in range(first, last)}
        if KEPT in found:
            state[int(ends[first])] = GONE
        elif OPEN in found or b_held[first] or last in cuts:
            state[int(ends[first])] = OPEN
        else:
            state[int(ends[first])] = KEPT
    decided = [(seq, s == KEPT) for seq, s in state.items() if s != OPEN]
    return pd.DataFrame(decided, columns=["seq", "kept"]).astype({"seq": "int64", "kept": "bool"})


def greedy_duplicates(sigs: DataFrame, num_perm: int, threshold: float) -> DataFrame:
    """``seq`` of all duplicates among records as ``signatures`` gives them."""
    empty = sigs.select("seq").limit(0)
    nodes = sigs.select("seq", "keys", "print")
    found: list[DataFrame] = []
    leaders = 1
    while True:
        buckets = _Buckets(nodes)
        if buckets.largest == 0:
            break
        members, first = _members_and_leaders(nodes, buckets, leaders, SMALL_BUCKET)
        edges = (
            _compare(members, first, sigs, buckets, (num_perm, threshold))
            .filter(F.col("matches") / num_perm >= threshold)
            .select("a", "b")
        )
        waiting = None
        if buckets.largest > SMALL_BUCKET:
            last = (
                first.filter(F.col("n") > SMALL_BUCKET)
                .groupBy("band", "key")
                .agg(F.max("a").alias("last"))
            )
            waiting = cut_lineage(
                members.filter(F.col("n") > SMALL_BUCKET)
                .join(buckets.all_salts(last), buckets.on)
                .filter(F.col("seq") > F.col("last"))
                .select("seq")
                .distinct()
            )
        dropped, left = _settle(edges, waiting)
        discard(members)
        found += dropped
        if waiting is None:
            break
        # Undecided: not dropped, and either still to meet leaders or matched
        # by an earlier record that is itself undecided.
        open_ = waiting.unionByName(left.select(F.col("b").alias("seq"))).distinct()
        for gone in dropped:
            open_ = open_.join(gone, "seq", "left_anti")
        nodes = cut_lineage(nodes.join(open_, "seq", "left_semi"))
        leaders = min(2 * leaders, MAX_LEADERS)
    return reduce(DataFrame.unionByName, found, empty)


def near_duplicates(df: DataFrame, cfg: CorpusConfig, text: str = "text", seq: str = "seq") -> DataFrame:
    """``seq`` of every near duplicate.

    Copies of the same shingle text are settled first, by hash: they have the
    same signature as their first record, hence its fate or that of being its
    duplicate, and need no signature of their own.  Up to ``BROADCAST_ROWS``
    numbers of copies are broadcast, so that no text is shuffled to leave them
    out.  The signatures go when the duplicates are known.
    """
    grams = _shingled(df, cfg, text, seq)
    copies = cut_lineage(_later_copies(grams.select(seq, F.unhex(content_hash(F.col("_s"))).alias("_hash")), seq))
    known = F.broadcast(copies) if copies.count() <= BROADCAST_ROWS else copies
    firsts = grams.filter(F.col(seq).isNotNull()).join(known, seq, "left_anti")
    signed = write_table(_sign(firsts, cfg, seq), options=PACKED)
    similar = greedy_duplicates(signed, cfg.num_perm, cfg.threshold)
    discard(signed)
    return copies.unionByName(similar.withColumnRenamed("seq", seq))


def mark_duplicates(df: DataFrame, cfg: CorpusConfig, text: str = "text", seq: str = "seq") -> DataFrame:
    """Adds ``is_duplicate`` by the configured method; null where the text is null."""
    if cfg.dup_method != "minhash":
        return mark_exact(df, text, seq)
    return mark_known(df, near_duplicates(df, cfg, text, seq), text, seq)


def mark_known(df: DataFrame, later: DataFrame, text: str = "text", seq: str = "seq") -> DataFrame:
    """Adds ``is_duplicate`` from the numbers of the duplicates; null where the text is null."""
    flagged = _flag(df, later, "_later", seq)
    return flagged.withColumn(
        "is_duplicate", F.when(F.col(text).isNotNull(), F.col("_later"))
    ).drop("_later")


def filter_duplicates(df: DataFrame, cfg: CorpusConfig, text: str = "text", seq: str = "seq") -> DataFrame:
    """The records that are not duplicates of an earlier one."""
    marked = mark_duplicates(df, cfg, text, seq)
    return marked.filter(~F.col("is_duplicate")).drop("is_duplicate")


def dedup_totals(marked: DataFrame) -> DataFrame:
    """One row: records checked, duplicates found, unique records."""
    return marked.agg(
        F.count("is_duplicate").alias("total_checked"),
        F.count_if("is_duplicate").alias("duplicates_found"),
        F.count_if(~F.col("is_duplicate")).alias("unique_items"),
    )
