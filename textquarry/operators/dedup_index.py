"""Near-duplicate removal over several runs, with an index of what earlier runs have seen.

The index is a folder of tables, partitioned by run: the hashes of all shingle
texts, and the signatures of the records kept.  A run probes what the others
have written and adds its own, so earlier texts are never read again.  Its
flags are those of a single search over all runs' records in their order,
provided that the records of a run come after those of the runs before.

A record that matches an earlier kept record is a duplicate whatever else it
matches, so those of other runs are settled first.  A copy of any earlier text
shares its fate or is its duplicate.  A run repeated after a failure replaces
what it had written.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CorpusConfig
from ..functions import minhash as M
from ..session import cut_lineage
from . import dedup

HASHES = "seq long, _hash binary, run long"


class DuplicateIndex:
    """The index in ``folder``, on storage all executors share, for one set of duplicate settings."""

    def __init__(self, spark: SparkSession, folder: str, cfg: CorpusConfig):
        self.spark, self.cfg = spark, cfg
        # Signatures of other settings can't be compared.
        self.folder = f"{folder}/{cfg.hash_family}-{cfg.num_perm}-{cfg.ngram_size}-{cfg.threshold}"
        self.kept_schema = f"seq long, sig array<{'bigint' if cfg.hash_family == 'affine' else 'binary'}>, keys array<bigint>, print array<bigint>, run long"

    def _others(self, table: str, schema: str, run: int) -> DataFrame:
        """What the other runs have written."""
        try:
            rows = self.spark.read.schema(schema).parquet(f"{self.folder}/{table}")
        except AnalysisException:
            rows = self.spark.createDataFrame([], schema)
        return rows.filter(F.col("run") != run).drop("run")

    def _write(self, rows: DataFrame, table: str, run: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder}/{table}/run={run}")

    def add(self, df: DataFrame, run: int, text: str = "text", seq: str = "seq") -> DataFrame:
        """``seq`` of the duplicates among the records of a run, which the index then has as well."""
        grams = dedup._shingled(df, self.cfg, text, seq)
        hashes = cut_lineage(grams.select(F.col(seq).alias("seq"), F.unhex(dedup.content_hash(F.col("_s"))).alias("_hash")))
        copies = dedup._later_copies(hashes, "seq")
        firsts = hashes.groupBy("_hash").agg(F.min("seq").alias("seq")).select("seq", "_hash")
        seen = self._others("hashes", HASHES, run).select("_hash").distinct().withColumn("_seen", F.lit(True))
        firsts = cut_lineage(firsts.join(seen, "_hash", "left").select("seq", "_hash", F.coalesce("_seen", F.lit(False)).alias("seen")))
        fresh = firsts.filter("not seen")
        signed = cut_lineage(dedup._sign(grams.join(fresh.select(F.col("seq").alias(seq)), seq, "left_semi"), self.cfg, seq))
        matched = cut_lineage(self._matched(signed, self._others("kept", self.kept_schema, run)))
        left = signed.join(matched, "seq", "left_anti")
        similar = cut_lineage(dedup.greedy_duplicates(left, self.cfg.num_perm, self.cfg.threshold))
        self._write(left.join(similar, "seq", "left_anti"), "kept", run)
        self._write(fresh.select("seq", "_hash"), "hashes", run)
        parts = [copies.select("seq"), firsts.filter("seen").select("seq"), matched, similar.select("seq")]
        return reduce(DataFrame.unionByName, parts).withColumnRenamed("seq", seq)

    def _matched(self, signed: DataFrame, kept: DataFrame) -> DataFrame:
        """``seq`` of new records that match a kept one of another run.

        Buckets are joined without signatures; those are fetched for the pairs
        which the fingerprints leave.  Large buckets are spread over salts.
        """
        buckets = dedup._Buckets(kept.select("seq", "keys", "print"))
        old = buckets.one_salt(dedup.bucket_rows(kept)).withColumnRenamed("seq", "a")
        old = old.select("a", F.col("keys").alias("a_keys"), F.col("print").alias("a_print"), *buckets.on)
        new = buckets.all_salts(dedup.bucket_rows(signed)).withColumnRenamed("seq", "b")
        bound = M.at_most_matching(F.col("a_print"), F.col("print"), self.cfg.num_perm)
        pairs = (
            new.join(old, buckets.on)
            .filter(bound / self.cfg.num_perm >= self.cfg.threshold)
            .filter(M.first_shared_band(F.col("a_keys"), F.col("keys")) == F.col("band"))
            .select("a", "b")
        )
        sigs = pairs.join(kept.select(F.col("seq").alias("a"), F.col("sig").alias("a_sig")), "a").join(
            signed.select(F.col("seq").alias("b"), F.col("sig").alias("b_sig")), "b"
        )
        agree = M.matching(F.col("a_sig"), F.col("b_sig")) / self.cfg.num_perm >= self.cfg.threshold
        return sigs.filter(agree).select(F.col("b").alias("seq")).distinct()
