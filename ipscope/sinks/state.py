"""Committed change-control state for the blacklist snapshot.

Layout under ``path``:

* ``records/<folder>/bucket=<b>/`` — the committed records (Parquet, 4 columns), dealt by a
  hash of the IP and sorted by it in each bucket;
* ``trees/<folder>/`` — the digest of every bucket;
* ``_manifest/`` — one row per commit: version, folder, buckets, generated_at, source
  object, record count, root digest.

``detect`` compares the current snapshot's digests with the newest commit's (no commit =
first run = changed) and diffs only the buckets whose digests differ; with equal roots
no record is read.  ``commit`` writes a new version after downstream work succeeded,
the manifest row last.  Every commit has a folder of its own, so a failed one leaves
the state as it was and two at once do not mix: of equal version numbers the one with
the greater folder name counts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ipscope import schemas as S
from ipscope.operators.changes import (STATE_COLUMNS, bucket_of, changed_buckets, diff_snapshots, diff_summary, digest_tree,
                                       tree_root)
from ipscope.operators.dedupe import last_wins
from ipscope.sinks.store import _exists

MANIFEST = StructType([
    StructField("version", LongType(), False), StructField("folder", StringType(), True), StructField("buckets", IntegerType(), True),
    StructField("generated_at", StringType(), True), StructField("source_object_name", StringType(), True),
    StructField("record_count", LongType(), True), StructField("fingerprint", StringType(), True)])
TREE = StructType([StructField("bucket", IntegerType(), True), StructField("record_count", LongType(), True),
                   StructField("fingerprint", StringType(), True)])
RECORDS = StructType([*S.STATE_RECORD.fields, StructField("bucket", IntegerType(), True)])


class SnapshotGate:
    """``buckets`` should follow the snapshot's size; a commit keeps its own number, so it may change between commits."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def manifest(self) -> DataFrame:
        p = f"{self.path}/_manifest"
        if not _exists(self.spark, p):
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(p)

    def latest(self):
        """Newest manifest row, or None before the first commit (one bounded row)."""
        r = self.manifest().orderBy(F.col("version").desc(), F.col("folder").desc()).limit(1).collect()
        return r[0] if r else None

    def committed_records(self, buckets: list[int] | None = None) -> DataFrame:
        """The newest commit's records, of all buckets or of those listed (the others' folders are not read)."""
        m = self.latest()
        if m is None or not m.record_count:
            return self.spark.createDataFrame([], S.STATE_RECORD)
        rows = self.spark.read.schema(RECORDS).parquet(f"{self.path}/records/{m.folder}")
        return (rows if buckets is None else rows.filter(F.col("bucket").isin(buckets))).drop("bucket")

    def diff(self, current: DataFrame) -> DataFrame:
        """(ip_address, change) for every IP that is new, removed or changed since the newest commit."""
        m, cur = self.latest(), _columns(current)
        return self._diff(m, cur, digest_tree(cur, m.buckets) if m else None)

    def _diff(self, m, cur: DataFrame, tree: DataFrame | None) -> DataFrame:
        if m is None:
            prev = self.spark.createDataFrame([], S.STATE_RECORD)
        else:
            differ = changed_buckets(self.spark.read.schema(TREE).parquet(f"{self.path}/trees/{m.folder}"), tree)
            prev, cur = self.committed_records(differ), cur.filter(bucket_of("ip_address", m.buckets).isin(differ))
        return diff_snapshots(prev, cur).filter("change <> 'same'")

    def detect(self, current: DataFrame) -> DataFrame:
        """One row: changed flag, both fingerprints, record count and diff counts."""
        m, cur = self.latest(), _columns(current)
        tree = digest_tree(cur, m.buckets if m else self.buckets)
        root = tree_root(tree).first()  # one row
        same = m is not None and m.fingerprint == root.fingerprint
        changes = self.spark.createDataFrame([], "ip_address string, change string") if same else self._diff(m, cur, tree)
        return diff_summary(changes).select(
            F.lit(m.fingerprint if m else None).cast("string").alias("previous_fingerprint"),
            F.lit(root.fingerprint).alias("current_fingerprint"), F.lit(root.record_count).alias("record_count"),
            "new_ip_count", "changed_ip_count", "removed_ip_count", F.lit(not same).alias("changed"))

    def should_run(self, current: DataFrame) -> bool:
        return bool(self.detect(current).select("changed").collect()[0][0])

    def commit(self, current: DataFrame, source_object_name: str | None, generated_at: str) -> int:
        """Write the current snapshot as the next committed version; returns it."""
        m = self.latest()
        version = (m.version if m else 0) + 1
        folder = f"{version:012d}-{uuid.uuid4().hex}"
        cur = _columns(current)
        kept = last_wins(cur).drop("pos") if "pos" in cur.columns else cur
        (kept.withColumn("bucket", bucket_of("ip_address", self.buckets)).repartition("bucket")
         .sortWithinPartitions("bucket", "ip_address").write.partitionBy("bucket").parquet(f"{self.path}/records/{folder}"))  # T3
        # The digests are of the snapshot as it came, duplicates included (Q14).
        digest_tree(cur, self.buckets).write.parquet(f"{self.path}/trees/{folder}")
        root = tree_root(self.spark.read.schema(TREE).parquet(f"{self.path}/trees/{folder}")).first()
        (self.spark.createDataFrame([(version, folder, self.buckets, generated_at, source_object_name,
                                      int(root.record_count), root.fingerprint)], MANIFEST)
         .write.mode("append").parquet(f"{self.path}/_manifest"))
        return version


def _columns(current: DataFrame) -> DataFrame:
    return current.select(*(c for c in ("pos",) if c in current.columns), *STATE_COLUMNS)
