"""Profile batches and snapshots, written with plain partitioned writers.

A profile store is one Parquet folder, ``writer=<w>/batch_id=<n>/``, holding every
merged batch as it came (K5, K6, K9).  Writing a batch again replaces its own folder
(dynamic partition overwrite), so a replayed micro-batch or a retried job leaves
nothing twice (X2).  Reading folds the batches per IP under the store's merge policy,
in one aggregation; ``compact_to`` writes the folded rows as the base of a new folder
when a store has gathered many batches.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

from ipscope import schemas as S
from ipscope.operators.enrich import conform, run_time
from ipscope.operators.keyed import rows_of_keys
from ipscope.operators.merge import resolve_versions, version_order

VERSION = StructType([*S.PROFILE.fields, StructField("_merge_ts", TimestampType(), True), StructField("_keep", BooleanType(), True),
                      StructField("_delta", IntegerType(), True), StructField("writer", StringType(), True),
                      StructField("batch_id", LongType(), True)])
BLOOM = {"parquet.bloom.filter.enabled#ip_address": "true"}


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path).select("path").limit(1).collect()
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


class ProfileStore:
    """Profiles by IP under one merge policy: ``table`` (J4) or ``document``.

    A batch is known by (writer, batch_id); streams, batch jobs and lookups that write to
    one store are different writers.  Batches fold in order of their run time, then
    writer, then number.  Files are sorted by IP and carry a Bloom filter on it, so reads
    for few IPs skip row groups.
    """

    def __init__(self, spark: SparkSession, path: str, policy: str = "table", keep_old_enriched_at: bool = False):
        if policy not in ("table", "document"):
            raise ValueError(f"unknown merge policy {policy!r}")
        self.spark, self.path, self.policy, self.keep_old_enriched_at = spark, path.rstrip("/"), policy, keep_old_enriched_at

    def merge(self, batch: DataFrame, batch_id: int, run_ts: str | None = None, writer: str = "default",
              keep_old_enriched_at: bool | None = None) -> None:
        """Add ``batch`` (PROFILE rows, key-unique), or put it in place of what this batch wrote before.

        Rows with a blank key are left out.  ``keep_old_enriched_at`` holds for this write
        (Q15: lookup writes keep the stored time where they bring none, pipeline writes
        do not); by default the store's.
        """
        keep = self.keep_old_enriched_at if keep_old_enriched_at is None else keep_old_enriched_at
        rows = conform(batch, S.PROFILE).filter(F.col("ip_address").isNotNull() & (F.col("ip_address") != ""))
        self._write(rows, run_time(run_ts), keep, 1, writer, batch_id)

    def _write(self, rows: DataFrame, at: Column, keep: bool, delta: int, writer: str, batch_id: int) -> None:
        (rows.withColumns({"_merge_ts": at, "_keep": F.lit(keep), "_delta": F.lit(delta), "writer": F.lit(writer),
                           "batch_id": F.lit(int(batch_id)).cast("long")})
         .sortWithinPartitions("ip_address").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .options(**BLOOM).partitionBy("writer", "batch_id").parquet(self.path))

    def versions(self) -> DataFrame:
        """Every row of every batch, with its place; an unwritten store has none."""
        try:
            rows = self.spark.read.schema(VERSION).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], VERSION)
        return rows.withColumn("_ord", F.expr(version_order("_delta", "_merge_ts", "writer", "batch_id"))).drop("_delta", "writer", "batch_id")

    def profiles(self) -> DataFrame:
        return resolve_versions(self.versions(), self.policy)

    def rows_for(self, keys: DataFrame) -> DataFrame:
        """The profiles of the IPs in ``keys``; the key test is below the fold, at the scan."""
        return resolve_versions(rows_of_keys(self.versions(), keys), self.policy)

    def point(self, ip: str) -> DataFrame:
        return resolve_versions(self.versions().filter(F.col("ip_address") == ip), self.policy)

    def compact_to(self, path: str) -> "ProfileStore":
        """A new store at ``path`` that starts from this one's profiles; batches go there from then on."""
        other = ProfileStore(self.spark, path, self.policy, self.keep_old_enriched_at)
        other._write(self.profiles(), F.lit(None).cast("timestamp"), False, 0, "base", 0)
        return other


def save_profiles(profiles: DataFrame, stores: list[ProfileStore], batch_id: int,
                  run_ts: str | None = None, writer: str = "default",
                  keep_old_enriched_at: bool | None = None) -> None:
    """K9: save profiles to every store (each under its own policy)."""
    profiles = profiles.persist()
    try:
        for store in stores:
            store.merge(profiles, batch_id, run_ts, writer, keep_old_enriched_at)
    finally:
        profiles.unpersist()


def write_snapshot(df: DataFrame, root: str, run_ts: str, fmt: str = "parquet",
                   run_id: str | None = None, counters: dict[str, Column] | None = None, required: bool = False,
                   drop: tuple[str, ...] = ()) -> dict:
    """K1/K2: write a snapshot under ``year=/month=/day=`` of the run time; returns its counters.

    The run id column takes the place of the timestamped file name, so several
    runs on one day stay apart and the newest is selectable by partition filter.
    Writing a run again replaces that run's partition.  ``record_count`` and ``counters``
    (aggregates over the rows, ``drop`` columns included, which are not written) are
    gathered while the rows are written, so counting costs no job (K3, A5).  A
    ``required`` snapshot without rows raises (S11).
    """
    ts = F.to_timestamp(F.lit(run_ts))
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("record_count"), *[c.alias(k) for k, c in (counters or {}).items()])
    out = (counted.drop(*drop).withColumn("year", F.date_format(ts, "yyyy"))
             .withColumn("month", F.date_format(ts, "MM"))
             .withColumn("day", F.date_format(ts, "dd"))
             .withColumn("run_id", F.lit(run_id or run_id_of(run_ts))))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("year", "month", "day", "run_id").format(fmt).save(root))
    got = {"record_count": 0, **dict.fromkeys(counters or {}, 0), **seen.get}
    if required and not got["record_count"]:
        raise ValueError(f"the snapshot of {run_ts} for {root} has no rows")
    return got


def run_id_of(run_ts: str) -> str:
    return re.sub(r"[^0-9]", "", run_ts)[:14]


def write_raw_snapshot(df: DataFrame, root: str, run_ts: str, source: str) -> str:
    """K1: a raw snapshot as JSON lines, and its envelope (source, ingestion time, record count) beside it.

    The envelope is one row under ``_envelopes/run_id=<id>``, so records are written and
    read by many tasks; it is written last, from what was counted while the records were
    written, and names a complete snapshot.  Writing a run again replaces both.
    """
    run_id = run_id_of(run_ts)
    count = write_snapshot(df, f"{root}/records", run_ts, "json", run_id)["record_count"]
    (df.sparkSession.range(1).select(F.lit(source).alias("source"), F.lit(run_ts).alias("ingestion_time"), F.lit(count).alias("record_count"))
     .write.mode("overwrite").option("partitionOverwriteMode", "static").json(f"{root}/_envelopes/run_id={run_id}"))
    return root


def read_raw_snapshot(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The records of the newest complete raw snapshot, with its envelope's fields."""
    envelopes = spark.read.schema("source string, ingestion_time string, record_count long, run_id string").json(f"{root}/_envelopes")
    newest = envelopes.orderBy(F.col("run_id").desc()).first()  # one row
    fields = ["source", "ingestion_time", "record_count"]
    if newest is None:
        return spark.createDataFrame([], StructType([*(envelopes.schema[f] for f in fields), *schema.fields]))
    records = spark.read.schema(schema).json(f"{root}/records/*/*/*/run_id={newest.run_id}")  # no other run is listed
    return records.select(*[F.lit(newest[f]).alias(f) for f in fields], *schema.names)


def snapshot_manifest(df: DataFrame, source: str, ingestion_time: str) -> DataFrame:
    """K3/A3: one-row ``(source, ingestion_time, record_count)``."""
    return df.agg(F.count("*").alias("record_count")).select(
        F.lit(source).alias("source"), F.lit(ingestion_time).alias("ingestion_time"), "record_count")


def publish_json(df: DataFrame, fmt: str = "kafka", path: str | None = None,
                 options: dict | None = None, run_id: str | None = None) -> None:
    """K4: every row as a JSON value (explicit nulls kept), no key.

    To files, a run publishes under ``run_id=<id>`` and publishing it again replaces
    that folder; a message queue gets the rows again (at least once).
    """
    out = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    w = out.write.format(fmt).options(**(options or {}))
    if fmt in ("text", "json", "parquet"):
        if run_id is None:
            w.mode("append").save(path)
        else:
            w.mode("overwrite").option("partitionOverwriteMode", "static").save(f"{path}/run_id={run_id}")
    else:
        w.save()
