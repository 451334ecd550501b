"""Exact dedup over a persistent digest index (DataFrame functions only).

The index is a Parquet table bucketed and sorted by digest.  A batch is reduced
to one row per digest (combined before the shuffle) and joined with the index once,
by sort-merge on the buckets: what finds no partner there (the anti-join) is new and
is appended, what finds one keeps the index's document.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ipscope.llm.common import ASCII_SPACE, shuffle_partitions, staged


def digest_of(text: Column) -> Column:
    """SHA-256 of the text without ASCII white space; a null text counts as empty."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), ASCII_SPACE + "+", ""), 256))


class DigestIndex:
    """Digests seen so far, with the document that stays for each.

    ``path`` is a folder all executors share; opening the same path again, also in
    another session, continues the same index.  The bucket count is fixed when the
    index is made (it should follow the size the index is meant to reach) and is kept
    beside it: whoever opens the index later gets that count, whatever they ask for.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, id_type: str = "bigint"):
        self.spark, self.path = spark, path.rstrip("/")
        self.name = "digest_index_" + hashlib.sha256(self.path.encode()).hexdigest()[:16]
        self.buckets = self._made_with() or self._make(buckets or shuffle_partitions(spark))
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id {id_type}, n_rows BIGINT) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}'")

    def _made_with(self) -> int | None:
        try:
            return self.spark.read.schema("buckets int").parquet(f"{self.path}/_made_with").first().buckets
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _make(self, buckets: int) -> int:
        self.spark.range(1).select(F.lit(buckets).alias("buckets")).write.parquet(f"{self.path}/_made_with")
        return buckets

    def add(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """Dedup a batch against itself and the index; append what is new.

        Returns one row per input row: doc_id, keep_id, group_size, kept,
        text_sha256.  Of equal texts in the batch the row with the most code
        points stays, then the smallest doc_id; a text the index knows from an
        earlier batch keeps that batch's document, so no row of this one is kept.
        group_size counts the rows of this batch.  Null and empty texts (and texts
        of white space only) are equal to each other.  A null doc_id loses every
        tie.  Rows that repeat both doc_id and text are all kept if their doc_id is.
        An empty batch gives no rows.  Other columns are not read.  Running a
        failed batch again gives the same rows: its digests are already there.
        """
        rows = staged(docs.select(
            F.col(doc_id).alias("doc_id"),
            F.char_length(F.coalesce(F.col(text), F.lit(""))).alias("n_chars"),
            digest_of(F.col(text)).alias("digest")), "digests")
        best = F.min(F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), F.col("doc_id")))
        # Written out, so that the join stays behind the aggregation: below it, all
        # rows of a hot digest would meet in one task.
        firsts = staged(rows.groupBy("digest").agg(best.alias("best"), F.count("*").alias("n_rows")).select(
            "digest", F.col("best.doc_id").alias("keep_id"), "n_rows"), "digest_firsts")
        groups = staged(self.known(firsts).select(
            "digest", "n_rows", F.col("known_id").isNull().alias("fresh"), F.coalesce("known_id", F.struct("keep_id")).alias("keep")),
            "digest_groups")
        (groups.filter("fresh").select("digest", "keep.keep_id", "n_rows").repartition(self.buckets, "digest")
         .write.insertInto(self.name))
        # Written out, both sides are plain exchanges, whose hot digests the runtime can split.
        groups = groups.select("digest", "n_rows", "keep.keep_id")
        return rows.join(groups, "digest").select(
            "doc_id", "keep_id", F.col("n_rows").alias("group_size"),
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"))

    def known(self, firsts: DataFrame) -> DataFrame:
        """``firsts`` (one row per digest) with ``known_id``: the index's document in a struct, or null.

        Sort-merge join on the buckets: the batch is dealt to them, the index stays where it is.
        """
        index = self.spark.table(self.name).select(F.col("digest").alias("known"), F.struct("keep_id").alias("known_id"))
        batch = firsts.repartition(self.buckets, "digest")
        return batch.join(index.hint("merge"), batch["digest"] == index["known"], "left").drop("known")

    def keep(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """The rows of ``docs`` that stay, columns unchanged: one for each text that is new to the index.

        Of rows that repeat both doc_id and normalised text one stays, of those with
        the most code points.
        """
        stays = self.add(docs, doc_id, text).filter("kept").select(
            F.col("doc_id").alias("__id"), F.unhex("text_sha256").alias("__sha")).distinct()
        rows = docs.withColumn("__digest", digest_of(F.col(text))).join(
            stays, (F.col("__digest") == F.col("__sha")) & F.col(doc_id).eqNullSafe(F.col("__id")))
        turn = Window.partitionBy("__sha", "__id").orderBy(F.char_length(text).desc_nulls_last(), F.xxhash64(*docs.columns))
        return rows.withColumn("__turn", F.row_number().over(turn)).filter("__turn = 1").select(*docs.columns)
