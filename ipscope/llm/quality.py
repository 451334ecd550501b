"""Quality by importance resampling.

Two generative models over hashed word n-grams (one and two words), one of target
text and one of all raw text, give each document a log importance weight; adding
Gumbel noise and keeping the k largest draws k documents without replacement in
proportion to their weights.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ipscope.llm.common import WordHashes, mix64, ranked, slices, staged

BINS = 1 << 16
TOKENS = regex.compile(r"\w+|[^\w\s]+")


def grams(texts: list[str], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Bins of the one- and two-word grams of all texts, and the text each belongs to."""
    words, size = hashes.of([TOKENS.findall(x.lower()) for x in texts])
    owner = np.repeat(np.arange(len(texts)), size)
    one = (mix64(words) % np.uint64(BINS)).astype(np.int64)
    same = owner[1:] == owner[:-1] if len(owner) else np.zeros(0, bool)
    two = (mix64(words[:-1] * np.uint64(3) + mix64(words[1:])) % np.uint64(BINS)).astype(np.int64)[same]
    return np.concatenate([one, two]), np.concatenate([owner, owner[:-1][same]])


def fit(docs: DataFrame, target_ids: DataFrame, doc_id: str = "doc_id", text: str = "text",
        most_targets: int = 20_000, smoothing: float = 1.0) -> np.ndarray:
    """Log ratio of target to raw probability for each bin.

    The raw model counts all documents.  The target model counts the documents
    whose ids ``target_ids`` (column doc_id) names, about ``most_targets`` of them
    picked by a digest of the id, so the id list sent to the tasks is bounded.  Only
    two counts per bin reach the driver.  Null ids are no targets; without targets or
    documents all ratios are 0.
    """
    ids = target_ids.select("doc_id").filter("doc_id IS NOT NULL").distinct()
    share = min(1.0, most_targets / max(1, ids.count()))
    picked = ids.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    chosen = F.broadcast(picked.select(F.col("doc_id").alias("__target")))  # most_targets ids

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, raw, target = WordHashes(), np.zeros(BINS, np.int64), np.zeros(BINS, np.int64)
        for b in slices(batches, "text"):
            bins, owner = grams([x or "" for x in b.column("text").to_pylist()], hashes)
            raw += np.bincount(bins, minlength=BINS)
            wanted = b.column("target").to_numpy(zero_copy_only=False)
            target += np.bincount(bins[wanted[owner]], minlength=BINS)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])],
                                         names=["bin", "raw", "target"])

    flagged = (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
               .join(chosen, F.col("doc_id") == F.col("__target"), "left")
               .select("text", F.col("__target").isNotNull().alias("target")))
    raw, target = np.full(BINS, smoothing), np.full(BINS, smoothing)
    for r in (flagged.mapInArrow(count, "bin long, raw long, target long").groupBy("bin")
              .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()):
        raw[r.bin] += r.raw
        target[r.bin] += r.target
    if target.sum() == smoothing * BINS:
        return np.zeros(BINS)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weigh(docs: DataFrame, ratio: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Log importance weight of every whole text: doc_id, n_grams, log_weight.

    A null or empty text has no grams and weight 0.  One row per input row.
    """
    id_type = docs.schema[doc_id].dataType.simpleString()
    shared, key = docs.sparkSession.sparkContext.broadcast(ratio), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in slices(batches, "text"):
            bins, owner = grams([x or "" for x in b.column("text").to_pylist()], hashes)
            n = np.bincount(owner, minlength=b.num_rows)
            total = np.bincount(owner, weights=shared.value[bins], minlength=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n), pa.array(total)],
                                             names=["doc_id", "n_grams", "log_weight"])

    return (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(run, f"doc_id {id_type}, n_grams long, log_weight double"))


def resample(weighed: DataFrame, k: int, seed: str = "quality") -> DataFrame:
    """Gumbel top-k: adds gumbel_key and kept; exactly min(k, rows) rows are kept.

    The noise comes from a digest of ``seed`` and doc_id, so reruns agree; ties in the
    key go to the smaller doc_id.  The k largest are found by a distributed rank, not
    in one task.
    """
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 12)
    uniform = (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 48))
    keyed = staged(weighed.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(uniform))), "gumbel_keys")
    return (ranked(keyed, [], [-F.col("gumbel_key"), F.col("doc_id")], "place")
            .withColumn("kept", F.col("place") < F.lit(int(k))).drop("place"))
