"""Helpers shared by the training-data operators.

Tables that are read more than once, and lineage cuts, are Parquet folders under
the shared folder the cluster names in ``spark.checkpoint.dir``: they outlive
lost executors and are visible to every one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ipscope.session import scratch_path

#: White space of the word-based contracts, as a regular-expression class.
ASCII_SPACE = r"[\x20\x09-\x0D]"
ASCII_WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def staged(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` once under the shared folder and read it back (a durable lineage cut)."""
    path = scratch_path(df.sparkSession, "llm", label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, group: list[str], order: list[Column], rank: str = "rank") -> DataFrame:
    """Zero-based rank of each row within its group, for groups of any size.

    Rows are dealt by range of (group, order), so a group holding most rows is
    spread over many tasks; each slice is ranked on its own and shifted by the
    rows of the group's earlier slices (one row per group and slice).  Group
    columns must not be null.  Rows equal in all of ``order`` get ranks in any order.
    """
    spark = df.sparkSession
    slices = 4 * shuffle_partitions(spark)  # small slices even out when dealt by hash
    keys = [F.col(g) for g in group]
    cols = {f"__o{i}": c for i, c in enumerate(order)}
    cut = staged(df.withColumns(cols).repartitionByRange(slices, *keys, *[F.col(c) for c in cols])
                 .withColumn("__slice", F.spark_partition_id()), "ranked")
    by = [*group, "__slice"]
    before = Window.partitionBy(*group).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    shift = (cut.groupBy(*by).agg(F.count("*").alias("__n"))
             .select(*by, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift")))
    inside = F.row_number().over(Window.partitionBy(*by).orderBy(*cols)) - 1
    return (cut.withColumn(rank, inside).join(shift, by)
            .withColumn(rank, (F.col(rank) + F.col("__shift")).cast("long"))
            .drop("__slice", "__shift", *cols))


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows with about ``most`` bytes of text (one row at least)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, n in enumerate(sizes):
            if total and total + n > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        yield batch.slice(start)


class WordHashes(dict):
    """64-bit hashes of words; a worker keeps those of up to ``most`` words, then starts anew."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h

    def of(self, parts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words of all texts one after another, and each text's number of words."""
        size = np.array([len(p) for p in parts], np.int64)
        return np.fromiter(map(self.__getitem__, chain.from_iterable(parts)), np.uint64, int(size.sum())), size


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_HELD: dict = {}


def held(owner: str, key, make):
    """What an operator keeps in a worker between tasks; one operator at a time keeps anything.

    Workers serve one job after another, and what two operators hold must not add up.
    """
    if _HELD.get("owner") != owner:
        _HELD.clear()
        _HELD["owner"] = owner
        pa.default_memory_pool().release_unused()
    if key not in _HELD:
        _HELD[key] = make()
    return _HELD[key]
