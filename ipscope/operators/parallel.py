"""Parallelism for CPU-heavy per-row work on few input splits.

A scan yields one task per file split; a large unsplittable input (one Parquet
row group, one gzip file) would run all per-row work in one task.  Whoever knows
the input to be like that passes a number of partitions; by default the plan is
left alone, and nothing is looked at while it is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    return df if partitions is None else df.repartition(partitions)


def for_few_files(df: DataFrame) -> int | None:
    """Partitions for a scan of fewer files than there are cores; ``None`` (leave it alone) for any other."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return cores if len(df.inputFiles()) < cores else None
