"""Tables in one global order (T3): range-partitioned files, sorted inside, ranges apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_ordered(df: DataFrame, path: str, key: str, files: int) -> None:
    """At most ``files`` Parquet files; every key of one is less than every key of the next."""
    (df.repartitionByRange(files, key).sortWithinPartitions(key).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").parquet(path))


def file_ranges(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A row per file: file, rows, least and greatest key."""
    rows = spark.read.parquet(path)
    return rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(key).alias("least"), F.max(key).alias("greatest"))


def positions(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The table with each row's place in the order, from the files as they are: rows of the files before, and place in its file."""
    ranges = file_ranges(spark, path, key)
    before = Window.orderBy("least").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    starts = ranges.select("file", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    rows = spark.read.parquet(path)
    placed = rows.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    return placed.join(starts, "file").withColumn("position", F.col("start") + F.col("at")).drop("file", "at", "start")
