"""Reads by key list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_of_keys(df: DataFrame, keys: DataFrame, key: str = "ip_address") -> DataFrame:
    """The rows of ``df`` whose key occurs in ``keys`` (null keys match nothing).

    Up to ``spark.sql.parquet.pushdown.inFilterThreshold`` distinct keys become a list of
    equalities that the scan tests against row-group statistics and Bloom filters;
    more keys are a semi join, for which Spark makes a runtime Bloom filter of the keys
    when the scan is large.
    """
    few = int(df.sparkSession.conf.get("spark.sql.parquet.pushdown.inFilterThreshold"))
    wanted = keys.select(F.col(key)).filter(F.col(key).isNotNull()).distinct()
    listed = [r[0] for r in wanted.limit(few + 1).collect()]  # at most few + 1 keys
    if len(listed) <= few:
        return df.filter(F.col(key).isin(listed)) if listed else df.filter(F.lit(False))
    return df.join(wanted, key, "left_semi")
