"""Reports with the snapshot version that was in force.

``pinned`` takes one version for all reports, the newest at a given time, as a stream does
that loads its snapshots at start-up.  ``asof_versions`` gives every report the newest
version of its key at the report's own time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _versions(versions: DataFrame, key: str, version_ts: str) -> DataFrame:
    """One row per key and time: of equal ones the greatest by all other columns."""
    rest = sorted(c for c in versions.columns if c not in (key, version_ts))
    return versions.filter(F.col(key).isNotNull() & F.col(version_ts).isNotNull()).groupBy(
        F.col(key).alias("_k"), F.col(version_ts).alias("_t")).agg(F.max(F.struct(*rest)).alias("_v"))


def pinned(reports: DataFrame, versions: DataFrame, at, key: str = "ip_address", version_ts: str = "version_ts") -> DataFrame:
    """``reports`` with the columns of the newest version of their key up to ``at`` (a Column), null without one."""
    v = _versions(versions, key, version_ts).filter(F.col("_t") <= at)
    newest = v.groupBy("_k").agg(F.max(F.struct("_t", "_v")).alias("_n"))
    j = reports.join(newest, reports[key] == newest["_k"], "left")
    return j.select(*reports.columns, F.col("_n._t").alias(version_ts), "_n._v.*")


def asof_versions(reports: DataFrame, versions: DataFrame, ts: str, key: str = "ip_address", version_ts: str = "version_ts",
                  slice_seconds: int = 86_400) -> DataFrame:
    """``reports`` with the columns of the newest version of their key at or before ``ts``, null without one.

    Reports and versions are put in one order of time per key and the last version seen is
    carried on.  A key is cut into slices of ``slice_seconds``, each ordered on its own and
    started from the last version before it, so a key that holds a third of all reports is
    many tasks' work; per key only the versions, one a slice at most, meet in one place.
    Reports with a null key or time keep their row and get no version.
    """
    v = _versions(versions, key, version_ts)
    slot = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / F.lit(slice_seconds * 1_000_000)).cast("long")
    r = reports.select(F.col(key).alias("_k"), F.col(ts).alias("_t"), F.struct(*reports.columns).alias("_r")).withColumn("_s", slot("_t"))
    v = v.select("_k", "_t", F.struct(F.col("_t").alias(version_ts), "_v.*").alias("_v")).withColumn("_s", slot("_t"))
    rows = r.withColumn("_v", F.lit(None).cast(v.schema["_v"].dataType)).unionByName(
        v.withColumn("_r", F.lit(None).cast(r.schema["_r"].dataType)))
    # At the same time the version comes first.
    order = Window.partitionBy("_k", "_s").orderBy("_t", F.col("_r").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.withColumn("_here", F.last("_v", ignorenulls=True).over(order)).filter(F.col("_r").isNotNull())
    # What each slice with reports starts from: the last version of an earlier slice.
    ends = v.groupBy("_k", "_s").agg(F.max_by("_v", "_t").alias("_end"))
    slots = (r.filter(F.col("_k").isNotNull() & F.col("_s").isNotNull()).select("_k", "_s").distinct()
             .join(ends, ["_k", "_s"], "full_outer"))
    before = Window.partitionBy("_k").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    carried = slots.select("_k", "_s", F.last("_end", ignorenulls=True).over(before).alias("_before"))
    out = inside.join(carried, ["_k", "_s"], "left").withColumn("_v", F.coalesce("_here", "_before"))
    return out.select("_r.*", "_v.*")
