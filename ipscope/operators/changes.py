"""Change control between snapshots: diff, fingerprint, carry-forward.

* ``diff_snapshots`` — one full outer join of last-wins-deduped snapshots on the
  key classifies every key as new / removed / changed / same (J5, J6; null
  equals null in the record comparison).
* ``fingerprint`` — an order-independent multiset digest (A6).  Each row is
  hashed (SHA-256 of its canonical JSON: sorted keys, no spaces, explicit
  nulls); four 60-bit slices of the row hashes are summed as exact decimals,
  and the digest is SHA-256 over ``count:sum1:sum2:sum3:sum4``.  Equal
  multisets of rows give equal digests; the aggregation is fully map-side
  combinable, so no group or row list is ever collected.
* ``digest_tree`` — the same digest in two levels: one for each hash bucket of the
  key, and a root over them.  Snapshots are compared bucket by bucket, and a diff
  reads only the buckets whose digests differ.
* ``carry_changes`` / ``carry_forward`` — old snapshot ∪ fresh records by key (J11) with
  first-ingestion kept and a seen counter (A5 counters alongside).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ipscope.functions.sqltext import ident, strip
from ipscope.operators.dedupe import last_wins

STATE_COLUMNS = ["ip_address", "abuse_confidence_score", "last_reported_at", "country_code"]


def canonical_json(cols: list[str]) -> Column:
    """JSON object with keys in sorted order, compact separators, explicit nulls."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(cols)]), {"ignoreNullFields": "false"})


def row_digest(cols: list[str]) -> Column:
    """SHA-256 hex of the canonical JSON of ``cols``."""
    return F.sha2(canonical_json(cols), 256)


def _multiset(rows: DataFrame, by: list[str]) -> DataFrame:
    """(by…, record_count, fingerprint) of rows with their digest in ``h``: combined map-side, no row list."""
    parts = [F.conv(F.substring("h", 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)") for i in range(4)]
    agg = rows.groupBy(*by).agg(F.count("*").alias("record_count"),
                                *[F.coalesce(F.sum(p), F.lit(0).cast("decimal(38,0)")).alias(f"s{i}")
                                  for i, p in enumerate(parts)])
    text = F.concat_ws(":", F.col("record_count").cast("string"),
                       *[F.col(f"s{i}").cast("string") for i in range(4)])
    return agg.select(*by, "record_count", F.sha2(text, 256).alias("fingerprint"))


def fingerprint(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row ``(record_count, fingerprint)`` for the multiset of rows."""
    cols = cols or [c for c in df.columns if c != "pos"]
    return _multiset(df.select(row_digest(cols).alias("h")), [])


def bucket_of(key: str, buckets: int) -> Column:
    """Hash bucket of a key; all rows of a key share it."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def digest_tree(df: DataFrame, buckets: int, key: str = "ip_address", cols: list[str] | None = None) -> DataFrame:
    """``(bucket, record_count, fingerprint)`` for each bucket that has rows."""
    cols = cols or [c for c in df.columns if c != "pos"]
    return _multiset(df.select(bucket_of(key, buckets).alias("bucket"), row_digest(cols).alias("h")), ["bucket"])


def tree_root(tree: DataFrame) -> DataFrame:
    """One row ``(record_count, fingerprint)`` over a digest tree, which has at most as many rows as buckets."""
    leaves = F.transform(F.array_sort(F.collect_list(F.struct("bucket", "fingerprint"))),
                         lambda x: F.concat_ws(":", x["bucket"].cast("string"), x["fingerprint"]))
    return tree.agg(F.coalesce(F.sum("record_count"), F.lit(0)).cast("long").alias("record_count"),
                    F.sha2(F.array_join(leaves, ","), 256).alias("fingerprint"))


def changed_buckets(prev_tree: DataFrame, curr_tree: DataFrame) -> list[int]:
    """The buckets whose digests differ, or that one tree lacks: at most as many numbers as there are buckets."""
    leaf = lambda t, n: t.select("bucket", F.col("fingerprint").alias(n))
    both = leaf(prev_tree, "p").join(leaf(curr_tree, "c"), "bucket", "full_outer")
    return sorted(r.bucket for r in both.filter(~F.col("p").eqNullSafe(F.col("c"))).collect())


def diff_snapshots(prev: DataFrame, curr: DataFrame, key: str = "ip_address",
                   cols: list[str] | None = None, pos: str | None = "pos") -> DataFrame:
    """(key, change) for every key of either snapshot; change in new/removed/changed/same."""
    cols = cols or [c for c in STATE_COLUMNS if c != key]

    def keyed(df):
        d = last_wins(df, key, pos) if pos and pos in df.columns else df
        return d.select(key, F.struct(*cols).alias("rec"), F.lit(True).alias("present"))

    p, c = keyed(prev).alias("p"), keyed(curr).alias("c")
    j = p.join(c, F.col(f"p.{key}") == F.col(f"c.{key}"), "full_outer")
    change = (F.when(F.col("p.present").isNull(), F.lit("new"))
              .when(F.col("c.present").isNull(), F.lit("removed"))
              .when(~F.col("p.rec").eqNullSafe(F.col("c.rec")), F.lit("changed"))
              .otherwise(F.lit("same")))
    return j.select(F.coalesce(F.col(f"p.{key}"), F.col(f"c.{key}")).alias(key), change.alias("change"))


def diff_summary(diff: DataFrame) -> DataFrame:
    """A4: counts of new / changed / removed keys (one pass)."""
    return diff.agg(
        F.count_if(F.col("change") == "new").alias("new_ip_count"),
        F.count_if(F.col("change") == "changed").alias("changed_ip_count"),
        F.count_if(F.col("change") == "removed").alias("removed_ip_count"))


def diff_samples(diff: DataFrame, n: int = 10, key: str = "ip_address") -> DataFrame:
    """T4: the first ``n`` keys (ascending) of each change class.

    One pass over the diff: the rank limit is pushed below the window's shuffle
    (WindowGroupLimit), so a task sends at most ``n`` keys of each class.
    """
    place = F.row_number().over(Window.partitionBy("change").orderBy(key))
    return (diff.filter(F.col("change").isin("new", "changed", "removed"))
            .withColumn("_place", place).filter(F.col("_place") <= n).select(key, "change"))


def snapshots_differ(prev_fp: DataFrame, curr_fp: DataFrame) -> DataFrame:
    """The gate: one row telling whether the fingerprints differ (no previous = changed)."""
    tagged = (prev_fp.select(F.lit("p").alias("t"), "fingerprint", "record_count")
              .unionByName(curr_fp.select(F.lit("c").alias("t"), "fingerprint", "record_count")))
    out = tagged.agg(
        F.max(F.when(F.col("t") == "p", F.col("fingerprint"))).alias("previous_fingerprint"),
        F.max(F.when(F.col("t") == "c", F.col("fingerprint"))).alias("current_fingerprint"),
        F.max(F.when(F.col("t") == "c", F.col("record_count"))).alias("record_count"))
    return out.withColumn("changed", F.col("previous_fingerprint").isNull()
                          | (F.col("previous_fingerprint") != F.col("current_fingerprint")))


def _newest_first(df: DataFrame, key: str) -> list[str]:
    """Columns that order records of one key: the newest ingestion, then the rest."""
    rest = [c for c in df.columns if c != key]
    return sorted(rest, key=lambda c: c != "last_ingestion_time")


def carry_changes(old: DataFrame, candidates: DataFrame, fresh: DataFrame,
                  update_existing: bool = False, key: str = "ip",
                  retry_errors: bool = False, status: str = "status") -> DataFrame:
    """Merge freshly fetched records into the previous snapshot.

    ``old`` — previous snapshot records (with ``pos`` when ordered; last wins).
    ``candidates`` — IPs wanted this run.  ``fresh`` — fetched records for IPs
    (only those not skipped are used).  Returns the snapshot's rows with what happened to
    each in ``_run_change``: new, updated, skipped (wanted, but known) or kept.
    Updated rows keep the old ``first_ingestion_time`` and count
    ``seen_count = coalesce(old, 1) + 1``; untouched old rows stay intact.
    ``retry_errors`` also refetches IPs whose stored row is an error row (Q12).
    """
    old_d = last_wins(old, key, "pos") if "pos" in old.columns else old
    old_d = old_d.drop("pos")
    cand = candidates.select(strip(F.col(key)).alias(key)).filter(
        F.col(key).isNotNull() & (F.col(key) != "")).distinct()
    known = old_d
    if retry_errors and status in old_d.columns:
        known = old_d.filter(F.col(status) == "ok")  # error rows count as unknown
    to_fetch = cand if update_existing else cand.join(known.select(key), key, "left_anti")
    f = fresh.join(to_fetch, key, "left_semi")
    f = (last_wins(f, key, "pos") if "pos" in f.columns
         else f.groupBy(key).agg(F.max(F.struct(*_newest_first(f, key))).alias("_w"))
         .select(key, *[f"_w.{c}" for c in f.columns if c != key])).drop("pos")
    cols = old_d.columns
    o = old_d.selectExpr(*[f"{ident(c)} AS {ident('o_' + c)}" for c in cols], "true AS o_present")
    n = f.selectExpr(*[f"{ident(c) if c in f.columns else 'NULL'} AS {ident('n_' + c)}" for c in cols],
                     "true AS n_present")
    j = o.join(n, F.col(f"o_{key}") == F.col(f"n_{key}"), "full_outer")
    upd = "(o_present AND n_present)"
    out = []
    for c in cols:
        oc, nc = ident("o_" + c), ident("n_" + c)
        if c == key:
            v = f"coalesce({nc}, {oc})"
        elif c == "first_ingestion_time":
            v = f"CASE WHEN {upd} THEN coalesce({oc}, {nc}) WHEN n_present THEN {nc} ELSE {oc} END"
        elif c == "seen_count":
            t = old_d.schema[c].dataType.simpleString()
            v = (f"CASE WHEN {upd} THEN CAST(coalesce(CAST({oc} AS INT), 1) + 1 AS {t}) "
                 f"WHEN n_present THEN {nc} ELSE {oc} END")
        else:
            v = f"CASE WHEN n_present THEN {nc} ELSE {oc} END"
        out.append(f"{v} AS {ident(c)}")
    flag = f"CASE WHEN {upd} THEN 'updated' WHEN n_present THEN 'new' ELSE 'kept' END AS _run_change"
    snap = j.selectExpr(*out, flag)
    # Skipped: wanted, known, not fetched again. Such a row is in the snapshot as it was.
    skipped = cand.select(F.col(key).alias("_wanted"))
    if update_existing:
        skipped = skipped.limit(0)
    elif known is not old_d:
        skipped = skipped.join(known.select(F.col(key).alias("_wanted")), "_wanted", "left_semi")
    return snap.join(skipped, F.col(key) == F.col("_wanted"), "left").select(
        *cols, F.when((F.col("_run_change") == "kept") & F.col("_wanted").isNotNull(), "skipped").otherwise(F.col("_run_change"))
        .alias("_run_change"))


def carry_counters() -> dict[str, Column]:
    """A5: the run's counters as aggregates over ``carry_changes`` rows."""
    count = lambda change: F.count_if(F.col("_run_change") == change)
    return {"new_count": count("new"), "updated_count": count("updated"), "skipped_count": count("skipped"),
            "total_unique": F.count(F.lit(1))}


def carry_forward(old: DataFrame, candidates: DataFrame, fresh: DataFrame, update_existing: bool = False,
                  key: str = "ip", retry_errors: bool = False, status: str = "status") -> tuple[DataFrame, DataFrame]:
    """``carry_changes`` as ``(snapshot, counters)``; a job that writes the snapshot counts in the same pass instead."""
    rows = carry_changes(old, candidates, fresh, update_existing, key, retry_errors, status)
    return rows.drop("_run_change"), rows.agg(*[c.alias(n) for n, c in carry_counters().items()])
