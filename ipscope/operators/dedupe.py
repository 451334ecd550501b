"""Keyed dedupe, top-N and distinct-list operators.

Dedupe is an aggregation, not a window: ``groupBy(key).agg(max(struct(...)))``
keeps one winner per key with a deterministic total order and is combined
map-side (partial aggregation), so a hot key that holds a third of all rows is
reduced to one row per map task before the shuffle.  A ``row_number`` window
would instead sort every row of the hot key inside one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ipscope.functions.sqltext import ident, lit, strip


def _winner(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per ``key``: the row with the largest ``order`` tuple.

    ``order`` holds column names.  Ties on ``order`` are broken by every
    remaining column, so the survivor is the same on every run and every
    partitioning.  Built as SQL text (one JVM call for the whole struct).
    """
    rest = [c for c in df.columns if c != key]
    fields = [f"'_o{i}', {ident(o)}" for i, o in enumerate(order)] + \
             [f"{lit(c)}, {ident(c)}" for c in rest]
    return (df.groupBy(key).agg(F.expr(f"max(named_struct({', '.join(fields)}))").alias("_w"))
            .selectExpr(ident(key), *[f"_w.{ident(c)} AS {ident(c)}" for c in rest]))


def dedupe_latest(df: DataFrame, key: str = "ip_address",
                  ts: str = "last_reported_at", score: str | None = "abuse_confidence_score") -> DataFrame:
    """A1: one report per key — latest ``ts`` (nulls lose), then highest score."""
    order = [ts] + ([score] if score and score in df.columns else [])
    return _winner(df, key, order)


def last_wins(df: DataFrame, key: str = "ip_address", pos: str = "pos") -> DataFrame:
    """A2: keyed last-wins over an ordered list (largest ``pos`` survives)."""
    return _winner(df, key, [pos])


def latest_snapshot_rows(df: DataFrame, key: str = "ip_address",
                         order=("last_ingestion_time", "processed_at")) -> DataFrame:
    """Key-unique dimension rows: newest ingestion wins (Q10: no join fan-out)."""
    return _winner(df, key, [c for c in order if c in df.columns])


def distinct_ips(df: DataFrame, col: str = "ip_address", pos: str | None = "pos") -> DataFrame:
    """trimmed, non-blank, distinct IPs; keeps the first position of each."""
    ip = strip(F.col(col).cast("string"))
    base = df.select(ip.alias("ip_address"), *([F.col(pos)] if pos else []))
    base = base.filter(F.col("ip_address").isNotNull() & (F.col("ip_address") != ""))
    if not pos:
        return base.distinct()
    return base.groupBy("ip_address").agg(F.min(pos).alias("first_pos"))


def first_n_distinct(df: DataFrame, n: int | None = None, col: str = "ip_address",
                     pos: str = "pos") -> DataFrame:
    """The first ``n`` distinct IPs in list order (``n`` 0/None = all)."""
    d = distinct_ips(df, col, pos)
    if n:
        return d.orderBy("first_pos").limit(n)
    return d


def top_n_latest(df: DataFrame, n: int = 100, ts: str = "last_reported_at",
                 pos: str = "pos", key: str = "ip_address") -> DataFrame:
    """The ``n`` newest reports by text timestamp (missing sorts as '').

    Stable on ties (list position ascending); duplicate keys occupy slots.
    Planned as TakeOrderedAndProject: each task keeps its own top ``n``.
    """
    kept = df.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    return kept.orderBy(F.coalesce(F.col(ts), F.lit("")).desc(), F.col(pos).asc()).limit(n)
