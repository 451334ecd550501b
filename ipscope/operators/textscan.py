"""Scans over free text: attack-keyword classification and IP extraction.

Both read whole texts.  Lower-casing happens once per row; the 32 keyword tests
are native ``contains`` calls inside one ``filter`` expression (codegen, no
Python).  IP extraction is a native ``regexp_extract_all`` followed by the
validity regex; per-IP counts are a partial-aggregated ``groupBy``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ipscope.functions.ip import IPV4_TOKEN_RE, ip_version
from ipscope.functions.scoring import matched_categories, matched_keywords
from ipscope.operators.parallel import spread


def classify_text(df: DataFrame, text: str = "text", word_boundary: bool = False,
                  partitions: int | None = None) -> DataFrame:
    """J10/H7 over a text column: adds ``attack_keywords_matched``, ``attack_categories``.

    ``partitions`` spreads texts that come in too few splits.
    """
    # Lower-case once into its own column; the 32 keyword tests then read it.
    low = spread(df, partitions).select("*", F.lower(F.col(text)).alias("_lt"))
    out = low.select(*df.columns, matched_keywords("_lt", word_boundary).alias("attack_keywords_matched"))
    return out.withColumn("attack_categories", matched_categories("attack_keywords_matched"))


def ip_tokens(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), partitions: int | None = None) -> DataFrame:
    """One row per dotted-quad token found in ``text`` (duplicates kept)."""
    toks = F.regexp_extract_all(F.col(text), F.lit(IPV4_TOKEN_RE), 0)
    return spread(df, partitions).select(*keep, F.explode(toks).alias("ip_token"))


def ip_token_counts(df: DataFrame, text: str = "text", key: str = "doc_id", partitions: int | None = None) -> DataFrame:
    """Per token: validity/version, documents containing it, total occurrences."""
    t = ip_tokens(df, text, (key,), partitions)
    return (t.groupBy("ip_token")
            .agg(F.count("*").alias("n_occurrences"), F.count_distinct(key).alias("n_docs"))
            .withColumn("ip_version", ip_version(F.col("ip_token"))))
