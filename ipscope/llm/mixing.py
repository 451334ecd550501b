"""Mixing sources to target weights by systematic sampling.

Within a source every document expects the same number of copies; documents are
put in order of size, expected copies are prefix-summed, one random offset is
added, and a document is emitted once per integer boundary its interval crosses.
The order by size spreads the draws over small and large documents alike, so a
source's words come within about one document of its target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ipscope.llm.common import ASCII_WORD, ranked, staged


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """Words to take from each source (columns src_null, src, source_size, target).

    ``sizes`` has src_null, src and size per document.  Sources in code-point
    order, null last, weigh ``weights`` in turn; ``share`` of all words is dealt by
    weight; a target stops at ``most`` times its source's size and the excess is
    dealt again by weight until none is above.  Each round is one aggregate over
    the sources; only its two sums reach the driver.
    """
    totals = staged(sizes.groupBy("src_null", "src").agg(F.sum("size").alias("source_size")), "mix_sources")
    place = ranked(totals, [], [F.col("src_null"), F.col("src")], "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = staged(place.select("src_null", "src", "source_size", weight.alias("weight")), "mix_weights")
    cap = F.col("source_size") * F.lit(most)
    words = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * share
    level, last = 0.0, None
    while level != last:
        last = level
        full = cap < F.col("weight") * F.lit(level)
        capped, open_weight = sources.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))).first()
        level = (words - capped) / open_weight if open_weight else last
    return sources.select("src_null", "src", "source_size",
                          F.least(cap, F.col("weight") * F.lit(level)).alias("target"))


def plan_mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
             weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
             seed: str = "mix") -> DataFrame:
    """Copies of each document: doc_id, size, source_size, target, copies, taken.

    One row per input row.  A null text has size 0 and a null source is a source
    of its own, last in order.  Documents of a source without words are taken no
    times.  Repeated rows are drawn one by one, so a doc_id that occurs k times has
    k rows.  Ties in size are ordered by a digest of doc_id (null first), so runs
    agree; ``seed`` changes the offsets.  An empty table gives no rows.
    """
    sizes = staged(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).isNull().alias("src_null"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("src"),
        F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(ASCII_WORD)).cast("long").alias("size")),
        "mix_sizes")
    targets = source_targets(sizes, weights, share, most)
    shuffled = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    order = ranked(sizes, ["src_null", "src"], [F.col("size"), shuffled, F.col("doc_id")])
    # A source is one row of ``targets``; a hot one is split by the runtime's skew join.
    rows = staged(order, "mix_order").join(targets, ["src_null", "src"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.col("src_null").cast("int").cast("string"), F.col("src"))), 1, 6)
    offset = F.conv(digits, 16, 10).cast("double") / F.lit(16777216.0)
    rows = rows.withColumn("rate", rate).withColumn("offset", offset)
    below = F.floor(F.col("rank") * F.col("rate") + F.col("offset"))
    above = F.floor((F.col("rank") + 1) * F.col("rate") + F.col("offset"))
    return (rows.withColumn("copies", (above - below).cast("long"))
            .select("doc_id", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def mix(docs: DataFrame, doc_id: str = "doc_id", **how) -> DataFrame:
    """The mixed table: each row of ``docs`` as often as the plan takes it, columns unchanged.

    The draws of rows that share a doc_id (null included) are added up and dealt
    evenly over them.  Arguments and edge cases are those of ``plan_mix``.
    """
    drawn = plan_mix(docs, doc_id, **how).groupBy(F.col("doc_id").alias("__id")).agg(
        F.sum("copies").alias("__copies"), F.count("*").alias("__rows"))
    columns = docs.columns
    joined = docs.join(drawn.filter("__copies > 0"), F.col(doc_id).eqNullSafe(F.col("__id")))
    turn = F.row_number().over(Window.partitionBy("__id").orderBy(F.xxhash64(*columns)))
    share = F.floor(F.col("__copies") / F.col("__rows")) + (F.col("__turn") <= F.col("__copies") % F.col("__rows")).cast("long")
    return (joined.withColumn("__turn", turn).withColumn("__times", share.cast("int")).filter("__times > 0")
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*columns))
