"""Keyword search with the lexicon as a table.

The expression form in ``functions.scoring`` tests every keyword on every text, which
suits a lexicon of dozens.  Here texts and terms are cut into runs of like characters,
and a term's longest run must lie in a run of the text.  Each different run of all
documents is indexed once by its substrings as long as the lexicon's anchors (the first
``width`` characters of a term's run, or the whole of a shorter one); an equi-join on
them finds the terms a run may stand for.  Documents are dealt into buckets of bounded
size, and each bucket gets the runs it holds with their terms.  So the work follows the
words and the hits, not documents times substrings, and no text is paired with a term
that shares nothing with it.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ipscope.operators.parallel import spread

#: Runs of word characters, of white space, and of any others; a text is cut alike wherever it is cut.
RUNS = (r"[a-z0-9_]+", r"\s+", r"[^a-z0-9_\s]+")
_RUN, _WORD = re.compile("|".join(RUNS), re.ASCII), frozenset("abcdefghijklmnopqrstuvwxyz0123456789_")
#: Bytes of text in a bucket of documents, about.
BUCKET_BYTES = 16 << 20


def runs(text: Column, kinds: tuple[str, ...] = RUNS) -> Column:
    return F.regexp_extract_all(text, F.lit("|".join(kinds)), F.lit(0))


def anchors(lexicon: DataFrame, term: str = "term", width: int = 4) -> DataFrame:
    """Distinct lower-case terms with their longest run (``part``) and its kind (a place in ``RUNS``), the
    characters before it, whether any are behind it, and the run's anchor; null and empty terms go."""
    t = lexicon.select(F.lower(F.col(term)).alias("term")).filter("term <> ''").distinct()
    longest = F.array_max(F.transform(runs("term"), lambda r, i: F.struct(F.length(r).alias("n"), r.alias("part"), i.alias("i"))))
    t = t.select("term", longest.alias("l"), F.array_join(F.slice(runs("term"), 1, longest["i"]), "").alias("head"))
    kind = F.when(F.rlike("l.part", F.lit(RUNS[0])), 0).when(F.rlike("l.part", F.lit(RUNS[1])), 1).otherwise(2)
    return t.select("term", "l.part", kind.alias("kind"), F.length("head").alias("before"),
                    (F.length("head") + F.col("l.n") < F.length("term")).alias("behind"), F.substring("l.part", 1, width).alias("anchor"))


def substrings(text: Column, lengths: list[int]) -> Column:
    """Distinct substrings of the given lengths; a long text is cut into characters once, not counted through for each."""
    every = lambda cut: F.array_distinct(F.concat(*[F.coalesce(cut(n), F.array().cast("array<string>")) for n in lengths]))
    places = lambda size, n, at: F.when(size >= n, F.transform(F.sequence(F.lit(1), size - (n - 1)), at))
    short = every(lambda n: places(F.length(text), n, lambda i: F.substring(text, i, n)))
    long = F.element_at(F.transform(F.array(F.split(text, "")), lambda c: every(
        lambda n: places(F.size(c), n, lambda i: F.array_join(F.slice(c, i, n), "")))), 1)
    return F.when(F.length(text) <= 64, short).otherwise(long)


def terms_of_runs(index: DataFrame, lex: DataFrame, lengths: list[int]) -> DataFrame:
    """(bucket, run, terms, shifts) of distinct (bucket, run): the terms whose longest run lies in the run.

    A term that goes on before its longest run can only begin the run with it, and one
    that goes on behind can only end it; its shift is where it then starts, counted from
    the start of the run (null for a term of one run).  The lexicon is broadcast only
    where Spark's size check allows it, else runs and lexicon meet by a shuffle on the
    anchor, whose hot values skew handling splits.
    """
    known = index.groupBy("run").agg(F.collect_list("bucket").alias("buckets"))
    cut = known.select("*", F.explode(substrings(F.col("run"), lengths)).alias("anchor"))
    begins, ends = F.col("before") > 0, F.col("behind")
    shift = F.when(begins, -F.col("before")).when(ends, F.length("run") - F.length("part"))
    found = (cut.join(lex, "anchor").filter(F.contains("run", "part") & (~begins | F.startswith("run", "part")) & (~ends | F.endswith("run", "part")))
             .groupBy("run").agg(F.collect_list(F.struct("term", shift.alias("shift"))).alias("found"), F.first("buckets").alias("buckets")))
    return found.select(F.explode("buckets").alias("bucket"), "run", F.col("found.term").alias("terms"), F.col("found.shift").alias("shifts"))


def match_rules(docs: DataFrame, lexicon: DataFrame, doc_id: str = "doc_id", text: str = "text", term: str = "term",
                width: int = 4, partitions: int | None = None) -> DataFrame:
    """(doc_id, anywhere, whole), one row per row of ``docs``: the sorted terms its lower-case text
    contains, and those of them with no ASCII letter, digit or underscore on either side (Q1).

    A null or empty text contains nothing.  The terms of a document are held together: at
    most as many as its text has different ones.  ``partitions`` spreads documents that
    come in too few splits.
    """
    lex = anchors(lexicon, term, width)
    met = lex.select(F.length("anchor"), "kind").distinct().collect()  # at most ``width`` lengths of each kind
    lengths, kinds = sorted({r[0] for r in met}), tuple(RUNS[k] for k in sorted({r[1] for r in met}))
    none = F.array().cast("array<string>")
    if not lengths:
        return docs.select(F.col(doc_id).alias("doc_id"), none.alias("anywhere"), none.alias("whole"))
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    n = max(partitions or 1, size // BUCKET_BYTES + 1)
    low = spread(docs.select(F.col(doc_id).alias("doc_id"), F.lower(F.col(text)).alias("t")), partitions)
    low = low.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "t"), F.lit(n)).cast("int"))
    index = low.select("bucket", F.explode(runs(F.col("t"), kinds)).alias("run")).distinct()
    terms = terms_of_runs(index, lex, lengths)
    id_type = low.schema["doc_id"].dataType.simpleString()
    return low.groupBy("bucket").cogroup(terms.groupBy("bucket")).applyInArrow(
        _match_bucket, f"doc_id {id_type}, anywhere array<string>, whole array<string>")


def match_lexicon(docs: DataFrame, lexicon: DataFrame, doc_id: str = "doc_id", text: str = "text", term: str = "term",
                  width: int = 4, word_boundary: bool = False, partitions: int | None = None) -> DataFrame:
    """(doc_id, terms): for each document the sorted terms its lower-case text contains, or with
    ``word_boundary`` only those that stand whole; see ``match_rules``."""
    found = match_rules(docs, lexicon, doc_id, text, term, width, partitions)
    return found.select("doc_id", F.col("whole" if word_boundary else "anywhere").alias("terms"))


def _match_bucket(docs: pa.Table, terms: pa.Table) -> pa.Table:
    """The terms of each document of a bucket, from the terms of its runs; those of several runs are compared where the run is."""
    alone, joint = {}, {}  # run -> its terms of one run; its terms of several, with their shifts
    for run, found, shifts in zip(terms["run"].to_pylist(), terms["terms"].to_pylist(), terms["shifts"].to_pylist()):
        alone[run] = [t for t, s in zip(found, shifts) if s is None]
        if len(alone[run]) < len(found):
            joint[run] = [(t, s) for t, s in zip(found, shifts) if s is not None]
    anywhere, whole = [], []
    for text in docs["t"].to_pylist():
        cut = _RUN.findall(text or "")
        held = set(cut)
        found = set().union(*[alone[r] for r in held & alone.keys()])
        # a word stands whole where it is all of a run
        fit = {t for t in found if (t in held if t[0] in _WORD else _whole(text, t))}
        starts = defaultdict(list)
        for run, start in zip(cut, accumulate(map(len, cut), initial=0)):
            if run in joint:
                starts[run].append(start)
        for run, places in starts.items():
            for term, shift in joint[run]:
                for at in places:
                    if text.startswith(term, at + shift) and at + shift >= 0:
                        found.add(term)
                        if _stands(text, at + shift, term):
                            fit.add(term)
                            break
        anywhere.append(sorted(found))
        whole.append(sorted(fit))
    strings = pa.list_(pa.string())
    return pa.table({"doc_id": docs["doc_id"], "anywhere": pa.array(anywhere, strings), "whole": pa.array(whole, strings)})


def _stands(text: str, at: int, term: str) -> bool:
    """Whether the term found at a place of the text stands between word boundaries."""
    return text[at - 1:at] not in _WORD and text[at + len(term):at + len(term) + 1] not in _WORD


def _whole(text: str, term: str) -> bool:
    at = text.find(term)
    while at >= 0:
        if _stands(text, at, term):
            return True
        at = text.find(term, at + 1)
    return False
