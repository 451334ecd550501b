"""Corpus pipeline: from raw documents to token ids.

Language ID drops texts without a language, exact and near duplicates are reduced to
one document each, the sources are mixed to their target weights, and what is left
is encoded.  Every stage works on all rows its predecessor kept.  The first four
return the columns of ``documents``; the last one returns the encoded documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ipscope.llm import bpe_lexicon, language, mixing, near_dup
from ipscope.llm.common import staged, table
from ipscope.llm.exact_dedup import DigestIndex
from ipscope.session import scratch_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose text is null or has no letter (language ``und``)."""
    model = language.fit(docs.filter(~language.held_out(F.col("doc_id"))), PIECES)
    if not model.languages:  # no labelled document to learn from: all texts with a letter stay
        return language.lettered(docs)
    labelled = language.label(docs, model, lang="__lang", score="__score")
    return labelled.filter("__lang <> 'und'").select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each text, compared without white space."""
    return DigestIndex(spark, scratch_path(spark, "llm", "pipeline_index")).keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates (five words, similarity 0.8): the smallest doc_id, a null one last."""
    return near_dup.keep(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents of each source until its target of words, some of them twice."""
    return mixing.mix(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes every text and decodes it again: doc_id, n_tokens, ids, ids_sha256, decoded_sha256."""
    lexicon = bpe_lexicon.build_lexicon(docs, BYTE_BPE)
    return bpe_lexicon.digests(bpe_lexicon.round_trip(docs, BYTE_BPE, lexicon), "ids")


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("source_mix", source_mix), ("bpe", bpe)]

#: SQL cannot express the learned, hashed and encoding stages; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
