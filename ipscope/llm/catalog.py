"""Registered queries of the training-data operators, with SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ipscope.llm import bpe_lexicon, fill_middle, language, licenses, oracles, quality, token_files, url_filter, whitening
from ipscope.llm.common import staged, table
from ipscope.llm.embedding_dedup import near_vectors
from ipscope.llm.exact_dedup import DigestIndex
from ipscope.llm.mixing import plan_mix
from ipscope.llm.near_dup import near_duplicates
from ipscope.llm.repeats import remove_repeats
from ipscope.session import scratch_path


#: Vocabularies of the encoding queries and of language ID.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.fit(docs)).select(
        "doc_id", "n_paragraphs", F.size("found").cast("long").alias("n_found"),
        F.array_join(F.array_sort(F.array_distinct("found.family")), ",").alias("families"),
        F.array_max("found.probability").alias("probability"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm", "token_files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, BYTE_BPE)
    return token_files.read_token_files(spark, path).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.filter(~language.held_out(F.col("doc_id"))), PIECES)
    return language.predict(docs, model).select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = DigestIndex(spark, scratch_path(spark, "llm", "digest_index"))
    return index.add(table(spark, sf_dir, "documents"))


def op8_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op9_quality_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keeps as large a share of the documents as the labels call good."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    ratio = quality.fit(docs, labels.filter("quality = 1"))
    share = labels.agg(F.coalesce(F.avg(F.col("quality").cast("double")), F.lit(1.0))).first()[0]
    weighed = staged(quality.weigh(docs, ratio), "quality_weights")
    return quality.resample(weighed, round(share * weighed.count()))


def op10_bpe_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = bpe_lexicon.build_lexicon(docs, BYTE_BPE)
    return bpe_lexicon.digests(bpe_lexicon.round_trip(docs, BYTE_BPE, lexicon))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors)
    return whitening.components(whitening.whiten(vectors, model), model)


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.transform(table(spark, sf_dir, "documents")))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.fit(url_filter.labelled_urls(spark))
    return url_filter.judge(table(spark, sf_dir, "pages"), model)


_QUERIES = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_license_scan": op2_license_scan,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_token_files": op4_token_files,
    "op5_source_mix": op5_source_mix,
    "op6_language_id": op6_language_id,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_repeat_removal": op8_repeat_removal,
    "op9_quality_resample": op9_quality_resample,
    "op10_bpe_lexicon": op10_bpe_lexicon,
    "op11_whitening": op11_whitening,
    "op12_fill_middle": op12_fill_middle,
    "op13_url_filter": op13_url_filter,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return {"op5_source_mix": oracles.SOURCE_MIX, "op7_exact_dedup": oracles.EXACT_DEDUP,
            "op12_fill_middle": oracles.FILL_MIDDLE}
