"""Poison rows: every value gets a reason code, and one pass splits good from bad.

Reasons, the first that holds: ``not_json`` (null, blank, no JSON object), ``null_key``,
``blank_key``, ``wrong_type`` (a score that is there but is no number).  Good rows have none.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ipscope.functions.casts import safe_int
from ipscope.functions.sqltext import strip

FIELDS = ("ip_address", "country_code", "abuse_confidence_score", "last_reported_at", "ingestion_time", "processed_at")
# Every field is read as text: a float-typed writer's 100.0 is 100 by safe_int, not null (Q3).
VALUE = StructType([*(StructField(n, StringType(), True) for n in FIELDS), StructField("_corrupt", StringType(), True)])
LANDED = StructType([StructField("raw_value", StringType(), True), StructField("reason", StringType(), True),
                     *(StructField(n, IntegerType() if n == "abuse_confidence_score" else StringType(), True) for n in FIELDS)])


def judge_values(raw: DataFrame, value: str = "value") -> DataFrame:
    """LANDED rows: the raw text, why it cannot be used (null if it can), and the parsed record.

    A record in which the key or score is bad keeps its other fields; text that is no JSON
    object has none, even where it began like one.
    """
    text = F.col(value).cast("string")
    record = F.from_json(text, VALUE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    r = raw.select(text.alias("raw_value"), record.alias("r"))
    ip, score = strip(F.col("r.ip_address")), F.col("r.abuse_confidence_score")
    number = safe_int("r.abuse_confidence_score", None)
    reason = (F.when(F.col("r").isNull() | F.col("r._corrupt").isNotNull() | ~F.startswith(F.ltrim("raw_value"), F.lit("{")), "not_json")
              .when(ip.isNull(), "null_key").when(ip == "", "blank_key")
              .when(score.isNotNull() & number.isNull(), "wrong_type"))
    named = {"ip_address": ip, "abuse_confidence_score": number}
    judged = r.select("raw_value", reason.alias("reason"), *[named.get(n, F.col(f"r.{n}")).alias(n) for n in FIELDS])
    readable = ~F.col("reason").eqNullSafe(F.lit("not_json"))
    return judged.select("raw_value", "reason", *[F.when(readable, F.col(n)).alias(n) for n in FIELDS])


def land(judged: DataFrame, path: str, batch_id: int) -> None:
    """One pass: a batch's rows to ``batch_id=<n>/outcome=good`` and ``outcome=quarantine``; written again, both are replaced."""
    (judged.withColumns({"batch_id": F.lit(int(batch_id)), "outcome": F.when(F.col("reason").isNull(), "good").otherwise("quarantine")})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id", "outcome").parquet(path))


def landed(spark: SparkSession, path: str, outcome: str, batch_id: int | None = None) -> DataFrame:
    """LANDED rows of one outcome, of one batch or of all; no such folder gives no rows."""
    folder = f"{path}/batch_id={'*' if batch_id is None else int(batch_id)}/outcome={outcome}"
    try:
        return spark.read.schema(LANDED).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LANDED)
