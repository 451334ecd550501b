"""Snapshot sources: raw JSON envelopes, JSON-lines records, Parquet snapshots.

* ``read_envelope`` — the one-document-per-run format
  ``{source, ingestion_time, record_count, data: [...]}`` or a bare JSON list
  (S1/S2).  A document is a single value, so each file is one task; positions
  come from ``posexplode`` so last-wins and stable-tie rules stay exact.
* ``read_json_lines`` — the splittable layout for volume (one record per line);
  order is (file, block start, row id), exact within every file.
* ``newest_file`` — the newest object under a prefix by modification time
  (S3), ties broken by path; only the path/time columns are read.
* ``read_parquet_snapshot`` — typed read with an empty typed fallback (S4/S5).
"""

from __future__ import annotations

import re
from urllib.parse import urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType, TimestampType

from ipscope.schemas import envelope_schema


def parse_envelope_text(text_df: DataFrame, record_schema: StructType,
                        value: str = "value") -> DataFrame:
    """Whole-document JSON text -> one row per record with ``pos`` and envelope fields.

    Accepts an envelope object (records under ``data``) or a bare list; anything
    else yields no records.  The leading-character test is needed because
    ``from_json`` with an array schema would wrap a lone object into a list.
    """
    env_schema = envelope_schema(record_schema)
    v = F.ltrim(F.col(value))
    env = F.from_json(F.col(value), env_schema)
    as_list = F.from_json(F.col(value), ArrayType(record_schema))
    records = (F.when(v.startswith("["), as_list)
               .when(v.startswith("{"), env["data"]))
    meta = [env[f.name].alias(f"envelope_{f.name}") for f in env_schema.fields if f.name != "data"]
    keep = [c for c in text_df.columns if c != value]
    df = text_df.select(*keep, F.when(v.startswith("{"), F.struct(*meta)).alias("_env"),
                        F.posexplode_outer(records).alias("pos", "_rec"))
    df = df.filter(F.col("_rec").isNotNull())
    return df.select(*keep, "pos", "_env.*", "_rec.*")


def read_envelope(spark: SparkSession, path: str, record_schema: StructType) -> DataFrame:
    """Read envelope file(s) under ``path``; adds ``source_file``."""
    raw = (spark.read.text(path, wholetext=True)
           .select(F.col("_metadata.file_path").alias("source_file"), "value"))
    return parse_envelope_text(raw, record_schema)


def read_json_lines(spark: SparkSession, path: str, record_schema: StructType) -> DataFrame:
    """JSON lines, PERMISSIVE, explicit schema; ``pos`` orders rows exactly within a file."""
    df = spark.read.schema(record_schema).option("mode", "PERMISSIVE").json(path)
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.struct(F.col("_metadata.file_path").alias("file"),
                 F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("row")).alias("pos"))


def list_files(spark: SparkSession, root: str, suffix: str | None = None) -> DataFrame:
    """(path, modificationTime, length) of every file under ``root``; content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    return reader.load(root).select("path", "modificationTime", "length")


def newest_file(spark: SparkSession, root: str, suffix: str | None = None) -> str | None:
    """S3: newest file by modification time, ties by path; ``None`` when nothing matches."""
    try:
        files = list_files(spark, root, suffix)
    except Exception as e:  # noqa: BLE001 - a missing prefix is "no snapshot yet"
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return None
        raise
    row = (files.orderBy(F.col("modificationTime").desc(), F.col("path").asc())
           .select("path").limit(1).collect())
    return row[0]["path"] if row else None


def newest_per_prefix(spark: SparkSession, root: str, suffix: str | None = None, unit: str = "file") -> DataFrame:
    """S3/A10: (prefix, path, modified) of the newest object under each folder of ``root``.

    One aggregation over file names and times, no content.  An object is a file, or with
    ``unit="folder"`` a folder of part files, as new as its newest file.  Of equally new
    objects the one listed first (by path) wins.
    """
    base = re.escape(urlsplit(root).path.rstrip("/"))
    files = list_files(spark, root, suffix).select(
        F.regexp_extract("path", f"{base}/([^/]+)/", 1).alias("prefix"), F.col("modificationTime").alias("modified"),
        (F.regexp_extract("path", "^(.*)/[^/]*$", 1) if unit == "folder" else F.col("path")).alias("path")).filter("prefix <> ''")
    if unit == "folder":
        files = files.groupBy("prefix", "path").agg(F.max("modified").alias("modified"))
    first = files.groupBy("prefix", "modified").agg(F.min("path").alias("path"))  # settles ties
    return first.groupBy("prefix").agg(F.max_by("path", "modified").alias("path"), F.max("modified").alias("modified"))


def read_newest(spark: SparkSession, root: str, schema: StructType, suffix: str | None = None, unit: str = "file",
                fmt: str = "json") -> DataFrame:
    """The newest object of every prefix, each row with where it came from (S10): prefix, source_file, source_modified.

    One name a prefix comes back to the driver; only these objects are opened.
    """
    paths = [r.path for r in newest_per_prefix(spark, root, suffix, unit).collect()]
    names = [f.name for f in schema.fields]
    if not paths:
        return spark.createDataFrame([], StructType([*schema.fields, StructField("prefix", StringType()), StructField("source_file", StringType()),
                                                     StructField("source_modified", TimestampType())]))
    base = re.escape(urlsplit(root).path.rstrip("/"))
    return spark.read.schema(schema).format(fmt).load(paths).select(
        *names, F.regexp_extract(F.col("_metadata.file_path"), f"{base}/([^/]+)/", 1).alias("prefix"),
        F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_modification_time").alias("source_modified"))


RUN_FOLDERS = ("year", "month", "day", "run_id")


def newest_run(spark: SparkSession, root: str) -> str | None:
    """The newest ``year=/month=/day=/run_id=`` folder with a file, by name; ``None`` without one.

    One aggregate over file paths: no file is opened, and one value comes back.
    """
    folder = F.regexp_extract("path", "(" + "/".join(f"{c}=[^/]+" for c in RUN_FOLDERS) + ")/[^/]+$", 1)
    try:
        return list_files(spark, root).select(folder.alias("run")).filter("run <> ''").agg(F.max("run")).first()[0]
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_run(spark: SparkSession, root: str, run: str | None, schema: StructType) -> DataFrame:
    """One run of a partitioned snapshot; only its folder is listed, its folder names are strings."""
    fields = StructType([*schema.fields, *(StructField(c, StringType(), True) for c in RUN_FOLDERS)])
    if run is None:
        return spark.createDataFrame([], fields)
    return spark.read.schema(fields).option("basePath", root).parquet(f"{root}/{run}")


def read_parquet_snapshot(spark: SparkSession, path: str | None, schema: StructType) -> DataFrame:
    """Typed Parquet read; a missing path gives an empty table of ``schema``."""
    if not path:
        return spark.createDataFrame([], schema)
    try:
        df = spark.read.schema(schema).parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise
    return df


def require_columns(df: DataFrame, cols: list[str], what: str = "input") -> DataFrame:
    """Fail fast when a required column is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"{what} lacks required column(s): {missing}")
    return df
