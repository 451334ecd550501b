"""Comparable rendering of results: arrays as joined text, timestamps as ISO text.

Used for query outputs that are checked against another engine, so both sides
hash identical primitive values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, StructType, TimestampNTZType, TimestampType

from ipscope.functions.sqltext import ident

ISO_FMT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def render(df: DataFrame, drop_structs: bool = True) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = ident(f.name)
        if isinstance(f.dataType, ArrayType):
            cols.append(f"array_join({c}, ', ') AS {c}")
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            cols.append(f"date_format({c}, \"{ISO_FMT}\") AS {c}")
        elif isinstance(f.dataType, StructType) and drop_structs:
            continue
        else:
            cols.append(c)
    return df.selectExpr(*cols)
