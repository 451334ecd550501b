"""Plain values at any depth (H6): the expression is built by walking the schema.

NaN becomes null, times become ISO text, in structs, arrays and map values alike.  What
is not a struct, array, map, float or time passes unchanged, infinities included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DataType, DateType, DoubleType, FloatType, MapType, StructType, TimestampNTZType,
                               TimestampType)


def iso_text(c: Column, zoned: bool) -> Column:
    """ISO-8601 text of a time: a fraction only where there is one, the offset for times with a zone."""
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(c, ".SSSSSS")
    text = F.concat(whole, F.when(micros == ".000000", F.lit("")).otherwise(micros))
    return F.concat(text, F.date_format(c, "xxx")) if zoned else text


def plain_value(c: Column, kind: DataType) -> Column:
    """``c`` of type ``kind`` without NaN and typed times; null containers stay null, empty ones empty."""
    if isinstance(kind, (FloatType, DoubleType)):
        return F.when(~F.isnan(c), c)
    if isinstance(kind, TimestampType):
        return iso_text(c, True)
    if isinstance(kind, TimestampNTZType):
        return iso_text(c, False)
    if isinstance(kind, DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(kind, StructType):
        return F.when(c.isNotNull(), F.struct(*[plain_value(c.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]))
    if isinstance(kind, ArrayType):
        return F.transform(c, lambda x: plain_value(x, kind.elementType)) if _touched(kind.elementType) else c
    if isinstance(kind, MapType):
        return F.transform_values(c, lambda _, x: plain_value(x, kind.valueType)) if _touched(kind.valueType) else c
    return c


def _touched(kind: DataType) -> bool:
    """Whether a type holds anything that ``plain_value`` changes."""
    if isinstance(kind, StructType):
        return any(_touched(f.dataType) for f in kind.fields)
    if isinstance(kind, ArrayType):
        return _touched(kind.elementType)
    if isinstance(kind, MapType):
        return _touched(kind.valueType)
    return isinstance(kind, (FloatType, DoubleType, TimestampType, TimestampNTZType, DateType))


def plain_records(df: DataFrame) -> DataFrame:
    """Every column as ``plain_value`` makes it."""
    return df.select(*[plain_value(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])
