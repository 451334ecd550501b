"""Tolerant value conversions as native column expressions.

Each function takes a column name (or a Column) and returns a Column.  They give
the same answers as Python's ``int(float(v))`` / ``float(v)`` / truthy-word
parsing on text input, without a UDF:

* text is checked against Python's float grammar first, so ``12d`` (accepted by
  the JVM) is rejected and ``1_000`` (accepted by Python) is accepted;
* NaN and +-inf never become integers; NaN never becomes a float;
* numbers that overflow int32 fall back to the default.

Each rule is written once, as SQL text over an input expression (``*_sql``);
the Column functions wrap it with one ``F.expr`` over a column name or a
dotted field path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, NumericType, StringType

from ipscope.functions.sqltext import ident, let_sql, lit, strip_sql
from ipscope.schemas import FALSE_WORDS, TRUE_WORDS

_DIGITS = r"[0-9](?:_?[0-9])*"
# Python float() grammar (ASCII subset): decimal with optional exponent, or nan/inf.
PY_FLOAT_RE = (
    rf"\A[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    r"|(?i:nan|inf|infinity))\z"
)


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _typed(sql: str, dtype: str) -> str:
    return f"CAST({sql} AS {dtype})"


# ------------------------------------------------------------------ SQL text
def text_to_double_sql(x: str) -> str:
    """Python-compatible text -> double; null when Python's float() would raise."""
    low = "lower(regexp_replace(s_, '_', ''))"
    body = (f"CASE WHEN NOT coalesce(s_ RLIKE {lit(PY_FLOAT_RE)}, false) THEN CAST(NULL AS DOUBLE) "
            f"WHEN {low} RLIKE '^[+]?(inf|infinity)$' THEN CAST('Infinity' AS DOUBLE) "
            f"WHEN {low} RLIKE '^-(inf|infinity)$' THEN CAST('-Infinity' AS DOUBLE) "
            f"WHEN {low} RLIKE '^[+-]?nan$' THEN CAST('NaN' AS DOUBLE) "
            f"ELSE try_cast(regexp_replace(s_, '_', '') AS DOUBLE) END")
    return let_sql(strip_sql(f"CAST({x} AS STRING)"), "s_", body)


def to_double_sql(x: str, dtype: DataType | None = None) -> str:
    if isinstance(dtype, (NumericType, BooleanType)):
        return f"CAST({x} AS DOUBLE)"
    if dtype is not None and not isinstance(dtype, StringType):
        return "CAST(NULL AS DOUBLE)"
    return text_to_double_sql(x)


def safe_int_sql(x: str, default=0, dtype: DataType | None = None) -> str:
    """``int(float(v))`` truncating toward zero; default on null/NaN/inf/garbage/overflow."""
    as_int = let_sql(to_double_sql(x, dtype), "d_",
                  "CASE WHEN isnan(d_) OR abs(d_) = CAST('Infinity' AS DOUBLE) THEN CAST(NULL AS INT) "
                  "ELSE try_cast(d_ AS INT) END")
    return f"coalesce({as_int}, {_typed(lit(default), 'INT')})"


def safe_float_sql(x: str, default=None, dtype: DataType | None = None) -> str:
    """``float(v)`` with NaN treated as missing; default otherwise."""
    as_f = let_sql(to_double_sql(x, dtype), "d_", "CASE WHEN isnan(d_) THEN CAST(NULL AS DOUBLE) ELSE d_ END")
    return f"coalesce({as_f}, {_typed(lit(default), 'DOUBLE')})"


def safe_bool_sql(x: str, default=None, dtype: DataType | None = None) -> str:
    """Booleans pass; text true/1/yes/y and false/0/no/n (trimmed, any case); else default."""
    dflt = _typed(lit(default), "BOOLEAN")
    if isinstance(dtype, BooleanType):
        return f"coalesce({x}, {dflt})"
    if dtype is not None and not isinstance(dtype, StringType):
        return dflt
    t = ", ".join(lit(v) for v in TRUE_WORDS)
    f = ", ".join(lit(v) for v in FALSE_WORDS)
    return let_sql(f"lower({strip_sql(f'CAST({x} AS STRING)')})", "w_",
                f"CASE WHEN w_ IN ({t}) THEN true WHEN w_ IN ({f}) THEN false ELSE {dflt} END")


def non_blank_sql(arr: str) -> str:
    return f"filter({arr}, x -> x IS NOT NULL AND {strip_sql('x')} <> '')"


def normalize_string_array_sql(x: str, dtype: DataType | None = None) -> str:
    """Array or text -> ``array<string>`` of non-blank elements; null -> [].

    Text: blank -> []; a JSON list -> its non-blank elements; anything else -> [trimmed text].
    """
    empty = "CAST(array() AS ARRAY<STRING>)"
    if dtype is not None and not isinstance(dtype, StringType):
        return f"coalesce({non_blank_sql(f'CAST({x} AS ARRAY<STRING>)')}, {empty})"
    parsed = "CASE WHEN startswith(s_, '[') THEN from_json(s_, 'array<string>') END"
    body = let_sql(parsed, "j_", f"CASE WHEN s_ IS NULL OR s_ = '' THEN {empty} "
                f"WHEN j_ IS NOT NULL THEN {non_blank_sql('j_')} ELSE array(s_) END")
    return let_sql(strip_sql(x), "s_", body)


# ---------------------------------------------------------------- Columns
def _rule(c, sql_fn, *args) -> Column:
    """Column for a rule over a column name or dotted field path (e.g. ``r.score``)."""
    if not isinstance(c, str):
        raise TypeError("pass a column name or dotted path; project other expressions to a column first")
    return F.expr(sql_fn(ident(c), *args))


def safe_int(c, default=0, dtype=None) -> Column:
    return _rule(c, safe_int_sql, default, dtype)


def safe_float(c, default=None, dtype=None) -> Column:
    return _rule(c, safe_float_sql, default, dtype)


def safe_bool(c, default=None, dtype=None) -> Column:
    return _rule(c, safe_bool_sql, default, dtype)


def normalize_string_array(c, dtype=None) -> Column:
    return _rule(c, normalize_string_array_sql, dtype)


def safe_string(c, default=None) -> Column:
    return F.coalesce(col_of(c).cast("string"), F.lit(default).cast("string"))


def has_value(c) -> Column:
    """Not null and not the empty string."""
    c = col_of(c)
    return c.isNotNull() & (c.cast("string") != F.lit(""))

