"""SQL-text builders for the library's larger expressions.

A Column built call-by-call costs one JVM round trip per ``lit``/``when``/``col``;
the classification and score expressions would need hundreds.  Building the same
expression as SQL text and handing it over with one ``F.expr`` keeps plan
construction cheap; the resulting expression tree is identical.
"""

from __future__ import annotations

# White space that Python's str.strip() removes, as a regular-expression class.
SPACE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def ident(name: str) -> str:
    """Back-quoted column identifier; a dotted name is a field path (``a.b`` -> `a`.`b`)."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def lit(value) -> str:
    """SQL literal for str / int / float / bool / None."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return repr(value) if isinstance(value, int) else f"CAST({value!r} AS DOUBLE)"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def let_sql(value: str, var: str, body: str) -> str:
    """Evaluate ``body`` with ``var`` bound to ``value``, referencing ``value`` once.

    Catalyst inlines aliases when it pushes a filter through a projection; a rule
    that mentions its input many times would then copy the whole upstream
    expression that many times (and multiply along a chain of rules).  Binding
    the input once keeps every rule linear in its input.
    """
    return f"element_at(transform(array({value}), {var} -> {body}), 1)"


def str_array(values) -> str:
    return "CAST(array(" + ", ".join(lit(v) for v in values) + ") AS ARRAY<STRING>)"


def strip_sql(x: str) -> str:
    """``str.strip()``: the text without white space of any kind at either end."""
    return f"regexp_replace({x}, {lit(rf'\A{SPACE}+|{SPACE}+\z')}, '')"


def strip(c):
    """``strip_sql`` over a Column."""
    from pyspark.sql import functions as F
    return F.regexp_replace(c, rf"\A{SPACE}+|{SPACE}+\z", "")
