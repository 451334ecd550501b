"""Attack classification, risk score and status as native expressions.

Classification lower-cases the pulse names once, joins them with `` | `` and
tests every lexicon keyword with a plain substring match (so ``rce`` also
matches inside ``force`` — kept for parity).  The score is the six-stage rule:
abuse weight, pulse steps, passive-DNS weight, category and keyword bonuses,
rule floors, then ``round(min(score, 100), 2)``.

Expressions are generated as SQL text (one JVM call each, see ``sqltext``);
arguments are column names.
"""

from __future__ import annotations

import re
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ipscope import schemas as S
from ipscope.functions.sqltext import ident, let_sql, lit, str_array

ALL_KEYWORDS = sorted(set(chain.from_iterable(S.ATTACK_KEYWORDS.values())))
CATEGORIES = sorted(S.ATTACK_KEYWORDS)


# ------------------------------------------------------------------ SQL text
def pulse_text_sql(names: str) -> str:
    """Lower-cased names (non-null, non-empty) joined with `` | ``."""
    return f"lower(array_join(filter({names}, x -> x IS NOT NULL AND x <> ''), ' | '))"


def matched_keywords_sql(text: str, word_boundary: bool = False) -> str:
    """Sorted lexicon keywords contained in ``text``: one CASE per keyword, nulls dropped."""
    t = "t_"
    if word_boundary:
        test = lambda k: f"{t} RLIKE {lit(r'\b' + re.escape(k) + r'\b')}"
    else:
        test = lambda k: f"contains({t}, {lit(k)})"
    cases = ", ".join(f"CASE WHEN {test(k)} THEN {lit(k)} END" for k in ALL_KEYWORDS)
    return let_sql(f"coalesce({text}, '')", "t_", f"array_compact(array({cases}))")


def matched_categories_sql(keywords: str) -> str:
    """Sorted categories with at least one matched keyword."""
    cases = ", ".join(
        f"CASE WHEN arrays_overlap(w_, {str_array(S.ATTACK_KEYWORDS[c])}) THEN {lit(c)} END"
        for c in CATEGORIES)
    return let_sql(keywords, "w_", f"array_compact(array({cases}))")


def _bonus_sql(arr: str, table: dict) -> str:
    # Elements are distinct, so the bonus sum is a sum over the table.
    return "(" + " + ".join(f"CASE WHEN array_contains({arr}, {lit(k)}) THEN {v} ELSE 0 END"
                            for k, v in table.items()) + ")"


def risk_score_sql(a: str, p: str, d: str, cats: str, kws: str) -> str:
    """Six-stage risk score over non-null int inputs and matched arrays."""
    bound = f"named_struct('a', {a}, 'p', {p}, 'd', {d}, 'c', {cats}, 'w', {kws})"
    return let_sql(bound, "v_", _risk_score_body("v_.a", "v_.p", "v_.d", "v_.c", "v_.w"))


def _risk_score_body(a: str, p: str, d: str, cats: str, kws: str) -> str:
    steps = " ".join(f"WHEN {p} >= {t} THEN {b}" for t, b in S.PULSE_STEPS)
    base = (f"least({a}, {S.ABUSE_CAP}) * CAST({S.ABUSE_WEIGHT} AS DOUBLE)"
            f" + CASE {steps} ELSE 0 END"
            f" + least({d}, {S.DNS_CAP}) * CAST({S.DNS_WEIGHT} AS DOUBLE)"
            f" + {_bonus_sql(cats, S.CATEGORY_BONUS)} + {_bonus_sql(kws, S.KEYWORD_BONUS)}")
    has_cat = f"size({cats}) > 0"
    # A floor that does not apply is NULL, which greatest() ignores: scores below
    # zero (negative abuse input) stay as computed, as in the rule.
    floors = ", ".join([
        f"CASE WHEN {p} >= 20 AND {has_cat} THEN 55.0D END",
        f"CASE WHEN array_contains({cats}, 'Exploitation') OR array_contains({kws}, 'rce') "
        f"OR array_contains({kws}, 'remote code execution') THEN 70.0D END",
        f"CASE WHEN array_contains({cats}, 'Botnet / C2') OR array_contains({cats}, 'Ransomware') "
        f"THEN 80.0D END",
        f"CASE WHEN {a} >= 40 AND {has_cat} THEN 65.0D END",
    ])
    return f"round(least(greatest(CAST({base} AS DOUBLE), {floors}), 100.0D), 2)"


def risk_status_sql(score: str, high: float = S.HIGH_RISK_AT, medium: float = S.MEDIUM_RISK_AT) -> str:
    return let_sql(score, "s_", f"CASE WHEN s_ >= {high} THEN {lit(S.STATUS_HIGH)} "
                   f"WHEN s_ >= {medium} THEN {lit(S.STATUS_MEDIUM)} ELSE {lit(S.STATUS_LOW)} END")


# ---------------------------------------------------------------- Columns
def pulse_text(names: str) -> Column:
    return F.expr(pulse_text_sql(ident(names)))


def matched_keywords(text: str, word_boundary: bool = False) -> Column:
    return F.expr(matched_keywords_sql(ident(text), word_boundary))


def matched_categories(keywords: str) -> Column:
    return F.expr(matched_categories_sql(ident(keywords)))


def classify(names: str, word_boundary: bool = False) -> tuple[Column, Column]:
    """(categories, keywords) for an ``array<string>`` column of pulse names."""
    kws = matched_keywords_sql(pulse_text_sql(ident(names)), word_boundary)
    return F.expr(matched_categories_sql(kws)), F.expr(kws)


def risk_score(abuse: str, pulses: str, dns: str, categories: str, keywords: str) -> Column:
    return F.expr(risk_score_sql(ident(abuse), ident(pulses), ident(dns),
                                 ident(categories), ident(keywords)))


def risk_status(score: str, high: float = S.HIGH_RISK_AT, medium: float = S.MEDIUM_RISK_AT) -> Column:
    return F.expr(risk_status_sql(ident(score), high, medium))


_COMPUTED = ("attack_categories", "attack_keywords_matched", "risk_score", "status")


def score_columns(df: DataFrame, names: str = "otx_pulse_names", abuse: str = "abuse_confidence_score",
                  pulses: str = "otx_pulse_count", dns: str = "otx_passive_dns_count",
                  word_boundary: bool = False) -> DataFrame:
    """Add attack_categories, attack_keywords_matched, risk_score and status.

    Missing numeric inputs count as 0 (``safe_int(..., 0)``), as in the batch step.
    The lower-cased text is its own column so the keyword tests read it once.
    """
    from ipscope.functions.casts import safe_int_sql
    dt = {f.name: f.dataType for f in df.schema.fields}
    drop = [c for c in (*_COMPUTED, "_a", "_p", "_d", "_pt") if c in df.columns]
    base = df.drop(*drop) if drop else df
    nums = [f"{safe_int_sql(ident(c), 0, dt[c])} AS {a}"
            for c, a in ((abuse, "_a"), (pulses, "_p"), (dns, "_d"))]
    # Append-only projections ("*" plus the new column): no re-listing of every column.
    out = base.selectExpr("*", f"{pulse_text_sql(ident(names))} AS _pt", *nums)
    out = out.selectExpr("*", f"{matched_keywords_sql('_pt', word_boundary)} AS attack_keywords_matched")
    out = out.selectExpr("*", f"{matched_categories_sql('attack_keywords_matched')} AS attack_categories")
    score = risk_score_sql("_a", "_p", "_d", "attack_categories", "attack_keywords_matched")
    out = out.selectExpr("*", f"{score} AS risk_score")
    out = out.selectExpr("*", f"{risk_status_sql('risk_score')} AS status")
    return out.drop("_pt", "_a", "_p", "_d")
