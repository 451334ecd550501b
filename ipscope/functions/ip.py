"""IP address validity and version as regular expressions (no UDF).

IPv4: four decimal parts 0-255, no leading zeros.  IPv6: the RFC 3986
``IPv6address`` grammar (eight 16-bit groups, one ``::`` run, a trailing IPv4
counting as two groups), plus an optional non-empty ``%scope`` without a second
``%``.  The patterns avoid look-arounds so the same text runs in Java regex and
RE2 (DuckDB) alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ipscope.functions.casts import col_of

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4_BODY = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_H16 = r"[0-9A-Fa-f]{1,4}"
_LS32 = rf"(?:{_H16}:{_H16}|{IPV4_BODY})"


def _rep(n: int) -> str:
    """Exactly n repetitions of ``h16:``."""
    return "" if n == 0 else rf"(?:{_H16}:){{{n}}}"


def _upto(n: int) -> str:
    """Optional prefix of at most n+1 groups ending in h16 (``[*n(h16:) h16]``)."""
    if n < 0:
        return ""
    inner = _H16 if n == 0 else rf"(?:{_H16}:){{0,{n}}}{_H16}"
    return rf"(?:{inner})?"


def _ipv6_alternatives() -> list[str]:
    alts = [rf"{_rep(6)}{_LS32}", rf"::{_rep(5)}{_LS32}"]
    # [ *k(h16 ":") h16 ] "::" then (4-k) fixed groups and ls32, for k = -1..3
    alts.append(rf"{_upto(0)}::{_rep(4)}{_LS32}")
    alts.append(rf"{_upto(1)}::{_rep(3)}{_LS32}")
    alts.append(rf"{_upto(2)}::{_rep(2)}{_LS32}")
    alts.append(rf"{_upto(3)}::{_H16}:{_LS32}")
    alts.append(rf"{_upto(4)}::{_LS32}")
    alts.append(rf"{_upto(5)}::{_H16}")
    alts.append(rf"{_upto(6)}::")
    return alts


IPV6_BODY = "(?:" + "|".join(_ipv6_alternatives()) + ")"
IPV4_RE = rf"\A{IPV4_BODY}\z"
IPV6_RE = rf"\A{IPV6_BODY}(?:%[^%]+)?\z"


def is_ipv4(c) -> Column:
    return F.coalesce(col_of(c).rlike(IPV4_RE), F.lit(False))


def is_ipv6(c) -> Column:
    return F.coalesce(col_of(c).rlike(IPV6_RE), F.lit(False))


def is_valid_ip(c) -> Column:
    return is_ipv4(c) | is_ipv6(c)


def ip_version(c) -> Column:
    """``IPv4`` / ``IPv6`` / null for invalid text."""
    return F.when(is_ipv4(c), F.lit("IPv4")).when(is_ipv6(c), F.lit("IPv6"))


# Candidate tokens for extraction from free text: dotted quads.  Validation of
# the token (octet range, leading zeros) is done by is_ipv4 afterwards.
IPV4_TOKEN_RE = r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b"
