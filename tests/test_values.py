"""Nested values, the substring index and versions in force, on small tables."""
import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from ipscope import schemas as S
from ipscope.functions.nested import plain_records
from ipscope.operators import asof, lexicon


def test_plain_values_at_any_depth(spark):
    t = dt.datetime(2024, 5, 6, 7, 8, 9, 120)
    schema = ("id int, x double, f float, at timestamp_ntz, z timestamp, d date, s string, n array<int>, e array<double>, "
              "r struct<a:double,b:struct<c:array<struct<t:timestamp_ntz,v:float>>>>, m map<string,array<double>>, aa array<array<double>>")
    nan = math.nan
    rows = [(1, nan, nan, t, t, t.date(), "NaN", [1, None], [nan, 1.5, None, math.inf], (nan, ([(t, nan), None, (None, 2.0)],)), {"k": [nan, 2.0], "l": None}, [[nan], None, []]),
            (2, 1.0, 2.0, t.replace(microsecond=0), None, None, None, None, None, None, None, None),
            (3, None, None, None, None, None, "", [], [], (None, None), {}, [])]
    a, b, c = plain_records(spark.createDataFrame(rows, schema)).orderBy("id").collect()
    assert (a.x, a.f, a.at, a.d, a.s, a.n, a.e) == (None, None, "2024-05-06T07:08:09.000120", "2024-05-06", "NaN", [1, None], [None, 1.5, None, math.inf])
    assert a.z.startswith("2024-05-06T") and a.z.endswith("+00:00")
    assert a.r.a is None and [None if x is None else (x.t, x.v) for x in a.r.b.c] == [("2024-05-06T07:08:09.000120", None), None, (None, 2.0)]
    assert a.m == {"k": [None, 2.0], "l": None} and a.aa == [[None], None, []]
    assert (b.x, b.f, b.at, b.r, b.m, b.e) == (1.0, 2.0, "2024-05-06T07:08:09", None, None, None)
    assert c.r.a is None and c.r.b is None and c.m == {} and c.e == []


@pytest.mark.parametrize("width", [1, 2, 4, 9])
def test_substring_index_equals_a_loop(spark, width):
    rng = random.Random(width)
    docs = [(i, "".join(rng.choice("abc _é.Ö") for _ in range(rng.randrange(60)))) for i in range(60)] + [(100, None), (101, ""), (None, "abc"), (102, "ABC abc")]
    terms = {"".join(rng.choice("abc _é.ö") for _ in range(rng.randrange(1, 7))) for _ in range(400)} | {"abc", "a", "(.", r"\E", "Ö"}
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    lex = spark.createDataFrame([(t,) for t in terms] + [(None,), ("",), ("abc",)], "term string")
    low = {t.lower() for t in terms}
    word = set("abcdefghijklmnopqrstuvwxyz0123456789_")

    def whole(t, x):
        return any(x.startswith(t, k) and (k == 0 or x[k - 1] not in word) and (k + len(t) == len(x) or x[k + len(t)] not in word) for k in range(len(x)))

    for boundary, holds in ((False, lambda t, x: t in x), (True, whole)):
        got = {r.doc_id: r.terms for r in lexicon.match_lexicon(frame, lex, width=width, word_boundary=boundary).collect()}
        want = {i: sorted((t for t in low if holds(t, (x or "").lower())), key=lambda t: t.encode()) for i, x in docs}
        assert got == want
    none = lexicon.match_lexicon(frame, lex.limit(0)).collect()
    assert len(none) == len(docs) and all(r.terms == [] for r in none)


def test_lexicon_of_thousands_without_a_join_of_all_pairs(spark):
    lex = spark.createDataFrame([(f"{a}{b}",) for a in S.ATTACK_KEYWORDS["Malware"] for b in range(1000)], "term string")
    docs = spark.createDataFrame([(1, "a trojan77 and a loader1000"), (2, "trojan")], "doc_id long, text string")
    m = lexicon.match_lexicon(docs, lex)
    assert {r.doc_id: r.terms for r in m.collect()} == {1: ["loader1", "loader10", "loader100", "trojan7", "trojan77"], 2: []}
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_run_is_indexed_once_whatever_the_documents(spark):
    """A run of many documents is one row of the index, and one row of a bucket; both rules come from one pass."""
    docs = spark.createDataFrame([(i % 150, f"The sshd log, ssh-agent {i}") for i in range(300)] + [(None, None)], "doc_id long, text string")
    lex = spark.createDataFrame([("SSH",), ("log, ssh",), ("d l",), ("e s",), (", ",), ("-",), ("absent",)], "term string")
    index = docs.select(F.lit(0).alias("bucket"), F.explode(lexicon.runs(F.lower("text"))).alias("run")).distinct()
    found = {r.run: dict(zip(r.terms, r.shifts)) for r in lexicon.terms_of_runs(index, lexicon.anchors(lex), [1, 2, 3]).collect()}
    near = {"ssh": None, "log, ssh": -5, "e s": -2}
    assert (found["sshd"], found["ssh"], found["-"], "absent" in found) == (near, near, {"-": None}, False)
    got = lexicon.match_rules(docs, lex, partitions=3).collect()
    assert len(got) == 301
    assert {(tuple(r.anywhere), tuple(r.whole)) for r in got if r.doc_id is not None} == {((", ", "-", "d l", "e s", "log, ssh", "ssh"), ("log, ssh", "ssh"))}
    assert [(r.anywhere, r.whole) for r in got if r.doc_id is None] == [([], [])]


@pytest.mark.parametrize("slice_seconds", [1, 7, 10_000])
def test_versions_in_force_equal_a_loop(spark, slice_seconds):
    rng = random.Random(slice_seconds)
    start = dt.datetime(2024, 1, 1)
    at = lambda: start + dt.timedelta(seconds=rng.randrange(40))
    key = lambda: rng.choice(["hot"] * 6 + ["a", "b", None])
    reports = [(i, key(), rng.choice([at(), at(), None]) if i % 9 == 0 else at()) for i in range(200)]
    versions = [(key(), rng.randrange(50), at()) for _ in range(30)] + [("hot", 1, None)]
    r = spark.createDataFrame(reports, "pos int, ip_address string, ts timestamp_ntz")
    v = spark.createDataFrame(versions, "ip_address string, n int, version_ts timestamp_ntz")

    def in_force(k, t):
        fit = [(w, n) for x, n, w in versions if k is not None and x == k and t is not None and w is not None and w <= t]
        return max(fit) if fit else (None, None)

    got = {x.pos: (x.version_ts, x.n) for x in asof.asof_versions(r, v, "ts", slice_seconds=slice_seconds).collect()}
    assert got == {i: in_force(k, t) for i, k, t in reports}
    pin = start + dt.timedelta(seconds=20)
    got = {x.pos: (x.version_ts, x.n) for x in asof.pinned(r, v, F.lit(pin).cast("timestamp_ntz")).collect()}
    assert got == {i: in_force(k, pin) for i, k, _ in reports}
    assert asof.asof_versions(r, v.limit(0), "ts").filter("n IS NOT NULL").count() == 0 and asof.asof_versions(r.limit(0), v, "ts").count() == 0
