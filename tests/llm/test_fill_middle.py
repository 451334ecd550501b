"""Fill-in-the-middle against plain Python, and its boundary containers."""

import hashlib

import numpy as np
import pytest
from helpers import documents, empty, rows, words
from oracle_compare import compare

from ipscope.llm import catalog, fill_middle
from ipscope.llm.common import table

SF = "/root/testdata/sf0.001"


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def texts():
    return [(i, t) for i, t, *_ in rows()] + [
        (100, "字" * 70_000), (101, "aé" * 50_000), (102, "a" * 200_000), (103, "😀a" * 40_000 + "x" * 70_000),
        (104, "x" * 65_536), (105, "x" * 65_535), (106, "has <S> inside"), (107, "<"), (108, "<P"), (109, "<S<P<M<"),
        *((200 + i, "<" * i + "S>" + words(i, i)) for i in range(40)), *((300 + i, "é<x" * i) for i in range(60))]


def test_equals_plain_python(spark):
    data = texts()
    got = fill_middle.transform(spark.createDataFrame([(i, t, "x", 5) for i, t in data],
                                                      "doc_id long, text string, form string, n int").repartition(3)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((i, *brute(i, t))) for i, t in data)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_restores_and_digests(spark):
    data = texts()
    frame = spark.createDataFrame(data, "doc_id long, text string")
    got = fill_middle.digests(fill_middle.transform(frame)).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(i, *brute(i, t)[:4], sha(brute(i, t)[4]), sha(t or "")) for i, t in data]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_odd_and_empty_tables(spark):
    assert fill_middle.transform(documents(spark)).count() == len(rows())
    assert fill_middle.digests(fill_middle.transform(empty(spark))).collect() == []


def test_other_id_types(spark):
    frame = spark.createDataFrame([("a", "some text"), ("b", None)], "doc_id string, text string")
    assert {r.doc_id: r.n for r in fill_middle.transform(frame).collect()} == {"a": 9, "b": 0}


@pytest.mark.parametrize("kind, low", [
    ("RunContainer", np.arange(65_536)), ("RunContainer", np.arange(9, 40_000)), ("ArrayContainer", np.arange(0, 5000, 3)),
    ("BitmapContainer", np.arange(0, 65_536, 3)), ("BitmapContainer", np.sort(np.random.default_rng(1).choice(65_536, 30_000, False))),
    ("ArrayContainer", np.array([0, 7, 65_535])), ("RunContainer", np.array([0]))])
def test_containers_select_their_members(kind, low):
    made = fill_middle.container(low)
    assert type(made).__name__ == kind or len(low) == 1
    assert [made.select(k) for k in range(0, len(low), 37)] == low[::37].tolist()
    assert made.select(len(low) - 1) == low[-1]


def test_boundary_set_selects_every_code_point():
    for text in ("", "a", "字", "aé字😀" * 30_000, "é" * 32_768, "a" * 65_536, "a" * 131_072 + "😀"):
        points = fill_middle.BoundarySet(text.encode())
        assert points.points == len(text)
        ks = sorted({0, len(text), len(text) // 2, len(text) // 3, max(0, len(text) - 1), *range(0, len(text), 7919)})
        assert points.select(*ks) == [len(text[:k].encode()) for k in ks]


def test_query_equals_sql(spark):
    got = compare(spark, "op12_fill_middle", catalog.queries()["op12_fill_middle"], catalog.oracle_sql()["op12_fill_middle"], SF)
    assert got["status"] == "ok", got
    assert table(spark, SF, "documents").count() == got["spark_rows"]
