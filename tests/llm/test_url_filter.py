"""URL filter against plain Python."""

import math
import re

import pytest
import xxhash

from ipscope.llm import catalog, url_filter
from ipscope.llm.common import table

SF = "/root/testdata/sf0.001"


def cut(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]


def grams(url, buckets, sizes):
    out = []
    for mark, part in zip("hp", cut(url)):
        s = f"^{part}$" if part else ""
        for n in sizes:
            for i in range(len(s) - n + 1):
                h = xxhash.xxh64_intdigest((mark + s[i:i + n]).encode(), seed=42)
                out.append((h - (1 << 64) if h >> 63 else h) % buckets)
    return out


def probability(f, weights, bias):
    return 1 / (1 + math.exp(-(bias + sum(weights[b] for b in f) / math.sqrt(max(1, len(f))))))


def brute_fit(rows, buckets, sizes, rounds, rate=6.0, ridge=1e-3):
    data = [(grams(u, buckets, sizes), float(y)) for u, y in rows]
    w, v, b, c = [0.0] * buckets, [0.0] * buckets, 0.0, 0.0
    for k in range(rounds):
        m = k / (k + 3)
        look, look_b = [x + m * (x - y) for x, y in zip(w, v)], b + m * (b - c)
        new, new_b = [x - rate * ridge * x for x in look], look_b
        for f, y in data:
            e = probability(f, look, look_b) - y
            new_b -= rate * e / len(data)
            for g in f:
                new[g] -= rate * e / math.sqrt(max(1, len(f))) / len(data)
        w, v, b, c = new, w, new_b, b
    return w, b


def brute_rule(host, path, rules):
    fit = [(len(h + p), h + p, v == "block", v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1::2] if fit else (None, None)


ODD = [None, "", "no scheme", "http://", "://", "HTTP://WWW.Example.NET/en/x?y#z", "http://a.net", "http://net/", "http://anet/", "http://x.net?/en/",
       "http://user@example.com:80/de/", "http://example.com/de", "http://example.com/de/a", "http://EXAMPLE.ORG/fr/", "http://org/fr/x",
       "http://ÄÖÜ.example.net/en/é", "http://example.net/en/?", "x://y://example.net/en/", "http://a\nb.net/c\nd", "http://z" + "a" * 30_000 + ".net/" + "é" * 30_000,
       "http://casino.test/", "http://casino.test/", "http://😀.test/😀😀", "http://a/", "http://a"]


def test_model_and_verdicts_equal_plain_python(spark):
    sizes, buckets, rounds = (3, 4), 512, 6
    rows = [(u, True) for u in url_filter.BLOCKED[:12]] + [(u, False) for u in url_filter.ALLOWED[:12]]
    frame = spark.createDataFrame([*rows, (None, True), ("http://x/", None)], "url string, blocked boolean")
    model = url_filter.fit(frame, buckets=buckets, sizes=sizes, rounds=rounds)
    weights, bias = brute_fit(rows, buckets, sizes, rounds)
    assert abs(model.bias - bias) < 1e-6 and max(abs(a - b) for a, b in zip(model.weights, weights)) < 1e-6
    data = list(enumerate(ODD)) + [(None, "http://spam.test/")]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in data], "page_id long, url string, host string, f string").repartition(3)
    got = url_filter.judge(pages, model).collect()
    want = []
    for i, u in data:
        host, path = cut(u)
        name, verdict = brute_rule(host, path, url_filter.RULES)
        p = probability(grams(u, buckets, sizes), weights, bias)
        want.append((i, host, path, name, verdict or ("block" if p >= 0.5 else "allow"), round(p, 5)))
    assert sorted(repr((*tuple(r)[:5], round(r.block_probability, 5))) for r in got) == sorted(map(repr, want))


def test_query_equals_plain_python(spark):
    model = url_filter.fit(url_filter.labelled_urls(spark))
    pages = {r.page_id: r.url for r in table(spark, SF, "pages").collect()}
    got = {r.page_id: r for r in catalog.queries()["op13_url_filter"](spark, SF).collect()}
    assert len(got) == len(pages)
    for i, u in pages.items():
        host, path = cut(u)
        name, verdict = brute_rule(host, path, url_filter.RULES)
        p = probability(grams(u, len(model.weights), model.sizes), model.weights, model.bias)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, name)
        assert abs(got[i].block_probability - p) < 1e-9
        assert got[i].verdict == (verdict or ("block" if p >= 0.5 else "allow"))


def test_longest_rule_wins_and_ties_are_settled(spark):
    rules = (("a.b", "/", "allow"), ("b", "/xx", "block"), ("b", "/xx", "allow"), ("c", "", "block"))
    frame = spark.createDataFrame([(1, "http://a.b/xx"), (2, "http://q.a.b/x"), (3, "http://b/xx"), (4, "http://c"), (5, "http://cc/")], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(frame, url_filter.fit(frame.limit(0).selectExpr("url", "true AS blocked")), rules=rules).collect()}
    assert got == {1: ("b/xx", "block"), 2: ("a.b/", "allow"), 3: ("b/xx", "block"), 4: ("c", "block"), 5: (None, "block")}


def test_held_out_labels(spark):
    """Five folds of the labelled table: URLs the model has not seen."""
    rows = [(u, True) for u in url_filter.BLOCKED] + [(u, False) for u in url_filter.ALLOWED]
    right = 0
    for fold in range(5):
        seen = [r for k, r in enumerate(rows) if k % 5 != fold]
        weights, bias = brute_fit(seen, 1 << 13, (2, 3, 4), 40)
        right += sum((probability(grams(u, 1 << 13, (2, 3, 4)), weights, bias) >= 0.5) == y for u, y in rows[fold::5])
    assert right / len(rows) >= 0.85


def test_empty_table_and_plan_without_python(spark):
    model = url_filter.fit(url_filter.labelled_urls(spark), rounds=1)
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string"), model).collect() == []
    plan = url_filter.judge(table(spark, SF, "pages"), model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan and "ReadSchema: struct<page_id:bigint,url:string>" in plan


@pytest.mark.parametrize("blocked", [True, False])
def test_one_label_only(spark, blocked):
    frame = spark.createDataFrame([("http://a.test/", blocked)], "url string, blocked boolean")
    got = url_filter.judge(spark.createDataFrame([(1, "http://zzz.test/q")], "page_id long, url string"), url_filter.fit(frame, rounds=5)).first()
    assert got.verdict == ("block" if blocked else "allow")
