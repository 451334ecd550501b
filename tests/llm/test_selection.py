"""Exact dedup, mixing, language ID, licences, quality and the pipeline."""

import hashlib
import math
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
import xxhash
from helpers import documents, empty, rows, words
from oracle_compare import compare
from test_pairs import brute_near
from tokenizers import Tokenizer

import corpus_pipeline
from ipscope.llm import catalog, language, licenses, mixing, quality
from ipscope.llm.common import ranked, staged, table
from ipscope.llm.exact_dedup import DigestIndex
from ipscope.session import scratch_path
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, name):
    got = compare(spark, name, catalog.queries()[name], catalog.oracle_sql()[name], SF)
    assert got["status"] == "ok", got


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0d]", "", text or "")


def test_digest_index_odd_rows(spark):
    index = DigestIndex(spark, scratch_path(spark, "test"), buckets=4)
    got = index.add(documents(spark)).collect()
    groups = {}
    for r in rows():
        groups.setdefault(squeezed(r[1]), []).append((-len(r[1] or ""), r[0] is None, r[0] or 0, r[0]))
    assert len(got) == len(rows())
    want = {hashlib.sha256(k.encode()).hexdigest(): (min(v)[3], len(v)) for k, v in groups.items()}
    for r in got:
        assert (r.keep_id, r.group_size) == want[r.text_sha256]
        assert r.kept == (r.doc_id == r.keep_id)
    assert DigestIndex(spark, scratch_path(spark, "test")).add(empty(spark)).collect() == []


def test_digest_index_persists_and_appends_only_what_is_new(spark):
    path = scratch_path(spark, "test")
    first = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    second = spark.createDataFrame([(3, "a  b  longer".replace("longer", "")), (4, "d"), (5, "d ")], "doc_id long, text string")
    DigestIndex(spark, path, buckets=4).add(first).collect()
    spark.sql(f"DROP TABLE {DigestIndex(spark, path, buckets=4).name}")  # as in another session: the files stay
    again = DigestIndex(spark, path, buckets=4)
    got = {r.doc_id: (r.keep_id, r.kept, r.group_size) for r in again.add(second).collect()}
    assert got == {3: (1, False, 1), 4: (5, False, 2), 5: (5, True, 2)}
    once_more = {r.doc_id: r.keep_id for r in again.add(second).collect()}
    assert once_more == {3: 1, 4: 5, 5: 5}
    assert spark.read.parquet(path).count() == 3


@pytest.mark.parametrize("later", [2, 16])
def test_digest_index_opened_with_another_bucket_count(spark, later):
    path = scratch_path(spark, "test")
    frame = spark.createDataFrame([(i, f"text number {i}") for i in range(40)], "doc_id long, text string")
    DigestIndex(spark, path, buckets=4).add(frame).collect()
    spark.sql(f"DROP TABLE {DigestIndex(spark, path).name}")  # as in another session
    index = DigestIndex(spark, path, buckets=later)
    assert index.buckets == 4
    again = index.add(frame.withColumn("doc_id", F.col("doc_id") + 100)).collect()
    assert len(again) == 40 and {(r.doc_id, r.keep_id, r.kept) for r in again} == {(100 + i, i, False) for i in range(40)}
    assert spark.read.parquet(path).count() == 40


def test_digest_index_is_not_moved_for_a_batch(spark):
    index = DigestIndex(spark, scratch_path(spark, "test"), buckets=4)
    frame = spark.createDataFrame([(i, f"text number {i}") for i in range(40)], "doc_id long, text string")
    index.add(frame).collect()
    firsts = staged(spark.range(30).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"),
                                           F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("n_rows")), "firsts")
    plan = index.known(firsts)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1 and "SelectedBucketsCount: 4 out of 4" in plan


def test_digest_index_keeps_one_row_of_each_text(spark):
    kept = DigestIndex(spark, scratch_path(spark, "test"), buckets=4).keep(documents(spark))
    assert kept.columns == documents(spark).columns
    texts = [squeezed(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({squeezed(r[1]) for r in rows()})


def test_ranked_equals_sorting(spark):
    data = [(g, v, i) for i, (g, v) in enumerate([("a", k % 5) for k in range(200)] + [("b", 1), ("c", 2)])]
    frame = spark.createDataFrame(data, "g string, v int, i int")
    got = {(r.g, r.i): r.rank for r in ranked(frame, ["g"], [F.col("v"), F.col("i")]).collect()}
    for g in "abc":
        mine = sorted((v, i) for h, v, i in data if h == g)
        assert [got[g, i] for _, i in mine] == list(range(len(mine)))


def test_mix_odd_rows(spark):
    plan = mixing.plan_mix(documents(spark)).collect()
    assert len(plan) == len(rows())
    for r in plan:
        assert 0 <= r.copies <= 2 and r.taken == r.copies * r.size and r.target <= 2 * r.source_size
    total = sum(len(re.findall(r"[^\x20\x09-\x0d]+", r[1] or "")) for r in rows())
    targets = {(r.source_size, r.target) for r in plan}
    assert abs(sum(t for _, t in targets) - 1.5 * total) < 1e-6 * total
    assert sorted(map(repr, plan)) == sorted(map(repr, mixing.plan_mix(documents(spark)).collect()))
    mixed = mixing.mix(documents(spark))
    assert mixed.columns == documents(spark).columns
    assert mixed.count() == sum(r.copies for r in plan)
    assert mixing.plan_mix(empty(spark)).collect() == [] and mixing.mix(empty(spark)).collect() == []


def test_mix_comes_near_its_targets(spark):
    plan = mixing.plan_mix(table(spark, "/root/testdata/sf0.01", "documents")).toPandas()
    per = plan.groupby(["source_size", "target"]).taken.sum().reset_index()
    longest = plan["size"].max()
    assert ((per.taken - per.target).abs() <= 2 * longest).all()
    assert (per.taken - per.target).abs().sum() < 0.08 * per.target.sum()


def test_language_held_out_accuracy_and_columns(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = {r.doc_id: r for r in catalog.op6_language_id(spark, "/root/testdata/sf0.01").collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out == (i in set(held)) for i in got) and len(got) == len(truth)
    known = [i for i in held if truth[i] is not None]
    assert np.mean([got[i].lang_pred == truth[i] for i in known]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_odd_rows(spark):
    model = language.fit(documents(spark), catalog.PIECES, rounds=1)
    assert model.languages == ["de", "en", "fr"]
    got = language.predict(documents(spark), model).collect()
    assert len(got) == len(rows())
    for r in got:
        if r.doc_id in (5, 6, 7, 13):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None:
            assert r.lang_pred in model.languages and 0 < r.score <= 1
    nothing = language.fit(empty(spark), catalog.PIECES)
    assert {r.lang_pred for r in language.predict(documents(spark), nothing).collect()} == {"und"}
    assert language.predict(empty(spark), model).collect() == []


def test_forward_sums_all_segmentations():
    pieces = ["a", "ab", "b", "ba", "aba"]
    prob = np.array([[0.1, 0.2], [0.2, 0.1], [0.3, 0.3], [0.1, 0.2], [0.3, 0.2]])

    def total(word, k):
        if not word:
            return 1.0
        return sum(prob[i, k] * total(word[len(p):], k) for i, p in enumerate(pieces) if word.startswith(p)) + (
            language.UNKNOWN * total(word[1:], k) if word[0] not in pieces else 0.0)

    words = ["a", "ab", "aba", "abab", "bbaab", "axb"]
    got = language.Segmenter(pieces, prob).forward(words)
    want = [[np.log(total(w, k)) for k in (0, 1)] for w in words]
    assert np.allclose(got, want)
    uses = language.Segmenter(pieces, prob).expected(["ab"], np.array([2.0]), np.array([0]))
    both = 0.1 * 0.3 + 0.2
    assert np.isclose(uses[1, 0], 2 * 0.2 / both) and np.isclose(uses[0, 0], 2 * 0.03 / both)


def test_predictions_equal_plain_python(spark):
    """Whole texts scored word by word with sums over all segmentations, one letter after the other."""
    docs = table(spark, SF, "documents")
    model = language.fit(docs.filter(~language.held_out(F.col("doc_id"))), catalog.PIECES, rounds=1)
    at = {p: i for i, p in enumerate(model.pieces)}
    longest = max(map(len, at))

    def forward(run):
        alpha = [np.ones(len(model.languages))] + [np.zeros(len(model.languages)) for _ in run]
        for end in range(1, len(run) + 1):
            for start in range(max(0, end - longest), end):
                i = at.get(run[start:end])
                if i is not None:
                    alpha[end] = alpha[end] + alpha[start] * model.prob[i]
                elif end - start == 1:
                    alpha[end] = alpha[end] + alpha[start] * language.UNKNOWN
        return np.log(np.maximum(alpha[-1], 1e-300))

    known = {}

    def score(text):
        total = np.zeros(len(model.languages))
        for w in regex.findall(r"\p{L}+", (text or "").lower()):
            if w not in known:
                marked = language.START + w
                known[w] = sum(forward(marked[i:i + language.LONGEST]) for i in range(0, len(marked), language.LONGEST))
            total = total + known[w]
        return total

    odd = [(10_001, "x" * 300 + " " + "ß" * 95 + " é"), (10_002, "12 34"), (10_003, None), (10_004, "a" * 47 + " " + "b" * 48), (10_005, "ΣΑΣ. σ 字字 İ")]
    frame = docs.select("doc_id", "text").unionAll(spark.createDataFrame(odd, "doc_id long, text string"))
    for r, text in zip(language.predict(frame.orderBy("doc_id"), model).orderBy("doc_id").collect(),
                       [x.text for x in frame.orderBy("doc_id").collect()]):
        if not regex.search(r"\p{L}", text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        log = score(text)
        odds = np.exp(log - log.max())
        best = odds.max() / odds.sum()
        assert abs(r.score - best) < 1e-9 and odds[model.languages.index(r.lang_pred)] > 1 - 1e-9


def test_licences(spark):
    lines = {t: f for f, ts in licenses.TEMPLATES.items() for t in ts[:1]}
    texts = [(i, words(20, i) + "\n" + t + ".\n" + words(15, 50 + i), f) for i, (t, f) in enumerate(lines.items())]
    plain = [(100 + i, words(60, 200 + i) + "\nthe general public license was renewed in the public office", None) for i in range(20)]
    frame = spark.createDataFrame([(i, t) for i, t, _ in texts + plain] + [(500, None), (501, ""), (None, "x"), (1, texts[1][1])],
                                  "doc_id long, text string")
    model = licenses.fit(frame)
    got = {r.doc_id: r for r in licenses.scan(frame, model).collect()}
    for i, t, f in texts:
        assert [x.family for x in got[i].found] == [f]
        assert t[got[i].found[0].start:got[i].found[0].stop].rstrip(".") in lines
    assert all(not got[i].found for i, _, _ in plain)
    assert got[500].n_paragraphs == got[501].n_paragraphs == 0
    assert licenses.scan(documents(spark), model).count() == len(rows())
    assert licenses.scan(empty(spark), licenses.fit(empty(spark))).collect() == []


def test_licences_wrapped_over_lines(spark):
    gpl = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
           "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.")
    headers = {
        "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
               "following conditions are met:",
        "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
               "provided that the above copyright notice and this permission notice appear in all copies.",
        "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
               "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use,",
        "GPL": gpl, "AGPL": gpl.replace("GNU General", "GNU Affero General")}
    docs, want = [], {}
    for k, (family, header) in enumerate(headers.items()):
        for j, (wide, mark) in enumerate([(72, ""), (72, " * "), (30, "# "), (9, ""), (72, "")]):
            # alone in a paragraph, between lines of one, and at the beginning of the text
            before, after = [("x y\n\n", "\n\n"), (words(12, k) + "\n", "\n"), ("", "\n")][j % 3]
            notice = "\n".join(textwrap.wrap(header, wide, initial_indent=mark, subsequent_indent=mark, break_long_words=False))
            docs.append((10 * k + j, before + notice + after + words(15, 50 + k)))
            want[10 * k + j] = (family, len(before), len(before + notice))
    docs += [(100 + i, "\n".join(words(9, 300 + 7 * i + j) for j in range(9))) for i in range(20)]
    docs.append((200, "Released under the\nMIT License.\nLicensed under the Apache\nLicense, Version 2.0\n\r\n" + words(9, 1)))
    docs.append((201, "Released under the MIT License.\n\n\nall rights\n\nreserved"))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(frame, licenses.fit(frame)).collect()}
    for i, (family, start, stop) in want.items():
        assert [x.family for x in got[i].found] == [family], (i, got[i])
        assert start <= got[i].found[0].start < got[i].found[0].stop <= stop and got[i].found[0].overlap == 1.0
    assert all(not got[100 + i].found for i in range(20))
    assert [(x.family, x.start, x.stop) for x in got[200].found] == [("MIT", 0, 31), ("Apache-2.0", 32, 78)]
    assert [x.family for x in got[201].found] == ["MIT"]  # a notice does not go over an empty line
    assert (got[100].n_paragraphs, got[200].n_paragraphs, got[201].n_paragraphs) == (1, 2, 3)


def test_licence_query_finds_the_lines_of_the_corpus(spark):
    docs = {r.doc_id: r.text or "" for r in table(spark, SF, "documents").collect()}
    lines = {"Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
             "This work is licensed under the GNU General Public License, version 3.": "GPL",
             "All rights reserved.": "Proprietary", "Licensed under CC BY-NC 4.0.": "CC-BY-NC"}
    for r in catalog.op2_license_scan(spark, SF).collect():
        assert r.families == ",".join(sorted({f for line, f in lines.items() if line in docs[r.doc_id].split("\n")}))


def test_quality_separates_and_keeps_the_wanted_number(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in catalog.op9_quality_resample(spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    good = [got[i].log_weight for i, q in labels.items() if q == 1]
    bad = [got[i].log_weight for i, q in labels.items() if q == 0]
    assert np.mean([a > b for a in good for b in bad]) > 0.97
    share = np.mean(list(labels.values()))
    assert sum(r.kept for r in got.values()) == round(share * len(got))
    keys = sorted((-r.gumbel_key, r.doc_id, r.kept) for r in got.values())
    assert [k for *_, k in keys] == sorted((k for *_, k in keys), reverse=True)


def test_quality_equals_plain_python(spark):
    frame = spark.createDataFrame([(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
                                  + [(i, t) for i, t, *_ in rows()], "doc_id long, text string")
    targets = {1, 3, 8, 15, 60, 120, 999_999}
    got = quality.resample(quality.weigh(frame, quality.fit(frame, spark.createDataFrame([(i,) for i in targets], "doc_id long"))),
                           40, seed="s").collect()

    def mix(x):
        for _ in range(2):
            x ^= x >> 32
            x = x * 0xD6E8FEB86659FD93 % (1 << 64)
        return x ^ (x >> 32)

    def bins(text):
        hashes = [xxhash.xxh64_intdigest(w.encode()) for w in regex.findall(r"\w+|[^\w\s]+", (text or "").lower())]
        return ([mix(h) % quality.BINS for h in hashes]
                + [mix((a * 3 + mix(b)) % (1 << 64)) % quality.BINS for a, b in zip(hashes, hashes[1:])])

    raw, target, want = Counter(), Counter(), []
    docs = [(r.doc_id, bins(r.text)) for r in frame.collect()]
    for i, grams in docs:
        raw.update(grams)
        target.update(grams if i in targets else [])
    sums = [sum(c.values()) + quality.BINS for c in (target, raw)]
    for i, grams in docs:
        weight = math.fsum(math.log((target[g] + 1) / sums[0]) - math.log((raw[g] + 1) / sums[1]) for g in grams)
        digest = hashlib.md5(f"s{'' if i is None else i}".encode()).hexdigest()[:12]
        want.append((i, len(grams), weight, weight - math.log(-math.log((int(digest, 16) + 0.5) / 2.0 ** 48))))
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    want.sort(key=key)
    got.sort(key=lambda r: key((r.doc_id, r.n_grams, r.log_weight)))
    assert [(r.doc_id, r.n_grams) for r in got] == [w[:2] for w in want]
    assert np.allclose([(r.log_weight, r.gumbel_key) for r in got], [w[2:] for w in want], rtol=1e-9, atol=1e-9)
    floor = sorted((w[3] for w in want), reverse=True)[39]
    assert sum(r.kept for r in got) == 40
    assert all(r.kept == (r.gumbel_key >= floor - 1e-9) for r in got if abs(r.gumbel_key - floor) > 1e-9)


def test_quality_odd_rows(spark):
    frame = documents(spark)
    ratio = quality.fit(frame, spark.createDataFrame([(1,), (None,), (999,), (1,)], "doc_id long"))
    got = quality.resample(quality.weigh(frame, ratio), 4).collect()
    assert len(got) == len(rows()) and sum(r.kept for r in got) == 4
    assert all(r.log_weight == 0 for r in got if r.doc_id in (5, 6, 7))
    assert not quality.fit(frame, spark.createDataFrame([], "doc_id long")).any()
    assert quality.resample(quality.weigh(empty(spark), ratio), 4).collect() == []


def test_pipeline_drops_texts_without_a_letter_where_no_document_is_labelled(spark):
    for docs in (documents(spark), documents(spark).withColumn("lang", F.lit(None).cast("string"))):
        got = corpus_pipeline.language_id(spark, docs, SF)
        assert got.columns == docs.columns
        want = [tuple(r) for r in docs.collect() if regex.search(r"\p{L}", r.text or "")]
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want)) and 0 < len(want) < len(rows())


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    names, sizes = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF).cache()
        sizes.append(docs.count())
        if name != "bpe":
            assert docs.columns == names
        if name in ("exact_dedup", "near_dedup"):
            ids = {r.doc_id for r in docs.select("doc_id").collect()}
            assert ids <= {r.doc_id for r in before.select("doc_id").collect()} and len(ids) == sizes[-1]
    assert sizes[0] >= sizes[1] >= sizes[2] and sizes[3] == sizes[4]
    assert set(docs.columns) >= {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"}


def brute_mix(docs):
    """Copies of each (doc_id, source, size), drawn in plain Python."""
    by = {}
    for i, text, source in docs:
        by.setdefault((source is None, source or ""), []).append((len(re.findall(r"[^\x20\x09-\x0d]+", text)), i))
    weights = {k: (5.0, 2.0, 1.0)[n % 3] for n, k in enumerate(sorted(by, key=lambda k: (k[0], k[1].encode())))}
    sizes = {k: sum(n for n, _ in v) for k, v in by.items()}
    target, left, free = {}, 1.5 * sum(sizes.values()), set(by)
    while free:
        level = left / sum(weights[k] for k in free)
        over = {k for k in free if weights[k] * level > 2 * sizes[k]}
        for k in over or free:
            target[k] = 2.0 * sizes[k] if over else weights[k] * level
            left -= target[k] if over else 0
        free = free - over if over else set()
    out = {}
    for k, v in by.items():
        rate = target[k] / sizes[k] if sizes[k] else 0.0
        u = int(hashlib.md5(f"mix{int(k[0])}{k[1]}".encode()).hexdigest()[:6], 16) / 2 ** 24
        v.sort(key=lambda x: (x[0], hashlib.md5(str(x[1]).encode()).hexdigest(), x[1]))
        for rank, (_, i) in enumerate(v):
            out[i] = math.floor((rank + 1) * rate + u) - math.floor(rank * rate + u)
    return out


def test_pipeline_equals_brute_force(spark):
    docs = [(r.doc_id, r.text, r.source) for r in table(spark, SF, "documents").collect()]
    docs = [d for d in docs if d[1] and regex.search(r"\p{L}", d[1])]
    best = {}
    for d in docs:
        k = squeezed(d[1])
        best[k] = min(best.get(k, d), d, key=lambda x: (-len(x[1]), x[0]))
    docs = list(best.values())
    near = brute_near([d[:2] for d in docs])
    docs = [d for d in docs if near[d[0]][0] == d[0]]
    copies = brute_mix(docs)
    tokenizer = Tokenizer.from_file(catalog.BYTE_BPE)
    want = []
    for i, text, _ in docs:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        row = (i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        want += [row] * copies[i]
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)


def test_pipeline_stages_take_odd_and_empty_tables(spark):
    for make in (documents, empty):
        docs = make(spark)
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF).cache()
            if name != "bpe":
                assert docs.columns == make(spark).columns
        docs.count()
