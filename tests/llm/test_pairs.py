"""Near duplicates, embeddings and repeats against brute force."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents, empty, rows, words

from ipscope.llm import links, near_dup, repeats
from ipscope.llm.catalog import queries
from ipscope.llm.common import table
from ipscope.llm.embedding_dedup import near_vectors

SF = "/root/testdata/sf0.001"


def shingles(text):
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", text or "") if x]
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components(nodes, pairs):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def brute_near(docs):
    sets = {i: shingles(t) for i, t in docs}
    ids = sorted(sets)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if sets[a] and sets[b] and 9 * len(sets[a] & sets[b]) >= 4 * (len(sets[a]) + len(sets[b]))]
    count = Counter(x for p in pairs for x in p)
    roots = components(ids, pairs)
    return {i: (roots[i], count[i]) for i in ids}


@pytest.mark.parametrize("block", [512, 2])
def test_near_duplicates_equal_brute_force(spark, block):
    docs = table(spark, SF, "documents")
    got = {r.doc_id: (r.class_id, r.n_links) for r in near_dup.near_duplicates(docs, block=block).collect()}
    assert got == brute_near([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_near_duplicates_odd_rows(spark):
    got = near_dup.near_duplicates(documents(spark)).collect()
    assert len(got) == len(rows())
    by = {r.doc_id: r for r in got}
    want = brute_near([(r[0], r[1]) for r in rows() if r[0] is not None])
    for i, (root, n) in want.items():
        assert by[i].class_id == root
        assert by[i].n_links == (n + 1 if i in (14, 15) else n)  # doc 15 is there twice
    assert by[1].n_copies == 3 and by[3].class_id == 1 and not by[3].kept
    assert by[5].n_links == by[6].n_links == by[7].n_links == 0 and by[7].kept
    assert near_dup.near_duplicates(empty(spark)).collect() == []


def test_near_duplicates_of_repeated_and_missing_ids(spark):
    x, y = words(80, 1), words(80, 2)
    near = lambda t, k: " ".join(w if i != k else "other" for i, w in enumerate(t.split()))
    z = words(80, 3)
    data = [(5, x), (5, y), (3, near(y, 40)), (None, near(x, 79)), (None, z), (None, near(z, 0)), (None, near(z, 79)), (7, z + " more"), (None, None), (8, "")]
    frame = spark.createDataFrame([(i, t, "k") for i, t in data], "doc_id long, text string, kept string").repartition(3)
    got = {(r.doc_id, r.class_id, r.n_links, r.kept) for r in near_dup.near_duplicates(frame.select("doc_id", "text")).collect()}
    assert got == {(5, 5, 1, True), (5, 3, 1, False), (3, 3, 1, True), (None, 5, 1, False), (None, 7, 3, False), (7, 7, 3, True),
                   (None, None, 0, True), (8, 8, 0, True)}
    left = near_dup.keep(frame)
    assert left.columns == frame.columns
    assert sorted(map(repr, map(tuple, left.collect()))) == sorted(repr((i, t, "k")) for i, t in data if (i, t) in (
        (5, x), (3, near(y, 40)), (7, z + " more"), (None, None), (8, "")))
    nameless = spark.createDataFrame([(None, t) for t in (z, near(z, 0), near(z, 79))], "doc_id long, text string")
    assert near_dup.keep(nameless).count() == 1  # one document of a class stays, though none has an id
    named = spark.createDataFrame([("b", x), ("a", near(x, 3))], "doc_id string, text string")
    assert {(r.doc_id, r.class_id) for r in near_dup.near_duplicates(named).collect()} == {("a", "a"), ("b", "a")}


def test_prefixes_are_shortened_until_the_recall_is_met():
    assert near_dup.shortest_prefix(28, 8, 0.8, 0.5) == 8
    for recall in (0.9, 0.99, 0.9995):
        n = near_dup.shortest_prefix(28, 8, 0.8, recall)
        assert near_dup.meets(0.8, 28, n) >= recall
        assert n == 8 or near_dup.meets(0.8, 28, n + 1) < recall
    assert near_dup.measured_recall({}, 28, 8) == 1.0 and near_dup.measured_recall({near_dup.BINS: 9}, 28, 8) == 1.0
    low = near_dup.measured_recall({40: 10, 45: 10}, 28, 8)
    assert near_dup.meets(0.8, 28, 8) < low < near_dup.meets(0.9, 28, 8) and low < near_dup.measured_recall({40: 10, 45: 10}, 28, 7)


def test_forest_recall_level_by_level(spark, monkeypatch):
    """Pairs just above the threshold: few trees find a share at full depth, shortening finds nearly all."""
    base = [words(60, 100 + k, 5000).split() for k in range(150)]
    docs = [(2 * k, " ".join(w)) for k, w in enumerate(base)] + [
        (2 * k + 1, " ".join([*w[:-1 - k % 5], *(f"new{k}{i}" for i in range(1 + k % 5))])) for k, w in enumerate(base)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    want = {i for i, (_, n) in brute_near(docs).items() if n}
    depths = []
    inner = near_dup._buckets
    monkeypatch.setattr(near_dup, "_buckets", lambda c, trees, depth, length, block: depths.append(length) or inner(c, trees, depth, length, block))

    def share(trees, recall):
        depths.clear()
        return len({r.doc_id for r in near_dup.near_duplicates(frame, trees=trees, recall=recall).collect() if r.n_links} & want) / len(want)

    assert share(4, 0.1) < 0.97 and depths == [8]
    assert share(4, 0.9) >= 0.9 and depths == list(range(8, min(depths) - 1, -1)) and len(depths) > 1
    assert share(28, 0.9995) >= 0.99


def test_components_of_chains_stars_and_loops(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 199), (199, 200)]
    got = {r.node: r.root for r in links.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = components({x for p in pairs for x in p} - set(), [p for p in pairs if p[0] != p[1]])
    assert got == {n: r for n, r in want.items()}
    assert links.components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_vectors(rows, threshold=0.93):
    good = [(i, np.array(v, float), g) for i, v, g in rows
            if g is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    pairs = [(a, b) for k, (a, v, g) in enumerate(good) for b, w, h in good[k + 1:]
             if g == h and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= threshold]
    count = Counter(x for p in pairs for x in p)
    roots = components([r[0] for r in rows], pairs)
    return {r[0]: (count[r[0]], roots[r[0]], roots[r[0]] == r[0]) for r in rows}


@pytest.mark.parametrize("per_cell, block", [(1000, 512), (12, 5)])
def test_vectors_equal_brute_force(spark, per_cell, block):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(30, 16))
    data = [(i, [float(x) for x in np.float32(centres[i % 30] + 0.19 * rng.normal(size=16))], int(i % 30 % 3)) for i in range(400)]
    data += [(1000 + i, data[5][1], data[5][2]) for i in range(40)]  # equal vectors
    data += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [None] + [1.0] * 15, 1), (2003, [float("nan")] * 16, 1),
             (2004, [float("inf")] + [1.0] * 15, 0), (2005, data[0][1], None), (2006, [], 1), (2007, [1.0, 2.0], 1), (2008, [2.0, 4.0], 1)]
    frame = spark.createDataFrame([(*r, "x") for r in data], "vec_id long, embedding array<float>, label int, rep string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept)
           for r in near_vectors(frame, per_cell=per_cell, block=block).collect()}
    want = brute_vectors(data)
    assert sum(n for n, _, _ in want.values()) > 400
    assert got == want


def test_vectors_at_the_threshold_of_any_size_and_without_id(spark):
    def at(c, scale=1.0):
        return [scale * c, scale * math.sqrt(1 - c * c)]

    base = [1.0, 0.0]
    data = [(1, base), (2, at(0.93 + 1e-9)), (3, at(0.93 - 1e-9, -1.0)), (4, [-1e200, 0.0]), (5, [-1e-200, 0.0]), (6, [-5e-324, 0.0]),
            (None, [0.0, 1.0]), (None, [0.0, 1e300]), (None, [0.0, -1.0]), (None, None), (9, [1e-3, -2.0])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in data], "vec_id long, embedding array<double>, label int")
    got = sorted(map(repr, map(tuple, near_vectors(frame).collect())))
    want = [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (4, 2, 4, True), (5, 2, 4, False), (6, 2, 4, False),
            (None, 1, None, False), (None, 1, None, False), (None, 1, 9, False), (None, 0, None, True), (9, 1, 9, True)]
    assert got == sorted(map(repr, want))


def test_vectors_of_an_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert near_vectors(frame).collect() == []


def brute_repeats(docs, span=50):
    out, seen, group = {}, set(), []
    for i, x in sorted(docs):
        if group and group[0] != i:
            seen.update(group[1])
            group = []
        grams = [x[k:k + span] for k in range(len(x) - span + 1)]
        cover = bytearray(len(x))
        for k, g in enumerate(grams):
            if g in seen:
                cover[k:k + span] = b"\1" * span
        group = [i, [*(group[1] if group else []), *grams]]
        kept = bytes(b for b, c in zip(x, cover) if not c)
        spans = sum(1 for k in range(len(x)) if cover[k] and (k == 0 or not cover[k - 1]))
        out[i] = (len(x), sum(cover), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_repeats_equal_brute_force(spark):
    docs = table(spark, SF, "documents")
    got = {r.doc_id: tuple(r[1:]) for r in queries()["op8_repeat_removal"](spark, SF).collect()}
    assert got == brute_repeats([(r.doc_id, (r.text or "").encode()) for r in docs.collect()])


def test_repeats_odd_rows_and_a_full_filter(spark):
    for bits in (28, 6):  # a filter of 64 bits lets everything through
        got = repeats.remove_repeats(documents(spark), bits=bits).collect()
        assert len(got) == len(rows())
        want = brute_repeats([(r[0], (r[1] or "").encode()) for r in rows() if r[0] is not None])
        for r in got:
            if r.doc_id is None:
                assert not r.spans
                continue
            removed = sum(s.stop - s.start for s in r.spans)
            assert (r.n_bytes, removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) == want[r.doc_id]
    assert repeats.remove_repeats(empty(spark)).collect() == []


def test_repeats_of_one_byte_and_nulls_in_text(spark):
    texts = [(1, "a" * 49), (2, "a" * 50), (3, "a" * 300), (4, "\x00" * 60 + "b"), (5, "c" + "\x00" * 60), (6, "ab" * 40)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, sum(s.stop - s.start for s in r.spans)) for r in repeats.remove_repeats(frame).collect()}
    want = {i: v[:2] for i, v in brute_repeats([(i, t.encode()) for i, t in texts]).items()}
    assert got == want


@pytest.mark.parametrize("letters, slice_size", [("ab", 64), ("a", 64), ("abc\x00", 1 << 18)])
def test_longest_previous_factors_equal_a_loop(monkeypatch, letters, slice_size):
    monkeypatch.setattr(repeats, "SLICE", slice_size)
    rng = np.random.default_rng(len(letters))
    span = 32
    text = ["".join(rng.choice(list(letters), 90)) for _ in range(3)] + ["x" * 40 + "".join(rng.choice(list(letters), 60))]
    segments = sorted({text[i][a:a + n].encode() for i, a, n in zip(rng.integers(0, 4, 60), rng.integers(0, 30, 60), rng.integers(32, 60, 60))})
    documents = rng.integers(0, 20, len(segments))
    got = repeats.earlier_matches(segments, documents, span)

    def common(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    for k, (s, found) in enumerate(zip(segments, got)):
        for p in range(len(s) - span + 1):
            best = max((common(s[p:], t[q:]) for j, t in enumerate(segments) if documents[j] < documents[k] for q in range(len(t) - span + 1)), default=0)
            assert found[p] == (best if best >= span else 0)


def test_nearest_smaller_equals_a_loop():
    rng = np.random.default_rng(0)
    for n in (1, 2, 50, 400):
        documents, common = rng.integers(0, 9, n), np.r_[0, rng.integers(30, 60, n - 1)] if n > 1 else np.zeros(1, int)
        got = repeats.nearest_smaller(documents, common, 32)
        for i in range(n):
            j, least = i, 10 ** 9
            while j > 0 and documents[j] >= documents[i]:
                least = min(least, common[j])
                j -= 1
            found = j < i and documents[j] < documents[i] and least >= 32
            assert got[i] == (least if found else 0), (n, i)


def test_hot_minimizer_in_varied_text(spark):
    """A line of 40 bytes in most documents with other text around it, and repeats that hold it."""
    line = "this very common line has forty bytes ok"
    docs = [(i, words(6, i) + " " + line + " " + words(6, 1000 + i)) for i in range(300)] + [(400 + i, docs_[1]) for i, docs_ in enumerate([(0, words(6, 5) + " " + line + " " + words(3, 1005))])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest())
           for r in repeats.remove_repeats(frame).collect()}
    assert got == brute_repeats([(i, t.encode()) for i, t in docs])


@pytest.mark.parametrize("hot, windows, bits", [(2, 1 << 17, 28), (100, 64, 28), (3, 1, 6)])
def test_minimizers_dealt_by_window_change_no_result(spark, monkeypatch, hot, windows, bits):
    """All repeats, or those of a common line, dealt by window; also with hardly any window held back."""
    line = "this very common line has forty bytes ok"
    texts = [(i, words(6, i % 120) + " " + line + " " + words(6, 1000 + i % 150)) for i in range(300)]
    texts += [(1000 + r[0], r[1] or "") for r in rows() if r[0] is not None and r[0] != 15] + [(5000, texts[3][1] * 3)]
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(repeats, "WINDOWS", windows)
    got = {r.doc_id: (r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest())
           for r in repeats.remove_repeats(frame, hot=hot, bits=bits).collect()}
    assert got == brute_repeats([(i, t.encode()) for i, t in texts])


def test_hot_minimizers_are_found_and_cut(spark):
    """The line's minimizers are marked, those of two documents are not; its segments are single windows of many buckets."""
    line = "this very common line has forty bytes ok"
    texts = [(i, words(6, i) + " " + line + " " + words(6, 1000 + i)) for i in range(300)] + [(400, words(40, 7)), (401, words(40, 7))]
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    keep, hot = repeats.repeated_minimizers(frame, 50, 28, 200)
    found = [np.unique(repeats.minimizers(np.frombuffer(t.encode(), np.uint8), 50)) for t in (line + " 123456789", texts[-1][1])]
    assert repeats.marked(keep, found[0]).any() and repeats.marked(keep, found[1]).all()
    coarse = np.uint64(repeats.COARSE)
    mask = np.uint64((1 << 28) - 1)
    assert repeats.marked(hot, (found[0] & mask) >> coarse).any() and not repeats.marked(hot, (found[1] & mask) >> coarse).any()
    held = repeats._Segments(50, 1 << 20, keep, hot)
    ids, flat = [i for i, _ in texts], pa.array([t for _, t in texts])
    assert not list(held.add(ids, ids, flat))
    smallest = np.array([repeats.minimizers(np.frombuffer(x[4], np.uint8), 50)[0] for x in held.sent], np.uint64)
    cut = [x for x, h in zip(held.sent, repeats.marked(hot, (smallest & mask) >> coarse)) if h]
    assert all(len(x[4]) == 50 for x in cut) and any(len(x[4]) > 50 for x in held.sent)
    assert len({x[0] for x in cut}) > 0.9 * len({x[4] for x in cut}) > 900
