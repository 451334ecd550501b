"""Licence scan by a trained paragraph classifier.

Consecutive lines with a word are a paragraph, so a notice may be wrapped over lines; a line
is cut at the ends of its sentences and clauses, so a notice may also stand within a line.
Every window of such pieces of a paragraph that a notice could fill, and the whole paragraph,
is judged: a sparse logistic regression over hashed word n-grams (one and two words)
names the licence family; its probability is calibrated on held-out phrasings and on licences
of other families, with ``unknown`` as a class of its own, and a comparison with the family's
templates must confirm a named family.  Of windows that hold the same notice the best one is
reported, and notices of one family that follow each other are one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ipscope.llm.common import WordHashes, mix64, slices
from ipscope.llm.licence_texts import FRAMES, HELD_FRAMES, HELD_OTHERS, NAMES, OTHERS, SPDX, TEXTS, clauses

BINS = 1 << 15
TOKENS = regex.compile(r"[\p{L}\p{N}]+")
#: Where a text is cut into pieces: line ends, and ends of sentences and clauses between words.
CUTS = regex.compile(r"\n|(?<=[\p{L}\p{N}]{2}[.!?;:])[ \t]+(?=[\p{L}\p{N}])")
UNKNOWN = "unknown"
SPELLINGS = {"licence": "license", "licences": "licenses", "licenced": "licensed"}

# Short public licence notices, by family.
NOTICES = {
    "AGPL": ["licensed under the GNU Affero General Public License, version 3",
             "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0", "released under the Apache 2.0 license",
                   "you may not use this file except in compliance with the License",
                   "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"],
    "BSD": ["released under the BSD 3-Clause License", "Licensed under the BSD license",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "CC-BY": ["Licensed under CC BY 4.0", "licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND": ["Licensed under CC BY-ND 4.0", "licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0": ["Released under CC0 1.0 Universal", "dedicated to the public domain under the CC0 1.0 Universal public domain dedication"],
    "GPL": ["licensed under the GNU General Public License, version 3", "licensed under the GNU GPL v3",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"],
    "ISC": ["released under the ISC License",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "LGPL": ["licensed under the GNU Lesser General Public License, version 3",
             "redistribute it and/or modify it under the terms of the GNU Lesser General Public License"],
    "MIT": ["Released under the MIT License", "Licensed under the MIT license",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "licensed under the Mozilla Public License 2.0"],
    "Proprietary": ["All rights reserved", "Copyright. All rights reserved. No part of this publication may be reproduced without permission"],
    "Unlicense": ["This is free and unencumbered software released into the public domain", "released under the Unlicense"],
}
# Sentences with the words of licences that name none.
NEAR_MISSES = ["the driving license was renewed", "he has a licence to sell", "permission was granted by the office",
               "the general public is welcome", "version 2 of the software was released", "the terms of the contract",
               "all the rights of man", "under the terms", "a free copy of the book", "released in 2004",
               "this work is done", "come by 4 o clock or at 3 0 5", "distributed to the public", "the source code is here", "use of the software"]


# More of them, held out to calibrate.
HELD_MISSES = ["a fishing license costs ten pounds", "we ask for your permission to enter", "the foundation published a free program",
               "no part of the public was admitted", "the copyright office is closed", "conditions of the road and the following day"]


def tokens(line: str) -> list[str]:
    """Words in lower case, the spellings of licence made one."""
    return [SPELLINGS.get(w, w) for w in TOKENS.findall(line.lower())]


def pairs(line: str) -> set[tuple[str, ...]]:
    words = tokens(line)
    return set(zip(words, words[1:])) or {tuple(words)}


def _mentions(name: str) -> list[str]:
    """What confirms a mention of a name: the name, or with its neighbour if it is one word."""
    return [name] if len(tokens(name)) > 1 else [f"under {name}", f"the {name}", f"{name} license", f"license {name}", f"the {name} license",
                                                          f"{name} licensed", f"{name} or later", f"{name} only"]


def _templates() -> tuple[dict[str, list[str]], dict[tuple[str, ...], float]]:
    """Templates by family, and the weight of each word pair: one over the number of classes that have it.

    Near misses and other licences are one class.  A template without a pair that no other
    family has names no family and is left out.
    """
    every = {f: [*NOTICES[f], *clauses(TEXTS.get(f, "")), *[m for n in NAMES.get(f, []) for m in _mentions(n)],
                 *[f"SPDX-License-Identifier: {i}" for i in SPDX.get(f, [])]] for f in NOTICES}
    having: dict[tuple[str, ...], set[str]] = {}
    for f, ts in every.items():
        for t in [*ts, *[frame.format(n) for frame in FRAMES for n in NAMES.get(f, [])]]:
            for pair in pairs(t):
                having.setdefault(pair, set()).add(f)
    own = {pair for pair, fs in having.items() if len(fs) == 1}
    for t in NEAR_MISSES + OTHERS:
        for pair in pairs(t) & having.keys():
            having[pair].add(UNKNOWN)
    return ({f: [t for t in dict.fromkeys(ts) if pairs(t) & own] for f, ts in every.items()},
            {pair: 1.0 / len(fs) for pair, fs in having.items()})


TEMPLATES, PAIR_WEIGHTS = _templates()


class Evidence:
    """The templates of one family by word pair, for finding the one a window holds most of."""

    def __init__(self, texts: list[str]):
        self.pairs = [pairs(t) for t in texts]
        self.total = [sum(PAIR_WEIGHTS[x] for x in t) for t in self.pairs]
        self.own = [{x for x in t if PAIR_WEIGHTS[x] == 1.0} for t in self.pairs]
        self.having: dict[tuple[str, ...], list[int]] = {}
        for i, t in enumerate(self.pairs):
            for x in t:
                self.having.setdefault(x, []).append(i)

    def best(self, seen) -> tuple[float, set[tuple[str, ...]]]:
        """Largest share of a template among pairs ``seen``, and its pairs; more weight first among equals.

        The share is that of the weights, or that of the pairs no other class has if it is smaller.
        """
        weight: dict[int, float] = {}
        for x in seen:
            for i in self.having.get(x, ()):
                weight[i] = weight.get(i, 0.0) + PAIR_WEIGHTS[x]
        if not weight:
            return 0.0, set()
        share = {i: min(w / self.total[i], len(self.own[i] & seen) / len(self.own[i]) if self.own[i] else 1.0)
                 for i, w in weight.items()}
        i = max(share, key=lambda i: (round(share[i], 9), weight[i], -i))
        return min(1.0, round(share[i], 12)), self.pairs[i]


#: Words a window may have between its first and last piece; a template has at most half as many.
REACH = 2 * max(len(tokens(t)) for ts in TEMPLATES.values() for t in ts)


def pieces(text: str) -> list[tuple[int, int]]:
    """Starts and stops of the pieces of a text, in order; every line has one at least."""
    cuts = [c.span() for c in CUTS.finditer(text)]
    return list(zip([0, *(z for _, z in cuts)], [*(a for a, _ in cuts), len(text)]))


def two_grams(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Bins of the two-word grams of words with these hashes."""
    return (mix64(first * np.uint64(5) + mix64(second)) % np.uint64(BINS)).astype(np.int64)


def grams(lines: list[list[str]], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins of the one- and two-word grams of all lines, the line of each, and the lines' numbers of grams."""
    words, size = hashes.of(lines)
    owner = np.repeat(np.arange(len(lines)), size)
    same = owner[1:] == owner[:-1] if len(owner) else np.zeros(0, bool)
    one = (mix64(words) % np.uint64(BINS)).astype(np.int64)
    two = two_grams(words[:-1], words[1:])[same]
    return np.concatenate([one, two]), np.concatenate([owner, owner[:-1][same]]), np.maximum(1, 2 * size - 1)


class LicenseModel:
    """Families (``unknown`` last), weights by bin and family, and the calibrated temperature."""

    def __init__(self, families: list[str], weights: np.ndarray, bias: np.ndarray, temperature: float):
        self.families, self.weights, self.bias, self.temperature = families, weights, bias, temperature

    def scores(self, lines: list[list[str]], hashes: WordHashes) -> np.ndarray:
        """Logits of each line: summed gram weights over the root of the number of grams."""
        out, n = self.sums(lines, hashes)
        return out / np.sqrt(n)[:, None] + self.bias

    def sums(self, lines: list[list[str]], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
        """Summed gram weights of each line, and the lines' numbers of grams."""
        bins, owner, n = grams(lines, hashes)
        order = np.argsort(owner, kind="stable")
        out = np.zeros((len(lines), len(self.families)))
        counts = np.bincount(owner, minlength=len(lines))
        full = np.flatnonzero(counts)
        if len(full):
            out[full] = np.add.reduceat(self.weights[bins[order]], (np.cumsum(counts) - counts)[full], axis=0)
        return out, n

    def windows(self, lines: list[list[str]], follows: np.ndarray, hashes: WordHashes
                ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """First lines, last lines and logits of the windows of all paragraphs, then of the whole paragraphs.

        ``follows`` says of each line that the next one is in its paragraph.  A window has up to
        ``REACH`` words between its first and last line, however many lines that are.  Grams
        across line ends count like others.
        """
        sums, _ = self.sums(lines, hashes)
        count = np.array([len(w) for w in lines], np.int64)
        joints = np.flatnonzero(follows)
        across = np.zeros_like(sums)
        if len(joints):
            ends = np.array([(hashes[lines[i][-1]], hashes[lines[i + 1][0]]) for i in joints], np.uint64)
            across[joints] = self.weights[two_grams(ends[:, 0], ends[:, 1])]
        first = last = np.flatnonzero(count)
        total, size = sums[first], count[first]
        while len(first):
            yield first, last, self._logits(total, size)
            more = follows[last] & (size - count[first] <= REACH)
            first, last, total, size = first[more], last[more], total[more], size[more]
            total = total + across[last] + sums[last + 1]
            last = last + 1
            size = size + count[last]
        some = np.flatnonzero(count)
        if len(some):
            begins = np.flatnonzero(np.r_[True, ~follows[some[:-1]]])
            total = np.add.reduceat((sums + across)[some], begins, axis=0)
            yield some[begins], some[np.r_[begins[1:] - 1, len(some) - 1]], self._logits(total, np.add.reduceat(count[some], begins))

    def _logits(self, total: np.ndarray, size: np.ndarray) -> np.ndarray:
        return total / np.sqrt(np.maximum(1, 2 * size - 1))[:, None] + self.bias

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        e = np.exp((logits - logits.max(axis=1, keepdims=True)) / self.temperature)
        return e / e.sum(axis=1, keepdims=True)


def _examples(plain: list[list[str]], rng: np.random.Generator
              ) -> tuple[list[list[str]], np.ndarray, np.ndarray, list[str]]:
    """Example lines, their classes, which are held out to calibrate, and the classes.

    Trained on are templates and framed names, cut, thinned and set between words of plain
    paragraphs, and as unknown near misses, notices of other licences and plain paragraphs.
    Held out are names in other frames, templates with a fifth of their words gone, other near
    misses, other licences and a fifth of the plain paragraphs.
    """
    families = [*sorted(TEMPLATES), UNKNOWN]
    filler = [w for p in plain for w in p] or ["text"]
    lines, labels, held = [], [], []

    def add(words: list[str], label: int, hold: bool, before: int = 0, after: int = 0) -> None:
        around = [[filler[j] for j in rng.integers(0, len(filler), rng.integers(0, n + 1))] for n in (before, after)]
        lines.append([*around[0], *words, *around[1]])
        labels.append(label)
        held.append(hold)

    def thin(words: list[str], share: float) -> list[str]:
        return [w for w in words if rng.random() > share] or words

    for k, family in enumerate(families[:-1]):
        for template in TEMPLATES[family]:
            words = tokens(template)
            for i in range(24):
                add(words if i < 8 else thin(words, 0.08), k, False, *((0, 0) if i < 4 else (6, 6)))
            add(thin(words, 0.2), k, True, 3, 3)
        for name in NAMES.get(family, []):
            for frame in FRAMES:
                for i in range(3):
                    add(tokens(frame.format(name)), k, False, *((0, 0) if i < 1 else (6, 6)))
            for frame in HELD_FRAMES:
                add(tokens(frame.format(name)), k, True, 3, 3)
    for texts, copies, hold in ((NEAR_MISSES + OTHERS, 20, False), (HELD_MISSES + HELD_OTHERS, 5, True)):
        for text in texts:
            for _ in range(copies):
                add(tokens(text), len(families) - 1, hold, 0, 8)
    for p in plain:
        add(p, len(families) - 1, bool(rng.random() < 0.2))
    return lines, np.array(labels), np.array(held), families


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most_paragraphs: int = 4000,
        most_characters: int = 400, rounds: int = 150, seed: int = 7) -> LicenseModel:
    """Train on the templates and about ``most_paragraphs`` paragraphs of the corpus as unknown.

    The paragraphs are the first lines of documents picked by a digest of doc_id, up to
    ``most_characters`` of each, so that about as much reaches the driver for any corpus; lines
    that hold a whole template, or the beginning of one that is wrapped over the next lines,
    are left out.  Phrasings, licences and paragraphs that are not trained on calibrate the
    temperature.  An empty corpus trains on the templates alone.
    """
    share = min(1.0, most_paragraphs / max(1, docs.count()))
    place = F.pmod(F.xxhash64(F.col(doc_id)), F.lit(1 << 30))
    sample = (docs.filter(F.col(doc_id).isNotNull() & (place < F.lit(int(share * (1 << 30)))))
              .select(F.col(doc_id).alias("id"), F.substring(F.trim(F.col(text)), 1, 2 * most_characters).alias("head"))
              .filter("length(head) > 0").collect())
    sample.sort(key=lambda r: (r.id, r.head))
    starts: dict[tuple[str, ...], list[list[str]]] = {}
    for t in (tokens(t) for ts in TEMPLATES.values() for t in ts):
        starts.setdefault(tuple(t[:2]), []).append(t)

    def holds(line: list[str], rest: list[str]) -> bool:
        """Whether a template starts in the line."""
        words = line + rest
        return any(words[i:i + len(t)] == t for i in range(len(line)) for t in starts.get(tuple(words[i:i + 2]), ()))

    def first(head: str) -> tuple[list[str], list[str]]:
        line = head.split("\n", 1)[0][:most_characters]
        return tokens(line), tokens(head[len(line):])

    plain = [line for line, rest in (first(r.head) for r in sample) if line and not holds(line, rest)]
    rng = np.random.default_rng(seed)
    lines, labels, held, families = _examples(plain, rng)
    bins, owner, n = grams(lines, WordHashes())
    use = ~held[owner]
    rows, columns = owner[use], bins[use]
    weights, bias = np.zeros((BINS, len(families)), np.float32), np.zeros(len(families))
    target, scale = np.eye(len(families))[labels], 1.0 / np.sqrt(n)[:, None]
    balance = (1.0 / np.maximum(1, np.bincount(labels[~held], minlength=len(families)))[labels]) * len(lines) / len(families)
    balance = np.where(held, 0.0, balance)[:, None]
    by_row, by_bin = columns[np.argsort(rows, kind="stable")], rows[np.argsort(columns, kind="stable")]
    lines_used, row_starts = np.unique(np.sort(rows), return_index=True)
    active, bin_starts = np.unique(np.sort(columns), return_index=True)
    squares, square_bias = np.full((len(active), len(families)), 1e-3), np.full_like(bias, 1e-3)
    for _ in range(rounds):  # full-batch AdaGrad on the bins that occur
        logits = np.tile(bias, (len(lines), 1))
        logits[lines_used] += np.add.reduceat(weights[by_row], row_starts, axis=0) * scale[lines_used]
        p = LicenseModel(families, weights, bias, 1.0).probabilities(logits)
        error = (p - target) * balance / len(lines)
        gradient = np.add.reduceat((error * scale).astype(np.float32)[by_bin], bin_starts, axis=0) + 1e-6 * weights[active]
        squares += gradient ** 2
        square_bias += error.sum(axis=0) ** 2
        weights[active] -= 0.5 * gradient / np.sqrt(squares)
        bias -= 0.5 * error.sum(axis=0) / np.sqrt(square_bias)
    model = LicenseModel(families, weights, bias, 1.0)
    logits, truth = model.scores([x for x, h in zip(lines, held) if h], WordHashes()), labels[held]

    def loss(temperature: float) -> float:
        model.temperature = temperature
        return -np.log(np.maximum(model.probabilities(logits)[np.arange(len(truth)), truth], 1e-12)).mean()

    model.temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=loss)
    return model


def notices(hits: list[tuple[int, int, int, float]], words: list[str], stops: list[int],
            templates: dict[int, Evidence], overlap: float) -> list[tuple[int, int, int, float, float]]:
    """The notices among the windows of a text: first piece, last piece, family, probability, overlap; in order.

    ``hits`` are first piece, last piece, family and probability; ``words`` are those of the whole
    text and ``stops`` the number of words up to each piece's end.  Best first (overlap, then
    fewer words), every word pair confirms one notice: a window is taken if pairs that no
    better notice used suffice for ``overlap``.
    """
    used: set[int] = set()

    def alike(first: int, last: int, family: int) -> tuple[float, set[int]]:
        a, z = stops[first - 1] if first else 0, stops[last]
        places: dict[tuple[str, ...], list[int]] = {}
        for i in range(a, z - 1):
            if i not in used:
                places.setdefault((words[i], words[i + 1]), []).append(i)
        share, best = templates[family].best(places.keys())
        return share, {i for p in best & places.keys() for i in places[p]}

    def entry(first: int, last: int, family: int, p: float) -> tuple | None:
        share, places = alike(first, last, family)
        if share < overlap:
            return None
        return (-share, stops[last] - (stops[first - 1] if first else 0), first, last, family, p), places

    queue, evidence = [], {}
    for h in hits:
        if (e := entry(*h)) is not None:
            evidence[h] = e[1]
            queue.append(e[0])
    heapq.heapify(queue)
    out = []
    while queue:
        top = heapq.heappop(queue)
        h = top[2:6]
        if evidence[h] & used:  # less is left for it than when it was queued
            if (e := entry(*h)) is not None:
                evidence[h] = e[1]
                heapq.heappush(queue, e[0])
            continue
        used |= evidence[h]
        out.append((*h, -top[0]))
    return sorted(out)


def joined(found: list[tuple[int, int, int, float, float]], paragraph: np.ndarray) -> list[tuple[int, int, int, float, float]]:
    """Notices of one family in one paragraph, with no piece between them, as one: largest probability and overlap."""
    out: list[tuple[int, int, int, float, float]] = []
    for first, last, family, p, share in found:
        if out and out[-1][2] == family and first <= out[-1][1] + 1 and paragraph[first] == paragraph[out[-1][1]]:
            a, z, _, q, other = out.pop()
            first, last, p, share = a, max(z, last), max(p, q), max(share, other)
        out.append((first, last, family, p, share))
    return out


def scan(docs: DataFrame, model: LicenseModel, doc_id: str = "doc_id", text: str = "text",
         least: float = 0.5, overlap: float = 0.6) -> DataFrame:
    """Licence notices of every whole text.

    Returns one row per input row: doc_id, n_paragraphs (runs of consecutive lines with
    a word) and found, an array of (start, stop, family, probability, overlap), with
    character offsets in the text, in order; start and stop are those of the notice's
    pieces (a line, or a sentence or clause of one).  A window of pieces is found if its most
    probable class is a family with ``least`` or more, and ``overlap`` or more of the word
    pairs of one of that family's templates occur in it, each weighing one over the number of
    families whose notices have it; of windows that share these pairs the one with most
    of them and fewest words counts, and a whole paragraph counts where none of its
    windows does.  Notices of one family right behind each other in a paragraph are one, so a
    whole licence is found once a paragraph.  Null and empty texts have no paragraphs.
    Repeated rows repeat; null doc_ids stay null; other columns are not read.
    """
    id_type = docs.schema[doc_id].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("family", pa.string()),
                               ("probability", pa.float64()), ("overlap", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, hashes = shared.value, WordHashes()
        unknown = len(model.families) - 1
        templates = {model.families.index(f): Evidence(ts) for f, ts in TEMPLATES.items()}
        for b in slices(batches, "text"):
            texts = [x or "" for x in b.column("text").to_pylist()]
            parts = [pieces(x) for x in texts]
            owner = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
            begins = np.searchsorted(owner, np.arange(len(texts)))
            words = [tokens(x[a:z]) for x, p in zip(texts, parts) for a, z in p]
            some = np.array([len(w) > 0 for w in words])
            follows = np.r_[some[:-1] & some[1:] & (owner[:-1] == owner[1:]), False]
            paragraph = np.cumsum(some & ~np.r_[False, follows[:-1]])
            hits: dict[int, list[list[tuple[int, int, int, float]]]] = {}  # of each text: windows, whole paragraphs
            *windows, whole = [*model.windows(words, follows, hashes)] or [None]
            for k, group in enumerate((windows, [whole] if whole else [])):
                for first, last, logits in group:
                    named = np.flatnonzero(logits.argmax(axis=1) != unknown)
                    p = model.probabilities(logits[named])
                    for i, best, top in zip(named, p.argmax(axis=1), p.max(axis=1)):
                        if top >= least:
                            row = int(owner[first[i]])
                            zero = int(begins[row])
                            hits.setdefault(row, [[], []])[k].append(
                                (int(first[i]) - zero, int(last[i]) - zero, int(best), float(top)))
            found = [[] for _ in texts]
            for row, (narrow, wide) in hits.items():
                zero, cuts = int(begins[row]), parts[row]
                mine, belongs = words[zero:zero + len(cuts)], paragraph[zero:zero + len(cuts)]
                flat = [w for x in mine for w in x]
                stops = np.cumsum([len(x) for x in mine]).tolist()
                out = notices(narrow, flat, stops, templates, overlap)
                known = {belongs[first] for first, *_ in out}
                out += notices([h for h in wide if belongs[h[0]] not in known], flat, stops, templates, overlap)
                for first, last, family, p, share in joined(sorted(out), belongs):
                    found[row].append({"start": cuts[first][0], "stop": cuts[last][1],
                                       "family": model.families[family], "probability": p, "overlap": share})
            n = np.bincount(owner[some & ~np.r_[False, follows[:-1]]], minlength=len(texts))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n), pa.array(found, kind)],
                                             names=["doc_id", "n_paragraphs", "found"])

    return (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {id_type}, n_paragraphs long, found array<struct<start:bigint,stop:bigint,family:string,"
             "probability:double,overlap:double>>"))
