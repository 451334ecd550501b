"""Licence scan: everyday notices, other licences, whole licences, and the scan against plain Python."""

from __future__ import annotations

import numpy as np
import pytest
import regex

from ipscope.llm import licenses
from ipscope.llm.common import table
from ipscope.llm.licence_texts import TEXTS, clauses
from helpers import words

SF = "/root/testdata/sf0.01"

# Notices looked at while the operator was built.
NOTICES = [
    ("Licensed under the Apache License 2.0", "Apache-2.0"),
    ("This data is distributed under CC-BY 4.0", "CC-BY"),
    ("// SPDX-License-Identifier: MIT", "MIT"),
    ("MIT License. Copyright (c) 2021 Jane Roe", "MIT"),
    ("          GNU GENERAL PUBLIC LICENSE\n           Version 3, 29 June 2007", "GPL"),
    ("ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED\nWARRANTIES OF MERCHANTABILITY AND FITNESS "
     "FOR A PARTICULAR PURPOSE ARE\nDISCLAIMED. IN NO EVENT SHALL THE REGENTS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL", "BSD"),
    ("Use of this source code is governed by a BSD-style\nlicense that can be found in the LICENSE file.", "BSD"),
    ("If a copy of the MPL was not distributed with this file,\nYou can obtain one at http://mozilla.org/MPL/2.0/.", "MPL"),
    ("To the extent possible under law, Jane Roe has waived all copyright and related or neighboring rights to this work.", "CC0"),
    ("Dual licensed: GPLv2 or later.", "GPL"), ("AGPLv3 licensed; see COPYING", "AGPL"),
    ("You can use, copy and change this under the MIT licence", "MIT"),
    ("All content here is CC BY-SA 4.0 unless otherwise noted.", "CC-BY-SA"),
]
# Written after the lists were finished; nothing was changed for them: 16 of these 18 are found.
LATER = [
    ("Our parser is open source under the Apache 2.0 license.", "Apache-2.0"),
    ("Source code: MIT license, see LICENSE.txt", "MIT"),
    ("This module may be redistributed under the GNU General Public License as found in the file COPYING.", "GPL"),
    ("Contributions are accepted under the BSD 3-Clause License only", "BSD"),
    ("Figures are shared under a Creative Commons Attribution 4.0 International License by the authors.", "CC-BY"),
    ("Except where noted, text is CC BY-NC 4.0.", "CC-BY-NC"),
    ("The dataset is in the public domain (CC0 1.0).", "CC0"),
    ("# SPDX-License-Identifier: LGPL-2.1-or-later", "LGPL"),
    ("/* SPDX-License-Identifier: BSD-2-Clause */", "BSD"),
    ("Firefox code is under the Mozilla Public License 2.0", "MPL"),
    ("I put this snippet under the ISC license, have fun", "ISC"),
    ("The library is LGPL licensed and can be linked freely", "LGPL"),
    ("Server parts: GNU Affero General Public License, client parts: ask us", "AGPL"),
    ("Anyone is free to copy, modify, publish, use, compile, sell,\nor distribute this software", "Unlicense"),
    ("Wikipedia text is available under the Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA"),
    ("(c) 2019 Example Press. All rights reserved worldwide.", "Proprietary"),
    ("You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0", "Apache-2.0"),
    ("the above copyright notice and this permission notice shall be included in all\ncopies of the Software.", "MIT"),
]
NONE = [
    "This software is provided 'as-is', without any express or implied warranty.", "Distributed under the Boost Software License, Version 1.0.",
    "SPDX-License-Identifier: BSL-1.0", "Eclipse Public License - v 2.0", "He renewed his driving licence under the new rules.",
    "The general public was not admitted to the gallery; a license was needed.", "a permission notice shall be posted on the door",
    "MIT is a university in Cambridge", "The Apache tribe was licensed to hunt", "the software was distributed on floppy disks",
    "CC me on the mail by 4 o'clock", "All the rights of the heirs were reserved for later", "the public domain of the king",
    "The council granted a licence to the publican", "version 2.0 of the contract was signed by the foundation",
    "freely distributed leaflets told of the commons", "the attribution of the painting is international news",
]


@pytest.fixture(scope="module")
def model(spark):
    return licenses.fit(table(spark, SF, "documents"))


def scanned(spark, model, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.found for r in sorted(licenses.scan(frame, model).collect())]


def test_everyday_notices(spark, model):
    got = scanned(spark, model, [t for t, _ in NOTICES])
    assert [(t, [x.family for x in g]) for (t, _), g in zip(NOTICES, got)] == [(t, [f]) for t, f in NOTICES]


def test_notices_written_later_and_sentences_without_one(spark, model):
    got = scanned(spark, model, [t for t, _ in LATER] + NONE)
    right = [[x.family for x in g] == [f] for (_, f), g in zip(LATER, got)]
    wrong = [t for t, g in zip(NONE, got[len(LATER):]) if g]
    assert sum(right) >= 16, [(n, g) for n, g, ok in zip(LATER, got, right) if not ok]
    named = sum(len(g) for g in got)
    assert sum(right) / max(1, named) >= 0.9, wrong


def test_whole_licences_and_notices_within_a_line(spark, model):
    mit, bsd = TEXTS["MIT"], TEXTS["BSD"]
    one_line = words(200, 1) + ". Licensed under the MIT license. " + words(200, 2)
    got = scanned(spark, model, [words(40, 3) + "\n\n" + mit + "\n\n" + words(40, 4), bsd.replace("\n\n", "\n"), one_line])
    assert {x.family for x in got[0]} == {"MIT"} and len(got[0]) == 3  # once a paragraph
    assert [x.family for x in got[1]] == ["BSD"] and (got[1][0].start, got[1][0].stop) == (0, len(bsd.replace("\n\n", "\n")))
    assert [(x.family, one_line[x.start:x.stop]) for x in got[2]] == [("MIT", "Licensed under the MIT license.")]


def test_clauses_hold_all_words_of_long_sentences():
    text = "one two three four five six. short one.\n\n" + " ".join(f"w{i}" for i in range(70))
    assert clauses(text)[0] == "one two three four five six."
    assert " ".join(clauses(text)[1:]).split() == [f"w{i}" for i in range(70)]
    assert all(len(c.split()) <= 32 for c in clauses(text))


def plain_scan(text, model, least=0.5, overlap=0.6):
    """The scan of one text by loops over every window."""
    cut = [0]
    for m in regex.finditer(r"\n|(?<=[\p{L}\p{N}]{2}[.!?;:])[ \t]+(?=[\p{L}\p{N}])", text):
        cut += [m.start(), m.end()]
    cut.append(len(text))
    parts = [(cut[i], cut[i + 1]) for i in range(0, len(cut), 2)]
    toks = [licenses.tokens(text[a:z]) for a, z in parts]
    runs, run = [], []
    for i, w in enumerate([*toks, []]):
        if w:
            run.append(i)
        elif run:
            runs.append(run)
            run = []
    hashes = licenses.WordHashes()

    def judge(first, last):
        ws = [w for i in range(first, last + 1) for w in toks[i]]
        bins, _, _ = licenses.grams([ws], hashes)
        logits = model.weights[bins].sum(axis=0, dtype=float) / np.sqrt(max(1, 2 * len(ws) - 1)) + model.bias
        e = np.exp((logits - logits.max()) / model.temperature)
        p = e / e.sum()
        return (first, last, int(p.argmax()), float(p.max())) if p.argmax() < len(p) - 1 and p.max() >= least else None

    places = [(i, k) for i in range(len(toks)) for k in range(len(toks[i]))]
    order = {pk: n for n, pk in enumerate(places)}
    flat = [toks[i][k] for i, k in places]

    def greedy(hits):
        used, out = set(), []
        while True:
            best = None
            for first, last, family, p in hits:
                a, z = order[first, 0], order[last, len(toks[last]) - 1]
                free = {n: (flat[n], flat[n + 1]) for n in range(a, z) if n not in used}
                seen = set(free.values())
                for j, t in enumerate(licenses.TEMPLATES[model.families[family]]):
                    weigh = licenses.PAIR_WEIGHTS
                    pairs = licenses.pairs(t)
                    own = {x for x in pairs if weigh[x] == 1.0}
                    weight = sum(weigh[x] for x in pairs & seen)
                    share = min(1.0, weight / sum(weigh[x] for x in pairs), len(own & seen) / len(own) if own else 1.0)
                    if share >= overlap:
                        rank = (-round(share, 9), z - a, first, last, family, p, -weight, j)
                        if best is None or rank < best[0]:
                            best = rank, share, {n for n, x in free.items() if x in pairs}
            if best is None:
                return out
            used |= best[2]
            out.append((*best[0][2:6], best[1]))

    narrow = [h for run in runs for i in run for j in run if i <= j
              and sum(len(toks[k]) for k in range(i + 1, j)) <= licenses.REACH for h in [judge(i, j)] if h]
    out = greedy(narrow)
    done = {k for k, run in enumerate(runs) for o in out if o[0] in run}
    out += greedy([h for k, run in enumerate(runs) if k not in done for h in [judge(run[0], run[-1])] if h])
    merged = []
    for first, last, family, p, share in sorted(out):
        if merged and merged[-1][2] == family and first <= merged[-1][1] + 1 and any(first in r and merged[-1][1] in r for r in runs):
            a, z, _, q, s = merged.pop()
            first, last, p, share = a, max(z, last), max(p, q), max(s, share)
        merged.append((first, last, family, p, share))
    return len(runs), [(parts[a][0], parts[z][1], model.families[f], round(p, 5), round(s, 5)) for a, z, f, p, s in merged]


def test_scan_equals_plain_python(spark, model):
    texts = [t for t, _ in NOTICES + LATER] + NONE + ["", "\n\n", ";; x. y\n;; z", "é" * 3000]
    texts += ["\n".join(t for t, _ in NOTICES[i:i + 3]) for i in range(0, 9, 3)] + [NOTICES[3][0] + "\n" + NOTICES[3][0]]
    texts += [r.text for r in table(spark, SF, "documents").orderBy("doc_id").limit(60).collect() if r.text and len(r.text) < 3000]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in licenses.scan(frame, model).collect():
        want = plain_scan(texts[r.doc_id], model)
        got = [(x.start, x.stop, x.family, round(x.probability, 5), round(x.overlap, 5)) for x in r.found]
        assert (r.n_paragraphs, [g[:3] for g in got]) == (want[0], [w[:3] for w in want[1]]), texts[r.doc_id]
        assert np.allclose([g[3:] for g in got], [w[3:] for w in want[1]], atol=1e-4)
