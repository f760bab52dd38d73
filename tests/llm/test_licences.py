"""Licence scans on wordings in and beyond the templates, and their decisions in plain Python."""

import math
import os

import pytest
import regex
import xxhash

from tickflow.llm import licenses

SF = "/root/testdata/sf0.001"
PLAIN = [f"plain text number {i} about rivers and hills and work that is done under the sun" for i in range(80)]
LINES = {
    "MIT License": ["mit"],
    "SPDX-License-Identifier: MIT": ["mit"],
    "// SPDX-License-Identifier: GPL-3.0-or-later": ["gpl-3.0"],
    "License: GPL-3.0-or-later": ["gpl-3.0"],
    "Distributed under the Boost Software License, Version 1.0. (See accompanying file)": ["boost-1.0"],
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING': ["mit"],
    "Dual licensed under the MIT license and the Apache License, Version 2.0.": ["apache-2.0", "mit"],
    "all rights reserved seats were sold": [],
    "Copyright 2021 Some Company. All rights reserved.": ["proprietary"],
    "Copyright 2021 Some Company. All rights reserved": ["proprietary"],
    "The licence plates under the bridge were permitted to any person": [],
    "we walked with the permission of the public and the work was free": [],
    "This module is licensed under the MIT License; see LICENSE for details.": ["mit"],
    "It may be distributed under the terms of the GNU Lesser General Public License as well.": ["lgpl"],
    "The data set is licensed under CC BY-SA 4.0 by its authors": ["cc-by-sa"],
    "Unauthorized copying of this file, via any medium is strictly prohibited, says the header": ["proprietary"],
    "this work is dedicated: CC0 1.0 Universal": ["cc0"],
}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, t) for i, t in enumerate(PLAIN)]
    return licenses.train(spark.createDataFrame(rows, "doc_id long, text string"), background_rows=60)


def test_lines_get_all_their_families_and_others_none(spark, model):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*LINES, *PLAIN])], "doc_id long, text string")
    got = {r.paragraph: r.licences for r in licenses.scanned(docs, model=model).collect()}
    assert {t: sorted(got[t]) for t in LINES if LINES[t]} == {t: f for t, f in LINES.items() if f}
    assert all(set(got[t]) <= {licenses.UNKNOWN} for t, f in LINES.items() if not f)
    assert not any(got[t] for t in PLAIN)


def test_every_template_gets_its_family_in_other_text(spark, model):
    rows = [(f, t) for f in licenses.FAMILIES for t in licenses.TEMPLATES[f]]
    docs = spark.createDataFrame([(i, f"Note 7 of the file: {t}") for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.licences for r in licenses.licence_report(docs, model=model).collect()}
    assert all(f in got[i] for i, (f, _) in enumerate(rows))
    wrong = sum(len(set(got[i]) - {f}) for i, (f, _) in enumerate(rows))
    assert wrong <= 0.05 * len(rows)


def test_words_of_notices_in_other_orders_are_none(spark, model):
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(licenses._other_orders())], "doc_id long, text string")
    got = licenses.licence_report(docs, model=model).collect()
    named = sum(bool(set(r.licences) - {licenses.UNKNOWN}) for r in got)
    assert named <= 0.01 * len(got) + 1
    assert 0.5 <= model.threshold < 1


_TOKEN = regex.compile(r"[\p{L}\p{N}.\-]*[\p{L}\p{N}]|\.(?=[ \t\n\x0b\f\r]|$)")


def _signed(h):
    return h - (1 << 64) if h >> 63 else h


def _features(line):
    tokens = [*_TOKEN.findall(line.lower().translate(str.maketrans("!?;:", "...."))), "."]
    raw = [xxhash.xxh64_intdigest(t.encode(), 42).to_bytes(8, "little") for t in tokens]
    pairs = [xxhash.xxh64_intdigest(b, xxhash.xxh64_intdigest(a, 42)) for a, b in zip(raw, raw[1:])]
    return [_signed(int.from_bytes(r, "little")) for r in raw], [_signed(p) for p in pairs]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_lines_of_a_table_alone_equal_plain_python(spark):
    """Lines with an empty line around them, so that none is joined to another."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model, pairs = licenses.train(docs), licenses.template_pairs(spark)
    lines = sorted({x for r in docs.collect() for x in r.text.split("\n")} | set(LINES))

    def families(line):
        words, held = _features(line)
        numbers = {n for h in words + held for n in [model.features.buckets[h % licenses.BUCKETS]] if n >= 0 and model.features.hashes[n] == h}
        scores = [b + sum(round(w[n], 6) for n in numbers) for w, b in zip(model.weights, model.intercepts)]
        odds = [1 / (1 + math.exp(scores[-1] - s)) for s in scores[:-1]]
        likely = [(f, o) for f, o in zip(licenses.FAMILIES, odds) if o > 0.5]
        sure = [f for f, o in likely if o >= model.threshold and any(
            len(set(known) & set(held)) / len(known) >= licenses.CONTAINMENT for known in pairs[f])]
        return sure or ([licenses.UNKNOWN] if likely else [])
    table = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "doc_id long, text string").repartition(4)
    got = {r.row.doc_id: r.licences for r in licenses.scanned(table, model=model).collect()}
    assert {i: got[i] for i in got} == {i: families(t) for i, t in enumerate(lines)}
    assert sum(bool(f) for f in got.values()) > len(LINES) / 2
