"""Licence scans: a trained paragraph classifier, confirmed by comparison with templates.

Paragraphs are lines. Features are single words and pairs of neighbours in
lower case, hashed; the end of a sentence or line is a word, too. Only features
that occur in a template carry weight, so the model is sparse. A multinomial
logistic regression over the licence families and the class of no licence is
trained here, on the templates with other words around them, on two templates
in a row, on parts of templates, on their words in other orders, and on at most
`background_rows` paragraphs of the corpus (picked by least hashes; a documented
bound of the sample) that have little in common with any template. All features
of a picked paragraph count, however long it is. The threshold of the unknown
class is calibrated on paragraphs held out of the training: it is the least odds
at which at most one in a hundred held-out paragraphs of no licence would be
named a licence. A quarter of the background and words of templates in orders
that are not used in training are held out.

Every paragraph of every document is classified, into any number of families:
all whose odds against no licence are even or better. Such a family is
confirmed if these odds reach the threshold and the paragraph holds
`containment` of the word pairs of one of the family's templates. A paragraph
that the model takes for a licence, but of which no family is confirmed, is
`unknown`.

Notices that are wrapped run over several lines. So each line that holds a word
pair of a template, or meets its neighbour in one, is also joined to the lines
after it, one by one, up to a line without a word or until the lines after it
have half as many words again as the longest template. Joined lines are classified and confirmed like one
paragraph. If they are confirmed, those of them that are not confirmed alone
and hold pairs of that family's templates are of the family, too: all that are
`unknown` alone, and of the rest those where the pairs are half as many as the
words or more.

Everything on the path of the corpus is a column expression; the model is a few
arrays of constants, whose size is bounded by the templates. There is no
shuffle but for the sum per document.

Defined cases: a null text has no paragraphs; of a long paragraph every word and
pair counts; paragraphs without a word are
not counted; rows that agree in doc_id and text are judged alike and stay
separate rows; an empty table gives no rows.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.llm.helpers import let, saved

BUCKETS = 1 << 16
BACKGROUND_ROWS = 4000
CONTAINMENT = 0.8
UNKNOWN = "unknown"
NONE = "none"
REACH = 1.5  # words of following lines that a line is joined to, by the words of the longest template
END = "."
_TOKEN = r"[\p{L}\p{N}.\-]*[\p{L}\p{N}]|\.(?=\s|$)"
_ORDERS = 10  # of each template's words, held out of the training

# Customary notices, names and identifiers of each licence family. Where one ends in a full stop, a
# sentence or line has to end there.
TEMPLATES = {
    "agpl-3.0": [
        "GNU Affero General Public License",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
        "License: AGPL-3.0.",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License",
        "the Apache License, Version 2.0",
        "Apache License 2.0",
        "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
        "SPDX-License-Identifier: Apache-2.0",
        "License: Apache-2.0.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products",
        "This software is provided by the copyright holders and contributors as is and any express or implied warranties",
        "licensed under the BSD license",
        "BSD 2-Clause License.",
        "BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-2-Clause",
        "SPDX-License-Identifier: BSD-3-Clause",
        "License: BSD-3-Clause.",
    ],
    "boost-1.0": [
        "Distributed under the Boost Software License, Version 1.0",
        "Boost Software License 1.0",
        "SPDX-License-Identifier: BSL-1.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "Creative Commons Attribution 4.0 International",
        "SPDX-License-Identifier: CC-BY-4.0",
        "License: CC BY 4.0.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
        "License: CC BY-NC 4.0.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
        "License: CC BY-SA 4.0.",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
        "CC0 1.0 Universal",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "gpl-2.0": [
        "GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "License: GPL-2.0.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "GNU General Public License, version 3",
        "GNU General Public License v3.0",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "License: GPL-3.0.",
        "License: GPL-3.0-only.",
        "License: GPL-3.0-or-later.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "ISC License.",
        "SPDX-License-Identifier: ISC",
    ],
    "lgpl": [
        "GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "mit": [
        "Released under the MIT License",
        "licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        "The software is provided as is, without warranty of any kind, express or implied",
        "MIT License.",
        "SPDX-License-Identifier: MIT",
        "License: MIT.",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Mozilla Public License, Version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
        "License: MPL-2.0.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Proprietary and confidential.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain",
        "SPDX-License-Identifier: Unlicense",
    ],
}
FAMILIES = sorted(TEMPLATES)


@dataclass(frozen=True)
class Features:
    """Hashes of the words and pairs with weight, by number, and how they are found."""

    hashes: list[int]
    buckets: list[int]  # bucket of a hash to its number, -1 for most

    @classmethod
    def of(cls, hashes: list[int]) -> "Features":
        """One feature for each bucket; of those that share one, the first."""
        by_bucket = {}
        for h in sorted(hashes):
            by_bucket.setdefault(h % BUCKETS, h)
        buckets = [-1] * BUCKETS
        for number, bucket in enumerate(by_bucket):
            buckets[bucket] = number
        return cls(list(by_bucket.values()), buckets)


@dataclass(frozen=True)
class Model:
    """Weights by feature number for each class (families in order, then none), and what predicts the unknown class."""

    features: Features
    weights: list[list[float]]
    intercepts: list[float]
    threshold: float


def _tokens(text: Column) -> Column:
    """Words and ends of sentences, and the end of the line."""
    return F.concat(F.regexp_extract_all(F.translate(F.lower(text), "!?;:", "...."), F.lit(_TOKEN), F.lit(0)), F.array(F.lit(END)))


def _word_count(tokens: Column) -> Column:
    return F.size(F.filter(tokens, lambda t: t != END))


def _hashes(tokens: Column) -> Column:
    """Hashes of the words, then of the pairs."""
    return let(F.transform(tokens, lambda t: F.xxhash64(t)), lambda h: F.concat(h, _pairs(h)))


def _pairs(hashes: Column) -> Column:
    return F.transform(F.slice(hashes, 1, F.greatest(F.size(hashes) - 1, F.lit(0))), lambda t, i: F.xxhash64(t, F.get(hashes, i + 1)))


def _bucket(hash_: Column) -> Column:
    return F.pmod(hash_, F.lit(BUCKETS)).cast("int")


def _constants(values: list, kind: str) -> Column:
    """An array of numbers, folded to one constant when the query is planned."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _near(hashes: Column, features: Features) -> Column:
    """Those of the hashes whose bucket has a feature: a few, among them all that are features."""
    return F.filter(hashes, lambda h: F.get(_constants(features.buckets, "int"), _bucket(h)) >= 0)


def _weighted(near: Column, features: Features) -> Column:
    """Those of near hashes that are features."""
    def number(h: Column) -> Column:
        return F.get(_constants(features.buckets, "int"), _bucket(h))
    return F.filter(near, lambda h: F.get(_constants(features.hashes, "bigint"), number(h)) == h)


def _numbered(near: Column, features: Features) -> Column:
    """Numbers of the features among near hashes, each once."""
    return F.array_distinct(F.transform(_weighted(near, features), lambda h: F.get(_constants(features.buckets, "int"), _bucket(h))))


def _feature_numbers(text: Column, features: Features) -> Column:
    """Numbers of the features that a paragraph has, each once."""
    return let(_near(_hashes(_tokens(text)), features), lambda near: _numbered(near, features))


def _containment(held: Column, family: Column, pairs: dict[str, list[list[int]]]) -> Column:
    """Largest share of a template's word pairs that are among those held, over the templates of its family."""
    return F.greatest(F.lit(0.0), *(
        F.when(family == name, F.size(F.array_intersect(held, _constants(known, "bigint"))) / len(known)).otherwise(0.0)
        for name, templates in pairs.items() for known in templates))


def template_pairs(spark: SparkSession) -> dict[str, list[list[int]]]:
    """Hashes of the distinct word pairs of each template."""
    rows = [(f, i, t) for f in FAMILIES for i, t in enumerate(TEMPLATES[f])]
    table = spark.createDataFrame(rows, "family string, number int, text string")
    tokens = let(_tokens(F.col("text")), lambda t: F.slice(t, 1, F.size(t) - 1))  # the end of the line is not a part
    hashed = table.select("family", "number", F.array_distinct(
        let(F.transform(tokens, lambda t: F.xxhash64(t)), _pairs)).alias("pairs")).collect()
    out: dict[str, list[list[int]]] = {f: [] for f in FAMILIES}
    for row in sorted(hashed, key=lambda r: (r["family"], r["number"])):
        out[row["family"]].append(row["pairs"])
    return out


def _lines(text: Column, features: Features, known: Column) -> Column:
    """An array of structs, one for each line: its text, words, feature numbers and template pairs; and with its neighbours.

    `links` are the template pairs with those that reach over to the lines
    before and after, `across` the feature numbers of the latter.
    """
    def in_templates(near: Column) -> Column:
        # Most lines have no such pair, and are not compared with the list of all.
        return F.when(F.size(near) > 0, F.array_intersect(near, known)).otherwise(near)

    def line(x: Column) -> Column:
        return let(_tokens(x), lambda t: let(F.struct(F.transform(t, lambda w: F.xxhash64(w)).alias("h"), _word_count(t).alias("n")), hashed_line(x)))

    def hashed_line(x: Column):
        near = lambda l: F.struct(_near(l["h"], features).alias("words"), _near(_pairs(l["h"]), features).alias("pairs"))
        return lambda l: let(near(l), lambda k: F.struct(
            x.alias("text"), l["n"].alias("n"), F.when(l["n"] > 0, F.get(l["h"], F.lit(0))).alias("head"),
            F.get(l["h"], F.size(l["h"]) - 2).alias("tail"),
            _numbered(F.concat(k["words"], k["pairs"]), features).alias("numbers"), in_templates(k["pairs"]).alias("held")))

    def linked(all_lines: Column, x: Column, i: Column) -> Column:
        def pair(left: Column, right: Column) -> Column:
            return F.when(left.isNotNull() & right.isNotNull(), F.xxhash64(left, right))
        edges = F.array(pair(F.get(all_lines, i - 1)["tail"], x["head"]), pair(x["tail"], F.get(all_lines, i + 1)["head"]))
        return let(let(_near(F.filter(edges, lambda h: h.isNotNull()), features), in_templates), lambda e: F.struct(
            x["text"].alias("text"), x["n"].alias("n"), x["numbers"].alias("numbers"), x["held"].alias("held"),
            F.array_union(x["held"], e).alias("links"), _numbered(e, features).alias("across")))
    return let(F.transform(F.split(text, "\n"), line), lambda all_lines: F.transform(all_lines, lambda x, i: linked(all_lines, x, i)))


def _background(docs: DataFrame, text: str, features: Features, rows: int) -> list:
    """At most so many paragraphs that have little in common with any template: feature numbers, and some words.

    The least hash of each of four times as many classes of hashes is picked
    first, a few numbers from each task; only the picked paragraphs are taken
    apart, each as a whole.
    """
    lines = docs.select(F.explode(F.split(F.col(text), "\n")).alias("text"))
    hashed = lines.select(F.xxhash64("text").alias("h"))
    picked = hashed.groupBy(F.pmod("h", F.lit(4 * rows))).agg(F.min("h").alias("h")).select("h")
    texts = lines.join(F.broadcast(picked), F.xxhash64("text") == F.col("h")).groupBy("h").agg(F.min("text").alias("text"))
    parts = texts.select("h", _tokens(F.col("text")).alias("tokens"), _feature_numbers(F.col("text"), features).alias("numbers"),
                         F.array_distinct(_weighted(_near(_pairs_of(F.col("text")), features), features)).alias("held"))
    # A notice shares most of its features with a template; other text shares few.
    plain = parts.filter(F.size("numbers") <= 0.5 * F.size("tokens"))
    around = F.slice(F.filter("tokens", lambda t: t != END), 1, 12)
    return plain.select("h", "numbers", "held", around.alias("words")).orderBy("h").limit(rows).collect()


def _examples(spark: SparkSession, background: list, features: Features) -> DataFrame:
    """(numbers, label): templates alone, between other words, and halves of long ones as licences of their family; the rest none."""
    rows = []
    around = [b.words for b in background if len(b.words) == 12] or [["other", "words"] * 8]
    for label, family in enumerate(FAMILIES):
        for template in TEMPLATES[family]:
            words = template.split()
            for i in range(40):
                other = around[(7 * i + label) % len(around)]
                rows.append((" ".join([*other[:i % 6], *words, *other[6:6 + i % 5]]), float(label)))
            if len(words) > 12:
                rows += [(" ".join(words[i:i + len(words) // 2]), float(label)) for i in range(len(words) // 2)]
            # A line may name two licences.
            for i in range(1, 4):
                second = FAMILIES[(label + 3 * i) % len(FAMILIES)]
                both = [template, TEMPLATES[second][i % len(TEMPLATES[second])]]
                rows += [(" and ".join(pair), float(k)) for pair in (both, both[::-1]) for k in (label, FAMILIES.index(second))]
            # The same words in another order are no licence.
            rows += [(" ".join(order), float(len(FAMILIES))) for order in (words[::-1], words[::2] + words[1::2], sorted(words))]
    made = spark.createDataFrame(rows, "text string, label double").select(_feature_numbers(F.col("text"), features).alias("numbers"), "label")
    return made.unionByName(spark.createDataFrame([(b.numbers, float(len(FAMILIES))) for b in background], "numbers array<int>, label double"))


def train(docs: DataFrame, text: str = "text", background_rows: int = BACKGROUND_ROWS) -> Model:
    spark = docs.sparkSession
    table = spark.createDataFrame([(t,) for f in FAMILIES for t in TEMPLATES[f]], "text string")
    features = Features.of([r[0] for r in table.select(F.explode(_hashes(_tokens(F.col("text")))).alias("h")).distinct().collect()])
    background = _background(docs, text, features, background_rows)
    held_out, used = background[::4], [b for i, b in enumerate(background) if i % 4]
    examples = _examples(spark, used, features)
    dense = F.transform(F.sequence(F.lit(0), F.lit(len(features.hashes) - 1)), lambda i: F.array_contains("numbers", i).cast("double"))
    examples = saved(examples.coalesce(2).select("label", array_to_vector(dense).alias("features")))
    fitted = LogisticRegression(family="multinomial", regParam=0.002, maxIter=60).fit(examples)
    weights = [[float(x) for x in row] for row in fitted.coefficientMatrix.toArray()]
    model = Model(features, weights, [float(x) for x in fitted.interceptVector], 0.0)
    mixed = [(" ".join(shuffled),) for shuffled in _other_orders()]
    apart = spark.createDataFrame(mixed, "text string").select(
        _feature_numbers(F.col("text"), features).alias("numbers"), _pairs_of(F.col("text")).alias("held")).unionByName(
        spark.createDataFrame([(b.numbers, b.held) for b in held_out], "numbers array<int>, held array<long>"))
    pairs = template_pairs(spark)
    named = F.filter(_prediction(F.col("numbers"), model), lambda p: _containment(F.col("held"), p["family"], pairs) >= CONTAINMENT)
    odds = apart.select(F.array_max(F.transform(named, lambda p: p["odds"])).alias("odds"))
    worst = [r[0] for r in odds.orderBy(F.desc_nulls_last("odds")).limit((len(mixed) + len(held_out)) // 100 + 1).collect()]
    return Model(features, weights, model.intercepts, max(0.5, worst[-1] or 0.5))


def _pairs_of(text: Column) -> Column:
    return let(F.transform(_tokens(text), lambda t: F.xxhash64(t)), _pairs)


def _other_orders() -> list[list[str]]:
    """Words of templates in orders that the training has not, as held-out text of no licence."""
    dice, out = random.Random(1), []
    for template in (t for family in FAMILIES for t in TEMPLATES[family]):
        words = template.split()
        if len(words) > 4:
            out += [dice.sample(words, len(words)) for _ in range(_ORDERS)]
    return out


def _prediction(features: Column, model: Model) -> Column:
    """Array of structs, from feature numbers: the families that beat no licence, and their odds against it as a probability."""
    def score(features: Column, k: int) -> Column:
        weights = _constants([f"{w:.6f}" for w in model.weights[k]], "double")
        return F.aggregate(features, F.lit(model.intercepts[k]), lambda total, n: total + F.get(weights, n))

    def choose(scores: Column) -> Column:
        none = F.get(scores, len(FAMILIES))
        odds = F.transform(F.array(*map(F.lit, FAMILIES)), lambda name, k: F.struct(
            name.alias("family"), (1 / (1 + F.exp(none - F.get(scores, k)))).alias("odds")))
        return F.filter(odds, lambda p: p["odds"] > 0.5)
    classes = range(len(FAMILIES) + 1)
    return let(features, lambda f: let(F.array(*(score(f, k) for k in classes)), choose))


def _joined(lines: Column, at: Column, reach: int, family_of) -> Column:
    """The families that the line at a place has when it is joined to lines after it (null for none), and how many lines that are."""
    first = F.get(lines, at)
    start = F.struct(F.array_union(first["numbers"], first["across"]).alias("numbers"), first["links"].alias("links"),
                     F.lit(0).alias("words"), F.lit(1).alias("lines"), F.lit(True).alias("open"), F.lit(None).cast("array<string>").alias("family"))

    def add(s: Column, y: Column) -> Column:
        longer = F.struct(F.array_union(s["numbers"], F.array_union(y["numbers"], y["across"])).alias("numbers"),
                          F.array_union(s["links"], y["links"]).alias("links"))
        grown = let(longer, lambda g: F.struct(
            g["numbers"].alias("numbers"), g["links"].alias("links"), (s["words"] + y["n"]).alias("words"), (s["lines"] + 1).alias("lines"),
            F.lit(True).alias("open"), F.coalesce(s["family"], family_of(g["numbers"], g["links"])).alias("family")))
        closed = F.struct(s["numbers"].alias("numbers"), s["links"].alias("links"), s["words"].alias("words"), s["lines"].alias("lines"),
                          F.lit(False).alias("open"), s["family"].alias("family"))
        return F.when(~s["open"], s).when((y["n"] == 0) | (s["words"] >= reach), closed).otherwise(grown)
    # Each line that is joined has a word, so there are `reach` of them at most.
    grown = F.aggregate(F.slice(lines, at + 2, reach), start, add)
    return F.when(F.size(first["links"]) > 0, let(grown, lambda s: F.struct(s["family"].alias("family"), s["lines"].alias("lines"))))


def _licences(lines: Column, model: Model, pairs: dict[str, list[list[int]]], reach: int, containment: float) -> Column:
    """An array of structs, one for each line: text and licences."""
    def confirmed(predicted: Column, held: Column) -> Column:
        sure = F.filter(predicted, lambda p: (p["odds"] >= model.threshold) & (_containment(held, p["family"], pairs) >= containment))
        return F.transform(sure, lambda p: p["family"])

    def alone(x: Column) -> Column:
        return let(_prediction(x["numbers"], model), lambda p: F.when(F.size(p) == 0, F.array().cast("array<string>")).otherwise(
            let(confirmed(p, x["held"]), lambda names: F.when(F.size(names) > 0, names).otherwise(F.array(F.lit(UNKNOWN))))))

    def together(numbers: Column, held: Column) -> Column:
        # The model is asked only where some template is there.
        there = F.lit(False)
        for known in (known for templates in pairs.values() for known in templates):
            there = there | (F.size(F.array_intersect(held, _constants(known, "bigint"))) >= containment * len(known))
        return F.when((F.size(held) > 1) & there, let(
            let(_prediction(numbers, model), lambda p: confirmed(p, held)), lambda names: F.when(F.size(names) > 0, names)))

    def shared(x: Column, family: Column) -> Column:
        """Number of the line's pairs that are in templates of the family."""
        counts = F.lit(0)
        for name, templates in pairs.items():
            known = sorted({pair for template in templates for pair in template})
            counts = F.when(family == name, F.size(F.array_intersect(x["links"], _constants(known, "bigint")))).otherwise(counts)
        return counts

    def whole(of: Column, joined: Column) -> Column:
        def licences(x: Column, i: Column) -> Column:
            near = F.greatest(i - reach, F.lit(0))
            reaching = F.filter(F.transform(F.slice(joined, near + 1, i - near + 1), lambda j, k: F.when(
                j["lines"] > i - near - k, j["family"])), lambda family: family.isNotNull())
            unknown = F.array_contains(x["alone"], UNKNOWN)
            # The nearest start counts first.
            part = F.filter(F.flatten(F.reverse(reaching)), lambda family: let(
                shared(x, family), lambda n: (n > 0) & (unknown | (2 * n >= x["n"]))))
            known_alone = (F.size(x["alone"]) > 0) & ~unknown
            return F.when((F.size(x["links"]) == 0) | known_alone, x["alone"]).otherwise(
                let(part, lambda names: F.when(F.size(names) > 0, F.slice(names, 1, 1)).otherwise(x["alone"])))
        return F.transform(of, lambda x, i: F.struct(x["text"].alias("text"), licences(x, i).alias("licences")))

    def judged(all_lines: Column) -> Column:
        single = F.transform(all_lines, lambda x: F.struct(
            x["text"].alias("text"), x["n"].alias("n"), x["links"].alias("links"), alone(x).alias("alone")))
        joined = F.transform(all_lines, lambda x, i: _joined(all_lines, i, reach, together))
        return let(F.struct(single.alias("single"), joined.alias("joined")), lambda s: whole(s["single"], s["joined"]))
    return let(lines, judged)


def scanned(docs: DataFrame, text: str = "text", model: Model | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """(row, paragraph, licence, licences): the families of every line, or `unknown`, and the first of them (null for none);
    a document without lines has one null paragraph."""
    model = model or train(docs, text)
    pairs = template_pairs(docs.sparkSession)
    known = _constants(sorted({pair for templates in pairs.values() for template in templates for pair in template}), "bigint")
    reach = int(REACH * max(len(template) + 1 for templates in pairs.values() for template in templates))
    lines = _lines(F.col(text), model.features, known)
    judged = docs.select(F.struct("*").alias("row"), F.explode_outer(_licences(lines, model, pairs, reach, containment)).alias("of"))
    return judged.select("row", F.col("of.text").alias("paragraph"), F.get("of.licences", F.lit(0)).alias("licence"), "of.licences")


def licence_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: Model | None = None,
                   background_rows: int = BACKGROUND_ROWS, containment: float = CONTAINMENT) -> DataFrame:
    """One row per document: doc_id, n_paragraphs, n_licence, licences (sorted families, `unknown` among them)."""
    numbered = docs.select(F.monotonically_increasing_id().alias("id"), F.col(doc_id).alias("doc_id"), F.col(text).alias(text))
    judged = scanned(numbered, text, model or train(docs, text, background_rows), containment)
    per = judged.groupBy("row.id", "row.doc_id").agg(
        F.count_if(F.col("paragraph").rlike(r"[\p{L}\p{N}]")).alias("n_paragraphs"), F.count("licence").alias("n_licence"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("licences")))).alias("licences"))
    return per.select("doc_id", "n_paragraphs", "n_licence", "licences")
