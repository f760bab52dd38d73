"""Each operator against brute force, an exact round trip, or held-out accuracy."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from tickflow.llm import (
    components, exact_dedup, licenses, line_runs, mixing, packing, quality, sharding, simhash, substrings, token_counts,
)
from tickflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
SPACE = re.compile("[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@needs_data
@pytest.mark.parametrize("name", ["op1_mix_sources", "op5_exact_dedup", "op8_substring_dedup"])
def test_query_equals_sql(spark, name):
    from tests.oracle_check import oracle_rows, spark_rows
    from tickflow.llm.oracle import ORACLE_SQL
    columns, expected = oracle_rows(SF, ORACLE_SQL[name])
    got_columns, got = spark_rows(QUERIES[name](spark, SF))
    assert sorted(columns) == sorted(got_columns)
    assert got == expected


@needs_data
def test_mix_comes_near_its_targets(docs):
    rows = mixing.mix_report(docs).collect()
    total = sum(r.size for r in rows)
    assert abs(sum({r.source: r.target for r in rows}.values()) - 1.5 * total) < 1e-6 * total
    longest, taken = Counter(), Counter()
    for r in rows:
        assert r.taken <= 2 * r.size
        longest[r.source] = max(longest[r.source], r.size)
        taken[r.source] += r.taken
    for r in rows:
        assert abs(taken[r.source] - r.target) <= longest[r.source] / 2 + 1


@needs_data
def test_shards_match_the_mixture(docs, texts):
    rows = sharding.shard_report(docs).collect()
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1 and set(counts) <= set(range(8))
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(n)) for s, n in counts.items())
    per = Counter((r.source, r.shard) for r in rows)
    for source, n in Counter(r.source for r in rows).items():
        assert all(abs(per[source, s] - n / 8) <= 2 for s in range(8))
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r["size"] == len(texts[r.doc_id].encode()) + 1 for r in rows)


@needs_data
def test_packing_is_a_round_trip(docs, texts):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.public_tokenizer())
    tokenizer.encode_special_tokens = True
    by_doc = {}
    for r in packing.packed(docs, keep_ids=True).collect():
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc_id, text in texts.items():
        pieces = sorted(by_doc[doc_id], key=lambda r: r.piece)
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [1]
        assert [i for p in pieces for i in p.ids] == ids
        assert all(p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes()) for p in pieces)
        assert all(p.length == 4096 for p in pieces[:-1])


def test_special_strings_in_words_are_ordinary_text(spark):
    one = spark.createDataFrame([(1, "a <|startoftext|> b<|endoftext|>c x")], "doc_id long, text string")
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.public_tokenizer())
    tokenizer.encode_special_tokens = True
    assert packing.packed(one, keep_ids=True).first().ids == tokenizer.encode(
        "a <|startoftext|> b<|endoftext|>c x", add_special_tokens=False).ids + [1]


def test_best_fit_closes_the_fullest():
    bins = packing.OpenSequences(10, 2)
    assert [bins.put(n) for n in (6, 7, 3, 9, 4)] == [(0, 0), (1, 0), (1, 7), (2, 0), (0, 6)]
    bins = packing.OpenSequences(10, 1)
    assert [bins.put(n) for n in (6, 5, 5)] == [(0, 0), (1, 0), (1, 5)]


def test_token_counts_equal_the_plain_recursion():
    counter = token_counts.UnigramCounts(token_counts.piece_scores(token_counts.public_pieces()))
    random.seed(5)
    some = list({"".join(random.choice("abcdetheinglouéß日\U0001F600<|.,") for _ in range(random.randint(1, 70))) for _ in range(1500)})
    some += ["the", "The", "a\0", "a", "a\0b"]
    assert [int(n) for n in counter.counts(some)] == [counter._one(token_counts.MARK + w) for w in some]


def test_token_counts_equal_the_library():
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece
    path = token_counts.public_pieces()
    model, scores = pb.ModelProto(), token_counts.piece_scores(path)
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1  # unigram
    for piece in model.pieces:
        piece.score = scores.get(piece.piece, piece.score)
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    some = ["the", "Internationalization", "éß", "日本語", "xqzzk", "\U0001F600a"]
    assert token_counts.UnigramCounts(scores).counts(some).tolist() == [len(library.encode(w)) for w in some]


@needs_data
def test_exact_dedup_with_colliding_hashes_and_small_blocks(docs, texts):
    from pyspark.sql import functions as F

    def weak(block, salt):
        return (F.pmod(F.crc32(block), F.lit(7)), F.lit(0)) if salt == 0 else exact_dedup.hashes(block, salt)
    expected = {}
    for doc_id, text in texts.items():
        expected.setdefault(text, []).append(doc_id)
    for r in exact_dedup.exact_duplicates(docs, block_bytes=64, hasher=weak).collect():
        same = expected[texts[r.doc_id]]
        assert (r.keep_id, r.group_size, r.kept) == (max(same), len(same), r.doc_id == max(same))
        assert r.text_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def _base(text):
    w = words(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if often[g] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


@needs_data
def test_base_rules_equal_brute_force(spark, docs, texts):
    odd = [(10_000 + i, t) for i, t in enumerate(["a a a a a", "a b c", "a b a b a b", "x\nx\n\n x\ny", "a b c d a b c", "| # é"])]
    both = docs.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    every = texts | dict(odd)
    for r in quality.quality_report(both, labels).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == _base(every[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)


@needs_data
def test_scores_tell_good_from_bad(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op6_quality_rules"](spark, sf).collect() if not r.base_failed and r.doc_id in labels]
    assert all(r.kept == (labels[r.doc_id] == 1) for r in rows)


def test_every_document_labelled_good_is_counted(spark):
    docs = spark.range(10_050).selectExpr("id as doc_id", "concat('w', id) as text")
    labels = docs.selectExpr("doc_id", "1 as quality", "0 as toxic")
    trusted = quality.trusted_ids(labels)
    assert trusted.count() == 10_050
    # All raw text is trusted.
    assert set(quality.log_ratios(docs, trusted)) == {0.0}


def test_without_labels_only_the_base_rules_decide(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(60))), (2, "short")], "doc_id long, text string")
    assert {r.doc_id: r.kept for r in quality.quality_report(one, none).collect()} == {1: True, 2: False}


def _fingerprint(text):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(w)
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@needs_data
@pytest.mark.parametrize("shard_rows", [4096, 3])
def test_simhash_equals_all_pairs(docs, texts, shard_rows):
    prints = {d: _fingerprint(t) for d, t in texts.items()}
    root = {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    for r in simhash.near_duplicates(docs, shard_rows=shard_rows).collect():
        assert r.fingerprint == f"{prints[r.doc_id]:016x}" and r.component_id == find(r.doc_id)


def test_crowded_shards_find_the_same_links(spark):
    random.seed(9)
    base = random.getrandbits(64)
    values = sorted({base ^ sum(1 << b for b in random.sample(range(12), random.randint(0, 4))) for _ in range(300)})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    got = components.components(simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), shard_rows=7))
    root = {v: v for v in signed} | {r.node: r.root for r in got.collect()}
    expected = {}
    for i, a in enumerate(values):
        expected[a] = {a}
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 2 and expected[a] is not expected[b]:
                merged = expected[a] | expected[b]
                for v in merged:
                    expected[v] = merged
    for v, s in zip(values, signed):
        assert root[s] == min(x - (1 << 64) if x >> 63 else x for x in expected[v])


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    assert {r.node: r.root for r in components.components(chain).collect()} == {**{i: 0 for i in range(1, 41)}, 101: 100}


@needs_data
@pytest.mark.parametrize("window,gram", [(13, 5), (4, 2)])
def test_substrings_equal_brute_force(spark, docs, texts, window, gram):
    first = {}
    for d, t in texts.items():
        w = words(t)
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, d), d)
    for r in substrings.parsed(docs, window=window, gram=gram).collect():
        w = words(texts[r.doc_id])
        gone = {i + j for i in range(len(w) - window + 1) if first[tuple(w[i:i + window])] < r.doc_id for j in range(window)}
        assert (r.n_words, r.n_removed) == (len(w), len(gone))
        assert r.kept_text == " ".join(x for i, x in enumerate(w) if i not in gone)
        assert {i for s in r.spans for i in range(s.start, s.start + s.length)} == gone


def _line_runs(rows, least):
    seqs = [(t.split("\n"), [i for i, x in enumerate(t.split("\n")) if words(x)]) for _, t in rows]
    found = {}
    for k, (lines, full) in enumerate(seqs):
        for a in range(len(full)):
            for b in range(a, len(full)):
                found.setdefault(tuple(lines[full[x]] for x in range(a, b + 1)), []).append((k, a, b))
    gone = {}
    for run, places in found.items():
        if sum(len(words(x)) for x in run) >= least:
            for k, a, b in sorted(places)[1:]:
                gone.setdefault(k, set()).update(seqs[k][1][a:b + 1])
    return ["\n".join(x for i, x in enumerate(lines) if i not in gone.get(k, ())) for k, (lines, _) in enumerate(seqs)]


@pytest.mark.parametrize("least", [1, 4, 10])
def test_line_runs_equal_brute_force(spark, least):
    random.seed(least)
    some = ["a b c", "d", "e f", "g h i j k l", "", "m n", "o p q r s t u v w x y z", "  ", "q"]
    rows = [(i, "\n".join(random.choice(some) for _ in range(random.randint(1, 12)))) for i in range(40)]
    got = line_runs.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), min_words=least)
    assert [r.text for r in got.orderBy("doc_id").collect()] == _line_runs(rows, least)


@needs_data
def test_no_later_copy_of_a_line_stays_on_the_tables(docs, texts):
    seen, expected, short = set(), {}, 0
    for doc_id in sorted(texts):
        left = []
        for line in texts[doc_id].split("\n"):
            again = bool(words(line)) and line in seen
            seen.add(line)
            short += again and len(words(line)) < 10
            if not again:
                left.append(line)
        expected[doc_id] = "\n".join(left)
    assert short > 0
    assert {r.doc_id: r.text for r in line_runs.deduplicated(docs).collect()} == expected


def test_licences_on_held_out_notices(spark):
    plain = [f"plain text number {i} about rivers and hills and work that is done under the sun" for i in range(80)]
    held_out = {
        "Portions are licensed under the Apache License, Version 2.0.": "apache-2.0",
        "Our code was released under the MIT License. Enjoy it with friends.": "mit",
        "Text: Licensed under CC BY-NC 4.0. See the site": "cc-by-nc",
        "Note: This work is licensed under the GNU General Public License, version 3. Thanks": "gpl-3.0",
        "We walked under the bridge and the work was licensed to nobody": None,
        "rivers and hills are reserved for all": None,
    }
    rows = [(i, t) for i, t in enumerate([*plain, *held_out])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.paragraph: r.licence for r in licenses.scanned(docs, model=licenses.train(docs, background_rows=60)).collect()}
    assert {t: got[t] for t in held_out if held_out[t]} == {t: f for t, f in held_out.items() if f}
    assert all(got[t] in (None, licenses.UNKNOWN) for t, f in held_out.items() if f is None)
    assert all(got[t] is None for t in plain)


WRAPPED = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights""",
    "bsd": """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions
# are met:""",
    "gpl-3.0": """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or""",
    "apache-2.0": """// Licensed under the Apache License,
// Version 2.0 (the "License"); you may not use
// this file except in compliance with the License.""",
    "cc-by": "This work is licensed under a Creative\nCommons Attribution 4.0\nInternational License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the\nMozilla Public License, v. 2.0. If a copy of the MPL was not",
}


def test_licences_of_wrapped_notices(spark):
    plain = [f"plain text number {i} about rivers and hills and work that is done under the sun" for i in range(80)]
    narrow = "\n".join(re.sub(r"((?:\S+\s+){2}\S+)\s+", r"\1\n", " ".join(WRAPPED["mit"].split()[:20])).split("\n"))
    reworded = {
        "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of\nthis software together with associated documentation files",
        "bsd": "Redistribution and use in source and binary forms, with or without changes,\nare permitted provided that the following conditions are met",
        "gpl-3.0": "The program is free software; you can redistribute it and/or modify it under\nthe terms of the GNU General Public License as published by the Free Software Foundation",
    }
    notices = [*WRAPPED.items(), ("mit", narrow), *reworded.items()]
    rows = [(i, t) for i, t in enumerate(plain)]
    rows += [(100 + i, f"{plain[i]}\n{t}\n{plain[i + 1]}") for i, (_, t) in enumerate(notices)]
    rows += [(200 + i, f"{plain[i]}\n\n{t}\n \n{plain[i + 1]}") for i, (_, t) in enumerate(notices)]
    # An empty line ends a notice, and lines of other documents do not continue it.
    head, tail = WRAPPED["bsd"].split("\n", 1)
    rows += [(300, f"{head}\n\n{tail}"), (301, head), (302, tail)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model = licenses.train(spark.createDataFrame(rows[:len(plain)], "doc_id long, text string"), background_rows=60)
    got = {r.doc_id: r for r in licenses.licence_report(docs, model=model).collect()}
    for i, (family, text) in enumerate(notices):
        for at in (100 + i, 200 + i):
            assert (at, got[at].licences) == (at, [family])
            assert 1 <= got[at].n_licence <= len(text.split("\n"))
            assert got[at].n_paragraphs == len(text.split("\n")) + 2
    assert not any("bsd" in got[i].licences for i in (300, 301, 302))
    assert all(got[i].licences == [] for i in range(len(plain)))


@needs_data
def test_pipeline_stages_follow_each_other(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    columns = docs.columns
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        kept.append({r.doc_id for r in docs.collect()})
    assert kept[1] == kept[0] and kept[2] <= kept[1] and kept[3] <= kept[2]
    assert not any(labels.get(d) == 0 for d in kept[0])
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in pieces} == kept[3]
