"""Item search, token files and phrases against brute force and exact round trips."""

import heapq
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickflow.llm import item_search, phrases, token_files, word_tokens
from tickflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
DOCS = "doc_id long, text string, lang string"
ODD = [
    (1, "The CAT sat. The cat sat, the cat\tsat; é É ß 日本 \U0001F600 ﬁ", "en"), (2, None, "en"), (3, "", None), (4, " \n\t\x0b", "en"),
    (5, "the cat sat the cat sat\nthe cat\x01 sat", None), (5, "the cat sat the cat sat\nthe cat\x01 sat", None), (None, "cat's don't 1 22 ²", "und"),
    (6, "x" * 5000 + " " + "the cat sat " * 3000, "en"), (-7, "<|endoftext|> the<|startoftext|> a\0b Σς ŉ \u0085   ́", "de"),
]
CLASHING = ["key", "n", "a", "slice", "words", "codes", "first", "start", "score", "rank", "term", "item", "id", "_range", "_at", "_text"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, DOCS).repartition(3)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# Item search


def best_documents(docs, items, most=10):
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))
    counted = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    asked = {}
    for item_id, text in items:
        asked.setdefault(item_id, set()).update(terms(text))
    out = []
    for item_id, wanted in asked.items():
        scores = []
        for d, c, n in counted:
            m = 10 + 90 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if t in c)
            if s > 0:
                scores.append((-s, d is not None, d or 0))
        out += [(item_id, rank, d if known else None, -s) for rank, (s, known, d) in enumerate(sorted(scores)[:most], 1)]
    return out


def _key(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)


ITEMS = [(1, "The cat, THE cat"), (2, None), (3, "... "), (4, "zebra"), (5, "日本 é ß 22 s"), (5, "sat"), (None, "a b sat"), (6, "x" * 5000)]


def test_search_of_odd_rows_equals_brute_force_whatever_the_groups(spark, odd):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    expected = sorted(best_documents([r[:2] for r in ODD], ITEMS), key=_key)
    assert expected
    for options in ({}, {"automaton_bytes": 10}):
        got = item_search.ranked_documents(odd, items, **options).collect()
        assert sorted(map(tuple, got), key=_key) == expected
    wide = odd.withColumns({c: F.lit("x") for c in CLASHING})
    wide_items = items.withColumns({c: F.lit("x") for c in CLASHING})
    assert sorted(map(tuple, item_search.ranked_documents(wide, wide_items).collect()), key=_key) == expected


def test_search_with_ties_and_few_places(spark):
    rows = [(i, "same words here" if i % 3 else "other words", "en") for i in range(200)]
    items = [(i, text) for i, text in enumerate(["same", "words", "here other", "words words"])]
    got = item_search.ranked_documents(
        spark.createDataFrame(rows, DOCS).repartition(7), spark.createDataFrame(items, "item_id long, text string"), most=3)
    assert sorted(map(tuple, got.collect())) == sorted(best_documents([r[:2] for r in rows], items, 3))


def test_search_of_nothing_gives_nothing(spark, odd):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert item_search.ranked_documents(odd.limit(0), items).count() == 0
    assert item_search.ranked_documents(odd, items.limit(0)).count() == 0


# Token files


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(word_tokens.public_tokenizer())
    whole.encode_special_tokens = True
    return whole


def in_files(tokenizer, rows):
    """Rows (doc_id, start, n_tokens, crc) and all ids, for rows in the order of the files."""
    out, every = [], []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, len(every), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        every += ids
    return out, every


@needs_data
def test_token_file_query_equals_the_tokenizer(spark, docs, tokenizer):
    expected, _ = in_files(tokenizer, sorted((r.doc_id, r.text) for r in docs.collect()))
    assert sorted(map(tuple, QUERIES["op12_token_files"](spark, SF).collect())) == expected


@pytest.mark.parametrize("options", [{}, {"every": 7, "run_bytes": 40, "max_bits": 10}, {"every": 1, "max_bits": 24, "block_ids": 30}])
def test_token_files_of_odd_rows_are_a_round_trip(spark, odd, tokenizer, tmp_path, options):
    wide = odd.withColumns({c: F.lit("x") for c in CLASHING})
    folder = f"{tmp_path}/tokens"
    token_files.write_token_files(wide, folder, **options)
    got = token_files.read_token_files(spark, folder, keep_ids=True).orderBy("start").collect()
    texts = {r[0]: r[1] for r in ODD}
    expected, every = in_files(tokenizer, [(r.doc_id, texts[r.doc_id]) for r in got])
    assert [tuple(r)[:4] for r in got] == expected
    assert [i for r in got for i in r.ids] == every
    assert [r.doc_id for r in got] == [None, -7, 1, 2, 3, 4, 5, 5, 6]
    book = spark.read.parquet(f"{folder}/codebook").collect()
    assert {r.id for r in book} == set(every) and max(r.bits for r in book) <= options.get("max_bits", 18)
    for start, stop in ((0, 1), (3, 40), (len(every) - 5, len(every) + 9), (0, len(every))):
        parts = token_files.ids_between(spark, folder, start, stop).orderBy("start").collect()
        assert [i for p in parts for i in p.ids] == every[start:stop]


def test_token_files_of_an_empty_table(spark, odd, tmp_path):
    token_files.write_token_files(odd.limit(0), f"{tmp_path}/tokens")
    assert token_files.read_token_files(spark, f"{tmp_path}/tokens").count() == 0


def test_many_copies_of_one_document_fill_several_ranges(spark, tmp_path):
    same = spark.range(4000).select(F.lit(7).alias("doc_id"), F.lit("a b c d").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_files.write_token_files(same, f"{tmp_path}/tokens")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = token_files.read_token_files(spark, f"{tmp_path}/tokens").orderBy("start").collect()
    assert [r.start for r in got] == [i * got[0].n_tokens for i in range(4000)]
    assert len([f for f in os.listdir(f"{tmp_path}/tokens/blocks") if f.endswith(".parquet")]) > 1


def huffman_cost(counts):
    heap, cost = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


def test_code_lengths_are_optimal_and_limited():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 9, 300, 5000):
        counts = (rng.pareto(0.5, n) * 3 + 1).astype(np.int64)
        for limit in (max(1, math.ceil(math.log2(n or 1))), 14, 50):
            if n > 1 << limit:
                continue
            bits = token_files.code_lengths(counts, limit)
            assert bits.max() <= limit and (n == 1 or sum(0.5 ** bits) == 1)
        if n > 1:
            assert (counts * token_files.code_lengths(counts, 50)).sum() == huffman_cost(counts.tolist())
    # The best of all complete codes of at most 3 bits for 5 ids, by trial.
    counts = np.array([1, 1, 2, 50, 60])
    best = min(sum(c * b for c, b in zip(counts, bits)) for bits in np.ndindex(3, 3, 3, 3, 3)
               for bits in [[b + 1 for b in bits]] if sum(0.5 ** b for b in bits) <= 1)
    assert (counts * token_files.code_lengths(counts, 3)).sum() == best
    with pytest.raises(ValueError):
        token_files.code_lengths(np.ones(9, np.int64), 3)


def test_cut_words_equal_the_whole_tokenizer(tokenizer):
    random.seed(4)
    alphabet = "aAbBzZéÉÀÿßŐőſƏǅΣσςİıﬁ日本́̈\u0085\x1c12²¼٣ªµ'stTreVvlLdm.,-!<|>\U0001F600‍﻿ŉǰ×÷"
    words = list({"".join(random.choices(alphabet, k=random.randint(1, 9))) for _ in range(20_000)})
    tokens = word_tokens.WordTokens(word_tokens.public_tokenizer(), most=3000)
    for part in (words[:2000], words, words[::-1]):
        firsts, lengths, flat = tokens.look_up([w.encode() for w in part])
        for word, first, n in zip(part, firsts.tolist(), lengths.tolist()):
            assert flat[first:first + n].tolist() == tokenizer.encode(word, add_special_tokens=False).ids


def test_texts_cut_into_units_equal_the_whole_tokenizer(tokenizer):
    random.seed(6)
    alphabet = ["a", "B", "é", "É", "1", "²", ".", ",", "!", "?", "'", "s", "t", " ", " ", "\t", "\n", "-", "\u00a0", "日", "\u0301", "Σ", ";", ":"]
    texts = ["", None, ".", ", ,", "a,", "a.,", "A.b. c'S! it's, 1. ²; é, É."] + ["".join(random.choices(alphabet, k=random.randint(1, 40))) for _ in range(4000)]
    tokens = word_tokens.WordTokens(word_tokens.public_tokenizer())
    counts, codes, distinct = tokens.units_of(pa.array(texts))
    firsts, lengths, flat = tokens.look_up(distinct.to_pylist())
    ends = np.cumsum(counts)
    for text, first, end in zip(texts, ends - counts, ends):
        got = [i for c in codes[first:end] for i in flat[firsts[c]:firsts[c] + lengths[c]].tolist()]
        assert got == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_other_tokenizers_are_left_whole():
    import public_tokenizers
    assert word_tokens.cutting_pattern(word_tokens.public_tokenizer())
    assert word_tokens.cutting_pattern(public_tokenizers.path("byte_bpe_50k.json")) is None


# Phrases


def mined(rows, least, longest=5, most=2000, absorb=100):
    counts, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(longest, len(words) - i) + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i:i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {p[i:j] for p, a in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                  if j - i < len(p) and 100 * a >= absorb * f[p[i:j]]}
        scored = []
        for p, a in candidates.items():
            if p not in inside:
                s, k = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, rank, p.decode(), -a, l, r, n[lang], -s) for rank, (s, a, p, l, r) in enumerate(sorted(scored)[:most], 1)]
    return sorted(out)


@needs_data
@pytest.mark.parametrize("options", [{"least": 5}, {"least": 12, "longest": 3, "most": 7}, {"least": 8, "absorb": 60}, {"least": 10**6}])
def test_phrases_of_a_table_equal_brute_force(docs, options):
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert sorted(map(tuple, phrases.phrases(docs.repartition(5), **options).collect())) == mined(rows, **options)


@pytest.mark.parametrize("least", [1, 2, 3])
def test_phrases_of_odd_rows_equal_brute_force(odd, least):
    wide = odd.withColumns({c: F.lit("x") for c in CLASHING})
    expected = mined([(r[2], r[1]) for r in ODD], least, most=10**6)
    assert sorted(map(tuple, phrases.phrases(wide, least=least, most=10**6).collect())) == expected
    assert {r[0] for r in expected} >= {"en", "und"}


def test_phrases_split_over_batches_and_ranges_count_once(spark):
    random.seed(2)
    rows = [(random.choice(["en", None]), " ".join(random.choices("abcd", [90, 5, 4, 1], k=random.randint(1, 60)))) for _ in range(400)]
    table = spark.createDataFrame(rows, "lang string, text string").repartition(9)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sorted(map(tuple, phrases.phrases(table, least=3).collect())) == mined(rows, 3)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        for key, value in before.items():
            spark.conf.set(key, value)


def test_phrases_of_an_empty_table(odd):
    assert phrases.phrases(odd.limit(0)).count() == 0
