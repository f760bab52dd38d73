"""Whole results of the table queries that have no SQL, recomputed row by row in plain Python."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import regex
import xxhash

from tests.llm.test_operators import _base, _fingerprint, words
from tickflow.llm import line_runs, mixing, quality, sharding, token_counts, word_tokens
from tickflow.llm.oracle import ORACLE_SQL
from tickflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return docs.collect()


def test_shards_and_slots(spark, rows):
    def key(r):
        crc = zlib.crc32((r.text or "").encode())
        return hashlib.md5("|".join([sharding.SEED, str(r.doc_id), str(crc)]).encode()).hexdigest()
    ties = {r.doc_id: (r.source is None, r.source or "", key(r), r.doc_id) for r in rows}
    ranks, sizes = {}, Counter(r.source for r in rows)
    for source in sizes:
        for rank, r in enumerate(sorted((r for r in rows if r.source == source), key=lambda r: ties[r.doc_id])):
            ranks[r.doc_id] = (2 * rank + 1) / (2 * sizes[source])
    order = sorted(rows, key=lambda r: (ranks[r.doc_id], ties[r.doc_id]))
    cuts = [len(part) for part in np.array_split(np.arange(len(rows)), 8)]
    places = [(shard, slot) for shard, n in enumerate(cuts) for slot in range(n)]
    expected = {r.doc_id: place for r, place in zip(order, places)}
    assert {r.doc_id: (r.shard, r.slot) for r in QUERIES["op2_shard"](spark, SF).collect()} == expected


def test_token_counts(spark, rows):
    counter = token_counts.UnigramCounts(token_counts.piece_scores(token_counts.public_pieces()))
    once = {}

    def count(word):
        if word not in once:
            once[word] = counter._one(token_counts.MARK + word)
        return once[word]
    expected = {r.doc_id: (len(words(r.text)), sum(map(count, words(r.text)))) for r in rows}
    assert {r.doc_id: (r.n_words, r.n_tokens) for r in QUERIES["op4_token_counts"](spark, SF).collect()} == expected


_TOKEN = regex.compile(r"[\p{L}\p{N}]+|[^\p{L}\p{N} \t\n\x0b\f\r]+")


def _hash(data, seed=42):
    return xxhash.xxh64_intdigest(data, seed)


def _buckets(text):
    def bucket(h):
        return (h - (1 << 64) if h >> 63 else h) % quality.BUCKETS
    tokens = [_hash(t.encode()) for t in _TOKEN.findall(text or "")]
    raw = [t.to_bytes(8, "little") for t in tokens]
    pairs = [_hash(raw[i + 1], _hash(raw[i])) if i + 1 < len(raw) else _hash(raw[i]) for i in range(len(raw))]
    return [bucket(h) for h in [*tokens, *pairs]]


def _quality(rows, labels):
    """Per document: base columns, base_failed, score, kept."""
    good = {r.doc_id for r in labels if r.quality == 1 and not r.toxic}
    features = {r.doc_id: _buckets(r.text) for r in rows}
    raw, trusted = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    for doc_id, found in features.items():
        np.add.at(raw, found, 1)
        if doc_id in good:
            np.add.at(trusted, found, 1)
    smooth = quality.SMOOTHING
    ratios = np.round(np.log((trusted + smooth) / (trusted.sum() + smooth * quality.BUCKETS))
                      - np.log((raw + smooth) / (raw.sum() + smooth * quality.BUCKETS)), 6)
    out = {}
    for r in rows:
        base = _base(r.text or "")
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        score = float(np.mean(ratios[features[r.doc_id]])) if features[r.doc_id] else 0.0
        out[r.doc_id] = (*base, failed, score, not failed and score >= quality.THRESHOLD)
    return out


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet").collect()


def test_quality_scores_and_verdicts(spark, rows, labels):
    expected = _quality(rows, labels)
    for r in QUERIES["op6_quality_rules"](spark, SF).collect():
        *base, failed, score, kept = expected[r.doc_id]
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == base
        assert math.isclose(r.score, score, abs_tol=2e-6) and (r.base_failed, r.kept) == (failed, kept)


def _without_later_lines(texts):
    """Texts by doc_id without later copies of lines with a word, and the lines that are left of each."""
    seen, out = set(), {}
    for doc_id in sorted(texts):
        left = []
        for line in texts[doc_id].split("\n"):
            if not words(line) or line not in seen:
                left.append(line)
            seen.add(line)
        out[doc_id] = "\n".join(left)
    return out


def _maximal_runs(texts):
    """Per doc_id, lengths of the unions of overlapping later copies: from each line the longest run of 2^k lines that
    starts earlier, too."""
    lines = {d: [x for x in texts[d].split("\n") if words(x)] for d in sorted(texts)}
    reach = {d: [0] * len(own) for d, own in lines.items()}
    size = 1
    while any(len(own) >= size for own in lines.values()):
        seen = set()
        for d, own in lines.items():
            for i in range(len(own) - size + 1):
                run = tuple(own[i:i + size])
                if run in seen:
                    reach[d][i] = i + size
                seen.add(run)
        size *= 2
    out = {}
    for d, ends in reach.items():
        runs, last = [], 0
        for i, end in enumerate(ends):
            if end:
                if i < last:
                    runs[-1] += 1
                else:
                    runs.append(1)
                last = max(last, end)
        out[d] = (len(runs), max(runs, default=0))
    return out


def test_lines(spark, rows):
    texts = {r.doc_id: r.text for r in rows}
    kept, runs = _without_later_lines(texts), _maximal_runs(texts)
    assert max(longest for _, longest in runs.values()) >= 4
    for r in QUERIES["op10_line_dedup"](spark, SF).collect():
        before, after = texts[r.doc_id].split("\n"), kept[r.doc_id]
        n_after = sum(bool(words(x)) for x in after.split("\n"))
        assert r.n_lines == len(before) and r.n_removed == sum(bool(words(x)) for x in before) - n_after
        assert r.kept_sha256 == hashlib.sha256(after.encode()).hexdigest()
        assert (r.n_runs, r.longest_run) == runs[r.doc_id]


def test_doubling_goes_on_until_every_suffix_is_alone(docs):
    lines = line_runs.repeated_lines(docs)
    levels = line_runs.suffix_levels(lines)
    assert len(levels) >= 3
    deepest = levels[-1].groupBy("rank").count()
    assert deepest.filter("count < 2").count() == 0
    # No two suffixes share twice as many lines: pairs of neighbouring ranks are all different.
    step = 2 ** (len(levels) - 1)
    last = {(r.doc, r.twin, r.pos): r.rank for r in levels[-1].collect()}
    pairs = [(rank, last[(d, t, p + step)]) for (d, t, p), rank in last.items() if (d, t, p + step) in last]
    assert len(pairs) == len(set(pairs))


def test_mixing_counts_rows_beyond_any_task(spark):
    units = spark.createDataFrame(
        [(i, "s", f"d{i}", size, n) for i, (size, n) in enumerate([(10**6, 2 * 10**9), (7, 3 * 10**9), (1, 10)])],
        "doc_id long, source string, digest string, size long, rows long")
    targets = spark.createDataFrame([("s", 2 * 10**15 + 21 * 10**9 + 10, 1.5 * (2 * 10**15), 1)], "source string, source_size long, target double, whole long")
    assert mixing._draws(units, targets, "seed").count() >= 0


def _components(prints):
    root = {d: d for d in prints}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x
    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in ids}


def test_the_pipeline_row_by_row(spark, rows, labels):
    """All stages one after the other: rules, lines, near-duplicates, mixture by the SQL of its query, packing."""
    import corpus_pipeline
    from tokenizers import Tokenizer
    verdicts = _quality(rows, labels)
    texts = {r.doc_id: r.text for r in rows if verdicts[r.doc_id][-1]}
    texts = _without_later_lines(texts)
    component = _components({d: _fingerprint(t) for d, t in texts.items()})
    texts = {d: t for d, t in texts.items() if component[d] == d}

    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    source = {r.doc_id: r.source for r in rows}
    con.executemany("insert into documents values (?, ?, ?)", [(d, t, source[d]) for d, t in texts.items()])
    result = con.execute(ORACLE_SQL["op1_mix_sources"])
    names = [c[0] for c in result.description]
    copies = {r[names.index("doc_id")]: r[names.index("copies")] for r in result.fetchall()}

    tokenizer = Tokenizer.from_file(word_tokens.public_tokenizer())
    tokenizer.encode_special_tokens = True
    expected = Counter()
    for d, t in texts.items():
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[start:start + 4096], "<u4")
            expected[(d, piece, start, len(part), zlib.crc32(part.tobytes()))] += copies[d]
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in pieces) == +expected
    used = {}
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert used.get(r.sequence_id, 0) == r.offset
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= 4096
    assert len(used) <= 1.2 * sum(used.values()) / 4096 + 3
