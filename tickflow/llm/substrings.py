"""Substring dedup by window coverage: hashes of all windows stand in for a relative Lempel-Ziv parse of the corpus.

A window is `window` consecutive words of one document. Words are removed that
lie in a window which also starts in a document with a smaller doc_id. A greedy
relative Lempel-Ziv parse that looks up again at the ends of its factors covers
the same words; it is not done here. There are no factors, no places in a
reference and no comparison of words: windows are grouped by hash, those that
an earlier document has are marked, and the union of the marked ones goes.
`spans` are runs of covered words, which may come from several documents.

Sending every window to its block would move the corpus several times over. A
window is only looked up if its anchor is shared: the anchor is the least hash
among the window's `gram`-word grams, so equal windows have equal anchors, and a
run of neighbours has the same one. First the anchors that two documents or
more share are found, then the windows around these are looked up.

Tasks combine before each shuffle: of the documents a task holds together, all
but the smallest know at once that a window (or anchor) is shared, and one row
stands for the rest. So a passage that a third of all documents share is a row
per run of documents, and its other rows are dealt out by document.

Windows are compared by 64-bit hashes only; at n windows about n^2 / 2^65 pairs
of different ones agree by chance (0.7 at 5e9), and their words would be lost.

Defined cases: a null text has no words; texts of fewer words than a window
lose nothing; rows with a null doc_id are no reference and lose nothing; rows
that share a doc_id are one document as a reference; an empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickflow.llm.arrow_text import slices, words_of

WINDOW = 13
GRAM = 5
_SLICE_BYTES = 8 << 20
_SALTS = 1024
_ALONE, _LEAST, _LATER = 0, 1, 2
_EVIDENCE = "key long, doc_id long, part short"


def _factors(n: int, seed: int) -> np.ndarray:
    """Odd multipliers, the same in every task."""
    return np.array([xxhash.xxh64_intdigest(f"{seed}:{i}") | 1 for i in range(n)], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _run_hashes(words: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A hash of the n words from each place on, for all places with n words left."""
    count = max(len(words) - n + 1, 0)
    out = np.zeros(count, np.uint64)
    for i, factor in enumerate(_factors(n, seed)):
        out += words[i:i + count] * factor
    return _mixed(out)


class _Slice:
    """Word hashes, windows and anchors of a run of documents."""

    def __init__(self, texts: pa.Array, window: int, gram: int):
        counts, codes, distinct = words_of(texts)
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))[codes]
        ends = np.cumsum(counts)
        doc = np.repeat(np.arange(len(counts)), counts)
        room = ends[doc] - np.arange(len(codes)) >= window  # a window from here stays in its document
        self.starts = np.flatnonzero(room)
        self.doc = doc[self.starts]
        self.first_word = ends - counts
        self.counts = counts
        grams = _run_hashes(hashes, gram, 1)
        self.anchors = np.zeros(0, np.uint64)
        self.windows = _run_hashes(hashes, window, 2)[self.starts] if len(self.starts) else np.zeros(0, np.uint64)
        if len(self.starts):
            least = grams.copy()
            for i in range(1, window - gram + 1):
                np.minimum(least[:-i], grams[i:], out=least[:-i])
            self.anchors = least[self.starts]


def _evidence(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (key, doc) pairs, each once: key, doc, and the part doc plays for the key here: alone, least or later."""
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    new_key = np.append(True, keys[1:] != keys[:-1])
    new = new_key | np.append(True, docs[1:] != docs[:-1])
    keys, docs, new_key = keys[new], docs[new], new_key[new]
    followed = np.append(~new_key[1:], False)
    return keys, docs, np.where(new_key, np.where(followed, _LEAST, _ALONE), _LATER).astype(np.int16)


def _emit(keys: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
    if len(keys):
        keys, docs, part = _evidence(keys, docs)
    else:
        part = np.zeros(0, np.int16)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys.view(np.int64)), pa.array(docs.astype(np.int64)), pa.array(part)], names=["key", "doc_id", "part"])


def _anchors(window: int, gram: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, _SLICE_BYTES):
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            part = _Slice(batch.column("text"), window, gram)
            if len(part.starts):
                step = np.append(True, (part.anchors[1:] != part.anchors[:-1]) | (part.doc[1:] != part.doc[:-1]))
                yield _emit(part.anchors[step], ids[part.doc[step]])
    return run


def _members(batch: pa.RecordBatch, column: str, part: _Slice, keys: np.ndarray) -> np.ndarray:
    """Which windows have their key in their document's list. Lists and keys are sorted together."""
    lists = batch.column(column)
    sizes = np.diff(lists.offsets.to_numpy())
    wanted = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    owner = np.repeat(np.arange(len(lists)), sizes)
    mixed = _mixed(wanted + owner.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    return np.isin(_mixed(keys + part.doc.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)), mixed)


def _windows(window: int, gram: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = (batch.filter(batch.column("keys").is_valid()) for batch in batches)
        for batch in slices(near, _SLICE_BYTES):
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            part = _Slice(batch.column("text"), window, gram)
            hit = _members(batch, "keys", part, part.anchors)
            yield _emit(part.windows[hit], ids[part.doc[hit]])
    return run


def _parse(window: int, gram: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, _SLICE_BYTES):
            part = _Slice(batch.column("text"), window, gram)
            hit = part.starts[_members(batch, "keys", part, part.windows)]
            total = int(part.counts.sum())
            depth = np.zeros(total + 1, np.int64)
            np.add.at(depth, hit, 1)
            np.add.at(depth, hit + window, -1)
            covered = np.cumsum(depth)[:total] > 0
            factors, removed, kept = [], [], []
            for i, first, count in zip(range(batch.num_rows), part.first_word.tolist(), part.counts.tolist()):
                gone = covered[first:first + count]
                edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                factors.append([{"start": int(a), "length": int(b - a)} for a, b in zip(edges[::2], edges[1::2])])
                removed.append(int(gone.sum()))
                words = (batch.column("text")[i].as_py() or b"").split()
                if factors[-1]:
                    words = [w for w, x in zip(words, gone.tolist()) if not x]
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(part.counts), pa.array(removed, pa.int64()),
                pa.array(factors, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                pa.array([hashlib.sha256(k.encode()).hexdigest() for k in kept]), pa.array(kept)],
                names=["doc_id", "n_words", "n_removed", "spans", "kept_sha256", "kept_text"])
    return run


def _with_smaller(evidence: DataFrame, later_only: bool) -> DataFrame:
    """(doc_id, keys): of each document the keys that others have, too, or that a smaller doc_id has.

    What a task knows already only travels on by document.
    """
    later = F.col("part") == _LATER
    salt = F.when(later, F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS)) + 1).otherwise(0).cast("short")
    block = Window.partitionBy("key", "salt")
    seen = evidence.withColumn("salt", salt).withColumns({
        "least": F.min("doc_id").over(block), "most": F.max("doc_id").over(block)})
    shared = later | (F.col("doc_id") > F.col("least"))
    if not later_only:
        shared = shared | (F.col("part") == _LEAST) | (F.col("doc_id") < F.col("most"))
    return seen.filter(shared).groupBy("doc_id").agg(F.collect_list("key").alias("keys"))


def parsed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, spans (start, length in words), kept_sha256, kept_text."""
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    known = texts.filter("doc_id is not null")
    anchors = _with_smaller(known.mapInArrow(_anchors(window, gram), _EVIDENCE), later_only=False)
    # Left joins both times, so that the texts are dealt out by document once and read twice.
    near = texts.join(anchors, "doc_id", "left").mapInArrow(_windows(window, gram), _EVIDENCE)
    copies = _with_smaller(near, later_only=True)
    return texts.join(copies, "doc_id", "left").mapInArrow(
        _parse(window, gram), "doc_id long, n_words long, n_removed long, spans array<struct<start:long,length:long>>, kept_sha256 string, kept_text string")


def substring_report(docs: DataFrame, **how) -> DataFrame:
    return parsed(docs, **how).select("doc_id", "n_words", "n_removed", "kept_sha256")
