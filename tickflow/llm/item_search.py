"""Ranked documents per item, by one scan of the texts with an automaton of all items' terms.

Every distinct term of the items goes, with a guard on either side, into one
Aho-Corasick automaton; what stands between terms is mapped to the guard, so a
match is a whole term and never a part of one. A document is read once, counts
its terms and gets the number of times each item term occurs; there is no index
of the documents. Corpus statistics (documents, terms, document frequencies)
are aggregates of what the scan leaves, and so are known before scores are.
Scores add up in integers: a term's share goes to all items that hold it, task
by task, and a task sends on its best `most` documents per item.

An automaton is sent to all tasks. It is made of the terms of as many items as
have at most `automaton_bytes` of text together (or of one longer item); more
items go in several groups, each with a scan of its own and the same results.

Defined cases: null and empty texts hold no term, count as no document in the
statistics and are never ranked; items without a term, or whose terms no
document holds, have no rows; repeated terms of an item count once; repeated
items of one item_id are one item with the terms of all; repeated documents are
ranked each; equal scores go by ascending doc_id, a null doc_id first; where no
document has a term, or there is no item, there are no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickflow.llm.arrow_text import gather, slices
from tickflow.llm.helpers import in_order, same, saved

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
AUTOMATON_BYTES = 32 << 20
_GUARD = " "
# Bytes outside terms become the guard; of the others only A-Z change.
_TO_TERMS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else ord(_GUARD) for b in range(256))
_SLICE_BYTES = 8 << 20
_CELLS = 4_000_000  # scores a task holds at once
_HITS = "doc_id long, n long, terms array<int>, tfs array<int>"


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct rows (item_id, term)."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return items.select(F.col(item_id).alias("item_id"), F.explode(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))).alias("term")).distinct()


def _automaton(terms: list[str]):
    import ahocorasick
    automaton = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        automaton.add_word(f"{_GUARD}{term}{_GUARD}", number)
    automaton.make_automaton()
    return automaton


def _scan(terms: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, number = _automaton(terms), itemgetter(1)
        for batch in slices(batches, _SLICE_BYTES):
            ids, lengths, hits = [], [], []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                if not text.is_valid:
                    continue
                plain = text.as_py().encode().translate(_TO_TERMS)
                n = len(plain.split())
                if n:
                    ids.append(doc_id.as_py())
                    lengths.append(n)
                    hits.append(Counter(map(number, automaton.iter(f"{_GUARD}{plain.decode()}{_GUARD}"))))
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()),
                pa.array([list(h) for h in hits], pa.list_(pa.int32())),
                pa.array([list(h.values()) for h in hits], pa.list_(pa.int32()))], names=["doc_id", "n", "terms", "tfs"])
    return run


def _rank(n_docs: int, n_terms: int, weights: np.ndarray, firsts: np.ndarray, holders: np.ndarray, items: int, most: int) -> Callable:
    """Best documents per item number. Items that hold term t: holders[firsts[t]:firsts[t + 1]]."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_once = max(1, _CELLS // items)
        best = [np.zeros(0, np.int64) for _ in range(3)] + [np.zeros(0, bool)]  # item, score, doc_id, doc_id is known
        least = np.ones(items, np.int64)  # scores below cannot be among the best
        for whole in batches:
            for start in range(0, whole.num_rows, at_once):
                batch = whole.slice(start, at_once)
                terms = batch.column("terms").flatten().to_numpy().astype(np.int64)
                tfs = batch.column("tfs").flatten().to_numpy().astype(np.int64)
                held = np.diff(batch.column("terms").offsets.to_numpy())
                doc = np.repeat(np.arange(batch.num_rows), held)
                m = 10 + 90 * batch.column("n").to_numpy() * n_docs // n_terms
                share = weights[terms] * (1_000_000_000 * tfs // (1000 * tfs + 8 * m[doc]))
                counts = firsts[terms + 1] - firsts[terms]
                score = np.zeros(batch.num_rows * items, np.int64)
                ends = np.cumsum(counts)
                low = 0
                while low < len(terms):  # a bounded number of shares at a time
                    high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + _CELLS, side="right")))
                    some = slice(low, high)
                    cell = np.repeat(doc[some] * items, counts[some]) + holders[gather(firsts[terms[some]], counts[some])]
                    np.add.at(score, cell, np.repeat(share[some], counts[some]))
                    low = high
                score = score.reshape(batch.num_rows, items)
                row, item = np.nonzero(score >= least)
                ids = batch.column("doc_id")
                known = ids.is_valid().to_numpy(zero_copy_only=False)
                found = (item, score[row, item], ids.fill_null(0).to_numpy()[row], known[row])
                best = [np.concatenate(pair) for pair in zip(best, found)]
                order = np.lexsort((best[2], best[3], -best[1], best[0]))
                best = [column[order] for column in best]
                first = np.searchsorted(best[0], np.arange(items + 1))
                kept = np.arange(len(order)) - first[best[0]] < most
                full = np.flatnonzero(np.diff(first) >= most)
                least[full] = best[1][first[full] + most - 1]
                best = [column[kept] for column in best]
        yield pa.RecordBatch.from_arrays([
            pa.array(best[0].astype(np.int32)), pa.array(best[1]), pa.array(best[2], mask=~best[3])], names=["item", "score", "doc_id"])
    return run


def _ranked_group(docs: DataFrame, pairs: DataFrame, most: int) -> DataFrame:
    spark = docs.sparkSession
    rows = pairs.orderBy("term", "item_id").toArrow()  # at most `automaton_bytes` of terms, or one item
    coded, named = (rows[name].combine_chunks().dictionary_encode(null_encoding="encode") for name in ("term", "item_id"))
    terms, names = coded.dictionary.to_pylist(), named.dictionary
    term_of, item_of = (c.indices.to_numpy().astype(np.int64) for c in (coded, named))
    by_term = np.argsort(term_of, kind="stable")
    firsts, holders = np.searchsorted(term_of[by_term], np.arange(len(terms) + 1)), item_of[by_term]

    hits = saved(docs.mapInArrow(_scan(terms), _HITS))
    n_docs, n_terms = hits.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequency = hits.select(F.explode("terms").alias("term")).groupBy("term").count().toPandas()  # a row per item term
    df = np.zeros(len(terms), np.int64)
    df[frequency["term"].to_numpy(np.int64)] = frequency["count"].to_numpy(np.int64)
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)

    ranked = hits.mapInArrow(
        _rank(n_docs, max(n_terms, 1), weights, firsts, holders, len(names), most), "item int, score long, doc_id long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = ranked.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most)
    numbered = spark.createDataFrame(pa.table({"item": pa.array(range(len(names)), pa.int32()), "item_id": names}))
    return ranked.join(numbered, "item").select("item_id", "rank", "doc_id", "score")


def ranked_documents(docs: DataFrame, items: DataFrame, most: int = 10, doc_id: str = "doc_id", text: str = "text",
                     item_id: str = "item_id", item_text: str = "text", automaton_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """The `most` best documents with a score above 0 for each item: item_id, rank, doc_id, score."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pairs = saved(item_terms(items.withColumn(item_id, F.col(item_id).cast("long")), item_id, item_text))
    sizes = pairs.groupBy("item_id").agg(F.sum(F.octet_length("term") + 2).alias("bytes"))
    placed = saved(in_order(sizes, ["item_id"], sums=["bytes"]).select(
        "item_id", F.expr(f"before_bytes div {automaton_bytes}").alias("group")))
    groups = [row.group for row in placed.select("group").distinct().orderBy("group").collect()]
    found = [
        _ranked_group(docs, pairs.alias("p").join(placed.filter(F.col("group") == g).alias("g"), same("p", "g", ["item_id"])).select(
            "p.item_id", "term"), most) for g in groups]
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame(
        [], "item_id long, rank int, doc_id long, score long")
