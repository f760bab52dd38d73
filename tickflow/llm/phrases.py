"""Phrases whose words stand together more often than chance, from sorted streams of counts.

Texts are cut into slices of bounded size whose words are numbered per slice;
words counted at least `least` times get a number for the whole corpus, in
order of (lang, word), and a phrase is the big-endian numbers of its words, so
that byte order is word order. What follows is sorting and reading side by side:

1. The window stream. Each place of a slice gives the window of up to `longest`
   words from there to the end of its piece or to a word that is too rare (no
   phrase with it can count enough). Equal windows of a slice are one row. The
   stream is sorted by ranges; phrases of all lengths are runs of windows in
   it, so one pass counts them all. Runs that reach over the edge of a batch
   or range are added up afterwards.
2. The count stream in prefix order. A phrase stands behind its own prefixes,
   so the last row of each length before it is its prefix of that length: one
   pass in step gives all left counts, and each row the count of what it extends
   to the right.
3. The same stream in suffix order (words reversed): right counts, and the
   count of what a row extends to the left.

A phrase is dropped if one with a word more, on either side, counts as often (by
`absorb` percent): counts only fall as phrases grow, so a longer phrase that
covers it makes one of these cover it too. Scores are exact (decimals).

Ranges depend on the sorted rows, not on first words, so a frequent word or
window, or a language that most rows have, spreads over several tasks. Prefixes
that stand in earlier ranges are handed on by a table of one row per range.

Defined cases: a null or empty text has no words; a null lang is `und`, and
counts together with rows that say so; repeated rows count each; a table
without a phrase that counts enough gives no rows; other columns are not read.
Words without a letter are words; words are compared as they are but for A-Z.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickflow.llm.arrow_text import objects, slices
from tickflow.llm.helpers import in_order, saved

LEAST = 100
LONGEST = 5
MOST = 2000
ABSORB = 100
_SLICE_BYTES = 8 << 20
_PART_BITS = 33  # of monotonically_increasing_id
_SLICES = "lang string, codes binary, size long, words array<string>, counts array<long>"
_BREAKS, _GAP = b".,;:!?\n\x0b\x0c\r", 32
# Breaks become line ends, tabs become spaces, A-Z become a-z.
_TO_WORDS = bytes(10 if b in _BREAKS else _GAP if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def _words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, and the number of the piece each stands in."""
    data = np.frombuffer(b"\n".join(texts).translate(_TO_WORDS), np.uint8)
    line = data == 10
    gap = line | (data == _GAP)
    edges = np.flatnonzero(np.diff(gap.view(np.int8), prepend=1, append=1))
    starts, ends = edges[::2], edges[1::2]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[~gap]))
    return words, np.cumsum(line)[starts]


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slice and lang: words by number (0 ends a piece), and the distinct words with their counts."""
    for batch in slices(batches, _SLICE_BYTES):
        batch = batch.filter(pc.is_valid(batch.column("text")))
        for lang in pc.unique(batch.column("lang")).to_pylist():
            texts = batch.filter(pc.equal(batch.column("lang"), lang)).column("text")
            words, piece = _words(objects(pc.cast(texts, pa.large_binary())))
            if not len(words):
                continue
            coded = words.dictionary_encode()
            numbers = coded.indices.to_numpy().astype(np.int64)
            _, piece = np.unique(piece, return_inverse=True)
            codes = np.zeros(len(numbers) + int(piece[-1]) + 1, np.uint32)
            codes[np.arange(len(numbers)) + piece] = numbers + 1
            yield pa.RecordBatch.from_arrays([
                pa.array([lang]), pa.array([pa.compress(codes.astype("<u4").tobytes(), "zstd", asbytes=True)], pa.binary()),
                pa.array([len(codes)], pa.int64()), pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary.cast(pa.string())),
                pa.array([np.bincount(numbers)], pa.list_(pa.int64()))], names=["lang", "codes", "size", "words", "counts"])


def _sorted_windows(columns: list[np.ndarray], values: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows of small numbers, and where in it a new row begins."""
    bits = max(values.bit_length(), 1)
    each = max(63 // bits, 1)
    keys = [reduce(lambda key, column: key << bits | column, columns[i:i + each]) for i in range(0, len(columns), each)]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        ordered = key[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    return order, np.flatnonzero(new)


def _windows(longest: int, width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                size = batch.column("size")[i].as_py()
                codes = np.frombuffer(pa.decompress(batch.column("codes")[i].as_py(), 4 * size, "zstd", asbytes=True), "<u4")
                known = batch.column("known")[i].values  # code and id of the words that count enough
                ids, at = known.field("id").to_numpy(), known.field("code").to_numpy()
                distinct = np.sort(ids)
                place = np.zeros(int(max(codes.max(initial=0), at.max(initial=0))) + 1, np.int64)
                place[at] = np.searchsorted(distinct, ids) + 1
                stream = np.concatenate([place[codes], np.zeros(longest, np.int64)])
                starts = np.flatnonzero((stream[:-1] > 0) & (stream[1:] > 0))
                if not len(starts):
                    continue
                columns = [stream[starts]]
                for k in range(1, longest):
                    columns.append(np.where(columns[-1] > 0, stream[starts + k], 0))
                order, first = _sorted_windows(columns, len(distinct))
                counts = np.diff(np.append(first, len(order)))
                rows = np.stack([column[order[first]] for column in columns], axis=1)
                there = rows > 0
                data = np.insert(distinct, 0, 0)[rows[there]].astype(f">u{width}").tobytes()
                offsets = np.concatenate([[0], np.cumsum(there.sum(axis=1) * width)]).astype(np.int64)
                keys = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
                out = pa.RecordBatch.from_arrays([keys.cast(pa.binary()), pa.array(counts)], names=["key", "n"])
                yield from (out.slice(s, 100_000) for s in range(0, out.num_rows, 100_000))
    return run


def _runs(least: int, longest: int, width: int) -> Callable:
    """Phrases of at least two words in sorted windows: those that count enough, and those that may go on beyond the batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("key").cast(pa.large_binary())
            offsets = np.frombuffer(keys.buffers()[1], np.int64)[keys.offset:keys.offset + len(keys) + 1]
            held = np.diff(offsets) // width
            rows = np.zeros((len(keys), longest), np.int64)
            rows[np.arange(longest) < held[:, None]] = np.frombuffer(keys.buffers()[2], f">u{width}")[offsets[0] // width:offsets[-1] // width]
            n = batch.column("n").to_numpy()
            new = np.ones(len(rows), bool)
            new[1:] = rows[1:, 0] != rows[:-1, 0]
            for depth in range(2, longest + 1):
                new[1:] |= rows[1:, depth - 1] != rows[:-1, depth - 1]
                first = np.flatnonzero(new)
                counts = np.add.reduceat(n, first)
                edge = np.zeros(len(first), bool)
                edge[[0, -1]] = True
                kept = (rows[first, depth - 1] > 0) & (edge | (counts >= least))
                phrases = rows[first[kept], :depth].astype(f">u{width}").tobytes()
                if phrases:
                    size = depth * width
                    yield pa.RecordBatch.from_arrays([
                        pa.array([phrases[i:i + size] for i in range(0, len(phrases), size)], pa.binary()),
                        pa.array(counts[kept]), pa.array(edge[kept])], names=["key", "n", "edge"])
    return run


def _phrase_counts(windows: DataFrame, least: int, longest: int, width: int) -> DataFrame:
    """(key, a) of phrases of two words or more that count enough."""
    order = ["key", "slice"]  # a window of many slices can fill several ranges
    ordered = windows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "n")
    runs = saved(ordered.mapInArrow(_runs(least, longest, width), "key binary, n long, edge boolean"))
    over_edges = runs.filter("edge").groupBy("key").agg(F.sum("n").alias("n"))
    return runs.filter(~F.col("edge")).select("key", "n").unionByName(over_edges).filter(F.col("n") >= least).withColumnRenamed("n", "a")


def in_step(stream: DataFrame, key: str, depth: Column, values: dict[str, tuple[int, Column]]) -> DataFrame:
    """Adds, for name: (d, value), the value of the last row of depth d at or before each row in order of `key`.

    In a stream that holds all prefixes of its keys, that row is the prefix of depth d.
    """
    placed = saved(stream.repartitionByRange(key).sortWithinPartitions(key).withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumns({
        "_range": F.shiftright("_at", _PART_BITS), **{f"_{name}": F.when(depth == d, value) for name, (d, value) in values.items()}})
    # A row per range: what the next range finds before its first row.
    ends = placed.groupBy("_range").agg(*(
        F.max_by(f"_{name}", F.when(F.col(f"_{name}").isNotNull(), F.col("_at"))).alias(f"_end_{name}") for name in values))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.select("_range", *(F.last(f"_end_{name}", ignorenulls=True).over(earlier).alias(f"_before_{name}") for name in values))
    so_far = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = placed.join(F.broadcast(before), "_range").withColumns({
        name: F.coalesce(F.last(f"_{name}", ignorenulls=True).over(so_far), F.col(f"_before_{name}")) for name in values})
    return found.select(*stream.columns, *values)


def phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, most: int = MOST, absorb: int = ABSORB,
            lang: str = "lang", text: str = "text") -> DataFrame:
    """The first `most` phrases of each lang: lang, rank, phrase, a, l, r, n, score."""
    texts = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    sliced = saved(texts.mapInArrow(_sliced, _SLICES).withColumn("slice", F.monotonically_increasing_id()))
    words = sliced.select("slice", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("code", "w")).select(
        "slice", "lang", (F.col("code") + 1).alias("code"), F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    counted = saved(words.groupBy("lang", "word").agg(F.sum("n").alias("a")))
    totals = counted.groupBy("lang").agg(F.sum("a").alias("n"))
    frequent = in_order(counted.filter(F.col("a") >= least), ["lang", "word"])
    frequent = saved(frequent.withColumn("id", F.col("position") + 1).join(totals, "lang").select("id", "lang", "word", "a", "n"))
    width = 4 if frequent.count() < 1 << 32 else 8

    # Every word of a slice stays in the join, so that its rows go with the input and not with the words that count enough.
    known = words.join(frequent.select("lang", "word", "id"), ["lang", "word"], "left").groupBy("slice").agg(
        F.collect_list(F.when(F.col("id").isNotNull(), F.struct("code", "id"))).alias("known"))
    windows = sliced.select("slice", "codes", "size").join(known, "slice").select("codes", "size", "known").mapInArrow(
        _windows(longest, width), "key binary, n long").withColumn("slice", F.spark_partition_id())

    stream = _phrase_counts(windows, least, longest, width).select(
        "key", "a", F.lit(None).cast("struct<lang:string,n:long>").alias("of"))
    stream = stream.unionByName(frequent.select(
        F.unhex(F.lpad(F.hex("id"), 2 * width, "0")).alias("key"), "a", F.struct("lang", "n").alias("of")))

    depth = (F.octet_length("key") / width).cast("int")
    stream = in_step(stream, "key", depth, {
        "in_lang": (1, F.col("of")), **{f"l{d}": (d, F.col("a")) for d in range(1, longest)}})
    backward = F.concat(*(F.substring("key", 1 + i * width, width) for i in reversed(range(longest))))
    stream = in_step(
        stream.withColumn("backward", backward), "backward", depth, {f"r{d}": (d, F.col("a")) for d in range(1, longest)})
    stream = saved(stream.filter(depth > 1).withColumn("depth", depth).select("*", "in_lang.*").drop("of", "in_lang", "backward"))

    def covered(side: str, rest: Column) -> DataFrame:
        shorter = reduce(lambda found, d: F.when(F.col("depth") == d + 1, F.col(f"{side}{d}")).otherwise(found),
                         range(2, longest), F.lit(None).cast("long"))
        return stream.filter((F.col("depth") > 2) & (F.col("a") * 100 >= shorter * absorb)).select(rest.alias("key"))

    inside = covered("l", F.expr(f"substring(key, 1, (depth - 1) * {width})")).unionByName(
        covered("r", F.expr(f"substring(key, {width + 1})")))
    candidates = stream.join(inside.distinct(), "key", "left_anti")

    def exact(name: str) -> Column:
        return F.col(name).cast("decimal(19,0)")

    def cut(k: int) -> Column:  # after the first k words
        def scored(d: int) -> Column:
            left, right = f"l{k}", f"r{d - k}"
            score = F.call_function("div", exact("a") * exact("n") * F.lit(1000).cast("decimal(4,0)"), exact(left) * exact(right))
            return F.struct(score.cast("long").alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))
        return reduce(lambda found, d: F.when(F.col("depth") == d, scored(d)).otherwise(found),
                      range(k + 1, longest + 1), F.lit(None))

    lowest = F.array_min(F.array(*(cut(k) for k in range(1, longest))))  # nulls are skipped
    scored = candidates.withColumn("cut", lowest).select("key", "lang", "a", "n", "cut.score", "cut.l", "cut.r", "depth")
    in_lang = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    leading = saved(scored.withColumn("near", F.rank().over(in_lang)).filter(F.col("near") <= most).drop("near"))

    # Only phrases that may lead get their words.
    ids = leading.select("key", F.explode(F.expr("sequence(1, depth)")).alias("i")).withColumn(
        "id", F.conv(F.hex(F.expr(f"substring(key, (i - 1) * {width} + 1, {width})")), 16, 10).cast("long"))
    spelled = ids.join(frequent.select("id", "word"), "id").groupBy("key").agg(
        F.array_join(F.expr("transform(array_sort(collect_list(struct(i, word))), w -> w.word)"), " ").alias("phrase"))
    final = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return leading.join(spelled, "key").withColumn("rank", F.row_number().over(final).cast("long")).filter(F.col("rank") <= most).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
