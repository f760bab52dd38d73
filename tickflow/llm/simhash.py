"""SimHash near-duplicates, searched in BK-trees.

A fingerprint has a bit where over half of a document's shingles have it.
Distinct fingerprints are linked when few bits differ, and each document gets
the smallest doc_id it can reach.

Search: a BK-tree hangs every fingerprint below its parent under their
distance; a query follows only the edges within the radius. One tree over
everything, or every tree against every query, would cost a power of about 1.6
of the corpus, so trees are built in shards and sent, by shuffle, only to the
queries that can match: bits are cut into radius + 1 blocks; fingerprints within
the radius agree in at least one, so each block and its value is a shard. A
shard of more than `shard_rows` fingerprints is dealt out in chunks, and each
pair of chunks meets in one task: the tree of one is queried by the other. So
memory is bounded for any input, and nothing is sampled or capped. A task
passes on a spanning forest of the links it found.

Defined cases: a null text has no words, like an empty one; texts without
words have fingerprint zero and are linked like any other; a null doc_id is
linked but never names a component unless all its members are null; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.components import components
from tickflow.llm.helpers import saved

SHINGLE = 3
RADIUS = 2
SHARD_ROWS = 4096
_SEED = 42
_BITS = 64
_CHUNK = 1 << 18  # hashes whose bits are unpacked at a time


def _votes(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have."""
    ones = np.zeros(_BITS, np.int64)
    for start in range(0, len(hashes), _CHUNK):
        ones += np.unpackbits(hashes[start:start + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(bit) for bit in np.flatnonzero(2 * ones > len(hashes)))


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    words = (text or b"").lower().split()  # of bytes: A-Z only, and ASCII white space
    if not words:
        return 0
    if len(words) <= shingle:
        return _votes(np.array([xxhash.xxh64_intdigest(b" ".join(words), _SEED)], np.uint64))
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words])[:len(words) - shingle + 1].tolist()
    stops = (ends[shingle - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return _votes(np.array([digest(line[i:j], _SEED) for i, j in zip(starts, stops)], np.uint64))


def _fingerprints(shingle: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(values)], names=["key", "fp"])
    return run


class BKTree:
    """Fingerprints below a root; children are keyed by their distance to the parent."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        new = len(self.values)
        self.values.append(value)
        self.children.append({})
        node = 0
        while node != new:
            node = self.children[node].setdefault((value ^ self.values[node]).bit_count(), new)

    def within(self, value: int, radius: int) -> list[int]:
        found, todo = [], [0] if self.values else []
        while todo:
            node = todo.pop()
            distance = (value ^ self.values[node]).bit_count()
            if distance <= radius:
                found.append(self.values[node])
            edges = self.children[node]
            if len(edges) <= 2 * radius + 1:
                todo += [child for d, child in edges.items() if abs(d - distance) <= radius]
            else:
                todo += [edges[d] for d in range(distance - radius, distance + radius + 1) if d in edges]
        return found


def _forest(values: list[int], sides: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that hold together what is linked in one cell: within a chunk, or from chunk 0 to chunk 1."""
    tree, parent = BKTree(), {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x
    two = len(set(sides)) > 1
    if two:
        for value, side in zip(values, sides):
            if side == 0:
                tree.add(value)
    links = []
    for value, side in zip(values, sides):
        if two and side == 0:
            continue
        for other in tree.within(value, radius):
            a, b = root(value), root(other)
            if a != b:
                parent[a] = b
                links.append((value, other))
        if not two:
            tree.add(value)
    return links


def _search(radius: int) -> Callable:
    """Over rows sorted by cell: links found in each cell. A cell is held at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, values, sides = None, [], []
        mask = (1 << _BITS) - 1

        def links() -> list[tuple[int, int]]:
            return _forest(values, sides, radius) if len(values) > 1 else []
        for batch in batches:
            out = []
            for *here, side, value in zip(*(batch.column(c).to_pylist() for c in ("shard", "low", "high", "side", "fp"))):
                if here != cell:
                    out += links()
                    cell, values, sides = here, [], []
                values.append(value & mask)
                sides.append(side)
            yield _pairs(out)
        yield _pairs(links())

    def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
        both = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["a", "b"])
    return run


def _shards(radius: int) -> Column:
    """The shards of a fingerprint: for each block of bits, its number and value."""
    blocks = radius + 1
    edges = [i * _BITS // blocks for i in range(blocks + 1)]
    shards = []
    for number, (low, high) in enumerate(zip(edges, edges[1:])):
        mask = ((1 << (high - low)) - 1) << low
        signed = mask - (1 << _BITS) if mask >> (_BITS - 1) else mask
        shards.append(F.xxhash64(F.lit(number), F.col("fp").bitwiseAND(F.lit(signed))))
    return F.array(*shards)


def links(fingerprints: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints `fp` within the radius of each other."""
    routed = fingerprints.select("fp", F.explode(_shards(radius)).alias("shard"))
    crowded = routed.groupBy("shard").agg(F.count("*").alias("rows")).filter("rows > 1")
    routed = routed.join(crowded, "shard")  # the shards of one fingerprint alone have no links
    chunks = F.ceil(F.col("rows") / shard_rows)
    routed = routed.withColumns({"chunks": chunks, "chunk": F.pmod(F.xxhash64(F.col("fp"), F.lit(1)), chunks)})
    cells = routed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).select(
        "shard", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
        (F.col("chunk") > F.col("other")).cast("int").alias("side"), "fp")
    cell = ["shard", "low", "high"]
    return cells.repartition(*cell).sortWithinPartitions(*cell, "fp").mapInArrow(_search(radius), "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id."""
    return _linked(docs.select(F.col(doc_id).cast("long").alias("key"), F.col(text).cast("binary").alias("text")),
                   "long", shingle, radius, shard_rows).select(
        F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _linked(keyed: DataFrame, key_type: str, shingle: int, radius: int, shard_rows: int) -> DataFrame:
    """(key, text) to (key, fp, component_id): the least key of a component."""
    rows = saved(keyed.mapInArrow(_fingerprints(shingle), f"key {key_type}, fp long"))
    distinct = saved(rows.groupBy("fp").agg(F.min("key").alias("least")))
    roots = components(links(distinct, radius, shard_rows))
    named = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(named.join(least, "root").select("fp", "component_id"), "fp")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The documents less the near-duplicates: of each component the one with the smallest doc_id, with all its columns.

    Of rows that agree in the smallest doc_id, the one whose text has the
    smallest digest stays; of rows that agree in that too, one.
    """
    number = F.col(doc_id).cast("long").bitwiseXOR(F.lit(-2**63))  # as hex digits, in the order of the ids
    key = F.concat(F.coalesce(F.lpad(F.hex(number), 16, "0"), F.lit("~")),
                   F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    keyed = docs.select(key.alias("key"), F.struct("*").alias("row"))
    linked = _linked(docs.select(key.alias("key"), F.col(text).cast("binary").alias("text")), "string",
                     how.get("shingle", SHINGLE), how.get("radius", RADIUS), how.get("shard_rows", SHARD_ROWS))
    stay = linked.groupBy("component_id").agg(F.min("key").alias("key")).select("key").distinct()
    chosen = keyed.join(stay, "key", "left_semi")
    return chosen.dropDuplicates(["key"]).select("row.*")
