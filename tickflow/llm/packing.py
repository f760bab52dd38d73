"""Best-fit packing of tokenised documents, with a fixed number of open sequences.

Documents are tokenised where they are read; only a document longer than a
sequence is cut, into full pieces and a rest. Pieces, or just their lengths,
are dealt out by a hash and packed task by task: a piece goes to the open
sequence with the least free space that still holds it, found in a bitset
whose bit f is set while a sequence with f free places is open. If none holds
it, a new sequence is opened; when `open_sequences` are open already, the
fullest is closed first. A task's memory is bounded by the open sequences, not
by its pieces. The number of tasks follows the data (partitions are merged up
to the advisory size), and only each task's last open sequences stay unfilled.

The tokenizer's words never reach over white space, so each distinct word of
a run of documents is encoded once.

Defined cases: a null text is an empty document, which is its end token alone;
a null doc_id is carried through; repeated rows are packed as often as they
come; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.arrow_text import gather, objects, slices
from tickflow.llm.word_tokens import public_tokenizer, word_tokens

CAPACITY = 4096
END_TOKEN = 1
OPEN_SEQUENCES = 512
_SLICE_BYTES = 8 << 20
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(path: str, capacity: int, end_token: int, keep_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, _SLICE_BYTES):
            counts, codes, distinct = word_tokens(path).units_of(batch.column("text"))
            firsts, lengths, tokens = word_tokens(path).look_up(objects(distinct))
            flat = tokens[gather(firsts[codes], lengths[codes])].astype("<u4")
            ends = np.cumsum(np.bincount(np.repeat(np.arange(len(counts)), counts), lengths[codes], len(counts)).astype(np.int64))
            stop = np.array([end_token], "<u4")
            rows = {name: [] for name in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            for doc_id, first, end in zip(batch.column("doc_id").to_pylist(), [0, *ends.tolist()], ends.tolist()):
                ids = np.concatenate((flat[first:end], stop))
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity]
                    for name, value in zip(rows, (doc_id, piece, start, len(part), zlib.crc32(part.tobytes()), part)):
                        rows[name].append(value)
            columns = [
                pa.array(rows["doc_id"], pa.int64()), pa.array(rows["piece"], pa.int32()),
                *(pa.array(rows[name], pa.int64()) for name in ("start", "length", "ids_crc32"))]
            if keep_ids:
                columns.append(pa.array([part.astype(np.int32) for part in rows["ids"]], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=list(rows)[:len(columns)])
    return run


class OpenSequences:
    """Open sequences by free space; `put` says where a piece goes."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.levels = 0  # bit f: a sequence with f free places is open
        self.at: dict[int, list[int]] = {}
        self.open = self.made = 0

    def _take(self, free: int) -> int:
        stack = self.at[free]
        sequence = stack.pop()
        if not stack:
            self.levels ^= 1 << free
        self.open -= 1
        return sequence

    def put(self, length: int) -> tuple[int, int]:
        fitting = self.levels >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            sequence = self._take(free)
        else:
            free, sequence = self.capacity, self.made
            self.made += 1
            if length < self.capacity and self.open == self.most:
                self._take((self.levels & -self.levels).bit_length() - 1)  # the fullest is closed
        rest = free - length
        if rest:
            self.at.setdefault(rest, []).append(sequence)
            self.levels |= 1 << rest
            self.open += 1
        return sequence, self.capacity - free


def _place(capacity: int, open_sequences: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenSequences(capacity, open_sequences)
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.put(length) for length in batch.column("length").to_pylist()]
            sequences = np.fromiter((s for s, _ in placed), np.int64, len(placed)) + first
            offsets = np.fromiter((o for _, o in placed), np.int64, len(placed))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sequences), pa.array(offsets)],
                names=[*batch.schema.names, "sequence_id", "offset"])
    return run


def packed(docs: DataFrame, tokenizer: str | None = None, doc_id: str = "doc_id", text: str = "text",
           capacity: int = CAPACITY, end_token: int = END_TOKEN, open_sequences: int = OPEN_SEQUENCES,
           keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and with `keep_ids` its token ids."""
    path = tokenizer or public_tokenizer()
    schema = _PIECES + (", ids array<int>" if keep_ids else "")
    pieces = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        _pieces(path, capacity, end_token, keep_ids), schema)
    # Rows in an order of their own, so that a task run again packs alike.
    mixed = ["_mix", "doc_id", "piece", "ids_crc32"]
    dealt = pieces.withColumn("_mix", F.xxhash64("ids_crc32", "doc_id", "piece")).repartition("_mix").sortWithinPartitions(*mixed)
    return dealt.drop("_mix").mapInArrow(_place(capacity, open_sequences), f"{schema}, sequence_id long, offset long")
