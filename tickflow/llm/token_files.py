"""Token ids of a corpus in files, by canonical Huffman codes of limited length.

Layout of a folder:

`codebook`  one row per id that occurs: `id`, `bits` (length of its code). Codes
            are canonical: in order of (bits, id), each the one before plus one,
            so lengths alone tell them. No code has more than `max_bits` bits.
`blocks`    Parquet files in ascending order of documents, one row per block, a
            block being a run of whole documents: `first` (ids before the
            block), `n` (ids in it), `payload` (codes one after the other, most
            significant bit first), `every` and `checkpoints` (bit offset of
            each `every`-th id), `doc_ids` and `doc_lengths`.

A block is decoded alone, by one look-up of `max_bits` bits per id. Its
checkpoints are entry points: decoding runs from all of them side by side, and
a few ids are read without what stands before them.

Texts are sorted by ranges of doc_id and encoded in runs of about `run_bytes`;
each distinct word of a run is encoded once, and the run is kept as numbers of
words until the counts of all ids are known. Counts, at most one per id of the vocabulary, are
the only thing that meets in the driver. Words are then written, not ids: up to
three ids have one joint code of at most 57 bits.

Defined cases: a null or empty text is its end token alone; null doc_ids come
first; documents of one doc_id are ordered by text hash and each has its own
row; an empty table gives an empty codebook and no blocks; other columns are
not read. A block ends with the document that brings it to `block_ids` ids, or
with its run.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickflow.llm.arrow_text import gather, objects, slices
from tickflow.llm.helpers import saved
from tickflow.llm.word_tokens import public_tokenizer, word_tokens
from tickflow.session import scratch_dir

END_TOKEN = 2
MAX_BITS = 18
EVERY = 256
RUN_BYTES = 16 << 20
BLOCK_IDS = 1 << 20
_LANES = 4096  # checkpoints decoded side by side
_JOINT_BITS = 57  # with 7 bits of shift they fit into 64
_PART_BITS = 33  # of monotonically_increasing_id
_DRAFT = pa.schema([
    ("doc_ids", pa.list_(pa.int64())), ("doc_words", pa.list_(pa.int64())), ("doc_lengths", pa.list_(pa.int64())),
    ("n", pa.int64()), ("ids", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64())),
    ("codes", pa.binary()), ("run_lengths", pa.binary()), ("runs", pa.binary())])
_DRAFT_DDL = ("doc_ids array<long>, doc_words array<long>, doc_lengths array<long>, n long, ids array<int>, counts array<long>, "
              "codes binary, run_lengths binary, runs binary")
_BLOCK = pa.schema([
    ("first", pa.int64()), ("n", pa.int64()), ("every", pa.int32()), ("checkpoints", pa.list_(pa.int64())),
    ("doc_ids", pa.list_(pa.int64())), ("doc_lengths", pa.list_(pa.int64())), ("payload", pa.binary())])
_BLOCK_DDL = ("first long, n long, every int, checkpoints array<long>, doc_ids array<long>, doc_lengths array<long>, payload binary")


def code_lengths(counts: np.ndarray, max_bits: int) -> np.ndarray:
    """Lengths of an optimal prefix code with no code above `max_bits`, by package-merge."""
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    if n > 1 << max_bits:
        raise ValueError(f"{n} ids do not fit into codes of {max_bits} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    row, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(max_bits - 1):
        pairs = row[:len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        at = np.argsort(both, kind="stable")
        row = both[at]
        is_leaf.append(at < n)
    bits, take = np.zeros(n, np.int64), 2 * n - 2
    for level in reversed(is_leaf):
        taken = int(level[:take].sum())
        bits[:taken] += 1
        take = 2 * (take - taken)
    out = np.empty(n, np.int64)
    out[order] = bits
    return out


class Codebook:
    """Codes and the decoding table, from ids and the lengths of their codes."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray, max_bits: int):
        order = np.lexsort((ids, bits))
        ids, bits = ids[order].astype(np.int64), bits[order].astype(np.int64)
        self.max_bits = max_bits
        width = 1 << (max_bits - bits)
        size = int(ids.max(initial=-1)) + 1
        self.code, self.bits = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.code[ids] = ((np.cumsum(width) - width) >> (max_bits - bits)).astype(np.uint64)
        self.bits[ids] = bits
        self.symbol, self.length = np.zeros(1 << max_bits, np.uint32), np.ones(1 << max_bits, np.uint8)
        filled = int(width.sum())
        self.symbol[:filled], self.length[:filled] = np.repeat(ids, width), np.repeat(bits, width)


class Joint:
    """Runs of ids cut into pieces of a few ids that have one joint code each."""

    def __init__(self, book: Codebook, run_lengths: np.ndarray, runs: np.ndarray):
        most = _JOINT_BITS // book.max_bits
        self.pieces = -(-run_lengths // most)  # per run
        self.first = np.cumsum(self.pieces) - self.pieces
        total = int(self.pieces.sum())
        nth = np.arange(total) - np.repeat(self.first, self.pieces)
        start = np.repeat(np.cumsum(run_lengths) - run_lengths, self.pieces) + nth * most
        self.n = np.minimum(np.repeat(run_lengths, self.pieces) - nth * most, most)
        self.code, self.bits = np.zeros(total, np.uint64), np.zeros(total, np.int64)
        self.before = np.zeros((most, total), np.int64)  # bits before the k-th id of a piece
        for k in range(most):
            self.before[k] = self.bits
            there = self.n > k
            ids = runs[start[there] + k]
            self.code[there] = (self.code[there] << book.bits[ids].astype(np.uint64)) | book.code[ids]
            self.bits[there] += book.bits[ids]

    def written(self, run_codes: np.ndarray, every: int) -> tuple[bytes, np.ndarray]:
        """The bits of a sequence of runs, and the bit offset of each `every`-th id."""
        at = gather(self.first[run_codes], self.pieces[run_codes])
        bits, n = self.bits[at], self.n[at]
        ends, id_ends = np.cumsum(bits), np.cumsum(n)
        offsets = ends - bits
        marks = np.arange(0, int(id_ends[-1]) if len(at) else 0, every)
        holder = np.searchsorted(id_ends, marks, side="right")
        inside = marks - (id_ends[holder] - n[holder])
        checkpoints = offsets[holder] + self.before[inside, at[holder]]
        return _bits(self.code[at], bits, offsets), checkpoints


def _bits(codes: np.ndarray, bits: np.ndarray, offsets: np.ndarray) -> bytes:
    """Codes of at most 57 bits, none of them empty, one after the other in bytes."""
    if not len(codes):
        return b""
    total = int(offsets[-1] + bits[-1])
    words = np.zeros((total + 63) // 64 + 1, np.uint64)
    word, room = offsets >> 6, 64 - (offsets & 63) - bits
    inside = np.where(room >= 0, codes << np.maximum(room, 0).astype(np.uint64), codes >> np.maximum(-room, 0).astype(np.uint64))
    first = np.flatnonzero(np.diff(word, prepend=-1))
    words[word[first]] = np.bitwise_or.reduceat(inside, first)
    over = np.flatnonzero(room < 0)  # at most one code reaches over the end of each word
    words[word[over] + 1] |= codes[over] << (64 + room[over]).astype(np.uint64)
    return words.astype(">u8").tobytes()[:(total + 7) // 8]


def decoded(book: Codebook, payload: bytes, checkpoints: np.ndarray, n: int, every: int) -> np.ndarray:
    """`n` ids, from all checkpoints side by side; each of them leads to `every` ids but the last."""
    data = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
    data = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
    last, shift, mask = len(data) - 1, 32 - book.max_bits, (1 << book.max_bits) - 1
    parts = [np.zeros(0, np.uint32)]
    for first in range(0, len(checkpoints), _LANES):
        at = checkpoints[first:first + _LANES].astype(np.int64)
        out = np.empty((every, len(at)), np.uint32)
        for k in range(every):
            window = (data[np.minimum(at >> 3, last)] >> (shift - (at & 7)).astype(np.uint32)) & mask
            out[k] = book.symbol[window]
            at += book.length[window]
        parts.append(out.T.ravel())
    return np.concatenate(parts)[:n]


def _drafts(path: str, end_token: int, run_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, run_bytes):
            doc_words, codes, distinct = word_tokens(path).units_of(batch.column("text"))
            firsts, lengths, tokens = word_tokens(path).look_up(objects(distinct))
            # The end token is the last run.
            runs = np.append(tokens[gather(firsts, lengths)], end_token).astype("<u4")
            lengths = np.append(lengths, 1)
            doc_of = np.repeat(np.arange(len(doc_words)), doc_words)
            doc_lengths = np.bincount(doc_of, lengths[codes], len(doc_words)).astype(np.int64) + 1
            used = np.append(np.bincount(codes, minlength=len(distinct)), len(doc_words))
            counts = np.bincount(runs, np.repeat(used, lengths)).astype(np.int64)
            ids = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((
                batch.column("doc_id").to_pylist(), doc_words, doc_lengths, int(doc_lengths.sum()),
                ids.astype(np.int32), counts[ids],
                _packed(codes), _packed(lengths), _packed(runs)), _DRAFT.types)], schema=_DRAFT)
    return run


def _packed(values: np.ndarray) -> bytes:
    """Numbers from 0 in two or four bytes each, compressed, behind their width and size."""
    width = 2 if values.max(initial=0) < 1 << 16 else 4
    data = values.astype(f"<u{width}").tobytes()
    return bytes([width]) + len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(
        pa.decompress(data[9:], int.from_bytes(data[1:9], "little"), "zstd", asbytes=True), f"<u{data[0]}").astype(np.int64)


def _write(ids: np.ndarray, bits: np.ndarray, max_bits: int, every: int, block_ids: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(ids, bits, max_bits)
        place, within = None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["_range"] != place:
                    place, within = row["_range"], 0
                lengths, codes = _unpacked(row["run_lengths"]), _unpacked(row["codes"])
                joint = Joint(book, lengths, _unpacked(row["runs"]))
                doc_ends = np.cumsum(np.array(row["doc_words"], np.int64))
                doc_lengths = np.array(row["doc_lengths"], np.int64)
                filled = (np.cumsum(doc_lengths) - doc_lengths) // block_ids
                cuts = [0, *(np.flatnonzero(filled[:-1] != filled[1:]) + 1).tolist(), len(filled)]
                for a, b in zip(cuts, cuts[1:]):
                    low, n = int(doc_ends[a - 1]) if a else 0, int(doc_lengths[a:b].sum())
                    words = np.insert(codes[low:doc_ends[b - 1]], doc_ends[a:b] - low, len(lengths) - 1)
                    payload, checkpoints = joint.written(words, every)
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((
                        row["_start"] + within, n, every, checkpoints, row["doc_ids"][a:b], doc_lengths[a:b], payload),
                        _BLOCK.types)], schema=_BLOCK)
                    within += n
    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None, doc_id: str = "doc_id", text: str = "text",
                      end_token: int = END_TOKEN, max_bits: int = MAX_BITS, every: int = EVERY,
                      run_bytes: int = RUN_BYTES, block_ids: int = BLOCK_IDS) -> None:
    """Encode all documents and write them to a folder that does not exist yet."""
    if not 1 <= max_bits <= 24:
        raise ValueError("codes can have 1 to 24 bits")
    path, spark = tokenizer or public_tokenizer(), docs.sparkSession
    order = ["doc_id", "_text", "_copy"]  # copies are told apart, so that many of them fill several ranges
    ordered = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumns({
        "_text": F.xxhash64("text"), "_copy": F.monotonically_increasing_id()})
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    drafts = ordered.mapInArrow(_drafts(path, end_token, run_bytes), _DRAFT_DDL)
    drafts = saved(drafts.withColumn("_range", F.shiftright(F.monotonically_increasing_id(), _PART_BITS)))

    counted = drafts.select(F.explode(F.arrays_zip("ids", "counts")).alias("c")).groupBy(F.col("c.ids").alias("id")).agg(
        F.sum("c.counts").alias("n"))
    counted = counted.orderBy("id").toPandas()  # at most a row per id of the vocabulary
    ids, bits = counted["id"].to_numpy(np.int64), code_lengths(counted["n"].to_numpy(np.int64), max_bits)

    # A row per range: ids before its first document.
    totals = drafts.groupBy("_range").agg(F.sum("n").alias("_n"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    blocks = drafts.drop("ids", "counts").join(F.broadcast(starts), "_range").mapInArrow(
        _write(ids, bits, max_bits, every, block_ids), _BLOCK_DDL)
    blocks.write.option("compression", "none").parquet(f"{folder}/blocks")
    book = spark.createDataFrame(pa.table({
        "id": pa.array(ids, pa.int64()), "bits": pa.array(bits, pa.int32()), "max_bits": pa.array([max_bits] * len(ids), pa.int32())}))
    book.coalesce(1).write.parquet(f"{folder}/codebook")


def _codebook(spark: SparkSession, folder: str) -> Callable[[], Codebook]:
    rows = spark.read.parquet(f"{folder}/codebook").toPandas()  # at most a row per id of the vocabulary
    ids, bits = rows["id"].to_numpy(np.int64), rows["bits"].to_numpy(np.int64)
    max_bits = int(rows["max_bits"].iloc[0]) if len(rows) else 1
    return lambda: Codebook(ids, bits, max_bits)


def read_token_files(spark: SparkSession, folder: str, keep_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, ids_crc32, and with `keep_ids` its ids."""
    make = _codebook(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = make()
        for batch in batches:
            for row in batch.to_pylist():
                ids = decoded(book, row["payload"], np.array(row["checkpoints"]), row["n"], row["every"]).astype("<u4")
                lengths = np.array(row["doc_lengths"], np.int64)
                ends = np.cumsum(lengths)
                parts = [ids[end - n:end] for end, n in zip(ends.tolist(), lengths.tolist())]
                columns = [
                    pa.array(row["doc_ids"], pa.int64()), pa.array(ends - lengths + row["first"]), pa.array(lengths),
                    pa.array([zlib.crc32(part.tobytes()) for part in parts], pa.int64())]
                if keep_ids:
                    columns.append(pa.array([part.astype(np.int64) for part in parts], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(columns)])

    blocks = spark.read.parquet(f"{folder}/blocks")
    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if keep_ids else ""))


def token_report(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write the documents' ids and read them back: doc_id, start, n_tokens, ids_crc32."""
    folder = folder or scratch_dir(docs.sparkSession, "tokens")
    write_token_files(docs, folder, **options)
    return read_token_files(docs.sparkSession, folder)


def ids_between(spark: SparkSession, folder: str, start: int, stop: int) -> DataFrame:
    """Ids number `start` (from 0) to `stop` of the whole corpus as rows (start, ids), one per block, decoded from the checkpoint before them."""
    make = _codebook(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = make()
        for batch in batches:
            for row in batch.to_pylist():
                low, high = max(start - row["first"], 0), min(stop - row["first"], row["n"])
                lanes = np.array(row["checkpoints"])[low // row["every"]:-(-high // row["every"])]
                before = low // row["every"] * row["every"]
                ids = decoded(book, row["payload"], lanes, high - before, row["every"])[low - before:]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["first"] + low]), pa.array([ids.astype(np.int64)], pa.list_(pa.int64()))], names=["start", "ids"])

    near = spark.read.parquet(f"{folder}/blocks").filter((F.col("first") < stop) & (F.col("first") + F.col("n") > start))
    return near.select("first", "n", "every", "checkpoints", "payload").mapInArrow(run, "start long, ids array<long>")
