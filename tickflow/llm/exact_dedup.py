"""Exact duplicates by deterministic block naming.

Texts are cut into blocks of a fixed number of bytes. All distinct blocks are
sorted, each partition of their hashes by itself, and numbered; then adjacent pairs of numbers are sorted and numbered
again, level by level, until each document is left with one number. Two
documents are equal if and only if they took as many levels and end with the
same number: numbers stand for contents, so there are no collisions.

Blocks of text are moved once, to be sorted. Documents find the number of a
block by its two 64-bit hashes; before that is relied on, the sorted blocks
themselves are checked to have no two with the same hashes, over the whole
corpus, and another salt is taken if there are. The hot group of a text that
fills a third of all rows is one block after map-side aggregation, and what is
joined back is a few integers per block.

Defined cases: a null text counts as empty, all empty texts are one group;
rows with a null doc_id are below all others; of rows that agree in doc_id and
text, exactly one can stay; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.helpers import let, saved, sorted_names

BLOCK_BYTES = 2048


def hashes(block: Column, salt: int) -> tuple[Column, Column]:
    """Two hashes that have nothing to do with each other or with those of another salt."""
    return F.xxhash64(F.lit(2 * salt), block), F.xxhash64(F.lit(2 * salt + 1), block)


def _blocks(text: Column, size: int) -> Column:
    """The UTF-8 bytes of a text in blocks; one empty block for an empty text."""
    def cut(data: Column) -> Column:
        last = F.greatest(F.ceil(F.octet_length(data) / size), F.lit(1)) - 1
        return F.transform(F.sequence(F.lit(0).cast("long"), last.cast("long")), lambda i: F.substring(
            data, (i * size + 1).cast("int"), F.lit(size)))
    return let(F.coalesce(text, F.lit("")).cast("binary"), cut)


def _block_names(blocks: DataFrame, salt: int, hasher: Callable) -> DataFrame | None:
    """(a, b, name) for each distinct block, or None if two blocks share both hashes."""
    a, b = hasher(F.col("block"), salt)
    distinct = blocks.select(a.alias("a"), b.alias("b"), "block").groupBy("a", "b", "block").agg(F.count("*").alias("n"))
    names = saved(sorted_names(distinct, ["block"], "name").select("a", "b", "name"))
    clash = names.groupBy("a", "b").count().filter("count > 1")
    return None if clash.head(1) else names


def name_documents(docs: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES,
                   hasher: Callable = hashes) -> DataFrame:
    """One row per document: its columns but the text as `row`, `sha256`, and its identity (`levels`, `name`)."""
    keep = [F.col(f"`{c}`") for c in docs.columns if c != text]
    source = docs.select(F.struct(*keep, F.lit(0).alias("_")).alias("row"), F.col(text).alias("text"))
    blocks = source.select(F.explode(_blocks(F.col("text"), block_bytes)).alias("block"))
    salt, names = 0, _block_names(blocks, 0, hasher)
    while names is None:
        salt += 1
        names = _block_names(blocks, salt, hasher)

    def keys(block: Column) -> Column:
        a, b = hasher(block, salt)
        return F.struct(a.alias("a"), b.alias("b"))
    rows = saved(source.select(
        F.monotonically_increasing_id().alias("id"), "row",
        F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("sha256"),
        F.transform(_blocks(F.col("text"), block_bytes), keys).alias("keys")))
    named = (rows.select("id", F.posexplode("keys").alias("pos", "key")).select("id", "pos", "key.a", "key.b")
             .join(names, ["a", "b"]).select("id", "pos", "name"))
    most = rows.agg(F.max(F.size("keys"))).first()[0] or 1
    levels = (most - 1).bit_length()
    done = []
    for level in range(levels + 1):
        if level:
            named = _pair_up(named)
        sized = rows.select("id", F.ceil(F.log2(F.size("keys"))).cast("int").alias("levels"))
        done.append(sized.filter(F.col("levels") == level).join(named.filter("pos = 0"), "id").select("id", "levels", "name"))
        if level < levels:
            named = saved(named.join(sized.filter(F.col("levels") > level).select("id"), "id", "left_semi"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return rows.select("id", "row", "sha256").join(out, "id")


def _pair_up(named: DataFrame) -> DataFrame:
    """Numbers of adjacent pairs; a last one without a partner pairs with nothing."""
    left, right = F.when(F.col("pos") % 2 == 0, F.col("name")), F.when(F.col("pos") % 2 == 1, F.col("name"))
    pairs = named.groupBy("id", F.expr("pos div 2").alias("pos")).agg(
        F.max(left).alias("l"), F.coalesce(F.max(right), F.lit(-1)).alias("r"))
    names = saved(sorted_names(pairs.groupBy("l", "r").agg(F.count("*").alias("n")).drop("n"), ["l", "r"], "name"))
    return pairs.join(names, ["l", "r"]).select("id", "pos", "name")


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES,
                     hasher: Callable = hashes) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256; of equal texts the largest doc_id stays."""
    named = saved(name_documents(docs.select(doc_id, text), text, block_bytes, hasher).select(
        "id", F.col(f"row.{doc_id}").alias("doc_id"), "sha256", "levels", "name"))
    # Kept, so that the join deals both sides out anew and can split the rows of a large group.
    groups = saved(named.groupBy("levels", "name").agg(
        F.count("*").alias("group_size"), F.max(F.struct("doc_id", "id")).alias("best")))
    return named.join(groups, ["levels", "name"]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("id") == F.col("best.id")).alias("kept"),
        F.col("sha256").alias("text_sha256"))
