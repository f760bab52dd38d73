"""Line dedup: repeated runs of lines are found in a suffix array over line IDs, and later copies are deleted.

Lines with a word get integer IDs, numbered in sorted order of their 128-bit
hashes; a document is the sequence of its IDs. A suffix array is built by
prefix doubling: the rank of a suffix by its first 2k lines is its place among
the sorted pairs (rank by k lines at i, rank by k lines at i + k). Only
suffixes that share their rank go into the next round, as a suffix that is
alone has no copy from there on; rounds end when every suffix is alone.

Suffixes of one rank after k rounds are an interval of the array with a common
prefix of 2^k lines. Its first member in document order (smallest doc_id, then
further up) stays, the others are later copies of these lines. The longest
interval in which a place is a later copy says how far its copy reaches at
least; a repeated run of any length is two of them that overlap, so the union
of overlapping ones gives the maximal runs, and these are deleted.

With `min_words` above 1 a run is deleted only if it has so many words. Then
the intervals of minimal runs are looked up, those that cannot be shortened at
the end or at the start and still have enough words: every maximal run that
counts is a union of them. They have `min_words` lines at most, as a line in a
sequence has a word, so doubling ends there, and two overlapping ranks name
them. Shorter runs stay in place, however often they repeat.

The tasks' keys are ranks, pairs and runs, added up before the shuffle; a line
that a third of all documents share is one row per task. A document is the
largest thing held together; it is known by 128 bits of its doc_id and text.

Defined cases: a null text stays null and has no lines; lines without a word
are not part of a run and stay; a document may end up without lines and is
kept, empty; rows that agree in doc_id and text are one document and share its
result; null doc_ids come last; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickflow.llm.helpers import let, saved, word_count

MIN_WORDS = 1
_DOC = ["doc", "twin"]


def _named(docs: DataFrame, doc_id: str, text: str, *more: Column) -> DataFrame:
    """(doc, twin, doc_id, text): documents by 128 bits of their doc_id and text."""
    keys = [F.col("doc_id"), F.col("digest")]
    rows = docs.select(*more, F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn(
        "digest", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    return rows.withColumns({"doc": F.xxhash64(*keys), "twin": F.xxhash64(F.lit(1), *keys)}).drop("digest")


def _numbered(distinct: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Distinct keys with integers that grow in the order of the keys over all rows."""
    ordered = distinct.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return saved(ordered.withColumn(name, F.monotonically_increasing_id()))


def _shared(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").drop("n")


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, twin, doc_id, line, pos, id, words) of lines that occur twice or more; pos counts lines with a word, line counts all."""
    parts = F.split(F.col("text"), "\n")
    numbered = F.transform(parts, lambda s, i: F.struct(
        i.alias("line"), F.xxhash64(s).alias("a"), F.xxhash64(F.lit(1), s).alias("b"), word_count(s).alias("words")))
    full = let(F.filter(numbered, lambda x: x["words"] > 0), lambda kept: F.transform(kept, lambda x, i: F.struct(
        x["line"].alias("line"), i.alias("pos"), x["a"].alias("a"), x["b"].alias("b"), x["words"].alias("words"))))
    lines = _named(docs, doc_id, text).select(*_DOC, "doc_id", F.explode(full).alias("of")).select(*_DOC, "doc_id", "of.*")
    # Rows that agree in doc_id and text are one document.
    lines = saved(lines.groupBy(*_DOC, "doc_id", "line", "pos", "a", "b", "words").agg(F.count("*").alias("rows")).drop("rows"))
    ids = _numbered(_shared(lines, ["a", "b"]), ["a", "b"], "id")
    return saved(lines.join(ids, ["a", "b"]).select(*_DOC, "doc_id", "line", "pos", "id", "words"))


def suffix_levels(lines: DataFrame, depth: int | None = None) -> list[DataFrame]:
    """(doc, twin, doc_id, pos, rank) by the first 1, 2, 4, ... lines of a suffix, without the suffixes that are alone.

    Up to `depth` lines, or until every suffix is alone.
    """
    levels = [lines.select(*_DOC, "doc_id", "pos", F.col("id").alias("rank"))]
    while depth is None or 2 ** len(levels) <= depth:
        step = 2 ** (len(levels) - 1)
        there = Window.partitionBy(*_DOC).orderBy("pos").rangeBetween(step, step)
        pairs = levels[-1].withColumn("ahead", F.max("rank").over(there)).filter("ahead is not null")
        names = _numbered(_shared(pairs, ["rank", "ahead"]), ["rank", "ahead"], "name")
        if names.isEmpty():
            break
        levels.append(saved(pairs.join(names, ["rank", "ahead"]).select(*_DOC, "doc_id", "pos", F.col("name").alias("rank"))))
    return levels


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), *map(F.col, _DOC), F.col("pos"))


def _later_copies(levels: list[DataFrame]) -> DataFrame:
    """(doc, twin, pos, reach): lines that are later copies, and the end of the longest interval's prefix from there."""
    members = reduce(DataFrame.unionByName, (level.withColumn("depth", F.lit(k)) for k, level in enumerate(levels)))
    interval = ["depth", "rank"]
    # Kept, so that the join deals both sides out anew and can split the rows of a frequent run.
    first = saved(members.groupBy(*interval).agg(F.min(_place()).alias("first")))
    later = members.join(first, interval).filter(_place() > F.col("first"))
    longest = later.groupBy(*_DOC, "pos").agg(F.max("depth").alias("depth"))
    return longest.select(*_DOC, "pos", (F.col("pos") + F.expr("shiftleft(1, depth)")).alias("reach"))


def _long_later_copies(lines: DataFrame, levels: list[DataFrame], min_words: int) -> DataFrame:
    """The same of runs of at least so many words; `reach` is beyond the next line, so that neighbours are one run."""
    ranked = lines.select(*_DOC, "doc_id", "pos", "words")
    for k, level in enumerate(levels):
        ranked = ranked.join(level.select(*_DOC, "pos", F.col("rank").alias(f"r{k}")), [*_DOC, "pos"], "left")
    runs = saved(_minimal_runs(ranked, len(levels) - 1, min_words))
    interval = ["length", "l", "r"]
    first = saved(runs.groupBy(*interval).agg(F.min(_place()).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    later = runs.join(first, interval).filter(_place() > F.col("first"))
    gone = later.select(*_DOC, F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("length") - 1)).alias("pos")).distinct()
    return gone.withColumn("reach", F.col("pos") + 2)


def _minimal_runs(ranked: DataFrame, levels: int, min_words: int) -> DataFrame:
    """(doc, twin, doc_id, pos, length, l, r): runs that cannot be shortened at one of their ends, named by two overlapping ranks."""
    along = Window.partitionBy(*_DOC).orderBy("pos")
    here = F.struct("pos", "words", *(f"r{k}" for k in range(levels + 1)))
    after = F.collect_list(here).over(along.rowsBetween(0, min_words - 1))
    before = F.collect_list(here).over(along.rowsBetween(-(min_words - 1), 0))

    def shortest(lines: Column) -> Column:
        """Number of lines from the first on until there are enough words; null if there is a gap or are too few."""
        state = F.aggregate(lines, F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).alias("n")), lambda s, x: F.when(
            (s["words"] < min_words) & (F.abs(x["pos"] - lines[0]["pos"]) == s["n"]),
            F.struct((s["words"] + x["words"]).alias("words"), (s["n"] + 1).alias("n"))).otherwise(s))
        return let(state, lambda s: F.when(s["words"] >= min_words, s["n"]))

    def named(lines: Column, n: Column) -> Column:
        """The first n of the lines as a run."""
        name = F.lit(None).cast("struct<l:long,r:long>")
        for k in range(levels + 1):
            fits = (n >= 2**k) & (n < 2 ** (k + 1))
            name = F.when(fits, F.struct(lines[0][f"r{k}"].alias("l"), F.get(lines, n - 2**k)[f"r{k}"].alias("r"))).otherwise(name)
        return F.struct(lines[0]["pos"].alias("pos"), n.alias("length"), name.alias("name"))

    def forward(lines: Column) -> Column:
        return let(F.struct(lines.alias("x"), shortest(lines).alias("n")), lambda s: named(s["x"], s["n"]))

    def backward(lines: Column) -> Column:
        size = F.size(lines)
        return let(F.struct(lines.alias("x"), shortest(F.reverse(lines)).alias("n")), lambda s: let(
            F.struct(F.slice(s["x"], size - s["n"] + 1, F.greatest(s["n"], F.lit(0))).alias("x"), s["n"].alias("n")),
            lambda t: F.when(t["n"].isNotNull(), named(t["x"], t["n"]))))
    runs = ranked.select(*_DOC, "doc_id", after.alias("after"), before.alias("before")).select(
        *_DOC, "doc_id", F.explode(F.array_distinct(F.array(let(F.col("after"), forward), let(F.col("before"), backward)))).alias("run"))
    runs = runs.select(*_DOC, "doc_id", "run.pos", "run.length", "run.name.l", "run.name.r")
    return runs.filter("l is not null and r is not null").distinct()


def deleted_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, twin, lines, n_runs, longest_run): the numbers of the lines to delete, for documents that lose any, and the
    number of maximal runs and the lines of the longest."""
    lines = repeated_lines(docs, doc_id, text)
    if min_words <= 1:
        later = _later_copies(suffix_levels(lines))
    else:
        later = _long_later_copies(lines, suffix_levels(lines, min_words), min_words)
    along = Window.partitionBy(*_DOC).orderBy("pos")
    begins = F.coalesce(F.max("reach").over(along.rowsBetween(Window.unboundedPreceding, -1)) <= F.col("pos"), F.lit(True))
    runs = later.withColumn("begins", begins).withColumn("run", F.sum(F.col("begins").cast("int")).over(along))
    runs = runs.join(lines.select(*_DOC, "pos", "line"), [*_DOC, "pos"]).groupBy(*_DOC, "run").agg(F.collect_list("line").alias("lines"))
    return runs.groupBy(*_DOC).agg(
        F.flatten(F.collect_list("lines")).alias("lines"), F.count("*").alias("n_runs"), F.max(F.size("lines")).alias("longest_run"))


def without_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(row, doc_id, n_lines, n_removed, n_runs, longest_run, kept_text): documents as `row`, and the text that is left."""
    gone = saved(deleted_lines(docs, doc_id, text, min_words))
    rows = _named(docs, doc_id, text, F.struct("*").alias("row")).join(gone, _DOC, "left")
    # Numbers of all lines less those to delete: array_except hashes, so long documents cost no more per line.
    left = let(F.split("text", "\n"), lambda all_lines: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("lines")), lambda i: F.get(all_lines, i)))
    kept = F.when(F.col("lines").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))

    def count(value: Column) -> Column:
        return F.coalesce(value, F.lit(0)).cast("long")
    return rows.select(
        "row", "doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines"),
        count(F.size("lines")).alias("n_removed"), count(F.col("n_runs")).alias("n_runs"),
        count(F.col("longest_run")).alias("longest_run"), kept.alias("kept_text"))


def line_report(docs: DataFrame, **how) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256, n_runs, longest_run."""
    out = without_repeated_lines(docs, **how)
    kept = F.sha2(F.coalesce("kept_text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    return out.select("doc_id", "n_lines", "n_removed", kept, "n_runs", "longest_run")


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The documents with the text that is left, in the columns they came with."""
    out = without_repeated_lines(docs, doc_id, text, **how)
    return out.select(*(F.col("kept_text").alias(text) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
