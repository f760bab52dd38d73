"""Quality rules: base rules, and a hashed n-gram log-likelihood ratio of trusted against raw text.

Features are single tokens (runs of letters and digits, runs of other signs)
and pairs of neighbours, hashed into `buckets`. Two multinomials
over the buckets are counted: raw over every document, trusted over every
document whose labels say so, found by a join on the document's id. A
document's score is the mean over its features of log(trusted / raw), both
smoothed; every document with a score under `threshold` is rejected, without
chance.

All of it is built from column expressions. Counting adds up buckets in each
task before the shuffle, so neither a long text nor a frequent pair is a hot
key; texts are dealt out once by id for the labels. Scoring needs no shuffle:
the model is an array of `buckets` numbers, a size that does not grow with the
corpus.

Defined cases: a null text has no words, fails the base rules and is rejected;
a document without features scores 0; without trusted labels, or labels at
all, all scores are 0 and the base rules decide alone; a null doc_id has no label;
rows that share a doc_id share its label, and repeated rows are judged alike; an
empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.helpers import WORD, let, saved

BUCKETS = 1 << 16
THRESHOLD = -0.35
SMOOTHING = 1.0
MIN_WORDS = 50
MOST_REPEATED = 50  # per cent of words
WINDOW = 3
_TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"


def repeated_words(hashes: Column, window: int = WINDOW) -> Column:
    """Number of words in windows of so many words that occur twice or more, from the hashes of all words.

    Hashes of windows are sorted with their position in the lowest bits; of
    neighbours that agree above those bits the whole hashes are compared.
    """
    count = F.size(hashes)

    def gram(i: Column) -> Column:
        return F.xxhash64(*(F.get(hashes, i + k) for k in range(window)))

    def covered(low: Column) -> Column:
        top = F.bitwise_not(low)
        coded = F.transform(F.sequence(F.lit(0), count - window), lambda i: gram(i).bitwiseAND(top).bitwiseOR(i.cast("long")))
        alike = let(F.sort_array(coded), lambda s: F.filter(s, lambda x, i: (
            (F.get(s, i + 1).bitwiseXOR(x).bitwiseAND(top) == 0) | (F.get(s, i - 1).bitwiseXOR(x).bitwiseAND(top) == 0))))
        whole = let(F.transform(alike, lambda x: x.bitwiseAND(low).cast("int")),
                    lambda at: F.sort_array(F.transform(at, lambda i: F.struct(gram(i).alias("g"), i.alias("i")))))
        starts = let(whole, lambda e: F.sort_array(F.transform(F.filter(e, lambda x, i: (
            (F.get(e, i + 1)["g"] == x["g"]) | (F.get(e, i - 1)["g"] == x["g"]))), lambda x: x["i"])))
        return let(starts, lambda at: F.aggregate(
            F.transform(at, lambda s, i: F.least(F.lit(window), F.coalesce(F.get(at, i + 1) - s, F.lit(window)))),
            F.lit(0).cast("long"), lambda total, x: total + x))
    mask = F.pow(F.lit(2.0), F.ceil(F.log2(count + 1.0))).cast("long") - 1
    return F.when(count < window + 1, F.lit(0).cast("long")).otherwise(let(mask, covered))


def _found(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def _hashes(strings: Column) -> Column:
    return F.transform(strings, lambda s: F.xxhash64(s))


def _bucket(hash_: Column, buckets: int) -> Column:
    return F.pmod(hash_, F.lit(buckets)).cast("int")


def features(text: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of the tokens and of the pairs of neighbours; the last token's neighbour is the end."""
    return let(_hashes(_found(text, _TOKEN)), lambda tokens: F.concat(
        F.transform(tokens, lambda t: _bucket(t, buckets)),
        F.transform(tokens, lambda t, i: _bucket(F.xxhash64(t, F.get(tokens, i + 1)), buckets))))


def _mean_ratio(text: Column, ratios: list[float]) -> Column:
    # One constant: folded once when the query is planned.
    model = F.split(F.lit(",".join(f"{r:.6f}" for r in ratios)), ",").cast("array<double>")
    return let(features(text, len(ratios)), lambda f: F.when(F.size(f) == 0, 0.0).otherwise(
        F.aggregate(f, F.lit(0.0), lambda total, bucket: total + F.get(model, bucket)) / F.size(f)))


def measures(text: Column, ratios: list[float]) -> Column:
    """A struct: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and score of a text."""
    text = F.coalesce(text, F.lit(""))
    full = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    return let(_found(text, WORD), lambda words: F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.char_length(F.concat_ws("", words)).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(full, lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")).alias("n_dup_lines"),
        let(_hashes(words), repeated_words).alias("n_repeat_words"),
        _mean_ratio(text, ratios).alias("score")))


def trusted_ids(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Ids of all documents labelled good and not toxic, each once."""
    good = labels.filter("quality = 1 and coalesce(toxic, 0) = 0").select(F.col(doc_id).alias("trusted_id")).distinct()
    return good.filter("trusted_id is not null")


def log_ratios(docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text",
               buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> list[float]:
    """log(trusted / raw) of every bucket."""
    # Texts are dealt out, as they are smaller than their features; by hint, so that the plan is the same at all sizes.
    marked = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(
        trusted.hint("shuffle_hash"), F.col("id") == F.col("trusted_id"), "left")
    each = marked.select(F.col("trusted_id").isNotNull().cast("long").alias("trusted"),
                         F.explode(features(F.col("text"), buckets)).alias("bucket"))
    counts = saved(each.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("trusted").alias("trusted")))
    raw, good = [0] * buckets, [0] * buckets
    for row in counts.collect():  # one row per bucket
        raw[row["bucket"]], good[row["bucket"]] = row["raw"], row["trusted"]
    if not sum(good):
        return [0.0] * buckets
    raw_total, good_total = sum(raw) + smoothing * buckets, sum(good) + smoothing * buckets
    return [math.log((g + smoothing) / good_total) - math.log((r + smoothing) / raw_total) for g, r in zip(good, raw)]


def judged(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS,
           threshold: float = THRESHOLD) -> DataFrame:
    """The documents as `row`, with the base columns, `base_failed`, `score` and `kept`."""
    ratios = log_ratios(docs, trusted_ids(labels), doc_id, text, buckets)
    out = docs.select(F.struct("*").alias("row"), measures(F.col(text), ratios).alias("of")).select("row", "of.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= threshold))


def quality_report(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", **how) -> DataFrame:
    return judged(docs, labels, doc_id, **how).select(
        F.col(f"row.{doc_id}").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.round("score", 6).alias("score"))


def good_documents(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The documents that pass, with all their columns."""
    return judged(docs, labels, **how).filter("kept").select("row.*")
