"""Mixing sources to target weights by Pareto order sampling.

Targets: sources in code point order (null last) weigh `weights`, repeating,
and share `share` times all words; a target stops at `most` times its source's
words, and the excess is shared by weight again until none is above.

Copies: with a target of m times its source's words, every document of the
source gets floor(m) whole copies for certain. What is left of the target, R
words, is drawn without replacement, with inclusion odds in proportion to a
document's words (so that R words are expected); a document whose probability
would reach one is taken for certain. The others are ranked by Pareto's
quotient, random odds over inclusion odds, u/(1-u) / (p/(1-p)), and the sample
is the beginning of that order whose words come nearest to R: its size is
fixed in words, off by half a document at most. u is a hash of seed, doc_id
and text, so reruns agree.

Running words of a source come from a sort by ranges, so a source with a third
of all rows is spread over many tasks. Words of a source are first added up by
document size; one task holds the distinct sizes of a source, not its rows.

Defined cases: a null text has no words and is taken 0 times; a null source is
a source; rows that agree in doc_id, source and text share one draw; an empty
table, or one without words, gives targets of 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickflow.llm.helpers import in_order, same, saved, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = "mix-1"
_KEYS = ["doc_id", "source", "digest"]


def _keyed(docs: DataFrame, doc_id: str, text: str, source: str) -> list:
    return [F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
            F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("digest")]


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """(source, source_size) to the same with `target`, in words."""
    ranked = in_order(sizes, [F.col("source").asc_nulls_last()])
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("position") % len(weights) + 1).cast("int"))
    capped = ranked.withColumns({"weight": weight.cast("long"), "cap": F.col("source_size") * most}).drop("position")
    order = [F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()]
    filling = saved(in_order(capped, order, ["cap", "weight"]))
    words, weights_sum = filling.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    filling = filling.withColumns({
        "left": F.lit(float(share) * words) - F.col("before_cap"), "others": F.lit(weights_sum) - F.col("before_weight")})
    filling = filling.withColumn("full", F.col("cap") * F.col("others") <= F.col("left") * F.col("weight"))
    open_left, open_weight = filling.filter(~F.col("full")).agg(F.max("left"), F.max("others")).first()
    even = F.lit(open_left) / F.lit(open_weight) * F.col("weight")
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(even.cast("double"))
    return filling.select("source", "source_size", target.alias("target"))


def _draws(units: DataFrame, targets: DataFrame, seed: str) -> DataFrame:
    """Keys of what is drawn on top of the whole copies; each at most once."""
    plan = targets.filter("source_size > 0").select(
        "source", "whole", (F.col("target") - F.col("whole") * F.col("source_size")).alias("rest"))
    sizes = units.filter("size > 0").groupBy("source", "size").agg(F.sum("rows").alias("rows"))
    sizes = sizes.join(plan.alias("p"), sizes.source.eqNullSafe(F.col("p.source"))).drop(F.col("p.source"))
    larger = Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    smaller = Window.partitionBy("source").orderBy("size")
    words = F.col("size") * F.col("rows")
    squares = (F.col("size").cast("decimal(19,0)") * F.col("size").cast("decimal(19,0)")).cast("decimal(28,0)") * F.col("rows").cast("decimal(19,0)")
    sizes = sizes.withColumns({
        "above": F.coalesce(F.sum(words).over(larger), F.lit(0)),
        "below": F.sum(squares).over(smaller).cast("double")})
    sizes = sizes.withColumn("certain", (F.col("rest") - F.col("above")) * F.col("size") >= F.col("below"))
    per_source = saved(sizes.groupBy("source").agg(
        F.max("rest").alias("rest"),
        F.coalesce(F.sum(F.when(F.col("certain"), words)), F.lit(0)).alias("certain_words"),
        F.min(F.when(F.col("certain"), F.col("size"))).alias("certain_from"),
        F.max(F.when(~F.col("certain"), F.col("below"))).alias("below")))
    per_source = per_source.withColumn("rest", F.col("rest") - F.col("certain_words")).withColumnRenamed("source", "of")

    chance = F.col("rest") / F.col("below") * F.col("size")
    number = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string"), F.col("digest"))), 1, 13), 16, 10)
    known = units.filter("size > 0").join(per_source, units.source.eqNullSafe(F.col("of"))).drop("of")
    certain = known.filter(F.col("size") >= F.col("certain_from")).select(*_KEYS)
    others = known.filter((F.col("size") < F.coalesce("certain_from", F.lit(2**62))) & (F.col("rest") > 0)).withColumns({
        "u": (number.cast("double") + 0.5) / F.lit(float(2**52)), "chance": chance, "words": F.col("size") * F.col("rows")})
    quotient = (F.col("u") * (1 - F.col("chance"))) / ((1 - F.col("u")) * F.col("chance"))
    others = others.select(*_KEYS, "rest", "words", quotient.alias("quotient"))
    order = [F.col("source").asc_nulls_last(), F.col("quotient"), F.col("doc_id").asc_nulls_last(), F.col("digest")]
    running = saved(in_order(others, order, ["words"]).drop("position"))
    starts = running.groupBy(F.col("source").alias("of")).agg(F.min("before_words").alias("start"))
    drawn = running.join(starts, running.source.eqNullSafe(F.col("of"))).filter(
        F.col("before_words") - F.col("start") + F.col("words") / 2 <= F.col("rest")).select(*_KEYS)
    return certain.unionByName(drawn)


def mix_plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
             weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = SEED) -> DataFrame:
    """One row per (doc_id, source, digest): size, rows (that agree in all of them), source_size, target, copies of each row."""
    rows = docs.select(*_keyed(docs, doc_id, text, source), word_count(F.col(text)).alias("size"))
    units = saved(rows.groupBy(*_KEYS).agg(F.max("size").alias("size"), F.count("*").alias("rows")))
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    targets = source_targets(sizes, weights, share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = saved(targets.withColumn("whole", whole.cast("long")))
    extra = _draws(units, targets, seed).withColumn("extra", F.lit(1))
    out = units.alias("u").join(extra.alias("e"), same("u", "e", _KEYS), "left").select("u.*", "extra")
    out = out.join(targets.alias("t"), out.source.eqNullSafe(F.col("t.source"))).drop(F.col("t.source"))
    copies = F.when(F.col("size") > 0, F.col("whole") + F.coalesce("extra", F.lit(0))).otherwise(0)
    return out.select(*_KEYS, "size", "rows", "source_size", "target", copies.cast("long").alias("copies"))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns they came with."""
    plan = mix_plan(docs, doc_id, text, source, **how).filter("copies > 0").select(*_KEYS, "copies")
    rows = docs.select(F.struct("*").alias("row"), *_keyed(docs, doc_id, text, source))
    taken = rows.alias("r").join(plan.alias("p"), same("r", "p", _KEYS)).select(
        "r.row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("p.copies"))).alias("copy"))
    return taken.select("row.*")


def mix_report(docs: DataFrame, **how) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted), and its source and copies."""
    plan = mix_plan(docs, **how)
    each = plan.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return each.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                       "source", "copies")
