"""Connected components of a table of links, each named by its smallest node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.helpers import saved


def components(links: DataFrame) -> DataFrame:
    """(a, b) to (node, root) for all nodes that are linked and not the smallest of their component.

    Alternating steps: every node hands its larger neighbours to its smallest
    one, then its smaller neighbours. Links never grow in number, a component
    ends as a star around its smallest node, and rounds grow with the logarithm
    of its size. Smallest neighbours are found by aggregation, so a node with
    very many links is combined before the shuffle.
    """
    pairs = links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi > lo")
    pairs, before = saved(pairs.distinct()), None
    while True:
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        before = state
        both = pairs.unionByName(pairs.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.least(F.min("lo"), F.first("hi")).alias("m"))
        large = both.filter("lo > hi").join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).distinct()
        large = saved(large)
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").select(F.explode(F.array(
            F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")),
            F.struct(F.col("hi"), F.col("m").alias("lo")))).alias("e")).select("e.*").filter("hi > lo")
        pairs = saved(small.distinct())
