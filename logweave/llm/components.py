"""Connected components: locally over arrays, and over a distributed table of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.storage import staged


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes, the smallest node it reaches over the links ``a[i]-b[i]``."""
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        while not np.array_equal(jumped := label[label], label):
            label = jumped
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b): root is the smallest node it reaches.

    Large-star and small-star rounds: joins and grouped minima only, so that a
    node with many links is never gathered in one place. Each round's links
    are written to the shared folder; the loop ends when a round changes nothing.
    """
    def star(pairs: DataFrame) -> DataFrame:
        return pairs.where("hi != lo").distinct()

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())

    table = staged(star(links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))), name)
    seen = mark(table)
    while seen[0]:
        both = table.select("hi", "lo").union(table.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("least")).select("hi", F.least("hi", "least").alias("least"))
        large = star(both.join(least, "hi").where("lo > hi").select(F.col("lo").alias("hi"), F.col("least").alias("lo")))
        least = large.groupBy("hi").agg(F.min("lo").alias("least"))
        met = large.join(least, "hi")
        table = staged(star(least.select("hi", F.col("least").alias("lo")).union(
            met.select(F.col("lo").alias("hi"), F.col("least").alias("lo")))), name)
        before, seen = seen, mark(table)
        if before == seen:
            break
    return table.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
        table.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
