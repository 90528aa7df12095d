"""Connected components by least labels, with stored rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidegrid.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``key`` and ``label`` of every node of ``edges``; the label is the least key of its component.

    In each round a node takes the least label among itself and its neighbours, and then the label of that label, so long
    chains shrink by steps of growing length. All rounds are joins and map-side combined minima; nothing but the number of
    changed labels reaches the driver.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v")
    both = stored(both.union(both.select("v", "u")).distinct())
    labels = stored(both.groupBy(F.col("u").alias("key")).agg(F.least(F.min("v"), F.col("key")).alias("label")))
    while True:
        known = labels.select(F.col("key").alias("u"), F.col("label").alias("seen"))
        near = both.join(known, "u").groupBy(F.col("v").alias("key")).agg(F.min("seen").alias("seen"))
        met = labels.join(near, "key").select("key", F.col("label").alias("was"), F.least("label", "seen").alias("label"))
        met = stored(met)
        jump = met.select(F.col("key").alias("label"), F.col("label").alias("onward"))
        new = stored(met.join(jump, "label", "left").select("key", "was", F.least("label", "onward").alias("label")))
        labels = new.select("key", "label")
        if new.where("label != was").isEmpty():
            return labels


def joined(labels: DataFrame, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Labels of the components that ``labels`` and further ``edges`` make together; only the new links are gone over."""
    at = lambda side: labels.select(F.col("key").alias(side), F.col("label").alias(f"{side}_label"))
    ends = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).join(at("a"), "a", "left").join(at("b"), "b", "left")
    links = stored(ends.select("a", "b", F.coalesce("a_label", "a").alias("u"), F.coalesce("b_label", "b").alias("v")))
    moved = components(links, "u", "v").withColumnRenamed("label", "onward").withColumnRenamed("key", "label")
    lone = links.select(F.col("a").alias("key"), F.col("u").alias("label")).union(links.select("b", "v")).where("key = label")
    known = labels.unionByName(lone.distinct().join(labels, "key", "left_anti"))
    return stored(known.join(moved, "label", "left").select("key", F.coalesce("onward", "label").alias("label")))
