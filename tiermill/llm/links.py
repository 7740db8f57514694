"""Connected components of links between documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.plans.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b): the smallest node it reaches, by alternating star steps.

    Each node's smallest and greatest neighbour tell whether only stars are left; then they are the result, so nothing is
    run again to see that it stays.  Steps never add edges, so repeated ones are not looked for; the second step drops most.
    Every step is written to the shared folder.  Minima are combined before the shuffle; the joins are plain ones, whose
    hot keys adaptive execution splits.
    """
    now = edges.where("a <> b").select("a", "b")
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ends = stage(both.groupBy("a").agg(F.min("b").alias("lo"), F.max("b").alias("hi")), "ends")
        low = ends.select("a", F.least("a", "lo").alias("m"))
        if ends.where("lo < a and lo <> hi").isEmpty():  # who has a smaller neighbour has no other
            return low.toDF("node", "component")
        now = stage(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")), "large-star")
        low = now.groupBy("a").agg(F.min("b").alias("m"))
        small = now.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stage(small.union(low.select("a", F.col("m").alias("b"))), "small-star")
