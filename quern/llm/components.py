"""Connected components of an edge table, by alternating stars.

Every step is a grouped minimum and a join, so a vertex with very many edges is aggregated before it
is shuffled, and its join partition can be split. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component): the smallest vertex reachable, for vertices of ``edges`` (a, b: long).

    Self-loops and repeated edges do no harm; vertices without edges are not listed.
    """
    pairs = edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("v > u").distinct()
    pairs = written(pairs, "edges")
    before = None
    while True:
        now = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
        if now == before or now[0] == 0:
            break
        before = now
        # Each vertex hands its larger neighbours to the least vertex around it ...
        both = pairs.select("v", "u").union(pairs.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        # ... and then its smaller ones.
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v")
        small = small.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u")).union(least.select("v", F.col("m").alias("u")))
        pairs = written(small.distinct(), "edges")
    roots = pairs.select(F.col("u").alias("vertex")).distinct().withColumn("component", F.col("vertex"))
    return pairs.select(F.col("v").alias("vertex"), F.col("u").alias("component")).union(roots)
