"""Connected components of a link table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(v, component) for every end of ``links`` (a, b): the smallest end
    that links lead to.

    Each round ties every vertex's larger neighbours to its smallest one
    (large star), then its smaller neighbours to the smallest of these (small
    star), until nothing changes; the number of rounds grows with the
    logarithm of a component's size. Minima are summed up before they are
    shuffled and joined back, so that a vertex with very many links is no
    single task's work. Every round is written to the shared folder.
    """
    pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    before = None
    while True:
        pairs = stored(_small_star(_large_star(pairs)), "stars")
        state = tuple(pairs.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())
        if state == before:
            break
        before = state
    # Now b is the smallest vertex of a's component.
    return pairs.select(F.col("a").alias("v"), F.col("b").alias("component")).union(
        pairs.select(F.col("b").alias("v"), F.col("b").alias("component"))).groupBy("v").agg(F.min("component").alias("component"))


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.select(F.col("a").alias("u"), F.col("b").alias("w")).union(pairs.select(F.col("b").alias("u"), F.col("a").alias("w")))
    least = both.groupBy("u").agg(F.min("w").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("w > u").join(least, "u").select(F.col("w").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("a").agg(F.min("b").alias("m"))
    tied = pairs.join(least, "a")
    return tied.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
        least.select("a", F.col("m").alias("b"))).distinct()
