"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


def _with_least(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) with the least b of each a, or a itself, as m."""
    least = pairs.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("m"))
    return pairs.join(least, F.col("a") == F.col("of")).select("a", "b", F.least("a", "m").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _with_least(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _with_least(down)
    return least.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
        least.select("a", F.col("m").alias("b"))
    )


def components(links: DataFrame) -> DataFrame:
    """From (node, root) links, whose roots are nodes too: each node once with the least node of its component.

    Rounds until nothing changes, a number that grows with the logarithm of the longest path. A component
    that is a star from the start needs one. Every round is written.
    """
    a, b = links.columns
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b"))
    nodes = pairs.select("a").union(pairs.select(F.col("b").alias("a"))).distinct()
    now = written(pairs.where("a <> b").distinct(), "components")
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        after = written(_small_star(_large_star(now).distinct()).where("a <> b").distinct(), "components")
        changed = after.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        now = after
        if state == changed:
            break
    rooted = nodes.join(now, "a", "left")
    return rooted.select(F.col("a").alias("node"), F.coalesce("b", "a").alias("root"))
