"""Connected components of a link table, as joins and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almenara.llm.tables import release, stored


def _settled(links: DataFrame) -> bool:
    """Whether every node has one link, to a node that has none of its own: one count, no join."""
    ends = links.select("a", F.lit(1).alias("out"), F.lit(0).alias("into")).union(links.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("a").agg(F.sum("out").alias("out"), F.sum("into").alias("into")).where("out > 1 OR (out > 0 AND into > 0)").isEmpty()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable node (``root``) of every ``node`` in ``links`` (``a``, ``b``).

    Large-star and small-star steps in turn, until every link leads to its
    root; the rounds grow with the logarithm of the longest path. Each round's
    links are written to the shared folder, and so are the minima: only a join of
    two plain shuffles is split by adaptive execution, and a node may have a
    third of all links.
    Links from a node to itself and null ends are ignored; no links, no rows.
    """
    clean = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    now = stored(clean.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(max_rounds):
        if _settled(now):
            break
        both = now.union(now.select("b", "a"))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")), "least")
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        large = stored(large.where("a <> b").distinct(), "large")
        low = stored(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        now = stored(small.where("a <> b").distinct(), "links")
        release(links.sparkSession)
    else:
        if not _settled(now):
            raise RuntimeError(f"components not settled after {max_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
