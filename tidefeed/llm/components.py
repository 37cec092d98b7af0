"""Connected components of a table of links, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.llm.shared import scratch, staged

#: Links in a file of a step's table, on average.
LINKS = 500_000


def components(links: DataFrame) -> DataFrame:
    """(id, component): each linked id with the smallest id it can reach.

    ``links`` has longs a and b. Every step moves links towards smaller ids: first each id's
    larger neighbours, then all others, to the smallest neighbour. It is written as a table. The
    steps end when what is left are stars, after about the logarithm of a component's size.
    """
    with scratch(links.sparkSession):
        return _contracted(links)


def _contracted(links: DataFrame) -> DataFrame:
    pairs = links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    pairs = staged(pairs.distinct(), "links")
    files = max(1, pairs.count() // LINKS)
    while True:
        both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.where("b > a")
            .join(least, "a")
            .select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
            .distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
            F.col("m").alias("b"),
        )
        pairs = staged(small.where("a <> b").distinct().coalesce(files), "links")
        # stars: every id has one smaller neighbour, or larger ones only
        sides = pairs.select("a", F.lit(1).alias("down"), F.lit(0).alias("up")).unionAll(
            pairs.select("b", F.lit(0), F.lit(1))
        )
        sides = sides.groupBy("a").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
        if sides.where("down > 1 OR (down = 1 AND up = 1)").isEmpty():
            break
    heads = pairs.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    found = pairs.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(heads)
    return staged(found.coalesce(files), "components", keep=True)
