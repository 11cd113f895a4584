"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harkline.session import written


def _state(links: DataFrame) -> tuple:
    """Number and order-free digest of the links; equal when a round changed nothing."""
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
    return tuple(row)


def _smallest(pairs: DataFrame) -> DataFrame:
    """Smallest of each node and its neighbours; combines before the shuffle."""
    return pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest node it knows."""
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return (
        both.where("b > a").join(_smallest(both), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    smallest = _smallest(down)
    linked = down.join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionAll(smallest.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """`node` and `root` (the smallest node reachable) for every node of the links `a`, `b`.

    Node ids are numbers or strings with an order. Links of a node to itself and repeated
    links are allowed; null ends are left out. The rounds run on written tables, so lost
    executors cost no more than the round; their number grows with the logarithm of the
    longest path. A node with many links is combined before each shuffle, and the joins
    are plain ones that adaptive execution splits.
    """
    links = links.select("a", "b").where("a is not null and b is not null and a <> b")
    links = written(links.distinct(), name)
    state = _state(links)
    while state[0]:
        links = written(_small_star(written(_large_star(links), name)), name)
        before, state = state, _state(links)
        if state == before:
            break
    members = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return members.unionAll(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
