"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratawell.session import materialize, release


def _large_star(links: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the node's smallest neighbour instead."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its neighbours below are tied to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    # The row of the smallest neighbour ties the node itself, so that no second reading of ``least`` is joined on.
    upper = F.when(F.col("b") == F.col("least"), F.col("a")).otherwise(F.col("b"))
    return down.join(least, "a").select(upper.alias("a"), F.col("least").alias("b")).distinct()


def _is_stars(links: DataFrame) -> bool:
    """Whether every node of distinct (a, b) has either one link up to a root or none, which no round changes."""
    ends = links.select(F.inline(F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("ties"), F.lit(0).alias("leads")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("ties"), F.lit(1).alias("leads")),
    )))
    nodes = ends.groupBy("node").agg(F.sum("ties").alias("ties"), F.max("leads").alias("leads"))
    return nodes.where("ties + leads > 1").agg(F.count("*")).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """(a, b) links between long ids to (node, root): root is the smallest id of the component.

    Roots themselves, and nodes without a link to another one, do not appear. The rounds grow with the logarithm of the
    longest chain; each reads ``links``, or what the round before it wrote to the shared folder. Rows of an earlier
    result may be among the links; with links between its roots a round or two are enough. A node with very many links
    is summed before the shuffle and split by adaptive joins, never gathered.
    """
    state = links.where("a <> b").select("a", "b")
    while True:
        before, state = state, materialize(_small_star(_large_star(state)))
        release(before)
        if _is_stars(state):
            return state.select(F.col("a").alias("node"), F.col("b").alias("root"))
