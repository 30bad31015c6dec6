"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repodw.session import written

JUMPS = 3


def _each(*ends: tuple[str, str]) -> Column:
    """A row (a, b) for each of these pairs of columns, from one pass over a table."""
    return F.inline(F.array(*[F.struct(F.col(a).alias("a"), F.col(b).alias("b")) for a, b in ends]))


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b), the component being its least node.

    Each round hooks every label to the least label it is linked with, follows the hooks further, and keeps the links
    between different labels; what is left shrinks from round to round. Sums are reduced before they are
    shuffled, and what a round hands on is written to shared storage. No links give no rows.

    A round is four queries of few shuffles: what the driver holds of plans, their metrics and threads follows the number
    of queries and shuffles, however small the tables are.
    """
    ends = written(links.select(_each(("a", "b"), ("b", "a"), ("a", "a"), ("b", "b"))).distinct(), "ends")
    live = ends.filter("a <> b")
    labels = ends.filter("a <=> b").select(F.col("a").alias("node"), F.col("b").alias("component"))
    while not live.isEmpty():
        hooks = live.groupBy(F.col("a").alias("label")).agg(F.least(F.first("a"), F.min("b")).alias("hook"))
        hooks = written(hooks, "hooks")
        # Follow the hooks of hooks, three times over, so that a chain shrinks to a quarter in a round; where a hook is
        # hooked further still, the two stay linked for the next round.
        beyond = hooks.select(F.col("label").alias("hook"), F.col("hook").alias("beyond"))
        far = hooks
        for _ in range(JUMPS):
            far = far.join(beyond, "hook", "left").select("label", F.coalesce("beyond", "hook").alias("hook"))
        far = written(far, "far")
        labels = written(labels.join(far, F.col("component") == F.col("label"), "left").select(
            "node", F.coalesce("hook", "component").alias("component")), "labels")
        chains = far.join(beyond, "hook").filter("hook <> beyond").select(_each(("hook", "beyond"), ("beyond", "hook")))
        of_a = far.select(F.col("label").alias("a"), F.col("hook").alias("x"))
        of_b = far.select(F.col("label").alias("b"), F.col("hook").alias("y"))
        moved = live.join(of_a, "a").join(of_b, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        live = written(moved.unionByName(chains).filter("a <> b").distinct(), "live")
    return labels
