"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailseq.session import written_table


def components(links: DataFrame, on_round: Callable[[int], None] | None = None) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is the smallest node reachable.

    Every node has a parent, at first its smallest neighbour if that is smaller. In a round it looks at the grandparents of
    its neighbours. The smallest of these becomes the parent of the node and of the node's own parent, if it is
    smaller than what they have, and then everyone moves up to its grandparent. Moving parents, not only nodes, merges whole
    trees at once, so a chain of n nodes takes about log n rounds in whatever order its nodes are numbered. Every round
    is written to the shared folder; ``on_round`` is told its number.
    """
    edges = written_table(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "component-edges")
    state = written_table(
        edges.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("parent")), "component-parents")
    number = 0
    while True:
        number += 1
        if on_round:
            on_round(number)
        up = state.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        tops = state.join(up, "parent").select("node", "parent", "grand")
        near = edges.join(tops.select(F.col("node").alias("b"), "grand"), "b").groupBy("a").agg(
            F.min("grand").alias("near"))
        seen = written_table(tops.join(near, tops["node"] == near["a"]).select("node", "parent", "grand", "near"), "component-seen")
        hooked = seen.groupBy(F.col("parent").alias("node")).agg(F.min("near").alias("hook"))
        following = written_table(seen.join(hooked, "node", "left").select(
            "node", F.col("parent").alias("old"),
            F.least("grand", "near", F.coalesce("hook", "near")).alias("parent")), "component-parents")
        changed = following.where("parent < old").limit(1).count()
        state = following.select("node", "parent")
        if not changed:
            return state.select("node", F.col("parent").alias("component"))
