"""Connected components of a table of links, by hooking, pointer jumping and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from larder.workspace import stage


def _hook(links: DataFrame) -> DataFrame:
    """``(node, parent)``: the smallest of each node and its neighbours."""
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
        links.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    return both.groupBy("node").agg(F.least("node", F.min("other")).alias("parent"))


def _follow(pointers: DataFrame, by: DataFrame) -> DataFrame:
    """``pointers`` with each parent replaced by what ``by`` makes of it."""
    step = by.select(F.col("node").alias("parent"), F.col("parent").alias("onward"))
    return pointers.join(step, "parent", "left").select(
        "node", F.coalesce("onward", "parent").alias("parent")
    )


def components(links: DataFrame) -> DataFrame:
    """``(node, parent)`` for every node in ``links`` (``a, b``): ``parent`` is the smallest
    node reachable.

    Each round every node hooks onto its smallest neighbour, pointers are followed twice, and the
    links between what is left are drawn anew. Rounds grow with the logarithm of the longest path;
    each is written, so a lost executor repeats only the round at hand. Nothing but a count
    reaches the driver.
    """
    left = stage(links.select("a", "b").filter("a != b").distinct(), "links")
    found: DataFrame | None = None
    while not left.isEmpty():
        hooked = stage(_hook(left), "hooks")
        hooked = stage(_follow(_follow(hooked, hooked), hooked), "jumps")
        # Whatever is left is a parent of before, so the new pointers only lead further.
        found = hooked if found is None else stage(_follow(found, hooked), "parents")
        ends = left
        for end in ("a", "b"):
            to = hooked.select(F.col("node").alias(end), F.col("parent").alias(f"{end}_root"))
            ends = ends.join(to, end)
        left = stage(
            ends.select(
                F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")
            )
            .filter("a != b")
            .distinct(),
            "links",
        )
    if found is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("parent"))
    return found
