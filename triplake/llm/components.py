"""Connected components of a link table, as DataFrame joins.

Each round, every node that has a smaller neighbour points to its smallest
one; pointers are followed by doubling until they end at a root, and the links
are rewritten between roots.  Rounds go on until no link joins two roots.  All
steps are joins and partial aggregations over link and node tables, so neither
a large component nor a hub meets in one task.  Every round is written to the
shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplake.plans.materialize import materialize


def _follow(pointer: DataFrame) -> DataFrame:
    """Pointers (node, up) with ``up`` < ``node``, followed to their roots."""
    while True:
        above = pointer.select(F.col("node").alias("up"), F.col("up").alias("_above"))
        longer = pointer.join(above, "up", "left").select(
            "node", F.coalesce("_above", "up").alias("up"), F.col("_above").isNotNull().alias("_moved")
        )
        pointer = materialize(longer, "pointers")
        if pointer.where("_moved").isEmpty():
            return pointer.select("node", "up")
        pointer = pointer.select("node", "up")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v): the smallest node
    that links reach.  Links have no direction; loops, repeated links and
    links with a null end are ignored."""
    edges = materialize(
        links.where("u <> v")
        .select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo"))
        .distinct(),
        "links",
    )
    found: DataFrame | None = None
    while not edges.isEmpty():
        roots = _follow(edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("up")))
        if found is None:
            found = roots
        else:
            moved = roots.select(F.col("node").alias("up"), F.col("up").alias("_root"))
            kept = found.join(moved, "up", "left").select("node", F.coalesce("_root", "up").alias("up"))
            found = materialize(kept.unionByName(roots.join(found.select("node"), "node", "left_anti")), "components")
        up = roots.select("node", "up")
        edges = (
            edges.join(up.select(F.col("node").alias("hi"), F.col("up").alias("_a")), "hi", "left")
            .join(up.select(F.col("node").alias("lo"), F.col("up").alias("_b")), "lo", "left")
            .select(F.coalesce("_a", "hi").alias("a"), F.coalesce("_b", "lo").alias("b"))
            .where("a <> b")
            .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
            .distinct()
        )
        edges = materialize(edges, "links")
    if found is None:
        kind = dict(edges.dtypes)["hi"]
        return edges.select(F.col("hi").alias("node"), F.col("lo").cast(kind).alias("component"))
    roots = found.select(F.col("up").alias("node")).distinct().withColumn("up", F.col("node"))
    return found.unionByName(roots).select("node", F.col("up").alias("component"))
