"""Connected components of an edge list by repeated contraction towards the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.session import Scratch


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 100) -> DataFrame:
    """``(node, component)``: every node of an edge with the smallest node it is connected to.

    Nodes are numbered once, exactly: two nodes never share a number, whatever their names. In each
    round every node that still has an edge moves to its smallest neighbour, and on to where that
    one moves, and edges are rewritten to the new ends; loops and repeated edges vanish. The order of the numbers is mixed, so no
    order of the rows makes long chains. The number of edges falls by a constant factor, so the
    rounds grow with the logarithm of the graph, and so do the tables of moves: they are put
    together at the end, the smallest first. Neighbours are reduced by a minimum, combined before
    the shuffle, so a node with a third of all edges costs no more than others. Each round is
    written to the shared folder, which cuts the lineage and survives lost executors.

    Edges with a null end are ignored; a loop gives its node as a component of its own; an empty
    list gives an empty result.
    """
    spark = edges.sparkSession
    scratch = Scratch(spark, "components")
    named = scratch.table(edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a IS NOT NULL AND b IS NOT NULL").distinct())
    nodes = named.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    # the hash of one long number is a bijection, so it mixes the order without collisions
    nodes = scratch.table(nodes.select("node", F.xxhash64(F.monotonically_increasing_id()).alias("at")))
    one, two = nodes.select(F.col("node").alias("a"), F.col("at").alias("u")), nodes.select(F.col("node").alias("b"), F.col("at").alias("v"))
    ends = named.where("a <> b").join(one, "a").join(two, "b")
    links, links_at = scratch.keep(ends.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    moves: list[DataFrame] = []
    while not links.isEmpty():
        if len(moves) == max_rounds:
            raise RuntimeError(f"no end after {max_rounds} rounds")
        both = links.union(links.select("v", "u"))
        near = both.groupBy("u").agg(F.least("u", F.min("v")).alias("to"))
        on = near.select(F.col("u").alias("to"), F.col("to").alias("far"))
        step = scratch.table(near.join(on, "to").select("u", F.col("far").alias("to")))
        ends = (
            links.join(step.select("u", F.col("to").alias("x")), "u")
            .join(step.select(F.col("u").alias("v"), F.col("to").alias("y")), "v")
            .where("x <> y")
            .select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v"))
            .distinct()
        )
        old, (links, links_at) = links_at, scratch.keep(ends)
        scratch.drop(old)
        moves.append(step)
    place = nodes
    if moves:
        final = moves[-1]
        for step in reversed(moves[:-1]):
            after = final.select(F.col("u").alias("to"), F.col("to").alias("root"))
            final = step.join(after, "to", "left").select("u", F.coalesce("root", "to").alias("to"))
        place = nodes.join(final.withColumnRenamed("u", "at"), "at", "left").select("node", F.coalesce("to", "at").alias("at"))
        place = scratch.table(place)
    names = place.groupBy("at").agg(F.min("node").alias("component"))
    return place.join(names, "at").select("node", "component")
