"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starpipe.sources.io import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges(a, b)``; label is the smallest
    node of its component.

    Contraction: in each round every node moves to that node, among itself and
    its neighbours, whose hash under the round's seed is least, and the edges
    are drawn between the nodes moved to. Of every edge one end moves, so each
    round leaves fewer nodes; as the seeds make the order a new random one each
    time, a fixed share of the nodes with edges is expected to go, whatever the
    shape of the graph (a chain of n nodes: about log n rounds). What is left at the end is one
    node a component. Then the moves are read backwards, from the smallest
    table to the largest, so all rounds together cost about as much as the
    first. Every table is written to the shared folder, which cuts the lineage;
    only whether edges are left reaches the driver.
    """
    pairs = materialize(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a <> b").distinct(), "edges")
    moves: list[DataFrame] = []
    while not pairs.isEmpty():
        seed = F.lit(len(moves))
        near = pairs.groupBy("a").agg(F.min(F.struct(F.xxhash64("b", seed).alias("h"), "b")).alias("m"))
        own = F.struct(F.xxhash64("a", seed).alias("h"), F.col("a").alias("b"))
        to = materialize(near.select(F.col("a").alias("node"), F.least(own, "m")["b"].alias("head")), "moves")
        moves.append(to)
        pairs = materialize(
            pairs.join(to, pairs.a == to.node).select(F.col("head").alias("a"), "b")
            .join(to.withColumnRenamed("head", "to"), F.col("b") == F.col("node")).select("a", F.col("to").alias("b"))
            .where("a <> b").distinct(), "edges")
    if not moves:
        return pairs.select(F.col("a").alias("node"), F.col("b").alias("label"))
    heads = moves[-1]
    for to in reversed(moves[:-1]):
        later = heads.select(F.col("node").alias("head"), F.col("head").alias("last"))
        heads = materialize(to.join(later, "head", "left").select("node", F.coalesce("last", "head").alias("head")), "heads")
    least = heads.groupBy("head").agg(F.least(F.min("node"), F.col("head")).alias("label"))
    return materialize(heads.join(least, "head").select("node", "label"), "labels")
