"""Connected components by contraction, on tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b); component is its smallest node.

    Each round maps a node to the first of itself and its neighbours and draws the edges between the images.
    Odd rounds order nodes by id, which folds a star around its smallest node at once; even rounds by
    a hash of id and round, which folds long chains by a constant factor. Every round is stored.
    """
    links = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    nodes = stored(links.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
    labels = nodes.withColumn("root", F.col("node"))
    turn = 0
    while not links.isEmpty():
        turn += 1
        order = F.col("v") if turn % 2 else F.xxhash64(F.lit(turn), "v")
        near = links.select(F.explode(F.expr("array(struct(a as u, b as v), struct(b as u, a as v), struct(a as u, a as v), struct(b as u, b as v))")).alias("e"))
        first = near.select("e.*").groupBy("u").agg(F.min(F.struct(order.alias("order"), "v"))["v"].alias("to"))
        first = stored(first, "images")
        image_a, image_b = first.toDF("a", "a_to"), first.toDF("b", "b_to")
        links = links.join(image_a, "a").join(image_b, "b").where("a_to <> b_to")
        links = links.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct()
        links = stored(links, "links")
        labels = labels.join(first.toDF("root", "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        labels = stored(labels, "labels")
    smallest = stored(labels.groupBy("root").agg(F.min("node").alias("component")), "smallest")
    return labels.join(smallest, "root").select("node", "component")
