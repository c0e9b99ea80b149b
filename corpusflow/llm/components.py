"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.session import materialize


def _ordered(edges: DataFrame) -> DataFrame:
    """The edges as (a, b) with a larger than b, without loops and nulls."""
    edges = edges.toDF("a", "b").where("a <> b")
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def star_step(edges: DataFrame) -> DataFrame:
    """A large-star and a small-star step on written edges (a larger than b), four exchanges in all.

    Large star: every larger neighbour of a node moves to the node's smallest one, which is
    among the smaller ones or the node itself. Nodes with very many larger neighbours are keys of a
    join only, which Spark may split. Small star: a node and its smaller neighbours move to the smallest of them.
    """
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least.toDF("b", "least"), "b", "left").select("a", F.coalesce("least", "b").alias("b"))
    near = moved.withColumn("least", F.min("b").over(Window.partitionBy("a")))
    return near.select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b")).where("a <> b").distinct()


def least_neighbours(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes that have a smaller neighbour: connected where equal, not yet equal wherever connected."""
    return edges.toDF("a", "b").groupBy("a").agg(F.min("b").alias("b")).toDF("node", "component")


def joined(edges: DataFrame) -> DataFrame:
    """Edges with the same components, one step nearer to stars around the components' smallest nodes."""
    return materialize(star_step(materialize(_ordered(edges), "components")), "components")


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: no node has two smaller neighbours, or is a smaller one and has one."""
    ends = edges.select("a", "b").union(edges.select("b", "b")).groupBy("a").agg((F.min("b") < F.max("b")).alias("open"))
    return not ends.agg(F.max("open")).head()[0]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): each node of an edge and the smallest node that it reaches.

    edges: two columns of ids. Loops, repeated edges and edges with nulls do not
    matter. Each round is written to the shared folder, which cuts the lineage.
    """
    edges = materialize(_ordered(edges), "components")
    while not _settled(edges):
        edges = materialize(star_step(edges), "components")
    edges = edges.distinct()
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
