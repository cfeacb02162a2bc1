"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studytrail.llm import tables


def components(edges: DataFrame, store=tables.stored) -> DataFrame:
    """(key, comp) of every end of an edge (a, b): comp is the smallest key of its component.

    In each round every vertex joins its smallest neighbour, if that is smaller, and the graph is contracted; a round
    leaves at most half of the vertices that have edges, so rounds are few. Rounds end in a table of the shared folder;
    the tables of the rounds are removed at the end, ``store`` keeps the result.
    """
    with tables.Scratch(edges.sparkSession) as scratch:
        edges = scratch.stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        found = edges.select(F.col("a").alias("key"), F.col("b").alias("comp")).limit(0)
        first = True
        while not edges.isEmpty():
            both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
            parent = both.groupBy("a").agg(F.min("b").alias("p")).select(F.col("a").alias("v"), F.least("a", "p").alias("p"))
            parent = scratch.stored(parent, "parents")
            if first:
                found, first = parent.select(F.col("v").alias("key"), F.col("p").alias("comp")), False
            else:
                up = parent.select(F.col("v").alias("comp"), "p")
                found = scratch.stored(found.join(up, "comp", "left").select("key", F.coalesce("p", "comp").alias("comp")), "components")
            left, right = (parent.select(F.col("v").alias(c), F.col("p").alias(f"p{c}")) for c in "ab")
            edges = edges.join(left, "a").join(right, "b").where("pa <> pb")
            edges = scratch.stored(edges.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
        return store(found, "components")
