"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexisieve.operators.skew import join_listed
from lexisieve.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``(id, root)`` of every vertex of ``edges(a, b)``; the root is the component's least id.

    Every vertex points to its least neighbour or itself, pointers are followed to their
    ends, edges are redrawn between the ends, and so on until none is left. Least
    neighbours are aggregated before the shuffle, and where very many vertices point to one,
    its row comes to them, so a vertex of very many edges is no larger than others. A component's least vertex always points to itself. Self loops,
    repeated edges and an empty table are fine.
    """
    edges = materialize(edges.select("a", "b").distinct())
    roots = materialize(
        edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct().withColumn("root", F.col("id"))
    )
    edges = materialize(edges.filter("a != b"))
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parents = both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("p"))
        parents = _follow(materialize(parents))
        step_a = parents.select(F.col("v").alias("a"), F.col("p").alias("pa"))
        step_b = parents.select(F.col("v").alias("b"), F.col("p").alias("pb"))
        edges = materialize(
            edges.join(step_a, "a")
            .join(step_b, "b")
            .filter("pa != pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct()
        )
        # every root in use, also those without edges left, so that members need no outer join
        ends = (
            roots.select("root")
            .distinct()
            .join(parents.withColumnRenamed("v", "root"), "root", "left")
            .select("root", F.coalesce("p", "root").alias("end"))
        )
        roots = materialize(with_row(roots, materialize(ends), "root").select("id", F.col("end").alias("root")))
    return roots


def with_row(many: DataFrame, one: DataFrame, key: str) -> DataFrame:
    """``many`` rows with the row of ``one`` that has their key; keys of very many rows are not shuffled."""
    return join_listed(many, one, [key], materialize(many.groupBy(key).count()), "count")


def _follow(parents: DataFrame) -> DataFrame:
    """Pointers ``(v, p)`` to the end of their chains; a chain of ids only ever falls."""
    while True:
        next_ones = parents.select(F.col("v").alias("p"), F.col("p").alias("pp"))
        further = materialize(
            with_row(parents, next_ones, "p").select("v", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved"))
        )
        parents = further.select("v", "p")
        if further.filter("moved").isEmpty():
            return parents
