"""Groups of papers in which every two are linked, kept as their members.

All pairs of ``n`` papers are ``n * (n - 1)`` edges. A clique table has a row per member instead,
``clique, id, weight``, and stands for an edge of that weight each way between every two
members of a clique. A paper is in one clique at most. What operators need from the edges
follows from sums over the members: what reaches a member is the sum over its clique
without its own part. So every operator here is linear in the members, combines before
it shuffles, and brings back one row per clique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citegraph.operators.edges import FALLBACK
from citegraph.plans.materialize import broadcast_if_small, materialize

#: Most papers whose pairs are written out for a drawing.
MAX_DRAWN = 1000


def clique_of(vertices: DataFrame, weight: float = 1.0) -> DataFrame:
    """One clique of all vertices."""
    return vertices.select(F.lit("all").alias("clique"), "id", F.lit(weight).alias("weight"))


def cliques_by(vertices: DataFrame, *columns: str, weight: float = 1.0) -> DataFrame:
    """A clique per combination of values of ``columns``, such as venue and year."""
    return vertices.select(F.to_json(F.struct(*columns)).alias("clique"), "id", F.lit(weight).alias("weight"))


def clique_sizes(cliques: DataFrame) -> DataFrame:
    """``clique, n``; written, so that joins with it know how many there are."""
    return materialize(cliques.groupBy("clique").agg(F.count(F.lit(1)).alias("n")))


def count_pairs(cliques: DataFrame) -> DataFrame:
    """One row ``n``: the edges the cliques stand for."""
    n = F.col("n")
    return cliques.groupBy("clique").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(n * (n - 1)), F.lit(0)).alias("n"))


def clique_degrees(cliques: DataFrame) -> DataFrame:
    """``id, degree, weight``: edges out of each member (as many come in) and their summed weight."""
    sizes = broadcast_if_small(clique_sizes(cliques))
    degree = F.col("n") - 1
    return cliques.join(sizes, "clique").select("id", degree.alias("degree"), (degree * F.col("weight")).alias("weight"))


def undirected_cliques(cliques: DataFrame) -> DataFrame:
    """The cliques with the summed weight of each unordered pair, which has an edge each way."""
    return cliques.withColumn("weight", 2.0 * F.col("weight"))


def mirrored_cliques(cliques: DataFrame, dedupe: bool = False) -> DataFrame:
    """Every edge and its reverse. All reverses are there already: kept once with ``dedupe``, else
    each counts twice, as a row of twice the weight."""
    return cliques if dedupe else undirected_cliques(cliques)


def community_parts(cliques: DataFrame, communities: DataFrame) -> DataFrame:
    """``community, degree, inside``: what the cliques add to the sums of a modularity. With ``s`` of
    the ``n`` members in a community, ``s (n - 1)`` ends and ``s (s - 1)`` of them inside."""
    of = communities.select("id", "community")
    counted = cliques.join(of, "id").groupBy("clique", "weight", "community").agg(F.count(F.lit(1)).alias("s"))
    both = 2.0 * F.col("weight") * F.col("s")
    return counted.join(broadcast_if_small(clique_sizes(cliques)), "clique").select(
        "community", (both * (F.col("n") - 1)).alias("degree"), (both * (F.col("s") - 1)).alias("inside")
    )


def propagated_labels(cliques: DataFrame, rounds: int) -> DataFrame:
    """``id, community`` after label propagation inside the cliques.

    In the first round every member takes the least id of the others: all but the least member
    the least id, that one the second. From then on the least id has the most votes
    everywhere; with two members both keep swapping.
    """
    alone = cliques.select("id", F.col("id").alias("community"))
    if rounds == 0:
        return alone
    first = materialize(cliques.groupBy("clique").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")))
    marked = materialize(cliques.select("clique", "id").join(broadcast_if_small(first), "clique"))
    second = materialize(marked.where("id <> first").groupBy("clique").agg(F.min("id").alias("second")))
    marked = marked.join(broadcast_if_small(second), "clique", "left")
    other = F.when(F.col("id") == F.col("first"), F.col("second")).otherwise(F.col("first"))
    settled = other if rounds == 1 else F.col("first")
    pair = other if rounds % 2 else F.col("id")
    label = F.when(F.col("n") == 1, F.col("id")).when(F.col("n") == 2, pair).otherwise(settled)
    return marked.select("id", label.alias("community"))


def louvain_cliques(cliques: DataFrame, resolution: float = 1.0) -> DataFrame:
    """``id, community`` of best modularity inside the cliques: two members join if the weight between
    them outweighs their degrees, and then so do all of the clique, or none does."""
    sized = cliques.join(broadcast_if_small(clique_sizes(cliques)), "clique")
    degree = 2.0 * F.col("weight") * (F.col("n") - 1)
    total = sized.agg(F.coalesce(F.sum(degree), F.lit(0.0)).alias("m2")).scalar()
    joins = (F.col("n") > 1) & (F.lit(resolution) * 2.0 * F.col("weight") * total > degree * degree)
    return sized.select("id", F.when(joins, F.concat(F.lit("clique:"), "clique")).otherwise(F.concat(F.lit("id:"), "id")).alias("community"))


def edges_among(cliques: DataFrame, ids: DataFrame) -> DataFrame:
    """The edges between few chosen members (column ``id``), such as the vertices of a drawing."""
    chosen = materialize(cliques.join(F.broadcast(ids.select("id").distinct().limit(MAX_DRAWN + 1)), "id"))
    if chosen.count() > MAX_DRAWN:
        raise ValueError(f"more than {MAX_DRAWN} papers to write all pairs of")
    listed = chosen.groupBy("clique").agg(F.collect_list("id").alias("_ids"))
    ends = chosen.join(listed, "clique").select(F.col("id").alias("src"), F.explode("_ids").alias("dst"), "weight")
    return ends.where("src <> dst").select("src", "dst", "weight", F.lit(FALLBACK).alias("edge_type"))
