"""Breadth-first expansion over references and over undirected edges.

The driver holds only the hop counter. Frontiers and known ids are tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citegraph.operators.normalize import RECORD_ORDER
from citegraph.operators.search import lookup_by_ids
from citegraph.plans.materialize import materialize
from citegraph.sources.record_store import RecordStore


def expand_references(
    papers: DataFrame | RecordStore, seeds: DataFrame, max_hops: int = 1, per_hop_limit: int | None = None
) -> DataFrame:
    """``id, record_seq, hop`` of the seeds and of what they cite within
    ``max_hops`` hops; the record is the one that a lookup of the id returns.

    The candidates of a hop are the references of the papers found in the hop
    before that are not known yet. With a limit only the first of them are looked
    up: in the order of the papers that cite them, then of the reference lists.
    That order is a path, ``[place of the seed, place in its list, ...]``, so the
    first occurrence is a plain minimum and the cut a plain top-k; papers found
    at one hop have paths of the same length. Candidates that were cut or not
    found stay unknown and may come back at a later hop.

    Of a table every hop reads the ids of all records, of a store the buckets of
    its candidates.
    """

    def look_up(wanted: DataFrame) -> DataFrame:
        near = papers.near(wanted) if isinstance(papers, RecordStore) else papers
        return materialize(
            lookup_by_ids(near.select("paperId", "referenced_works", RECORD_ORDER), wanted).join(wanted.withColumnRenamed("id", "paperId"), "paperId")
        )

    frontier = look_up(seeds.select("id", F.array(F.col("ord").cast("int")).alias("path")))
    known = frontier.select(F.col("paperId").alias("id"), RECORD_ORDER, F.lit(0).alias("hop"))
    for hop in range(1, max_hops + 1):
        cited = frontier.select("path", F.posexplode("referenced_works").alias("place", "id"))
        if per_hop_limit:
            candidates = cited.groupBy("id").agg(F.min(F.concat("path", F.array("place"))).alias("path"))
        else:
            candidates = cited.select("id").distinct().withColumn("path", F.array().cast("array<int>"))
        # One row per cited id before the join, however often it is cited.
        candidates = candidates.join(known.select("id"), "id", "left_anti")
        if per_hop_limit:
            candidates = candidates.orderBy("path").limit(per_hop_limit)
        candidates = materialize(candidates)
        if candidates.isEmpty():
            break
        frontier = look_up(candidates)
        known = known.unionByName(
            frontier.select(F.col("paperId").alias("id"), RECORD_ORDER, F.lit(hop).alias("hop"))
        )
    return known


def k_hop_neighborhood(edges: DataFrame, seeds: DataFrame, k: int = 2) -> DataFrame:
    """``id, level``: smallest number of edges, in any direction, from a seed
    (column ``id``), up to ``k``."""
    known = seeds.select("id").distinct().withColumn("level", F.lit(0))
    frontier = known
    for level in range(1, k + 1):
        at = frontier.select("id")
        forward = edges.join(at.withColumnRenamed("id", "src"), "src", "left_semi").select(F.col("dst").alias("id"))
        backward = edges.join(at.withColumnRenamed("id", "dst"), "dst", "left_semi").select(F.col("src").alias("id"))
        frontier = materialize(
            forward.unionByName(backward).distinct().join(known, "id", "left_anti").withColumn("level", F.lit(level))
        )
        known = known.unionByName(frontier)
    return known
