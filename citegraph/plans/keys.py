"""Integer keys for vertices inside iterative operators.

Messages keyed by a long are a fraction of the size of messages keyed by a text
id, and they sort and hash faster. Two ways to key a graph:

* ``ordered_index``: keys grow with the id, for operators whose tie rule compares
  ids. One range shuffle of the ids and two joins of the edges.
* ``hashed_index``: a 64-bit hash of the id, checked to be free of collisions, for
  operators that never compare ids. The edges are not shuffled at all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citegraph.operators.graph import CitationGraph
from citegraph.plans.materialize import discard, materialize


@dataclass(frozen=True)
class IndexedGraph:
    """``vertices``: id, key. ``edges``: src, dst (keys), weight. ``rows``, if the keys are hashes:
    the vertices with all their columns and their key, which no join is needed for."""

    vertices: DataFrame
    edges: DataFrame
    rows: DataFrame | None = None


def numbered_rows(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with their place in the order, from 0, whatever the partitioning.

    A distributed sort: every partition of the sorted rows numbers its own and starts
    where those before it end. Only the row counts of the partitions come together.
    """
    position = F.monotonically_increasing_id()
    placed = materialize(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"_part": F.shiftright(position, 33), "_pos": position.bitwiseAND(F.lit((1 << 33) - 1))})
    )
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("_start"))
    numbered = materialize(
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_pos"))
        .drop("_part", "_pos", "_start")
    )
    discard(placed)
    return numbered


def ordered_index(graph: CitationGraph) -> IndexedGraph:
    """Keys in id order, the same for every partitioning. Only edges whose two ends are
    vertices are kept."""
    numbered = numbered_rows(graph.vertices.select("id"), [F.col("id").asc()], "key")
    return IndexedGraph(numbered, materialize(_join_keys(graph, numbered)))


def hashed_index(graph: CitationGraph) -> IndexedGraph:
    """Hashed keys; a graph with colliding hashes gets ordered keys instead."""

    def key(column: str) -> Column:
        return F.xxhash64(column)

    keyed = graph.vertices.select("id", key("id").alias("key"))
    if not keyed.groupBy("key").count().filter("count > 1").isEmpty():
        return ordered_index(graph)
    edges = graph.closed_edges().select(key("src").alias("src"), key("dst").alias("dst"), "weight")
    return IndexedGraph(keyed, edges, graph.vertices.where(F.col("id").isNotNull()).withColumn("key", key("id")))


def _join_keys(graph: CitationGraph, numbered: DataFrame) -> DataFrame:
    source = numbered.select(F.col("id").alias("src"), F.col("key").alias("_s"))
    target = numbered.select(F.col("id").alias("dst"), F.col("key").alias("_d"))
    return (
        graph.edges.select("src", "dst", "weight")
        .join(source, "src")
        .join(target, "dst")
        .select(F.col("_s").alias("src"), F.col("_d").alias("dst"), "weight")
    )
