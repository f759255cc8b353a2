"""The graph value: a vertex table and an edge table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citegraph.operators.cliques import count_pairs


@dataclass(frozen=True)
class CitationGraph:
    """``vertices`` is unique by ``id``; ``edges`` has ``src, dst, weight,
    edge_type``. ``closed`` states that both ends of every edge are vertices, as
    in every graph the builders of this library return. ``cliques`` (``clique, id,
    weight``, see ``operators.cliques``) stands for all pairs of edges inside groups."""

    vertices: DataFrame
    edges: DataFrame
    closed: bool = False
    cliques: DataFrame | None = None

    def persist(self, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> "CitationGraph":
        self.vertices.persist(level)
        self.edges.persist(level)
        return self

    def unpersist(self) -> "CitationGraph":
        self.vertices.unpersist()
        self.edges.unpersist()
        return self

    def closed_edges(self) -> DataFrame:
        """Edges whose two ends are vertices."""
        if self.closed:
            return self.edges
        ids = self.vertices.select("id")
        return self.edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(
            ids.withColumnRenamed("id", "dst"), "dst", "left_semi"
        )


def graph_stats(graph: CitationGraph) -> DataFrame:
    """One row: number of vertices and edges."""
    n_vertices = graph.vertices.agg(F.count(F.lit(1)).alias("n")).scalar()
    n_edges = graph.edges.agg(F.count(F.lit(1)).alias("n")).scalar()
    if graph.cliques is not None:
        n_edges = n_edges + count_pairs(graph.cliques).scalar()
    return graph.vertices.sparkSession.range(1).select(
        n_vertices.alias("n_vertices"), n_edges.alias("n_edges")
    )
