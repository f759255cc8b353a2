"""Saving and loading graphs and drawing tables.

Vertices, edges and cliques of a graph are replaced together: a save writes a new version
of each and then puts all in force at once (``sources/versions.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citegraph.operators.graph import CitationGraph
from citegraph.sources import versions
from citegraph.sources.schemas import CLIQUE, EDGE, VERTEX


def graph_paths(root: str, name: str) -> tuple[str, str]:
    base = f"{root.rstrip('/')}/processed/{name}"
    return f"{base}_vertices", f"{base}_edges_weighted"


def save_graph(graph: CitationGraph, name: str, root: str, edge_files: int | None = None) -> tuple[str, str]:
    """Write vertices by year, edges and members of cliques as Parquet, replacing an
    older graph of the name; returns the paths of vertices and edges, which hold a folder
    per version. A save that fails leaves the older graph as it was; the files of older
    versions stay until ``drop_old_graphs``.

    Vertices are rebalanced by year first: a rare year becomes one file, a year
    that holds a large share of all papers is split over many tasks. Edge files
    are sized the same way unless a number of files (such as 32) is asked for.
    """
    vertex_path, edge_path = graph_paths(root, name)
    vertices = graph.vertices.hint("rebalance", "year")
    edges = graph.edges.hint("rebalance") if edge_files is None else graph.edges.repartition(edge_files)
    version = versions.new_version()
    vertices.write.partitionBy("year").parquet(versions.versioned(vertex_path, version))
    edges.write.parquet(versions.versioned(edge_path, version))
    cliques = graph.cliques
    if cliques is None:
        cliques = graph.vertices.select("id").limit(0).select(F.lit("").alias("clique"), "id", F.lit(1.0).alias("weight"))
    cliques.write.parquet(versions.versioned(_clique_path(edge_path), version))
    versions.commit(graph.vertices.sparkSession, _log_path(edge_path), version)
    return vertex_path, edge_path


def _clique_path(edge_path: str) -> str:
    return f"{edge_path.removesuffix('_edges_weighted')}_cliques"


def _log_path(edge_path: str) -> str:
    return f"{edge_path.removesuffix('_edges_weighted')}_commits"


def drop_old_graphs(spark: SparkSession, name: str, root: str, keep: int = 2) -> list[str]:
    """Delete all saves of a graph but the ``keep`` last; returns their versions. The last but
    one may still be read by a job that started before it was replaced."""
    vertex_path, edge_path = graph_paths(root, name)
    return versions.drop_old_versions(spark, _log_path(edge_path), [vertex_path, edge_path, _clique_path(edge_path)], keep)


def load_graph(
    spark: SparkSession,
    name: str,
    root: str,
    years: list[int] | None = None,
    keep_references: bool = True,
) -> CitationGraph:
    """Read a saved graph in the column order of ``VERTEX`` and ``EDGE``.

    With ``years`` only their partitions are read, and the edges between them.
    ``keep_references`` must be false for a graph saved without references. All tables
    are of the version in force when the call is made.
    """
    vertex_path, edge_path = graph_paths(root, name)
    version = versions.current_version(spark, _log_path(edge_path))
    clique_path = versions.versioned(_clique_path(edge_path), version)
    vertex_path, edge_path = versions.versioned(vertex_path, version), versions.versioned(edge_path, version)
    fields = [f for f in VERTEX.fields if keep_references or f.name != "referenced_works"]
    vertices = spark.read.schema(T.StructType(fields)).parquet(vertex_path).select(*[f.name for f in fields])
    edges = spark.read.schema(EDGE).parquet(edge_path)
    cliques = spark.read.schema(CLIQUE).parquet(clique_path)
    cliques = None if cliques.isEmpty() else cliques
    if years is None:
        return CitationGraph(vertices, edges, closed=True, cliques=cliques)
    graph = CitationGraph(vertices.filter(F.col("year").isin(years)), edges)
    if cliques is not None:
        cliques = cliques.join(graph.vertices.select("id"), "id", "left_semi").select(*CLIQUE.fieldNames())
    return CitationGraph(graph.vertices, graph.closed_edges().select(*EDGE.fieldNames()), closed=True, cliques=cliques)


def save_render_tables(nodes: DataFrame, edges: DataFrame, name: str, root: str, fmt: str = "json") -> tuple[str, str]:
    """Write drawing tables for a drawing tool; returns both paths."""
    base = f"{root.rstrip('/')}/output/{name}"
    nodes.write.mode("overwrite").format(fmt).save(f"{base}_nodes")
    edges.write.mode("overwrite").format(fmt).save(f"{base}_edges")
    return f"{base}_nodes", f"{base}_edges"
