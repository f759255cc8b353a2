"""The edges of a graph kept on disk as iterative operators want them.

An iterative operator places edges by source before its first round (``plans/layout.py``). An
adjacency is that placement written once: keyed edges in as many buckets as there would be
partitions, one sorted file each, hot sources spread over salts. Read as a bucketed table, its
rounds join in place, and no later job moves the edges again.

``vertices`` (``id, key``), ``edges`` (``src, dst, weight, share``; ``share`` is the weight divided by
the sum of its source's weights), the hot sources and a row of facts are replaced together
(``sources/versions.py``).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citegraph.operators.graph import CitationGraph
from citegraph.plans.keys import hashed_index
from citegraph.plans.layout import MAX_EDGES_PER_PARTITION, MIN_HOT_EDGES, SourceLayout, hot_sources, salted
from citegraph.plans.materialize import discard, materialize, shuffle_partitions, shuffles_dropped
from citegraph.sources import versions

_EDGE = "src bigint, dst bigint, weight double, share double"
_FACTS = "buckets int, salted boolean"


@dataclass(frozen=True)
class Adjacency:
    vertices: DataFrame
    edges: DataFrame
    buckets: int
    hot: DataFrame | None

    def layout(self, weight: str = "weight") -> SourceLayout:
        """The edges in place, weighted by ``weight`` or ``share``."""
        salt = [] if self.hot is None else ["_salt"]
        edges = self.edges.select("src", "dst", F.col(weight).alias("weight"), *salt)
        return SourceLayout(edges, "src", self.buckets, self.hot)


def _tables(folder: str) -> list[str]:
    return [f"{folder.rstrip('/')}/{t}" for t in ("vertices", "edges", "hot", "facts")]


def _log(folder: str) -> str:
    return f"{folder.rstrip('/')}/commits"


def save_adjacency(
    graph: CitationGraph, folder: str, buckets: int | None = None, min_hot_edges: int = MIN_HOT_EDGES
) -> Adjacency:
    """Keep the edges of ``graph`` in ``folder``, replacing an older adjacency there. Of a graph
    with cliques only the edges would be kept, so it is refused."""
    if graph.cliques is not None:
        raise ValueError("an adjacency holds edges, not cliques")
    spark, version = graph.vertices.sparkSession, versions.new_version()
    paths = [versions.versioned(t, version) for t in _tables(folder)]
    index = hashed_index(graph)
    edges = keyed = materialize(index.edges)
    sums = materialize(edges.groupBy("src").agg(F.sum("weight").alias("_out"), F.count(F.lit(1)).alias("_edges")))
    total, largest = (n or 0 for n in sums.agg(F.sum("_edges"), F.max("_edges")).first())
    buckets = buckets or max(shuffle_partitions(spark), total // MAX_EDGES_PER_PARTITION)
    limit = max(min_hot_edges, total // buckets)
    hot = materialize(hot_sources(sums, "src", limit)) if largest > limit else None
    edges = edges.join(sums.drop("_edges"), "src").withColumn("share", F.col("weight") / F.col("_out")).drop("_out")
    keys = ["src"]
    if hot is not None:
        edges, keys = salted(edges, "src", hot), ["src", "_salt"]
    # a task per bucket, placed by the hash that names the buckets, so each is one file
    placed = edges.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", paths[1])
    name = f"adjacency_{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        placed.format("parquet").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # its name only: the files lie in a folder of ours
    index.vertices.write.parquet(paths[0])
    if hot is not None:
        hot.write.parquet(paths[2])
    facts = spark.range(1).select(F.lit(buckets).alias("buckets"), F.lit(hot is not None).alias("salted"))
    facts.write.parquet(paths[3])
    versions.commit(spark, _log(folder), version)
    discard(keyed, sums, *([] if hot is None else [hot]))
    return load_adjacency(spark, folder)


def load_adjacency(spark: SparkSession, folder: str) -> Adjacency:
    """The adjacency in force in ``folder``, its edges as a bucketed table of this session."""
    version = versions.current_version(spark, _log(folder))
    if version is None:
        raise ValueError(f"no adjacency is stored in {folder}")
    paths = [versions.versioned(t, version) for t in _tables(folder)]
    buckets, has_salt = spark.read.schema(_FACTS).parquet(paths[3]).first()
    columns, keys = (f"{_EDGE}, _salt int", "src, _salt") if has_salt else (_EDGE, "src")
    name = f"adjacency_{version}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{paths[1]}'"
    )
    hot = spark.read.schema("src bigint, _salts int").parquet(paths[2]) if has_salt else None
    return Adjacency(spark.read.schema("id string, key bigint").parquet(paths[0]), spark.table(name), buckets, hot)


def drop_old_adjacencies(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Delete all but the ``keep`` last adjacencies of ``folder``; returns their versions."""
    return versions.drop_old_versions(spark, _log(folder), _tables(folder), keep)
