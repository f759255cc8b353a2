"""Edge layouts for iterative operators.

An iterative operator joins the same edges with a new state table every round.
The edges are therefore partitioned by source and sorted once, and every round
joins in place: a state table that the previous round grouped by vertex already
has the same partitioning, so a round moves only its own messages.

A source that holds more than its share of the edges would make one task do the
work of many. Such sources are found first with a combined count; their edges are
spread over several salts and only their state rows are copied per salt. With
``n`` partitions and a limit of at least ``total / n`` edges there are fewer than
``n`` such sources, which bounds the table of them that is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citegraph.plans.materialize import BROADCAST_MAX_ROWS, materialize, shuffle_partitions, shuffles_dropped

#: Sources with fewer edges than this are never split.
MIN_HOT_EDGES = 1_000_000

#: Sources are counted in so many groups first.
SOURCE_GROUPS = 4096

#: A small graph is placed on fewer partitions than the session has.
MIN_EDGES_PER_PARTITION = 20_000

#: A large graph is placed on more partitions than the session has.
MAX_EDGES_PER_PARTITION = 5_000_000


@dataclass
class SourceLayout:
    """Edges placed by source; ``hot`` is null when no source needs salting.

    A ``small`` graph has so few edges that a row per end is broadcast instead."""

    edges: DataFrame
    source: str
    partitions: int
    hot: DataFrame | None
    small: bool = False
    placed_by: str | None = None  # when small: the column the edges are placed by

    def join_state(self, state: DataFrame, how: str = "inner") -> DataFrame:
        """Join every edge with the state row of its source. ``state`` has one
        row per vertex, keyed by a column named like the source column."""
        if self.small:
            return self.edges.join(F.broadcast(state), self.source, how)
        keys = [self.source]
        if self.hot is not None:
            keys.append("_salt")
            salts = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
            state = (
                state.join(F.broadcast(self.hot), self.source, "left")
                .withColumn("_salt", F.explode(salts))
                .drop("_salts")
            )
        return self.edges.join(state.hint("merge"), keys, how).drop("_salt")

    def release(self) -> None:
        self.edges.unpersist()


def place_by_source(
    edges: DataFrame,
    source: str = "src",
    min_hot_edges: int = MIN_HOT_EDGES,
    broadcast_max_rows: int = BROADCAST_MAX_ROWS,
    symmetric_target: str | None = None,
    in_place: Callable[[DataFrame], DataFrame] | None = None,
    before: Callable[[DataFrame], DataFrame] | None = None,
) -> SourceLayout:
    """Place and cache ``edges``; the caller releases them. A state has at most one
    row per end of an edge, so the counted edges bound what a small graph
    broadcasts. A caller that knows the vertices to be few enough for a broadcast, and the
    edges to be symmetric, names the target: without hot ends they are placed by it, so
    that what an edge brings to its target is there already.

    ``in_place`` is done with all edges of a source where they lie together, before they are kept,
    so that it needs no shuffle of its own; hot sources spread their edges, so with them ``before``
    (else ``in_place``) is done instead, before the edges move. Neither may add edges."""
    with_hot = before or in_place or _as_they_are
    in_place = in_place or _as_they_are
    # By groups of sources first: where no group has more than the limit, no source has, and no count
    # per source needs to move.
    total, largest = _total_and_largest(edges, F.pmod(F.xxhash64(source), F.lit(SOURCE_GROUPS)))
    n = max(shuffle_partitions(edges.sparkSession), total // MAX_EDGES_PER_PARTITION)
    limit = max(min_hot_edges, total // n)
    if largest > limit:
        largest = _total_and_largest(edges, F.col(source))[1]
    if largest <= limit and symmetric_target is not None:
        n = min(n, max(1, total // MIN_EDGES_PER_PARTITION))
        return SourceLayout(_kept(edges.repartition(n, symmetric_target)), source, n, None, small=True, placed_by=symmetric_target)
    if largest <= limit and total <= broadcast_max_rows:
        n = min(n, max(1, total // MIN_EDGES_PER_PARTITION))
        return SourceLayout(_kept(in_place(edges.repartition(n, source))), source, n, None, small=True)
    if largest <= limit:
        placed = in_place(edges.repartition(n, source)).sortWithinPartitions(source)
        return SourceLayout(_kept(placed), source, n, None)
    if with_hot is not _as_they_are:
        edges = materialize(with_hot(edges))
    # Written: every round joins it, and none should count the edges again.
    degrees = edges.groupBy(source).agg(F.count(F.lit(1)).alias("_edges"))
    hot = materialize(hot_sources(degrees, source, limit))
    placed = salted(edges, source, hot).repartition(n, source, "_salt").sortWithinPartitions(source, "_salt")
    return SourceLayout(_kept(placed), source, n, hot)


def _as_they_are(edges: DataFrame) -> DataFrame:
    return edges


def _total_and_largest(edges: DataFrame, group: Column) -> tuple[int, int]:
    """Edges in all, and of the group that has most."""
    counted = edges.groupBy(group.alias("_group")).agg(F.count(F.lit(1)).alias("_edges"))
    total, largest = counted.agg(F.sum("_edges"), F.max("_edges")).first()
    return total or 0, largest or 0


def place_by_key(rows: DataFrame, key: str, partitions: int) -> DataFrame:
    """``rows`` placed and cached as the edges of a layout without salts are; the caller releases them."""
    return _kept(rows.repartition(partitions, key).sortWithinPartitions(key))


def hot_sources(degrees: DataFrame, source: str, limit: int) -> DataFrame:
    """``source, _salts`` of the sources with more than ``limit`` edges (``_edges``)."""
    salts = F.ceil(F.col("_edges") / limit).cast("int").alias("_salts")
    return degrees.filter(F.col("_edges") > limit).select(source, salts)


def salted(edges: DataFrame, source: str, hot: DataFrame) -> DataFrame:
    """``edges`` with ``_salt``, which spreads those of hot sources."""
    spread = F.pmod(F.xxhash64(*[c for c in edges.columns if c != source]), F.coalesce("_salts", F.lit(1)))
    return edges.join(F.broadcast(hot), source, "left").withColumn("_salt", spread.cast("int")).drop("_salts")


def _kept(placed: DataFrame) -> DataFrame:
    """Fill the cache now: its partitioning is known only once it is filled. A lost
    part is computed again from the edges."""
    with shuffles_dropped(placed.sparkSession):
        placed = placed.select("*").persist(StorageLevel.MEMORY_AND_DISK)
        placed.count()
    return placed
