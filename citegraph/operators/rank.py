"""Influence of papers and of their authors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citegraph.operators.cliques import clique_sizes
from citegraph.operators.graph import CitationGraph
from citegraph.plans.keys import hashed_index
from citegraph.plans.layout import MIN_HOT_EDGES, place_by_key, place_by_source
from citegraph.plans.materialize import broadcast_if_small, checkpointed, materialize
from citegraph.sources.adjacency import Adjacency

#: Rounds between two written states. A round refers to its predecessor once, so
#: plans grow linearly; short ones plan faster than the extra small write costs.
ROUNDS_PER_JOB = 3

_TITLE_COLUMNS = ("title", "venue", "year")


def influence_rank(
    graph: CitationGraph,
    reset: float = 0.15,
    rounds: int = 10,
    mode: str = "raw",
    rounds_per_job: int = ROUNDS_PER_JOB,
    min_hot_edges: int = MIN_HOT_EDGES,
    adjacency: Adjacency | None = None,
) -> DataFrame:
    """``id, rank`` and the title columns of every vertex.

    All ranks start at 1. A round sets ``rank = reset + (1 - reset) * sum`` over
    the incoming edges of the citing paper's rank times the weight. ``raw`` sends
    the full rank along every edge; ``normalized`` first divides the weights of a
    paper by their sum, so that ranks stay comparable between graphs. A clique
    sends each member what the others send in total.

    Between rounds only the sums are kept: a vertex without a sum has the reset
    value, so no round needs the vertex table and each is one join in place and
    one combined shuffle of the messages. With the ``adjacency`` of the graph
    (``sources/adjacency.py``) its edges are read where they lie and not moved at all.
    Members of cliques are placed once like the edges; a round moves one row per clique for them.
    """
    if mode not in ("raw", "normalized"):
        raise ValueError(f"unknown mode {mode!r}")
    if adjacency is not None and graph.cliques is not None:
        raise ValueError("an adjacency holds edges, not cliques")
    index = adjacency or hashed_index(graph)
    edges = index.edges
    members = None
    if graph.cliques is not None:
        members = materialize(graph.cliques.join(index.vertices, "id").select("clique", F.col("key").alias("dst"), "weight"))
    if mode == "normalized" and members is not None:
        out_weight = edges.groupBy("src").agg(F.sum("weight").alias("_out"))
        sized = members.join(broadcast_if_small(clique_sizes(members)), "clique")
        linked = sized.select(F.col("dst").alias("src"), (F.col("weight") * (F.col("n") - 1)).alias("_out"))
        out_weight = out_weight.unionByName(linked).groupBy("src").agg(F.sum("_out").alias("_out"))
        # Written first: adaptive execution splits a hot source only in a join
        # whose two sides are plain shuffles.
        out_weight = materialize(out_weight)
        edges = _divided(edges, out_weight)
        members = materialize(
            members.join(out_weight.withColumnRenamed("src", "dst"), "dst").select(
                "clique", "dst", F.coalesce(F.col("weight") / F.nullif(F.col("_out"), F.lit(0.0)), F.lit(0.0)).alias("weight")
            )
        )

    rank = F.lit(reset) + F.lit(1.0 - reset) * F.coalesce(F.col("_sum"), F.lit(0.0))
    if adjacency is not None:
        layout = adjacency.layout("share" if mode == "normalized" else "weight")
    elif members is None and mode == "normalized":
        layout = place_by_source(edges, min_hot_edges=min_hot_edges, in_place=_shares, before=_shares_by_join)
    elif members is None:
        layout = place_by_source(edges, min_hot_edges=min_hot_edges)
    else:
        # the state has a row per vertex, however few the edges are, so it is never broadcast
        layout = place_by_source(edges, min_hot_edges=min_hot_edges, broadcast_max_rows=-1)
        keys = index.vertices.select(F.col("key").alias("dst"))
        members = place_by_key(keys.join(members.withColumnRenamed("weight", "_weight"), "dst", "left"), "dst", layout.partitions)
    sums = None
    for done in range(rounds):
        if sums is None:
            messages = layout.edges.select("dst", F.col("weight").alias("_part"))
        else:
            if done % rounds_per_job == 0 and members is None:
                sums = checkpointed(sums)
            state = sums.withColumnRenamed("dst", "src")
            messages = layout.join_state(state, "left").select("dst", (rank * F.col("weight")).alias("_part"))
        received = messages.groupBy("dst").agg(F.sum("_part").alias("_sum"))
        if members is not None:
            sent = members.withColumn("_sent", F.col("_weight"))
            if sums is not None:
                sent = members.join(sums.hint("merge"), "dst", "left").withColumn("_sent", rank * F.col("_weight")).drop("_sum")
            # used three times by the next round, so it is kept where it lies
            received, passed = _with_cliques(sent, received), sums
            if done % rounds_per_job == rounds_per_job - 1:
                received = checkpointed(received)
            sums = place_by_key(received, "dst", layout.partitions)
            if passed is not None:
                passed.unpersist()
        else:
            sums = received

    titles = [c for c in _TITLE_COLUMNS if c in graph.vertices.columns]
    own = adjacency is None and index.rows is not None
    ranked = index.rows.select("id", "key", *titles) if own else index.vertices
    if sums is None:
        ranked = ranked.withColumn("rank", F.lit(1.0))
    else:
        ranked = ranked.join(sums.withColumnRenamed("dst", "key"), "key", "left").withColumn("rank", rank)
    if not own:
        ranked = ranked.select("id", "rank").join(graph.vertices.select("id", *titles), "id")
    ranked = materialize(ranked.select("id", "rank", *titles))
    layout.release()
    if members is not None:
        members.unpersist()
        if sums is not None:
            sums.unpersist()
    return ranked


def _shares(placed: DataFrame) -> DataFrame:
    """Weights divided by their sum over the source, where its edges lie together."""
    out = F.sum("weight").over(Window.partitionBy("src"))
    return placed.select("src", "dst", (F.col("weight") / out).alias("weight"))


def _shares_by_join(edges: DataFrame) -> DataFrame:
    """The same of edges with hot sources. The sums are written first: adaptive execution splits a
    hot source only in a join whose two sides are plain shuffles."""
    return _divided(edges, materialize(edges.groupBy("src").agg(F.sum("weight").alias("_out"))))


def _divided(edges: DataFrame, out_weight: DataFrame) -> DataFrame:
    return edges.join(out_weight, "src").select("src", "dst", (F.col("weight") / F.col("_out")).alias("weight"))


def _with_cliques(sent: DataFrame, received: DataFrame) -> DataFrame:
    """The sums ``received`` along edges and what the others of its clique sent, for every vertex.

    ``sent`` has a row per member, and one without a clique for any other vertex, placed by vertex.
    """
    totals = sent.where(F.col("clique").isNotNull()).groupBy("clique").agg(F.sum("_sent").alias("_total"))
    others = sent.join(broadcast_if_small(materialize(totals)), "clique", "left").groupBy("dst").agg(
        F.sum(F.col("_total") - F.col("_sent")).alias("_others")
    )
    both = F.coalesce("_sum", F.lit(0.0)) + F.coalesce("_others", F.lit(0.0))
    return others.join(received, "dst", "left").select("dst", both.alias("_sum"))


def by_rank(ranks: DataFrame) -> list:
    """Sort order of papers. Ranks are rounded first: sums of doubles differ in
    their last bits with the order of the rows, and ties must fall the same way."""
    return [F.round(F.log10("rank"), 9).desc(), F.col("id").asc()]


def top_papers(ranks: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` papers of highest rank, ties by id."""
    return ranks.orderBy(*by_rank(ranks)).limit(k)


def author_influence(graph: CitationGraph, ranks: DataFrame, top_n: int | None = None) -> DataFrame:
    """``authorId, authorName, influenceScore, paperCount``, best first.

    Grouped by id and name, so two spellings of one id are two rows. An author
    listed twice on a paper adds its rank twice and counts the paper once: the
    repeats are marked inside the row, which leaves one combined aggregate and no
    distinct count.
    """
    if "authors" not in graph.vertices.columns:
        raise ValueError("the vertices have no authors column")
    # sorted before, in a projection of its own: inside the lambda it would be sorted once per author
    listed = F.col("_listed")
    marked = F.transform(
        listed,
        lambda a, i: F.struct(
            a["authorId"].alias("authorId"),
            a["name"].alias("authorName"),
            F.when((i > 0) & a.eqNullSafe(F.get(listed, i - 1)), 0).otherwise(1).alias("first"),
        ),
    )
    scores = (
        graph.vertices.select("id", F.array_sort("authors").alias("_listed"))
        .select("id", marked.alias("marked"))
        .join(ranks.select("id", "rank"), "id")
        # outer, since the filter that is inferred from a plain one would mark the authors a second time
        .select("rank", F.inline_outer("marked"))
        .filter(F.col("authorId") != "")
        .groupBy("authorId", "authorName")
        .agg(F.sum("rank").alias("influenceScore"), F.sum("first").alias("paperCount"))
        .orderBy(
            F.round(F.log10("influenceScore"), 9).desc(),
            F.col("paperCount").desc(),
            "authorId",
            "authorName",
        )
    )
    return scores.limit(top_n) if top_n else scores
