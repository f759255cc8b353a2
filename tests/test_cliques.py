"""Cliques kept as members against all their pairs written out."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from citegraph.operators import cliques, search
from citegraph.operators.communities import canonical_ids, label_propagation, modularity
from citegraph.operators.edges import symmetrize, undirected_edges
from citegraph.operators.graph import CitationGraph, graph_stats
from citegraph.operators.louvain import louvain
from citegraph.operators.rank import influence_rank
from citegraph.plans import workflows
from citegraph.sources import graph_store
from tests.conftest import pairs

GROUPS = {"a": "abcde", "f": "fg", "h": "h", "i": "ijk"}


@pytest.fixture(scope="module")
def both(spark, make):
    """The same graph with cliques and with their pairs as edges; ``l`` is in no clique."""
    vertices = make.vertices({i: [] for i in "abcdefghijkl"})
    members = spark.createDataFrame([(c, i, 0.5) for c, ids in GROUPS.items() for i in ids], "clique string, id string, weight double")
    cited = [("a", "f", 1.0), ("f", "l", 2.0), ("l", "a", 1.0), ("b", "c", 1.0)]
    linked = [(x, y, 0.5) for ids in GROUPS.values() for x, y in itertools.permutations(ids, 2)]
    return (
        CitationGraph(vertices, make.edges(cited), closed=True, cliques=members),
        CitationGraph(vertices, make.edges(cited + linked), closed=True),
        CitationGraph(vertices, make.edges([]), closed=True, cliques=members),
        CitationGraph(vertices, make.edges(linked), closed=True),
    )


@pytest.mark.parametrize("mode", ["raw", "normalized"])
@pytest.mark.parametrize("rounds", [0, 1, 4])
def test_rank(both, mode, rounds):
    for short, long in (both[:2], both[2:]):
        got, expected = ({r.id: r["rank"] for r in influence_rank(g, rounds=rounds, mode=mode).collect()} for g in (short, long))
        assert got.keys() == expected.keys() and all(math.isclose(got[i], expected[i], rel_tol=1e-12) for i in got)


def test_counts_degrees_and_weights(both):
    short, long = both[2:]
    assert graph_stats(short).first() == graph_stats(long).first()
    degrees = {r.id: (r.degree, r.weight) for r in cliques.clique_degrees(short.cliques).collect()}
    assert degrees == {i: (len(ids) - 1, 0.5 * (len(ids) - 1)) for ids in GROUPS.values() for i in ids}
    named = short.vertices.select("id")
    written = lambda c: cliques.edges_among(c, named)
    assert pairs(written(short.cliques)) == pairs(long.edges)
    once = {(r.src, r.dst): r.weight for r in written(cliques.undirected_cliques(short.cliques)).collect() if r.src < r.dst}
    assert once == {(r.a, r.b): r.weight for r in undirected_edges(long.edges).collect()}
    for dedupe in (False, True):
        total = symmetrize(long.edges, dedupe).agg(F.sum("weight")).first()[0]
        assert written(cliques.mirrored_cliques(short.cliques, dedupe)).agg(F.sum("weight")).first()[0] == total
    with pytest.raises(ValueError, match="more than"):
        cliques.edges_among(cliques.clique_of(short.vertices.sparkSession.range(1500).selectExpr("cast(id as string) id")), short.vertices.sparkSession.range(1500).selectExpr("cast(id as string) id"))


def test_modularity(both):
    for short, long in (both[:2], both[2:]):
        assigned = short.vertices.select("id", F.when(F.col("id") < "d", 1).when(F.col("id") < "j", 2).otherwise(3).alias("community"))
        assert math.isclose(modularity(short.edges, assigned, short.cliques).first().q, modularity(long.edges, assigned).first().q, rel_tol=1e-12)


@pytest.mark.parametrize("rounds", [0, 1, 2, 5])
def test_label_propagation(both, rounds):
    got, expected = ({r.id: r.community for r in label_propagation(g, rounds).collect()} for g in both[2:])
    assert got == expected


@pytest.mark.parametrize("resolution", [1.0, 0.05])
def test_louvain(both, resolution):
    got, expected = ({r.id: r.community for r in louvain(g, resolution).collect()} for g in both[2:])
    assert got == expected


def test_communities_of_edges_and_cliques_are_refused(both):
    for find in (label_propagation, louvain):
        with pytest.raises(ValueError, match="both edges and cliques"):
            find(both[0])


def test_saved_with_the_graph(spark, both, tmp_path):
    for name, g in zip("xy", both[:2], strict=True):
        graph_store.save_graph(g, name, str(tmp_path))
    back = graph_store.load_graph(spark, "x", str(tmp_path))
    assert sorted(back.cliques.collect()) == sorted(both[0].cliques.collect())
    assert graph_store.load_graph(spark, "y", str(tmp_path)).cliques is None
    assert graph_store.load_graph(spark, "x", str(tmp_path), years=[1]).cliques.count() == 0


def test_publication_without_citations(make):
    papers = make.records([(i, "t", [], n, 0, 2000, "v", []) for n, i in enumerate("bac")])
    graph = workflows.publication_graph(papers, "v", 2000)
    assert graph.edges.isEmpty() and sorted(r.id for r in graph.cliques.collect()) == ["a", "b", "c"]
    assert graph_stats(graph).first().n_edges == 6
    assert {r.community for r in canonical_ids(louvain(graph).select("id", "community")).collect()} == {0}
    with pytest.raises(ValueError, match="unknown fallback"):
        workflows.publication_graph(papers, "v", 2000, fallback="other")


def test_no_plan_makes_pairs(both):
    for df in (cliques.count_pairs(both[0].cliques), cliques.clique_degrees(both[0].cliques), cliques.community_parts(both[0].cliques, both[0].vertices.select("id", F.lit(1).alias("community")))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_cursor_pages(make):
    papers = make.records([(f"W{n}", "red x", [], n, n % 3, 2000, "v", []) for n in range(20)] + [("W1", "red again", [], 99, 7)])
    whole = [r.paperId for r in search.keyword_search(papers, "red").collect()]
    pages = [[r.paperId for r in p.orderBy(F.desc("cited_by_count"), "paperId").collect()] for p in search.keyword_pages(papers, "red", 6)]
    assert [len(p) for p in pages] == [6, 6, 6, 2] and sum(pages, []) == whole
    assert search.next_cursor(papers.limit(0)) is None
    assert [r.paperId for r in search.keyword_search(papers, "red", None, offset=7).collect()] == whole[7:]
    with pytest.raises(ValueError, match="no cursor"):
        search.keyword_search(papers, "red", 5, after="bm90aGluZw==")
    plan = search.keyword_search(papers, "red", 5, after=search.next_cursor(papers.limit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_rounds_over_cliques_move_one_row_per_clique(spark, both, monkeypatch):
    """What a round writes are the totals of the cliques, not the sums of all vertices."""
    from citegraph.operators import rank

    written, real = [], rank.materialize
    monkeypatch.setattr(rank, "materialize", lambda df: written.append(real(df)) or written[-1])
    influence_rank(both[0], rounds=3)
    assert [t.count() for t in written if t.columns == ["clique", "_total"]] == [len(GROUPS)] * 3
    assert not [t for t in written if t.columns == ["dst", "_sum"]]


def test_rank_of_repeated_members_and_of_vertices_outside(spark, make):
    """A paper listed twice in its clique counts twice, as two of the others; one without a clique gets edges only."""
    vertices = make.vertices({i: [] for i in "abc"})
    members = spark.createDataFrame([("g", "a", 1.0), ("g", "b", 1.0), ("g", "b", 1.0)], "clique string, id string, weight double")
    graph = CitationGraph(vertices, make.edges([("a", "c", 1.0)]), closed=True, cliques=members)
    found = {r.id: r["rank"] for r in influence_rank(graph, rounds=1).collect()}
    # each row of a member receives the total of 3 without its own part of 1
    assert found == pytest.approx({"a": 0.15 + 0.85 * 2, "b": 0.15 + 0.85 * 4, "c": 0.15 + 0.85})


def test_rank_over_cliques_with_hot_sources(both):
    """Sources spread over salts read the same sums as the members of cliques."""
    found = {r.id: r["rank"] for r in influence_rank(both[0], rounds=5, min_hot_edges=1).collect()}
    assert found == pytest.approx({r.id: r["rank"] for r in influence_rank(both[1], rounds=5).collect()})
