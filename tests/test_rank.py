import random

import pytest
from pyspark.sql import functions as F

from citegraph.operators.cliques import clique_of
from citegraph.operators.graph import CitationGraph
from citegraph.operators.rank import author_influence, influence_rank, top_papers
from citegraph.plans.keys import hashed_index, ordered_index
from citegraph.sources import adjacency


def brute(ids, edges, rounds, reset=0.15, normalized=False):
    out = {}
    for s, _, w in edges:
        out[s] = out.get(s, 0) + w
    rank = {i: 1.0 for i in ids}
    for _ in range(rounds):
        sums = {i: 0.0 for i in ids}
        for s, d, w in edges:
            if s in rank and d in sums:
                sums[d] += rank[s] * (w / out[s] if normalized else w)
        rank = {i: reset + (1 - reset) * sums[i] for i in ids}
    return rank


def ranks_of(df):
    return {r.id: r["rank"] for r in df.collect()}


def random_graph(make, n=40, m=200, hub=None, seed=5):
    rnd = random.Random(seed)
    ids = [f"n{i}" for i in range(n)]
    edges = [(rnd.choice(ids), rnd.choice(ids), rnd.choice([1, 2, 3])) for _ in range(m)]
    edges += [(hub, rnd.choice(ids), 1) for _ in range(m // 2)] if hub else []
    return ids, edges, CitationGraph(make.vertices({i: [] for i in ids}), make.edges(edges), closed=True)


def test_by_hand(make):
    edges = [("A", "B", 1), ("A", "C", 2), ("B", "C", 1)]
    g = CitationGraph(make.vertices({"A": [], "B": [], "C": []}), make.edges(edges), closed=True)
    one = ranks_of(influence_rank(g, rounds=1))
    assert one == pytest.approx({"A": 0.15, "B": 1.0, "C": 0.15 + 0.85 * 3})
    assert ranks_of(influence_rank(g, rounds=0)) == {"A": 1.0, "B": 1.0, "C": 1.0}
    assert ranks_of(influence_rank(g, rounds=3)) == pytest.approx(brute("ABC", edges, 3))


@pytest.mark.parametrize("mode", ["raw", "normalized"])
@pytest.mark.parametrize("hub, min_hot", [(None, 1_000_000), ("n3", 10)])
def test_against_brute_force_with_and_without_salting(make, mode, hub, min_hot):
    ids, edges, g = random_graph(make, hub=hub)
    got = ranks_of(influence_rank(g, rounds=7, mode=mode, min_hot_edges=min_hot, rounds_per_job=2))
    assert got == pytest.approx(brute(ids, edges, 7, normalized=mode == "normalized"), rel=1e-9)


def test_edges_of_strangers_do_not_count(make):
    g = CitationGraph(make.vertices({"A": [], "B": []}), make.edges([("X", "A"), ("A", "B"), ("B", "X")]))
    assert ranks_of(influence_rank(g, rounds=4)) == pytest.approx(brute("AB", [("A", "B", 1)], 4))


def test_graph_without_edges(make):
    g = CitationGraph(make.vertices({"A": []}), make.edges([("A", "A")]).limit(0), closed=True)
    assert ranks_of(influence_rank(g)) == {"A": 0.15}


def test_rank_does_not_depend_on_partitions(spark, make):
    _, _, g = random_graph(make)
    before = ranks_of(influence_rank(g))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        shuffled = CitationGraph(g.vertices.repartition(5), g.edges.orderBy("dst"), closed=True)
        assert ranks_of(influence_rank(shuffled)) == pytest.approx(before, rel=1e-9)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_unknown_mode(make):
    g = CitationGraph(make.vertices({"A": []}), make.edges([("A", "A")]))
    with pytest.raises(ValueError):
        influence_rank(g, mode="other")


def test_keys(make):
    ids, edges, g = random_graph(make)
    ordered = ordered_index(g)
    keys = {r.id: r.key for r in ordered.vertices.collect()}
    assert sorted(ids) == sorted(ids, key=keys.get)
    expected = sorted((keys[s], keys[d], float(w)) for s, d, w in edges)
    assert sorted(tuple(r) for r in ordered.edges.select("src", "dst", "weight").collect()) == expected
    assert hashed_index(g).edges.count() == len(edges)


def test_top_papers_break_ties_by_id(spark):
    ranks = spark.createDataFrame([("b", 2.0), ("a", 2.0 + 1e-13), ("c", 3.0), ("d", 1.0)], "id string, rank double")
    assert [r.id for r in top_papers(ranks, 3).collect()] == ["c", "a", "b"]


def test_authors(make, spark):
    authors = {
        "p": [("A1", "x"), ("A1", "x"), ("", "nobody"), (None, "null")],
        "q": [("A1", "y"), ("A2", None), ("A1", "x"), ("A2", None)],
        "r": [],
        "s": None,
    }
    v = make.vertices({i: [] for i in "pqrs"}, authors=authors)
    ranks = spark.createDataFrame([("p", 2.0), ("q", 3.0), ("r", 9.0), ("s", 1.0)], "id string, rank double")
    g = CitationGraph(v, make.edges([("p", "q")]))
    rows = [tuple(r) for r in author_influence(g, ranks).collect()]
    assert rows == [("A1", "x", 7.0, 2), ("A2", None, 6.0, 1), ("A1", "y", 3.0, 1)]
    assert len(author_influence(g, ranks, 2).collect()) == 2
    with pytest.raises(ValueError):
        author_influence(CitationGraph(v.drop("authors"), g.edges), ranks)


def test_authors_of_a_paper_are_sorted_once(make):
    v = make.vertices({"a": []}, authors={"a": [("A2", "y"), ("A1", "x"), ("A2", "y")]})
    ranks = v.select("id", F.lit(2.0).alias("rank"))
    scores = author_influence(CitationGraph(v, make.edges([])), ranks)
    assert [tuple(r) for r in scores.collect()] == [("A2", "y", 4.0, 1), ("A1", "x", 2.0, 1)]
    assert scores._jdf.queryExecution().optimizedPlan().toString().count("array_sort(") == 1


@pytest.mark.parametrize("min_hot_edges", [1_000_000, 3])
def test_rank_over_a_stored_adjacency(spark, make, tmp_path, min_hot_edges):
    names = [f"v{i}" for i in range(12)]
    edges = [(names[i % 12], names[(i * 5 + 1) % 12], 0.5 + i % 3) for i in range(40)] + [("v0", n, 1.0) for n in names[1:]]
    graph = CitationGraph(make.vertices({n: [] for n in names}), make.edges(edges), closed=True)
    kept = adjacency.save_adjacency(graph, str(tmp_path), 4, min_hot_edges)
    assert (kept.hot is not None) == (min_hot_edges == 3)
    for mode in ("raw", "normalized"):
        ranks = [{r.id: pytest.approx(r.rank) for r in influence_rank(graph, mode=mode, adjacency=a).collect()} for a in (kept, None)]
        assert {i: r.expected for i, r in ranks[0].items()} == ranks[1]
    layout = adjacency.load_adjacency(spark, str(tmp_path)).layout()
    sums = layout.edges.groupBy("dst").agg({"weight": "sum"}).toDF("src", "s")
    joined = layout.join_state(sums, "left")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    # the edges of the join are scanned in their buckets; only the sums move
    of_edges = plan[plan.index("SortMergeJoin") :].split("HashAggregate")[0]
    assert "Bucketed: true" in of_edges and "Exchange" not in of_edges.split("Bucketed: true")[0]


def test_an_adjacency_holds_no_cliques(make, tmp_path):
    vertices = make.vertices({"a": [], "b": []})
    graph = CitationGraph(vertices, make.edges([]), cliques=clique_of(vertices))
    with pytest.raises(ValueError):
        adjacency.save_adjacency(graph, str(tmp_path))
    with pytest.raises(ValueError):
        adjacency.load_adjacency(vertices.sparkSession, str(tmp_path))


def test_sources_are_counted_one_by_one_only_where_a_group_is_large(spark, make, monkeypatch):
    from citegraph.plans import layout

    counted, real = [], layout._total_and_largest
    monkeypatch.setattr(layout, "_total_and_largest", lambda *a: counted.append(real(*a)) or counted[-1])
    edges = make.edges([("h", f"v{i}") for i in range(40)] + [(f"v{i}", "h") for i in range(40)])
    calm = layout.place_by_source(edges, min_hot_edges=1000)
    assert calm.hot is None and len(counted) == 1 and counted[0][0] == 80
    calm.release()
    hot = layout.place_by_source(edges, min_hot_edges=20)
    assert [r.src for r in hot.hot.collect()] == ["h"] and len(counted) == 3
    assert hot.edges.count() == 80
    hot.release()


def test_ranks_of_hashed_keys_leave_out_a_vertex_without_id(spark, make):
    graph = CitationGraph(make.vertices({"a": [], "b": [], None: []}), make.edges([("a", "b")]), closed=True)
    found = {r.id: (r["rank"], r.title) for r in influence_rank(graph, rounds=1).collect()}
    assert found == {"a": (0.15, "title a"), "b": (pytest.approx(1.0), "title b")}
