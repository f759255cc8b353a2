import random

from conftest import pairs, triples

from citegraph.operators import edges as E
from citegraph.operators.graph import CitationGraph, graph_stats


def test_citations_stay_inside_the_set(make):
    v = make.vertices({"A": ["B", "C", "B"], "B": ["A"], "C": [], "D": None, "E": ["E", "X", "", None]})
    found = E.citation_edges(v)
    assert triples(found) == [(s, d, "citation") for s, d in [("A", "B"), ("A", "C"), ("B", "A"), ("E", "E")]]
    assert {r.weight for r in found.collect()} == {1.0}


def test_star_has_four_kinds_and_a_double_self_loop(make):
    v = make.vertices({"c": ["A", "c"], "A": ["B"], "B": ["c"], "D": [], "F": ["A", "X"]})
    assert triples(E.star_edges(v, "c")) == sorted(
        [
            ("A", "B", "seed_cite"),
            ("F", "A", "seed_cite"),
            ("c", "A", "central_cites"),
            ("c", "c", "central_cites"),
            ("c", "c", "cites_central"),
            ("B", "c", "cites_central"),
            ("c", "D", "fallback"),
            ("c", "F", "fallback"),  # reachable through A, but not linked directly
        ]
    )


def test_star_around_a_missing_centre_has_citations_only(make):
    v = make.vertices({"A": ["B", "z"], "B": []})
    assert triples(E.star_edges(v, "z")) == [("A", "B", "seed_cite")]


def test_star_fallback(make):
    assert pairs(E.star_fallback_edges(make.vertices({"b": [], "a": [], "c": []}))) == [
        ("a", "b"), ("a", "c"), ("b", "a"), ("c", "a"),
    ]
    one = E.star_fallback_edges(make.vertices({"a": []}))
    assert one.count() == 0 and one.columns == ["src", "dst", "weight", "edge_type"]


def test_mirror_doubles_mutual_and_self_citations(make):
    e = make.edges([("A", "B"), ("B", "A"), ("C", "C")])
    assert pairs(E.symmetrize(e)) == [("A", "B")] * 2 + [("B", "A")] * 2 + [("C", "C")] * 2
    assert pairs(E.symmetrize(e, dedupe=True)) == [("A", "B"), ("B", "A"), ("C", "C")]


def test_undirected_sums_both_directions(make):
    e = make.edges([("A", "B", 1), ("B", "A", 2), ("A", "B", 4), ("C", "C", 3)])
    assert sorted((r.a, r.b, r.weight) for r in E.undirected_edges(e).collect()) == [("A", "B", 7.0), ("C", "C", 3.0)]


def test_closed_edges_and_stats(make):
    v = make.vertices({"A": [], "B": []})
    g = CitationGraph(v, make.edges([("A", "B"), ("A", "X"), ("X", "B")]))
    assert pairs(g.closed_edges()) == [("A", "B")]
    assert tuple(graph_stats(g).first()) == (2, 3)


def test_random_graphs_against_brute_force(make):
    rnd = random.Random(3)
    ids = [f"n{i}" for i in range(30)]
    refs = {i: [rnd.choice(ids + ["x1", "x2"]) for _ in range(rnd.randrange(6))] for i in ids}
    v = make.vertices(refs)
    expected = sorted({(a, b) for a, r in refs.items() for b in r if b in refs})
    assert pairs(E.citation_edges(v)) == expected
    c = "n7"
    linked = {b for a, b in expected if a == c} | {a for a, b in expected if b == c}
    star = [(a, b, "seed_cite") for a, b in expected if c not in (a, b)]
    star += [(a, b, "central_cites") for a, b in expected if a == c]
    star += [(a, b, "cites_central") for a, b in expected if b == c]
    star += [(c, i, "fallback") for i in ids if i != c and i not in linked]
    assert triples(E.star_edges(v, c)) == sorted(star)
