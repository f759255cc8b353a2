import random
import re

import pytest
from pyspark.sql import functions as F

from citegraph.operators import expand, search
from citegraph.plans import workflows
from citegraph.sources import record_store
from conftest import pairs, triples


def ids(df):
    return [r.paperId for r in df.collect()]


ROWS = [
    # id, title, refs, seq, cited, year, venue, institutions
    ("W1", "Deep Learning", ["W2"], 1, 5, 2020, "Nature", ["I1"]),
    ("W2", "deep graph learning", [], 2, 9, 2020, "nature physics", ["I2"]),
    ("W3", "learning DEEP", ["W1"], 3, 5, 2021, "Science", ["I1", "I9"]),
    ("W1", "Other title", [], 4, 99, 2020, "Nature", ["I1"]),
    ("W4", "shallow", [], 5, 1, 2020, "NATURE", []),
    ("W2", "deep learning again", [], 0, 2, 2020, "x", ["I2"]),
]


def test_keywords(make):
    assert search.parse_keywords(" deep learning, ,graphs") == ["deep", "learning", "graphs"]
    assert search.parse_keywords(["a b", " ", "c"]) == ["a", "b", "c"]
    papers = make.records(ROWS)
    # W2 counts with its first matching record, W1 only with the one that matches.
    assert ids(search.keyword_search(papers, "deep, learning")) == ["W1", "W3", "W2"]
    assert ids(search.keyword_search(papers, "deep learning", institution="I1")) == ["W1", "W3"]
    assert ids(search.keyword_search(papers, "deep learning", limit=2)) == ["W1", "W3"]
    assert ids(search.keyword_search(papers, "nothing")) == []


def test_pages(make):
    papers = make.records([(f"W{i:03d}", "t", [], i, 0) for i in range(30)])
    page = lambda **kw: ids(search.keyword_search(papers, "t", **kw))
    assert page(limit=10, offset=10) == [f"W{i:03d}" for i in range(10, 20)]
    assert page(limit=101, offset=20) == [f"W{i:03d}" for i in range(20, 30)]
    assert page(offset=25) == [f"W{i:03d}" for i in range(25, 30)]
    assert len(page()) == 30


def test_publications(make):
    papers = make.records(ROWS)
    assert ids(search.publication_search(papers, "Nature", 2020)) == ["W2", "W1", "W4"]
    assert ids(search.publication_search(papers, "learning", 2020, match="title")) == ["W1", "W2"]
    with pytest.raises(ValueError):
        search.publication_search(papers, "x", 2020, match="other")


def test_lookup_takes_the_last_record(make, spark):
    papers = make.records(ROWS)
    wanted = search.seed_ids(spark, ["https://openalex.org/W1", "W1", " ", "W2", "W99"])
    assert [tuple(r) for r in wanted.orderBy("ord").collect()] == [("W1", 0), ("W2", 1), ("W99", 2)]
    found = search.lookup_by_ids(papers, wanted)
    assert sorted((r.paperId, r.title) for r in found.collect()) == [("W1", "Other title"), ("W2", "deep graph learning")]


def test_preview(make):
    papers = make.records([(f"W{i}", f"t{i}", [], i, i, 2000 + i) for i in range(8)])
    rows = [tuple(r) for r in search.preview(papers).collect()]
    assert rows == [(n + 1, f"t{7 - n}", 2007 - n, f"W{7 - n}", 3) for n in range(5)]
    assert [r.n_more for r in search.preview(papers.limit(2)).collect()] == [0, 0]


def hops(papers, spark, seeds, k, cap):
    found = expand.expand_references(papers, search.seed_ids(spark, seeds), k, cap)
    return sorted((r.id, r.hop) for r in found.collect())


def test_a_trimmed_candidate_returns(make, spark):
    papers = make.records([("S", "s", ["a", "b", "c"], 1), ("a", "", ["d"], 2), ("b", "", ["c"], 3), ("c", "", [], 4), ("d", "", [], 5)])
    assert hops(papers, spark, ["S"], 1, 2) == [("S", 0), ("a", 1), ("b", 1)]
    assert hops(papers, spark, ["S"], 2, 2) == [("S", 0), ("a", 1), ("b", 1), ("c", 2), ("d", 2)]
    assert hops(papers, spark, ["S"], 2, 1) == [("S", 0), ("a", 1), ("d", 2)]  # d comes first, c is trimmed again
    assert hops(papers, spark, ["S"], 0, 2) == [("S", 0)]
    assert hops(papers, spark, ["X"], 3, 2) == []
    assert hops(papers, spark, ["S"], 4, None) == [("S", 0), ("a", 1), ("b", 1), ("c", 1), ("d", 2)]


def brute_expand(refs, seeds, k, cap):
    found = {s: 0 for s in seeds if s in refs}
    frontier = [s for s in seeds if s in refs]
    for hop in range(1, k + 1):
        candidates = list(dict.fromkeys(r for p in frontier for r in refs[p] if r not in found))
        candidates = candidates[:cap] if cap else candidates
        frontier = [c for c in candidates if c in refs]
        if not candidates:
            break
        found.update({c: hop for c in frontier})
    return sorted(found.items())


@pytest.mark.parametrize("cap", [None, 0, 3, 7])
def test_expansion_against_brute_force(make, spark, cap):
    rnd = random.Random(4)
    names = [f"p{i}" for i in range(40)]
    refs = {n: list(dict.fromkeys(rnd.choice(names + ["x", "y"]) for _ in range(rnd.randrange(5)))) for n in names}
    papers = make.records([(n, "t", r, i) for i, (n, r) in enumerate(refs.items())])
    seeds = ["p9", "p3", "nope", "p20"]
    assert hops(papers, spark, seeds, 3, cap) == brute_expand(refs, seeds, 3, cap)


def test_neighbourhood(make, spark):
    edges = make.edges([("a", "b"), ("c", "b"), ("c", "d"), ("d", "e"), ("a", "a"), ("b", "a")])
    found = expand.k_hop_neighborhood(edges, spark.createDataFrame([("a",)], "id string"))
    assert dict(found.collect()) == {"a": 0, "b": 1, "c": 2}


def test_keyword_graphs(make):
    papers = make.records(ROWS + [("W7", "centre", ["W1", "W3"], 7), ("W8", "deep learning", [], 8, 0, 2020, "v", ["I5"])])
    g = workflows.keyword_graph(papers, "deep learning", institution="I1")
    assert triples(g.edges) == [("W3", "W1", "citation")]
    star = workflows.keyword_graph(papers, "deep learning", central="https://openalex.org/W7")
    assert triples(star.edges) == sorted(
        [("W1", "W2", "seed_cite"), ("W3", "W1", "seed_cite"), ("W7", "W1", "central_cites"),
         ("W7", "W3", "central_cites"), ("W7", "W2", "fallback"), ("W7", "W8", "fallback")]
    )
    assert star.vertices.count() == 5
    # A centre that does not exist: citations as usual.
    missing = workflows.keyword_graph(papers, "deep learning", institution="I1", central="W999")
    assert triples(missing.edges) == [("W3", "W1", "citation")]
    # No citation inside the set: star around the smallest id.
    lonely = workflows.keyword_graph(papers, "deep learning", institution="I2", keep_references=False)
    assert lonely.edges.count() == 0 and "referenced_works" not in lonely.vertices.columns
    empty = workflows.keyword_graph(papers, "nothing", central="W7")
    assert empty.vertices.count() == 0 and empty.edges.columns == ["src", "dst", "weight", "edge_type"]


def test_id_graphs(make):
    papers = make.records([("S", "s", ["a", "b"], 1), ("a", "", ["b", "S"], 2), ("b", "", ["c"], 3), ("c", "", [], 4), ("z", "", ["c"], 5)])
    assert pairs(workflows.id_graph(papers, ["S"]).edges) == [("S", "a"), ("S", "b"), ("a", "S"), ("a", "b")]
    assert pairs(workflows.id_graph(papers, ["S"], 2).edges) == [("S", "a"), ("S", "b"), ("a", "S"), ("a", "b"), ("b", "c")]
    star = workflows.id_graph(papers, ["z", "S"], max_hops=0)
    assert triples(star.edges) == [("S", "z", "fallback"), ("z", "S", "fallback")]
    assert workflows.id_graph(papers, ["none"]).vertices.count() == 0


def test_publication_graphs(make):
    papers = make.records(ROWS)
    cited = workflows.publication_graph(papers, "nature", 2020)
    # The first matching record of W1 cites W2; the edge comes with its reverse.
    assert triples(cited.edges) == [("W1", "W2", "citation"), ("W2", "W1", "citation")]
    uncited = make.records([(i, "t", [], n, 0, 2000, "v", []) for n, i in enumerate("bac")])
    assert pairs(workflows.publication_graph(uncited, "v", 2000, fallback="star").edges) == [
        ("a", "b"), ("a", "c"), ("b", "a"), ("c", "a"),
    ]
    assert workflows.publication_graph(uncited.limit(1), "v", 2000).vertices.count() == 0


def test_a_store_finds_what_the_records_give(make, tmp_path):
    papers = make.records(ROWS + [("W5", None, ["W1"], 6, 3, None, None, ["I1", None, "I1"]), ("W6", "  deep\u00a0sea  learning", [], 7, 5, 2021, "Nature", [])])
    store = record_store.save_records(papers, str(tmp_path), 5)
    rows = lambda df: [tuple(r) for r in df.select(*papers.columns).collect()]
    for words in ("deep, learning", "ee earn", "DEEP deep", "nothing", "", "sea"):
        for limit, institution, offset in ((None, None, 0), (2, None, 0), (None, "I1", 0), (2, None, 1), (None, None, 1), (None, "none", 0)):
            expected = search.keyword_search(papers, words, limit, institution, offset)
            assert rows(store.keyword_search(words, limit, institution, offset)) == rows(expected), (words, limit, institution, offset)
    cursor = search.next_cursor(store.keyword_search("deep", 1))
    assert rows(store.keyword_search("deep", 2, after=cursor)) == rows(search.keyword_search(papers, "deep", 2, after=cursor))
    for text, year, match in (("nature", 2020, "venue"), ("unknown v", -1, "venue"), ("deep learning", 2020, "title"), ("x", 1999, "venue"), ("", 2021, "title")):
        expected = search.publication_search(papers, text, year, 3, match=match)
        assert rows(store.publication_search(text, year, 3, match=match)) == rows(expected), (text, match)
    with pytest.raises(ValueError):
        store.publication_search("x", 2020, match="author")
    some = search.seed_ids(papers.sparkSession, ["https://openalex.org/W2", "W5", "W9"])
    assert sorted(rows(store.lookup_by_ids(some)), key=str) == sorted(rows(search.lookup_by_ids(papers, some)), key=str)
    graphs = [workflows.id_graph(p, ["W3"], 2) for p in (store, papers)]
    assert pairs(graphs[0].edges) == pairs(graphs[1].edges)
    # a second store replaces the first, which its readers keep until it is dropped
    again = record_store.save_records(papers.where("paperId = 'W1'"), str(tmp_path), 3)
    assert ids(again.keyword_search("deep")) == ["W1"] and len(ids(store.keyword_search("deep"))) == 4
    assert len(record_store.drop_old_records(papers.sparkSession, str(tmp_path), 1)) == 1
    empty = record_store.save_records(papers.limit(0), str(tmp_path / "empty"), 3)
    assert ids(empty.keyword_search("deep")) == ids(empty.keyword_search("")) == ids(empty.lookup_by_ids(some)) == []


def test_a_store_reads_only_the_buckets_it_needs(make, tmp_path):
    papers = make.records([(f"W{i}", f"title{i} common", [f"W{i + 1}"], i, i % 7) for i in range(200)])
    store = record_store.save_records(papers, str(tmp_path), 16)
    files = lambda df: df.select(F.input_file_name().alias("f")).distinct().count()
    seeds = search.seed_ids(papers.sparkSession, ["W7", "W8"])
    assert files(store.near(seeds)) <= 2 < 16 == files(store.records)
    hits = store.hits(store._words(["title77"]))
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan)
    assert files(store.postings.where(F.col("bucket").isin(store.terms.where("term = 'title77'").first().bucket))) == 1
    assert ids(store.keyword_search("title77")) == ["W77"]
