import glob
import json
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks import queries
from citegraph.operators.graph import CitationGraph
from citegraph.operators.normalize import normalize_works
from citegraph.sources import graph_store, tables, works
from citegraph.sources.schemas import EDGE, VERTEX
from conftest import pairs


def test_read_works_from_json_and_parquet(spark, tmp_path):
    path = tmp_path / "works.json"
    path.write_text(
        json.dumps({"id": "https://openalex.org/W1", "title": "t", "extra": 1, "publication_year": 2000,
                    "primary_location": {"source": {"display_name": "J"}},
                    "authorships": [{"author": {"id": "https://openalex.org/A1", "display_name": "x"}, "institutions": [{"lineage": ["I1"]}]}]}) + "\n"
        + json.dumps({"id": "https://openalex.org/W2", "primary_location": None}) + "\n"
    )
    raw = works.read_works(spark, str(path))
    rows = {r.paperId: r for r in normalize_works(raw).collect()}
    assert rows["W1"].venue == "J" and rows["W2"].venue == "Unknown Venue"
    assert rows["W1"].institutions == ["I1"] and tuple(rows["W1"].authors[0]) == ("A1", "x")
    raw.write.parquet(str(tmp_path / "works.parquet"))
    again = works.read_works(spark, str(tmp_path / "works.parquet"), "parquet")
    assert sorted(again.collect()) == sorted(raw.collect())


def test_read_papers_keeps_what_fits_and_counts_rejects(spark, tmp_path):
    path = tmp_path / "papers.json"
    path.write_text('{"paperId": "a", "year": "x", "title": "t"}\n{broken\n{"paperId": ""}\n{"paperId": "b", "year": 3}\n')
    papers = works.read_papers(spark, str(path), "json")
    assert {r.paperId: r.year for r in papers.collect()} == {"a": None, "b": 3}
    assert tuple(works.count_rejects(spark, str(path)).first()) == (4, 2, 2)


def test_archive(spark, tmp_path):
    raw = spark.createDataFrame([("W1", "t")], "id string, title string")
    path = works.archive_raw(raw, str(tmp_path), "keyword_deep learning/é", {"limit": 7})
    assert "/raw_json/keyword_deep_learning_é_" in path and path.endswith("Z")
    assert glob.glob(f"{path}/*.json.gz")
    assert spark.read.json(path).first().query_limit == 7
    assert [r.id for r in works.read_archive(spark, path).collect()] == ["W1"]
    at = datetime(2024, 5, 6, 7, 8, 9)
    assert works.archive_path(spark, "x", "n" * 99, at) == "x/raw_json/" + "n" * 80 + "_20240506T070809Z"


def test_one_pass_parts_papers_from_rejects(spark, tmp_path):
    path = tmp_path / "papers.json"
    lines = ['{"paperId": "a", "year": "x", "title": "t"}', "{broken", '{"paperId": ""}', "", '{"paperId": "b", "year": 3}', '{"year": "x"}', '{"paperId": "c"']
    path.write_text("\n".join(lines) + "\n")
    got = works.ingest_papers(spark, str(path), str(tmp_path / "kept"))
    assert {r.paperId: (r.title, r.year) for r in got.papers.collect()} == {"a": ("t", None), "b": (None, 3)}
    rejects = got.rejects.orderBy("place").collect()
    assert [(r.line, r.reason, r.kept) for r in rejects] == [
        (lines[0], "wrong type", True), (lines[1], "not json", False), (lines[2], "no id", False),
        (lines[5], "wrong type", False), (lines[6], "not json", False),
    ]
    assert all(r.file.endswith("papers.json") for r in rejects)
    assert tuple(got.counts[n] for n in ("n_records", "n_rejected", "n_without_id")) == tuple(works.count_rejects(spark, str(path)).first())
    empty = tmp_path / "empty.json"
    empty.write_text("\n")
    none = works.ingest_papers(spark, str(empty), str(tmp_path / "none"))
    assert none.papers.isEmpty() and none.rejects.isEmpty() and none.counts["n_records"] == 0


def test_archives_are_found_by_name_and_time(spark, tmp_path):
    folder = str(tmp_path)
    assert works.archives(spark, folder).isEmpty() and works.read_archives(spark, folder).isEmpty()
    made = lambda i: spark.createDataFrame([(f"W{i}", f"t{i}")], "id string, title string")
    works.archive_raw(made(1), folder, "keyword_a b", {"limit": None})
    works.archive_raw(made(2), folder, "ids", {"limit": 7})
    listed = {r.query: r for r in works.archives(spark, folder).collect()}
    assert (listed["ids"].n_works, listed["ids"].parameters, listed["keyword_a b"].parameters) == (1, '{"limit": 7}', '{"limit": null}')
    # the folder of the other archive is not even listed
    found = works.read_archives(spark, folder, "ids")
    assert [r.id for r in found.collect()] == ["W2"] and all("/ids_" in f for f in found.inputFiles())
    assert sorted(r.id for r in works.read_archives(spark, folder).collect()) == ["W1", "W2"]
    at = listed["ids"].saved_at
    assert works.archives(spark, folder, until=at.replace(year=2000)).isEmpty()
    assert works.archives(spark, folder, "ids", since=at.replace(year=2000)).count() == 1


def test_builders_archive_what_they_found(spark, tmp_path):
    from citegraph.plans import workflows

    line = '{"id": "https://openalex.org/%s", "title": "%s", "publication_year": 2000, "referenced_works": ["https://openalex.org/W2"], "primary_location": {"source": {"display_name": "J"}}}\n'
    path = tmp_path / "works.json"
    path.write_text(line % ("W1", "deep sea") + line % ("W2", "other") + line % ("W1", "deep sea again") + line % ("W3", "deep"))
    raw = works.read_works(spark, str(path))
    records, archive = normalize_works(raw), workflows.Archive(raw, str(tmp_path / "out"))
    workflows.keyword_graph(records, "deep", 10, central="W2", archive=archive)
    workflows.id_graph(records, ["W1"], max_hops=1, archive=archive)
    workflows.publication_graph(records, "j", 2000, archive=archive)
    workflows.keyword_graph(records, "nothing", archive=archive)
    ids = lambda name: sorted((r.id[-2:], r.title) for r in works.read_archives(spark, archive.folder, name).collect())
    assert ids("keyword_deep") == [("W1", "deep sea"), ("W3", "deep")]
    assert ids("keyword_central_paper") == [("W2", "other")]
    assert ids("publication_j_2000") == [("W1", "deep sea"), ("W2", "other"), ("W3", "deep")]
    assert [i for i, _ in ids("ids")] == ["W1", "W2"]
    assert works.archives(spark, archive.folder).count() == 4


def test_a_graph_is_replaced_as_a_whole(spark, make, tmp_path, monkeypatch):
    old = CitationGraph(make.vertices({"a": ["b"], "b": []}), make.edges([("a", "b")]), closed=True)
    new = CitationGraph(make.vertices({"c": ["d"], "d": []}), make.edges([("c", "d")]), closed=True)
    root, ids = str(tmp_path), lambda g: ({r.id for r in g.vertices.collect()}, pairs(g.edges))
    graph_store.save_graph(old, "g", root)
    reader = graph_store.load_graph(spark, "g", root)

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        # vertices and edges are written, nothing is in force
        m.setattr(graph_store.versions, "commit", stop)
        with pytest.raises(RuntimeError):
            graph_store.save_graph(new, "g", root)
    assert ids(graph_store.load_graph(spark, "g", root)) == ({"a", "b"}, [("a", "b")])
    broken = CitationGraph(new.vertices, new.edges.withColumn("weight", F.raise_error(F.lit("lost")).cast("double")), closed=True)
    with pytest.raises(Exception, match="lost"):
        graph_store.save_graph(broken, "g", root)
    assert ids(graph_store.load_graph(spark, "g", root)) == ({"a", "b"}, [("a", "b")])
    graph_store.save_graph(new, "g", root)
    assert ids(graph_store.load_graph(spark, "g", root)) == ({"c", "d"}, [("c", "d")])
    assert ids(reader) == ({"a", "b"}, [("a", "b")])  # started before, reads on
    assert graph_store.drop_old_graphs(spark, "g", root) == []
    assert len(graph_store.drop_old_graphs(spark, "g", root, keep=1)) == 1
    assert ids(graph_store.load_graph(spark, "g", root)) == ({"c", "d"}, [("c", "d")])


def test_a_graph_saved_without_versions_loads(spark, make, tmp_path):
    v, e = make.vertices({"a": ["b"], "b": []}), make.edges([("a", "b")])
    graph_store.save_graph(CitationGraph(v, e, closed=True), "g", str(tmp_path))
    paths = [*graph_store.graph_paths(str(tmp_path), "plain"), f"{tmp_path}/processed/plain_cliques"]
    v.write.partitionBy("year").parquet(paths[0])
    e.write.parquet(paths[1])
    spark.createDataFrame([], graph_store.CLIQUE).write.parquet(paths[2])
    back = graph_store.load_graph(spark, "plain", str(tmp_path))
    assert sorted(back.vertices.collect()) == sorted(v.collect()) and pairs(back.edges) == [("a", "b")]


def test_graph_roundtrip(spark, make, tmp_path):
    v = make.vertices({"a": ["b"], "b": [], "c": ["a"]}, years={"a": -1, "b": 2000, "c": 2001})
    g = CitationGraph(v, make.edges([("a", "b"), ("c", "a")]), closed=True)
    for files in (None, 3):
        paths = graph_store.save_graph(g, "g", str(tmp_path), edge_files=files)
        assert paths == (f"{tmp_path}/processed/g_vertices", f"{tmp_path}/processed/g_edges_weighted")
        back = graph_store.load_graph(spark, "g", str(tmp_path))
        assert back.vertices.columns == VERTEX.fieldNames() and back.edges.columns == EDGE.fieldNames()
        assert sorted(back.vertices.collect()) == sorted(v.collect())
        assert sorted(back.edges.collect()) == sorted(g.edges.collect())
    some = graph_store.load_graph(spark, "g", str(tmp_path), years=[-1, 2000])
    assert pairs(some.edges) == [("a", "b")]
    plan = some.vertices._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [year" in plan
    without = CitationGraph(v.drop("referenced_works"), g.edges, closed=True)
    graph_store.save_graph(without, "small", str(tmp_path))
    assert "referenced_works" not in graph_store.load_graph(spark, "small", str(tmp_path), keep_references=False).vertices.columns


def test_render_tables(spark, tmp_path):
    nodes = spark.createDataFrame([("a", 1.0)], "id string, size double")
    paths = graph_store.save_render_tables(nodes, nodes, "g", str(tmp_path))
    assert spark.read.json(paths[0]).first().id == "a"


def test_records_of_several_files_keep_their_order(spark, tmp_path):
    """The later file is the larger one, which is dealt to the first task."""
    path = tmp_path / "snapshot"
    path.mkdir()
    line = '{"id": "https://openalex.org/W%d", "title": "%s"}\n'
    (path / "2024-01.json").write_text(line % (1, "old") + line % (2, "first"))
    (path / "2024-02.json").write_text("".join(line % (i, "pad" * 30) for i in range(10, 400)) + line % (1, "new") + line % (1, "newest"))
    from citegraph.operators.dedupe import keep_first, keep_last
    from citegraph.operators.normalize import normalize_works

    records = normalize_works(works.read_works(spark, str(path)))
    assert records.select("record_seq").distinct().count() == records.count()
    title = lambda papers: papers.filter("paperId = 'W1'").first().title
    assert (title(keep_first(records)), title(keep_last(records))) == ("old", "newest")


def _tables(spark, folder, orders, lines):
    every = {
        "lineitem": (lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int"),
        "orders": (orders, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp"),
        "customer": ([(1, 0)], "c_custkey bigint, c_nationkey int"),
        "nation": ([(0, 0)], "n_nationkey int, n_regionkey int"),
        "part": ([(k, f"red gear {k}", "TIN", "Brand#1", k) for k in range(1, 40)], "p_partkey bigint, p_name string, p_type string, p_brand string, p_size int"),
    }
    for name, (rows, ddl) in every.items():
        spark.createDataFrame(rows, ddl).write.parquet(f"{folder}/{name}.parquet")


def test_works_of_orders_without_lines_with_many_and_with_null_keys(spark, tmp_path):
    """Every line of a known order is in one work, an order without lines is one, blocks without lines are none."""
    many = [(2, 4, 5, 1)] * 20 + [(2, None, 5, 1)]
    _tables(spark, tmp_path, [(1, 1, None), (2, 1, None), (3, 1, None), (None, 1, None)], [(1, 4, 6, 2), *many, (None, 9, 9, 1)])
    works = tables.works_from_tables(spark, str(tmp_path)).where(
        F.col("record_seq").isNull() | (F.col("record_seq") % tables.BLOCK_OFFSET < tables.SECOND_RECORD_OFFSET)
    )
    # order 2 has 21 lines, so three blocks: all lines but one fall into the same, and that one has no part
    block = (4 * 31 + 5 * 7 + 1) % 3
    found = Counter((r.record_seq, r.n) for r in works.select("record_seq", F.size(F.coalesce("authorships", F.array())).alias("n")).collect())
    assert found == Counter([(1, 1), (2 + block * tables.BLOCK_OFFSET, 1), (2, 1), (3, 0), (None, 0)])


def test_lines_move_as_lines(spark, tmp_path):
    """Sets of a few lines are larger than the lines, so nothing is collected before the shuffle."""
    _tables(spark, tmp_path, [(1, 1, None)], [(1, 4, 6, 2)])
    plan = tables.works_from_tables(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    final, partial = plan.index("[min(l_partkey"), plan.index("partial_collect_set")
    assert "Exchange" not in plan[final:partial] and "Exchange" in plan[partial:]


def test_records_of_tables_need_no_written_raw_works(spark, tmp_path):
    folder = str(tmp_path)
    _tables(spark, tmp_path, [(1, 1, None), (2, 2, None), (3, None, None)], [(1, 1, 1, 1), (1, 2, 1, 2), (2, 1, 2, 1)])
    records = queries.records(spark, folder)
    assert (spark.sparkContext.applicationId, folder, "raw_works") not in queries._shared
    expected = normalize_works(queries.raw_works(spark, folder))
    assert records.dtypes == expected.dtypes
    assert sorted(records.collect(), key=str) == sorted(expected.collect(), key=str) and not records.isEmpty()
    assert queries.weighted(spark, folder).edges.inputFiles() == queries.graph(spark, folder).edges.inputFiles()
