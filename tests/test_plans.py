import os
import pathlib
import re
import time

import pytest
from pyspark.sql import functions as F

import checks.queries as Q
from checks.queries import QUERIES
from citegraph.operators import rank
from citegraph.operators.communities import _votes_per_pair, label_propagation
from citegraph.operators.dedupe import keep_last
from citegraph.operators.edges import citation_edges
from citegraph.operators.graph import CitationGraph
from citegraph.operators.louvain import louvain_one_sweep
from citegraph.operators.normalize import normalize_works
from citegraph.operators.rank import _shares, _shares_by_join, influence_rank
from citegraph.operators.search import keyword_search
from citegraph.plans.layout import place_by_source
from citegraph.plans.materialize import DROP_SHUFFLES, WRITTEN, checkpoint_dir, checkpointed, discard, materialize
from citegraph.sources.adjacency import save_adjacency
from citegraph.sources.works import read_works

SF = "/root/testdata/sf0.001"
PACKAGE = pathlib.Path(Q.__file__).parent.parent / "citegraph"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df)


@pytest.mark.parametrize("name", ["normalize_papers", "citation_edges", "star_edges", "author_influence", "render_nodes"])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not re.search("Python|CartesianProduct|NestedLoop", text)


def test_only_needed_columns_are_read(spark):
    works = Q.raw_works(spark, SF)
    text = plan(normalize_works(works).select("paperId", "year"))
    schema = re.search(r"ReadSchema: (.*)", text).group(1)
    assert "referenced_works" not in schema and "authorships" not in schema and "display_name" not in schema


def test_nested_fields_are_pruned(spark, tmp_path):
    path = str(tmp_path / "w")
    Q.raw_works(spark, SF).write.parquet(path)
    text = plan(normalize_works(read_works(spark, path, "parquet")).select("authors"))
    assert "lineage" not in re.search(r"ReadSchema: (.*)", text).group(1)


def test_year_filter_reaches_the_scan(spark):
    found = Q.records(spark, SF).filter("year = 1998")
    assert "EqualTo(year,1998)" in plan(found)


def test_limited_search_sorts_narrow_rows(spark):
    text = plan(keyword_search(Q.records(spark, SF), "red", 10))
    narrow = [line for line in text.splitlines() if "TakeOrderedAndProject(limit=10" in line]
    assert narrow and "authors" not in narrow[0]


def test_dedupe_does_not_shuffle_wide_records(spark):
    text = plan(keep_last(Q.records(spark, SF)))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_citation_edges_need_no_dedupe_shuffle(spark):
    vertices = Q.graph(spark, SF).vertices
    text = plan(citation_edges(vertices))
    assert "HashAggregate" not in text


def test_a_round_shuffles_only_its_messages(spark):
    layout = place_by_source(Q.graph(spark, SF).edges.select("src", "dst", "weight"), broadcast_max_rows=0)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(layout.partitions))
    try:
        sums = layout.edges.groupBy("dst").agg({"weight": "sum"}).toDF("src", "s")
        left_side = plan(layout.join_state(sums, "left")).split("InMemoryRelation")[0]
        assert "SortMergeJoin" in left_side and "Exchange" not in left_side
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        layout.release()


def test_author_scores_need_one_aggregate_without_distinct(spark):
    g, ranks = Q.graph(spark, SF), Q.raw_ranks(spark, SF)
    text = plan(rank.author_influence(g, ranks))
    assert text.count("HashAggregate") + text.count("SortAggregate") == 2 and "distinct" not in text


def test_checkpoint_folder_is_the_one_of_the_session(spark):
    folder = checkpoint_dir(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    files = materialize(spark.range(3)).inputFiles()
    assert files and all(folder in f for f in files)


def test_nothing_is_collected_beyond_bounded_rows():
    """Rows reach the driver only as one-row scalars and counts."""
    for path in PACKAGE.rglob("*.py"):
        if "llm" in path.parts:
            continue  # has its own bounds and tests
        text = path.read_text()
        assert not re.search(r"\.collect\(|\.toPandas\(|\.toLocalIterator\(|localCheckpoint|crossJoin|\.rdd\b", text), path
        assert not re.search(r"pandas_udf|applyInPandas|mapInPandas|F\.udf", text), path


def _shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


@pytest.mark.parametrize("write", [materialize, checkpointed])
def test_a_written_state_leaves_no_shuffle_files(spark, write):
    before = _shuffle_files(spark)
    kept = write(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n")))
    for _ in range(50):  # they are removed behind the back of the job
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert kept.agg(F.sum("n")).first()[0] == 1000
    assert spark.conf.get(DROP_SHUFFLES) == "false"


def _folders(spark) -> set[str]:
    folder = checkpoint_dir(spark).removeprefix("file:")
    return {f for f in os.listdir(folder) if f.startswith(WRITTEN)}


def test_intermediate_tables_are_deleted(spark, make, tmp_path):
    ids = [f"p{i}" for i in range(12)]
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :: 3]]
    graph = CitationGraph(make.vertices({i: [] for i in ids}), make.edges(pairs), closed=True)
    for work, left in (
        (lambda: label_propagation(graph), 1),
        (lambda: louvain_one_sweep(graph), 1),
        (lambda: influence_rank(graph, mode="normalized"), 1),
        (lambda: save_adjacency(graph, str(tmp_path / "adjacency")), 0),
    ):
        before = _folders(spark)
        result = work()
        assert len(_folders(spark) - before) == left
        assert left == 0 or result.count() == len(ids)


def test_only_written_tables_are_deleted(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "mine"))
    kept = materialize(spark.range(3))
    for table in (spark.read.parquet(str(tmp_path / "mine")), kept.unionByName(materialize(spark.range(3)))):
        with pytest.raises(ValueError):
            discard(table)
    assert os.path.exists(tmp_path / "mine") and kept.count() == 3


@pytest.mark.parametrize("min_hot", [1, 10**6])
def test_pairs_are_combined_where_they_are_placed(spark, min_hot):
    """One row per pair, for hot sources too, though the edges move once only."""
    edges = spark.range(40).select((F.col("id") % 3).alias("src"), (F.col("id") % 4).alias("dst"))
    layout = place_by_source(edges, min_hot_edges=min_hot, broadcast_max_rows=0, in_place=_votes_per_pair)
    assert (layout.hot is not None) == (min_hot == 1)
    assert sorted((r.src, r.dst, r.n) for r in layout.edges.select("src", "dst", "n").collect()) == sorted(
        (r.src, r.dst, r.n) for r in _votes_per_pair(edges).collect()
    )
    layout.release()


@pytest.mark.parametrize("min_hot", [1, 10**6])
def test_shares_are_those_of_the_join(spark, min_hot):
    edges = spark.range(60).select((F.col("id") % 7).alias("src"), F.col("id").alias("dst"), (1.0 + F.col("id") % 4).alias("weight"))
    layout = place_by_source(edges, min_hot_edges=min_hot, broadcast_max_rows=0, in_place=_shares, before=_shares_by_join)
    got = {(r.src, r.dst): r.weight for r in layout.edges.collect()}
    assert got == pytest.approx({(r.src, r.dst): r.weight for r in _shares_by_join(edges).collect()})
    layout.release()


def test_ordered_json_files_leave_no_shuffle_files(spark, monkeypatch):
    """The sort by number is of no use once the files are written."""
    monkeypatch.setattr(Q, "raw_works", lambda *_: raw)
    raw = materialize(Q.works_from_tables(spark, SF))
    before = _shuffle_files(spark)
    read = Q._json_records(spark, SF)
    for _ in range(50):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before and read.count() > 0
