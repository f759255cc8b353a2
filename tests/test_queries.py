import pytest

import __spark_entry__ as entry_point
from checks.compare import connect, differences
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
ROWS_ONLY = {"louvain", "louvain_stats"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    top = entry_point.entry(spark)
    assert top.columns == ["id", "title", "log_rank"] and top.count() == 10


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    _, problem = differences(entry_point.queries()[name](spark, SF), con, entry_point.oracle_sql()[name])
    assert not problem


def test_louvain_properties(spark):
    import checks.queries as Q
    from citegraph.operators.communities import modularity

    g = Q.graph(spark, SF)
    found = Q.louvain_communities(spark, SF)
    assert found.count() == g.vertices.count() == found.select("id").distinct().count()
    sizes = [r["n"] for r in found.groupBy("community").count().withColumnRenamed("count", "n").orderBy("community").collect()]
    assert sizes == sorted(sizes, reverse=True)
    q = entry_point.queries()["louvain_stats"](spark, SF).first().q
    alone = modularity(g.edges, g.vertices.selectExpr("id", "id as community")).first().q
    by_label = entry_point.queries()["community_stats"](spark, SF).first().q
    assert q > 0.25 and q > alone and q > by_label
