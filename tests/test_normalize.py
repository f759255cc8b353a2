import string

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from citegraph.functions.text import CATALOGUE_PREFIX as P
from citegraph.functions.text import STRIP_CHARS, safe_name, strip_ws
from citegraph.operators import dedupe
from citegraph.operators.normalize import normalize_works, to_vertices
from citegraph.sources.schemas import PAPER, RAW_WORK, VERTEX


def work(id=None, title=None, display_name=None, year=None, venue=None, authorships=None, refs=None, cited=None):
    location = None if venue is None else ((venue,),)
    return (id, title, display_name, year, location, authorships, refs, cited)


def normalized(spark, *works):
    return normalize_works(spark.createDataFrame(list(works), RAW_WORK)).orderBy("record_seq").collect()


def test_ids_lose_every_prefix_and_outer_white_space(spark):
    rows = normalized(spark, work(f" {P}W1\t"), work(f"W{P}2 "), work(""), work(None), work("　"))
    assert [r.paperId for r in rows] == ["W1", "W2"]


def test_title_falls_back_on_empty_but_not_on_blank(spark):
    rows = normalized(
        spark,
        work("a", "", "shown"),
        work("b", "  ", "shown"),
        work("c", None, ""),
        work("d", "\n padded "),
        work("e", None, None),
    )
    assert [r.title for r in rows] == ["shown", "", "Untitled", "padded", "Untitled"]


def test_year_count_and_venue_defaults(spark):
    rows = normalized(
        spark, work("a", year=0, cited=None, venue=""), work("b", year=1999, cited=4, venue=" J "), work("c")
    )
    assert [(r.year, r.cited_by_count, r.venue) for r in rows] == [
        (-1, 0, "Unknown Venue"), (1999, 4, "J"), (-1, 0, "Unknown Venue"),
    ]


def test_authors_keep_order_repeats_and_null_names(spark):
    authorships = [((P + "A1", "x"), None), ((None, None), None), (None, None), ((P + "A1", "x"), None), ((" A2", "y"), None)]
    (row,) = normalized(spark, work("a", authorships=authorships))
    assert [tuple(a) for a in row.authors] == [("A1", "x"), ("", None), ("", ""), ("A1", "x"), (" A2", "y")]
    (none,) = normalized(spark, work("a"))
    assert none.authors == [] and none.referenced_works == [] and none.institutions == []


def test_references_are_clean_distinct_and_in_first_order(spark):
    (row,) = normalized(spark, work("a", refs=["W3", None, P + "W1", " W3 ", "", "W2", "W1\n"]))
    assert row.referenced_works == ["W3", "W1", "W2"]


def test_institutions_are_all_lineage_ids(spark):
    authorships = [((None, "x"), [(["I1", "I2"],), (None,)]), ((None, "y"), None), ((None, "z"), [(["I2", "I3"],)])]
    (row,) = normalized(spark, work("a", authorships=authorships))
    assert sorted(row.institutions) == ["I1", "I2", "I3"]


def test_record_order_is_added_and_unique(spark):
    works = spark.range(100, numPartitions=7).select(F.col("id").cast("string"))
    for field in RAW_WORK.fields[1:]:
        works = works.withColumn(field.name, F.lit(None).cast(field.dataType))
    assert normalize_works(works).select("record_seq").distinct().count() == 100


def test_schemas(spark):
    papers = normalize_works(spark.createDataFrame([work("a")], RAW_WORK))
    assert [f.name for f in PAPER.fields] == papers.columns[:7]
    vertices = to_vertices(papers)
    assert vertices.columns == VERTEX.fieldNames()
    assert [f.dataType.simpleString() for f in vertices.schema] == [f.dataType.simpleString() for f in VERTEX]
    assert "referenced_works" not in to_vertices(papers, keep_references=False).columns


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=STRIP_CHARS + "ab​᠎", max_size=8), min_size=1, max_size=30))
def test_strip_is_the_strip_of_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.s for r in df.select("i", strip_ws(F.col("t")).alias("s")).orderBy("i").collect()]
    assert got == [t.strip() for t in texts]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=string.printable + "éß中٣Ⅷ½́", max_size=100), min_size=1, max_size=20))
def test_safe_names(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.s for r in df.select("i", safe_name(F.col("t")).alias("s")).orderBy("i").collect()]
    assert got == ["".join(c if c.isalnum() or c in "-_" else "_" for c in t)[:80] for t in texts]


@pytest.mark.parametrize("keep, expected", [("last", "third"), ("first", "first")])
def test_duplicates_by_order(make, keep, expected):
    records = make.records([("a", "second", [], 2), ("a", "first", [], 1), ("b", "other", [], 4), ("a", "third", [], 3), ("", "none", [], 5)])
    kept = dedupe.keep_last(records) if keep == "last" else dedupe.keep_first(records)
    assert sorted((r.paperId, r.title) for r in kept.collect()) == [("a", expected), ("b", "other")]


def test_duplicates_by_hop(make):
    records = make.records([("a", "far", [], 1), ("a", "near late", [], 3), ("a", "near early", [], 2)])
    records = records.withColumn("hop", F.when(F.col("title") == "far", 2).otherwise(1))
    assert [r.title for r in dedupe.keep_lowest_hop(records).collect()] == ["near early"]


def test_one_id_with_a_third_of_all_records(spark, make):
    one = make.records([("a", "t", [], 0)])
    many = spark.range(3000).withColumn("n", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")))
    records = one.drop("paperId", "record_seq").join(many).select(
        F.col("n").alias("paperId"), *[c for c in one.columns if c not in ("paperId", "record_seq")], F.col("id").alias("record_seq")
    )
    kept = dedupe.keep_last(records)
    assert kept.count() == 2001
    assert kept.filter("paperId = 'hot'").first().record_seq == 2997


def test_ordered_json_files_grow_in_number_not_in_size(spark, tmp_path, monkeypatch):
    from checks import queries as Q
    from pyspark.sql import types as T

    from citegraph.sources.schemas import RAW_WORK

    blank = {f.name: None for f in RAW_WORK.fields}
    rows = [{**blank, "id": f"W{i % 40}", "title": f"t{i}", "record_seq": i} for i in range(90)]
    fields = [*RAW_WORK.fields, T.StructField("record_seq", T.LongType())]
    raw = spark.createDataFrame(rows, T.StructType(fields))
    monkeypatch.setattr(Q, "raw_works", lambda *_: raw)
    monkeypatch.setattr(Q, "RECORDS_PER_FILE", 10)
    monkeypatch.setattr(Q, "checkpoint_dir", lambda _: str(tmp_path))
    last = {r.paper_id: r.title for r in Q.json_last_wins(spark, "").collect()}
    first = {r.paper_id: r.title for r in Q.json_first_wins(spark, "").collect()}
    assert last == {f"W{i % 40}": f"t{i}" for i in range(90)}
    assert first == {f"W{i}": f"t{i}" for i in range(40)}
    assert all(len(list(d.glob("part-*.json"))) == 9 for d in tmp_path.glob("works-*"))
