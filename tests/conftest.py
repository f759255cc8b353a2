import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

VERTEX_DDL = (
    "id string, title string, venue string, year int, "
    "authors array<struct<authorId:string,name:string>>, referenced_works array<string>, cited_by_count int"
)
EDGE_DDL = "src string, dst string, weight double, edge_type string"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Builders of tiny vertex and edge tables."""

    class Make:
        @staticmethod
        def vertices(refs, **columns):
            rows = [
                (
                    i,
                    columns.get("titles", {}).get(i, f"title {i}"),
                    "v",
                    columns.get("years", {}).get(i, 2000),
                    columns.get("authors", {}).get(i, []),
                    r,
                    columns.get("cited", {}).get(i, 0),
                )
                for i, r in refs.items()
            ]
            return spark.createDataFrame(rows, VERTEX_DDL)

        @staticmethod
        def edges(pairs):
            rows = [(p[0], p[1], float(p[2]) if len(p) > 2 else 1.0, "citation") for p in pairs]
            return spark.createDataFrame(rows, EDGE_DDL)

        @staticmethod
        def records(rows):
            """Rows of (paperId, title, refs, record_seq, cited, year, venue, institutions)."""
            full = [tuple(r) + (None,) * (8 - len(r)) for r in rows]
            return spark.createDataFrame(
                [
                    (i, t, venue or "Unknown Venue", year if year is not None else -1, [], refs or [], cited or 0, inst or [], seq)
                    for i, t, refs, seq, cited, year, venue, inst in full
                ],
                "paperId string, title string, venue string, year int, "
                "authors array<struct<authorId:string,name:string>>, referenced_works array<string>, "
                "cited_by_count int, institutions array<string>, record_seq bigint",
            )

    return Make


def triples(edges):
    return sorted((r.src, r.dst, r.edge_type) for r in edges.collect())


def pairs(edges):
    return sorted((r.src, r.dst) for r in edges.collect())
