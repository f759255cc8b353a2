"""Raw work records to normalised papers, in one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citegraph.functions import works as w

#: Column that orders the records of one source; unique per record.
RECORD_ORDER = "record_seq"


def with_record_order(works: DataFrame) -> DataFrame:
    """Add the record order when the source has none. The number grows along
    each input split, so it is unique and needs no shuffle."""
    if RECORD_ORDER in works.columns:
        return works
    return works.withColumn(RECORD_ORDER, F.monotonically_increasing_id())


def normalize_works(works: DataFrame) -> DataFrame:
    """Normalised papers, one row per record with a non-empty id.

    ``institutions`` carries the lineage ids that the institution filter of the
    searches needs; ``record_seq`` decides which of several records of one id is
    first and which is last.
    """
    return (
        with_record_order(works)
        .select(
            w.paper_id().alias("paperId"),
            w.title().alias("title"),
            w.venue().alias("venue"),
            w.year().alias("year"),
            w.authors().alias("authors"),
            w.references().alias("referenced_works"),
            w.cited_by_count().alias("cited_by_count"),
            w.institution_ids().alias("institutions"),
            RECORD_ORDER,
        )
        .filter(valid_id("paperId"))
    )


def valid_id(column: str):
    return F.col(column).isNotNull() & (F.col(column) != "")


def to_vertices(papers: DataFrame, keep_references: bool = True) -> DataFrame:
    """Rename the key and keep the vertex columns. ``papers`` is unique by id."""
    columns = ["title", "venue", "year", "authors", "referenced_works", "cited_by_count"]
    if not keep_references:
        columns.remove("referenced_works")
    return papers.select(F.col("paperId").alias("id"), *columns)
