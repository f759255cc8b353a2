"""Column expressions over a raw work record (see ``schemas.RAW_WORK``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citegraph.functions.text import bare_id, non_empty, strip_prefix, strip_ws

UNTITLED = "Untitled"
UNKNOWN_VENUE = "Unknown Venue"
UNKNOWN_YEAR = -1


def paper_id() -> Column:
    return bare_id(F.col("id"))


def title() -> Column:
    """Title, else display name, else a placeholder. An empty text counts as
    missing, a blank one does not: it is kept and stripped to ``''``."""
    return strip_ws(
        F.coalesce(non_empty(F.col("title")), non_empty(F.col("display_name")), F.lit(UNTITLED))
    )


def venue() -> Column:
    name = F.col("primary_location.source.display_name")
    return strip_ws(F.coalesce(non_empty(name), F.lit(UNKNOWN_VENUE)))


def year() -> Column:
    return F.coalesce(F.nullif(F.col("publication_year"), F.lit(0)), F.lit(UNKNOWN_YEAR))


def cited_by_count() -> Column:
    return F.coalesce(F.col("cited_by_count"), F.lit(0))


def authors() -> Column:
    """Order is kept and an author listed twice stays listed twice. A missing
    author object gives an empty name; a null name inside one stays null."""

    def one(a: Column) -> Column:
        return F.struct(
            strip_prefix(F.coalesce(a["author"]["id"], F.lit(""))).alias("authorId"),
            F.when(a["author"].isNull(), F.lit("")).otherwise(a["author"]["display_name"]).alias("name"),
        )

    return F.coalesce(F.transform("authorships", one), F.array().cast("array<struct<authorId:string,name:string>>"))


def references() -> Column:
    """Distinct, non-empty, bare reference ids in order of first occurrence."""
    cleaned = F.transform("referenced_works", bare_id)
    return F.coalesce(
        F.array_distinct(F.filter(cleaned, lambda r: r != "")), F.array().cast("array<string>")
    )


def institution_ids() -> Column:
    """All institution ids in the lineages of all authors of the work."""
    no_ids = F.array().cast("array<string>")

    def of_author(a: Column) -> Column:
        lineages = F.transform(a["institutions"], lambda i: F.coalesce(i["lineage"], no_ids))
        return F.coalesce(F.flatten(lineages), no_ids)

    return F.coalesce(F.array_distinct(F.flatten(F.transform("authorships", of_author))), no_ids)


def has_institution(institution: str) -> Column:
    """Any author of the raw work belongs to the institution or one below it."""
    return F.coalesce(
        F.exists(
            "authorships",
            lambda a: F.exists(
                a["institutions"],
                lambda i: F.coalesce(F.array_contains(i["lineage"], institution), F.lit(False)),
            ),
        ),
        F.lit(False),
    )
