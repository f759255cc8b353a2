"""Selecting papers: text search, venue search, lookup by id, preview.

The input is the normalised record table, which may hold several records of one
id. A search keeps the first matching record of an id, a lookup the last record.

A limited search works in two steps: a narrow pass over the matching records finds
the ids and records that are wanted, then a join with at most ``limit`` rows
fetches the wide records. So copies of an id are combined before the shuffle and
wide records are moved for the result only.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citegraph.functions.text import CATALOGUE_PREFIX, contains_all, strip_prefix
from citegraph.operators.normalize import RECORD_ORDER, valid_id
from citegraph.plans.keys import numbered_rows
from citegraph.plans.materialize import materialize

_RESULT_ORDER = (F.desc, "cited_by_count"), (F.asc, "paperId")


def parse_keywords(keywords: str | list[str]) -> list[str]:
    """Search tokens: a text is split on commas and stripped; the parts are then
    split on white space. Empty parts add nothing to a search and are dropped."""
    parts = keywords.split(",") if isinstance(keywords, str) else keywords
    return [token for part in parts for token in part.split()]


def in_institution(institution: str | None) -> Column:
    """Normalised form of the institution filter; without one every paper passes."""
    if institution is None:
        return F.lit(True)
    return F.coalesce(F.array_contains("institutions", institution), F.lit(False))


def result_order() -> list[Column]:
    return [direction(column) for direction, column in _RESULT_ORDER]


def _first_matches(
    papers: DataFrame, match: Column, limit: int | None, offset: int = 0, after: str | None = None
) -> DataFrame:
    match = match & valid_id("paperId")
    hits = first_hits(papers.filter(match), limit, offset, after)
    # The filter is repeated, so that it reaches the scan of the wide records too.
    return papers.filter(match).join(hits.drop("_cited"), ["paperId", RECORD_ORDER], "left_semi").select(*papers.columns)


def first_hits(hits: DataFrame, limit: int | None, offset: int = 0, after: str | None = None) -> DataFrame:
    """``paperId, record_seq, _cited`` of the first of the ``hits`` of every id, behind the cursor and the offset."""
    hits = (
        hits.groupBy("paperId")
        .agg(
            F.min(RECORD_ORDER).alias(RECORD_ORDER),
            F.min_by("cited_by_count", RECORD_ORDER).alias("_cited"),
        )
    )
    if after is not None:
        cited, paper = _read_cursor(after)
        hits = hits.where((F.col("_cited") < cited) | ((F.col("_cited") == cited) & (F.col("paperId") > paper)))
    order = [F.desc("_cited"), F.asc("paperId")]
    if limit is not None:
        hits = hits.orderBy(*order).offset(offset).limit(limit)
    elif offset:
        # an offset alone would bring all results to one task
        hits = numbered_rows(hits, order, "_at").where(F.col("_at") >= offset).drop("_at")
    return hits


def keyword_search(
    papers: DataFrame,
    keywords: str | list[str],
    limit: int | None = None,
    institution: str | None = None,
    offset: int = 0,
    after: str | None = None,
) -> DataFrame:
    """Papers whose title holds every token, most cited first, ties by id.

    Results up to the cursor ``after`` and then ``offset`` more are skipped, then at
    most ``limit`` returned.
    """
    match = contains_all(F.col("title"), parse_keywords(keywords)) & in_institution(institution)
    return _first_matches(papers, match, limit, offset, after).orderBy(*result_order())


def next_cursor(page: DataFrame) -> str | None:
    """A token for the place behind the last row of a page of results; None after an empty page."""
    last = page.agg(F.max(F.struct((-F.col("cited_by_count").cast("bigint")).alias("place"), "paperId"))).first()[0]
    if last is None:
        return None
    return base64.urlsafe_b64encode(json.dumps([-last["place"], last["paperId"]]).encode()).decode()


def _read_cursor(token: str) -> tuple[int, str]:
    try:
        cited, paper = json.loads(base64.urlsafe_b64decode(token.encode()))
    except ValueError as error:
        raise ValueError(f"no cursor: {token!r}") from error
    return int(cited), str(paper)


def keyword_pages(
    papers: DataFrame, keywords: str | list[str], per_page: int, institution: str | None = None
) -> Iterator[DataFrame]:
    """All results of a search in pages, written one after the other.

    Each page is a filter behind the last result and a bounded top ``per_page``, so a
    late page costs no more than the first and none skips rows.
    """
    after = None
    while True:
        page = materialize(keyword_search(papers, keywords, per_page, institution, after=after))
        after = next_cursor(page)
        if after is None:
            return
        yield page


def publication_search(
    papers: DataFrame,
    publication: str,
    year: int,
    limit: int | None = None,
    institution: str | None = None,
    match: str = "venue",
    offset: int = 0,
) -> DataFrame:
    """Papers of a year whose venue contains the text (``match="venue"``) or whose
    title holds its tokens (``match="title"``)."""
    if match == "venue":
        found = F.contains(F.lower("venue"), F.lit(publication.lower()))
    elif match == "title":
        found = contains_all(F.col("title"), publication.split())
    else:
        raise ValueError(f"unknown match {match!r}")
    found = found & (F.col("year") == year) & in_institution(institution)
    return _first_matches(papers, found, limit, offset).orderBy(*result_order())


def bare_ids(ids: list[str]) -> list[str]:
    """The given ids without prefix, in input order, repeats and empty ids left out."""
    bare = [i.replace(CATALOGUE_PREFIX, "").strip() for i in ids]
    return list(dict.fromkeys(i for i in bare if i))


def seed_ids(spark: SparkSession, ids: list[str]) -> DataFrame:
    """``id, ord`` of the given ids without prefix, in input order, repeats and
    empty ids left out."""
    return spark.createDataFrame([(i, n) for n, i in enumerate(bare_ids(ids))], "id string, ord int")


def lookup_by_ids(papers: DataFrame, ids: DataFrame) -> DataFrame:
    """Last record of every paper whose id is in ``ids`` (column ``id``, with or
    without prefix). Unknown ids are silently absent. Which record is the last is
    found on narrow rows, combined per id; the wide ones are only joined with that."""
    wanted = ids.select(strip_prefix(F.col("id")).alias("paperId"))
    last = (
        papers.select("paperId", RECORD_ORDER)
        .join(wanted, "paperId", "left_semi")
        .groupBy("paperId")
        .agg(F.max(RECORD_ORDER).alias(RECORD_ORDER))
    )
    return papers.join(last, ["paperId", RECORD_ORDER], "left_semi").select(*papers.columns)


def preview(results: DataFrame, shown: int = 5) -> DataFrame:
    """The first hits, ``pos, title, year, paperId``, and how many more there are."""
    total = results.agg(F.count(F.lit(1)).alias("n")).scalar()
    top = results.select("paperId", "title", "year", "cited_by_count").orderBy(*result_order()).limit(shown)
    hits = top.agg(
        F.array_sort(
            F.collect_list(F.struct((-F.col("cited_by_count")).alias("o"), "paperId", "title", "year"))
        ).alias("hits")
    )
    return hits.select(F.posexplode("hits").alias("at", "hit")).select(
        (F.col("at") + 1).alias("pos"),
        "hit.title",
        "hit.year",
        "hit.paperId",
        F.greatest(total - shown, F.lit(0)).alias("n_more"),
    )
