"""The three ways to build a graph from normalised records.

``records`` is the result of ``normalize_works``, possibly several records per id, or a
store of it (``sources/record_store.py``).
With an ``archive`` a builder also keeps the raw works that its search found.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citegraph.operators.cliques import clique_of
from citegraph.operators.dedupe import keep_last
from citegraph.operators.edges import (
    citation_edges,
    star_edges,
    star_fallback_edges,
    symmetrize,
)
from citegraph.operators.expand import expand_references
from citegraph.operators.graph import CitationGraph
from citegraph.operators.normalize import RECORD_ORDER, to_vertices
from citegraph.operators.search import bare_ids, keyword_search, lookup_by_ids, publication_search, seed_ids
from citegraph.plans.materialize import materialize
from citegraph.sources.record_store import RecordStore
from citegraph.sources.works import archive_raw


@dataclass
class Archive:
    """Where builders keep what they found: the ``raw`` works that the records were made
    of, with the same ``record_seq``, and a shared folder."""

    raw: DataFrame
    folder: str

    def keep(self, found: DataFrame, query_name: str, parameters: dict) -> str | None:
        """Archive the raw works of ``found``; nothing is written for an empty search."""
        if found.isEmpty():
            return None
        works = self.raw.join(found.select(RECORD_ORDER), RECORD_ORDER, "left_semi").drop(RECORD_ORDER)
        return archive_raw(works, self.folder, query_name, parameters)


def _looked_up(records: DataFrame | RecordStore, ids: DataFrame) -> DataFrame:
    return records.lookup_by_ids(ids) if isinstance(records, RecordStore) else lookup_by_ids(records, ids)


def whole_graph(records: DataFrame) -> CitationGraph:
    """Graph of all papers, last record of an id wins. A whole corpus may simply
    have no citations, so there is no fallback."""
    vertices = materialize(to_vertices(keep_last(records)))
    return CitationGraph(vertices, materialize(citation_edges(vertices)), closed=True)


def _citations_or_star(vertices: DataFrame) -> DataFrame:
    edges = materialize(citation_edges(vertices))
    return materialize(star_fallback_edges(vertices)) if edges.isEmpty() else edges


def keyword_graph(
    records: DataFrame | RecordStore,
    keywords: str | list[str],
    limit: int | None = None,
    central: str | None = None,
    institution: str | None = None,
    keep_references: bool = True,
    archive: Archive | None = None,
) -> CitationGraph:
    """Graph of a keyword search.

    A central paper is looked up when the search did not find it. If it exists,
    the edges form a star around it. Otherwise they are the citations inside the
    set or, if there are none, a star around the smallest id. A search without
    hits gives an empty graph.
    """
    stored = isinstance(records, RecordStore)
    found = records.keyword_search(keywords, limit, institution) if stored else keyword_search(records, keywords, limit, institution)
    found = materialize(found)
    if archive is not None:
        words = keywords if isinstance(keywords, str) else ", ".join(keywords)
        archive.keep(found, f"keyword_{words}", {"query": words, "limit": limit})
    centre = None
    if central and not found.isEmpty():
        bare = bare_ids([central])
        centre = bare[0] if bare else None
    if centre is not None and found.filter(F.col("paperId") == centre).isEmpty():
        looked_up = materialize(_looked_up(records, seed_ids(found.sparkSession, [centre])))
        if archive is not None:
            archive.keep(looked_up, "keyword_central_paper", {"ids": centre})
        found = materialize(found.unionByName(looked_up))
        if looked_up.isEmpty():
            centre = None
    vertices = materialize(to_vertices(found))
    edges = _citations_or_star(vertices) if centre is None else materialize(star_edges(vertices, centre))
    return CitationGraph(_kept(vertices, keep_references), edges, closed=True)


def id_graph(
    records: DataFrame | RecordStore,
    seeds: list[str],
    max_hops: int = 1,
    per_hop_limit: int | None = None,
    keep_references: bool = False,
    archive: Archive | None = None,
) -> CitationGraph:
    """Graph of the seeds and of what they cite within ``max_hops`` hops; a star
    around the smallest id if nothing in the set cites anything in it."""
    stored = isinstance(records, RecordStore)
    spark = records.records.sparkSession if stored else records.sparkSession
    reached = expand_references(records, seed_ids(spark, seeds), max_hops, per_hop_limit)
    keys = materialize(reached.select(F.col("id").alias("paperId"), RECORD_ORDER))
    if archive is not None:
        wanted = ",".join(bare_ids(seeds))
        archive.keep(keys, "ids", {"ids": wanted, "max_hops": max_hops, "per_hop_limit": per_hop_limit})
    near = records.near(keys.select(F.col("paperId").alias("id"))) if stored else records
    papers = near.join(keys, ["paperId", RECORD_ORDER], "left_semi")
    vertices = materialize(to_vertices(papers))
    return CitationGraph(_kept(vertices, keep_references), _citations_or_star(vertices), closed=True)


def publication_graph(
    records: DataFrame | RecordStore,
    publication: str,
    year: int,
    limit: int | None = None,
    institution: str | None = None,
    match: str = "venue",
    dedupe: bool = False,
    keep_references: bool = False,
    fallback: str = "pairs",
    archive: Archive | None = None,
) -> CitationGraph:
    """Graph of a venue and year: the citations inside the set, every edge also in
    reverse. Without any, all pairs are linked, as one clique of the papers
    (``fallback="pairs"``), or those with the smallest id (``"star"``). Fewer than
    two papers give an empty graph."""
    if fallback not in ("pairs", "star"):
        raise ValueError(f"unknown fallback {fallback!r}")
    if isinstance(records, RecordStore):
        found = records.publication_search(publication, year, limit, institution, match)
    else:
        found = publication_search(records, publication, year, limit, institution, match)
    if archive is not None:
        found = materialize(found)
        archive.keep(found, f"publication_{publication}_{year}", {"publication": publication, "year": year, "limit": limit})
    vertices = materialize(to_vertices(found))
    if vertices.limit(2).count() < 2:
        vertices = vertices.filter(F.lit(False))
    edges = materialize(citation_edges(vertices))
    cliques = None
    if not edges.isEmpty():
        edges = materialize(symmetrize(edges, dedupe))
    elif fallback == "star":
        # the star has both directions already
        edges = materialize(star_fallback_edges(vertices))
    else:
        cliques = materialize(clique_of(vertices))
    return CitationGraph(_kept(vertices, keep_references), edges, closed=True, cliques=cliques)


def _kept(vertices: DataFrame, keep_references: bool) -> DataFrame:
    return vertices if keep_references else vertices.drop("referenced_works")
