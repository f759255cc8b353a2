"""One query per operator over works derived from the given tables.

Every callable takes ``(spark, folder)`` and returns flat scalar columns under the
names that the SQL in ``checks.oracle`` uses.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citegraph.functions.text import safe_name
from citegraph.operators import communities as com
from citegraph.operators import cliques, dedupe, edges, expand, rank, render, search, selection
from citegraph.operators.graph import CitationGraph, graph_stats
from citegraph.operators.louvain import louvain, louvain_one_sweep
from citegraph.operators.normalize import normalize_works
from citegraph.plans import workflows
from citegraph.plans.materialize import checkpoint_dir, materialize, shuffles_dropped
from citegraph.sources import adjacency, graph_store, record_store
from citegraph.sources import works as work_files
from citegraph.sources.tables import lines_per_block, works_from_tables

CENTRE = "W42"
KEYWORDS = "red, gear"
SEEDS = ["W1", "https://openalex.org/W2", "W3", "W700000000000"]
VENUE, YEAR = "brand#1", 1998
FALLBACK_VENUE, FALLBACK_INSTITUTION = "brand#7", "I2"

_shared: dict[tuple, object] = {}


def _once_per_session(build):
    """Written tables that several queries read are built once per session."""

    @wraps(build)
    def get(spark: SparkSession, folder: str):
        key = (spark.sparkContext.applicationId, folder, build.__name__)
        if key not in _shared:
            _shared[key] = build(spark, folder)
        return _shared[key]

    return get


@_once_per_session
def raw_works(spark, folder) -> DataFrame:
    return materialize(works_from_tables(spark, folder))


@_once_per_session
def records(spark, folder) -> DataFrame:
    """Of the raw works, if the session has written them. Most queries need only the records, and the
    wide raw works would be written and read for nothing else."""
    raw = _shared.get((spark.sparkContext.applicationId, folder, "raw_works"))
    return materialize(normalize_works(works_from_tables(spark, folder) if raw is None else raw))


@_once_per_session
def graph(spark, folder) -> CitationGraph:
    return workflows.whole_graph(records(spark, folder))


@_once_per_session
def raw_ranks(spark, folder) -> DataFrame:
    return rank.influence_rank(graph(spark, folder))


@_once_per_session
def normalized_ranks(spark, folder) -> DataFrame:
    return rank.influence_rank(graph(spark, folder), mode="normalized")


@_once_per_session
def propagated(spark, folder) -> DataFrame:
    return com.label_propagation(graph(spark, folder)).select("id", "title", "community")


@_once_per_session
def numbered(spark, folder) -> DataFrame:
    return materialize(com.canonical_ids(propagated(spark, folder)))


@_once_per_session
def louvain_communities(spark, folder) -> DataFrame:
    g = graph(spark, folder)
    return materialize(louvain(g))


def _log(column: str, name: str):
    return F.round(F.log10(column), 6).alias(name)


def _edges(g: CitationGraph, *columns: str) -> DataFrame:
    return g.edges.select("src", "dst", "weight", *columns)


# normalising and dedupe


def normalize_papers(spark, folder):
    return records(spark, folder).select(
        F.col("paperId").alias("paper_id"), "title", "venue", "year", "cited_by_count", "record_seq"
    )


def normalize_authors(spark, folder):
    return (
        records(spark, folder)
        .select(F.col("paperId").alias("paper_id"), "record_seq", F.posexplode("authors").alias("pos", "a"))
        .select("paper_id", "record_seq", "pos", F.col("a.authorId").alias("author_id"), F.col("a.name").alias("name"))
    )


def sanitize_references(spark, folder):
    return records(spark, folder).select(
        F.col("paperId").alias("paper_id"),
        "record_seq",
        F.size("referenced_works").alias("n_refs"),
        F.concat_ws(",", "referenced_works").alias("refs_joined"),
    )


#: Records of an ordered JSON file, so that the task that sorts and writes one stays as small as it is.
RECORDS_PER_FILE = 100_000


def _json_records(spark, folder) -> DataFrame:
    """The raw works from JSON files that hold them in order, without a number."""
    path = f"{checkpoint_dir(spark)}/works-{uuid.uuid4().hex}"
    raw = raw_works(spark, folder)
    files = max(5, raw.count() // RECORDS_PER_FILE)
    ordered = raw.repartitionByRange(files, "record_seq").sortWithinPartitions("record_seq")
    with shuffles_dropped(spark):
        ordered.drop("record_seq").write.json(path)
    return normalize_works(work_files.read_works(spark, path))


def json_last_wins(spark, folder):
    return _deduped(dedupe.keep_last(_json_records(spark, folder))).drop("record_seq")


def json_first_wins(spark, folder):
    return _deduped(dedupe.keep_first(_json_records(spark, folder))).drop("record_seq")


def _deduped(papers: DataFrame) -> DataFrame:
    return papers.select(F.col("paperId").alias("paper_id"), "title", "record_seq")


def dedupe_last_wins(spark, folder):
    return _deduped(dedupe.keep_last(records(spark, folder)))


def dedupe_first_wins(spark, folder):
    return _deduped(dedupe.keep_first(records(spark, folder)))


def dedupe_lowest_hop(spark, folder):
    hop = F.when(F.contains("title", F.lit("v2")), 1).otherwise(2)
    return _deduped(dedupe.keep_lowest_hop(records(spark, folder).withColumn("hop", hop)))


def safe_payload_names(spark, folder):
    return records(spark, folder).select(
        F.col("paperId").alias("paper_id"),
        "record_seq",
        safe_name(F.concat(F.lit("publication_"), "venue", F.lit("_"), "title")).alias("safe_name"),
    )


def raw_archive_roundtrip(spark, folder):
    target = f"{checkpoint_dir(spark)}/archive-{uuid.uuid4().hex}"
    path = work_files.archive_raw(
        raw_works(spark, folder).drop("record_seq"), target, "keyword_all works", {"limit": 100}
    )
    back = normalize_works(work_files.read_archive(spark, path))
    return back.select(
        F.col("paperId").alias("paper_id"),
        "title",
        "year",
        F.size("authors").alias("n_authors"),
        F.concat_ws(",", "referenced_works").alias("refs_joined"),
    )


def archived_search(spark, folder):
    """The works that a search archived, found by the name of the query."""
    target = f"{checkpoint_dir(spark)}/archive-{uuid.uuid4().hex}"
    raw = raw_works(spark, folder)
    archive = workflows.Archive(raw, target)
    workflows.keyword_graph(records(spark, folder), KEYWORDS, 100, archive=archive)
    workflows.id_graph(records(spark, folder), [CENTRE], archive=archive)
    words = KEYWORDS if isinstance(KEYWORDS, str) else ", ".join(KEYWORDS)
    back = normalize_works(work_files.read_archives(spark, target, f"keyword_{words}"))
    return back.select(F.col("paperId").alias("paper_id"), "title", "year", "cited_by_count")


# searches


def keyword_search(spark, folder):
    return search.keyword_search(records(spark, folder), KEYWORDS, 100, "R1").select(
        F.col("paperId").alias("paper_id"), "title", "cited_by_count", "record_seq"
    )


def keyword_search_all(spark, folder):
    return search.keyword_search(records(spark, folder), ["widget"], None).select(
        F.col("paperId").alias("paper_id"), "title", "cited_by_count", "record_seq"
    )


def keyword_search_page(spark, folder):
    return search.keyword_search(records(spark, folder), "widget", 50, offset=100).select(F.col("paperId").alias("paper_id"))


def search_preview(spark, folder):
    hits = search.keyword_search(records(spark, folder), KEYWORDS, None)
    return search.preview(hits).select("pos", "title", "year", F.col("paperId").alias("paper_id"), "n_more")


def publication_search(spark, folder):
    return search.publication_search(records(spark, folder), VENUE, YEAR, 1000, "R1").select(
        F.col("paperId").alias("paper_id"), "venue", "year"
    )


def publication_search_title(spark, folder):
    return search.publication_search(records(spark, folder), "red gear", YEAR, None, match="title").select(
        F.col("paperId").alias("paper_id"), "venue", "year"
    )


def lookup_by_ids(spark, folder):
    # Every reference of a paper on a widget, found or not, bare or not.
    wanted = (
        records(spark, folder)
        .filter(F.contains("title", F.lit("widget")))
        .select(F.explode("referenced_works").alias("ref"))
        .distinct()
        .select(F.concat(F.lit("https://openalex.org/"), "ref").alias("id"))
    )
    return search.lookup_by_ids(records(spark, folder), wanted).select(
        F.col("paperId").alias("paper_id"), "title", "record_seq"
    )


# the same through a store of records


@_once_per_session
def stored(spark, folder) -> record_store.RecordStore:
    return record_store.save_records(records(spark, folder), f"{checkpoint_dir(spark)}/records-{uuid.uuid4().hex}", 32)


def stored_keyword_search(spark, folder):
    return stored(spark, folder).keyword_search(KEYWORDS, 100, "R1").select(
        F.col("paperId").alias("paper_id"), "title", "cited_by_count", "record_seq"
    )


def stored_keyword_search_all(spark, folder):
    return stored(spark, folder).keyword_search(["widget"]).select(
        F.col("paperId").alias("paper_id"), "title", "cited_by_count", "record_seq"
    )


def stored_publication_search(spark, folder):
    return stored(spark, folder).publication_search(VENUE, YEAR, 1000, "R1").select(
        F.col("paperId").alias("paper_id"), "venue", "year"
    )


def stored_publication_search_title(spark, folder):
    return stored(spark, folder).publication_search("red gear", YEAR, match="title").select(
        F.col("paperId").alias("paper_id"), "venue", "year"
    )


def stored_expand_2hop(spark, folder):
    return expand.expand_references(stored(spark, folder), search.seed_ids(spark, SEEDS), 2, None).select("id", "hop")


def stored_id_graph_capped(spark, folder):
    return _edges(workflows.id_graph(stored(spark, folder), SEEDS, 2, 5))


def stored_keyword_graph_central(spark, folder):
    return _edges(workflows.keyword_graph(stored(spark, folder), KEYWORDS, 1000, central=CENTRE), "edge_type")


# edges and graphs


def citation_edges(spark, folder):
    return _edges(graph(spark, folder), "edge_type")


def star_edges(spark, folder):
    return edges.star_edges(graph(spark, folder).vertices, CENTRE)


def star_fallback_edges(spark, folder):
    return edges.star_fallback_edges(graph(spark, folder).vertices)


def symmetrized_edges(spark, folder):
    return edges.symmetrize(graph(spark, folder).edges).select("src", "dst", "weight")


def symmetrized_edges_distinct(spark, folder):
    return edges.symmetrize(graph(spark, folder).edges, dedupe=True).select("src", "dst", "weight")


def keyword_graph(spark, folder):
    return _edges(workflows.keyword_graph(records(spark, folder), KEYWORDS, 1000), "edge_type")


def keyword_graph_central(spark, folder):
    return _edges(workflows.keyword_graph(records(spark, folder), KEYWORDS, 1000, central=CENTRE), "edge_type")


def keyword_graph_fallback(spark, folder):
    g = workflows.keyword_graph(records(spark, folder), KEYWORDS, 100, institution=FALLBACK_INSTITUTION)
    return _edges(g, "edge_type")


def id_graph_1hop(spark, folder):
    return _edges(workflows.id_graph(records(spark, folder), SEEDS))


def id_graph_2hop(spark, folder):
    return _edges(workflows.id_graph(records(spark, folder), SEEDS, 2, None))


def id_graph_capped(spark, folder):
    return _edges(workflows.id_graph(records(spark, folder), SEEDS, 2, 5))


def expand_2hop(spark, folder):
    seeds = search.seed_ids(spark, SEEDS)
    return expand.expand_references(records(spark, folder), seeds, 2, None).select("id", "hop")


def expand_2hop_capped(spark, folder):
    seeds = search.seed_ids(spark, SEEDS)
    return expand.expand_references(records(spark, folder), seeds, 2, 5).select("id", "hop")


def publication_graph(spark, folder):
    return _edges(workflows.publication_graph(records(spark, folder), VENUE, YEAR, 1000))


def publication_graph_fallback(spark, folder):
    return _edges(
        workflows.publication_graph(
            records(spark, folder), FALLBACK_VENUE, YEAR, 100, institution=FALLBACK_INSTITUTION, fallback="star"
        )
    )


# all pairs, as members of cliques: one venue without citations, and the papers of every venue and year


@_once_per_session
def uncited_venue(spark, folder) -> CitationGraph:
    return workflows.publication_graph(records(spark, folder), FALLBACK_VENUE, YEAR, 100, institution=FALLBACK_INSTITUTION)


@_once_per_session
def shared_venues(spark, folder) -> CitationGraph:
    """Papers linked with all others of their venue and year, next to the citations."""
    g = graph(spark, folder)
    return CitationGraph(g.vertices, g.edges, closed=True, cliques=materialize(cliques.cliques_by(g.vertices, "venue", "year", weight=0.5)))


def venue_pairs(spark, folder):
    g = uncited_venue(spark, folder)
    return _edges(CitationGraph(g.vertices, cliques.edges_among(g.cliques, g.vertices)), "edge_type")


def venue_pairs_stats(spark, folder):
    return graph_stats(uncited_venue(spark, folder))


def venue_pairs_rank(spark, folder):
    return rank.influence_rank(uncited_venue(spark, folder)).select("id", _log("rank", "log_rank"))


def venue_pairs_labels(spark, folder):
    return com.label_propagation(uncited_venue(spark, folder)).select("id", "community")


def clique_stats(spark, folder):
    return graph_stats(shared_venues(spark, folder))


def clique_degrees(spark, folder):
    return cliques.clique_degrees(shared_venues(spark, folder).cliques)


def clique_rank(spark, folder):
    return rank.influence_rank(shared_venues(spark, folder)).select("id", _log("rank", "log_rank"))


def clique_rank_normalized(spark, folder):
    return rank.influence_rank(shared_venues(spark, folder), mode="normalized").select("id", _log("rank", "log_rank"))


def clique_modularity(spark, folder):
    g = shared_venues(spark, folder)
    by_year = g.vertices.select("id", F.col("year").alias("community"))
    return com.modularity(g.edges, by_year, g.cliques).select(F.round("q", 6).alias("q"))


def clique_labels(spark, folder):
    g = shared_venues(spark, folder)
    alone = CitationGraph(g.vertices, g.edges.limit(0), closed=True, cliques=g.cliques)
    return com.label_propagation(alone).select("id", "community")


def keyword_search_cursor(spark, folder):
    """Every result of a search by cursor, a quarter or less on a page."""
    hits = search.keyword_search(records(spark, folder), "widget", None)
    per_page = hits.count() // 4 + 1
    pages = search.keyword_pages(records(spark, folder), "widget", per_page)
    numbered_pages = [p.select(F.col("paperId").alias("paper_id"), F.lit(n).alias("page")) for n, p in enumerate(pages)]
    return functools.reduce(DataFrame.unionByName, numbered_pages, hits.limit(0).select(F.col("paperId").alias("paper_id"), F.lit(0).alias("page")))


def missing_authors(spark, folder):
    """Authors scored with and without their column; without it the operator refuses."""
    g, counts = graph(spark, folder), []
    for vertices in (g.vertices, g.vertices.drop("authors")):
        try:
            scores = rank.author_influence(CitationGraph(vertices, g.edges, closed=True), raw_ranks(spark, folder))
            counts.append(scores.agg(F.lit(True).alias("has_authors"), F.count("*").alias("n_authors")))
        except ValueError:
            counts.append(vertices.agg(F.count("*").alias("n")).select(F.lit(False).alias("has_authors"), F.lit(0).cast("bigint").alias("n_authors")))
    return counts[0].unionByName(counts[1])


def stats(spark, folder):
    return graph_stats(graph(spark, folder))


def line_coverage(spark, folder):
    """Distinct pairs of an order with a work cited through its lines, and with a supplier."""
    blocks = lines_per_block(spark.read.parquet(f"{folder}/lineitem.parquet"))
    cited = blocks.select("o_orderkey", F.explode("cited").alias("c")).distinct().agg(F.count("*").alias("n")).scalar()
    authors = blocks.select("o_orderkey", F.explode("suppliers").alias("s")).distinct()
    return authors.agg(cited.alias("n_cited"), F.count("*").alias("n_authors"))


def papers_from_json(spark, folder):
    path = f"{checkpoint_dir(spark)}/papers-{uuid.uuid4().hex}"
    records(spark, folder).write.json(path)
    papers = work_files.read_papers(spark, path, "json")
    return papers.select(F.col("paperId").alias("paper_id"), "title", "year", F.size("referenced_works").alias("n_refs"))


def rejected_records(spark, folder):
    """Every tenth line is cut short and every tenth has no id."""
    rows = records(spark, folder)
    line = F.to_json(F.struct(*[F.when(F.col("record_seq") % 10 != 1, F.col(c)).alias(c) if c == "paperId" else F.col(c) for c in rows.columns]))
    cut = F.when(F.col("record_seq") % 10 == 0, F.substr(line, F.lit(1), F.lit(20))).otherwise(line)
    path = f"{checkpoint_dir(spark)}/lines-{uuid.uuid4().hex}"
    rows.select(cut.alias("value")).write.text(path)
    return work_files.count_rejects(spark, path)


def _faulty_lines(spark, folder) -> str:
    """Of ten lines one is cut short, one has no id and one a year that is no number."""
    rows = records(spark, folder)
    columns = ["record_seq", *(c for c in rows.columns if c != "record_seq")]

    def line(**other):
        return F.to_json(F.struct(*[other.get(c, F.col(c)).alias(c) for c in columns]))

    whole, fault = line(), F.col("record_seq") % 10
    cut = F.substr(whole, F.lit(1), F.length(F.col("record_seq").cast("string")) + 24)
    text = F.when(fault == 0, cut).when(fault == 1, line(paperId=F.lit(None).cast("string"))).when(fault == 2, line(year=F.lit("soon"))).otherwise(whole)
    path = f"{checkpoint_dir(spark)}/lines-{uuid.uuid4().hex}"
    rows.select(text.alias("value")).write.text(path)
    return path


def _ingested(spark, folder) -> work_files.Ingested:
    return work_files.ingest_papers(spark, _faulty_lines(spark, folder), f"{checkpoint_dir(spark)}/ingested-{uuid.uuid4().hex}")


def rejected_lines(spark, folder):
    number = F.regexp_extract("line", r'"record_seq":(\d+)', 1).cast("bigint")
    return _ingested(spark, folder).rejects.select(number.alias("record_seq"), "reason", "kept")


def ingested_papers(spark, folder):
    return _ingested(spark, folder).papers.select(F.col("paperId").alias("paper_id"), "title", "year", F.size("authors").alias("n_authors"))


def publication_graph_too_small(spark, folder):
    return _edges(workflows.publication_graph(records(spark, folder), "no venue has this name", YEAR), "edge_type")


@_once_per_session
def weighted(spark, folder) -> CitationGraph:
    """The graph with weights from a quarter to one."""
    g = graph(spark, folder)
    weight = (1 + F.substr("src", F.lit(2)).cast("bigint") % 4) * 0.25
    return CitationGraph(g.vertices, g.edges.withColumn("weight", weight.cast("double")), closed=True)


def weighted_rank(spark, folder):
    return rank.influence_rank(weighted(spark, folder)).select("id", _log("rank", "log_rank"))


def weighted_rank_normalized(spark, folder):
    return rank.influence_rank(weighted(spark, folder), mode="normalized").select("id", _log("rank", "log_rank"))


def weighted_undirected(spark, folder):
    return edges.undirected_edges(weighted(spark, folder).edges)


def weighted_modularity(spark, folder):
    g = weighted(spark, folder)
    by_year = g.vertices.select("id", F.col("year").alias("community"))
    return com.modularity(g.edges, by_year).select(F.round("q", 6).alias("q"))


def weighted_render_edges(spark, folder):
    return _drawn_edges(render.render_edges(weighted(spark, folder).edges))


# ranks


def influence_rank(spark, folder):
    return raw_ranks(spark, folder).select("id", _log("rank", "log_rank"), "title")


def influence_rank_normalized(spark, folder):
    return normalized_ranks(spark, folder).select("id", _log("rank", "log_rank"), "title")


@_once_per_session
def _adjacency(spark, folder) -> adjacency.Adjacency:
    return adjacency.save_adjacency(weighted(spark, folder), f"{checkpoint_dir(spark)}/adjacency-{uuid.uuid4().hex}")


def stored_weighted_rank(spark, folder):
    ranks = rank.influence_rank(weighted(spark, folder), adjacency=_adjacency(spark, folder))
    return ranks.select("id", _log("rank", "log_rank"))


def stored_weighted_rank_normalized(spark, folder):
    ranks = rank.influence_rank(weighted(spark, folder), mode="normalized", adjacency=_adjacency(spark, folder))
    return ranks.select("id", _log("rank", "log_rank"))


def top_papers(spark, folder):
    return rank.top_papers(raw_ranks(spark, folder), 10).select("id", "title", _log("rank", "log_rank"))


def _authors(scores: DataFrame) -> DataFrame:
    return scores.select(
        F.col("authorId").alias("author_id"),
        F.col("authorName").alias("author_name"),
        _log("influenceScore", "log_score"),
        F.col("paperCount").alias("paper_count"),
    )


def author_influence(spark, folder):
    return _authors(rank.author_influence(graph(spark, folder), raw_ranks(spark, folder)))


def top_authors(spark, folder):
    return _authors(rank.author_influence(graph(spark, folder), raw_ranks(spark, folder), 10))


# communities


def undirected_edges(spark, folder):
    return edges.undirected_edges(graph(spark, folder).edges)


def modularity_by_year(spark, folder):
    g = graph(spark, folder)
    by_year = g.vertices.select("id", F.col("year").alias("community"))
    return com.modularity(g.edges, by_year).select(F.round("q", 6).alias("q"))


def louvain_sweep(spark, folder):
    return louvain_one_sweep(graph(spark, folder))


def louvain_full(spark, folder):
    return louvain_communities(spark, folder).select("id", "community", "title")


def louvain_properties(spark, folder):
    """What must hold of the communities, whichever way ties and turns went: every paper once, numbers
    from 0 by falling size and then smallest id, and more modular than label propagation and than
    papers alone."""
    found, g = louvain_communities(spark, folder), graph(spark, folder)
    sizes = materialize(com.community_sizes(found))
    after = sizes.select((F.col("community") - 1).alias("community"), F.col("size").alias("size_after"), F.col("first_id").alias("id_after"))
    falls = (F.col("size") > F.col("size_after")) | ((F.col("size") == F.col("size_after")) & (F.col("first_id") < F.col("id_after")))
    # only the last one has none after it
    steps = sizes.join(after, "community", "left").agg(
        F.bool_and(F.coalesce(falls, F.lit(True))) & (F.count_if(F.col("size_after").isNull()) == 1) & (F.min("community") == 0)
    )
    ordered = steps.scalar()
    q = com.modularity(g.edges, found).scalar()
    labels = com.modularity(g.edges, propagated(spark, folder)).scalar()
    alone = com.modularity(g.edges, g.vertices.select("id", F.col("id").alias("community"))).scalar()
    return found.agg(
        F.count("id").alias("papers"),
        F.count_distinct("id").alias("ids"),
        F.sum(F.length("id")).alias("id_letters"),
    ).select("papers", "ids", "id_letters", ordered.alias("canonical"), ((q > labels) & (q > alone)).alias("more_modular"))


def louvain_stats(spark, folder):
    found = louvain_communities(spark, folder)
    return com.community_stats(graph(spark, folder).edges, found).select("n_communities", F.round("q", 6).alias("q"))


def label_propagation(spark, folder):
    return propagated(spark, folder).select("id", "community")


def canonical_communities(spark, folder):
    return numbered(spark, folder).select("id", "community")


def community_stats(spark, folder):
    found = propagated(spark, folder)
    return com.community_stats(graph(spark, folder).edges, found).select("n_communities", F.round("q", 6).alias("q"))


def community_summary(spark, folder):
    return com.community_summary(numbered(spark, folder))


# drawing tables and selection


def _nodes(nodes: DataFrame) -> DataFrame:
    return nodes.select(
        "id", F.round("size", 6).alias("size"), "label", "color", F.col("title").alias("tooltip")
    )


def render_nodes(spark, folder):
    found, ranks = numbered(spark, folder), normalized_ranks(spark, folder)
    return _nodes(render.render_nodes(graph(spark, folder), ranks, found))


def render_nodes_by_rank(spark, folder):
    ranks = normalized_ranks(spark, folder)
    return _nodes(render.render_nodes(graph(spark, folder), ranks, with_venue=True))


def _drawn_edges(drawn: DataFrame) -> DataFrame:
    return drawn.select(
        "src", "dst", F.round("value", 6).alias("thickness"), "color", "arrows", F.col("title").alias("tooltip")
    )


def render_edges(spark, folder):
    star = edges.star_edges(graph(spark, folder).vertices, CENTRE)
    return _drawn_edges(render.render_edges(star))


def render_edges_untyped(spark, folder):
    return _drawn_edges(render.render_edges(graph(spark, folder).edges, by_type=False))


def render_tables_roundtrip(spark, folder):
    nodes = render.render_nodes(graph(spark, folder), normalized_ranks(spark, folder), numbered(spark, folder))
    root = f"{checkpoint_dir(spark)}/drawing-{uuid.uuid4().hex}"
    path, _ = graph_store.save_render_tables(
        nodes, render.render_edges(graph(spark, folder).edges), "whole", root, "parquet"
    )
    return _nodes(spark.read.schema(nodes.schema).parquet(path))


def k_hop_neighborhood(spark, folder):
    seeds = spark.createDataFrame([(CENTRE,)], "id string")
    return expand.k_hop_neighborhood(graph(spark, folder).edges, seeds)


def select_nodes(spark, folder):
    return selection.select_nodes(graph(spark, folder), "cited_by_count", [0, 7, 13])


def select_edge_endpoints(spark, folder):
    g = graph(spark, folder)
    star = CitationGraph(g.vertices, edges.star_edges(g.vertices, CENTRE), closed=True)
    return selection.select_nodes(star, "edge_type", [edges.CENTRAL_CITES, edges.CITES_CENTRAL], by="edge")


# persistence


def _saved(spark, folder) -> str:
    root = f"{checkpoint_dir(spark)}/graph-{uuid.uuid4().hex}"
    graph_store.save_graph(graph(spark, folder), "whole", root)
    return root


def graph_roundtrip(spark, folder):
    g = graph_store.load_graph(spark, "whole", _saved(spark, folder))
    return g.vertices.select("id", "year", F.size("referenced_works").alias("n_refs"))


def graph_roundtrip_edges(spark, folder):
    return _edges(graph_store.load_graph(spark, "whole", _saved(spark, folder)), "edge_type")


def graph_roundtrip_years(spark, folder):
    return _edges(graph_store.load_graph(spark, "whole", _saved(spark, folder), years=[-1, YEAR]))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "normalize_papers": normalize_papers,
    "normalize_authors": normalize_authors,
    "sanitize_references": sanitize_references,
    "dedupe_last_wins": dedupe_last_wins,
    "dedupe_first_wins": dedupe_first_wins,
    "dedupe_lowest_hop": dedupe_lowest_hop,
    "json_last_wins": json_last_wins,
    "json_first_wins": json_first_wins,
    "safe_payload_names": safe_payload_names,
    "raw_archive_roundtrip": raw_archive_roundtrip,
    "archived_search": archived_search,
    "keyword_search": keyword_search,
    "keyword_search_all": keyword_search_all,
    "keyword_search_page": keyword_search_page,
    "search_preview": search_preview,
    "publication_search": publication_search,
    "publication_search_title": publication_search_title,
    "lookup_by_ids": lookup_by_ids,
    "stored_keyword_search": stored_keyword_search,
    "stored_keyword_search_all": stored_keyword_search_all,
    "stored_publication_search": stored_publication_search,
    "stored_publication_search_title": stored_publication_search_title,
    "stored_expand_2hop": stored_expand_2hop,
    "stored_id_graph_capped": stored_id_graph_capped,
    "stored_keyword_graph_central": stored_keyword_graph_central,
    "citation_edges": citation_edges,
    "star_edges": star_edges,
    "star_fallback_edges": star_fallback_edges,
    "symmetrized_edges": symmetrized_edges,
    "symmetrized_edges_distinct": symmetrized_edges_distinct,
    "keyword_graph": keyword_graph,
    "keyword_graph_central": keyword_graph_central,
    "keyword_graph_fallback": keyword_graph_fallback,
    "id_graph_1hop": id_graph_1hop,
    "id_graph_2hop": id_graph_2hop,
    "id_graph_capped": id_graph_capped,
    "expand_2hop": expand_2hop,
    "expand_2hop_capped": expand_2hop_capped,
    "publication_graph": publication_graph,
    "publication_graph_fallback": publication_graph_fallback,
    "venue_pairs": venue_pairs,
    "venue_pairs_stats": venue_pairs_stats,
    "venue_pairs_rank": venue_pairs_rank,
    "venue_pairs_labels": venue_pairs_labels,
    "clique_stats": clique_stats,
    "clique_degrees": clique_degrees,
    "clique_rank": clique_rank,
    "clique_rank_normalized": clique_rank_normalized,
    "clique_modularity": clique_modularity,
    "clique_labels": clique_labels,
    "keyword_search_cursor": keyword_search_cursor,
    "missing_authors": missing_authors,
    "graph_stats": stats,
    "line_coverage": line_coverage,
    "papers_from_json": papers_from_json,
    "rejected_records": rejected_records,
    "rejected_lines": rejected_lines,
    "ingested_papers": ingested_papers,
    "publication_graph_too_small": publication_graph_too_small,
    "weighted_rank": weighted_rank,
    "weighted_rank_normalized": weighted_rank_normalized,
    "weighted_undirected": weighted_undirected,
    "weighted_modularity": weighted_modularity,
    "weighted_render_edges": weighted_render_edges,
    "influence_rank": influence_rank,
    "influence_rank_normalized": influence_rank_normalized,
    "stored_weighted_rank": stored_weighted_rank,
    "stored_weighted_rank_normalized": stored_weighted_rank_normalized,
    "top_papers": top_papers,
    "author_influence": author_influence,
    "top_authors": top_authors,
    "undirected_edges": undirected_edges,
    "modularity_by_year": modularity_by_year,
    "louvain_one_sweep": louvain_sweep,
    "louvain": louvain_full,
    "louvain_stats": louvain_stats,
    "louvain_properties": louvain_properties,
    "label_propagation": label_propagation,
    "canonical_communities": canonical_communities,
    "community_stats": community_stats,
    "community_summary": community_summary,
    "render_nodes": render_nodes,
    "render_nodes_by_rank": render_nodes_by_rank,
    "render_edges": render_edges,
    "render_edges_untyped": render_edges_untyped,
    "render_tables_roundtrip": render_tables_roundtrip,
    "k_hop_neighborhood": k_hop_neighborhood,
    "select_nodes": select_nodes,
    "select_edge_endpoints": select_edge_endpoints,
    "graph_roundtrip": graph_roundtrip,
    "graph_roundtrip_edges": graph_roundtrip_edges,
    "graph_roundtrip_years": graph_roundtrip_years,
}
