"""The same results as ``checks.queries`` in SQL, over the whole given tables.

Every statement starts from the tables: ``WITH`` clauses derive the works, the
normalised records (``p``), the papers (``v``, last record wins) and the citation
edges (``e``).
"""

from __future__ import annotations

from checks.queries import CENTRE, FALLBACK_INSTITUTION, FALLBACK_VENUE, SEEDS, VENUE, YEAR
from citegraph.functions.text import CATALOGUE_PREFIX, STRIP_CHARS

P = CATALOGUE_PREFIX


def _strip(x: str) -> str:
    return f"trim({x}, '{STRIP_CHARS}')"


WORKS = f"""
order_sizes AS (SELECT l_orderkey AS sk, (count(*) + 7) // 8 AS blocks FROM lineitem GROUP BY l_orderkey),
lines AS (SELECT l_orderkey AS lk, (l_partkey * 31 + l_suppkey * 7 + l_linenumber) % blocks AS block, min(l_partkey) AS topic_part,
    list_sort(list(DISTINCT l_partkey * 7 + l_linenumber % 8)) AS cited, list_sort(list(DISTINCT l_suppkey)) AS suppliers
  FROM lineitem JOIN order_sizes ON sk = l_orderkey GROUP BY lk, block),
base AS (SELECT o_orderkey + coalesce(block, 0) * 10000000000000 AS k, topic_part, p_brand, p_size, o_orderdate, c_nationkey, n_regionkey,
    CASE WHEN p_name IS NOT NULL THEN concat_ws(' ', p_name, lower(p_type)) END AS name, coalesce(cited, []) AS cited, suppliers
  FROM orders LEFT JOIN lines ON lk = o_orderkey
  LEFT JOIN part ON p_partkey = topic_part
  LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN nation ON n_nationkey = c_nationkey),
first_works AS (SELECT k AS record_seq, '{P}W' || k AS id,
    CASE WHEN k % 50 = 0 THEN '' WHEN k % 50 = 1 THEN '  ' WHEN k % 7 = 0 THEN ' ' || name || ' ' ELSE name END AS title,
    CASE WHEN k % 100 <> 0 THEN name END AS display_name,
    CASE WHEN k % 40 = 3 THEN NULL WHEN k % 40 = 4 THEN 0 ELSE CAST(year(o_orderdate) AS INTEGER) END AS publication_year,
    CASE WHEN k % 30 = 5 THEN NULL WHEN k % 30 = 6 THEN '' WHEN k % 30 = 7 THEN chr(9) || p_brand || ' ' ELSE p_brand END AS source_name,
    CASE WHEN topic_part IS NOT NULL THEN [{{
      'id': CASE WHEN s % 17 <> 0 THEN '{P}A' || s END,
      'name': CASE WHEN s % 23 = 0 THEN NULL WHEN k % 11 = 0 THEN 'SUPPLIER#' || lpad(CAST(s AS VARCHAR), 9, '0') ELSE 'Supplier#' || lpad(CAST(s AS VARCHAR), 9, '0') END
      }} FOR s IN suppliers] END AS authorships,
    CASE WHEN topic_part IS NOT NULL THEN ['I' || c_nationkey, 'R' || n_regionkey] ELSE [] END AS institutions,
    list_concat(['{P}W' || c FOR c IN cited], ['{P}W' || (k + 100000000000)],
      CASE WHEN k % 10 = 0 THEN ['', NULL, ' W7 '] ELSE [] END,
      CASE WHEN k % 500 = 9 THEN ['{P}W' || k] ELSE [] END,
      CASE WHEN k % 97 = 0 THEN ['{P}W' || (k + 1)] WHEN k % 97 = 1 THEN ['{P}W' || (k - 1)] ELSE [] END) AS referenced_works,
    CASE WHEN k % 40 <> 6 THEN CAST(p_size AS INTEGER) END AS cited_by_count
  FROM base),
works AS (SELECT * FROM first_works UNION ALL
  SELECT record_seq + 1000000000000, id, title || ' v2', display_name, publication_year, source_name, authorships,
    institutions, list_concat(referenced_works, ['{P}W' || (record_seq + 3)]), cited_by_count
  FROM first_works WHERE record_seq % 25 = 2)"""

RECORDS = f"""{WORKS},
p AS MATERIALIZED (SELECT {_strip(f"replace(coalesce(id, ''), '{P}', '')")} AS paper_id,
    {_strip("coalesce(nullif(title, ''), nullif(display_name, ''), 'Untitled')")} AS title,
    {_strip("coalesce(nullif(source_name, ''), 'Unknown Venue')")} AS venue,
    CAST(coalesce(nullif(publication_year, 0), -1) AS INTEGER) AS year,
    [{{'author_id': replace(coalesce(a.id, ''), '{P}', ''), 'name': a.name}} FOR a IN coalesce(authorships, [])] AS authors,
    list_filter([{_strip(f"replace(coalesce(r, ''), '{P}', '')")} FOR r IN referenced_works], lambda x: x <> '') AS dirty_refs,
    list_filter(dirty_refs, lambda x, i: list_position(dirty_refs, x) = i) AS refs,
    CAST(coalesce(cited_by_count, 0) AS INTEGER) AS cited_by_count, institutions, record_seq
  FROM works)"""

GRAPH = f"""{RECORDS},
v AS MATERIALIZED (SELECT p.* RENAME (paper_id AS id) FROM p
  JOIN (SELECT paper_id, max(record_seq) AS record_seq FROM p GROUP BY paper_id) USING (paper_id, record_seq)),
e AS MATERIALIZED (SELECT src, dst, 1.0::DOUBLE AS weight, 'citation' AS edge_type
  FROM (SELECT DISTINCT id AS src, unnest(refs) AS dst FROM v) WHERE dst IN (SELECT id FROM v))"""


def _sql(clauses: str, select: str) -> str:
    return f"WITH {clauses.strip()}\n{select}"


def _dedupe(kept: str, columns: str = "paper_id, title, record_seq") -> str:
    order = "CASE WHEN contains(title, 'v2') THEN 1 ELSE 2 END"
    by = {"last": "record_seq DESC", "first": "record_seq", "hop": f"{order}, record_seq"}[kept]
    return _sql(
        RECORDS,
        f"""SELECT {columns} FROM
  (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY {by}) AS rn FROM p) WHERE rn = 1""",
    )


# searches: first matching record of an id, most cited first


def _search(match: str, limit: int | None, offset: int = 0, name: str = "hits") -> str:
    cut = "" if limit is None else f" LIMIT {limit} OFFSET {offset}"
    return f"""{name} AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY record_seq) AS rn
  FROM p WHERE {match}) WHERE rn = 1 ORDER BY cited_by_count DESC, paper_id{cut})"""


_RED_GEAR = "contains(lower(title), 'red') AND contains(lower(title), 'gear')"
_WIDGET = "contains(lower(title), 'widget')"


def _at(institution: str) -> str:
    return f"list_contains(institutions, '{institution}')"


def _venue(text: str) -> str:
    return f"contains(lower(venue), '{text}') AND year = {YEAR}"


# edges of a set of papers ``s`` (paper_id, refs)


def _set_edges(papers: str) -> str:
    return f"""s AS MATERIALIZED ({papers}),
c AS MATERIALIZED (SELECT src, dst FROM (SELECT DISTINCT paper_id AS src, unnest(refs) AS dst FROM s) WHERE dst IN (SELECT paper_id FROM s))"""


def _star(papers: str, centre: str) -> str:
    return f"""{_set_edges(papers)},
star AS (SELECT src, dst, 'seed_cite' AS edge_type FROM c WHERE src <> '{centre}' AND dst <> '{centre}'
  UNION ALL SELECT src, dst, 'central_cites' FROM c WHERE src = '{centre}'
  UNION ALL SELECT src, dst, 'cites_central' FROM c WHERE dst = '{centre}'
  UNION ALL SELECT '{centre}', paper_id, 'fallback' FROM s WHERE paper_id <> '{centre}'
    AND paper_id NOT IN (SELECT dst FROM c WHERE src = '{centre}') AND paper_id NOT IN (SELECT src FROM c WHERE dst = '{centre}'))"""


_STAR_FALLBACK = """hub AS (SELECT min(paper_id) AS h FROM s),
spokes AS (SELECT h AS src, paper_id AS dst FROM s, hub WHERE paper_id <> h
  UNION ALL SELECT paper_id, h FROM s, hub WHERE paper_id <> h)"""

_CITED_OR_STAR = f"""{_STAR_FALLBACK},
found AS (SELECT src, dst, 'citation' AS edge_type FROM c
  UNION ALL SELECT src, dst, 'fallback' FROM spokes WHERE NOT EXISTS (SELECT 1 FROM c))"""

_CITED_OR_STAR_BOTH = f"""{_STAR_FALLBACK},
mirrored AS (SELECT src, dst FROM c UNION ALL SELECT dst, src FROM c
  UNION ALL SELECT src, dst FROM spokes WHERE NOT EXISTS (SELECT 1 FROM c))"""

_VERTEX_PAPERS = "SELECT id AS paper_id, refs FROM v"
_EDGE = "SELECT src, dst, 1.0::DOUBLE AS weight, edge_type FROM "
_PLAIN_EDGE = "SELECT src, dst, 1.0::DOUBLE AS weight FROM "

# expansion: seeds and two hops; a path is one number that keeps the order

_SEED_ROWS = ", ".join(f"('{s.replace(P, '')}', {n})" for n, s in enumerate(SEEDS))


def _expand(hops: int, cap: int | None) -> str:
    cut = "" if cap is None else f" ORDER BY path LIMIT {cap}"
    parts = [
        f"seed(id, path) AS (VALUES {_SEED_ROWS})",
        "h0 AS MATERIALIZED (SELECT v.id, v.refs, path FROM v JOIN seed USING (id))",
        "k0 AS MATERIALIZED (SELECT id, refs, 0 AS hop FROM h0)",
    ]
    for h in range(1, hops + 1):
        parts += [
            f"r{h} AS (SELECT path, unnest(refs) AS id, generate_subscripts(refs, 1) AS place FROM h{h - 1})",
            f"c{h} AS MATERIALIZED (SELECT id, min(path * 100000 + place) AS path FROM r{h} WHERE id NOT IN (SELECT id FROM k{h - 1}) GROUP BY id{cut})",
            f"h{h} AS MATERIALIZED (SELECT v.id, v.refs, path FROM v JOIN c{h} USING (id))",
            f"k{h} AS MATERIALIZED (SELECT * FROM k{h - 1} UNION ALL SELECT id, refs, {h} FROM h{h})",
        ]
    return ",\n".join(parts)


# iterations, unrolled


def _ranks(mode: str) -> str:
    weight = "weight" if mode == "raw" else "weight / sum(weight) OVER (PARTITION BY src)"
    rounds = [f"w AS MATERIALIZED (SELECT src, dst, {weight} AS weight FROM e)", "r0 AS (SELECT id, 1.0::DOUBLE AS rank FROM v)"]
    for i in range(1, 11):
        rounds.append(
            f"""r{i} AS MATERIALIZED (SELECT v.id, 0.15::DOUBLE + 0.85::DOUBLE * coalesce(total, 0) AS rank FROM v
  LEFT JOIN (SELECT dst, sum(rank * weight) AS total FROM w JOIN r{i - 1} ON id = src GROUP BY dst) ON dst = v.id)"""
        )
    return ",\n".join(rounds) + ",\nranks AS MATERIALIZED (SELECT v.*, rank FROM r10 JOIN v USING (id))"


def _labels() -> str:
    rounds = [
        """m AS MATERIALIZED (SELECT f, t, count(*) AS n FROM
  (SELECT src AS f, dst AS t FROM e UNION ALL SELECT dst, src FROM e) GROUP BY f, t)""",
        "l0 AS (SELECT id, id AS label FROM v)",
    ]
    for i in range(1, 6):
        rounds.append(
            f"""l{i} AS MATERIALIZED (SELECT v.id, coalesce(best.label, old.label) AS label FROM v JOIN l{i - 1} old USING (id)
  LEFT JOIN (SELECT t, label FROM (SELECT t, label, row_number() OVER (PARTITION BY t ORDER BY n DESC, label) AS rn FROM
    (SELECT t, label, sum(n) AS n FROM m JOIN l{i - 1} ON id = f GROUP BY t, label)) WHERE rn = 1) best ON best.t = v.id)"""
        )
    return ",\n".join(rounds)


_CANONICAL = """sizes AS (SELECT label, count(*) AS size, min(id) AS first_id FROM l5 GROUP BY label),
numbers AS (SELECT label, size, CAST(row_number() OVER (ORDER BY size DESC, first_id) - 1 AS INTEGER) AS community FROM sizes),
comm AS MATERIALIZED (SELECT l5.id, community, size FROM l5 JOIN numbers USING (label))"""


def _modularity(assigned: str) -> str:
    return f"""und AS (SELECT least(src, dst) AS a, greatest(src, dst) AS b, sum(weight) AS w FROM e GROUP BY 1, 2),
part_of AS ({assigned}),
both_ends AS (SELECT x.c AS ca, y.c AS cb, w FROM und JOIN part_of x ON x.id = a JOIN part_of y ON y.id = b),
per AS (SELECT c, sum(w) AS deg, sum(inside) AS inside FROM
  (SELECT ca AS c, w, CASE WHEN ca = cb THEN 2 * w ELSE 0 END AS inside FROM both_ends UNION ALL SELECT cb, w, 0 FROM both_ends) GROUP BY c),
q AS (SELECT round(sum(inside) / sum(deg) - sum(deg * deg) / (sum(deg) * sum(deg)), 6) AS q FROM per)"""


_SWEEP = """und AS (SELECT least(src, dst) AS a, greatest(src, dst) AS b, sum(weight) AS w FROM e GROUP BY 1, 2),
adj AS MATERIALIZED (SELECT a AS u, b AS x, w FROM und WHERE a <> b UNION ALL SELECT b, a, w FROM und WHERE a <> b
  UNION ALL SELECT a, a, 2 * w FROM und WHERE a = b),
deg AS MATERIALIZED (SELECT u, sum(w) AS k FROM adj GROUP BY u),
scored AS (SELECT adj.x AS id, adj.u AS community, w * (SELECT sum(k) FROM deg) - mine.k * theirs.k AS score
  FROM adj JOIN deg theirs ON theirs.u = adj.u JOIN deg mine ON mine.u = adj.x WHERE adj.u <> adj.x
  UNION ALL SELECT u, u, 0 FROM deg)"""

# drawing

_TOP = """top AS (SELECT id, rank, row_number() OVER (ORDER BY round(log10(rank), 9) DESC, id) AS place FROM ranks
  QUALIFY place <= 50),
span AS (SELECT min(rank) AS low, max(rank) AS high FROM top),
scaled AS (SELECT v.id, v.title, v.year, v.venue, place, coalesce(top.rank, low) AS rank,
    CASE WHEN high > low THEN (coalesce(top.rank, low) - low) / (high - low) ELSE 0.5 END AS t
  FROM v LEFT JOIN top USING (id), span)"""

# Fixed values of the drawing tables.
_PALETTE = """['#e6194b', '#3cb44b', '#ffe119', '#4363d8', '#f58231', '#911eb4', '#42d4f4', '#f032e6', '#bfef45', '#fabed4',
  '#469990', '#dcbeff', '#9a6324', '#fffac8', '#800000', '#aaffc3', '#808000', '#ffd8b1', '#000075', '#a9a9a9']"""
_LABEL = "CASE WHEN place <= 10 THEN CASE WHEN length(title) > 40 THEN substr(title, 1, 40) || '...' ELSE title END ELSE ' ' END"
_TOOLTIP_TAIL = "'\n' || 'PageRank: ' || printf('%.4f', rank)"


def _channel(base: int, slope: int) -> str:
    return f"lpad(lower(hex(CAST(trunc({base} - t * {slope}) AS INTEGER))), 2, '0')"


_RENDER_NODES = f"""SELECT id, round(15 + 35 * t, 6)::DOUBLE AS size, {_LABEL} AS label, {_PALETTE}[community % 20 + 1] AS color,
  coalesce(nullif(title, ''), 'Untitled') || '\nYear: ' || year || '\nCommunity: ' || community || {_TOOLTIP_TAIL} AS tooltip
  FROM scaled JOIN comm USING (id)"""

_RENDER_BY_RANK = f"""SELECT id, round(15 + 35 * t, 6)::DOUBLE AS size, {_LABEL} AS label,
  '#' || {_channel(220, 180)} || {_channel(235, 135)} || {_channel(255, 55)} AS color,
  coalesce(nullif(title, ''), 'Untitled') || '\nVenue: ' || venue || '\nYear: ' || year || '\nCommunity: 0' || {_TOOLTIP_TAIL} AS tooltip
  FROM scaled"""

_EDGE_COLOR = """CASE edge_type WHEN 'citation' THEN 'rgba(90, 130, 180, 0.4)' WHEN 'central_cites' THEN 'rgba(40, 120, 200, 0.6)'
  WHEN 'cites_central' THEN 'rgba(40, 120, 200, 0.6)' WHEN 'seed_cite' THEN 'rgba(90, 130, 180, 0.4)'
  WHEN 'fallback' THEN 'rgba(160, 160, 160, 0.25)' END"""

_NEIGHBOURS = f"""und AS MATERIALIZED (SELECT src AS f, dst AS t FROM e UNION ALL SELECT dst, src FROM e),
n1 AS (SELECT DISTINCT t AS id FROM und WHERE f = '{CENTRE}'),
n2 AS (SELECT DISTINCT t AS id FROM und WHERE f IN (SELECT id FROM n1)),
reached AS (SELECT '{CENTRE}' AS id, 0 AS level UNION ALL SELECT id, 1 FROM n1 UNION ALL SELECT id, 2 FROM n2)"""

_AUTHORS = """listed AS (SELECT id, rank, unnest(authors) AS a FROM ranks),
scores AS (SELECT a.author_id AS author_id, a.name AS author_name, sum(rank) AS score, count(DISTINCT id) AS paper_count
  FROM listed WHERE a.author_id <> '' GROUP BY 1, 2)"""
_AUTHOR_COLUMNS = "SELECT author_id, author_name, round(log10(score), 6) AS log_score, CAST(paper_count AS BIGINT) AS paper_count FROM scores"

_PUBLICATION_COLUMNS = "SELECT paper_id, venue, year FROM hits"
_SEARCH_COLUMNS = "SELECT paper_id, title, cited_by_count, record_seq FROM hits"
_HIT_PAPERS = "SELECT paper_id, refs FROM hits"
_WITH_CENTRE = f"""SELECT paper_id, refs FROM hits UNION ALL
  SELECT id, refs FROM v WHERE id = '{CENTRE}' AND id NOT IN (SELECT paper_id FROM hits)"""


def _id_graph(hops: int, cap: int | None) -> str:
    return _sql(
        f"{GRAPH},\n{_expand(hops, cap)},\n{_set_edges(f'SELECT id AS paper_id, refs FROM k{hops}')},\n{_CITED_OR_STAR}",
        _PLAIN_EDGE + "found",
    )


def _publication_graph(match: str, limit: int) -> str:
    return _sql(
        f"{GRAPH},\n{_search(match, limit)},\n{_set_edges(_HIT_PAPERS)},\n{_CITED_OR_STAR_BOTH}", _PLAIN_EDGE + "mirrored"
    )


def _venue_pairs() -> str:
    """Papers of a venue without citations as ``v``, and all their pairs as ``e``."""
    match = f"{_venue(FALLBACK_VENUE)} AND {_at(FALLBACK_INSTITUTION)}"
    return f"""{RECORDS},
{_search(match, 100)},
v AS MATERIALIZED (SELECT * RENAME (paper_id AS id) FROM hits),
e AS MATERIALIZED (SELECT a.id AS src, b.id AS dst, 1.0::DOUBLE AS weight, 'fallback' AS edge_type FROM v a JOIN v b ON a.id <> b.id)"""


_SHARED_PAIRS = """pairs AS MATERIALIZED (SELECT a.id AS src, b.id AS dst, 0.5::DOUBLE AS weight, 'fallback' AS edge_type
  FROM v a JOIN v b ON a.venue IS NOT DISTINCT FROM b.venue AND a.year = b.year AND a.id <> b.id)"""
_SHARED_VENUES = f"""{GRAPH.replace('e AS MATERIALIZED', 'cites AS MATERIALIZED')},
{_SHARED_PAIRS},
e AS MATERIALIZED (SELECT * FROM cites UNION ALL SELECT * FROM pairs)"""
_ONLY_VENUES = f"""{GRAPH.replace('e AS MATERIALIZED', 'cites AS MATERIALIZED')},
{_SHARED_PAIRS},
e AS MATERIALIZED (SELECT * FROM pairs)"""
_STATS = "SELECT (SELECT count(*) FROM v) AS n_vertices, (SELECT count(*) FROM e) AS n_edges"
_LOG_RANK = "SELECT id, round(log10(rank), 6) AS log_rank FROM ranks"

_WEIGHTED = GRAPH.replace("SELECT src, dst, 1.0::DOUBLE AS weight", "SELECT src, dst, 0.25::DOUBLE * (1 + CAST(substr(src, 2) AS BIGINT) % 4) AS weight")

ORACLE: dict[str, str] = {
    "venue_pairs": _sql(_venue_pairs(), _EDGE + "e"),
    "venue_pairs_stats": _sql(_venue_pairs(), _STATS),
    "venue_pairs_rank": _sql(f"{_venue_pairs()},\n{_ranks('raw')}", _LOG_RANK),
    "venue_pairs_labels": _sql(f"{_venue_pairs()},\n{_labels()}", "SELECT id, label AS community FROM l5"),
    "clique_stats": _sql(_SHARED_VENUES, _STATS),
    "clique_degrees": _sql(
        _ONLY_VENUES,
        "SELECT v.id, count(src) AS degree, coalesce(sum(weight), 0)::DOUBLE AS weight FROM v LEFT JOIN e ON src = v.id GROUP BY v.id",
    ),
    "clique_rank": _sql(f"{_SHARED_VENUES},\n{_ranks('raw')}", _LOG_RANK),
    "clique_rank_normalized": _sql(f"{_SHARED_VENUES},\n{_ranks('normalized')}", _LOG_RANK),
    "clique_modularity": _sql(f"{_SHARED_VENUES},\n{_modularity('SELECT id, year AS c FROM v')}", "SELECT q FROM q"),
    "clique_labels": _sql(f"{_ONLY_VENUES},\n{_labels()}", "SELECT id, label AS community FROM l5"),
    "keyword_search_cursor": _sql(
        f"{RECORDS},\n{_search(_WIDGET, None)}",
        """SELECT paper_id, CAST((row_number() OVER (ORDER BY cited_by_count DESC, paper_id) - 1) // (count(*) OVER () // 4 + 1) AS INTEGER) AS page
  FROM hits""",
    ),
    "missing_authors": _sql(
        f"{GRAPH},\n{_ranks('raw')},\n{_AUTHORS}", "SELECT true AS has_authors, count(*) AS n_authors FROM scores UNION ALL SELECT false, 0"
    ),
    "line_coverage": """SELECT count(DISTINCT (l_orderkey, l_partkey * 7 + l_linenumber % 8)) AS n_cited,
  count(DISTINCT (l_orderkey, l_suppkey)) AS n_authors FROM lineitem""",
    "papers_from_json": _sql(RECORDS, "SELECT paper_id, title, year, CAST(len(refs) AS INTEGER) AS n_refs FROM p"),
    "rejected_records": _sql(
        RECORDS,
        """SELECT count(*) AS n_records, count(*) FILTER (record_seq % 10 = 0) AS n_rejected,
  count(*) FILTER (record_seq % 10 IN (0, 1)) AS n_without_id FROM p""",
    ),
    "rejected_lines": _sql(
        RECORDS,
        """SELECT record_seq, CASE record_seq % 10 WHEN 0 THEN 'not json' WHEN 1 THEN 'no id' ELSE 'wrong type' END AS reason,
  record_seq % 10 = 2 AS kept FROM p WHERE record_seq % 10 < 3""",
    ),
    "ingested_papers": _sql(
        RECORDS,
        """SELECT paper_id, title, CASE WHEN record_seq % 10 <> 2 THEN year END AS year, CAST(len(authors) AS INTEGER) AS n_authors
FROM p WHERE record_seq % 10 > 1""",
    ),
    "publication_graph_too_small": "SELECT 'a' AS src, 'b' AS dst, 1.0::DOUBLE AS weight, 'citation' AS edge_type WHERE false",
    "weighted_rank": _sql(f"{_WEIGHTED},\n{_ranks('raw')}", "SELECT id, round(log10(rank), 6) AS log_rank FROM ranks"),
    "weighted_rank_normalized": _sql(
        f"{_WEIGHTED},\n{_ranks('normalized')}", "SELECT id, round(log10(rank), 6) AS log_rank FROM ranks"
    ),
    "weighted_undirected": _sql(
        _WEIGHTED, "SELECT least(src, dst) AS a, greatest(src, dst) AS b, sum(weight) AS weight FROM e GROUP BY 1, 2"
    ),
    "weighted_modularity": _sql(f"{_WEIGHTED},\n{_modularity('SELECT id, year AS c FROM v')}", "SELECT q FROM q"),
    "weighted_render_edges": _sql(
        _WEIGHTED,
        """SELECT src, dst, round(0.3 + 3 * weight, 6)::DOUBLE AS thickness, 'rgba(90, 130, 180, 0.4)' AS color, 'to' AS arrows,
  'Type: ' || edge_type || '\nWeight: ' || printf('%.3f', weight) AS tooltip FROM e""",
    ),
    "normalize_papers": _sql(RECORDS, "SELECT paper_id, title, venue, year, cited_by_count, record_seq FROM p"),
    "normalize_authors": _sql(
        RECORDS,
        """SELECT paper_id, record_seq, CAST(pos - 1 AS INTEGER) AS pos, a.author_id AS author_id, a.name AS name FROM
  (SELECT paper_id, record_seq, unnest(authors) AS a, generate_subscripts(authors, 1) AS pos FROM p)""",
    ),
    "sanitize_references": _sql(
        RECORDS,
        "SELECT paper_id, record_seq, CAST(len(refs) AS INTEGER) AS n_refs, array_to_string(refs, ',') AS refs_joined FROM p",
    ),
    "dedupe_last_wins": _dedupe("last"),
    "dedupe_first_wins": _dedupe("first"),
    "dedupe_lowest_hop": _dedupe("hop"),
    "json_last_wins": _dedupe("last", "paper_id, title"),
    "json_first_wins": _dedupe("first", "paper_id, title"),
    "safe_payload_names": _sql(
        RECORDS,
        r"""SELECT paper_id, record_seq,
  substr(regexp_replace('publication_' || venue || '_' || title, '[^\p{L}\p{N}_-]', '_', 'g'), 1, 80) AS safe_name FROM p""",
    ),
    "raw_archive_roundtrip": _sql(
        RECORDS,
        "SELECT paper_id, title, year, CAST(len(authors) AS INTEGER) AS n_authors, array_to_string(refs, ',') AS refs_joined FROM p",
    ),
    "archived_search": _sql(f"{RECORDS},\n{_search(_RED_GEAR, 100)}", "SELECT paper_id, title, year, cited_by_count FROM hits"),
    "keyword_search": _sql(f"{RECORDS},\n{_search(f'{_RED_GEAR} AND {_at('R1')}', 100)}", _SEARCH_COLUMNS),
    "keyword_search_all": _sql(f"{RECORDS},\n{_search(_WIDGET, None)}", _SEARCH_COLUMNS),
    "keyword_search_page": _sql(f"{RECORDS},\n{_search(_WIDGET, 50, 100)}", "SELECT paper_id FROM hits"),
    "search_preview": _sql(
        f"{RECORDS},\n{_search(_RED_GEAR, None)}",
        """SELECT CAST(row_number() OVER (ORDER BY cited_by_count DESC, paper_id) AS INTEGER) AS pos, title, year, paper_id,
  CAST(greatest((SELECT count(*) FROM hits) - 5, 0) AS BIGINT) AS n_more FROM hits QUALIFY pos <= 5""",
    ),
    "publication_search": _sql(f"{RECORDS},\n{_search(f'{_venue(VENUE)} AND {_at('R1')}', 1000)}", _PUBLICATION_COLUMNS),
    "publication_search_title": _sql(f"{RECORDS},\n{_search(f'{_RED_GEAR} AND year = {YEAR}', None)}", _PUBLICATION_COLUMNS),
    "lookup_by_ids": _sql(
        GRAPH,
        f"""SELECT id AS paper_id, title, record_seq FROM v
  WHERE id IN (SELECT unnest(refs) FROM p WHERE {_WIDGET})""",
    ),
    "citation_edges": _sql(GRAPH, "SELECT src, dst, weight, edge_type FROM e"),
    "star_edges": _sql(f"{GRAPH},\n{_star(_VERTEX_PAPERS, CENTRE)}", _EDGE + "star"),
    "star_fallback_edges": _sql(
        f"{GRAPH},\ns AS ({_VERTEX_PAPERS}),\n{_STAR_FALLBACK}",
        "SELECT src, dst, 1.0::DOUBLE AS weight, 'fallback' AS edge_type FROM spokes",
    ),
    "symmetrized_edges": _sql(GRAPH, "SELECT src, dst, weight FROM e UNION ALL SELECT dst, src, weight FROM e"),
    "symmetrized_edges_distinct": _sql(GRAPH, "SELECT src, dst, weight FROM e UNION SELECT dst, src, weight FROM e"),
    "keyword_graph": _sql(
        f"{GRAPH},\n{_search(_RED_GEAR, 1000)},\n{_set_edges(_HIT_PAPERS)},\n{_CITED_OR_STAR}", _EDGE + "found"
    ),
    "keyword_graph_central": _sql(f"{GRAPH},\n{_search(_RED_GEAR, 1000)},\n{_star(_WITH_CENTRE, CENTRE)}", _EDGE + "star"),
    "keyword_graph_fallback": _sql(
        f"{GRAPH},\n{_search(f'{_RED_GEAR} AND {_at(FALLBACK_INSTITUTION)}', 100)},\n{_set_edges(_HIT_PAPERS)},\n{_CITED_OR_STAR}",
        _EDGE + "found",
    ),
    "id_graph_1hop": _id_graph(1, None),
    "id_graph_2hop": _id_graph(2, None),
    "id_graph_capped": _id_graph(2, 5),
    "expand_2hop": _sql(f"{GRAPH},\n{_expand(2, None)}", "SELECT id, hop FROM k2"),
    "expand_2hop_capped": _sql(f"{GRAPH},\n{_expand(2, 5)}", "SELECT id, hop FROM k2"),
    "publication_graph": _publication_graph(_venue(VENUE), 1000),
    "publication_graph_fallback": _publication_graph(f"{_venue(FALLBACK_VENUE)} AND {_at(FALLBACK_INSTITUTION)}", 100),
    "graph_stats": _sql(
        GRAPH,
        "SELECT CAST((SELECT count(*) FROM v) AS BIGINT) AS n_vertices, CAST((SELECT count(*) FROM e) AS BIGINT) AS n_edges",
    ),
    "influence_rank": _sql(f"{GRAPH},\n{_ranks('raw')}", "SELECT id, round(log10(rank), 6) AS log_rank, title FROM ranks"),
    "influence_rank_normalized": _sql(
        f"{GRAPH},\n{_ranks('normalized')}", "SELECT id, round(log10(rank), 6) AS log_rank, title FROM ranks"
    ),
    "top_papers": _sql(
        f"{GRAPH},\n{_ranks('raw')}",
        """SELECT id, title, round(log10(rank), 6) AS log_rank FROM ranks
  ORDER BY round(log10(rank), 9) DESC, id LIMIT 10""",
    ),
    "author_influence": _sql(f"{GRAPH},\n{_ranks('raw')},\n{_AUTHORS}", _AUTHOR_COLUMNS),
    "top_authors": _sql(
        f"{GRAPH},\n{_ranks('raw')},\n{_AUTHORS}",
        f"{_AUTHOR_COLUMNS} ORDER BY round(log10(score), 9) DESC, paper_count DESC, author_id, author_name LIMIT 10",
    ),
    "undirected_edges": _sql(
        GRAPH, "SELECT least(src, dst) AS a, greatest(src, dst) AS b, sum(weight) AS weight FROM e GROUP BY 1, 2"
    ),
    "modularity_by_year": _sql(f"{GRAPH},\n{_modularity('SELECT id, year AS c FROM v')}", "SELECT q FROM q"),
    "louvain_one_sweep": _sql(
        f"{GRAPH},\n{_SWEEP}",
        """SELECT id, community FROM scored
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, community <> id, community) = 1""",
    ),
    "label_propagation": _sql(f"{GRAPH},\n{_labels()}", "SELECT id, label AS community FROM l5"),
    "canonical_communities": _sql(f"{GRAPH},\n{_labels()},\n{_CANONICAL}", "SELECT id, community FROM comm"),
    "louvain_properties": _sql(
        GRAPH,
        """SELECT count(*) AS papers, count(DISTINCT id) AS ids, CAST(sum(length(id)) AS BIGINT) AS id_letters,
  true AS canonical, true AS more_modular FROM v""",
    ),
    "community_stats": _sql(
        f"{GRAPH},\n{_labels()},\n{_modularity('SELECT id, label AS c FROM l5')}",
        "SELECT CAST((SELECT count(DISTINCT label) FROM l5) AS BIGINT) AS n_communities, q FROM q",
    ),
    "community_summary": _sql(
        f"{GRAPH},\n{_labels()},\n{_CANONICAL}",
        "SELECT community, CAST(size AS BIGINT) AS size, id, v.title FROM comm JOIN v USING (id)",
    ),
    "render_nodes": _sql(f"{GRAPH},\n{_ranks('normalized')},\n{_labels()},\n{_CANONICAL},\n{_TOP}", _RENDER_NODES),
    "render_nodes_by_rank": _sql(f"{GRAPH},\n{_ranks('normalized')},\n{_TOP}", _RENDER_BY_RANK),
    "render_edges": _sql(
        f"{GRAPH},\n{_star(_VERTEX_PAPERS, CENTRE)}",
        f"""SELECT src, dst, 3.3::DOUBLE AS thickness, {_EDGE_COLOR} AS color,
  CASE WHEN edge_type = 'fallback' THEN '' ELSE 'to' END AS arrows, 'Type: ' || edge_type || '\nWeight: 1.000' AS tooltip FROM star""",
    ),
    "render_edges_untyped": _sql(
        GRAPH,
        """SELECT src, dst, 3.3::DOUBLE AS thickness, 'rgba(90, 130, 180, 0.4)' AS color, 'to' AS arrows,
  'Weight: 1.000' AS tooltip FROM e""",
    ),
    "render_tables_roundtrip": _sql(
        f"{GRAPH},\n{_ranks('normalized')},\n{_labels()},\n{_CANONICAL},\n{_TOP}", _RENDER_NODES
    ),
    "k_hop_neighborhood": _sql(
        f"{GRAPH},\n{_NEIGHBOURS}", "SELECT id, CAST(min(level) AS INTEGER) AS level FROM reached GROUP BY id"
    ),
    "select_nodes": _sql(GRAPH, "SELECT id FROM v WHERE cited_by_count IN (7, 13)"),
    "select_edge_endpoints": _sql(
        f"{GRAPH},\n{_star(_VERTEX_PAPERS, CENTRE)}",
        """SELECT DISTINCT unnest([src, dst]) AS id FROM star WHERE edge_type IN ('central_cites', 'cites_central')""",
    ),
    "graph_roundtrip": _sql(GRAPH, "SELECT id, year, CAST(len(refs) AS INTEGER) AS n_refs FROM v"),
    "graph_roundtrip_edges": _sql(GRAPH, "SELECT src, dst, weight, edge_type FROM e"),
    "graph_roundtrip_years": _sql(
        GRAPH,
        f"""SELECT src, dst, weight FROM e WHERE src IN (SELECT id FROM v WHERE year IN (-1, {YEAR}))
  AND dst IN (SELECT id FROM v WHERE year IN (-1, {YEAR}))""",
    ),
}

# a store of records gives what the records themselves give
ORACLE |= {
    f"stored_{name}": ORACLE[name]
    for name in (
        "keyword_search", "keyword_search_all", "publication_search", "publication_search_title", "expand_2hop", "id_graph_capped",
        "keyword_graph_central", "weighted_rank", "weighted_rank_normalized",
    )
}
