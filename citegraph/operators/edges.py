"""Edge builders. Vertices are unique by id throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CITATION = "citation"
SEED_CITE = "seed_cite"
CENTRAL_CITES = "central_cites"
CITES_CENTRAL = "cites_central"
FALLBACK = "fallback"


def _edge_columns(df: DataFrame, edge_type: Column | None = None) -> DataFrame:
    kind = F.col("edge_type") if edge_type is None else edge_type
    return df.select("src", "dst", F.lit(1.0).alias("weight"), kind.alias("edge_type"))


def citations(vertices: DataFrame) -> DataFrame:
    """``src, dst`` per distinct reference. Ids are unique, so a pair can repeat
    only inside one reference list and is removed there, without a shuffle."""
    return vertices.select(
        F.col("id").alias("src"), F.explode(F.array_distinct("referenced_works")).alias("dst")
    ).filter(F.col("dst").isNotNull() & (F.col("dst") != ""))


def citation_edges(vertices: DataFrame) -> DataFrame:
    """Citations between vertices; self-citations stay."""
    ids = vertices.select(F.col("id").alias("dst"))
    return _edge_columns(citations(vertices).join(ids, "dst", "left_semi"), F.lit(CITATION))


def star_edges(vertices: DataFrame, centre: str) -> DataFrame:
    """Edges around a central paper.

    Citations between other papers, of the centre and by the centre keep their
    own kind; a centre that cites itself has one edge of either kind. The centre
    also gets a fallback edge to every paper it has no direct citation with. One
    pass over the citations yields all three kinds.
    """
    is_src, is_dst = F.col("src") == centre, F.col("dst") == centre
    kinds = F.array_compact(
        F.array(
            F.when(~is_src & ~is_dst, SEED_CITE),
            F.when(is_src, CENTRAL_CITES),
            F.when(is_dst, CITES_CENTRAL),
        )
    )
    cited = citations(vertices).select("src", "dst", F.explode(kinds).alias("edge_type"))
    ids = vertices.select(F.col("id").alias("dst"))
    cited = cited.join(ids, "dst", "left_semi")

    the_centre = vertices.filter(F.col("id") == centre)
    cites_centre = F.coalesce(F.array_contains("referenced_works", centre), F.lit(False))
    unlinked = (
        vertices.filter((F.col("id") != centre) & ~cites_centre)
        .filter(the_centre.agg(F.count(F.lit(1)).alias("n")).scalar() > 0)
        .select(F.col("id").alias("dst"))
        .join(the_centre.select(F.explode("referenced_works").alias("dst")), "dst", "left_anti")
        .select(F.lit(centre).alias("src"), "dst", F.lit(FALLBACK).alias("edge_type"))
    )
    return _edge_columns(cited.unionByName(unlinked))


def star_fallback_edges(vertices: DataFrame) -> DataFrame:
    """Both directions between the smallest id and every other vertex."""
    hub = vertices.agg(F.min("id").alias("hub")).scalar()
    both = F.explode(
        F.array(
            F.struct(F.col("hub").alias("src"), F.col("id").alias("dst")),
            F.struct(F.col("id").alias("src"), F.col("hub").alias("dst")),
        )
    )
    pairs = vertices.select("id", hub.alias("hub")).filter(F.col("id") != F.col("hub")).select(both.alias("e"))
    return _edge_columns(pairs.select("e.src", "e.dst"), F.lit(FALLBACK))


def symmetrize(edges: DataFrame, dedupe: bool = False) -> DataFrame:
    """Every edge and its reverse. Mutual citations and self-citations come out
    twice, unless ``dedupe`` keeps one row per direction."""
    both = F.explode(F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"))))
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    out = edges.select(both.alias("e"), *rest).select("e.src", "e.dst", *rest)
    return out.dropDuplicates(["src", "dst"]) if dedupe else out


def undirected_edges(edges: DataFrame) -> DataFrame:
    """``a, b, weight`` with the summed weight of each unordered pair."""
    return edges.groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).agg(
        F.sum("weight").alias("weight")
    )
