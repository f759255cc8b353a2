"""Selecting vertices by a property of theirs or of their edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citegraph.operators.graph import CitationGraph


def _text(value: object) -> str:
    """A literal as the text of a property with that value."""
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float) and value.is_integer():
        return str(int(value))
    return str(value)


def _matches(df: DataFrame, column: str, values: list) -> Column:
    """The property as text is one of ``values``; null, 0, false and '' never match."""
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, T.BooleanType):
        truthy = value
    elif isinstance(kind, T.NumericType):
        truthy = value != 0
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            # A whole number is written without decimals.
            text = F.when(value == F.floor(value), F.floor(value).cast("string")).otherwise(value.cast("string"))
            return truthy & text.isin([_text(v) for v in values])
    else:
        truthy = value != ""
    return truthy & value.cast("string").isin([_text(v) for v in values])


def select_nodes(graph: CitationGraph, column: str, values: list, by: str = "node") -> DataFrame:
    """``id`` of the vertices with the property (``by="node"``) or of both ends of
    the edges with it (``by="edge"``)."""
    if by == "node":
        return graph.vertices.filter(_matches(graph.vertices, column, values)).select("id")
    if by == "edge":
        ends = F.explode(F.array("src", "dst")).alias("id")
        return graph.edges.filter(_matches(graph.edges, column, values)).select(ends).distinct()
    raise ValueError(f"unknown item {by!r}")
