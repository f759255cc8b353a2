"""One record per paper id.

Copies of an id are rare, but one id may hold a large share of all records. So
the wide records are never grouped: a narrow aggregate finds the ids that occur
more than once and the record each of them keeps (combined before the shuffle),
and a left join lets every other record pass. While the list of such ids is
counted to be small it is broadcast and the wide records are not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citegraph.operators.normalize import RECORD_ORDER, valid_id
from citegraph.plans.materialize import broadcast_if_small, materialize


def _keep_one(papers: DataFrame, kept: Column, order: Column) -> DataFrame:
    repeated = materialize(
        papers.groupBy("paperId")
        .agg(kept.alias("_kept"), F.count(F.lit(1)).alias("_records"))
        .filter("_records > 1")
        .select("paperId", "_kept")
    )
    return (
        papers.join(broadcast_if_small(repeated), "paperId", "left")
        .filter(F.col("_kept").isNull() | (order == F.col("_kept")))
        .select(*papers.columns)
    )


def keep_last(papers: DataFrame, order: str = RECORD_ORDER) -> DataFrame:
    """Last record of each id wins; ``order`` is unique within an id."""
    papers = papers.filter(valid_id("paperId"))
    return _keep_one(papers, F.max(order), F.col(order))


def keep_first(papers: DataFrame, order: str = RECORD_ORDER) -> DataFrame:
    """First record of each id wins; ``order`` is unique within an id."""
    papers = papers.filter(valid_id("paperId"))
    return _keep_one(papers, F.min(order), F.col(order))


def keep_lowest_hop(papers: DataFrame, hop: str = "hop", order: str = RECORD_ORDER) -> DataFrame:
    """Record of the lowest hop wins, the first of them if several."""
    papers = papers.filter(valid_id("paperId"))
    key = F.struct(F.col(hop), F.col(order))
    return _keep_one(papers, F.min(key), key)
