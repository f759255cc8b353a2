"""Works derived from a folder of star-schema tables.

An order is a work, or several: its lines are dealt over as many blocks as keep about
``BLOCK_LINES`` lines each, and each block is a work. Every line counts: the part of a
line, with its line number, gives a work that it cites, its supplier an author. The part
with the smallest key names the work and its venue, the nation of the customer is the
institution of all authors.

The number of blocks comes from a combined count per order, so an order that holds a large
share of all lines becomes many works and no group of unknown size is ever collected. The
lines move once, by order and block; an order is copied per block and joined where they
lie, its customer before that, while its row is narrow.

The ``CASE`` branches on the key do not select rows: they add the kinds of dirt
that real records have (blank titles, padded ids, missing years, duplicates).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citegraph.functions.text import CATALOGUE_PREFIX
from citegraph.plans.materialize import broadcast_if_small, materialize

#: Line numbers modulo this tell apart the works cited through one part.
SLOTS = 8
#: Lines of a block, on average; orders with fewer lines are one block.
BLOCK_LINES = 8
#: Distance of the keys of an order's blocks; block 0 has the key of the order.
BLOCK_OFFSET = 10_000_000_000_000
#: Stands for a null block in a join.
NO_BLOCK = -1
WORKS_PER_PART = 7
OUTSIDE_OFFSET = 100_000_000_000
SECOND_RECORD_OFFSET = 1_000_000_000_000


def _work_id(key: Column) -> Column:
    return F.concat(F.lit(CATALOGUE_PREFIX + "W"), key.cast("string"))


def _large_orders(lineitem: DataFrame) -> DataFrame:
    """``l_orderkey, blocks`` of the orders of several blocks; written, so that their number is known."""
    counts = lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return materialize(counts.where(F.col("n") > BLOCK_LINES).select("l_orderkey", F.ceil(F.col("n") / BLOCK_LINES).alias("blocks")))


def lines_per_block(lineitem: DataFrame) -> DataFrame:
    """``o_orderkey, block, topic_part, cited, suppliers`` with sorted, distinct arrays."""
    blocks = _line_blocks(lineitem, broadcast_if_small(_large_orders(lineitem)))
    return blocks.select("o_orderkey", F.nullif("_block", F.lit(NO_BLOCK)).alias("block"), "topic_part", "cited", "suppliers")


def _line_blocks(lineitem: DataFrame, large: DataFrame) -> DataFrame:
    """``lines_per_block`` with ``_block``, placed by order and ``_block``."""
    lines = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    dealt = F.col("l_partkey") * 31 + F.col("l_suppkey") * 7 + F.col("l_linenumber")
    block = F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(dealt, F.col("blocks")))
    cited = F.col("l_partkey") * WORKS_PER_PART + F.col("l_linenumber") % SLOTS
    return (
        lines.join(large, "l_orderkey", "left")
        .select(
            F.col("l_orderkey").alias("o_orderkey"),
            F.coalesce(block.cast("bigint"), F.lit(NO_BLOCK)).alias("_block"),
            "l_partkey",
            "l_suppkey",
            cited.alias("_cited"),
        )
        # lines are smaller than the sets of their groups
        .repartition("o_orderkey", "_block")
        .groupBy("o_orderkey", "_block")
        .agg(
            F.min("l_partkey").alias("topic_part"),
            F.sort_array(F.collect_set("_cited")).alias("cited"),
            F.sort_array(F.collect_set("l_suppkey")).alias("suppliers"),
        )
    )


def _order_blocks(orders: DataFrame, customers: DataFrame, large: DataFrame) -> DataFrame:
    """A row per order and block that it may have, with what the customer gives."""
    may_have = F.sequence(F.lit(NO_BLOCK), F.col("blocks") - 1)
    return (
        orders.select("o_orderkey", "o_custkey", "o_orderdate")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(large.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left")
        .withColumn("_block", F.explode(F.coalesce(may_have, F.array(F.lit(0).cast("bigint")))))
    )


def _references(key: Column) -> Column:
    from_lines = F.transform(F.coalesce("cited", F.array().cast("array<bigint>")), _work_id)
    none = F.array().cast("array<string>")
    return F.concat(
        from_lines,
        F.array(_work_id(key + OUTSIDE_OFFSET)),
        F.when(key % 10 == 0, F.array(F.lit(""), F.lit(None).cast("string"), F.lit(" W7 "))).otherwise(none),
        F.when(key % 500 == 9, F.array(_work_id(key))).otherwise(none),
        F.when(key % 97 == 0, F.array(_work_id(key + 1)))
        .when(key % 97 == 1, F.array(_work_id(key - 1)))
        .otherwise(none),
    )


def _authorships(key: Column) -> Column:
    lineage = F.array(
        F.concat(F.lit("I"), F.col("c_nationkey").cast("string")),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")),
    )

    def authorship(supplier: Column) -> Column:
        name = F.concat(F.lit("Supplier#"), F.lpad(supplier.cast("string"), 9, "0"))
        spelled = F.when(key % 11 == 0, F.upper(name)).otherwise(name)
        return F.struct(
            F.struct(
                F.when(supplier % 17 != 0, F.concat(F.lit(CATALOGUE_PREFIX + "A"), supplier.cast("string"))).alias("id"),
                F.when(supplier % 23 != 0, spelled).alias("display_name"),
            ).alias("author"),
            F.array(F.struct(lineage.alias("lineage"))).alias("institutions"),
        )

    return F.transform("suppliers", authorship)


def works_from_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Raw works (``schemas.RAW_WORK``) plus a unique ``record_seq``."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    large = broadcast_if_small(_large_orders(table("lineitem")))
    lines = _line_blocks(table("lineitem"), large)
    customers = (
        table("customer")
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_nationkey", "n_regionkey")
    )
    parts = table("part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
    key = F.col("o_orderkey") + F.greatest("_block", F.lit(0)) * BLOCK_OFFSET
    topic = F.concat_ws(" ", F.col("p_name"), F.lower("p_type"))
    name = F.when(F.col("p_name").isNotNull(), topic)
    records = (
        _order_blocks(table("orders"), customers, large)
        .join(lines, ["o_orderkey", "_block"], "left")
        # an order without lines has one block, one of several no row for a block that got none
        .where(F.col("blocks").isNull() | F.col("cited").isNotNull())
        .join(parts, F.col("topic_part") == F.col("p_partkey"), "left")
        .select(
            key.alias("record_seq"),
            _work_id(key).alias("id"),
            F.when(key % 50 == 0, "")
            .when(key % 50 == 1, "  ")
            .when(key % 7 == 0, F.concat(F.lit(" "), name, F.lit(" ")))
            .otherwise(name)
            .alias("title"),
            F.when(key % 100 != 0, name).alias("display_name"),
            F.when(key % 40 == 3, None)
            .when(key % 40 == 4, F.lit(0))
            .otherwise(F.year("o_orderdate"))
            .cast("int")
            .alias("publication_year"),
            F.struct(
                F.struct(
                    F.when(key % 30 == 5, None)
                    .when(key % 30 == 6, F.lit(""))
                    .when(key % 30 == 7, F.concat(F.lit("\t"), F.col("p_brand"), F.lit(" ")))
                    .otherwise(F.col("p_brand"))
                    .alias("display_name")
                ).alias("source")
            ).alias("primary_location"),
            _authorships(key).alias("authorships"),
            _references(key).alias("referenced_works"),
            F.when(key % 40 != 6, F.col("p_size")).cast("int").alias("cited_by_count"),
        )
    )
    is_second = F.col("record_no") == 2
    return (
        records.withColumn(
            "record_no",
            F.explode(F.when(F.col("record_seq") % 25 == 2, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))),
        )
        .withColumn("title", F.when(is_second, F.concat("title", F.lit(" v2"))).otherwise(F.col("title")))
        .withColumn(
            "referenced_works",
            F.when(is_second, F.concat("referenced_works", F.array(_work_id(F.col("record_seq") + 3)))).otherwise(
                F.col("referenced_works")
            ),
        )
        .withColumn("record_seq", F.col("record_seq") + F.when(is_second, SECOND_RECORD_OFFSET).otherwise(0))
        .drop("record_no")
    )
