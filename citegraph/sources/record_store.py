"""Normalised records kept for many lookups and searches.

A store is three tables, replaced together (``sources/versions.py``):

* ``records`` in buckets by a hash of the id, sorted by it inside a file. A lookup reads
  the buckets of its ids only; the ids' buckets, at most as many numbers as there are
  buckets, are all that reaches the driver.
* ``postings``: a row per record and word of its title, per record and lineage id, and
  per record and venue, in buckets by a hash of the term. A row has all that a search
  sorts and cuts by, so wide records are read for the result only. A frequent term fills
  several files.
* ``terms``: each term once, with its bucket and how many postings it has. A search matches
  its tokens with the terms, reads the buckets of those that hold one, and joins
  the lists rarest first.

A token has no white space, so a title holds it if one of the pieces between its spaces
does, and the results are those of the searches over the records themselves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citegraph.functions.text import strip_prefix
from citegraph.operators import search
from citegraph.operators.normalize import RECORD_ORDER, valid_id
from citegraph.plans.materialize import materialize
from citegraph.sources import versions

WORD, LINEAGE, VENUE = "word", "lineage", "venue"
_POSTING = f"kind string, term string, paperId string, {RECORD_ORDER} bigint, cited_by_count int, year int, bucket int"
_TERM = "kind string, term string, bucket int, postings bigint"


def _bucket(buckets: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int").alias("bucket")


def _log(folder: str) -> str:
    return f"{folder.rstrip('/')}/commits"


def _tables(folder: str) -> list[str]:
    return [f"{folder.rstrip('/')}/{t}" for t in ("records", "postings", "terms", "columns")]


@dataclass(frozen=True)
class RecordStore:
    """``records`` and ``postings`` are partitioned by ``bucket``."""

    records: DataFrame
    postings: DataFrame
    terms: DataFrame
    buckets: int

    @property
    def columns(self) -> list[str]:
        return [c for c in self.records.columns if c != "bucket"]

    def near(self, ids: DataFrame) -> DataFrame:
        """All records in the buckets of ``ids`` (column ``id``, with or without prefix)."""
        buckets = ids.select(strip_prefix(F.col("id")).alias("id")).select(_bucket(self.buckets, "id"))
        needed = buckets.agg(F.collect_set("bucket")).first()[0]
        return self.records.where(F.col("bucket").isin(needed)).select(*self.columns)

    def lookup_by_ids(self, ids: DataFrame) -> DataFrame:
        """As ``search.lookup_by_ids``."""
        return search.lookup_by_ids(self.near(ids), ids)

    def keyword_search(
        self,
        keywords: str | list[str],
        limit: int | None = None,
        institution: str | None = None,
        offset: int = 0,
        after: str | None = None,
    ) -> DataFrame:
        """As ``search.keyword_search``. Without a token and an institution every record is read."""
        wanted = self._words(search.parse_keywords(keywords)) + self._lineage(institution)
        if not wanted:
            return search.keyword_search(self.records.select(*self.columns), [], limit, offset=offset, after=after)
        return self._found(wanted, None, limit, offset, after)

    def publication_search(
        self,
        publication: str,
        year: int,
        limit: int | None = None,
        institution: str | None = None,
        match: str = "venue",
        offset: int = 0,
    ) -> DataFrame:
        """As ``search.publication_search``."""
        if match not in ("venue", "title"):
            raise ValueError(f"unknown match {match!r}")
        held = (F.col("kind") == VENUE) & F.contains("term", F.lit(publication.lower()))
        wanted = [held] if match == "venue" else self._words(publication.split())
        wanted = wanted + self._lineage(institution)
        if not wanted:
            return search.publication_search(self.records.select(*self.columns), publication, year, limit, match=match, offset=offset)
        return self._found(wanted, F.col("year") == year, limit, offset, None)

    def _words(self, tokens: list[str]) -> list[Column]:
        distinct = dict.fromkeys(t.lower() for t in tokens)
        return [(F.col("kind") == WORD) & F.contains("term", F.lit(t)) for t in distinct]

    def _lineage(self, institution: str | None) -> list[Column]:
        return [] if institution is None else [(F.col("kind") == LINEAGE) & (F.col("term") == institution)]

    def hits(self, wanted: list[Column], other: Column | None = None) -> DataFrame:
        """``paperId, record_seq, cited_by_count, year`` of the records that are on a list of every
        condition on terms, by the buckets of these lists; a record may be there several times."""
        sums = [F.collect_set(F.when(w, F.col("bucket"))).alias(f"b{i}") for i, w in enumerate(wanted)]
        sums += [F.coalesce(F.sum(F.when(w, F.col("postings"))), F.lit(0)).alias(f"n{i}") for i, w in enumerate(wanted)]
        row = self.terms.agg(*sums).first()
        hits = None
        for i in sorted(range(len(wanted)), key=lambda i: row[f"n{i}"]):
            listed = self.postings.where(F.col("bucket").isin(row[f"b{i}"]) & wanted[i])
            listed = (listed if other is None else listed.where(other)).select("paperId", RECORD_ORDER, "cited_by_count", "year")
            hits = listed if hits is None else hits.join(listed, ["paperId", RECORD_ORDER], "left_semi")
        return hits

    def _found(self, wanted: list[Column], other: Column | None, limit: int | None, offset: int, after: str | None) -> DataFrame:
        first = materialize(search.first_hits(self.hits(wanted, other), limit, offset, after))
        near = self.near(first.select(F.col("paperId").alias("id")))
        return near.join(first.drop("_cited"), ["paperId", RECORD_ORDER], "left_semi").select(*self.columns).orderBy(*search.result_order())


def save_records(records: DataFrame, folder: str, buckets: int = 256) -> RecordStore:
    """Keep ``records`` (the result of ``normalize_works``) in ``folder``, replacing an older store there.

    About as many buckets as there are gigabytes of records keep a bucket's read short.
    """
    spark, version = records.sparkSession, versions.new_version()
    paths = [versions.versioned(t, version) for t in _tables(folder)]
    records = records.where(valid_id("paperId"))

    def listed(kind: str, terms: Column) -> DataFrame:
        return records.select(F.lit(kind).alias("kind"), F.explode(terms).alias("term"), "paperId", RECORD_ORDER, "cited_by_count", "year")

    words = listed(WORD, F.array_distinct(F.split(F.lower("title"), " "))).where("term <> ''")
    lineage = listed(LINEAGE, F.array_distinct("institutions")).where("term is not null")
    venues = listed(VENUE, F.array(F.lower("venue"))).where("term is not null")
    postings = words.unionByName(lineage).unionByName(venues).withColumn("bucket", _bucket(buckets, "kind", "term"))
    stored = records.withColumn("bucket", _bucket(buckets, "paperId"))
    # rebalanced, so that a bucket is one file, or several if it is large
    stored.hint("rebalance", "bucket").sortWithinPartitions("bucket", "paperId").write.partitionBy("bucket").parquet(paths[0])
    postings.hint("rebalance", "bucket").sortWithinPartitions("bucket", "kind", "term").write.partitionBy("bucket").parquet(paths[1])
    read = spark.read.schema(_POSTING).parquet(paths[1])
    terms = read.groupBy("kind", "term", "bucket").agg(F.count(F.lit(1)).alias("postings"))
    terms.withColumn("buckets", F.lit(buckets)).write.parquet(paths[2])
    # partitioned tables without rows have no file that tells their columns
    records.limit(0).write.parquet(paths[3])
    versions.commit(spark, _log(folder), version)
    return load_records(spark, folder)


def load_records(spark: SparkSession, folder: str) -> RecordStore:
    """The store in force in ``folder``."""
    version = versions.current_version(spark, _log(folder))
    if version is None:
        raise ValueError(f"no records are stored in {folder}")
    paths = [versions.versioned(t, version) for t in _tables(folder)]
    terms = spark.read.schema(f"{_TERM}, buckets int").parquet(paths[2])
    buckets = terms.agg(F.max("buckets")).first()[0] or 1
    postings = spark.read.schema(_POSTING).parquet(paths[1])
    stored = spark.read.schema(spark.read.parquet(paths[3]).schema.add("bucket", "integer")).parquet(paths[0])
    return RecordStore(stored, postings, terms.drop("buckets"), buckets)


def drop_old_records(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Delete all stores of ``folder`` but the ``keep`` last; returns their versions."""
    return versions.drop_old_versions(spark, _log(folder), _tables(folder), keep)
