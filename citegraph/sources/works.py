"""Reading work snapshots and archiving them."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citegraph.operators.normalize import RECORD_ORDER, valid_id
from citegraph.sources.schemas import ARCHIVE, PAPER, RAW_WORK, REJECT
from citegraph.sources.versions import path_exists

CORRUPT = "_corrupt_record"

#: Bits of a record number for the place in a file; the others are the file's rank.
FILE_BITS = 43


def read_works(spark: SparkSession, path: str | list[str], fmt: str = "json") -> DataFrame:
    """Raw works with the needed fields only. ``fmt`` is ``json`` (one record per
    line, compressed or not) or ``parquet``; Parquet may carry ``record_seq``. Without
    one, records are ordered by the path of their file and their place in it."""
    if fmt not in ("json", "parquet"):
        raise ValueError(f"unknown format {fmt!r}")
    paths = [path] if isinstance(path, str) else path
    stored = spark.read.schema(RAW_WORK).json(paths) if fmt == "json" else spark.read.parquet(*paths)
    if RECORD_ORDER in stored.columns:
        return stored.select(*RAW_WORK.fieldNames(), RECORD_ORDER)
    return _in_source_order(stored, RAW_WORK.fieldNames())


def _in_source_order(stored: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and ``record_seq``: files by path, then records by their place.

    A number is the file's rank, then the start of the split in the file plus the
    record's place in the task. A split has at least as many bytes as records, and one
    that is shorter than a task's share is the last of its file, so numbers grow along a
    file and none occurs twice, however the splits are dealt to tasks. There is room for
    a million files of up to eight terabytes.
    """
    files = sorted({re.sub(r"^(\w+):/+", r"\1:/", f) for f in stored.inputFiles()})  # as in the metadata, but for slashes
    if len(files) >= 1 << (63 - FILE_BITS):
        raise ValueError("too many files to number their records; add record_seq")
    ranks = stored.sparkSession.createDataFrame(list(zip(files, range(len(files)), strict=True)), "_file string, _rank bigint")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = stored.select(
        *columns,
        F.regexp_replace("_metadata.file_path", r"^(\w+):/+", "$1:/").alias("_file"),
        (F.col("_metadata.file_block_start") + place).alias("_place"),
    )
    rank = F.coalesce("_rank", F.raise_error(F.concat(F.lit("file not listed: "), F.col("_file"))).cast("bigint"))
    # One row per file of the listing that the driver holds anyway.
    numbered = rows.join(F.broadcast(ranks), "_file", "left")
    return numbered.select(*columns, (F.shiftleft(rank, FILE_BITS) + F.col("_place")).alias(RECORD_ORDER))


def read_papers(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Normalised papers with a non-empty id. A field of a JSON record that does
    not fit the schema is null, the rest of the record is kept."""
    reader = spark.read.schema(PAPER)
    papers = reader.json(path) if fmt == "json" else reader.parquet(path)
    return papers.filter(valid_id("paperId"))


def count_rejects(spark: SparkSession, path: str, schema: T.StructType = PAPER) -> DataFrame:
    """One row for a JSON source: records, records that are broken or hold a field
    of the wrong type, and records without an id."""
    key = schema.fieldNames()[0]
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    # Parsed from text, since a JSON scan would skip the fields nobody asks for.
    parsed = F.from_json("value", with_corrupt, {"columnNameOfCorruptRecord": CORRUPT})
    return (
        spark.read.text(path)
        .filter(F.trim("value") != "")
        .select(parsed.alias("record"))
        .select("record.*")
        .agg(
            F.count(F.lit(1)).alias("n_records"),
            F.count_if(F.col(CORRUPT).isNotNull()).alias("n_rejected"),
            F.count_if(F.col(key).isNull() | (F.col(key) == "")).alias("n_without_id"),
        )
    )


@dataclass
class Ingested:
    """``papers`` with an id; ``rejects``, a row per faulty line; ``counts`` of both."""

    papers: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


def ingest_papers(spark: SparkSession, path: str, target: str) -> Ingested:
    """Read JSON lines once, parted into papers and rejected lines, both kept in ``target``.

    A reject has its ``file``, ``place`` (grows along the file), ``line``, whether its paper
    was kept, and the ``reason``: ``not json``, ``wrong type`` (such a field is null in the
    paper, if that has an id) or ``no id``. Blank lines are no records. ``counts`` are those
    of ``count_rejects``, observed while the rows are written.
    """
    parsed = F.from_json("line", T.StructType([*PAPER.fields, T.StructField(CORRUPT, T.StringType())]), {"columnNameOfCorruptRecord": CORRUPT})
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_metadata.file_block_start")
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), place.alias("place"))
    rows = lines.where(F.trim("line") != "").withColumn("r", parsed)
    key, corrupt = F.col("r.paperId"), F.col(f"r.{CORRUPT}").isNotNull()
    no_id = key.isNull() | (key == "")
    reason = F.when(corrupt & F.try_parse_json("line").isNull(), "not json").when(corrupt, "wrong type").when(no_id, "no id")
    faulty = reason.isNotNull()
    written = rows.select(
        *[F.col(f"r.{f.name}").alias(f.name) for f in PAPER.fields],
        "file",
        "place",
        F.when(faulty, F.col("line")).alias("line"),
        reason.alias("reason"),
        corrupt.alias("corrupt"),
        (~no_id).alias("kept"),
    )
    seen = Observation()
    counts = {
        "n_records": F.count(F.lit(1)),
        "n_rejected": F.count_if("corrupt"),
        "n_without_id": F.count_if(~F.col("kept")),
    }
    written = written.observe(seen, *[c.alias(n) for n, c in counts.items()]).drop("corrupt")
    written.write.partitionBy("kept").parquet(target)
    stored = spark.read.schema(T.StructType([*PAPER.fields, *REJECT.fields])).parquet(target)
    papers = stored.where("kept").select(*PAPER.fieldNames())
    return Ingested(papers, stored.where(F.col("reason").isNotNull()).select(*REJECT.fieldNames()), dict(seen.get))


def archive_path(spark: SparkSession, folder: str, query_name: str, at: datetime | None = None) -> str:
    """Folder of an archive: safe form of the query name and a UTC stamp."""
    stamp = (at or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%SZ")
    name = re.sub(r"[^\w-]", "_", query_name)[:80]
    return f"{folder.rstrip('/')}/raw_json/{name}_{stamp}"


def archive_raw(works: DataFrame, folder: str, query_name: str, parameters: dict | None = None) -> str:
    """Keep raw records as compressed JSON lines, each with the parameters of the
    query that fetched them, and list the archive in the folder's manifest. Returns the path."""
    spark = works.sparkSession
    at = datetime.now(timezone.utc).replace(microsecond=0)
    path = archive_path(spark, folder, query_name, at)
    wrapped = works
    for name, value in (parameters or {}).items():
        wrapped = wrapped.withColumn(f"query_{name}", F.lit(None).cast("string") if value is None else F.lit(value))
    seen = Observation()
    wrapped.observe(seen, F.count(F.lit(1)).alias("n")).write.option("compression", "gzip").json(path)
    row = (query_name, at, path, seen.get["n"], json.dumps(parameters or {}, ensure_ascii=False))
    spark.createDataFrame([row], ARCHIVE).coalesce(1).write.mode("append").parquet(_manifest_path(folder))
    return path


def _manifest_path(folder: str) -> str:
    return f"{folder.rstrip('/')}/raw_json_manifest"


def archives(
    spark: SparkSession, folder: str, query_name: str | None = None, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    """The archives of a folder by its manifest: of one query, saved at ``since`` or later and before ``until``."""
    manifest = _manifest_path(folder)
    listed = spark.read.schema(ARCHIVE).parquet(manifest) if path_exists(spark, manifest) else spark.createDataFrame([], ARCHIVE)
    if query_name is not None:
        listed = listed.where(F.col("query") == query_name)
    if since is not None:
        listed = listed.where(F.col("saved_at") >= F.lit(since))
    if until is not None:
        listed = listed.where(F.col("saved_at") < F.lit(until))
    return listed


def read_archive(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_works(spark, path, "json")


def read_archives(
    spark: SparkSession, folder: str, query_name: str | None = None, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    """Raw works of the archives that ``archives`` finds; only their files are listed and read.
    Records are ordered by path, so those of one query by the time they were saved."""
    # the driver gets the names of the archives' folders, as a listing of the folder would give, and no other rows
    found = archives(spark, folder, query_name, since, until)
    found = found.agg(F.array_sort(F.collect_list(F.struct("saved_at", "path"))).alias("found")).first().found
    if not found:
        return spark.createDataFrame([], T.StructType([*RAW_WORK.fields, T.StructField(RECORD_ORDER, T.LongType())]))
    return read_archive(spark, [r.path for r in found])
