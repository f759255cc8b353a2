"""Versions of a set of tables that are replaced together.

Every save writes its tables into folders of its own, ``<table>/version=<name>``, and then
commits by appending one row to a small table of commits. Readers follow the newest row,
so they see all tables of one save or none: a save that stops in between leaves the
previous version in force, and a reader that started on it keeps its files until they are
dropped. The append is one file that Spark's committer moves into place.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_COMMIT = "number bigint, version string, saved_at timestamp"


def _commits(spark: SparkSession, log: str) -> DataFrame | None:
    return spark.read.schema(_COMMIT).json(log) if path_exists(spark, log) else None


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def current_version(spark: SparkSession, log: str) -> str | None:
    """The version committed last; null without any. Of equal numbers, which only savers
    at the same time produce, the larger name is in force for every reader."""
    commits = _commits(spark, log)
    last = None if commits is None else commits.agg(F.max(F.struct("number", "version")).alias("m")).first().m
    return None if last is None else last.version


def new_version() -> str:
    return uuid.uuid4().hex


def commit(spark: SparkSession, log: str, version: str) -> None:
    """Put ``version``, whose tables are all written, in force."""
    commits = _commits(spark, log)
    last = None if commits is None else commits.agg(F.max("number")).first()[0]
    row = (1 + (last or 0), version, datetime.now(timezone.utc))
    spark.createDataFrame([row], _COMMIT).coalesce(1).write.mode("append").json(log)


def versioned(table: str, version: str | None) -> str:
    """Folder of a version of ``table``; without a version, as older saves wrote it, the table's own."""
    return table if version is None else f"{table}/version={version}"


def drop_old_versions(spark: SparkSession, log: str, tables: list[str], keep: int = 2) -> list[str]:
    """Delete all versions of ``tables`` but the ``keep`` committed last, and return their names.

    Folders of saves that never committed stay, since one may still be running.
    """
    if keep < 1:
        raise ValueError("the version in force must be kept")
    commits = _commits(spark, log)
    if commits is None:
        return []
    # the driver gets the names of the saves of this set of tables, whose folders it deletes
    named = F.array_sort(F.collect_list(F.struct("number", "version")))
    rows = F.slice(F.reverse(named), keep + 1, F.greatest(F.size(named), F.lit(1)))
    rows = commits.agg(rows.alias("rows")).first().rows
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    dropped = []
    for row in rows:
        for table in tables:
            place = hadoop(versioned(table, row.version))
            if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True):
                dropped.append(row.version)
    return list(dict.fromkeys(dropped))
