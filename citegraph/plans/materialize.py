"""Cutting lineage on storage that outlives an executor.

Both helpers write into the folder that the session names in
``spark.checkpoint.dir``, so their results survive the loss of any executor.

* ``materialize`` writes a table. Its true size is known afterwards, so the
  optimizer broadcasts it only while it is small.
* ``checkpointed`` keeps the partitioning, for the state of a loop that joins it in
  place. Its size estimate is inherited from the plan and multiplies with every
  join, so it is used only where a round refers to its predecessor once.

What was shuffled for such a state is of no use once it is written. Spark would keep those
files until the driver happens to collect its garbage, so that a chain of states fills the
disks of the executors; here they go with the job (``shuffles_dropped``). An intermediate
table that nothing refers to any more is deleted by ``discard``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Setting of a session: the shuffle files of a query are removed when it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Begin of the folder names of written tables.
WRITTEN = "citegraph-"

#: A side is broadcast explicitly only when its counted rows are at most this.
BROADCAST_MAX_ROWS = 200_000


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for written state, as the session names it.

    Only a purely local session without the setting gets a temporary folder; a
    cluster session without it is an error, since a machine-local folder would
    not survive the loss of that machine.
    """
    sc = spark.sparkContext
    named = (
        spark.conf.get("spark.checkpoint.dir", None)
        or sc.getConf().get("spark.checkpoint.dir")
        or sc.getCheckpointDir()
    )
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="citegraph-checkpoint-")
        sc.setCheckpointDir(named)
    return named


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of queries that are made and run inside are removed as each ends. A part
    of a result that is lost later is shuffled again."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into a table of the checkpoint folder and read that."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{WRITTEN}{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint of ``df``."""
    spark = df.sparkSession
    folder = checkpoint_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    with shuffles_dropped(spark):
        return df.select("*").checkpoint(eager=True)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` returned, once nothing refers to them any more."""
    for table in tables:
        folders = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
        if len(folders) != 1 or not (folder := folders.pop()).rsplit("/", 1)[1].startswith(WRITTEN):
            raise ValueError("not a table that was written here")
        sc = table.sparkSession.sparkContext
        place = sc._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(sc._jsc.hadoopConfiguration()).delete(place, True)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Hint a broadcast when an already materialised, narrow ``df`` is counted to
    be small; otherwise leave the join strategy to the optimizer."""
    return F.broadcast(df) if df.count() <= max_rows else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
