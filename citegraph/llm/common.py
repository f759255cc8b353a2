"""What several operators share: reading tables, word pattern, bucket of an id, written state."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citegraph.plans.materialize import materialize

__all__ = ["BLANK", "WORD", "arrow_rows", "crc_bucket", "materialize", "prefixed", "small_batches", "table"]

#: Words are runs of anything but space and the five control characters from tab to return.
BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_bucket(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def arrow_rows(batches: Iterator[pa.RecordBatch], make, schema: pa.Schema, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Apply ``make`` (columns as Python lists to columns as lists) to small slices of each batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            columns = make(*(c.to_pylist() for c in part.columns))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


#: Rows and bytes of the Arrow batches that tasks exchange with Python. A batch is held by both sides,
#: and neither gives its memory back: the usual 10,000 rows are tens of megabytes of texts.
BATCH_LIMITS = {"maxRecordsPerBatch": 500, "maxBytesPerBatch": 4 << 20}


def small_batches(spark: SparkSession) -> None:
    """Have the session exchange small Arrow batches; smaller ones that it asks for stay.

    A lasting setting, since a DataFrame is computed after its operator has returned.
    """
    for name, most in BATCH_LIMITS.items():
        key = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(key, None)
        number = int(now) if now is not None and now.lstrip("-").isdigit() else 0
        if not 0 < number <= most:
            spark.conf.set(key, str(most))


def prefixed(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, resolved once, so that extra or clashing columns never reach an operator."""
    return df.select(*(df[c].alias(c) for c in columns))
