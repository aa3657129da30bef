"""Snapshot append, staging by parameter and full refresh."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.declared import declare
from tideline.functions.dates import AsOf, day
from tideline.operators.quality import watched_keys

#: Rows of a bucket, which one task sorts and one task joins.
BUCKET_ROWS = 1_000_000


def append_snapshot(
    df: DataFrame, path: str, as_of: AsOf = None, column: str = "snapshot_date", keys: Sequence[str] = (), report: dict | None = None
) -> None:
    """Add the rows as the snapshot of one day; earlier snapshots are never touched.

    ``report`` receives ``n_rows`` and ``n_null_keys`` (of ``keys``), counted by the job that writes.
    """
    dated = df.withColumn(column, day(as_of))
    declare(df.sparkSession, path, dated.schema)
    dated, watch = watched_keys(dated, keys) if report is not None else (dated, None)
    dated.write.mode("append").partitionBy(column).parquet(path)
    if watch:
        report.update(watch.get)


def stage_by(df: DataFrame, path: str, *parameters: str) -> None:
    """One folder per parameter value; only the values present in ``df`` are replaced.

    ``landed.read_table`` gives parameters back with the types they had.
    """
    declare(df.sparkSession, path, df.schema)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*parameters).parquet(path)


def full_refresh(df: DataFrame, path: str) -> DataFrame:
    """Materialise a dataset and return it as stored."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def buckets_for(df: DataFrame, rows: int = BUCKET_ROWS) -> int:
    """The power of two of buckets that hold at most ``rows`` each on average, so that a larger table has more, not larger ones.

    Tables that are to be joined on their buckets take the largest number any of them needs.
    """
    return 1 << (max(-(-df.count() // rows), 1) - 1).bit_length()


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Replace a catalog table by ``df``, bucketed and sorted by ``keys``; returns the table as stored.

    Tables bucketed by equal keys into equally many buckets are joined, grouped and deduplicated by those keys
    without a shuffle. Rows are dealt by the keys before they are written, so that a bucket is one file. With ``path`` the
    table is external: its files lie there.
    """
    dealt = df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).format("parquet")
    (dealt.option("path", path) if path else dealt).saveAsTable(name)
    return df.sparkSession.table(name)


def stored_text(number: Column) -> Column:
    """Number as landed string tables hold it: missing is the text ``nan``."""
    return F.coalesce(number.cast("string"), F.lit("nan"))
