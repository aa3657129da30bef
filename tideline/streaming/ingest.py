"""Incremental ingest: newly landed files into snapshots or keyed tables.

Each run takes what has landed since the last one and stops. Upserts are ordered by the
load columns of the rows, so late slices need no watermark: they simply compete.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tideline.sinks import keyed


def landed_stream(
    spark: SparkSession, landing: str, schema: StructType, fmt: str = "parquet", files_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(landing)


def _batch_name(batch: DataFrame, number: int) -> str:
    return f"stream-{batch.sparkSession.sparkContext.getLocalProperty('sql.streaming.queryId')}-{number}"


def _run(stream: DataFrame, each: Callable[[DataFrame, int], None], progress: str) -> None:
    query: StreamingQuery = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest_upsert(
    stream: DataFrame,
    target: str,
    progress: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    buckets: int = keyed.BUCKETS,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> None:
    """Upsert every micro-batch; a batch repeated after a failure resumes its own work.

    Batches are named after the stream's own id, which its progress folder keeps, so any number of
    streams can feed one target, and one with a new progress folder starts anew.
    """

    def each(batch: DataFrame, number: int) -> None:
        keyed.upsert(
            batch.sparkSession, target, prepare(batch), keys, order_by, buckets=buckets, batch=_batch_name(batch, number)
        )

    _run(stream, each, progress)


def ingest_staged_merge(
    stream: DataFrame,
    staging: str,
    progress: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    **merge,
) -> None:
    """Stage every micro-batch; ``merge`` goes to ``sinks.keyed.staged_merge``, ``sinks.keyed.read_merged`` merges them."""

    def each(batch: DataFrame, number: int) -> None:
        keyed.staged_merge(batch.sparkSession, staging, prepare(batch), batch=_batch_name(batch, number), **merge)

    _run(stream, each, progress)


def ingest_append(stream: DataFrame, target: str, progress: str, partition_by: Sequence[str] = ()) -> None:
    """Append newly landed rows as a Parquet stream sink, each exactly once."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", progress)
        .partitionBy(*partition_by)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()
