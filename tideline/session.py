"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", app: str = "tideline", **conf: str) -> SparkSession:
    """Session for tests and benchmarks; on a cluster the caller brings their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        # The JVM never compiles methods above 8000 bytes; wide projections are split instead.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="tideline-")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_scratch()


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run inside go when it ends; otherwise they stay until the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write ``df`` once as Parquet in the shared folder and read it back.

    Unlike a cache this outlives lost executors, and unlike an RDD checkpoint the
    copy stays columnar, so later readers still prune columns.
    """
    path = fresh_dir(df.sparkSession, label)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder) -> None:
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``fresh_dir`` has named, or one below, that nothing will read again."""
    _delete(spark, spark._jvm.org.apache.hadoop.fs.Path(path))


def remove(*tables: DataFrame) -> None:
    """Delete tables that ``written`` has given and that nothing will read again."""
    for table in tables:
        spark = table.sparkSession
        for file in table.inputFiles()[:1]:
            _delete(spark, spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file)).getParent())
