"""Readers for landed files and tables."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.declared import declaration, schema_of
from tideline.session import written


def csv_headers(spark: SparkSession, path: str) -> DataFrame:
    """``file, header`` of every CSV file below ``path`` that is not empty; the header is its first line."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_start"),
        # Within the first part of a file, which one task reads, ids follow the lines.
        F.monotonically_increasing_id().alias("_at"),
        "value",
    )
    return lines.where("_start = 0").groupBy("file").agg(F.min_by("value", "_at").alias("header"))


def missing_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """``file, missing`` for files whose header lacks some of ``columns``."""
    names = F.split(F.regexp_replace("header", '["﻿\r]', ""), ",")
    missing = csv_headers(spark, path).select("file", F.array_except(F.lit(list(columns)), names).alias("missing"))
    return missing.where(F.size("missing") > 0)


def read_csv_text(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    slice_columns: Sequence[str] = (),
    by_name: bool = True,
    multi_line: bool = True,
) -> DataFrame:
    """CSV responses with every column a string; slice columns come from the folder names.

    Columns are found by name in the header of each file, whatever their order: others are left out,
    and one that a file lacks is null (``missing_columns`` reports those). That takes one pass
    over the lines for the headers, then one scan per different header; only headers with the names of
    their files reach the driver, which lists the files anyway. ``by_name=False`` saves the pass: every
    file must then have exactly ``columns``, which is checked. ``multi_line=False`` lets Spark split
    large files, for texts known to have no quoted line breaks.
    """

    def scan(names: Sequence[str], files, enforce: bool) -> DataFrame:
        schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, *slice_columns]])
        reader = spark.read.schema(schema).option("header", True).option("enforceSchema", enforce)
        return reader.option("multiLine", multi_line).option("escape", '"').option("basePath", path).csv(files)

    wanted = [*columns, *slice_columns]
    if not by_name:
        return scan(columns, path, enforce=False)
    headers = csv_headers(spark, path).groupBy("header").agg(F.collect_list("file").alias("files"))
    found = spark.createDataFrame([], T.StructType([T.StructField(name, T.StringType()) for name in wanted]))
    for header, files in headers.collect():
        names = next(csv.reader([header.lstrip("﻿")]), [])
        # A name that is not wanted, or comes again, is only a place.
        known = [name if name in columns and name not in names[:i] else f"_unused_{i}" for i, name in enumerate(names)]
        rows = scan(known, files, enforce=True)
        found = found.unionByName(rows.select(*[f"`{n}`" for n in wanted if n in rows.columns]), allowMissingColumns=True)
    return found


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table, or a Parquet folder or glob when ``name`` is a path, with its declared types if it has any."""
    if "/" not in name:
        return spark.table(name)
    declared = declaration(spark, name)
    return (spark.read.schema(schema_of(declared)) if declared else spark.read).parquet(name)


def parsed_json(payload: Column, schema: T.StructType | str) -> Column:
    """JSON text by a declared schema; malformed text gives null fields."""
    return F.from_json(payload, schema)


def arrays_to_rows(df: DataFrame, arrays: dict[str, str], keep: Sequence[str]) -> DataFrame:
    """Parallel arrays to one row per index; ``arrays`` maps output name to array column.

    Give it rows that ``aligned_arrays`` accepts: zipping would pad a short array.
    """
    zipped = F.arrays_zip(*[F.col(source).alias(name) for name, source in arrays.items()])
    return df.select(*keep, F.inline(zipped).alias(*arrays))


def aligned_arrays(arrays: Sequence[str], index: str) -> Column:
    """True when no array is shorter than the ``index`` array; a missing array counts as short."""
    size = F.size(F.col(index))
    tests = [F.coalesce(F.size(F.col(name)) >= size, F.lit(False)) for name in arrays]
    combined = F.col(index).isNotNull()
    for test in tests:
        combined = combined & test
    return combined


def lookup(df: DataFrame, dimension: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Inner join to a keyed dimension. No hint: Spark broadcasts it when it is small enough."""
    return df.join(dimension, on, "inner")


def lookup_with_hot_keys(
    df: DataFrame, dimension: DataFrame, on: str, how: str = "inner", share: int = 1000
) -> DataFrame:
    """As ``lookup`` (or a left join) for rows of which a few keys hold a large part.

    Keys with more than one row in ``share`` number fewer than ``share``, so their
    dimension rows, one per key, are safe to broadcast whatever the tables' size: hot rows
    are joined where they are read. All other rows join by shuffle, where no key is large.
    A dimension with several rows for a hot key has no such bound; it is counted before
    the broadcast, and left to ``lookup`` if it exceeds ``share`` rows.
    """
    total = df.agg(F.count("*")).scalar()
    counts = df.groupBy(on).agg(F.count("*").alias("_n")).where(F.col(on).isNotNull())
    hot = F.broadcast(written(counts.where(F.col("_n") * share > total).select(on), "hot-keys"))
    hot_dimension = written(dimension.join(hot, on, "left_semi"), "hot-dimension")
    if hot_dimension.count() > share:
        return df.join(dimension, on, how)
    hot_dimension = F.broadcast(hot_dimension)
    hot_rows = df.join(hot, on, "left_semi").join(hot_dimension, on, how)
    other_rows = df.join(hot, on, "left_anti").join(dimension, on, how)
    return hot_rows.unionByName(other_rows)


def unmatched(df: DataFrame, dimension: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key the dimension lacks, for reporting."""
    return df.join(dimension, on, "left_anti")
