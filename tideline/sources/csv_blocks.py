"""CSV files of any size with line breaks inside quotes, read by many tasks each.

A line begins inside a quoted value when the quotes before it in its file are odd in number. Tasks count quotes from
the start of their own block of a file, sums over the blocks say with which state each began, and so
every line knows the record it belongs to. Records of one line, nearly all, stay where they are read; only the lines
of longer ones are shuffled.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.session import written

_MARK = "﻿"  # of byte order


def _file_lines(spark: SparkSession, path: str, slice_columns: Sequence[str]) -> DataFrame:
    schema = T.StructType([T.StructField(name, T.StringType()) for name in ["value", *slice_columns]])
    lines = spark.read.schema(schema).option("basePath", path).option("lineSep", "\n").text(path)
    place = {"_file": "file_path", "_block": "file_block_start", "_length": "file_block_length"}
    return lines.select("value", *slice_columns, *[F.col(f"_metadata.{at}").alias(name) for name, at in place.items()])


def _numbered_lines(batches: Iterator) -> Iterator:
    """Adds to each line its number in its block, whether the block's quotes up to its end are odd, and the last line that
    begins a record, once if the block begins outside quotes and once if inside (-1: none so far)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    place, number, odd, starts = None, 0, 0, [-1, -1]
    for batch in batches:
        n = batch.num_rows
        files, blocks = batch.column("_file"), batch.column("_block")
        quotes = pc.count_substring(batch.column("value"), '"').to_numpy(zero_copy_only=False) & 1
        changes = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(blocks[1:], blocks[:-1])) if n > 1 else []
        bounds = [0, *(np.flatnonzero(np.asarray(changes)) + 1).tolist(), n] if n else []
        columns = [[], [], [], []]
        for low, high in zip(bounds, bounds[1:]):
            if (files[low].as_py(), blocks[low].as_py()) != place:
                place, number, odd, starts = (files[low].as_py(), blocks[low].as_py()), 0, 0, [-1, -1]
            numbers = np.arange(number, number + high - low, dtype=np.int64)
            after = (odd + np.cumsum(quotes[low:high])) & 1
            before = after ^ quotes[low:high]
            # A line begins a record when its block began in the same state as the quotes before it would undo.
            begun = [np.maximum(np.maximum.accumulate(np.where(before == s, numbers, -1)), starts[s]) for s in (0, 1)]
            number, odd, starts = number + high - low, int(after[-1]), [int(begun[s][-1]) for s in (0, 1)]
            for column, part in zip(columns, (numbers, after.astype(np.int32), *begun)):
                column.append(part)
        if n:
            added = [pa.array(np.concatenate(column)) for column in columns]
            names = [*batch.schema.names, "_number", "_odd", "_start0", "_start1"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=names)


def _lines(spark: SparkSession, path: str, slice_columns: Sequence[str]) -> DataFrame:
    lines = _file_lines(spark, path, slice_columns)
    fields = [*lines.schema.fields]
    added = [T.StructField("_number", T.LongType()), T.StructField("_odd", T.IntegerType())]
    added += [T.StructField(name, T.LongType()) for name in ("_start0", "_start1")]
    return lines.mapInArrow(_numbered_lines, T.StructType(fields + added))


def _counted_blocks(batches: Iterator) -> Iterator:
    """One row per batch and block out of lines: the number of the last line, its state, whether any line ends inside quotes,
    the last lines that begin a record and the first line of a file."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in _numbered_lines(batches):
        n = batch.num_rows
        files, blocks = batch.column("_file"), batch.column("_block")
        changes = np.asarray(pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(blocks[1:], blocks[:-1]))) if n > 1 else []
        ends = [*np.flatnonzero(changes).tolist(), n - 1]
        starts = [0, *[end + 1 for end in ends[:-1]]]
        odd = batch.column("_odd").to_numpy()
        heads = [
            batch.column("value")[i].as_py() if blocks[i].as_py() == 0 and batch.column("_number")[i].as_py() == 0 else None for i in starts
        ]
        last = batch.select(["_file", "_block", "_length", "_number", "_odd", "_start0", "_start1"]).take(pa.array(ends, pa.int64()))
        inside = [int(odd[low : high + 1].max()) for low, high in zip(starts, ends)]
        yield pa.RecordBatch.from_arrays(
            [*last.columns, pa.array(inside, pa.int32()), pa.array(heads, pa.string())], names=[*last.schema.names, "_any", "_head"]
        )


def _blocks(lines: DataFrame) -> DataFrame:
    """``_file, _block, _length, _inside, _from_block, _from, _header, _breaks`` per block of a file, written once.

    ``_inside`` says whether it begins inside quotes, ``_from_block`` and ``_from`` name the line that began the record it begins in,
    ``_header`` is the first line of the file and ``_breaks`` whether any line of the block ends inside quotes or begins there.
    A file with an odd number of quotes fails the job.
    """
    schema = "_file string, _block bigint, _length bigint, _number bigint, _odd int, _start0 bigint, _start1 bigint, _any int, _head string"
    counted = lines.select("value", "_file", "_block", "_length").mapInArrow(_counted_blocks, schema).groupBy("_file", "_block", "_length").agg(
        F.max_by("_odd", "_number").alias("_odd"),
        F.max("_any").alias("_any"),
        F.max("_start0").alias("_start0"),
        F.max("_start1").alias("_start1"),
        F.max("_head").alias("_head"),
    )
    of_file = Window.partitionBy("_file").orderBy("_block")
    so_far = of_file.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_file")
    states = counted.select(
        "*",
        (F.coalesce(F.sum("_odd").over(so_far), F.lit(0)) % 2).cast("int").alias("_inside"),
        (F.sum("_odd").over(whole) % 2 == 1).alias("_unbalanced"),
        F.max("_head").over(whole).alias("_header"),
    )
    own = F.when(F.col("_inside") == 0, F.col("_start0")).otherwise(F.col("_start1"))
    own = F.when(own >= 0, F.struct(F.col("_block").alias("block"), own.alias("start")))
    begun = states.withColumn("_own", own).withColumn("_from", F.last("_own", ignorenulls=True).over(so_far))
    failed = F.raise_error(F.concat(F.lit("odd number of quotes in "), F.col("_file")))
    return written(
        begun.select(
            "_file",
            "_block",
            "_length",
            F.when(~F.col("_unbalanced"), F.col("_inside")).otherwise(failed).alias("_inside"),
            F.col("_from.block").alias("_from_block"),
            F.col("_from.start").alias("_from"),
            "_header",
            ((F.col("_any") == 1) | (F.col("_inside") == 1)).alias("_breaks"),
        ),
        "csv-blocks",
    )


def _records(lines: DataFrame, blocks: DataFrame, slice_columns: Sequence[str]) -> DataFrame:
    """One row per record that is not a header: ``record, _file, _header`` and the slice columns."""
    known = lines.join(blocks, ["_file", "_block", "_length"], "left")
    # Each scan cuts the files anew; with other settings or another number of cores in between they have other blocks.
    moved = F.raise_error(F.concat(F.lit("blocks have moved since they were counted: "), F.col("_file")))
    inside = F.coalesce("_inside", moved)
    own = F.when(inside == 0, F.col("_start0")).otherwise(F.col("_start1"))
    placed = known.select(
        "*",
        (own < 0).alias("_carried"),
        (own == F.col("_number")).alias("_begins"),
        (((F.col("_odd") + inside) % 2) == 0).alias("_ends"),
        own.alias("_own"),
    )
    whole = F.col("_begins") & F.col("_ends")
    header = (F.col("_block") == 0) & (F.col("_number") == 0)
    kept = ["_file", "_header", *slice_columns]
    single = placed.where(whole & ~header).select(F.col("value").alias("record"), *kept)
    if blocks.where("_breaks").isEmpty():
        return single
    in_order = F.array_sort(F.collect_list(F.struct("_block", "_number", "value")))
    long = (
        placed.where(~whole)
        .withColumn("_at", F.when(F.col("_carried"), F.col("_from_block")).otherwise(F.col("_block")))
        .withColumn("_start", F.when(F.col("_carried"), F.col("_from")).otherwise(F.col("_own")))
        .groupBy(*[F.col(name) for name in kept], "_at", "_start")
        .agg(F.array_join(F.transform(in_order, lambda line: line["value"]), "\n").alias("record"))
    )
    return single.unionByName(long.select("record", *kept))


def _is_regular(record: Column) -> Column:
    """Every quote of the record encloses a whole value or is doubled within one."""
    undoubled = F.regexp_replace(F.replace(record, F.lit('""'), F.lit("")), r'(?<=^|,)"[^"]*"(?=,|\r?\z)', "")
    return ~record.contains('"') | ~undoubled.contains('"')


def _without_return(record: Column) -> Column:
    return F.when(record.endswith("\r"), F.substring(record, F.lit(1), F.length(record) - 1)).otherwise(record)


def _picker(columns: Sequence[str], places: Sequence[int | None]) -> Callable[[Column], Column]:
    """Function from parsed values to the wanted columns, each by its place in the header."""

    def pick(values: Column) -> Column:
        found = [F.lit(None).cast("string") if place is None else values[f"_c{place}"] for place in places]
        return F.struct(*[value.alias(name) for value, name in zip(found, columns, strict=True)])

    return pick


def read_csv_blocks(spark: SparkSession, path: str, columns: Sequence[str], slice_columns: Sequence[str] = ()) -> DataFrame:
    """CSV files below ``path`` with every column a string; slice columns come from the folder names.

    As ``landed.read_csv_text``: columns are found by name in each file's header, others are left out, and one that a file
    lacks is null. But large files are split among tasks whatever line breaks their values hold, headers come from the
    pass that counts quotes, and only the different headers reach the driver, no file names. Text is scanned
    twice, and once more if any value holds a line break; no line of a record of one line is shuffled.

    Quotes must be as RFC 4180 has them, and a header must be one line: a quote within a value that is not quoted, or an odd number of
    quotes in a file, fails the job with the file's name (``landed.read_csv_text`` guesses there). Lines end
    with ``\\n`` or ``\\r\\n``. Blank lines are no records.
    """
    lines = _lines(spark, path, slice_columns)
    blocks = _blocks(_file_lines(spark, path, slice_columns))
    headers = [row[0] for row in blocks.select("_header").distinct().collect() if row[0] is not None]
    irregular = F.raise_error(F.concat(F.lit("a quote within a value that is not quoted in "), F.col("_file")))
    records = _records(lines, blocks, slice_columns).withColumn("_bare", _without_return(F.col("record"))).where(F.trim("_bare") != "")
    checked = F.when(_is_regular(F.col("record")), F.col("_bare")).otherwise(irregular)
    wanted = T.ArrayType(T.StructType([T.StructField(name, T.StringType()) for name in columns]))
    parsed = F.lit(None).cast(wanted)
    for header in headers:
        names = next(csv.reader([header.removeprefix(_MARK).rstrip("\r")]), [])
        fields = ", ".join(f"_c{i} string" for i in range(len(names)))
        places = [names.index(name) if name in names else None for name in columns]
        # Arrays, so that a record is parsed once and not for each column.
        values = F.transform(F.array(F.from_csv(F.col("record"), fields, {"escape": '"'})), _picker(columns, places))
        parsed = F.when(F.col("_header") == header, values).otherwise(parsed)
    typed = records.withColumn("record", checked).select(*slice_columns, F.inline(parsed))
    return typed.select(*columns, *slice_columns)
