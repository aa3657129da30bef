"""Keyed tables on plain Parquet: batches are appended, and rows of a key merge when they are read.

A batch is one folder that one Spark job writes; it counts once the job has left its success marker.
Nothing that has been written is ever written again, so readers never meet half a change. Of the
rows of a key the latest by ``order_by`` is the one that is read, whenever it came; so a batch that comes late,
or again, does no harm, and neither does a compaction: it writes the merged rows as one more folder,
which gives the same result with or without the folders it covers. Those are removed apart, when no
reader can be using them. Where the table format has row-level merge, use ``merge_into`` instead.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.declared import declaration, declare, exists, files, like_declared, schema_of
from tideline.operators.bitmaps import bitmap, marked
from tideline.operators.dedup import first_per_key, latest_non_null, latest_per_key
from tideline.operators.quality import watched, watched_keys
from tideline.session import shuffles_removed

BUCKET = "key_bucket"

# Folders of a compacted table by key hash; a table of many terabytes wants thousands.
BUCKETS = 64

# Compacted folders sort after the batch whose number they carry, which is the last that they cover.
_COMPACTED = "~"


def _bucket(table: dict) -> Column:
    return F.pmod(F.xxhash64(*table["bucket_by"]), F.lit(table["buckets"])).cast("int")


def _written(spark: SparkSession, path: str, kind: str = "batch") -> list[str]:
    """Names of finished folders, in order."""
    pattern, system = files(spark, f"{path}/{kind}=*/_SUCCESS")
    return sorted(f.getPath().getParent().getName().split("=", 1)[1] for f in system.globStatus(pattern))


def _covered(spark: SparkSession, path: str) -> set[str]:
    """Names that a finished compaction holds the rows of, whether their folders are still there or not."""
    records = [f"{path}/_covered={name}" for name in _written(spark, path, "_covered")]
    return {row.value for row in spark.read.text(records).collect()} if records else set()


def _live(spark: SparkSession, path: str) -> list[str]:
    covered = _covered(spark, path)
    return [name for name in _written(spark, path) if name not in covered]


def _rows(spark: SparkSession, path: str, table: dict, names: Sequence[str]) -> DataFrame:
    """Rows of some folders with ``batch`` and the bucket; only compacted ones are laid out by bucket."""
    schema = schema_of(table).add("batch", "string")
    reader = spark.read.option("basePath", path)
    folders = {kind: [f"{path}/batch={n}" for n in names if (_COMPACTED in n) == kind] for kind in (False, True)}
    found = spark.createDataFrame([], schema).withColumn(BUCKET, F.lit(None).cast("int"))
    if folders[False]:
        found = reader.schema(schema).parquet(*folders[False]).withColumn(BUCKET, _bucket(table))
    if folders[True]:
        compacted = reader.schema(schema_of(table).add("batch", "string").add(BUCKET, "integer")).parquet(*folders[True])
        found = compacted.unionByName(found) if folders[False] else compacted
    return found


def _sorted_by(keys: Sequence[str], bucket_by: Sequence[str]) -> list[str]:
    """The keys in the order in which a sort should compare them: stages and slices, which many rows share, come last."""
    return list(dict.fromkeys([*bucket_by, *keys]))


def _latest(rows: DataFrame, table: dict) -> DataFrame:
    """One row per key, the one appended last when rows tie; of a table of slices all rows that came with it."""
    order = [F.desc_nulls_last(c) for c in [*table["order_by"], "batch"]]
    keys = [*_sorted_by(table["keys"], table["bucket_by"]), BUCKET]
    if not table["slices"]:
        return first_per_key(rows, keys, order)
    rank = F.rank().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def _merged(spark: SparkSession, path: str, table: dict, names: Sequence[str]) -> DataFrame:
    """Rows of the folders merged; what was compacted is only shuffled where later batches have rows."""
    compacted = [name for name in names if _COMPACTED in name]
    if len(names) == 1:
        return _rows(spark, path, table, names)  # a folder has one row, or one slice, per key
    if len(compacted) != 1:
        return _latest(_rows(spark, path, table, names), table)
    later, base = _rows(spark, path, table, [n for n in names if n not in compacted]), _rows(spark, path, table, compacted)
    touched = F.col(BUCKET).isin([row[0] for row in later.select(BUCKET).distinct().collect()])
    return base.where(~touched).unionByName(_latest(base.where(touched).unionByName(later), table))


def finished(spark: SparkSession, folder: str) -> bool:
    """Whether the job that wrote a folder came to its end."""
    return exists(spark, f"{folder}/_SUCCESS")


def is_table(spark: SparkSession, path: str) -> bool:
    """Whether a batch has been appended at ``path``."""
    return declaration(spark, path) is not None and bool(_written(spark, path))


def is_only_batch(spark: SparkSession, path: str, batch: str) -> bool:
    """Whether a batch holds all rows of the table, so that every key is one of its own."""
    live = _live(spark, path)
    return len(live) == 1 and _COMPACTED not in live[0] and live[0].split("-", 1)[1] == batch


def has_batch(spark: SparkSession, path: str, batch: str) -> bool:
    """Whether a batch of that name has been appended, even if a compaction holds its rows now."""
    return any(name.split("-", 1)[1] == batch for name in {*_written(spark, path), *_covered(spark, path)})


def read_keyed(spark: SparkSession, path: str, only: DataFrame | None = None) -> DataFrame:
    """The table as it stands: one row per key; with ``only``, which holds values of some key columns, the rows of those.

    Rows of other keys are sorted out before the folders are merged, nearly all by a bitmap before they are shuffled, and the
    merge follows in the same tasks.
    """
    table, names = declaration(spark, path), _live(spark, path)
    if only is None:
        return _merged(spark, path, table, names).drop("batch", BUCKET)
    rows = _rows(spark, path, table, names)
    # Equal values of other types, which the join may still match, have other hashes.
    if all(rows.schema[c].dataType == only.schema[c].dataType for c in only.columns):
        rows = marked(rows, bitmap(only), [F.col(f"`{c}`") for c in only.columns], "_only").where("_only").drop("_only")
    rows = rows.join(only, only.columns, "left_semi")
    return (rows if len(names) == 1 else _latest(rows, table)).drop("batch", BUCKET)


def _gathered(df: DataFrame, layout: Sequence[str]) -> DataFrame:
    """Rebalancing gathers the rows of a folder but splits a large one over several tasks."""
    return df.hint("rebalance", *layout) if layout else df


def _write(df: DataFrame, folder: str, layout: Sequence[str]) -> None:
    with shuffles_removed(df.sparkSession):
        df.write.mode("overwrite").partitionBy(*layout).parquet(folder)


def _same_rows(a: DataFrame, b: DataFrame, but: Sequence[str]) -> bool:
    """Whether number and summed hashes of the rows agree in all but some columns."""

    def print_of(df: DataFrame) -> tuple:
        row = F.xxhash64(*[f"`{c}`" for c in sorted(b.columns) if c not in but]).cast("decimal(38,0)")
        return tuple(df.agg(F.count("*"), F.sum(row)).first())

    return print_of(a) == print_of(b)


def upsert(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    buckets: int = BUCKETS,
    bucket_by: Sequence[str] | None = None,
    partitions: Sequence[str] = (),
    batch: str | None = None,
    slices: bool = False,
    unique: bool = False,
    gather: bool = True,
    report: dict | None = None,
    **declared,
) -> None:
    """Append ``incoming`` to the keyed table at ``path``; the latest row of a key is read, however late it comes.

    The table is declared by its first batch; one with other columns, keys or order fails. A batch writes
    its own rows, one per key, and reads nothing else. Repeating a ``batch`` that is through changes nothing; its name
    with other rows is an error as long as its folder is there (columns of ``order_by`` may differ, as load times do).
    ``bucket_by``, which says how compacted rows are laid out, and ``partitions`` must be part of the key.
    With ``slices`` a key stands for all rows that a batch has for it, which replace those of earlier batches
    together; ``order_by`` should then be equal in all rows of a slice, or empty.
    ``unique`` says that ``incoming`` has one row per key already, so that it is written without a shuffle.
    Without ``gather``, for ``partitions`` of few values, each task writes to all their folders, which spares a shuffle of the rows.
    ``report`` receives ``n_rows`` and ``n_null_keys`` of ``incoming`` and ``n_stored``, the rows written, all counted
    by the job that writes; it stays as it is when the batch was there already.
    """
    if batch is not None and not re.fullmatch(r"[\w.-]+", batch):
        raise ValueError(f"{batch!r} cannot name a batch")
    layout = {"keys": list(keys), "order_by": list(order_by), "buckets": buckets, "bucket_by": list(bucket_by or keys)}
    layout |= {"partitions": list(partitions), "slices": slices}
    table = declaration(spark, path)
    rows = like_declared(incoming, table) if table else incoming
    table = declare(spark, path, table and schema_of(table) or incoming.schema, **layout, **declared)
    rows, came = watched_keys(rows, keys) if report is not None else (rows, None)
    newest = rows if slices or unique else latest_per_key(rows, _sorted_by(keys, layout["bucket_by"]), order_by)
    finished = _written(spark, path)
    if batch is not None:
        known = [name for name in finished if name.split("-", 1)[1] == batch]
        if known:
            if not _same_rows(_rows(spark, path, table, known), newest, order_by):
                raise ValueError(f"batch {batch!r} of {path} has been used for other rows")
            return
        if has_batch(spark, path, batch):
            return
    number = 1 + max((int(name.split("-", 1)[0]) for name in finished), default=0)
    newest, stored = watched(newest, "n_stored") if report is not None else (newest, None)
    newest = _gathered(newest, table["partitions"]) if gather else newest
    _write(newest, f"{path}/batch={number:08d}-{batch or uuid.uuid4().hex}", table["partitions"])
    if report is not None:
        report.update(came.get | stored.get)


def _record(spark: SparkSession, place: str, names: Sequence[str]) -> None:
    spark.createDataFrame([(name,) for name in names], "value string").coalesce(1).write.text(place)


def compact(spark: SparkSession, path: str) -> list[str]:
    """Write the merged rows of all finished folders as one, laid out by bucket; returns the folders it covers.

    It may run beside readers and batches and may be killed at any time: until its rows and the list of what
    they cover are written, readers use the folders there were, and afterwards either gives the same rows.
    """
    table, live = declaration(spark, path), _live(spark, path)
    if len(live) < 2:
        return []
    name = f"{live[-1].split('-', 1)[0]}-{_COMPACTED}{uuid.uuid4().hex}"
    layout = [*table["partitions"], BUCKET]
    _write(_gathered(_merged(spark, path, table, live).drop("batch"), layout), f"{path}/batch={name}", layout)
    _record(spark, f"{path}/_covered={name}", live)
    return live


def remove_covered(spark: SparkSession, path: str) -> list[str]:
    """Delete the folders whose rows a compaction holds; call it when readers from before that are done."""
    gone = [name for name in _written(spark, path) if name in _covered(spark, path)]
    for name in gone:
        place, system = files(spark, f"{path}/batch={name}")
        system.delete(place, True)
    return gone


def staged_merge(
    spark: SparkSession,
    staging: str,
    incoming: DataFrame,
    stage: str,
    slice_column: str,
    keys: Sequence[str],
    merge_columns: Sequence[str],
    order_by: Sequence[str],
    buckets: int = BUCKETS,
    batch: str | None = None,
    report: dict | None = None,
) -> None:
    """Stage landed slices by parameter; ``read_merged`` gives one row per key out of all stages.

    Staging keeps one row per stage, slice and key, so a replayed slice replaces itself and
    a later slice with an empty column cannot erase an earlier value. The merge needs each of those
    rows with its own time, so that is what a compaction keeps as well.
    """
    upsert(
        spark,
        staging,
        incoming,
        keys=[stage, slice_column, *keys],
        order_by=order_by,
        buckets=buckets,
        bucket_by=keys,
        partitions=[stage],
        gather=False,
        batch=batch,
        report=report,
        merge={"keys": list(keys), "columns": list(merge_columns)},
    )


def read_merged(spark: SparkSession, staging: str) -> DataFrame:
    """One row per key out of all stages, each merge column with its latest non-null value."""
    table = declaration(spark, staging)
    merge = table["merge"]
    return latest_non_null(read_keyed(spark, staging), merge["keys"], merge["columns"], table["order_by"])


def merge_into(incoming: DataFrame, table: str, keys: Sequence[str], order_by: Sequence[str]) -> None:
    """Upsert into a catalog table whose format supports row-level merge."""
    newest = latest_per_key(incoming, keys, order_by).alias("incoming")
    stored = table.split(".")[-1]
    same = [F.col(f"incoming.{key}").eqNullSafe(F.col(f"{stored}.{key}")) for key in keys]
    later = F.struct(*[f"incoming.{c}" for c in order_by]) >= F.struct(*[f"{stored}.{c}" for c in order_by])
    merge = newest.mergeInto(table, reduce(lambda a, b: a & b, same))
    merge.whenMatched(later).updateAll().whenNotMatched().insertAll().merge()
