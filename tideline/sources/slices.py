"""Slices of an iteration grid as a Spark data source: one input partition, and one call of a function, per slice."""

from __future__ import annotations

import datetime as dt
import itertools
import json
from collections.abc import Callable, Iterable, Iterator, Sequence

from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

#: Gives the rows of a slice: it gets ``slice_start``, ``slice_end`` and the categories by name.
Fetch = Callable[[dict], Iterable[dict]]

#: Rows handed to Spark at once; a function that yields rows is never held whole.
BATCH_ROWS = 10_000

_KEPT_BY = {
    EqualTo: lambda value, wanted: value == wanted,
    In: lambda value, wanted: value in wanted,
    GreaterThan: lambda value, wanted: value > wanted,
    GreaterThanOrEqual: lambda value, wanted: value >= wanted,
    LessThan: lambda value, wanted: value < wanted,
    LessThanOrEqual: lambda value, wanted: value <= wanted,
}


def grid_slices(options: dict[str, str]) -> list[dict]:
    """The slices that options declare, in order; ``calendar.slice_grid`` gives the same as a DataFrame.

    ``start`` and ``end`` are the declared range, ``step_days`` and ``window_days`` its grain,
    ``categories`` a JSON object of lists. ``only_from``, ``only_to`` and ``limit`` restrict a run.
    """
    first, last = (dt.date.fromisoformat(options[name]) for name in ("start", "end"))
    step, window = int(options.get("step_days", 1)), int(options.get("window_days", 1))
    only_from = dt.date.fromisoformat(options.get("only_from", options["start"]))
    only_to = dt.date.fromisoformat(options.get("only_to", options["end"]))
    starts = [first + dt.timedelta(n) for n in range(0, (last - first).days + 1, step)]
    starts = [day for day in starts if only_from <= day <= only_to]
    categories = json.loads(options.get("categories", "{}"))
    slices = [
        {"slice_start": day, "slice_end": day + dt.timedelta(window - 1), **dict(zip(categories, values, strict=True))}
        for day in starts
        for values in itertools.product(*categories.values())
    ]
    if "limit" in options:
        slices.sort(key=lambda one: (one["slice_start"], *(one[name] for name in categories)))
    return slices[: int(options["limit"])] if "limit" in options else slices


class SlicePartition(InputPartition):
    def __init__(self, values: dict):
        super().__init__(values)


class SliceReader(DataSourceReader):
    def __init__(self, schema: T.StructType, slices: list[dict], fetch: Fetch):
        self._schema, self.slices, self._fetch = schema, slices, fetch

    def partitions(self) -> Sequence[InputPartition]:
        return [SlicePartition(values) for values in self.slices]

    def read(self, partition: InputPartition) -> Iterator:
        """Rows of one slice as Arrow batches of the declared schema; keys a row lacks are null, others are left out."""
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        if partition is None:  # no slice is left
            return
        schema, rows = to_arrow_schema(self._schema), iter(self._fetch(dict(partition.value)))
        while chunk := list(itertools.islice(rows, BATCH_ROWS)):
            yield pa.RecordBatch.from_pylist([{**row, **partition.value} for row in chunk], schema=schema)


class PrunedSliceReader(SliceReader):
    """Also takes filters on slice columns, so that other slices get no partition."""

    def pushFilters(self, filters):
        for one in filters:
            kept = _KEPT_BY.get(type(one))
            if kept and len(one.attribute) == 1 and all(one.attribute[0] in values for values in self.slices):
                self.slices = [values for values in self.slices if kept(values[one.attribute[0]], one.value)]
            else:
                yield one


class SliceStreamReader(DataSourceStreamReader):
    """Each batch is the slices that have ended since the one before; the offset is the first day not looked at."""

    def __init__(self, reader: SliceReader, start: str, as_of: str | None):
        self._reader, self._start, self._as_of = reader, start, as_of

    def initialOffset(self) -> dict:
        return {"before": self._start}

    def latestOffset(self) -> dict:
        today = dt.date.fromisoformat(self._as_of) if self._as_of else dt.date.today()
        ended = [values["slice_start"] for values in self._reader.slices if values["slice_end"] < today]
        return {"before": (max(ended) + dt.timedelta(1)).isoformat() if ended else self._start}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return [p for p in self._reader.partitions() if start["before"] <= p.value["slice_start"].isoformat() < end["before"]]

    def read(self, partition: InputPartition) -> Iterator:
        return self._reader.read(partition)


def slice_source(name: str, columns: T.StructType | str, fetch: Fetch) -> type[DataSource]:
    """Data source that calls ``fetch`` once per slice, in the tasks of a scan.

    Register it (``spark.dataSource.register``) and read it by ``spark.read.format(name)`` or
    ``spark.readStream.format(name)`` with the options of ``grid_slices``. Rows have the columns, ``slice_start``,
    ``slice_end`` and the categories as text. A task that is repeated calls ``fetch`` again, so it must give the same rows.
    The list of slices, bounded by the calendar and the categories, is all that the driver holds.

    ``pushdown`` = ``true`` lets filters on slice columns choose the slices; it needs
    ``spark.sql.python.filterPushdown.enabled``. A stream reads slices that ended before ``as_of`` (default: today);
    it takes no ``limit``, for which a later grid could stand for other slices.
    """
    declared = T.StructType.fromDDL(columns) if isinstance(columns, str) else columns

    class SliceSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> T.StructType:
            dates = [T.StructField(name, T.DateType()) for name in ("slice_start", "slice_end")]
            texts = [T.StructField(name, T.StringType()) for name in json.loads(self.options.get("categories", "{}"))]
            return T.StructType([*declared.fields, *dates, *texts])

        def reader(self, schema: T.StructType) -> DataSourceReader:
            pruned = self.options.get("pushdown", "false").lower() == "true"
            return (PrunedSliceReader if pruned else SliceReader)(schema, grid_slices(self._given()), fetch)

        def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
            options = self._given()
            if "limit" in options:
                raise ValueError("a stream of slices takes no limit")
            return SliceStreamReader(SliceReader(schema, grid_slices(options), fetch), options["start"], options.get("as_of"))

        def _given(self) -> dict[str, str]:
            known = ("start", "end", "step_days", "window_days", "categories", "only_from", "only_to", "limit", "as_of")
            return {option: self.options[option] for option in known if option in self.options}

    return SliceSource


def landed_folder(root: str, keys: Sequence[str]) -> Fetch:
    """Function for ``slice_source`` that reads the Parquet files landed below ``root`` in one folder per slice.

    ``keys`` are the slice columns in the order of the folders (``key=value``). A slice without a folder has no rows.
    Files are opened by pyarrow, so ``root`` is a path or a URI that it knows (local, ``hdfs``, ``s3``, ``gs``).
    """

    def fetch(values: dict) -> Iterator[dict]:
        from pyarrow import fs
        from pyarrow import parquet as pq

        store, base = fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)
        folder = "/".join([base.rstrip("/"), *[f"{key}={values[key]}" for key in keys]])
        for file in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            if file.path.endswith(".parquet"):
                with store.open_input_file(file.path) as opened:
                    for batch in pq.ParquetFile(opened).iter_batches(BATCH_ROWS):
                        yield from batch.to_pylist()

    return fetch
