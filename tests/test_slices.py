import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tideline.operators import calendar
from tideline.sources import slices

CATEGORIES = {"kind": ["click", "view"]}
GRID = {"start": "2024-01-01", "end": "2024-01-10", "categories": json.dumps(CATEGORIES)}


@pytest.fixture(scope="module")
def source(spark):
    def numbered(values):  # two rows a slice; the second lacks a note
        day = values["slice_start"].day
        yield {"n": day, "note": values["kind"], "ignored": 1}
        yield {"n": day * 10}

    spark.dataSource.register(slices.slice_source("numbered", "n bigint, note string", numbered))
    return lambda **options: spark.read.format("numbered").options(**{**GRID, **options}).load()


@pytest.mark.parametrize(
    "only",
    [{}, {"only_from": "2024-01-04", "only_to": "2024-01-06"}, {"limit": 3}, {"step_days": 3, "window_days": 2}, {"only_from": "2025-01-01"}],
)
def test_slices_are_those_of_the_grid(spark, source, only):
    frame = source(**only)
    grid = calendar.slice_grid(spark, GRID["start"], GRID["end"], categories=CATEGORIES, **only)
    order = ["slice_start", "slice_end", "kind"]
    want = rows(grid.select(*order), *order)
    assert rows(frame.select(*order).distinct(), *order) == want
    assert frame.count() == 2 * len(want)
    if want:
        assert frame.rdd.getNumPartitions() == len(want)


def test_rows_carry_their_slice_and_the_declared_types(source):
    got = rows(source(only_from="2024-01-02", only_to="2024-01-02").drop("slice_end"), "kind", "n")
    second = dt.date(2024, 1, 2)
    assert got == [(2, "click", second, "click"), (20, None, second, "click"), (2, "view", second, "view"), (20, None, second, "view")]


def test_filters_choose_slices(spark, source):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        kept = (F.col("kind") == "view") & (F.col("slice_start") >= F.lit("2024-01-09").cast("date")) & (F.col("n") < 50)
        frame = source(pushdown="true").where(kept)
        assert frame.rdd.getNumPartitions() == 2
        assert rows(frame.select("n", "kind"), "n") == rows(source().where(kept).select("n", "kind"), "n") == [(9, "view"), (10, "view")]
        assert source(pushdown="true").where("kind = 'none'").count() == 0
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_stream_reads_each_ended_slice_once(spark, tmp_path, source):
    def run(as_of):
        stream = spark.readStream.format("numbered").options(**GRID, as_of=as_of).load()
        sink = stream.writeStream.option("checkpointLocation", str(tmp_path / "progress")).format("parquet")
        sink.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
        return spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))

    assert run("2024-01-04").agg(F.countDistinct("slice_start"), F.count("*")).first() == (3, 12)
    assert run("2024-01-04").count() == 12
    assert rows(run("2024-02-01"), "n", "kind") == rows(source(), "n", "kind")


def test_a_stream_takes_no_limit(spark):
    with pytest.raises(Exception, match="takes no limit"):
        stream = spark.readStream.format("numbered").options(**GRID, limit=2).load()
        stream.writeStream.format("noop").trigger(availableNow=True).start().awaitTermination()


def test_a_failing_call_fails_the_read(spark):
    def fails(values):
        raise ValueError(f"no answer for {values['slice_start']}")

    spark.dataSource.register(slices.slice_source("failing", "n bigint", fails))
    with pytest.raises(Exception, match="no answer for 2024-01-01"):
        spark.read.format("failing").options(start="2024-01-01", end="2024-01-01").load().collect()


def test_landed_folders(spark, tmp_path):
    root = str(tmp_path / "landed")
    landed = spark.range(30).selectExpr("id", "date_add(date'2024-01-01', cast(id % 3 as int)) slice_start", "if(id % 2 = 0, 'click', 'view') kind")
    landed.write.partitionBy("kind", "slice_start").parquet(root)
    for path in (root, f"file://{root}"):
        spark.dataSource.register(slices.slice_source("landed", "id bigint", slices.landed_folder(path, ["kind", "slice_start"])))
        got = spark.read.format("landed").options(**GRID).load().select("id", "slice_start", "kind")
        assert rows(got, "id") == rows(landed, "id")
