from conftest import rows, ts

from tideline.sinks import keyed
from tideline.streaming import ingest

SCHEMA = "id string, v int, at timestamp_ntz"


def land(spark, folder, *items):
    spark.createDataFrame([(i, v, ts(at)) for i, v, at in items], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_runs_take_up_only_new_files_and_late_rows_compete(spark, tmp_path):
    landing, target, progress = (str(tmp_path / n) for n in ("landing", "target", "progress"))

    def run():
        stream = ingest.landed_stream(spark, landing, spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)
        ingest.ingest_upsert(stream, target, progress, ["id"], ["at"], buckets=2)
        return rows(keyed.read_keyed(spark, target).select("id", "v"), "id")

    land(spark, landing, ("a", 1, "2024-01-05"), ("b", 1, "2024-01-01"))
    land(spark, landing, ("b", 2, "2024-01-02"))
    assert run() == [("a", 1), ("b", 2)]
    assert run() == [("a", 1), ("b", 2)]
    land(spark, landing, ("c", 9, "2024-01-09"), ("a", 0, "2024-01-04"), ("b", 5, "2024-01-03"))
    assert run() == [("a", 1), ("b", 5), ("c", 9)]


def test_append_takes_every_row_once(spark, tmp_path):
    landing, target, progress = (str(tmp_path / n) for n in ("landing", "target", "progress"))
    schema = spark.createDataFrame([], SCHEMA).schema
    for number in range(2):
        land(spark, landing, (f"x{number}", number, "2024-01-01"))
        for _ in range(2):
            ingest.ingest_append(ingest.landed_stream(spark, landing, schema), target, progress, ["id"])
    assert rows(spark.read.parquet(target).select("id", "v"), "id") == [("x0", 0), ("x1", 1)]


def test_staged_merge_stream(spark, tmp_path):
    landing, staging, progress = (str(tmp_path / n) for n in ("landing", "staging", "progress"))
    schema = "stage string, slice int, k int, r string, i string, at int"

    def run(*items):
        spark.createDataFrame(items, schema).write.mode("append").parquet(landing)
        stream = ingest.landed_stream(spark, landing, spark.createDataFrame([], schema).schema)
        ingest.ingest_staged_merge(
            stream, staging, progress,
            stage="stage", slice_column="slice", keys=["k"], merge_columns=["r", "i"], order_by=["at", "slice", "stage"], buckets=2,
        )
        return rows(keyed.read_merged(spark, staging).select("k", "r", "i"), "k")

    assert run(("review", 1, 1, "r1", None, 1), ("review", 1, 2, "r2", None, 1)) == [(1, "r1", None), (2, "r2", None)]
    assert run(("issued", 2, 1, None, "i1", 2), ("review", 3, 2, None, None, 3)) == [(1, "r1", "i1"), (2, "r2", None)]


def test_two_feeds_and_a_new_progress_folder_lose_nothing(spark, tmp_path):
    target = str(tmp_path / "target")
    schema = spark.createDataFrame([], SCHEMA).schema
    for name in ("one", "two"):
        land(spark, str(tmp_path / name), (name, 1, "2024-01-01"))
    for feed, progress in (("one", "p1"), ("two", "p2"), ("one", "p3")):
        stream = ingest.landed_stream(spark, str(tmp_path / feed), schema)
        ingest.ingest_upsert(stream, target, str(tmp_path / progress), ["id"], ["at"], buckets=2)
    land(spark, str(tmp_path / "one"), ("three", 3, "2024-01-02"))
    ingest.ingest_upsert(ingest.landed_stream(spark, str(tmp_path / "one"), schema), target, str(tmp_path / "p3"), ["id"], ["at"], buckets=2)
    assert rows(keyed.read_keyed(spark, target).select("id", "v"), "id") == [("one", 1), ("three", 3), ("two", 1)]
