from conftest import rows

from tideline.operators import quality
from tideline.plans import ingest
from tideline.sinks import keyed, plain
from tideline.sources.mapping import declared_types, map_columns


def test_null_is_no_duplicate_but_is_missing(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "c")], "k int, v string")
    assert rows(quality.duplicate_keys(frame, ["k"])) == [(1, 2)]
    assert quality.null_keys(frame, ["k"]).count() == 2
    clean = frame.where("k = 2")
    assert quality.duplicate_keys(clean, ["k"]).isEmpty() and quality.null_keys(clean, ["k"]).isEmpty()


def test_schema_report(spark):
    frame = spark.createDataFrame([(1, "a", 1.0), (2, None, 2.0)], "k int, v string, x double")
    got = {r.column_name: tuple(r)[1:] for r in quality.schema_report(frame, {"k": "int", "v": "int", "z": "string"}).collect()}
    assert got == {
        "k": ("ok", "int", "int", 2, 0),
        "v": ("mistyped", "int", "string", 2, 1),
        "z": ("missing", "string", None, 2, None),
        "x": ("extra", None, "double", 2, 0),
    }


def test_mapped_rows_conform_to_their_declaration(spark):
    paths = {spec.path for spec in ingest.PERMIT_COLUMNS if spec.path} | {"X_WEB_MERCATOR", "Y_WEB_MERCATOR"}
    raw = spark.createDataFrame([tuple("1" for _ in paths)], ", ".join(f"{p} string" for p in sorted(paths)))
    mapped = map_columns(raw, ingest.PERMIT_COLUMNS)
    report = quality.schema_report(mapped, declared_types(ingest.PERMIT_COLUMNS))
    assert {r.status for r in report.collect()} == {"ok"} and report.count() == 18
    wrong = quality.schema_report(raw, declared_types(ingest.LISTING_COLUMNS))
    assert {r.status for r in wrong.collect()} == {"missing", "extra"}


def test_key_report(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "d")], "k int, v string")
    assert rows(quality.key_report(frame, ["k"])) == [(6, 2, 1)]
    assert rows(quality.key_report(frame, ["k", "v"])) == [(6, 2, 1)]
    assert rows(quality.key_report(frame.limit(0), ["k"])) == [(0, 0, 0)]


def test_upsert_counts_while_it_writes(spark, tmp_path):
    frame = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (None, 1), (None, 2)], "k int, at int")
    seen, again, gone = {}, {}, {}
    path = str(tmp_path / "t")
    keyed.upsert(spark, path, frame, ["k"], ["at"], buckets=2, batch="a", report=seen)
    assert seen == {"n_rows": 5, "n_null_keys": 2, "n_stored": 3}
    keyed.upsert(spark, path, frame, ["k"], ["at"], buckets=2, batch="a", report=again)
    assert again == {}
    keyed.upsert(spark, path, frame.limit(0), ["k"], ["at"], buckets=2, batch="b", report=gone)
    assert gone == {"n_rows": 0, "n_null_keys": 0, "n_stored": 0}
    keyed.compact(spark, path)
    keyed.remove_covered(spark, path)
    keyed.upsert(spark, path, frame, ["k"], ["at"], buckets=2, batch="a", report=again)
    assert again == {} and keyed.read_keyed(spark, path).count() == 3


def test_counts_run_no_job_of_their_own(spark, tmp_path):
    frame = spark.range(100).selectExpr("cast(id % 10 as int) k", "id at")
    jobs = {}
    for name, report in (("plain", None), ("counted", {})):
        spark.sparkContext.setJobGroup(name, name)
        keyed.upsert(spark, str(tmp_path / name), frame, ["k"], ["at"], buckets=2, batch="a", report=report)
        jobs[name] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs["plain"] == jobs["counted"] > 0


def test_staged_slices_and_snapshots_count_too(spark, tmp_path):
    frame = spark.createDataFrame([("a", "d1", 1, "x", 1), ("a", "d1", 1, None, 2), ("b", "d1", None, "y", 1)],
                                  "stage string, slice string, k int, v string, at int")
    seen, snapshot = {}, {}
    keyed.staged_merge(spark, str(tmp_path / "s"), frame, "stage", "slice", ["k"], ["v"], ["at"], buckets=2, batch="a", report=seen)
    assert seen == {"n_rows": 3, "n_null_keys": 1, "n_stored": 2}
    plain.append_snapshot(frame, str(tmp_path / "p"), "2024-01-01", keys=["k"], report=snapshot)
    assert snapshot == {"n_rows": 3, "n_null_keys": 1}


def test_rejected_payloads_are_counted_by_the_ingest(spark, tmp_path):
    good = '{"daily": {"time": ["2024-01-01"], "temperature_2m_max": [1.0], "temperature_2m_min": [0.0], ' \
           '"precipitation_sum": [0.0], "windspeed_10m_max": [2.0]}}'
    payloads = spark.createDataFrame([("salem", good), (None, good), ("bend", "{broken"), ("bend", None)], "city string, payload string")
    seen = {}
    days = ingest.ingest_weather_payloads(payloads, str(tmp_path / "w"), seen, "2024-02-01", 2, "0")
    assert seen == {"n_payloads": 4, "n_rejected": 2, "n_rows": 2, "n_null_keys": 1, "n_stored": 2}
    assert sorted(r.city or "" for r in days.collect()) == ["", "salem"]
