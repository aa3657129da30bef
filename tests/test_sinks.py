import random
from pathlib import Path

import pytest
from conftest import day, rows, ts
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tideline.plans import ingest
from tideline.session import shared_dir, written
from tideline.sinks import keyed, plain
from tideline.sources import landed

SCHEMA = "id string, v int, loaded_at timestamp_ntz"


def batch(spark, *items):
    return spark.createDataFrame([(i, v, ts(at)) for i, v, at in items], SCHEMA)


def state(spark, path):
    return sorted(rows(keyed.read_keyed(spark, path).select("id", "v")), key=repr)


def test_upsert_replaces_adds_and_keeps(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.upsert(spark, path, batch(spark, ("a", 1, "2024-01-01"), ("b", 2, "2024-01-01"), (None, 7, "2024-01-01")), ["id"], ["loaded_at"])
    second = batch(spark, ("b", 3, "2024-01-02"), ("b", 4, "2024-01-03"), ("c", 5, "2024-01-02"), (None, 8, "2024-01-02"))
    keyed.upsert(spark, path, second, ["id"], ["loaded_at"])
    want = sorted([("a", 1), ("b", 4), ("c", 5), (None, 8)], key=repr)
    assert state(spark, path) == want
    keyed.upsert(spark, path, second, ["id"], ["loaded_at"])
    assert state(spark, path) == want


def test_many_keys_survive_many_batches(spark, tmp_path):
    path, rng, want = str(tmp_path / "t"), random.Random(5), {}
    for number in range(4):
        items = {f"k{rng.randrange(60)}": number * 1000 + i for i in range(40)}
        want |= items
        keyed.upsert(
            spark, path, batch(spark, *[(k, v, f"2024-01-0{number + 1}") for k, v in items.items()]), ["id"], ["loaded_at"], buckets=5
        )
    assert dict(state(spark, path)) == want


def test_a_late_older_row_does_not_replace_a_newer_one(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.upsert(spark, path, batch(spark, ("a", 5, "2024-01-05"), ("b", 5, "2024-01-05")), ["id"], ["loaded_at"])
    keyed.upsert(spark, path, batch(spark, ("a", 4, "2024-01-04"), ("b", 1, "2024-01-05")), ["id"], ["loaded_at"])
    assert state(spark, path) == [("a", 5), ("b", 1)]


def test_a_batch_with_other_columns_fails_and_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.upsert(spark, path, batch(spark, ("a", 1, "2024-01-01")), ["id"], ["loaded_at"], buckets=1)
    with pytest.raises(AnalysisException):
        wider = batch(spark, ("a", 2, "2024-01-02")).withColumn("extra", F.lit("x"))
        keyed.upsert(spark, path, wider, ["id"], ["loaded_at"], buckets=1)
    assert state(spark, path) == [("a", 1)]


def lost(*_):
    raise RuntimeError("lost")


def half_written(df, folder, layout):
    """What a job leaves that dies before its success marker."""
    df.limit(1).write.parquet(folder)
    next(iter(Path(folder).glob("_SUCCESS"))).unlink()
    lost()


@pytest.mark.parametrize("dies", [lost, half_written])
def test_failed_batch_leaves_the_table_and_can_be_repeated(spark, tmp_path, monkeypatch, dies):
    path = str(tmp_path / "t")
    keyed.upsert(spark, path, batch(spark, ("a", 1, "2024-01-01")), ["id"], ["loaded_at"], batch="1")
    second = batch(spark, ("a", 2, "2024-01-02"), ("b", 3, "2024-01-02"))
    with monkeypatch.context() as patch:
        patch.setattr(keyed, "_write", dies)
        with pytest.raises(RuntimeError):
            keyed.upsert(spark, path, second, ["id"], ["loaded_at"], batch="2")
    assert state(spark, path) == [("a", 1)]
    keyed.upsert(spark, path, second, ["id"], ["loaded_at"], batch="2")
    assert state(spark, path) == [("a", 2), ("b", 3)]


def data_files(path):
    return {f: f.stat().st_size for f in Path(path).rglob("*.parquet")}


def test_a_batch_writes_its_own_rows_only(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.upsert(spark, path, batch(spark, *[(f"k{i}", i, "2024-01-01") for i in range(5000)]), ["id"], ["loaded_at"], buckets=10)
    first = data_files(path)
    keyed.compact(spark, path)
    spread = [(f"k{i}", -i, "2024-01-02") for i in range(0, 5000, 100)]
    keyed.upsert(spark, path, batch(spark, *spread), ["id"], ["loaded_at"], buckets=10)
    second = data_files(path)
    assert first.items() <= second.items()
    assert sum(second.values()) - sum(first.values()) < sum(first.values()) / 5
    assert dict(state(spark, path)) == {f"k{i}": -i if i % 100 == 0 else i for i in range(5000)}


def test_compaction_changes_no_row(spark, tmp_path, monkeypatch):
    path, rng = str(tmp_path / "t"), random.Random(7)

    def append(number):
        items = [(rng.choice([f"k{rng.randrange(40)}", None]), number * 100 + i, f"2024-01-{rng.randrange(1, 29):02d}") for i in range(30)]
        keyed.upsert(spark, path, batch(spark, *items), ["id"], ["loaded_at"], buckets=5, batch=str(number))

    for number in range(3):
        append(number)
    before = state(spark, path)
    for dies in (lost, half_written):
        with monkeypatch.context() as patch:
            patch.setattr(keyed, "_write", dies)
            with pytest.raises(RuntimeError):
                keyed.compact(spark, path)
        assert state(spark, path) == before
    with monkeypatch.context() as patch:  # rows are written, the list of what they cover is not
        patch.setattr(keyed, "_record", lost)
        with pytest.raises(RuntimeError):
            keyed.compact(spark, path)
    assert state(spark, path) == before and keyed.remove_covered(spark, path) == []
    assert len(keyed.compact(spark, path)) == 4
    assert state(spark, path) == before
    assert len(keyed.remove_covered(spark, path)) == 4
    assert state(spark, path) == before and keyed.compact(spark, path) == []
    keyed.upsert(spark, path, batch(spark, ("k0", -1, "2020-01-01")), ["id"], ["loaded_at"], buckets=5, batch="1")  # came before
    assert state(spark, path) == before
    append(3)
    after = state(spark, path)
    assert after != before
    keyed.compact(spark, path)
    assert state(spark, path) == after


def test_rows_that_tie_follow_the_order_of_batches(spark, tmp_path):
    path, at = str(tmp_path / "t"), "2024-01-01"
    for value in (5, 9, 1):
        keyed.upsert(spark, path, batch(spark, ("a", value, at)), ["id"], ["loaded_at"])
        keyed.compact(spark, path)
        assert state(spark, path) == [("a", value)]


def test_a_table_keeps_its_declaration(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.upsert(spark, path, batch(spark, ("a", 1, "2024-01-01")), ["id"], ["loaded_at"])
    with pytest.raises(ValueError, match="keys"):
        keyed.upsert(spark, path, batch(spark, ("a", 1, "2024-01-01")), ["v"], ["loaded_at"])
    with pytest.raises(ValueError, match="cannot name"):
        keyed.upsert(spark, path, batch(spark, ("a", 1, "2024-01-01")), ["id"], ["loaded_at"], batch="a/b")
    text = spark.createDataFrame([("01", 1, 1), ("1", 2, 1)], "part string, k int, at int")
    keyed.upsert(spark, str(tmp_path / "p"), text, ["part", "k"], ["at"], partitions=["part"])
    assert rows(keyed.read_keyed(spark, str(tmp_path / "p")).select("part", "k"), "k") == [("01", 1), ("1", 2)]
    keyed.upsert(spark, str(tmp_path / "p"), text.where("k = 1"), ["part", "k"], ["at"], partitions=["part"])
    keyed.compact(spark, str(tmp_path / "p"))
    assert rows(keyed.read_keyed(spark, str(tmp_path / "p")).select("part", "k"), "k") == [("01", 1), ("1", 2)]


def slices(spark):
    data = [
        ("review", "2024-01-01", 1, "2024-01-01", None, "2024-01-10"),
        ("issued", "2024-01-04", 1, None, "2024-01-04", "2024-01-11"),
        ("review", "2024-01-02", 2, "2024-01-02", None, "2024-01-10"),
        ("review", "2024-01-06", 1, None, None, "2024-01-12"),
        ("issued", "2024-01-07", 3, None, "2024-01-07", "2024-01-12"),
        ("review", "2024-01-01", 1, "2024-01-01", None, "2024-01-10"),
    ]
    return [
        spark.createDataFrame(
            [(s, day(d), k, day(r), day(i), ts(at))],
            "stage string, slice_date date, k int, review date, issued date, loaded_at timestamp_ntz",
        )
        for s, d, k, r, i, at in data
    ]


@pytest.mark.parametrize("seed", [0, 1])
def test_staged_merge_does_not_depend_on_arrival(spark, tmp_path, seed):
    parts = slices(spark)
    random.Random(seed).shuffle(parts)
    groups = [parts[:2], parts[2:5], parts[5:]]
    for group in groups:
        frame = group[0]
        for other in group[1:]:
            frame = frame.unionByName(other)
        keyed.staged_merge(
            spark, str(tmp_path / "staging"), frame, "stage", "slice_date", ["k"],
            ["review", "issued"], ["loaded_at", "slice_date", "stage"], buckets=3,
        )
        keyed.compact(spark, str(tmp_path / "staging"))
    got = rows(keyed.read_merged(spark, str(tmp_path / "staging")).select("k", "review", "issued"), "k")
    assert got == [
        (1, day("2024-01-01"), day("2024-01-04")),
        (2, day("2024-01-02"), None),
        (3, None, day("2024-01-07")),
    ]


def test_permit_ingest_from_csv(spark, tmp_path):
    header = ",".join([s.path for s in ingest.PERMIT_COLUMNS if s.path] + ["X_WEB_MERCATOR", "Y_WEB_MERCATOR"])

    def land(stage, slice_date, *lines):
        folder = tmp_path / "landing" / f"date_type={stage}" / f"slice_date={slice_date}"
        folder.mkdir(parents=True)
        (folder / "part.csv").write_text("\n".join([header, *lines]) + "\n")

    def line(key, review="", issued="", final="", sqft="nan"):
        return f'{key},app{key},"1 Main, St",Hood,West,,desc,nan,10,nan,{sqft},2,0,{review},{issued},{final},-13655000,5703000'

    land("review", "2024-01-01", line(1, review="2024-01-01"), line(2, review="2024-01-01"))
    land("issued", "2024-01-05", line(1, issued="2024-01-05", sqft="900"))
    land("final", "2024-01-09", line(1, final="2024-01-09", review="nan"))
    merged = ingest.ingest_permits(
        ingest.permit_rows(spark, str(tmp_path / "landing")), str(tmp_path / "s"), "2024-02-01"
    )
    got = rows(merged.select("ivr_number", "under_review", "issued", "final", "address", "work", F.round("lat", 5)), "ivr_number")
    assert got == [
        ("1", "2024-01-01", "2024-01-05", "2024-01-09", "1 Main, St", None, 45.51522),
        ("2", "2024-01-01", None, None, "1 Main, St", None, 45.51522),
    ]


def test_snapshots_accumulate(spark, tmp_path):
    path = str(tmp_path / "s")
    frame = spark.createDataFrame([(1,), (2,)], "x int")
    plain.append_snapshot(frame, path, "2024-01-01")
    plain.append_snapshot(frame.where("x = 1"), path, "2024-01-02")
    assert rows(spark.read.parquet(path).groupBy("snapshot_date").count(), "snapshot_date") == [
        (day("2024-01-01"), 2), (day("2024-01-02"), 1),
    ]


def test_staging_replaces_only_present_parameters(spark, tmp_path):
    path = str(tmp_path / "s")
    plain.stage_by(spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string"), path, "p")
    plain.stage_by(spark.createDataFrame([(3, "b")], "x int, p string"), path, "p")
    assert rows(spark.read.parquet(path), "p") == [(1, "a"), (3, "b")]
    plain.stage_by(spark.createDataFrame([(4, "01"), (5, "1.50"), (6, None)], "x int, p string"), path, "p")
    assert rows(landed.read_table(spark, path), "x") == [(1, "a"), (3, "b"), (4, "01"), (5, "1.50"), (6, None)]


def test_written_table_and_shared_folder(spark):
    frame = spark.createDataFrame([(1, "a")], "x int, y string")
    assert rows(written(frame, "test")) == [(1, "a")]
    assert shared_dir(spark)
    assert rows(spark.createDataFrame([(1.5,), (None,)], "x double").select(plain.stored_text(F.col("x")))) == [("1.5",), ("nan",)]


def test_repeating_an_old_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    for number in (0, 1, 2):
        keyed.upsert(spark, path, batch(spark, ("a", number, f"2024-01-0{number + 1}")), ["id"], ["loaded_at"], batch=str(number))
    keyed.upsert(spark, path, batch(spark, ("a", 1, "2024-01-02")), ["id"], ["loaded_at"], batch="1")
    assert rows(keyed.read_keyed(spark, path).select("id", "v")) == [("a", 2)]
    with pytest.raises(ValueError, match="other rows"):
        keyed.upsert(spark, path, batch(spark, ("new", 9, "2024-02-01")), ["id"], ["loaded_at"], batch="2")


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path, capsys):
    left = spark.range(1000).selectExpr("id % 100 as k", "id as v")
    right = spark.range(100).selectExpr("id as k", "id * 2 as w")
    a = plain.save_bucketed(left, "bucketed_left", ["k"], 4, str(tmp_path / "left"))
    b = plain.save_bucketed(right, "bucketed_right", ["k"], 4, str(tmp_path / "right"))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        joined = landed.read_table(spark, "bucketed_left").join(b, "k").groupBy("k").agg(F.sum("v").alias("v"), F.max("w").alias("w"))
        joined.explain()
        plan = capsys.readouterr().out
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert rows(joined, "k")[7] == (7, sum(range(7, 1000, 100)), 14) and a.count() == 1000
    finally:
        spark.conf.set(threshold, before)
        for name in ("bucketed_left", "bucketed_right"):
            spark.sql(f"DROP TABLE {name}")


def test_number_of_buckets_follows_the_rows(spark):
    assert [plain.buckets_for(spark.range(n), rows=10) for n in (0, 1, 10, 11, 20, 21, 79)] == [1, 1, 1, 2, 2, 4, 8]


def test_staged_rows_are_sorted_by_their_own_key_first(spark, tmp_path, monkeypatch):
    asked = []
    real = keyed.latest_per_key
    monkeypatch.setattr(keyed, "latest_per_key", lambda rows, keys, order_by: asked.append(keys) or real(rows, keys, order_by))
    staged = spark.createDataFrame([("s", "d", "a", 1), ("s", "d", "a", 2)], "stage string, day string, id string, at int")
    keyed.staged_merge(spark, str(tmp_path / "t"), staged, "stage", "day", ["id"], [], ["at"])
    assert asked == [["id", "stage", "day"]]
    assert rows(keyed.read_merged(spark, str(tmp_path / "t")).select("id", "at")) == [("a", 2)]


def test_rows_of_some_keys_are_read_and_unique_rows_are_stored_as_they_are(spark, tmp_path, monkeypatch):
    path, wanted = str(tmp_path / "t"), spark.createDataFrame([("a",), ("c",)], "id string")
    monkeypatch.setattr(keyed, "latest_per_key", lambda *_: pytest.fail("rows that are one per key were ranked"))
    keyed.upsert(spark, path, batch(spark, ("a", 1, "2024-01-01"), ("b", 2, "2024-01-01")), ["id"], ["loaded_at"], unique=True)
    assert rows(keyed.read_keyed(spark, path, wanted).select("id", "v")) == [("a", 1)]
    keyed.upsert(spark, path, batch(spark, ("a", 3, "2024-01-02"), ("c", 4, "2024-01-01")), ["id"], ["loaded_at"], unique=True)
    assert sorted(rows(keyed.read_keyed(spark, path, wanted).select("id", "v"))) == [("a", 3), ("c", 4)]
    keyed.compact(spark, path)
    keyed.upsert(spark, path, batch(spark, ("a", 0, "2023-01-01"), ("b", 5, "2024-01-02")), ["id"], ["loaded_at"], unique=True)
    assert sorted(rows(keyed.read_keyed(spark, path, wanted).select("id", "v"))) == [("a", 3), ("c", 4)]


def test_writes_leave_no_shuffle_files_and_stages_are_written_without_another_shuffle(spark, tmp_path, monkeypatch):
    store = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    monkeypatch.setattr("tideline.session.shared_dir", lambda _: str(tmp_path / "scratch"))
    monkeypatch.setattr("pyspark.sql.DataFrame.hint", lambda *_: pytest.fail("rows that are shuffled already were rebalanced"))
    staged = spark.createDataFrame([(s, "d", str(i % 50), i) for i in range(100) for s in "ab"], "stage string, day string, id string, at int")
    before = store.getAllFiles().size()
    counted = written(staged.groupBy("id").agg(F.max("at").alias("at")), "counted")
    keyed.staged_merge(spark, str(tmp_path / "t"), staged, "stage", "day", ["id"], [], ["at"])
    assert store.getAllFiles().size() <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert sorted(rows(keyed.read_merged(spark, str(tmp_path / "t")).select("id", "at"))) == sorted(rows(counted))
    assert {p.name for p in (tmp_path / "t").glob("batch=*/stage=*")} == {"stage=a", "stage=b"}


def test_rows_of_other_keys_are_sorted_out_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    for at in ("2024-01-01", "2024-01-02"):
        keyed.upsert(spark, path, batch(spark, *[(str(i) if i else None, i, at) for i in range(100)]), ["id"], ["loaded_at"])
    read = keyed.read_keyed(spark, path, spark.createDataFrame([("7",), ("x",), (None,)], "id string"))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" in plan and rows(read.select("id", "v")) == [("7", 7)]
    # Keys of another type match as a join matches them.
    other = keyed.read_keyed(spark, path, spark.createDataFrame([(7,)], "id int"))
    assert rows(other.select("id", "v")) == [("7", 7)]
