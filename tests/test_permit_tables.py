import datetime as dt
import random

import pytest
import verify
from conftest import day

from test_permits import RAW_COLUMNS, raw

from tideline.operators import calendar
from tideline.plans import permits
from tideline.plans.permit_tables import CATEGORIES, FRAME, PermitTables
from tideline.session import written
from tideline.sinks import keyed

START, WARMUP, REPORT, AS_OF = "2015-01-01", "2015-06-01", "2016-01-01", "2019-06-30"


def same(got, want):
    assert sorted(got.columns) == sorted(want.columns)
    assert verify.rows_of(got.columns, got.collect()) == verify.rows_of(want.columns, want.collect())


def full_refresh(spark, records, as_of):
    """All models from the latest record of each permit."""
    latest = {}
    for record in records:
        key = record["IVR_NUMBER"]
        if key not in latest or latest[key]["updated_at"] <= record["updated_at"]:
            latest[key] = record
    facts = written(permits.cleaned(permits.typed(raw(spark, *latest.values()))), "facts")
    days = calendar.calendar_days(spark, START, as_of)
    per_day = permits.by_date(facts, days, as_of)
    models = {"permits_cleaned": facts, "permits_by_date": per_day}
    models["rolling_permits_timeseries"] = permits.rolling_series(per_day, WARMUP, REPORT)
    for category in CATEGORIES:
        models[f"permits_by_date_and_{category}"] = permits.by_date_and(facts, days, category, as_of)
        models[f"rolling_permits_by_{category}"] = permits.rolling_by(models[f"permits_by_date_and_{category}"], category, WARMUP, REPORT)
    return models


def record(draw, key, load, types):
    def date(none=0.2):
        return None if draw.random() < none else str(dt.date(2015, 1, 1) + dt.timedelta(draw.randrange(1900)))

    mark = "-000-" if draw.random() < 0.85 else "-001-"
    return dict.fromkeys(RAW_COLUMNS) | {
        "IVR_NUMBER": str(key), "APPLICATION_NUMBER": f"2024-000001{mark}00-RS", "SET_UP": date(), "UNDER_REVIEW": date(),
        "ISSUED": date(), "FINAL": date(), "STATUS": draw.choice(["Issued", "Expired", None]), "TYPE": draw.choice(types),
        "WORK": draw.choice(["Addition", "Demolition", None]), "TOTAL_SQFT": str(draw.randrange(0, 900)), "NEW_UNITS": str(draw.randrange(3)),
        "FINAL_VALUATION": str(draw.randrange(1000)), "updated_at": f"2020-01-{load:02d}",
    }


def lost(*_):
    raise RuntimeError("lost")


def tables(spark, path):
    return PermitTables(spark, str(path), start=START, warmup_from=WARMUP, report_from=REPORT, buckets=3)


def test_batches_give_what_a_full_refresh_gives(spark, tmp_path, monkeypatch):
    draw, seen, stored = random.Random(8), [], tables(spark, tmp_path)
    kinds = ["Duplex", "Storage", "Assembly"]
    batches = [
        ([record(draw, k, 1, kinds) for k in range(60)], "2019-01-01"),
        # Later days to compute for, a new type, a late older record.
        ([record(draw, k, 3, [*kinds, "Hotel/Motel"]) for k in (5, 6, 7, 60, 61)] + [record(draw, 9, 0, kinds) | {"updated_at": "2019-12-01"}], AS_OF),
        ([record(draw, 8, 4, ["Duplex"]), record(draw, 62, 4, ["Duplex"])], AS_OF),
    ]
    for number, (batch, as_of) in enumerate(batches):
        seen = sorted([*seen, *batch], key=lambda r: r["updated_at"])
        for step in ("_daily", "_trailing") if number == 1 else ():  # the batch dies, and is repeated
            with monkeypatch.context() as patch:
                patch.setattr(PermitTables, step, lost)
                with pytest.raises(RuntimeError):
                    stored.apply(raw(spark, *batch), str(number), as_of)
        stored.apply(raw(spark, *batch), str(number), as_of)
    models = {name: written(df, name) for name, df in full_refresh(spark, seen, AS_OF).items()}
    for name, want in models.items():
        same(stored.read(name, AS_OF), want)
    # The last batch has written its touched days and no other.
    events = set()
    for key in ("8", "62"):
        versions = [r for r in seen if r["IVR_NUMBER"] == key][-2:]
        events |= {day(r[c]) for r in versions for c in ("ISSUED", "UNDER_REVIEW", "FINAL") if r[c]}
    table = keyed.read_keyed(spark, stored.path("permits_by_date"))
    assert table.count() == calendar.calendar_days(spark, START, AS_OF).count()
    last = spark.read.parquet(f"{stored.path('permits_by_date')}/batch=00000003-2")
    assert {r.day for r in last.select("day").collect()} <= events and last.count() <= 12
    trailing = spark.read.parquet(f"{stored.path('rolling_permits_timeseries')}/batch=00000003-2")
    assert 0 < trailing.count() <= 12 * FRAME
    # Neither a repeat nor a compaction changes anything.
    stored.apply(raw(spark, *batches[1][0]), "1", AS_OF)
    stored.compact()
    for name in ("permits_cleaned", "permits_by_date", "permits_by_date_and_work_type", "rolling_permits_by_function_type"):
        same(stored.read(name, AS_OF), models[name])
    assert stored.this_week("2017-01-01").columns == permits.this_week(models["permits_cleaned"], "2017-01-01").columns


def test_batches_leave_no_copies_of_records(spark, tmp_path, monkeypatch):
    scratch = tmp_path / "scratch"
    monkeypatch.setattr("tideline.session.shared_dir", lambda _: str(scratch))
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    draw, stored = random.Random(9), tables(spark, tmp_path / "t")
    wrote = []
    first, second = ([record(draw, k, load, ["Duplex"]) for k in range(low, 20)] for load, low in ((1, 0), (2, 17)))
    before = disk.getAllFiles().size()
    monkeypatch.setattr(PermitTables, "_trailing", lambda *_: wrote.append({p.name.rsplit("-", 1)[0] for p in scratch.iterdir()}))
    monkeypatch.setattr(PermitTables, "_daily", lambda *_: wrote.append(disk.getAllFiles().size() - before))
    stored.apply(raw(spark, *first), "0", AS_OF)
    stored.apply(raw(spark, *second), "1", AS_OF)
    assert [x for x in wrote if isinstance(x, set) and x & {"batch-keys", "batch-records", "cleaned"}] == []
    assert len(wrote) == 4 and all(x <= 0 for x in wrote if isinstance(x, int))
    latest = {r["IVR_NUMBER"]: r for r in [*first, *second]}
    same(stored.read("permits_cleaned"), permits.cleaned(permits.typed(raw(spark, *latest.values()))))
