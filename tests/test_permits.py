from conftest import day, rows, ts
from pyspark.sql import functions as F

from tideline.operators import calendar, quality
from tideline.plans import permits
from tideline.session import written

RAW_COLUMNS = [
    "IVR_NUMBER", "APPLICATION_NUMBER", "STATUS", "TYPE", "DESCRIPTION", "WORK", "ADDRESS", "SET_UP", "UNDER_REVIEW",
    "ISSUED", "FINAL", "NEIGHBORHOOD", "NEIGHBORHOOD_DISTRICT", "BUSINESS_ASSOCIATION", "OCCUPANCY_GROUP",
    "CONSTRUCTION_TYPE", "SUBMITTED_VALUATION", "FINAL_VALUATION", "NEW_UNITS", "TOTAL_SQFT", "STORIES", "customer",
    "lon", "lat", "updated_at",
]


def raw(spark, *records):
    base = dict.fromkeys(RAW_COLUMNS) | {"APPLICATION_NUMBER": "2024-000001-000-00-RS", "customer": "7.0"}
    data = [tuple((base | record)[name] for name in RAW_COLUMNS) for record in records]
    return spark.createDataFrame(data, ", ".join(f"{name} string" for name in RAW_COLUMNS))


def test_typed(spark):
    record = {
        "IVR_NUMBER": "4021.0", "WORK": "nan", "SET_UP": "2024-01-02", "ISSUED": "2024-01-05 10:11", "FINAL": "nan",
        "SUBMITTED_VALUATION": "nan", "FINAL_VALUATION": "12.5", "TOTAL_SQFT": "nan", "lon": "-122.5", "lat": "nan",
        "updated_at": "2024-02-01T01:02:03",
    }
    out = permits.typed(raw(spark, record)).first()
    assert (out.ivr_number, out.work, out.customer) == (4021, None, 7)
    assert (out.set_up_at, out.issued_at, out.final_at) == (ts("2024-01-02"), ts("2024-01-05 10:11"), None)
    assert (out.submitted_valuation_amt, out.final_valuation_amt, out.total_sqft_amt) == (None, 12.5, None)
    assert (out.has_square_footage, out.longitude, out.latitude, out.location) == (False, -122.5, None, None)
    assert out.updated_at == ts("2024-02-01 01:02:03")
    literal = permits.typed(raw(spark, record), nan_is_area=True).first()
    assert literal.has_square_footage is True


def cleaned(spark, *records):
    return permits.cleaned(permits.typed(raw(spark, *records)))


def test_cleaned_keeps_primary_records_with_the_earliest_later_date(spark):
    out = cleaned(
        spark,
        {"IVR_NUMBER": "1", "ISSUED": "2024-01-09", "UNDER_REVIEW": "2024-01-01", "DESCRIPTION": "late"},
        {"IVR_NUMBER": "1", "ISSUED": "2024-01-03", "UNDER_REVIEW": "2024-01-05", "DESCRIPTION": "early"},
        {"IVR_NUMBER": "1", "DESCRIPTION": "dateless"},
        {"IVR_NUMBER": "2", "APPLICATION_NUMBER": "2024-000001-001-00-RS"},
        {"IVR_NUMBER": "nan", "DESCRIPTION": "a"},
        {"IVR_NUMBER": "x", "DESCRIPTION": "b"},
    )
    assert rows(out.select("ivr_number", "description"), F.asc_nulls_last("ivr_number")) == [(1, "early"), (None, "a")]
    assert quality.duplicate_keys(out, ["ivr_number"]).isEmpty()


def test_cleaned_derived_columns(spark):
    out = cleaned(
        spark,
        {
            "IVR_NUMBER": "1", "SET_UP": "2024-01-10", "ISSUED": "2024-01-03 23:00", "FINAL": "2024-02-01", "WORK": "Addition",
            "SUBMITTED_VALUATION": "100", "TOTAL_SQFT": "0", "STORIES": "0", "TYPE": "Duplex", "OCCUPANCY_GROUP": "R-3",
        },
    ).first()
    assert (out.days_to_issue, out.days_to_final) == (-7, 29)
    assert out.last_status_update_at == ts("2024-02-01")
    assert (out.value, out.dollars_per_sf, out.sf_per_story, out.work_type) == (100.0, None, None, "Addition/Alteration")
    assert (out.structure_type, out.function_type) == ("Rowhouse, Townhouse, Duplex", "Residential")


def facts(spark):
    return cleaned(
        spark,
        {"IVR_NUMBER": "1", "SET_UP": "2024-01-01", "UNDER_REVIEW": "2024-01-02", "ISSUED": "2024-01-04", "STATUS": "Issued",
         "TOTAL_SQFT": "500", "NEW_UNITS": "2", "FINAL_VALUATION": "10", "TYPE": "Duplex"},
        {"IVR_NUMBER": "2", "SET_UP": "2024-01-01", "UNDER_REVIEW": "2024-01-02", "STATUS": "Expired", "TOTAL_SQFT": "300", "TYPE": "Duplex"},
        {"IVR_NUMBER": "3", "SET_UP": "2024-01-01", "UNDER_REVIEW": "2024-01-02", "TOTAL_SQFT": "300", "NEW_UNITS": "1", "TYPE": "Storage"},
        {"IVR_NUMBER": "4", "ISSUED": "2024-01-04", "UNDER_REVIEW": "2024-01-04", "SET_UP": "2024-01-04", "STATUS": "Issued",
         "TOTAL_SQFT": "100", "NEW_UNITS": "0", "TYPE": "Storage"},
    )


def spine(spark):
    return calendar.calendar_days(spark, "2024-01-01", "2024-01-05", years_ahead=0)


def test_by_date(spark):
    got = {r.date: r for r in permits.by_date(facts(spark), spine(spark), "2024-01-10").collect()}
    assert len(got) == 5
    issue = got[day("2024-01-04")]
    assert (issue.count_permits_issued, issue.total_sqft_issued_amt, issue.final_valuation_issued_amount) == (2, 600.0, 1)
    assert (issue.avg_days_to_issue, issue.days_to_issue_sqft, issue.days_to_issue_new_units) == (1.5, 3 / 600, 1.5)
    # Issued on the day it entered review: not waiting that day, so the sum has no rows.
    assert (issue.count_permits_review, issue.total_sqft_waiting_approval) == (1, None)
    review = got[day("2024-01-02")]
    assert (review.total_sqft_review_amt, review.total_sqft_waiting_approval) == (1100.0, 500.0)
    empty = got[day("2024-01-01")]
    assert (empty.count_permits_issued, empty.total_sqft_issued_amt, empty.total_sqft_review_amt) == (0, None, 0.0)
    assert (empty.count_permits_final, empty.days_to_issue_sqft) == (0, None)
    assert len(empty) == 22


def test_by_category_drops_small_areas_and_leaves_review_dates_null(spark):
    out = permits.by_date_and(facts(spark), spine(spark), "structure_type", "2024-01-10")
    assert len(out.columns) == 17
    issued = out.where("date = '2024-01-04' and count_permits_issued > 0").collect()
    assert [(r.structure_type, r.total_sqft_issued_amt) for r in issued] == [("Rowhouse, Townhouse, Duplex", 500.0)]
    reviews = rows(out.where("count_permits_review > 0").select("date", "structure_type", "count_permits_review"), "structure_type")
    assert reviews == [(None, "Rowhouse, Townhouse, Duplex", 2), (None, "Storage", 1)]
    dated = permits.by_date_and(facts(spark), spine(spark), "structure_type", "2024-01-10", coalesce_date=True)
    assert dated.where("date is null").isEmpty()


def test_all_categories_come_from_one_scan(spark, tmp_path, capsys):
    facts(spark).write.parquet(str(tmp_path / "facts"))
    stored = spark.read.parquet(str(tmp_path / "facts"))
    categories = ["function_type", "structure_type", "work_type"]
    days = permits.category_days(stored, categories, "2024-01-10")
    days.explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert "address" not in plan.split("ReadSchema")[1]
    kept = written(days, "days")
    for category in categories:
        one = permits.by_date_and(stored, spine(spark), category, "2024-01-10")
        order = [F.asc_nulls_last(c) for c in ("date", category, "count_permits_review")]
        assert rows(permits.by_category(kept, spine(spark), category), *order) == rows(one, *order)
    # A null category is a group of its own, apart from the nulls of other grouping sets.
    of_null = kept.where("kind = 'work_type' and stage = 'review' and value is null")
    assert rows(of_null.select("date", "count_permits_review")) == [(day("2024-01-02"), 3)]


def test_this_week_is_eight_days_newest_and_largest_first(spark):
    records = [
        {"IVR_NUMBER": str(i), "ISSUED": f"2024-01-{d:02d}", "TOTAL_SQFT": sqft, "DESCRIPTION": f"p{i}"}
        for i, (d, sqft) in enumerate([(1, "10"), (2, "10"), (9, "10"), (9, "30"), (10, "10"), (9, "0"), (9, "nan")])
    ]
    out = permits.this_week(cleaned(spark, *records), "2024-01-09")
    assert [r.Description for r in out.collect()] == ["p3", "p2", "p1"]


def test_reports_over_string_tables(spark):
    loaded = spark.createDataFrame(
        [("a", "10", "2024-01-01"), ("a", "20", "nan"), ("b", "nan", "2024-01-01"), ("c", "5", None), (None, "1", "x")],
        "neighborhood string, submitted_valuation string, issued string",
    )
    assert rows(permits.top_neighborhoods(loaded, 2)) == [("a", 2, 15.0), ("c", 1, 5.0)]
    assert rows(permits.issued_by_neighborhood(loaded)) == [("a", 1), ("b", 1), (None, 1)]
