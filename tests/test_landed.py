import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tideline.functions import geo
from tideline.plans import ingest
from tideline.sources import landed
from tideline.sources.mapping import ColumnSpec, map_columns


def payload(times, **arrays):
    n = len(times)
    names = [name for name in ingest.WEATHER_ARRAYS.values() if name != "time"]
    return json.dumps({"daily": {"time": times, **{name: arrays.get(name, [1.0] * n) for name in names}}})


def test_arrays_to_rows_and_rejects(spark):
    good = payload(["2024-01-01", "2024-01-02"], temperature_2m_max=[None, 5.5])
    short = payload(["2024-01-01", "2024-01-02"], temperature_2m_max=[1.0])
    longer = payload(["2024-01-03"], precipitation_sum=[2.0, 9.0])
    frame = spark.createDataFrame(
        [("salem", good), ("bend", short), ("eugene", longer), ("x", "{broken"), ("y", payload([]))],
        "city string, payload string",
    )
    got = rows(ingest.weather_rows(frame, strict=False), "id")
    assert got == [
        ("eugene_2024-01-03", "eugene", "2024-01-03", 1.0, 1.0, 2.0, 1.0),
        ("salem_2024-01-01", "salem", "2024-01-01", None, 1.0, 1.0, 1.0),
        ("salem_2024-01-02", "salem", "2024-01-02", 5.5, 1.0, 1.0, 1.0),
    ]
    assert {r.city for r in ingest.weather_rejects(frame).collect()} == {"bend", "x"}
    assert rows(ingest.weather_rows(frame.where("city not in ('bend', 'x')")), "id") == got
    for city in ("bend", "x"):
        with pytest.raises(Exception, match="line up: " + city):
            ingest.weather_rows(frame.where(F.col("city") == city)).collect()


def test_unknown_dimension_key_is_reported(spark):
    cities = spark.createDataFrame([("bend",), ("paris",)], "city string")
    dimension = ingest.city_dimension(spark)
    assert rows(landed.lookup(cities, dimension, "city")) == [("bend", 44.0582, -121.3153)]
    assert rows(landed.unmatched(cities, dimension, "city")) == [("paris",)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_join_without_a_shuffle_of_their_rows(spark, how):
    frame = spark.createDataFrame([(7, i) for i in range(300)] + [(i, i) for i in range(20)] + [(None, 1)], "k int, v int")
    dimension = spark.createDataFrame([(7, "hot"), (3, "three"), (99, "unused")], "k int, name string")
    got = landed.lookup_with_hot_keys(frame, dimension, "k", how, share=4)
    want = frame.join(dimension, "k", how)
    assert sorted(rows(got), key=repr) == sorted(rows(want), key=repr)
    assert got.where("name = 'hot'").count() == 301


def test_weather_requests_resolve_today(spark):
    cities = spark.createDataFrame([("bend",)], "city string")
    out = ingest.weather_requests(spark, cities, as_of="2024-03-01").first()
    assert (out.start_date, out.end_date, out.lat) == ("2024-01-01", "2024-03-01", 44.0582)
    cities = spark.createDataFrame([("bend",), ("paris",)], "city string")
    assert ingest.weather_requests(spark, cities, as_of="2024-03-01", strict=False).count() == 1
    with pytest.raises(Exception, match="unknown city: paris"):
        ingest.weather_requests(spark, cities, as_of="2024-03-01").collect()


def test_large_integers_keep_their_digits(spark):
    frame = spark.createDataFrame([("3000000000",), ("9007199254740993",), ("4021.0",), ("2.5",), ("x",), (None,)], "a string")
    got = [r[0] for r in frame.select(ColumnSpec("a", "integer").column()).collect()]
    assert got == [3000000000, 9007199254740993, 4021, 2, None, None]


def test_latest_copy_of_a_detail_page_counts(spark):
    cards = spark.createDataFrame([("bend", '<li class="cl-static-search-result"><a href="u"></a></li>')], "region string, html string")
    page = '<section id="postingbody">{}</section>'
    copies = spark.createDataFrame([("u", page.format("zzz"), 1), ("u", page.format("new"), 2)], "url string, html string, at int")
    [row] = ingest.listing_rows(cards, copies, landed_at="at").collect()
    assert row.post_description == "new"
    assert ingest.listing_rows(cards, copies).count() == 1


def test_csv_headers_are_checked_and_line_breaks_kept(spark, tmp_path):
    folder = tmp_path / "date_type=issued" / "slice_date=2024-01-01"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text('A,B\n1,"two\nlines ""quoted"""\n,nan\n')
    out = landed.read_csv_text(spark, str(tmp_path), ["A", "B"], ["date_type", "slice_date"])
    assert rows(out, F.asc_nulls_last("A")) == [
        ("1", 'two\nlines "quoted"', "issued", "2024-01-01"),
        (None, "nan", "issued", "2024-01-01"),
    ]
    assert rows(landed.missing_columns(spark, str(tmp_path), ["A", "B"])) == []
    with pytest.raises(Exception, match="(?i)header"):
        landed.read_csv_text(spark, str(tmp_path), ["B", "A"], ["date_type", "slice_date"], by_name=False).collect()


def test_csv_columns_are_found_by_name_in_each_file(spark, tmp_path):
    files = {
        "01": "A,B\n1,2\n",
        "02": 'more,"B",A,A\nx,"two\nlines",3,again\n',
        "03": "B\r\n5\r\n",
        "04": "",
        "05": "A,B\n",
    }
    for day_, text in files.items():
        folder = tmp_path / f"slice_date={day_}"
        folder.mkdir()
        (folder / "a.csv").write_bytes(text.encode())
    out = landed.read_csv_text(spark, str(tmp_path), ["A", "B"], ["slice_date"])
    assert out.columns == ["A", "B", "slice_date"]
    assert rows(out, "slice_date") == [("1", "2", "01"), ("3", "two\nlines", "02"), (None, "5", "03")]
    [(file, missing)] = rows(landed.missing_columns(spark, str(tmp_path), ["A", "B"]))
    assert file.endswith("slice_date=03/a.csv") and missing == ["A"]


def test_hot_keys_of_a_dimension_with_many_rows_are_not_broadcast(spark):
    frame = spark.createDataFrame([(7, i) for i in range(50)], "k int, v int")
    dimension = spark.createDataFrame([(7, str(i)) for i in range(9)], "k int, name string")
    assert landed.lookup_with_hot_keys(frame, dimension, "k", share=4).count() == 450


def test_column_mapping_types_paths_and_derived(spark):
    frame = spark.createDataFrame([("4021.0", "nan", "nan", ("x",), "01/05/2024")], "a string, b string, c string, d struct<e: string>, f string")
    specs = [
        ColumnSpec("key", "integer", "a"),
        ColumnSpec("number", "float", "b"),
        ColumnSpec("text", "string", "c"),
        ColumnSpec("nested", "string", "d.e"),
        ColumnSpec("day", "date", "f", format="MM/dd/yyyy"),
        ColumnSpec("twice", derive=lambda: F.concat("a", "a")),
    ]
    got = map_columns(frame, specs).first()
    assert (got.key, got.number, got.text, got.nested, str(got.day), got.twice) == (
        4021, None, None, "x", "2024-01-05", "4021.04021.0",
    )
    with pytest.raises(ValueError):
        ColumnSpec("z", "blob", "a").column()


def test_projection_and_points(spark):
    frame = spark.createDataFrame([(-13655000.0, 5703000.0), (0.0, 0.0), (None, 1.0)], "x double, y double")
    lon, lat = geo.mercator_lon(F.col("x")), geo.mercator_lat(F.col("y"))
    got = frame.select(F.round(lon, 5), F.round(lat, 5), geo.point(lon, lat).isNull()).collect()
    assert tuple(got[0]) == (-122.66495, 45.51522, False)
    assert abs(got[1][1]) < 1e-9 and got[2][2] is True


def test_permit_slices(spark):
    out = ingest.permit_slices(spark, as_of="2020-02-01", only_from="2020-01-30")
    assert out.count() == 9
    assert out.where("date_from = '01/30/2020' and date_to = '01/30/2020' and date_type = 'final'").count() == 1
