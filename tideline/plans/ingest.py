"""Ingest jobs: landed permit CSV, listing pages and weather payloads to stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions import geo
from tideline.functions import typing as ty
from tideline.functions.dates import AsOf
from tideline.operators import calendar, quality
from tideline.operators.report import median_summary
from tideline.operators.dedup import latest_per_key
from tideline.sinks import keyed, plain
from tideline.sources import html, landed
from tideline.sources.csv_blocks import read_csv_blocks
from tideline.sources.mapping import ColumnSpec, map_columns


def _projected(name: str, convert) -> ColumnSpec:
    source = {"lon": "X_WEB_MERCATOR", "lat": "Y_WEB_MERCATOR"}[name]
    return ColumnSpec(name, "float", derive=lambda: convert(ty.clean_double(F.col(source))))


# Declared columns, their source paths and types.
PERMIT_COLUMNS = [
    ColumnSpec("ivr_number", "string", "IVR_NUMBER"),
    ColumnSpec("application_number", "string", "APPLICATION_NUMBER"),
    ColumnSpec("address", "string", "ADDRESS"),
    ColumnSpec("neighborhood", "string", "NEIGHBORHOOD"),
    ColumnSpec("neighborhood_district", "string", "NEIGHBORHOOD_DISTRICT"),
    ColumnSpec("business_association", "string", "BUSINESS_ASSOCIATION"),
    ColumnSpec("description", "string", "DESCRIPTION"),
    ColumnSpec("work", "string", "WORK"),
    ColumnSpec("submitted_valuation", "float", "SUBMITTED_VALUATION"),
    ColumnSpec("final_valuation", "float", "FINAL_VALUATION"),
    ColumnSpec("total_sqft", "float", "TOTAL_SQFT"),
    ColumnSpec("stories", "float", "STORIES"),
    ColumnSpec("new_units", "float", "NEW_UNITS"),
    ColumnSpec("under_review", "string", "UNDER_REVIEW"),
    ColumnSpec("issued", "string", "ISSUED"),
    ColumnSpec("final", "string", "FINAL"),
    _projected("lon", geo.mercator_lon),
    _projected("lat", geo.mercator_lat),
]
PERMIT_STAGES = ["review", "issued", "final"]
PERMIT_START = "2020-01-01"

LISTING_REGIONS = ["portland", "eugene", "salem", "bend", "corvallis"]
LISTING_COLUMNS = [
    ColumnSpec("region"),
    ColumnSpec("url"),
    ColumnSpec("posted"),
    ColumnSpec("price", "integer"),
    ColumnSpec("bedrooms", "float"),
    ColumnSpec("sqft", "float"),
    ColumnSpec("neighborhood"),
    ColumnSpec("title"),
    ColumnSpec("address"),
    ColumnSpec("post_description"),
    ColumnSpec("latitude", "float"),
    ColumnSpec("longitude", "float"),
]

WEATHER_CITIES = {
    "portland": (45.5231, -122.6765),
    "eugene": (44.0521, -123.0868),
    "salem": (44.9429, -123.0351),
    "bend": (44.0582, -121.3153),
    "corvallis": (44.5646, -123.2620),
}
WEATHER_START = "2024-01-01"
WEATHER_PAYLOAD = (
    "daily struct<time: array<string>, temperature_2m_max: array<double>, temperature_2m_min: array<double>, "
    "precipitation_sum: array<double>, windspeed_10m_max: array<double>>"
)
WEATHER_ARRAYS = {
    "date": "time",
    "temp_max_c": "temperature_2m_max",
    "temp_min_c": "temperature_2m_min",
    "precipitation_mm": "precipitation_sum",
    "windspeed_max_kmh": "windspeed_10m_max",
}


def _source_paths(specs: list[ColumnSpec]) -> list[str]:
    return [spec.path for spec in specs if spec.path]


def permit_slices(spark: SparkSession, as_of: AsOf = None, only_from: AsOf = None, only_to: AsOf = None) -> DataFrame:
    """The declared permit grid, one row per day and stage, with its request texts."""
    grid = calendar.slice_grid(
        spark, PERMIT_START, as_of, categories={"date_type": PERMIT_STAGES}, only_from=only_from, only_to=only_to
    )
    return grid.select(
        calendar.request_text(F.col("slice_start")).alias("date_from"),
        calendar.request_text(F.col("slice_end")).alias("date_to"),
        "date_type",
    )


def permit_rows(spark: SparkSession, landing: str, whole_files: bool = False) -> DataFrame:
    """CSV files below ``date_type=<stage>/slice_date=<day>/`` folders to mapped rows.

    ``whole_files`` reads each file in one task, which also takes quotes that are not as RFC 4180 has them.
    """
    paths = [*_source_paths(PERMIT_COLUMNS), "X_WEB_MERCATOR", "Y_WEB_MERCATOR"]
    read = landed.read_csv_text if whole_files else read_csv_blocks
    raw = read(spark, landing, paths, slice_columns=["date_type", "slice_date"])
    return map_columns(raw, PERMIT_COLUMNS, keep=["date_type", "slice_date"])


def ingest_permits(
    rows: DataFrame,
    staging: str,
    loaded_at: AsOf = None,
    buckets: int = keyed.BUCKETS,
    batch: str | None = None,
    report: dict | None = None,
) -> DataFrame:
    """Stage rows by event-date type, merge them per permit with the latest non-null dates.

    ``report`` is filled as by ``keyed.upsert``; ingest jobs count in the job that writes, without a second scan.
    """
    stamped = rows.withColumn("loaded_at", F.lit(loaded_at).cast("timestamp_ntz") if loaded_at else F.localtimestamp())
    spark = rows.sparkSession
    keyed.staged_merge(
        spark,
        staging,
        stamped,
        stage="date_type",
        slice_column="slice_date",
        keys=["ivr_number"],
        merge_columns=["under_review", "issued", "final"],
        order_by=["loaded_at", "slice_date", "date_type"],
        buckets=buckets,
        batch=batch,
        report=report,
    )
    return keyed.read_merged(spark, staging).select(*[spec.name for spec in PERMIT_COLUMNS])


def listing_rows(
    list_pages: DataFrame, detail_pages: DataFrame, max_records: int | None = None, landed_at: str | None = None
) -> DataFrame:
    """Listing cards with the fields of their detail pages, where there is one.

    Of several copies of a detail page the latest by the column ``landed_at`` counts; without one, and
    for ties, the copy with the greatest fields. Pages are parsed first, so that only fields are shuffled.
    """
    cards = html.listing_cards(list_pages, max_records)
    order = [landed_at] if landed_at else []
    details = latest_per_key(html.listing_details(detail_pages, order), ["url"], order).drop(*order)
    return map_columns(html.with_details(cards, details), LISTING_COLUMNS)


def ingest_listings(rows: DataFrame, target: str, as_of: AsOf = None, report: dict | None = None) -> None:
    plain.append_snapshot(rows, target, as_of, keys=["url"], report=report)


def listing_medians(listings: DataFrame) -> DataFrame:
    """Number of priced listings, median rent and median size by region, dearest first."""
    priced = listings.where(ty.not_marker(F.col("price").cast("string")))
    medians = {
        "median_rent": ty.try_double(F.col("price").cast("string")),
        "median_sqft": ty.try_double(F.col("sqft").cast("string")),
    }
    return median_summary(
        priced, "region", "listings", medians, [F.desc_nulls_last("median_rent"), F.asc_nulls_last("region")]
    )


def city_dimension(spark: SparkSession) -> DataFrame:
    rows = [(city, lat, lon) for city, (lat, lon) in WEATHER_CITIES.items()]
    return spark.createDataFrame(rows, "city string, lat double, lon double")


def _required(value: Column, message: Column) -> Column:
    """``value``, or a failed job where it is null."""
    return F.coalesce(value, F.raise_error(message))


def weather_requests(spark: SparkSession, cities: DataFrame, as_of: AsOf = None, strict: bool = True) -> DataFrame:
    """One request per city: coordinates and date range up to ``as_of``.

    A city without coordinates fails the job; with ``strict=False`` it gets no request (``landed.unmatched`` lists those).
    """
    located = cities.join(city_dimension(spark), "city", "left" if strict else "inner")
    if strict:
        unknown = F.concat(F.lit("unknown city: "), F.coalesce(F.col("city").cast("string"), F.lit("null")))
        located = located.withColumns({name: _required(F.col(name), unknown) for name in ("lat", "lon")})
    grid = calendar.slice_grid(spark, as_of, as_of).select(F.col("slice_start").cast("string").alias("end_date"))
    return located.select("*", F.lit(WEATHER_START).alias("start_date"), grid.scalar().alias("end_date"))


def parsed_weather(payloads: DataFrame) -> DataFrame:
    """``(city, payload)`` rows with the payload's arrays as columns."""
    parsed = payloads.withColumn("p", landed.parsed_json(F.col("payload"), WEATHER_PAYLOAD))
    return parsed.select("city", "payload", *[F.col(f"p.daily.{name}").alias(name) for name in WEATHER_ARRAYS.values()])


def weather_rows(payloads: DataFrame, strict: bool = True) -> DataFrame:
    """One row per city and day.

    A payload that does not parse or line up fails the job; with ``strict=False`` it is left to ``weather_rejects``.
    """
    return _weather_days(parsed_weather(payloads), strict)


def _weather_days(parsed: DataFrame, strict: bool) -> DataFrame:
    good = landed.aligned_arrays(list(WEATHER_ARRAYS.values()), "time")
    if strict:
        bad = F.concat(F.lit("weather payload that does not parse or line up: "), F.coalesce("city", F.lit("null")))
        good = _required(F.when(good, True), bad)
    lined_up = parsed.where(good)
    rows = landed.arrays_to_rows(lined_up, WEATHER_ARRAYS, keep=["city"]).where(F.col("date").isNotNull())
    return rows.select(F.concat("city", F.lit("_"), "date").alias("id"), "city", *list(WEATHER_ARRAYS))


def weather_rejects(payloads: DataFrame) -> DataFrame:
    """Payloads that do not parse or whose arrays are shorter than their days."""
    parsed = parsed_weather(payloads)
    return parsed.where(~landed.aligned_arrays(list(WEATHER_ARRAYS.values()), "time")).select("city", "payload")


def ingest_weather(
    rows: DataFrame,
    target: str,
    loaded_at: AsOf = None,
    buckets: int = keyed.BUCKETS,
    batch: str | None = None,
    rejects: DataFrame | None = None,
    report: dict | None = None,
) -> DataFrame:
    """Upsert daily rows by id; a reload replaces the days it covers.

    ``rejects``, the payloads of ``weather_rejects``, must be empty; pass none to store what there is.
    """
    if rejects is not None and (bad := rejects.select("city").first()) is not None:
        raise ValueError(f"the weather payload of {bad.city!r} does not parse or its arrays do not line up")
    stamped = rows.withColumn("loaded_at", F.lit(loaded_at).cast("timestamp_ntz") if loaded_at else F.localtimestamp())
    spark = rows.sparkSession
    keyed.upsert(spark, target, stamped, ["id"], ["loaded_at"], buckets=buckets, batch=batch, report=report)
    return keyed.read_keyed(spark, target).drop("loaded_at")


def ingest_weather_payloads(
    payloads: DataFrame, target: str, report: dict, loaded_at: AsOf = None, buckets: int = keyed.BUCKETS, batch: str | None = None
) -> DataFrame:
    """Upsert the days of all payloads that parse and line up; ``report`` says how many did not.

    Besides the counts of ``keyed.upsert`` it receives ``n_payloads`` and ``n_rejected``. Nothing is
    scanned or parsed for them a second time; ``weather_rejects`` lists the payloads themselves.
    """
    good = landed.aligned_arrays(list(WEATHER_ARRAYS.values()), "time")
    parsed, watch = quality.watched(parsed_weather(payloads), "n_payloads", n_rejected=~good)
    written: dict = {}
    days = ingest_weather(_weather_days(parsed, strict=False), target, loaded_at, buckets, batch, report=written)
    if written:
        report.update(written | watch.get)
    return days
