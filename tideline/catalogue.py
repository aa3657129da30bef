"""The package's operators and models as queries over the given tables.

Dates and timestamps leave as ISO text, so that every engine hands over the same value.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions import dates as D
from tideline.functions import geo
from tideline.functions import text as T
from tideline.functions import typing as ty
from tideline.functions.rules import Rule, categorise
from tideline.operators import calendar, dedup, quality, report, rolling, rollup
from tideline.plans import ingest, permits
from tideline.plans import permit_tables as stored
from tideline.session import fresh_dir, remove, remove_folder, shuffles_removed, written
from tideline.sinks import keyed, plain
from tideline.sources import html, landed, slices
from tideline.sources.csv_blocks import read_csv_blocks
from tideline.sources.mapping import ColumnSpec, map_columns
from tideline.streaming import ingest as streams

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

AS_OF = "2001-08-01"
SPINE_START = "1995-01-01"

# Key buckets of the small tables written here.
FEW_BUCKETS = 8
WARMUP_FROM = "1996-01-01"
REPORT_FROM = "1997-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return landed.read_table(spark, f"{sf_dir}/{name}.parquet")


def iso_text(df: DataFrame) -> DataFrame:
    texts = [f.name for f in df.schema if f.dataType.typeName() in {"date", "timestamp", "timestamp_ntz"}]
    return df.withColumns({name: F.col(name).cast("string") for name in texts}) if texts else df


def query(function: Query) -> Query:
    QUERIES[function.__name__] = lambda spark, sf_dir: iso_text(function(spark, sf_dir))
    return function


def money(value: Column | str) -> Column:
    """Two-decimal amounts add up exactly as decimals, in any order."""
    return (F.col(value) if isinstance(value, str) else value).cast("decimal(18,2)")


def money_sum(value: Column | str) -> Column:
    return F.sum(money(value)).cast("double")


def spine(spark: SparkSession) -> DataFrame:
    return calendar.calendar_days(spark, SPINE_START, AS_OF)


# --- calendars and slices


@query
def calendar_days(spark, sf):
    orders = table(spark, sf, "orders")
    first = orders.agg(F.min(F.to_date("o_orderdate"))).scalar()
    last = orders.agg(F.max(F.to_date("o_orderdate"))).scalar()
    return calendar.calendar_days(spark, first, last)


@query
def slice_grid(spark, sf):
    events = table(spark, sf, "events")
    bounds = [events.agg(f(F.to_date("ts"))).scalar() for f in (F.min, F.max)]
    grid = calendar.category_slices(events, "event_type", *bounds, window_days=2)
    return grid.select(
        "event_type",
        "slice_start",
        "slice_end",
        calendar.request_text(F.col("slice_start")).alias("date_from"),
        calendar.request_text(F.col("slice_end")).alias("date_to"),
    )


@query
def slice_cap(spark, sf):
    events = table(spark, sf, "events").select(
        F.to_date("ts").alias("slice_date"), "event_type", "ts", "event_id", "user_id"
    )
    return calendar.cap_per_slice(events, ["slice_date", "event_type"], ["ts", "event_id"], 5)


@query
def slice_backfill(spark, sf):
    """Landed rows of every slice of a restricted run; slices without rows count zero."""
    grid = calendar.slice_grid(
        spark,
        "2024-01-01",
        "2024-01-31",
        categories={"event_type": ["click", "purchase", "refund"]},
        only_from="2024-01-10",
        only_to="2024-01-16",
    )
    events = table(spark, sf, "events")
    landed_rows = rollup.daily(events, F.col("ts"), {"n_landed": F.count("*")}, ["event_type"])
    counted = grid.drop("slice_end").join(
        landed_rows.withColumnRenamed("date", "slice_start"), ["slice_start", "event_type"], "left"
    )
    return counted.withColumn("n_landed", F.coalesce("n_landed", F.lit(0)))


@query
def slice_gaps(spark, sf):
    """Runs of days for which a user has no landed event, up to the day the report is made for."""
    events = table(spark, sf, "events")
    grid = calendar.category_slices(events, "user_id", "2024-01-01", D.day("2024-02-05"))
    landed_days = events.select("user_id", F.to_date("ts").alias("slice_start"))
    return calendar.missing_runs(grid, landed_days, ["user_id"])


# --- typing and mapping


@query
def parquet_glob(spark, sf):
    return landed.read_table(spark, f"{sf}/par*.parquet").groupBy("p_type").agg(F.count("*").alias("n"))


@query
def csv_line_breaks(spark, sf):
    """Documents as CSV whose texts are quoted and hold line breaks, read by blocks of the files."""
    folder = fresh_dir(spark, "csv")
    documents = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), "source", F.concat("source", F.lit('\n\n"'), "text", F.lit('",\n')).alias("body")
    )
    writer = documents.write.partitionBy("source").option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
    return read_csv_blocks(spark, folder, ["body", "doc_id"], ["source"])


@query
def sql_text(spark, sf):
    """SQL text over named tables."""
    names = ["customer", "nation", "region"]
    return spark.sql(
        "SELECT r_name, count(*) AS n_customers FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey "
        "JOIN {region} ON n_regionkey = r_regionkey GROUP BY r_name",
        **{name: table(spark, sf, name) for name in names},
    )


@query
def stored_as_text(spark, sf):
    """Numbers stored as text with ``nan`` for missing ones, read back and typed."""
    price = F.when(F.col("l_linenumber") != 7, F.col("l_extendedprice"))
    lines = table(spark, sf, "lineitem").select("l_returnflag", plain.stored_text(price).alias("price"))
    stored = plain.full_refresh(lines, fresh_dir(spark, "text"))
    return stored.groupBy("l_returnflag").agg(
        F.count("*").alias("n"),
        F.count(F.when(~ty.not_marker(F.col("price")), 1)).alias("n_marked"),
        money_sum(ty.clean_double(F.col("price"))).alias("total"),
    )


def lineitem_text(spark, sf) -> DataFrame:
    """Line items as a string table, with ``nan`` for the numbers of the seventh line."""

    def stored(value: Column) -> Column:
        return F.when(F.col("l_linenumber") == 7, F.lit("nan")).otherwise(value.cast("string"))

    return table(spark, sf, "lineitem").select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit(".0")).alias("order_text"),
        F.col("l_linenumber").cast("string").alias("line_text"),
        stored(money("l_quantity")).alias("quantity_text"),
        stored(money("l_extendedprice")).alias("price_text"),
        stored(money(F.col("l_quantity") / 4)).alias("quarter_text"),
        F.when(F.col("l_returnflag") == "N", "nan").otherwise(F.col("l_returnflag")).alias("flag_text"),
        F.when(F.col("l_linestatus") == "O", F.col("l_shipdate").cast("string"))
        .otherwise(F.date_format("l_shipdate", "yyyy/MM/dd"))
        .alias("ship_text"),
    )


@query
def typed_from_strings(spark, sf):
    return lineitem_text(spark, sf).select(
        ty.try_int(F.col("order_text")).alias("order_key"),
        ty.try_int(F.col("line_text")).alias("line_number"),
        ty.clean_double(F.col("quantity_text")).alias("quantity"),
        ty.strict_double(F.col("price_text")).alias("price"),
        ty.try_int(F.col("quarter_text")).alias("quarter_quantity"),
        ty.positive_flag(ty.try_double(F.col("quantity_text"))).alias("has_quantity"),
        ty.positive_flag_nan_high(ty.try_double(F.col("quantity_text"))).alias("has_quantity_literal"),
        ty.null_if_marker(F.col("flag_text")).alias("flag"),
        ty.try_timestamp(F.col("ship_text")).alias("shipped_at"),
        ty.try_timestamp(F.col("flag_text")).alias("not_a_time"),
    )


@query
def column_mapping(spark, sf):
    specs = [
        ColumnSpec("order_key", "integer", "o_orderkey"),
        ColumnSpec("status", "string", "o_orderstatus"),
        ColumnSpec("total", "float", "o_totalprice"),
        ColumnSpec("priority", "string", "o_orderpriority"),
        ColumnSpec("order_day", "date", "o_orderdate"),
        ColumnSpec("order_year", derive=lambda: F.year("o_orderdate")),
    ]
    return map_columns(table(spark, sf, "orders"), specs)


@query
def dedup_first(spark, sf):
    lines = table(spark, sf, "lineitem")
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    columns = ["l_orderkey", "l_linenumber", *order]
    return dedup.first_per_key(
        lines.select(*columns), ["l_orderkey", "l_linenumber"], [F.asc_nulls_last(name) for name in order]
    )


@query
def code_filter(spark, sf):
    part = table(spark, sf, "part")
    return part.where(F.substring("p_brand", 1, 7) == "Brand#1").select("p_partkey", "p_brand", "p_name")


@query
def rule_category(spark, sf):
    rules = [
        Rule("Discounted", equals={"p_type": ["PROMO", "ECONOMY"]}, prefixes={("p_name", 3): ["red", "hot"]}),
        Rule("Unreachable", prefixes={("p_name", 1): ["sm"]}),
        Rule("Small", equals={"p_type": ["SMALL"], "p_brand": ["Brand#1", "Brand#2"]}),
        Rule("Blue", prefixes={("p_name", 4): ["blue"]}),
    ]
    return table(spark, sf, "part").select(
        "p_partkey",
        categorise(rules, F.col("p_type")).alias("category"),
        F.when(~F.col("p_type").isin("PROMO", "ECONOMY"), F.col("p_size")).alias("regular_size"),
    )


# --- lifecycle facts


def order_lifecycle(spark, sf) -> DataFrame:
    """Per order: its date, first and last shipment and summed lines.

    Lines are aggregated to one row per order before the join, so both sides are unique.
    """
    lines = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.min("l_shipdate").alias("first_ship"),
            F.max("l_shipdate").alias("last_ship"),
            money_sum("l_quantity").alias("quantity"),
        )
    )
    return table(spark, sf, "orders").join(lines, "o_orderkey", "left")


@query
def last_status(spark, sf):
    times = [F.col("o_orderdate"), F.col("first_ship"), F.col("last_ship")]
    return order_lifecycle(spark, sf).select("o_orderkey", D.latest_of(*times).alias("last_status_at"))


@query
def lifecycle_days(spark, sf):
    return order_lifecycle(spark, sf).select(
        "o_orderkey",
        D.days_between(F.col("o_orderdate"), F.col("first_ship")).alias("days_to_first"),
        D.days_between(F.col("first_ship"), F.col("last_ship")).alias("days_to_last"),
    )


@query
def guarded_ratio(spark, sf):
    units = F.when(F.col("l_returnflag") == "R", 0.0).otherwise(F.col("l_quantity"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", ty.ratio(F.col("l_extendedprice"), units).alias("price_per_unit")
    )


# --- rollups


@query
def daily_rollup(spark, sf):
    measures = {
        "sum_qty": money_sum("l_quantity"),
        "sum_returned": money_sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))),
        "n_lines": F.count("*"),
        "n_large": F.count(F.when(F.col("l_quantity") > 40, F.col("l_orderkey"))),
        "avg_qty": F.avg("l_quantity"),
    }
    days = rollup.daily(table(spark, sf, "lineitem"), F.col("l_shipdate"), measures)
    return rollup.on_spine(spine(spark), days, zero=["n_lines", "n_large", "sum_returned"])


@query
def lifecycle_by_date(spark, sf):
    facts = order_lifecycle(spark, sf)
    days = D.days_between(F.col("o_orderdate"), F.col("first_ship"))
    waiting = D.is_open_on(F.col("date"), F.col("o_orderdate"), F.col("first_ship"), AS_OF)
    waiting = waiting & ~F.col("o_orderstatus").isin("F")

    def on(stage):
        return lambda value, also=None: rollup.on_stage(stage, value, also)

    placed, first, last = on("placed"), on("first"), on("last")
    measures = {
        "first": {
            "n_first": F.count(first(F.col("o_orderkey"))),
            "qty_first": F.sum(first(F.col("quantity"))),
            "sum_days": F.sum(first(days)),
            "avg_days": F.avg(first(days)),
        },
        "placed": {
            "n_placed": F.count(placed(F.col("o_orderkey"))),
            "qty_placed": F.sum(placed(F.col("quantity"))),
            "qty_waiting": F.sum(placed(F.col("quantity"), waiting)),
        },
        "last": {"n_last": F.count(last(F.col("o_orderkey"))), "qty_last": F.sum(last(F.col("quantity")))},
    }
    times = {"placed": F.col("o_orderdate"), "first": F.col("first_ship"), "last": F.col("last_ship")}
    daily = rollup.stages_daily(facts, times, measures)
    zero = ["n_first", "sum_days", "n_placed", "qty_placed", "n_last", "qty_last"]
    out = rollup.on_spine(spine(spark), daily, zero=zero)
    return out.withColumn("days_per_qty", ty.ratio(F.col("sum_days"), F.col("qty_first")))


@query
def chained_daily_joins(spark, sf):
    """Three one-to-one left joins of separate day rollups to the calendar."""
    orders, lines, events = (table(spark, sf, name) for name in ("orders", "lineitem", "events"))
    days = [
        rollup.daily(orders, F.col("o_orderdate"), {"n_orders": F.count("*")}),
        rollup.daily(lines, F.col("l_shipdate"), {"n_lines": F.count("*")}),
        rollup.daily(events, F.col("ts"), {"n_events": F.count("*")}),
    ]
    last = events.agg(F.max(F.to_date("ts"))).scalar()
    return rollup.chain(calendar.calendar_days(spark, SPINE_START, last, years_ahead=0), days)


def typed_lines(spark, sf) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return landed.lookup(lines, part, "l_partkey")


def category_sides(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Daily line measures by part type: by ship date and by order date, larger lines only."""
    lines = typed_lines(spark, sf)
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    large = F.col("l_quantity") > 10
    shipped = rollup.daily(
        lines,
        F.col("l_shipdate"),
        {"qty_shipped": money_sum("l_quantity"), "n_shipped": F.count("l_orderkey")},
        ["p_type"],
        large,
    )
    ordered = rollup.daily(
        lines.join(orders, "l_orderkey"),
        F.col("o_orderdate"),
        {"qty_ordered": money_sum("l_quantity"), "n_ordered": F.count("l_orderkey")},
        ["p_type"],
        large,
    )
    days = spine(spark)
    return (
        rollup.on_spine(days, shipped, zero=["n_shipped"]),
        rollup.on_spine(days, ordered, zero=["n_ordered", "qty_ordered"]),
    )


@query
def daily_by_category(spark, sf):
    return rollup.full_combine(spine(spark), *category_sides(spark, sf), by="p_type")


@query
def daily_by_category_coalesced(spark, sf):
    return rollup.full_combine(spine(spark), *category_sides(spark, sf), by="p_type", coalesce_date=True)


def shipped_by_type(spark, sf) -> DataFrame:
    measures = {"qty": money_sum("l_quantity")}
    days = rollup.daily(typed_lines(spark, sf), F.col("l_shipdate"), measures, ["p_type"])
    # Day-grain rows, written because the grid reads them for its dates, categories and values.
    return written(rollup.on_spine(spine(spark), days), "shipped-by-type")


@query
def dense_grid(spark, sf):
    return calendar.densify(shipped_by_type(spark, sf), "p_type", after=WARMUP_FROM)


# --- trailing windows


@query
def rolling_by_category(spark, sf):
    return rolling.trailing_by_category(
        shipped_by_type(spark, sf), "p_type", "qty", WARMUP_FROM, REPORT_FROM, category_name="p_type"
    )


@query
def rolling_timeseries(spark, sf):
    measures = {"qty": money_sum("l_quantity"), "n_lines": F.count("*")}
    days = rollup.daily(table(spark, sf, "lineitem"), F.col("l_shipdate"), measures)
    series = {"avg_qty": F.avg("qty"), "avg_lines": F.avg("n_lines"), "sum_lines": F.sum("n_lines")}
    return rolling.trailing_series(
        rollup.on_spine(spine(spark), days, zero=["n_lines"]), series, WARMUP_FROM, REPORT_FROM
    )


@query
def rolling_events(spark, sf):
    """Trailing frames over single events, in blocks: of all events, and of each event type."""
    events = table(spark, sf, "events").select("event_id", "ts", "event_type", "user_id")
    measures = {"avg_user": F.avg("user_id"), "max_user": F.max("user_id"), "n_events": F.count("*")}
    order = ["ts", "event_id"]
    overall = rolling.trailing_in_blocks(events, order, measures, rows=366)
    of_type = {f"{name}_of_type": value for name, value in measures.items()}
    return rolling.trailing_in_blocks(overall, order, of_type, rows=50, by=["event_type"])


# --- reports


@query
def recent_window(spark, sf):
    recent = table(spark, sf, "lineitem").where(
        report.within_days(F.col("l_shipdate"), AS_OF) & (F.col("l_extendedprice") > 0)
    )
    return recent.select(
        "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("shipped"), "l_extendedprice", "l_quantity"
    ).orderBy(
        F.desc_nulls_last("shipped"),
        ty.round_to_int(F.col("l_extendedprice")).desc_nulls_last(),
        "l_orderkey",
        "l_linenumber",
    )


@query
def top_groups(spark, sf):
    orders = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n"), F.sum(money("o_totalprice")).alias("total")
    )
    customer = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    by_nation = landed.lookup(landed.lookup(orders, customer, "c_custkey"), nation, "n_nationkey")
    measures = {"n_orders": F.sum("n"), "avg_total": F.sum("total").cast("double") / F.sum("n")}
    return report.group_summary(by_nation, ["n_name"], measures, [F.desc("n_orders"), F.asc("n_name")], limit=20)


@query
def median_by_group(spark, sf):
    medians = {"median_total": F.col("o_totalprice"), "median_day": F.datediff("o_orderdate", F.lit("1995-01-01"))}
    out = report.median_summary(
        table(spark, sf, "orders"), "o_orderpriority", "n_orders", medians, [F.desc("median_total")]
    )
    return out.withColumn("median_total", F.round("median_total", 4))


@query
def count_by_group(spark, sf):
    stored = table(spark, sf, "events").select(
        "event_type", F.when(F.get_json_object("props", "$.k") == "7", "nan").otherwise(F.col("props")).alias("props")
    )
    kept = stored.where(ty.not_marker(F.col("props")))
    return report.group_summary(kept, ["event_type"], {"n": F.count("*")}, [F.desc("n"), F.asc("event_type")])


# --- merge and write strategies


STAGE_DATES = {"viewed_at": "view", "clicked_at": "click", "bought_at": "purchase"}


def staged_events(spark, sf) -> DataFrame:
    """Events as slices: each fills the date of its own stage, some carry the text ``nan``."""
    events = table(spark, sf, "events")
    erased = F.get_json_object("props", "$.k").cast("int") > 90
    dates = [
        ty.null_if_marker(
            F.when(F.col("event_type") == kind, F.when(erased, "nan").otherwise(F.to_date("ts").cast("string")))
        ).alias(name)
        for name, kind in STAGE_DATES.items()
    ]
    return events.select("user_id", "event_type", F.col("ts").alias("loaded_at"), F.to_date("ts").alias("slice_date"),
                         "event_id", "value", *dates)


@query
def latest_non_null(spark, sf):
    rows = staged_events(spark, sf).drop("slice_date")
    return dedup.latest_non_null(rows, ["user_id"], list(STAGE_DATES), ["loaded_at", "event_id"])


def halves(df: DataFrame, at: str) -> list[DataFrame]:
    return [df.where(F.col(at) < F.lit("2024-01-15").cast("timestamp_ntz")),
            df.where(F.col(at) >= F.lit("2024-01-15").cast("timestamp_ntz"))]


@query
def staged_merge(spark, sf):
    folder = fresh_dir(spark, "staged-merge")
    for number, batch in enumerate(halves(staged_events(spark, sf), "loaded_at")):
        keyed.staged_merge(
            spark,
            f"{folder}/staging",
            batch,
            stage="event_type",
            slice_column="slice_date",
            keys=["user_id"],
            merge_columns=list(STAGE_DATES),
            order_by=["loaded_at", "event_id"],
            buckets=FEW_BUCKETS,
            batch=str(number),
        )
    return keyed.read_merged(spark, f"{folder}/staging").select("user_id", *STAGE_DATES, "event_id", "event_type")


@query
def upsert_latest(spark, sf):
    path = fresh_dir(spark, "upsert")
    events = table(spark, sf, "events")
    for number, batch in enumerate(halves(events, "ts")):
        keyed.upsert(
            spark, path, batch, ["user_id", "event_type"], ["ts", "event_id"], buckets=FEW_BUCKETS, batch=str(number)
        )
    return keyed.read_keyed(spark, path).select("user_id", "event_type", "event_id", "ts", "value")


@query
def keyed_compaction(spark, sf):
    """Batches before and after a compaction whose covered folders are gone; one of the batches comes again."""
    path = fresh_dir(spark, "compaction")
    events = table(spark, sf, "events")
    early, late = halves(events, "ts")
    batches = {"odd": early.where("event_id % 2 = 1"), "even": early.where("event_id % 2 = 0"), "late": late}
    for name, batch in batches.items():
        if name == "late":
            keyed.compact(spark, path)
            keyed.remove_covered(spark, path)
        keyed.upsert(spark, path, batch, ["user_id", "event_type"], ["ts", "event_id"], buckets=FEW_BUCKETS, batch=name)
    keyed.upsert(spark, path, batches["odd"], ["user_id", "event_type"], ["ts", "event_id"], buckets=FEW_BUCKETS, batch="odd")
    return keyed.read_keyed(spark, path).select("user_id", "event_type", "event_id", "ts", "value")


@query
def snapshot_append(spark, sf):
    path = fresh_dir(spark, "snapshots")
    events = table(spark, sf, "events").select("event_id", "user_id", "value", "ts")
    for batch, taken in zip(halves(events, "ts"), ("2024-01-15", "2024-01-31"), strict=True):
        plain.append_snapshot(batch.drop("ts"), path, taken)
    return spark.read.parquet(path)


@query
def stage_by_parameter(spark, sf):
    """One folder per event type and hour, which stays the text it was; a second run replaces only what it brings."""
    path = fresh_dir(spark, "stages")
    events = table(spark, sf, "events").select("event_id", "value", "event_type", F.date_format("ts", "HH").alias("hour"))
    plain.stage_by(events, path, "event_type", "hour")
    plain.stage_by(events.where("event_type = 'click'").withColumn("value", F.lit(0.0)), path, "event_type", "hour")
    staged = landed.read_table(spark, path).groupBy("event_type", "hour")
    return staged.agg(F.count("*").alias("n"), money_sum("value").alias("total"))


@query
def full_refresh(spark, sf):
    path = fresh_dir(spark, "refresh")
    plain.full_refresh(table(spark, sf, "customer"), path)
    return plain.full_refresh(table(spark, sf, "supplier"), path)


@query
def catalog_tables(spark, sf):
    """Lines and orders as catalog tables bucketed by order, read by name and joined on their buckets."""
    names, keys = {}, {"lineitem": "l_orderkey", "orders": "o_orderkey"}
    buckets = max(FEW_BUCKETS, *[plain.buckets_for(table(spark, sf, name)) for name in keys])
    for name, key in keys.items():
        path = fresh_dir(spark, name)
        names[name] = f"tideline_{path.rsplit('/', 1)[1].replace('-', '_')}"
        plain.save_bucketed(table(spark, sf, name), names[name], [key], buckets, path)
    lines, orders = (landed.read_table(spark, names[name]) for name in ("lineitem", "orders"))
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    per_order = joined.groupBy("o_orderkey", "o_orderpriority").agg(F.count("*").alias("n_lines"), money_sum("l_extendedprice").alias("total"))
    return per_order.groupBy("o_orderpriority").agg(
        F.count("*").alias("n_orders"), F.sum("n_lines").alias("n_lines"), F.max("total").alias("largest")
    )


# --- projection, JSON, dimension lookup


@query
def reproject_points(spark, sf):
    x = F.lit(-13655000.0) + F.col("c_custkey") * 10
    y = F.lit(5703000.0) + F.col("c_acctbal")
    projected = table(spark, sf, "customer").select(
        "c_custkey", geo.point(geo.mercator_lon(x), geo.mercator_lat(y)).alias("location")
    )
    return projected.select("c_custkey", *[F.round(f"location.{part}", 9).alias(part) for part in ("lon", "lat")])


@query
def json_fields(spark, sf):
    parsed = table(spark, sf, "events").withColumn("parsed", landed.parsed_json(F.col("props"), "k int"))
    return parsed.select("event_id", F.col("parsed.k").alias("k"))


def event_payloads(spark, sf) -> DataFrame:
    """JSON payloads of parallel arrays per event type, day and hour, as a feed would land them.

    The hours, and thousands of ids within one, bound each payload.
    """
    events = table(spark, sf, "events")
    chunk = [F.to_date("ts").alias("day"), F.hour("ts").alias("hour"), F.floor(F.col("event_id") / 1000).alias("part")]
    rows = F.array_sort(F.collect_list(F.struct("event_id", "user_id", "value")))
    grouped = events.groupBy("event_type", *chunk).agg(rows.alias("rows"))
    daily = F.struct(*[F.col(f"rows.{name}").alias(name) for name in ("event_id", "user_id", "value")])
    return grouped.select("event_type", "day", F.to_json(F.struct(daily.alias("daily"))).alias("payload"))


def payload_rows(payloads: DataFrame, keep: list[str]) -> DataFrame:
    schema = "daily struct<event_id: array<bigint>, user_id: array<bigint>, value: array<double>>"
    names = ["event_id", "user_id", "value"]
    parsed = payloads.withColumn("p", landed.parsed_json(F.col("payload"), schema))
    parsed = parsed.select(*keep, *[F.col(f"p.daily.{name}").alias(name) for name in names])
    lined_up = parsed.where(landed.aligned_arrays(names, "event_id"))
    return landed.arrays_to_rows(lined_up, {name: name for name in names}, keep=keep)


@query
def json_arrays_to_rows(spark, sf):
    return payload_rows(event_payloads(spark, sf), ["event_type", "day"])


@query
def slice_source(spark, sf):
    """Payloads landed in one folder per event type and day; a restricted run of three slices reads only theirs."""
    root, keys = fresh_dir(spark, "payloads"), ["event_type", "slice_start"]
    payloads = event_payloads(spark, sf).withColumnRenamed("day", "slice_start")
    payloads.repartition(*keys).write.partitionBy(*keys).parquet(root)
    spark.dataSource.register(slices.slice_source("landed_payloads", "payload string", slices.landed_folder(root, keys)))
    run = spark.read.format("landed_payloads").options(
        start="2024-01-01",
        end="2024-01-31",
        categories=json.dumps({"event_type": ["purchase"]}),
        only_from="2024-01-10",
        only_to="2024-01-12",
    )
    return payload_rows(run.load(), ["event_type", "slice_start"])


@query
def dim_lookup(spark, sf):
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    joined = landed.lookup(table(spark, sf, "supplier"), nation, "s_nationkey")
    return joined.select("s_suppkey", F.concat("n_name", F.lit("_"), "s_name").alias("id"), "s_acctbal")


@query
def hot_key_lookup(spark, sf):
    """Daily lines by part type where single parts may hold much of the table."""
    lines = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_quantity", "l_shipdate")
    part = table(spark, sf, "part").select("p_partkey", "p_type")
    typed = landed.lookup_with_hot_keys(lines, part, "p_partkey")
    return rollup.daily(typed, F.col("l_shipdate"), {"qty": money_sum("l_quantity"), "n": F.count("*")}, ["p_type"])


@query
def dim_unmatched(spark, sf):
    """Customers whose key has no supplier: the lookup's report of unknown keys."""
    keys = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("c_custkey"))
    return landed.unmatched(table(spark, sf, "customer").select("c_custkey", "c_name"), keys, "c_custkey")


# --- HTML and number parsing


@query
def html_items(spark, sf):
    return html.linked_rows(table(spark, sf, "pages").select("page_id", "html"), T.start_tag("li"), html.link_fields)


@query
def html_detail_join(spark, sf):
    """Links of every page with the texts of the page they point to.

    The first link of a page stands for the page itself; the others have no landed page.
    """
    pages = table(spark, sf, "pages")
    listed = pages.select(F.col("url").alias("page_url"), "html")
    items = html.linked_rows(listed, T.start_tag("li"), html.link_fields)
    items = items.withColumn("url", F.when(F.col("position") == 0, F.col("page_url")).otherwise(F.col("url")))
    markup = F.col("markup")
    details = pages.select("url", T.visible_markup(F.col("html")).alias("markup")).select(
        "url",
        T.text_of(T.first_element(markup, T.start_tag("h1"))).alias("heading"),
        T.text_of(T.first_element(markup, T.start_tag("div", class_="ad"))).alias("ad"),
        T.text_of(T.first_element(markup, T.start_tag("article")), " ").alias("body"),
    )
    return html.with_details(items.select("page_url", "position", "url"), details)


@query
def number_parse(spark, sf):
    size = F.col("p_size").cast("string")
    rendered = F.array(
        F.concat(size, F.lit("BR / 1Ba")),
        F.concat(F.lit("1,"), F.lpad(size, 3, "0"), F.lit(" ft2")),
        F.concat(F.col("p_name"), F.lit(" "), (F.col("p_size") + 1).cast("string"), F.lit(" br")),
    )
    price = F.concat(F.lit("$1,"), money("p_retailprice").cast("string"))
    return table(spark, sf, "part").select(
        "p_partkey",
        T.digits_int(price).alias("price"),
        T.digits_int(F.col("p_name")).alias("no_digits"),
        T.last_number_before(rendered, "BR").alias("bedrooms"),
        T.last_number_before(rendered, "ft").alias("sqft"),
    )


# --- quality checks


@query
def key_unique_check(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def key_not_null_check(spark, sf):
    return quality.null_keys(order_lifecycle(spark, sf), ["first_ship"]).select("o_orderkey", "o_orderstatus")


DECLARED_ORDERS = {
    "o_orderkey": "bigint",
    "o_custkey": "int",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_clerk": "string",
}


@query
def schema_report(spark, sf):
    return quality.schema_report(table(spark, sf, "orders"), DECLARED_ORDERS)


# --- incremental ingest


@query
def incremental_ingest(spark, sf):
    folder = fresh_dir(spark, "incremental")
    events = table(spark, sf, "events")
    for batch in halves(events, "ts"):
        batch.write.mode("append").parquet(f"{folder}/landing")
        stream = streams.landed_stream(spark, f"{folder}/landing", events.schema)
        streams.ingest_upsert(
            stream,
            f"{folder}/target",
            f"{folder}/progress",
            ["user_id", "event_type"],
            ["ts", "event_id"],
            buckets=FEW_BUCKETS,
        )
    return keyed.read_keyed(spark, f"{folder}/target").select("user_id", "event_type", "event_id", "ts", "value")


@query
def incremental_append(spark, sf):
    folder = fresh_dir(spark, "append")
    events = table(spark, sf, "events")
    for batch in halves(events, "ts"):
        batch.write.mode("append").parquet(f"{folder}/landing")
        stream = streams.landed_stream(spark, f"{folder}/landing", events.schema)
        streams.ingest_append(stream.drop("props"), f"{folder}/target", f"{folder}/progress", ["event_type"])
    return spark.read.parquet(f"{folder}/target")


# --- permit models over a string table rendered from orders, lines and parts

PERMIT_TYPES = {
    "STANDARD": "Single Family Dwelling",
    "MEDIUM": "Duplex",
    "LARGE": "Apartments/Condos (3 or more units)",
    "SMALL": "Garage/Carport",
    "ECONOMY": "Storage",
    "PROMO": "Tower",
}
PERMIT_WORK = {
    "1-URGENT": "New Construction",
    "2-HIGH": "Addition",
    "3-MEDIUM": "Alteration",
    "4-NOT SPECIFIED": "nan",
    "5-LOW": "Demolition",
}
PERMIT_STATUS = {"F": "Final", "O": "Under Review", "P": "Expired"}
PERMIT_GROUPS = ["A-2", "B", "E", "F-1", "H", "I-2", "R-3", "S-1", "SR", "U", "U1", None, None, None]


def _choose(source: str, options: dict[str, str]) -> Column:
    case = F
    for key, value in options.items():
        case = case.when(F.col(source) == key, value)
    return case


def raw_permits(spark, sf) -> DataFrame:
    """One string-typed permit record per order line; some keys occur more than once."""
    lines = table(spark, sf, "lineitem")
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    part = table(spark, sf, "part").withColumnRenamed("p_partkey", "l_partkey")
    rows = landed.lookup(landed.lookup(lines, orders, "l_orderkey"), part, "l_partkey")

    def text(value: Column) -> Column:
        return value.cast("string")

    def nan_if(condition: Column, value: Column) -> Column:
        return F.when(condition, F.lit("nan")).otherwise(text(value))

    line = F.col("l_linenumber")
    mark = F.when(F.col("l_returnflag") == "N", "-001-").otherwise("-000-")
    group = F.element_at(F.lit(PERMIT_GROUPS[:-3] + [""] * 3), (F.col("p_size") % len(PERMIT_GROUPS) + 1).cast("int"))
    return rows.select(
        text(F.concat(text(F.col("l_orderkey") * 10 + line), F.lit(".0"))).alias("IVR_NUMBER"),
        F.concat(F.lpad(text(F.col("l_orderkey")), 11, "0"), mark, F.lit("CO")).alias("APPLICATION_NUMBER"),
        F.when(line < 6, _choose("o_orderstatus", PERMIT_STATUS)).alias("STATUS"),
        _choose("p_type", PERMIT_TYPES).alias("TYPE"),
        F.col("p_name").alias("DESCRIPTION"),
        _choose("o_orderpriority", PERMIT_WORK).alias("WORK"),
        F.concat(F.lit("Lot "), text(F.col("o_custkey"))).alias("ADDRESS"),
        text(F.to_date("o_orderdate")).alias("SET_UP"),
        text(F.date_add("o_orderdate", line)).alias("UNDER_REVIEW"),
        nan_if(line == 5, F.to_date("l_shipdate")).alias("ISSUED"),
        nan_if(F.col("l_linestatus") == "O", F.date_add("l_shipdate", F.col("l_quantity").cast("int"))).alias("FINAL"),
        F.concat(F.lit("Hood "), text(F.col("l_suppkey"))).alias("NEIGHBORHOOD"),
        F.col("l_returnflag").alias("NEIGHBORHOOD_DISTRICT"),
        F.col("l_linestatus").alias("BUSINESS_ASSOCIATION"),
        F.nullif(group, F.lit("")).alias("OCCUPANCY_GROUP"),
        F.col("p_brand").alias("CONSTRUCTION_TYPE"),
        nan_if(line == 7, money("l_extendedprice")).alias("SUBMITTED_VALUATION"),
        nan_if(F.col("l_linestatus") == "O", money("o_totalprice")).alias("FINAL_VALUATION"),
        text(F.rint(F.col("l_tax") * 100).cast("int")).alias("NEW_UNITS"),
        nan_if(line == 6, (F.col("l_quantity") * 10).cast("int")).alias("TOTAL_SQFT"),
        text(F.col("p_size") % 5).alias("STORIES"),
        F.concat(text(F.col("o_custkey")), F.lit(".0")).alias("customer"),
        F.concat(F.lit("-122."), text(F.col("l_suppkey"))).alias("lon"),
        nan_if(line == 2, F.concat(F.lit("45."), text(F.col("l_suppkey")))).alias("lat"),
        text(F.to_date("o_orderdate")).alias("updated_at"),
    )


def cleaned_permits(spark, sf) -> DataFrame:
    return permits.cleaned(permits.typed(raw_permits(spark, sf)))


def flat(df: DataFrame) -> DataFrame:
    return df.withColumn("location", F.col("location.lon") + F.col("location.lat"))


@query
def permits_typed(spark, sf):
    return flat(permits.typed(raw_permits(spark, sf)))


@query
def permits_typed_literal_flag(spark, sf):
    typed = permits.typed(raw_permits(spark, sf), nan_is_area=True)
    return typed.groupBy("has_square_footage").agg(F.count("*").alias("n"), F.count("total_sqft_amt").alias("n_area"))


@query
def permits_cleaned(spark, sf):
    return flat(cleaned_permits(spark, sf))


@query
def permits_by_date(spark, sf):
    return permits.by_date(cleaned_permits(spark, sf), spine(spark), AS_OF)


def _by_category(category: str) -> Query:
    def by_category(spark, sf):
        return permits.by_date_and(cleaned_permits(spark, sf), spine(spark), category, AS_OF)

    by_category.__name__ = f"permits_by_date_and_{category}"
    return by_category


def _rolling_category(category: str) -> Query:
    def rolling_category(spark, sf):
        per_day = permits.by_date_and(cleaned_permits(spark, sf), spine(spark), category, AS_OF)
        return permits.rolling_by(per_day, category, WARMUP_FROM, REPORT_FROM)

    rolling_category.__name__ = f"rolling_permits_by_{category}"
    return rolling_category


for _category in ("function_type", "structure_type", "work_type"):
    query(_by_category(_category))
    query(_rolling_category(_category))


@query
def rolling_permits_timeseries(spark, sf):
    per_day = permits.by_date(cleaned_permits(spark, sf), spine(spark), AS_OF)
    return permits.rolling_series(per_day, WARMUP_FROM, REPORT_FROM)


@query
def this_week_permits(spark, sf):
    return permits.this_week(cleaned_permits(spark, sf), AS_OF)


def landed_again(records: DataFrame) -> DataFrame:
    """Typed records as the landed strings they could have come from."""
    names = {"IVR_NUMBER": "ivr_number", "NEIGHBORHOOD_DISTRICT": "neighborhood_coalition", "lon": "longitude", "lat": "latitude"}
    names |= {c: f"{c.lower()}_at" for c in ("SET_UP", "UNDER_REVIEW", "ISSUED", "FINAL")}
    names |= {c: f"{c.lower()}_amt" for c in ("SUBMITTED_VALUATION", "FINAL_VALUATION", "NEW_UNITS", "TOTAL_SQFT", "STORIES")}
    same = ("APPLICATION_NUMBER", "STATUS", "TYPE", "DESCRIPTION", "WORK", "ADDRESS", "NEIGHBORHOOD", "BUSINESS_ASSOCIATION",
            "OCCUPANCY_GROUP", "CONSTRUCTION_TYPE", "customer")
    names |= {c: c.lower() for c in same}
    return records.select(*[F.col(old).cast("string").alias(new) for new, old in names.items()])


@query
def permit_tables(spark, sf):
    """Stored models after three batches: some permits come wrong first, some again and some too late to count."""
    tables = stored.PermitTables(
        spark, fresh_dir(spark, "permit-tables"), start=SPINE_START, warmup_from=WARMUP_FROM, report_from=REPORT_FROM, buckets=FEW_BUCKETS
    )
    # Written in between, so that the shuffles of the lookups are gone before the records are shuffled.
    records = written(permits.primary(permits.typed(raw_permits(spark, sf))), "records")
    last = dedup.first_per_key(records, ["ivr_number"], permits.cleaning_order(records))
    right = written(landed_again(last), "landed")
    remove(records)
    # The shipped date, the area and the kind of application of the wrong ones are others.
    moved = F.date_add(F.col("ISSUED").try_cast("date"), 40).cast("string")
    wrong = right.withColumns({"ISSUED": F.coalesce(moved, F.lit("1996-02-29")), "TOTAL_SQFT": F.lit("90000"), "TYPE": F.lit("Assembly")})
    wrong = wrong.withColumn("APPLICATION_NUMBER", F.when(F.col("customer") % 2 == 0, "none").otherwise(F.col("APPLICATION_NUMBER")))
    key = F.col("IVR_NUMBER").cast("bigint")
    batches = [
        right.where(key % 3 != 0).withColumn("updated_at", F.lit("2002-01-02")).unionByName(
            wrong.where(key % 15 == 0).withColumn("updated_at", F.lit("2002-01-01"))),
        right.where(key % 3 == 0).withColumn("updated_at", F.lit("2002-01-03")),
        right.where(key % 50 == 0).withColumn("updated_at", F.lit("2002-01-05")).unionByName(
            wrong.where(key % 100 == 1).withColumn("updated_at", F.lit("2001-01-01"))),
    ]
    for number, batch in enumerate(batches):
        tables.apply(batch, str(number), AS_OF)
    return tables.read("permits_by_date")


def loaded_permits(spark, sf) -> DataFrame:
    raw = raw_permits(spark, sf)
    return raw.select(
        F.col("NEIGHBORHOOD").alias("neighborhood"),
        F.col("SUBMITTED_VALUATION").alias("submitted_valuation"),
        F.col("ISSUED").alias("issued"),
    )


@query
def top_neighborhoods(spark, sf):
    return permits.top_neighborhoods(loaded_permits(spark, sf)).withColumn(
        "avg_valuation", F.round("avg_valuation", 4)
    )


@query
def issued_by_neighborhood(spark, sf):
    return permits.issued_by_neighborhood(loaded_permits(spark, sf))


# --- the three ingest jobs


@query
def permit_ingest(spark, sf):
    """Permit records landed as CSV per event-date type and year, mapped, staged and merged."""
    folder = fresh_dir(spark, "permit-ingest")
    raw = raw_permits(spark, sf)
    projected = raw.withColumns(
        {
            "X_WEB_MERCATOR": (F.lit(-13655000) + F.substring("APPLICATION_NUMBER", 1, 11).cast("int")).cast("string"),
            "Y_WEB_MERCATOR": F.when(F.col("lat") == "nan", "nan").otherwise("5703000"),
        }
    )
    columns = [spec.path for spec in ingest.PERMIT_COLUMNS if spec.path] + ["X_WEB_MERCATOR", "Y_WEB_MERCATOR"]
    slices = F.array(
        *[
            F.struct(F.lit(stage).alias("date_type"), F.trunc(F.col(at).try_cast("date"), "year").alias("slice_date"))
            for stage, at in {"review": "UNDER_REVIEW", "issued": "ISSUED", "final": "FINAL"}.items()
        ]
    )
    landing = projected.select(*columns, F.inline(slices)).where("slice_date is not null")
    # A slice carries only its own event date, as the feed's answers would before the others exist.
    for stage, at in {"review": "UNDER_REVIEW", "issued": "ISSUED", "final": "FINAL"}.items():
        landing = landing.withColumn(at, F.when(F.col("date_type") == stage, F.col(at)).otherwise(F.lit("nan")))
    with shuffles_removed(spark):
        landing.write.partitionBy("date_type", "slice_date").option("header", True).csv(f"{folder}/landing")
    rows = ingest.permit_rows(spark, f"{folder}/landing")
    merged = ingest.ingest_permits(rows, f"{folder}/staging", "2002-01-01", FEW_BUCKETS, "all")
    remove_folder(spark, f"{folder}/landing")  # only what is staged is read from here on
    return merged.select(
        "ivr_number", "application_number", "under_review", "issued", "final", "work", "total_sqft",
        "submitted_valuation", F.round("lon", 9).alias("lon"), F.round("lat", 9).alias("lat"),
    )


@query
def listing_ingest(spark, sf):
    """Pages rendered from customers: listing cards per market segment and their detail pages."""
    # Dealt to many tasks: a small file is one task, and a row of it becomes a page to parse.
    customer = table(spark, sf, "customer").repartition("c_custkey")
    link = F.concat(F.lit("/apa/"), F.col("c_custkey").cast("string"))
    missing = F.col("c_nationkey") == 3
    card = F.concat(
        F.lit('<li class="cl-static-search-result" title="'), F.col("c_name"), F.lit('"><a href="'),
        F.when(F.col("c_nationkey") == 5, "").otherwise(link), F.lit('"><div class="price">$'),
        F.floor(F.abs("c_acctbal")).cast("string"), F.lit('</div><div class="location"> N&amp;'),
        F.col("c_nationkey").cast("string"), F.lit(" </div></a></li>"),
    )
    part = F.floor(F.col("c_custkey") / 100)
    cards = customer.groupBy(F.col("c_mktsegment").alias("region"), part.alias("page")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", card.alias("card")))),
                                 lambda c: c["card"]), "").alias("html")
    )
    detail = F.concat(
        F.lit('<time class="date" datetime="2024-01-'), F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0"),
        F.lit('"></time><p class="attrgroup"><span class="attr">'), (F.col("c_nationkey") % 4).cast("string"),
        F.lit('BR / 1Ba</span><span class="attr">'), F.col("c_custkey").cast("string"),
        F.lit('ft<sup>2</sup></span></p><div id="map" data-latitude="45.5" data-longitude="-122.'),
        F.col("c_nationkey").cast("string"), F.lit('"></div><section id="postingbody"><div class="print-qrcode-container">'
        '<div>QR</div></div>Home of <b>'), F.col("c_name"), F.lit("</b></section>"),
    )
    details = customer.where(~missing).select(link.alias("url"), detail.alias("html"))
    path = fresh_dir(spark, "listings")
    ingest.ingest_listings(ingest.listing_rows(cards.drop("page"), details), path, "2024-01-31")
    return spark.read.parquet(path)


@query
def listing_medians(spark, sf):
    listings = table(spark, sf, "customer").select(
        F.col("c_mktsegment").alias("region"),
        F.when(F.col("c_nationkey") == 3, "nan").otherwise(money("c_acctbal").cast("string")).alias("price"),
        F.when(F.col("c_nationkey") == 5, "nan").otherwise(F.col("c_custkey").cast("string")).alias("sqft"),
    )
    return ingest.listing_medians(listings).withColumn("median_rent", F.round("median_rent", 4))


def daily_payloads(rows: DataFrame) -> DataFrame:
    """One weather payload per user and month of ``user_id, day, high, low, n`` rows."""
    month = F.trunc("day", "month")
    values = F.array_sort(F.collect_list(F.struct("day", "high", "low", "n")))
    packed = rows.groupBy("user_id", month.alias("month")).agg(values.alias("v"))
    daily = F.struct(
        F.transform("v.day", lambda d: d.cast("string")).alias("time"),
        F.col("v.high").alias("temperature_2m_max"),
        F.col("v.low").alias("temperature_2m_min"),
        F.col("v.n").alias("precipitation_sum"),
        F.transform("v.n", lambda n: n * 2).alias("windspeed_10m_max"),
    )
    return packed.select(
        F.concat(F.lit("city"), F.col("user_id").cast("string")).alias("city"),
        F.to_json(F.struct(daily.alias("daily"))).alias("payload"),
    )


def event_days(spark, sf) -> DataFrame:
    return table(spark, sf, "events").groupBy(F.col("user_id"), F.to_date("ts").alias("day")).agg(
        F.max("value").alias("high"), F.min("value").alias("low"), F.count("*").cast("double").alias("n")
    )


@query
def weather_ingest(spark, sf):
    """Daily payloads per user rendered from events, loaded twice with changed values, upserted by id."""
    path = fresh_dir(spark, "weather")
    days = event_days(spark, sf)
    ingest.ingest_weather(ingest.weather_rows(daily_payloads(days)), path, "2024-02-01", FEW_BUCKETS, "0")
    late = days.where(F.col("day") >= F.lit("2024-01-20").cast("date")).withColumn("n", F.col("n") + 100)
    return ingest.ingest_weather(ingest.weather_rows(daily_payloads(late)), path, "2024-02-02", FEW_BUCKETS, "1")


@query
def ingest_report(spark, sf):
    """What one ingest of payloads counts while it writes: some are cut off, some lack their city, all come twice."""
    payloads = daily_payloads(event_days(spark, sf))
    user = F.substring("city", 5, 20).cast("bigint")
    cut = F.when(user % 7 == 3, F.substring("payload", 1, 40)).otherwise(F.col("payload"))
    landed_as = payloads.select(F.when(user % 11 != 5, F.col("city")).alias("city"), cut.alias("payload"))
    counts: dict = {}
    ingest.ingest_weather_payloads(
        landed_as.unionByName(landed_as), fresh_dir(spark, "weather-report"), counts, "2024-02-01", FEW_BUCKETS, "0"
    )
    return spark.createDataFrame(sorted(counts.items()), "measure string, n bigint")


@query
def permit_key_checks(spark, sf):
    """Rows, null keys and repeated keys of the permit records as landed and as cleaned."""
    models = {name: quality.key_report(QUERIES[name](spark, sf), ["ivr_number"]) for name in ("permits_typed", "permits_cleaned")}
    typed, cleaned = [report.select(F.lit(name).alias("model"), "*") for name, report in models.items()]
    return typed.unionByName(cleaned)
