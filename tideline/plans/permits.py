"""Permit models: landed strings to typed, cleaned, daily and trailing tables.

Each model is a function of the datasets it depends on, so the dependency graph is
plain function composition. Write ``cleaned`` once (``sinks.plain.full_refresh``) when
several rollups are wanted; it has five consumers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions import dates as D
from tideline.functions import geo
from tideline.functions import typing as ty
from tideline.functions.rules import Rule, categorise
from tideline.operators import dedup, report, rolling, rollup
from tideline.session import written

# Categories, the type names and occupancy codes they cover, in rule order.
WORK_RULES = [Rule("Addition/Alteration", equals={"work": ["Addition", "Alteration"]})]

STRUCTURE_RULES = [
    Rule(
        "Rowhouse, Townhouse, Duplex",
        equals={
            "type": [
                "Townhouse (3 or more units)",
                "Townhouse (2 Units)",
                "Duplex",
                "Rowhouse (2 units)",
                "Rowhouse (3 or more units)",
            ]
        },
    ),
    Rule("Apartments", equals={"type": ["Apartments/Condos (3 or more units)"]}),
    Rule("Single Family Detached", equals={"type": ["Single Family Dwelling", "Floating Home"]}),
    Rule(
        "Accessory Structures",
        equals={"type": ["Accessory Structure", "Decks, Fences, Retaining Walls", "Garage/Carport"]},
    ),
]

FUNCTION_RULES = [
    Rule(
        "Commercial",
        equals={"type": ["Assembly", "Hotel/Motel"]},
        prefixes={("occupancy_group", 1): ["A", "M", "R-1"]},
    ),
    Rule("Office", equals={"type": ["Business", "Building"]}, prefixes={("occupancy_group", 1): ["B"]}),
    Rule("School", equals={"type": ["Educational", "School"]}, prefixes={("occupancy_group", 1): ["E"]}),
    Rule(
        "Industrial",
        equals={"type": ["Factory/Industrial", "Hazardous"]},
        prefixes={("occupancy_group", 1): ["F", "H"]},
    ),
    Rule("Healthcare", prefixes={("occupancy_group", 1): ["I"]}),
    Rule(
        "Residential",
        equals={
            "type": [
                "Garage/Carport",
                "Accessory Structure",
                "Townhouse (3 or more units)",
                "Accessory Dwelling Unit",
                "Duplex",
                "Decks, Fences, Retaining Walls",
                "Townhouse (2 Units)",
                "Floating Home",
                "Single Family Dwelling",
                "Rowhouse (2 units)",
                "Rowhouse (3 or more units)",
            ]
        },
        prefixes={("occupancy_group", 1): ["R"], ("type", 10): ["Apartments"]},
    ),
    Rule(
        "Utility, Storage, Parking, Special",
        equals={"type": ["Mechanical", "Utility", "Storage"]},
        prefixes={("occupancy_group", 2): ["U", "S-", "SR"]},
    ),
]

# The mark of a primary application, closed states, smallest area in category rollups.
PRIMARY_MARK = "-000-"
PRIMARY_MARK_AT = 12
CLOSED_STATUSES = ["Expired", "Abandoned"]
CATEGORY_MIN_SQFT = 100

# The landed event times.
TIMES = ("SET_UP", "UNDER_REVIEW", "ISSUED", "FINAL")

# First calendar day, start of the window's input, start of the reported series.
CALENDAR_START = "2009-01-01"
WARMUP_FROM = "2010-01-01"
REPORT_FROM = "2011-01-01"


def typed(raw: DataFrame, loaded_at: str = "updated_at", nan_is_area: bool = False) -> DataFrame:
    """String warehouse rows to typed records.

    ``loaded_at`` is the load-time column, in and out. ``nan_is_area`` keeps the literal
    flag under which a missing area (NaN) has square footage.
    """

    def number(name: str) -> Column:
        return ty.strict_double(F.col(name))

    literal = [ty.positive_flag_nan_high(F.col("TOTAL_SQFT").cast("double")).alias("has_square_footage")]
    # One lambda for all times: written out per column they would make a method too large for the JVM to compile.
    times = F.transform(F.array(*[F.col(c).cast("string") for c in (*TIMES, loaded_at)]), ty.try_timestamp)
    parsed = raw.withColumn("_times", times).select(
        ty.try_int(F.col("IVR_NUMBER")).alias("ivr_number"),
        F.col("APPLICATION_NUMBER").alias("application_number"),
        F.col("STATUS").alias("status"),
        F.col("TYPE").alias("type"),
        F.col("DESCRIPTION").alias("description"),
        ty.null_if_marker(F.col("WORK")).alias("work"),
        F.col("ADDRESS").alias("address"),
        *[F.col("_times")[i].alias(f"{c.lower()}_at") for i, c in enumerate(TIMES)],
        F.col("NEIGHBORHOOD").alias("neighborhood"),
        F.col("NEIGHBORHOOD_DISTRICT").alias("neighborhood_coalition"),
        *[F.col(c).alias(c.lower()) for c in ("BUSINESS_ASSOCIATION", "OCCUPANCY_GROUP", "CONSTRUCTION_TYPE")],
        *[
            number(c).alias(f"{c.lower()}_amt")
            for c in ("SUBMITTED_VALUATION", "FINAL_VALUATION", "NEW_UNITS", "TOTAL_SQFT")
        ],
        *(literal if nan_is_area else []),
        number("STORIES").alias("stories_amt"),
        ty.try_int(F.col("customer")).alias("customer"),
        number("lon").alias("longitude"),
        number("lat").alias("latitude"),
        F.col("_times")[len(TIMES)].alias(loaded_at),
    )
    # Built on the parsed numbers, so that no text is parsed twice.
    if not nan_is_area:
        parsed = parsed.withColumn("has_square_footage", ty.positive_flag(F.col("total_sqft_amt")))
    return parsed.withColumn("location", geo.point(F.col("longitude"), F.col("latitude")))


def primary(records: DataFrame) -> DataFrame:
    """Records of primary applications."""
    return records.where(is_primary())


def is_primary() -> Column:
    return F.substring("application_number", PRIMARY_MARK_AT, len(PRIMARY_MARK)) == PRIMARY_MARK


def cleaning_order(records: DataFrame) -> list[Column]:
    """The record whose later of issue and review time is earliest comes first; the other columns break ties."""
    ties = [name for name in records.columns if name not in {"ivr_number", "location"}]
    return [c.asc_nulls_last() for c in (F.greatest("issued_at", "under_review_at"), *[F.col(name) for name in ties])]


def cleaned(records: DataFrame, loaded_at: str = "updated_at") -> DataFrame:
    """Primary applications, one per key, with categories, durations and ratios.

    Of several records the one whose later of issue and review time is earliest is kept,
    those without either last; the other columns break ties.
    """
    return facts(dedup.first_per_key(primary(records), ["ivr_number"], cleaning_order(records)), loaded_at)


def facts(kept: DataFrame, loaded_at: str = "updated_at") -> DataFrame:
    """Categories, durations and ratios of records that are primary applications, one per key."""
    times = [F.col(name) for name in ("set_up_at", "under_review_at", "issued_at", "final_at")]
    value = F.coalesce("final_valuation_amt", "submitted_valuation_amt")
    return kept.select(
        "ivr_number",
        "application_number",
        "status",
        "type",
        "description",
        categorise(WORK_RULES, F.col("work")).alias("work_type"),
        "address",
        *times,
        D.latest_of(*times).alias("last_status_update_at"),
        D.days_between(F.col("set_up_at"), F.col("issued_at")).alias("days_to_issue"),
        D.days_between(F.col("issued_at"), F.col("final_at")).alias("days_to_final"),
        "neighborhood",
        "neighborhood_coalition",
        "business_association",
        "occupancy_group",
        "construction_type",
        value.alias("value"),
        ty.ratio(value, F.col("total_sqft_amt")).alias("dollars_per_sf"),
        ty.ratio(F.col("total_sqft_amt"), F.col("stories_amt")).alias("sf_per_story"),
        "new_units_amt",
        "total_sqft_amt",
        "has_square_footage",
        "stories_amt",
        "customer",
        "longitude",
        "latitude",
        "location",
        categorise(STRUCTURE_RULES, F.col("type")).alias("structure_type"),
        categorise(FUNCTION_RULES, F.col("type")).alias("function_type"),
        loaded_at,
    )


def _issued(pick) -> dict[str, Column]:
    """Measures of issued permits. ``final_valuation_*`` columns count rows with a value."""
    days = F.col("days_to_issue")
    return {
        "total_sqft_issued_amt": F.sum(pick(F.col("total_sqft_amt"))),
        "total_new_units_issued_amt": F.sum(pick(F.col("new_units_amt"))),
        "count_permits_issued": F.count(pick(F.col("ivr_number"))),
        "count_permits_issued_w_sqft": F.count(pick(F.col("total_sqft_amt"))),
        "final_valuation_issued_amount": F.count(pick(F.col("value"))),
        "avg_days_to_issue": F.avg(pick(days)),
        "sum_days_to_issue": F.sum(pick(days)),
        "sum_days_to_issue_w_new_units": F.sum(pick(F.when(F.col("new_units_amt") > 0, days))),
    }


def _reviewed(pick, date: Column, as_of: D.AsOf) -> dict[str, Column]:
    """Measures of permits entering review; "waiting" looks at these rows alone."""
    waiting = D.is_open_on(date, F.col("set_up_at"), F.col("issued_at"), as_of)
    waiting = waiting & ~F.col("status").isin(*CLOSED_STATUSES)
    return {
        "total_sqft_review_amt": F.sum(pick(F.col("total_sqft_amt"))),
        "total_new_units_review_amt": F.sum(pick(F.col("new_units_amt"))),
        "total_sqft_waiting_approval": F.sum(pick(F.when(waiting, F.col("total_sqft_amt")))),
        "total_new_units_waiting_approval": F.sum(pick(F.when(waiting, F.col("new_units_amt")))),
        "count_permits_review": F.count(pick(F.col("ivr_number"))),
        "count_permits_review_w_sqft": F.count(pick(F.col("total_sqft_amt"))),
        "final_valuation_review_amount": F.count(pick(F.col("value"))),
    }


def _finalised(pick) -> dict[str, Column]:
    units = F.sum(pick(F.col("new_units_amt")))
    return {
        "total_sqft_final_amt": F.sum(pick(F.col("total_sqft_amt"))),
        "total_new_units_final_amt": units,
        "total_new_units_amt": units,
        "count_permits_final": F.count(pick(F.col("ivr_number"))),
        "count_permits_final_w_sqft": F.count(pick(F.col("total_sqft_amt"))),
        "final_valuation_amount": F.count(pick(F.col("value"))),
    }


# Issue-day measures that stay null on a day without facts; every other measure except the
# waiting sums is zero there.
_NULL_WHEN_EMPTY = {
    "total_sqft_issued_amt",
    "total_new_units_issued_amt",
    "avg_days_to_issue",
    "total_sqft_waiting_approval",
    "total_new_units_waiting_approval",
}


def _zero_filled(names) -> list[str]:
    return [name for name in names if name not in _NULL_WHEN_EMPTY]


def _with_issue_ratios(df: DataFrame) -> DataFrame:
    """The two helper sums become days per issued area and per issued new unit."""
    ratios = {
        "days_to_issue_sqft": ty.ratio(F.col("sum_days_to_issue"), F.col("total_sqft_issued_amt")),
        "days_to_issue_new_units": ty.ratio(F.col("sum_days_to_issue_w_new_units"), F.col("total_new_units_issued_amt")),
    }
    return df.withColumns(ratios).drop("sum_days_to_issue", "sum_days_to_issue_w_new_units")


def by_date(facts: DataFrame, calendar: DataFrame, as_of: D.AsOf = None) -> DataFrame:
    """Per calendar day: permits issued, entering review and finalised that day.

    The three event times come from one scan of the facts and one shuffle of day-grain rows.
    """
    measures = {
        "issued": _issued(lambda c: rollup.on_stage("issued", c)),
        "review": _reviewed(lambda c: rollup.on_stage("review", c), F.col("date"), as_of),
        "final": _finalised(lambda c: rollup.on_stage("final", c)),
    }
    times = {"issued": F.col("issued_at"), "review": F.col("under_review_at"), "final": F.col("final_at")}
    daily = rollup.stages_daily(facts, times, measures)
    names = [name for stage in measures.values() for name in stage]
    return _with_issue_ratios(rollup.on_spine(calendar, daily, zero=_zero_filled(names)))


def category_days(facts: DataFrame, categories: Sequence[str], as_of: D.AsOf = None) -> DataFrame:
    """Per day, stage and value of each category: permits issued and entering review, large areas only.

    All categories come from one scan of the facts; store it when more than one model is wanted.
    """
    measures = {
        "issued": _issued(lambda c: rollup.on_stage("issued", c)),
        "review": _reviewed(lambda c: rollup.on_stage("review", c), F.col("date"), as_of),
    }
    times = {"issued": F.col("issued_at"), "review": F.col("under_review_at")}
    large = facts.where(F.col("total_sqft_amt") > CATEGORY_MIN_SQFT)
    return rollup.stages_by_category(large, times, measures, categories)


def by_category(days: DataFrame, calendar: DataFrame, category: str, coalesce_date: bool = False) -> DataFrame:
    """Per calendar day and value of one category, out of ``category_days``.

    Literal full-join rows: a review without an issue of its category that day has a null
    date unless ``coalesce_date`` is set.
    """

    def side(stage: str, names: Sequence[str]) -> DataFrame:
        of = days.where((F.col("kind") == category) & (F.col("stage") == stage))
        of = of.select("date", F.col("value").alias(category), *names)
        return rollup.on_spine(calendar, of, zero=_zero_filled(names))

    left = side("issued", list(_issued(lambda c: c)))
    right = side("review", list(_reviewed(lambda c: c, F.col("date"), None)))
    return _with_issue_ratios(rollup.full_combine(calendar, left, right, category, coalesce_date=coalesce_date))


def by_date_and(
    facts: DataFrame, calendar: DataFrame, category: str, as_of: D.AsOf = None, coalesce_date: bool = False
) -> DataFrame:
    """``by_category`` of a single category. Its day rows are written to the shared folder, so the facts are read once."""
    return by_category(written(category_days(facts, [category], as_of), "category-days"), calendar, category, coalesce_date)


def rolling_series(
    per_day: DataFrame, warmup_from: D.AsOf = WARMUP_FROM, report_from: D.AsOf = REPORT_FROM, rows: int = 366
) -> DataFrame:
    """Trailing means and the trailing number of issued permits."""
    measures = {
        "total_sqft_issued_amt": F.avg("total_sqft_issued_amt"),
        "total_new_units_issued_amt": F.avg("total_new_units_issued_amt"),
        "count_permits_issued": F.avg("count_permits_issued"),
        "count_total_permits_issued": F.sum("count_permits_issued"),
    }
    return rolling.trailing_series(per_day, measures, warmup_from, report_from, rows)


def rolling_by(
    per_day: DataFrame,
    category: str,
    warmup_from: D.AsOf = WARMUP_FROM,
    report_from: D.AsOf = REPORT_FROM,
    rows: int = 366,
) -> DataFrame:
    """Trailing mean of issued area per category, as ``(date, type, value)``."""
    return rolling.trailing_by_category(
        per_day, category, "total_sqft_issued_amt", warmup_from, report_from, rows
    )


def this_week(facts: DataFrame, as_of: D.AsOf = None, days_back: int = 7) -> DataFrame:
    """Permits issued in the recent window, newest and largest first."""
    recent = facts.where(report.within_days(F.col("issued_at"), as_of, days_back) & (F.col("total_sqft_amt") > 0))
    return recent.select(
        F.col("structure_type").alias("Structure"),
        F.to_date("under_review_at").alias("Submitted"),
        F.to_date("issued_at").alias("Issued"),
        F.col("work_type").alias("Type_of_Work"),
        F.col("function_type").alias("Building_Function"),
        F.col("total_sqft_amt").alias("New_Square_Feet"),
        F.col("stories_amt").alias("Buildings_Stories"),
        F.col("new_units_amt").alias("New_Residential_Units"),
        F.col("value").alias("Construction_Value"),
        F.col("description").alias("Description"),
    ).orderBy(
        F.desc_nulls_last("Issued"),
        ty.round_to_int(F.col("New_Square_Feet")).desc_nulls_last(),
        # Beyond the report's order, so that ties fall the same way and a sort range can be split.
        F.asc_nulls_last("Construction_Value"),
        F.asc_nulls_last("Description"),
    )


def top_neighborhoods(loaded: DataFrame, limit: int = 20) -> DataFrame:
    """Neighbourhoods with the most permits and their mean submitted value."""
    return report.group_summary(
        loaded.where(ty.not_marker(F.col("submitted_valuation"))),
        ["neighborhood"],
        {"permits": F.count("*"), "avg_valuation": F.avg(F.col("submitted_valuation").cast("double"))},
        [F.desc("permits"), F.asc_nulls_last("neighborhood")],
        limit,
    )


def issued_by_neighborhood(loaded: DataFrame) -> DataFrame:
    """Number of issued permits per neighbourhood."""
    return report.group_summary(
        loaded.where(ty.not_marker(F.col("issued"))),
        ["neighborhood"],
        {"permits": F.count("*")},
        [F.desc("permits"), F.asc_nulls_last("neighborhood")],
    )
