"""The permit models as stored tables, kept up to date batch by batch.

``apply`` takes a batch of landed records through all models. Records and cleaned permits are keyed by permit; the
daily tables hold slices of a day, which a batch replaces whole. From the cleaned rows of the batch's permits before
and after it follow the days whose figures can change; those are computed anew from the cleaned table, and the
trailing series on the days that have one of them in their frame. Nothing is added to or taken from a stored figure,
so the tables are those that a full refresh would give. Every table is appended to and merges when it is
read (``sinks.keyed``), so a batch writes its own permits and the touched days only, and one that dies is
repeated under its name.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions import dates as D
from tideline.operators import calendar
from tideline.plans import permits
from tideline.session import remove, shuffles_removed, written
from tideline.sinks import keyed

KEY = "ivr_number"
CATEGORIES = ("function_type", "structure_type", "work_type")
#: Rows of a trailing frame, one a day.
FRAME = 366
#: All stored tables, in the order in which a batch reaches them.
TABLES = (
    "permits",
    "permits_cleaned",
    "permits_by_date",
    "permits_by_category",
    "rolling_permits_timeseries",
    "rolling_permits_by_category",
)


def _events(cleaned: DataFrame) -> DataFrame:
    """Days on which permits are issued, enter review or are finalised."""
    days = F.array(*[F.to_date(c) for c in ("issued_at", "under_review_at", "final_at")])
    return cleaned.select(F.explode(days).alias("date")).where("date is not null")


def _on_days(cleaned: DataFrame, days: DataFrame) -> DataFrame:
    """Permits with an event on one of the days, which the calendar bounds."""
    times = ("issued_at", "under_review_at", "final_at")
    for at in times:
        wanted = F.broadcast(days.select(F.col("date").alias(f"_{at}"), F.lit(True).alias(f"_on_{at}")))
        cleaned = cleaned.withColumn(f"_{at}", F.to_date(at)).join(wanted, f"_{at}", "left").drop(f"_{at}")
    flags = [f"_on_{at}" for at in times]
    return cleaned.where(F.coalesce(*flags, F.lit(False))).drop(*flags)


def _slices(spark: SparkSession, path: str, rows: DataFrame, batch: str, keys: Sequence[str] = ("day",)) -> None:
    """Figures of a batch that is through are not computed again: sums may differ in their last bits."""
    if not keyed.has_batch(spark, path, batch):
        keyed.upsert(spark, path, rows, list(keys), [], batch=batch, slices=True)


def _near(days: DataFrame, before: int, after: int) -> DataFrame:
    """The days and those around them."""
    around = F.sequence(F.date_sub("date", before), F.date_add("date", after))
    return days.select(F.explode(around).alias("date")).distinct()


class PermitTables:
    """Stored permit models below one folder. Records without a permit number cannot be kept up to date and are left out."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        loaded_at: str = "updated_at",
        start: D.AsOf = permits.CALENDAR_START,
        warmup_from: D.AsOf = permits.WARMUP_FROM,
        report_from: D.AsOf = permits.REPORT_FROM,
        buckets: int = keyed.BUCKETS,
    ):
        self.spark, self.root, self.loaded_at, self.buckets = spark, root, loaded_at, buckets
        self.start, self.warmup_from, self.report_from = start, warmup_from, report_from

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _stored(self, name: str, like: DataFrame, keys: DataFrame) -> DataFrame:
        """Rows of some keys of a table as it stands, empty before the first batch."""
        path = self.path(name)
        return keyed.read_keyed(self.spark, path, keys) if keyed.is_table(self.spark, path) else like.limit(0)

    def read(self, name: str, as_of: D.AsOf = None) -> DataFrame:
        """A model as its plan function gives it: ``permits_cleaned``, ``permits_by_date``, ``permits_by_date_and_<category>``,
        ``rolling_permits_timeseries`` or ``rolling_permits_by_<category>``."""
        if name.startswith("rolling_permits_by_"):
            return self._rolling_by_category().where(F.col("kind") == name.removeprefix("rolling_permits_by_")).drop("kind")
        if name.startswith("permits_by_date_and_"):
            days = keyed.read_keyed(self.spark, self.path("permits_by_category")).where("kind is not null")
            return permits.by_category(days, self._calendar(as_of), name.removeprefix("permits_by_date_and_"))
        table = keyed.read_keyed(self.spark, self.path(name))
        if name == "permits_cleaned":
            return table.where("_kept").drop("_kept")
        return table.drop("day", "_as_of")

    def _calendar(self, as_of: D.AsOf) -> DataFrame:
        return calendar.calendar_days(self.spark, self.start, as_of)

    def apply(self, raw: DataFrame, batch: str, as_of: D.AsOf = None) -> None:
        """Take landed records through all models; a permit's latest record by load time replaces earlier ones.

        The calendar ends a year after ``as_of``, which must not go back. A batch must be through before the next one
        starts; one that is through changes nothing when it comes again.
        """
        typed = permits.typed(raw, self.loaded_at).where(F.col(KEY).isNotNull())
        keyed.upsert(self.spark, self.path("permits"), typed, [KEY], [self.loaded_at], buckets=self.buckets, batch=batch)
        if keyed.has_batch(self.spark, self.path(TABLES[-1]), batch):
            return
        touched = self._clean(typed, batch, as_of)
        self._daily(touched, batch, as_of)
        self._trailing(touched, batch, as_of)

    def _clean(self, typed: DataFrame, batch: str, as_of: D.AsOf) -> DataFrame:
        """Clean the batch's permits; the days whose figures can change."""
        keys = written(typed.select(KEY).distinct(), "batch-keys")
        own = keyed.is_only_batch(self.spark, self.path("permits"), batch)
        records = keyed.read_keyed(self.spark, self.path("permits"), None if own else keys)
        # The first batch's records are read from where they are stored.
        records = records if own else written(records, "batch-records")
        # The stored table has one record per permit, so nothing is shuffled to clean them.
        after = permits.facts(permits.primary(records), self.loaded_at).withColumn("_kept", F.lit(True))
        # A permit whose latest record is no primary application any more leaves the models.
        gone = records.where(~F.coalesce(permits.is_primary(), F.lit(False))).select(KEY, self.loaded_at, F.lit(False).alias("_kept"))
        after = written(after.unionByName(gone, allowMissingColumns=True), "cleaned")
        if not own:
            remove(records)
        before = self._stored("permits_cleaned", after, keys).where("_kept")
        changed = _events(before.unionByName(after.where("_kept"))).distinct()
        # What earlier days know only of days after them changes with the day the tables are computed for.
        days = self._calendar(as_of)
        if keyed.is_table(self.spark, self.path("permits_by_date")):
            known = keyed.read_keyed(self.spark, self.path("permits_by_date")).groupBy(F.col("day").alias("date")).agg(F.max("_as_of").alias("_as_of"))
            last = known.agg(F.max("_as_of")).scalar()
            days = days.join(known, "date", "left").where(F.col("_as_of").isNull() | ((F.col("date") >= last) & (last < D.day(as_of)))).select("date")
        # Written before the cleaned rows, so that a repeat of a batch that has died finds the same days.
        place = f"{self.root}/touched/{batch}"
        if not keyed.finished(self.spark, place):
            touched = changed.unionByName(days).distinct().join(F.broadcast(self._calendar(as_of)), "date", "left_semi")
            with shuffles_removed(self.spark):
                touched.write.mode("overwrite").parquet(place)
        keyed.upsert(self.spark, self.path("permits_cleaned"), after, [KEY], [self.loaded_at], buckets=self.buckets, batch=batch, unique=True)
        remove(keys, after)
        return self.spark.read.schema("date date").parquet(place)

    def _daily(self, touched: DataFrame, batch: str, as_of: D.AsOf) -> None:
        facts = _on_days(self.read("permits_cleaned"), touched)
        per_day = permits.by_date(facts, touched, as_of)
        stamped = per_day.withColumns({"day": F.col("date"), "_as_of": D.day(as_of)})
        by_category = permits.category_days(facts, CATEGORIES, as_of).join(F.broadcast(touched), "date", "left_semi")
        # A day that has no row of its own any more is replaced by one without a kind.
        empty = touched.withColumn("kind", F.lit(None).cast("string"))
        slices = by_category.unionByName(empty, allowMissingColumns=True).withColumn("day", F.col("date"))
        _slices(self.spark, self.path("permits_by_category"), slices, batch)
        _slices(self.spark, self.path("permits_by_date"), stamped, batch)

    def _trailing(self, touched: DataFrame, batch: str, as_of: D.AsOf) -> None:
        """Trailing series on days with a touched day in their frame, from the days of their frames."""
        wanted = _near(touched, 0, FRAME - 1)
        needed = F.broadcast(_near(wanted, FRAME - 1, 0))
        per_day = self.read("permits_by_date").join(needed, "date", "left_semi")
        series = permits.rolling_series(per_day, self.warmup_from, self.report_from, FRAME)
        series = series.join(F.broadcast(wanted), "date", "left_semi").withColumn("day", F.col("date"))
        _slices(self.spark, self.path("rolling_permits_timeseries"), series, batch)
        self._trailing_by_category(wanted, needed, batch, as_of)

    def _trailing_by_category(self, wanted: DataFrame, needed: DataFrame, batch: str, as_of: D.AsOf) -> None:
        """A value that comes to a category or goes has a row on every day, so then all its days are computed."""
        issued = "total_sqft_issued_amt"
        sides = [self.read(f"permits_by_date_and_{c}", as_of).select(F.lit(c).alias("kind"), "date", F.col(c).alias("type"), issued) for c in CATEGORIES]
        per_day = written(reduce(DataFrame.unionByName, sides), "per-day")
        values = per_day.where("type is not null").select("kind", "type").distinct()
        changed = set(CATEGORIES)
        if keyed.is_table(self.spark, self.path("rolling_permits_by_category")):
            known = self._rolling_by_category().select("kind", "type").distinct()
            differ = values.exceptAll(known).unionByName(known.exceptAll(values))
            changed = {row.kind for row in differ.select("kind").distinct().collect()}
        parts = []
        for category in CATEGORIES:
            rows, days = per_day.where(F.col("kind") == category).drop("kind"), self._calendar(as_of)
            if category not in changed:
                types = values.where(F.col("kind") == category).select("type")
                rows = rows.join(needed, "date", "left_semi").unionByName(types, allowMissingColumns=True)
                days = wanted
            series = permits.rolling_by(rows.withColumnRenamed("type", category), category, self.warmup_from, self.report_from, FRAME)
            series = series.join(F.broadcast(days), "date", "left_semi")
            # A day without any value any more is replaced by a row without one.
            empty = days.where(F.col("date") > D.day(self.report_from))
            parts.append(series.unionByName(empty, allowMissingColumns=True).withColumns({"kind": F.lit(category), "day": F.col("date")}))
        _slices(self.spark, self.path("rolling_permits_by_category"), reduce(DataFrame.unionByName, parts), batch, ["kind", "day"])

    def _rolling_by_category(self) -> DataFrame:
        return keyed.read_keyed(self.spark, self.path("rolling_permits_by_category")).where("type is not null").drop("day")

    def compact(self) -> None:
        """Merge what the batches have appended; see ``sinks.keyed.compact``."""
        for name in TABLES:
            keyed.compact(self.spark, self.path(name))

    def this_week(self, as_of: D.AsOf = None) -> DataFrame:
        """Recently issued permits out of the stored ones."""
        return permits.this_week(self.read("permits_cleaned"), as_of)
