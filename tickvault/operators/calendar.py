"""Data-derived calendar, gaps and grids.

Day grids are generated with ``sequence`` + ``explode`` from per-series
bounds; minute grids go through a day grid first and are repartitioned
before the minute explode, so a long-lived symbol's grid is spread across
tasks instead of being generated by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import col


def _d(x):
    return F.lit(x).cast("date") if not hasattr(x, "_jc") else x


def trading_days(bars: DataFrame, start=None, end=None, date_col: str = "trading_date") -> DataFrame:
    """G1: distinct dates with bars in [start, end], sorted."""
    d = bars.select(F.col(date_col).alias("trading_date")).filter(F.col("trading_date").isNotNull())
    if start is not None:
        d = d.filter(F.col("trading_date") >= _d(start))
    if end is not None:
        d = d.filter(F.col("trading_date") <= _d(end))
    return d.distinct().orderBy("trading_date")


def session_rows(dates: DataFrame, date_col: str = "trading_date") -> DataFrame:
    """Session attributes: ISO week, month, quarter, is_holiday=false."""
    d = F.col(date_col)
    return dates.select(d.alias("trade_date"), F.weekofyear(d).alias("week"), F.month(d).alias("month"),
                        F.quarter(d).alias("quarter"), F.lit(False).alias("is_holiday"))


def sync_session(existing: DataFrame | None, bars: DataFrame, date_col: str = "trading_date") -> DataFrame:
    """Session rows for bar dates not yet in ``existing`` (anti join)."""
    dates = bars.select(F.col(date_col).alias("trading_date")).filter(F.col("trading_date").isNotNull()).distinct()
    if existing is not None:
        dates = dates.join(existing.select(F.col("trade_date").alias("trading_date")), "trading_date", "left_anti")
    return session_rows(dates)


def sync_session_dry_run(existing: DataFrame | None, bars: DataFrame) -> DataFrame:
    """G2 dry run: count and range of the dates that would be added."""
    new = sync_session(existing, bars)
    return new.agg(F.count(F.lit(1)).alias("new_dates"), F.min("trade_date").alias("first_date"),
                   F.max("trade_date").alias("last_date"))


def session_days(session: DataFrame, start, end) -> DataFrame:
    """Session dates in [start, end], sorted."""
    return session.filter((F.col("trade_date") >= _d(start)) & (F.col("trade_date") <= _d(end))) \
                  .select("trade_date").orderBy("trade_date")


def find_gaps(bars: DataFrame, series: str = "contract_series", date_col: str = "trading_date",
              min_gap_days: int = 3) -> DataFrame:
    """Consecutive dates of a series more than ``min_gap_days`` apart.
    The window is per series over daily rows (bounded by the calendar)."""
    d = bars.select(series, date_col).filter(F.col(date_col).isNotNull()).distinct()
    w = Window.partitionBy(series).orderBy(date_col)
    d = d.withColumn("prev_date", F.lag(date_col).over(w))
    return d.withColumn("gap_days", F.datediff(F.col(date_col), F.col("prev_date"))) \
            .filter(F.col("gap_days") > min_gap_days) \
            .select(series, "prev_date", F.col(date_col).alias("next_date"), "gap_days")


def day_grid(bounds: DataFrame, start_col: str, end_col: str, keys: Sequence[str] = (),
             weekdays_only: bool = False, out: str = "date") -> DataFrame:
    """One row per day in [start, end] per key row of ``bounds``."""
    g = bounds.select(*keys, F.explode(F.sequence(F.col(start_col), F.col(end_col))).alias(out))
    if weekdays_only:
        g = g.filter(F.dayofweek(out).between(2, 6))  # Mon..Fri
    return g


def missing_weekdays(bars: DataFrame, keys: Sequence[str] = ("contract_series",), date_col: str = "trading_date",
                     start=None, end=None) -> DataFrame:
    """Mon-Fri days in each key's range (or [start, end]) without a row."""
    present = bars.select(*keys, F.col(date_col).alias("date")).filter(F.col("date").isNotNull()).distinct()
    if start is None or end is None:
        b = present.groupBy(*keys).agg(F.min("date").alias("_s"), F.max("date").alias("_e"))
    else:
        b = present.select(*keys).distinct().select(*keys, _d(start).alias("_s"), _d(end).alias("_e"))
    grid = day_grid(b, "_s", "_e", keys, weekdays_only=True)
    return grid.join(present, [*keys, "date"], "left_anti")


def missing_session_days(bars: DataFrame, session: DataFrame, keys: Sequence[str] = ("contract_series",),
                         date_col: str = "trading_date") -> DataFrame:
    """G4 with the calendar as a parameter (Q19): session days (e.g. the
    data-derived ``dim_session``) inside each key's own [first, last] range
    on which the key has no row.  A range join of keys x session days is
    avoided: session days are bucketed by month and equi-joined on the months
    each key spans, then filtered to the exact range."""
    present = bars.select(*keys, F.col(date_col).alias("date")).filter(F.col("date").isNotNull()).distinct()
    b = present.groupBy(*keys).agg(F.min("date").alias("_s"), F.max("date").alias("_e"))
    months = b.select(*keys, "_s", "_e", F.explode(F.sequence(F.trunc("_s", "month"), F.trunc("_e", "month"),
                                                             F.expr("INTERVAL 1 MONTH"))).alias("_m"))
    days = session.select(F.col("trade_date").alias("date")).distinct().withColumn("_m", F.trunc("date", "month"))
    grid = months.join(days, "_m").filter(F.col("date").between(F.col("_s"), F.col("_e"))).select(*keys, "date")
    return grid.join(present, [*keys, "date"], "left_anti")


def missing_weekdays_by_month(missing: DataFrame, keys: Sequence[str] = ("contract_series",)) -> DataFrame:
    """G4 report form: missing weekdays counted per key and month."""
    return missing.groupBy(*keys, F.date_format("date", "yyyy-MM").alias("month")) \
                  .agg(F.count(F.lit(1)).alias("missing_days"))


def existing_dates(df: DataFrame, keys: Sequence[str] = (), ts_col: str = "ts_event") -> DataFrame:
    """Distinct loaded dates (UTC date of ``ts_col``) by optional keys."""
    return df.select(*keys, F.to_date(col(ts_col)).alias("date")).filter(F.col("date").isNotNull()).distinct()


def month_complete(expected: DataFrame, loaded: DataFrame, date_col: str = "date") -> DataFrame:
    """Per month, are all expected dates loaded?  One anti join for all
    months at once."""
    e = expected.select(F.col(date_col).alias("date")).distinct()
    missing = e.join(loaded.select(F.col(date_col).alias("date")).distinct(), "date", "left_anti") \
        .withColumn("_missing", F.lit(1))
    j = e.join(missing, "date", "left")
    return j.groupBy(F.date_format("date", "yyyy-MM").alias("month")) \
            .agg(F.count(F.lit(1)).alias("expected_dates"), F.count("_missing").alias("missing_dates")) \
            .withColumn("complete", F.col("missing_dates") == 0)


def normalize_business_daily(obs: DataFrame, start, end, series: str = "series_id",
                             date_col: str = "date", value: str = "value") -> DataFrame:
    """Per series, non-numeric values to null, reindex on the Mon-Fri
    grid of [start, end], forward fill.  Weekend observations are dropped
    before the fill (as the reference does); leading nulls stay; duplicate
    dates keep the last row (D2 by value order is not defined, so the max)."""
    v = F.col(value).cast("string").try_cast("double") if dict(obs.dtypes)[value] == "string" else F.col(value)
    o = obs.select(series, F.col(date_col).alias("date"), v.alias("value")) \
        .groupBy(series, "date").agg(F.max("value").alias("value"))
    keys = o.select(series).distinct().select(series, _d(start).alias("_s"), _d(end).alias("_e"))
    grid = day_grid(keys, "_s", "_e", [series], weekdays_only=True)
    g = grid.join(o, [series, "date"], "left")
    w = Window.partitionBy(series).orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return g.select(series, "date", F.last("value", ignorenulls=True).over(w).alias("value"))


def minute_coverage(quotes: DataFrame, symbol: str = "symbol", ts: str = "ts_event") -> DataFrame:
    """Per symbol minutes present, expected ((last-first)/60s + 1),
    missing, coverage as a fraction, first and last minute -- no grid needed."""
    m = quotes.select(symbol, F.date_trunc("minute", col(ts)).cast("timestamp_ntz").alias("minute"))
    per = m.groupBy(symbol).agg(F.count_distinct("minute").alias("minutes_present"),
                                F.min("minute").alias("first_minute"), F.max("minute").alias("last_minute"))
    span = (F.unix_seconds(F.col("last_minute").cast("timestamp")) - F.unix_seconds(F.col("first_minute").cast("timestamp")))
    exp = (span / 60 + 1).cast("long")
    return per.select(symbol, "minutes_present", exp.alias("minutes_expected"),
                      (exp - F.col("minutes_present")).alias("minutes_missing"),
                      (F.col("minutes_present") / exp).alias("coverage_pct"),
                      F.col("first_minute").alias("first_ts"), F.col("last_minute").alias("last_ts"))


def missing_minutes(quotes: DataFrame, symbol: str = "symbol", ts: str = "ts_event", by_day: bool = False) -> DataFrame:
    """G7 list form: minutes between a symbol's first and last minute with no
    row; with ``by_day`` one row per symbol and ``day`` that lack any, ``minutes``
    being the list as numbers 0 to 1439 of that day.

    Only rows per (symbol, day) are shuffled, a day's present minutes as one
    array; a day's missing ones are the runs between them, made in one task.
    Days are small rows with much work, so they are dealt over a fixed number of
    tasks, which adaptive execution does not merge: a symbol spanning years is
    spread over many."""
    of_day = lambda c: F.hour(c) * 60 + F.minute(c)
    m = quotes.select(symbol, F.date_trunc("minute", col(ts)).cast("timestamp_ntz").alias("minute")).distinct()
    b = m.groupBy(symbol).agg(F.min("minute").alias("_s"), F.max("minute").alias("_e"))
    days = b.select(symbol, "_s", "_e", F.explode(F.sequence(F.to_date("_s"), F.to_date("_e"))).alias("day"))
    there = m.groupBy(symbol, F.to_date("minute").alias("day")).agg(F.collect_list(of_day("minute")).alias("_there"))
    tasks = int(quotes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lo = F.when(F.col("day") == F.to_date("_s"), of_day("_s")).otherwise(0)
    hi = F.when(F.col("day") == F.to_date("_e"), of_day("_e")).otherwise(1439)
    ends = F.array_sort(F.concat(F.array(lo - 1, hi + 1), F.coalesce("_there", F.array().cast("array<int>"))))
    gap = lambda a, b: F.when(b - a > 1, F.sequence(a + 1, b - 1)).otherwise(F.array().cast("array<int>"))
    left = F.flatten(F.zip_with(F.slice("_ends", 1, F.size("_ends") - 1), F.slice("_ends", 2, F.size("_ends") - 1), gap))
    missing = days.repartition(tasks, symbol, "day").join(there, [symbol, "day"], "left").select(symbol, "day", ends.alias("_ends"))
    missing = missing.select(symbol, "day", left.alias("minutes"))
    if by_day:
        return missing.where(F.size("minutes") > 0)
    at = F.make_dt_interval(mins=F.col("_at"))
    return missing.select(symbol, "day", F.explode("minutes").alias("_at")).select(symbol, (F.col("day").cast("timestamp_ntz") + at).alias("minute"))


def day_count_pivot(df: DataFrame, symbol: str = "symbol", ts: str = "ts_event", wide: bool = False) -> DataFrame:
    """Symbol x UTC date row counts; long form (default) or pivoted with
    zero fill (the pivot's distinct dates are collected by Spark first)."""
    d = df.select(symbol, F.to_date(col(ts)).alias("date"))
    if wide:
        return d.groupBy(symbol).pivot("date").count().fillna(0)
    return d.groupBy(symbol, "date").agg(F.count(F.lit(1)).alias("rows"))


def date_overlap(a: DataFrame, b: DataFrame, date_col: str = "trading_date") -> DataFrame:
    """Sizes of the intersection and of both differences of two date sets
    (one full outer join of the distinct dates)."""
    da = a.select(F.col(date_col).alias("d")).filter(F.col("d").isNotNull()).distinct().withColumn("_a", F.lit(1))
    db = b.select(F.col(date_col).alias("d")).filter(F.col("d").isNotNull()).distinct().withColumn("_b", F.lit(1))
    j = da.join(db, "d", "full_outer")
    return j.agg(F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("common"),
                 F.count_if(F.col("_b").isNull()).alias("only_a"),
                 F.count_if(F.col("_a").isNull()).alias("only_b"))


def union_dates(*frames: DataFrame, date_col: str = "date") -> DataFrame:
    """U4: union of loaded dates of several products."""
    out = None
    for f in frames:
        d = f.select(F.col(date_col).alias("date"))
        out = d if out is None else out.union(d)
    return out.filter(F.col("date").isNotNull()).distinct()
