"""Macro and index series contract checks.

All checks run for every series at once, grouped by ``series_id``; a series
is daily (bounded by the calendar), so the per-series windows stay small.
``as_of`` dates are parameters, never the wall clock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .dedupe import keep_last, upsert_replace

# --- fixed values (must equal the reference's) -----------------------------
MAX_DAILY_CHANGE_PCT = 20.0
MIN_INDEX_VALUE = 100.0
MAX_STALE_DAYS = 10
MIN_BACKFILL_ROWS = 1000
HISTORY_PCT_TOLERANCE = 0.0002
HISTORY_ABS_TOLERANCE = 1.0
SOURCE_DIFF_WARN_PCT = 0.5
SOURCE_COMPARE_LAST_N = 5
# ---------------------------------------------------------------------------


def index_quality(obs: DataFrame, arrival: str, series: str = "series_id") -> DataFrame:
    """Per series -- rows on duplicated dates, non-positive values, the
    minimum and whether it is below the floor, daily moves above 20% (date
    order, arrival as tiebreak), and whether dates fail to increase in
    arrival order."""
    w_date = Window.partitionBy(series).orderBy("date", arrival)
    w_arr = Window.partitionBy(series).orderBy(arrival)
    d = obs.withColumn("_pct", (F.try_divide(F.col("value"), F.lag("value").over(w_date)) - 1) * 100) \
           .withColumn("_prev_date", F.lag("date").over(w_arr)) \
           .withColumn("_n_date", F.count(F.lit(1)).over(Window.partitionBy(series, "date")))
    return d.groupBy(series).agg(
        F.count_if(F.col("_n_date") > 1).alias("duplicate_date_rows"),
        F.count_if(F.col("value") <= 0).alias("non_positive"),
        F.min("value").alias("min_value"),
        (F.min("value") < MIN_INDEX_VALUE).alias("below_floor"),
        F.count_if(F.abs("_pct") > MAX_DAILY_CHANGE_PCT).alias("large_moves"),
        (F.count_if(F.col("date") < F.col("_prev_date")) > 0).alias("not_increasing"))


def index_freshness(obs: DataFrame, as_of, is_backfill: bool, start=None, end=None,
                    series: str = "series_id") -> DataFrame:
    """Per series -- stale when the last date is older than ``as_of`` - 10
    days; in a backfill too few rows (> 5 years requested: 1000, else
    max(50, int(years * 200))); years from [start, end] or the data range."""
    a = F.lit(as_of).cast("date")
    per = obs.groupBy(series).agg(F.count(F.lit(1)).alias("rows"), F.min("date").alias("first_date"),
                                  F.max("date").alias("last_date"))
    if start is not None and end is not None:
        years = F.datediff(F.lit(end).cast("date"), F.lit(start).cast("date")) / F.lit(365.25)
    else:
        years = F.datediff("last_date", "first_date") / F.lit(365.25)
    min_rows = F.when(years > 5, F.lit(MIN_BACKFILL_ROWS)).otherwise(F.greatest(F.lit(50), (years * 200).cast("int")))
    out = per.withColumn("years", years).withColumn("min_rows", min_rows) \
             .withColumn("stale", F.col("last_date") < F.date_sub(a, MAX_STALE_DAYS)) \
             .withColumn("too_few_rows", F.lit(is_backfill) & (F.col("rows") < F.col("min_rows")))
    return out.withColumn("fatal", F.col("stale") | F.col("too_few_rows"))


def history_changes(old: DataFrame, new: DataFrame, series: str = "series_id") -> DataFrame:
    """Per series, overlapping dates whose value changed beyond the
    tolerance (relative diff / max(|old|, 0.01) > 0.02% or diff > 1.0), and
    the largest relative drift with its date."""
    o = old.select(series, "date", F.col("value").alias("old_value")).filter(F.col("old_value").isNotNull())
    n = new.select(series, "date", F.col("value").alias("new_value")).filter(F.col("new_value").isNotNull())
    j = o.join(n, [series, "date"], "inner")
    diff = F.abs(F.col("old_value") - F.col("new_value"))
    pct = diff / F.greatest(F.abs("old_value"), F.lit(0.01))
    j = j.withColumn("abs_diff", diff).withColumn("pct_diff", pct)
    changed = (F.col("pct_diff") > HISTORY_PCT_TOLERANCE) | (F.col("abs_diff") > HISTORY_ABS_TOLERANCE)
    return j.groupBy(series).agg(
        F.count(F.lit(1)).alias("overlap_dates"), F.count_if(changed).alias("changed_dates"),
        F.max("pct_diff").alias("max_pct_diff"),
        F.max_by("date", F.struct("pct_diff", F.col("date"))).alias("max_diff_date"))


def merge_new_wins(old: DataFrame, new: DataFrame, series: str = "series_id") -> DataFrame:
    """I4: old rows whose (series, date) is not in the new pull, plus all new
    rows (W2 keyed on (series, date))."""
    return upsert_replace(old, new.select(*old.columns), [series, "date"], ["value"])


def source_compare(a: DataFrame, b: DataFrame, series: str = "series_id", n: int = SOURCE_COMPARE_LAST_N) -> DataFrame:
    """Per series the last ``n`` common dates: (a - b) / b in percent,
    the mean absolute difference, and a warning above 0.5%.  Zero or null
    values are skipped, like the reference's truthiness test."""
    j = a.select(series, "date", F.col("value").alias("a_value")) \
         .join(b.select(series, "date", F.col("value").alias("b_value")), [series, "date"], "inner")
    w = Window.partitionBy(series).orderBy(F.desc("date"))
    last = j.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    ok = F.col("a_value").isNotNull() & F.col("b_value").isNotNull() & (F.col("a_value") != 0) & (F.col("b_value") != 0)
    pct = F.when(ok, (F.col("a_value") - F.col("b_value")) / F.col("b_value") * 100)
    per = last.groupBy(series).agg(F.count(pct).alias("compared"), F.avg(F.abs(pct)).alias("avg_abs_diff_pct"))
    return per.withColumn("warn", F.col("avg_abs_diff_pct") > SOURCE_DIFF_WARN_PCT)


def source_fallback(candidates: DataFrame, series: str = "series_id") -> DataFrame:
    """Per series use the highest-priority source (lowest ``priority``)
    that has any row; series with no source at all are absent (the caller
    fails them).  One aggregate to choose, one semi join to keep."""
    chosen = candidates.groupBy(series).agg(F.min("priority").alias("priority"))
    return candidates.join(chosen, [series, "priority"], "left_semi")


def series_clean(raw: DataFrame, series: str = "series_id") -> DataFrame:
    """date/value coerced (bad text to null), rows with a null date or
    value dropped, one row per (series, date) (last by input order wins),
    ``source`` = the series' first source, ``last_updated`` = its max."""
    v = F.col("value").cast("string").try_cast("double")
    d = F.col("date").cast("string").try_cast("date")
    r = raw.select(series, d.alias("date"), v.alias("value"), "source", "last_updated", "_order") \
        .filter(F.col("date").isNotNull() & F.col("value").isNotNull())
    meta = r.groupBy(series).agg(F.min_by("source", "_order").alias("_source"), F.max("last_updated").alias("_lu"))
    one = keep_last(r, [series, "date"], ["_order"]).join(meta, series, "inner")
    return one.select("date", series, "value", F.col("_source").alias("source"), F.col("_lu").alias("last_updated"))
