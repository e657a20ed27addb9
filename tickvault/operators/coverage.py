"""Coverage and profile reports.

Each report is one group-by over the fact (partial aggregation, one shuffle
on the report key).  Scalars that a report needs (expected session days, a
window end) are lazy scalar subqueries (``DataFrame.scalar()``) -- never collected
into a driver loop.  Dimensions (instruments, canonical map) are joined by key and
left to the planner's size-checked broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import col, mid, round_dp, spread
from ..functions.symbols import series_rank, series_root
from .selection import exact_median, with_medians

# --- fixed values (must equal the reference's) -----------------------------
# Day classes by quote count.
FULL_DAY_MIN = 1200
PARTIAL_DAY_MIN = 200
VERY_PARTIAL_DAY_MIN = 50
# Definitions expected per year: quarterly and monthly listing roots.
QUARTERLY_ROOTS = ["ES", "NQ", "RTY"]
MONTHLY_ROOTS = ["SI", "GC", "CL"]
MAJOR_ASSETS = ["ES", "NQ", "RTY", "SI", "GC", "CL", "ZT", "ZF", "ZN", "UB"]
DEFINITION_DRIFT_PCT = 20
SYMBOL_COUNT_CV_LIMIT = 0.05
# Column-name parts that mark a date-like and a symbol-like column (table profile).
DATE_LIKE_PARTS = ["date", "timestamp", "ts_"]
SYMBOL_LIKE_PARTS = ["symbol", "series", "contract", "root", "series_id", "asset"]
# ---------------------------------------------------------------------------


def _between(df, date_col, start, end):
    if start is not None:
        df = df.filter(F.col(date_col) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(date_col) <= F.lit(end).cast("date"))
    return df


def series_coverage(bars: DataFrame, session: DataFrame, start, end, gap_threshold: int = 5):
    """Per series in [start, end]: actual days, first, last, expected
    (session days in range), missing, pct (2 dp).  Returns (summary,
    offenders, totals).  The expected count is a one-row aggregate."""
    b = _between(bars, "trading_date", start, end)
    per = b.groupBy("contract_series").agg(F.count_distinct("trading_date").alias("actual_days"),
                                           F.min("trading_date").alias("first_date"),
                                           F.max("trading_date").alias("last_date"))
    exp = _between(session, "trade_date", start, end).agg(F.count(F.lit(1))).scalar()
    s = per.withColumn("expected_days", exp)
    s = s.withColumn("missing_days", F.col("expected_days") - F.col("actual_days")) \
         .withColumn("coverage_pct", F.when(F.col("expected_days") > 0,
                                            round_dp(F.col("actual_days") / F.col("expected_days") * 100, 2))
                     .otherwise(F.lit(0.0)))
    offenders = s.filter(F.col("missing_days") > gap_threshold)
    totals = s.agg(F.count(F.lit(1)).alias("total_series"), F.sum("actual_days").alias("total_actual"),
                   F.sum("missing_days").alias("total_missing"),
                   (F.count(F.lit(1)) * F.max("expected_days")).alias("total_expected"))
    totals = totals.withColumn("overall_pct", F.when(F.col("total_expected") > 0,
                                                     F.col("total_actual") / F.col("total_expected") * 100).otherwise(0.0))
    return s, offenders, totals


def canonical_coverage(canonical: DataFrame, canonical_map: DataFrame, session: DataFrame, start, end):
    """Per canonical (root, series): bars, first, last, expected session
    days, pct (1 dp); and required roots without data."""
    b = _between(canonical, "trading_date", start, end)
    per = b.groupBy("root", "contract_series").agg(F.count(F.lit(1)).alias("bar_count"),
                                                   F.min("trading_date").alias("first_date"),
                                                   F.max("trading_date").alias("last_date"))
    exp = _between(session, "trade_date", start, end).agg(F.count(F.lit(1))).scalar()
    out = per.withColumn("expected", exp).withColumn(
        "coverage_pct", F.when(F.col("expected") > 0, round_dp(F.col("bar_count") / F.col("expected") * 100, 1)))
    missing = canonical_map.filter(~F.col("optional")).select("root").distinct() \
        .join(per.select("root").distinct(), "root", "left_anti")
    return out, missing


def audit_series(bars: DataFrame) -> DataFrame:
    """Per series root, first, last, rows, years = days / 365.25."""
    per = bars.groupBy("contract_series").agg(F.count(F.lit(1)).alias("row_count"),
                                              F.min("trading_date").alias("first_date"),
                                              F.max("trading_date").alias("last_date"))
    yrs = F.coalesce(F.datediff("last_date", "first_date") / F.lit(365.25), F.lit(0.0))
    return per.select(series_root("contract_series").alias("root"), "contract_series", "first_date",
                      "last_date", "row_count", yrs.alias("coverage_years"))


def best_series_per_root(audit: DataFrame) -> DataFrame:
    """C4: per root the series with most rows, then the latest end date,
    then the smallest name (a deterministic tiebreak)."""
    w = Window.partitionBy("root").orderBy(F.desc("row_count"), F.desc_nulls_last("last_date"), "contract_series")
    return audit.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def root_summary(bars: DataFrame) -> DataFrame:
    """Per root: series, rows, first, last, distinct days, volume."""
    return bars.groupBy(series_root("contract_series").alias("root")).agg(
        F.count_distinct("contract_series").alias("series_count"), F.count(F.lit(1)).alias("total_rows"),
        F.min("trading_date").alias("first_date"), F.max("trading_date").alias("last_date"),
        F.count_distinct("trading_date").alias("trading_days"), F.sum("volume").alias("total_volume"))


def root_rank_summary(bars: DataFrame) -> DataFrame:
    """Per (root, rank) bars, days, first, last, volume, plus one total
    row per root (rank null) from a ``rollup``; the grand total is dropped."""
    b = bars.select(series_root("contract_series").alias("root"),
                    series_rank("contract_series", "sql").alias("rank"), "trading_date", "volume")
    r = b.rollup("root", "rank").agg(F.count(F.lit(1)).alias("bar_count"),
                                     F.count_distinct("trading_date").alias("trading_days"),
                                     F.min("trading_date").alias("first_date"), F.max("trading_date").alias("last_date"),
                                     F.sum("volume").alias("total_volume"),
                                     F.grouping("root").alias("_gr"))
    return r.filter(F.col("_gr") == 0).drop("_gr")


def missing_ranks(expected: DataFrame, bars: DataFrame) -> DataFrame:
    """Expected (root, rank) from the universe minus ranks found."""
    # distinct series first: the name parsing then runs once per series,
    # not once per bar
    series = bars.select("contract_series").distinct()
    found = series.select(series_root("contract_series").alias("root"),
                          series_rank("contract_series", "sql").alias("rank")).distinct()
    return expected.select("root", "rank").join(found, ["root", "rank"], "left_anti")


def series_stats(bars: DataFrame, root: str | None = None) -> DataFrame:
    """Per series (of one root or all): bars, first, last, days,
    average and total volume, average close (2 dp)."""
    b = bars if root is None else bars.filter(series_root("contract_series") == root)
    return b.groupBy("contract_series").agg(
        F.count(F.lit(1)).alias("bar_count"), F.min("trading_date").alias("first_date"),
        F.max("trading_date").alias("last_date"), F.count_distinct("trading_date").alias("trading_days"),
        F.avg("volume").alias("avg_volume"), F.sum("volume").alias("total_volume"),
        round_dp(F.avg("close"), 2).alias("avg_close"))


def quote_summary(quotes: DataFrame, instruments: DataFrame, bars: DataFrame) -> DataFrame:
    """One row: quotes, quoted instruments, first/last date, trading
    days, instrument rows, bar rows (three one-row aggregates)."""
    q = quotes.agg(F.count(F.lit(1)).alias("total_quotes"),
                   F.count_distinct("instrument_id").alias("unique_instruments"),
                   F.min(F.to_date("ts_event")).alias("min_date"), F.max(F.to_date("ts_event")).alias("max_date"),
                   F.count_distinct(F.to_date("ts_event")).alias("trading_days"))
    return q.withColumn("instrument_count", instruments.agg(F.count(F.lit(1))).scalar()) \
            .withColumn("bar_count", bars.agg(F.count(F.lit(1))).scalar())


def quotes_by_root(instruments: DataFrame, quotes: DataFrame) -> DataFrame:
    """C10 (J7): per root from the dimension: instruments, instruments with
    quotes, first, last, ``total_rows`` (the reference's count(*), which is
    1 for an instrument without quotes, Q16) and ``total_quotes``.
    Quotes are pre-aggregated per instrument before the join."""
    qa = quotes.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("_n"), F.min(F.to_date("ts_event")).alias("_f"),
                                             F.max(F.to_date("ts_event")).alias("_l"))
    j = instruments.select("instrument_id", "root").join(qa, "instrument_id", "left")
    return j.groupBy("root").agg(F.count_distinct("instrument_id").alias("unique_instruments"),
                                 F.count_distinct(F.when(F.col("_n").isNotNull(), F.col("instrument_id"))).alias("instruments_with_quotes"),
                                 F.min("_f").alias("first_date"), F.max("_l").alias("last_date"),
                                 F.sum(F.coalesce("_n", F.lit(1))).alias("total_rows"),
                                 F.sum(F.coalesce("_n", F.lit(0))).alias("total_quotes"))


def quotes_per_contract(quotes: DataFrame, instruments: DataFrame) -> DataFrame:
    """C11 (J6): per contract symbol: quote count, first/last quote date,
    average spread (points) and average total size."""
    j = quotes.join(instruments.select("instrument_id", "symbol_canonical"), "instrument_id", "inner")
    return j.groupBy(F.col("symbol_canonical").alias("symbol")).agg(
        F.count(F.lit(1)).alias("quote_count"), F.min(F.to_date("ts_event")).alias("first_quote"),
        F.max(F.to_date("ts_event")).alias("last_quote"),
        F.avg(spread()).alias("avg_spread_pts"), F.avg(F.col("bid_sz") + F.col("ask_sz")).alias("avg_total_size"))


def daily_quotes(quotes: DataFrame) -> DataFrame:
    """Per UTC day: quotes, active contracts, avg spread."""
    return quotes.groupBy(F.to_date("ts_event").alias("date")).agg(
        F.count(F.lit(1)).alias("quote_count"), F.count_distinct("instrument_id").alias("active_contracts"),
        F.avg(spread()).alias("avg_spread_pts"))


def bars_per_contract(bars_1m: DataFrame, instruments: DataFrame) -> DataFrame:
    """C13 (J6): per symbol: bars, first, last, avg open and close mid."""
    j = bars_1m.join(instruments.select("instrument_id", "symbol_canonical"), "instrument_id", "inner")
    return j.groupBy(F.col("symbol_canonical").alias("symbol")).agg(
        F.count(F.lit(1)).alias("bar_count"), F.min(F.to_date("ts_minute")).alias("first_bar"),
        F.max(F.to_date("ts_minute")).alias("last_bar"),
        F.avg("o_mid").alias("avg_open"), F.avg("c_mid").alias("avg_close"))


def contract_bar_stats(bars: DataFrame, cols: Sequence[str] = ("open", "high", "low", "close", "volume"),
                       key: str = "contract_series") -> DataFrame:
    """C14: min / median / max of each value column per series, one row per
    (series, column) -- one aggregate, unpivoted."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).cast("double").alias(f"{c}__min"), F.median(c).alias(f"{c}__median"),
                 F.max(c).cast("double").alias(f"{c}__max")]
    one = bars.groupBy(key).agg(*aggs)
    items = [F.struct(F.lit(c).alias("column"), F.col(f"{c}__min").alias("min"),
                      F.col(f"{c}__median").alias("median"), F.col(f"{c}__max").alias("max")) for c in cols]
    return one.select(key, F.explode(F.array(*items)).alias("s")).select(key, "s.*")


def spread_stats(quotes: DataFrame, instruments: DataFrame) -> DataFrame:
    """Per symbol: count, min/avg/max/median spread."""
    j = quotes.join(instruments.select("instrument_id", "symbol_canonical"), "instrument_id", "inner") \
        .withColumn("_s", spread())
    j = j.withColumn("symbol", F.col("symbol_canonical"))
    per = j.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("quote_count"), F.min("_s").alias("min_spread"), F.avg("_s").alias("avg_spread"),
        F.max("_s").alias("max_spread"))
    return with_medians(per, ["symbol"], exact_median(j, ["symbol"], F.col("_s"), "median_spread"))


def day_class(n: Column) -> Column:
    return (F.when(n >= FULL_DAY_MIN, F.lit("full")).when(n >= PARTIAL_DAY_MIN, F.lit("partial"))
             .when(n >= VERY_PARTIAL_DAY_MIN, F.lit("very_partial")).otherwise(F.lit("test")))


def day_volume_class(quotes: DataFrame, key: str = "instrument_id") -> DataFrame:
    """Per (key, day) quote count and its class; then days per class."""
    per = quotes.groupBy(key, F.to_date("ts_event").alias("date")).agg(F.count(F.lit(1)).alias("quotes"))
    return per.groupBy(key, day_class(F.col("quotes")).alias("day_class")).agg(
        F.count(F.lit(1)).alias("days"), F.sum("quotes").alias("quotes"))


def macro_coverage(obs: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Per series rows, first, last; with a wanted list, every wanted
    series with a found flag (left join from the list)."""
    per = obs.groupBy("series_id").agg(F.count(F.lit(1)).alias("row_count"), F.min("date").alias("first_date"),
                                       F.max("date").alias("last_date"))
    if wanted is None:
        return per
    return wanted.select("series_id").distinct().join(per, "series_id", "left") \
                 .withColumn("found", F.col("row_count").isNotNull())


def table_profile(df: DataFrame) -> tuple[str | None, str | None, DataFrame]:
    """From the schema (driver side, no job) the first column whose
    name contains a date-like part and the first with a symbol-like part;
    then one group-by per identifier: row count and date range."""
    names = df.columns
    dcol = next((c for c in names if any(p in c.lower() for p in DATE_LIKE_PARTS)), None)
    scol = next((c for c in names if any(p in c.lower() for p in SYMBOL_LIKE_PARTS)), None)
    if scol is None or dcol is None:
        aggs = [F.count(F.lit(1)).alias("row_count")]
        if dcol is not None:
            aggs += [F.min(dcol).alias("min_date"), F.max(dcol).alias("max_date")]
        return dcol, scol, df.agg(*aggs)
    out = df.groupBy(F.col(scol).alias("identifier")).agg(
        F.count(F.lit(1)).alias("row_count"), F.min(dcol).alias("min_date"), F.max(dcol).alias("max_date"))
    return dcol, scol, out


def definitions_vs_bars(defs: DataFrame, bar_ids: DataFrame, id_col: str = "instrument_id"):
    """C20: (per asset with/without bars, orphans per asset with their
    symbols).  Bars are reduced to their distinct ids first (J3/J4)."""
    ids = bar_ids.select(F.col(id_col).alias("instrument_id")).filter(F.col("instrument_id").isNotNull()).distinct() \
        .withColumn("_has", F.lit(True))
    j = defs.join(ids, "instrument_id", "left")
    per_asset = j.filter(F.col("asset").isNotNull()).groupBy("asset").agg(
        F.count_if(F.col("_has").isNotNull()).alias("with_bars"), F.count_if(F.col("_has").isNull()).alias("without_bars"),
        F.count_distinct(F.when(F.col("_has").isNotNull(), F.col("native_symbol"))).alias("unique_symbols_with_bars"))
    orphans = j.filter(F.col("_has").isNull()).groupBy("asset").agg(
        F.count(F.lit(1)).alias("orphans"),
        F.array_join(F.array_sort(F.collect_set("native_symbol")), ", ").alias("symbols"))
    return per_asset, orphans


def definitions_expected(defs_with_bars: DataFrame, bars: DataFrame) -> DataFrame:
    """Expected definitions per asset (years x 4 for quarterly roots,
    x 12 for monthly roots, null otherwise) against the actual count; flag
    above 20% drift.  Years come from the bars' date range (one-row agg)."""
    yrs = bars.agg(F.datediff(F.max("trading_date"), F.min("trading_date")) / F.lit(365.25)).scalar()
    per = defs_with_bars.filter(F.col("asset").isin(*MAJOR_ASSETS)).groupBy("asset") \
        .agg(F.count(F.lit(1)).alias("actual"))
    j = per.withColumn("years", yrs)
    exp = (F.when(F.col("asset").isin(*QUARTERLY_ROOTS), (F.col("years") * 4).cast("int"))
            .when(F.col("asset").isin(*MONTHLY_ROOTS), (F.col("years") * 12).cast("int")))
    j = j.withColumn("expected", exp).withColumn("difference", F.col("actual") - F.col("expected"))
    pct = F.try_divide(F.col("difference") * 100.0, F.col("expected"))
    return j.select("asset", "actual", "expected", "difference",
                    (F.abs(pct) > DEFINITION_DRIFT_PCT).alias("flag"))


def instruments_by_root(bars: DataFrame, defs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct underlying ids per root; ids with bars but no definition
    with their first/last date (J3 as an anti join)."""
    b = bars.select(series_root("contract_series").alias("root"), "underlying_instrument_id", "trading_date") \
        .filter(F.col("underlying_instrument_id").isNotNull())
    per_root = b.groupBy("root").agg(F.count_distinct("underlying_instrument_id").alias("instruments"))
    rng = b.groupBy("root", "underlying_instrument_id").agg(F.min("trading_date").alias("first_date"),
                                                           F.max("trading_date").alias("last_date"))
    missing = rng.join(defs.select(F.col("instrument_id").alias("underlying_instrument_id")).distinct(),
                       "underlying_instrument_id", "left_anti")
    return per_root, missing


def keep_defined_with_bars(defs: DataFrame, bar_ids: DataFrame, id_col: str = "instrument_id") -> DataFrame:
    """Definitions whose id has bars (semi join); the orphans are
    the anti join and are what a dry run lists."""
    ids = bar_ids.select(F.col(id_col).alias("instrument_id")).filter(F.col("instrument_id").isNotNull())
    return defs.join(ids, "instrument_id", "left_semi")


def health_grid(canonical: DataFrame, roots: DataFrame, start, end) -> tuple[DataFrame, DataFrame]:
    """C24 (J12): roots x calendar days presence; per root present, missing,
    pct, sorted by missing.  The grid is generated per root row with
    ``explode(sequence(start, end))`` (no join), then left-joined to the
    distinct (root, date) pairs present."""
    days = F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date")))
    grid = roots.select("root").distinct().select("root", days.alias("date"))
    present = canonical.select("root", F.col("trading_date").alias("date")).distinct().withColumn("_p", F.lit(1))
    g = grid.join(present, ["root", "date"], "left").select("root", "date", F.col("_p").isNotNull().alias("present"))
    per = g.groupBy("root").agg(F.count_if("present").alias("present_days"),
                                F.count_if(~F.col("present")).alias("missing_days"),
                                F.count(F.lit(1)).alias("days"))
    per = per.withColumn("pct", round_dp(F.col("present_days") * 100.0 / F.col("days"), 1))
    return g, per.orderBy(F.desc("missing_days"), "root")


def bars_per_day(canonical: DataFrame, start, end) -> DataFrame:
    """Canonical bars per calendar day, zero days included."""
    days = canonical.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date"))
    per = canonical.groupBy(F.col("trading_date").alias("date")).agg(F.count(F.lit(1)).alias("bars"))
    return days.join(per, "date", "left").select("date", F.coalesce("bars", F.lit(0)).alias("bars"))


def root_ranges(canonical: DataFrame, canonical_map: DataFrame) -> DataFrame:
    """Per canonical root: first, last, distinct days, optional flag."""
    per = canonical.groupBy("root").agg(F.min("trading_date").alias("min_date"),
                                        F.max("trading_date").alias("max_date"),
                                        F.count_distinct("trading_date").alias("days"))
    return canonical_map.select("root", "optional").distinct().join(per, "root", "left")


def default_window_df(canonical: DataFrame, days: int) -> DataFrame:
    """C27 as a one-row frame (lazy): the ``days`` days that end at the last
    canonical date, both bounds inclusive."""
    return canonical.agg(F.max("trading_date").alias("window_end")) \
        .select(F.date_sub("window_end", days - 1).alias("window_start"), "window_end")


def option_file_profile(quotes: DataFrame, file_col: str = "file") -> DataFrame:
    """Per file, over the rows whose symbol parses as an option: total
    rows, unique symbols, expiries and minutes (of ``ts_recv`` when present,
    else ``ts_event``), time range in minutes, rows per minute, missing
    bid/ask, negative spreads, zero prices, median spread and median spread
    in percent of mid.  Vendor (``_00``) or plain price columns, chosen by
    schema."""
    from ..functions.symbols import OPTION_SYMBOL_RE
    cols = set(quotes.columns)
    bid = "bid_px_00" if "bid_px_00" in cols else "bid_px"
    ask = "ask_px_00" if "ask_px_00" in cols else "ask_px"
    tcol = "ts_recv" if "ts_recv" in cols else "ts_event"
    s = F.col("symbol")
    q = quotes.filter(s.rlike(OPTION_SYMBOL_RE)) \
        .withColumn("_mid", mid(bid, ask)).withColumn("_spr", spread(bid, ask))
    exp_code = F.concat(F.regexp_extract(s, OPTION_SYMBOL_RE, 2), F.regexp_extract(s, OPTION_SYMBOL_RE, 3))
    span = F.unix_micros(F.max(tcol).cast("timestamp")) - F.unix_micros(F.min(tcol).cast("timestamp"))
    per = q.groupBy(file_col).agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_distinct("symbol").alias("unique_symbols"),
        F.count_distinct(exp_code).alias("unique_expiries"),
        F.count_distinct(F.date_trunc("minute", tcol)).alias("unique_minutes"),
        (span / 60e6).alias("time_range_minutes"),
        F.count_if(F.col(bid).isNull()).alias("missing_bid"), F.count_if(F.col(ask).isNull()).alias("missing_ask"),
        F.count_if(F.col("_spr") < 0).alias("negative_spreads"),
        F.count_if((F.col(bid) == 0) | (F.col(ask) == 0)).alias("zero_prices"))
    share = F.try_divide(F.col("_spr"), F.col("_mid")) * 100
    per = with_medians(per, [file_col], exact_median(q, [file_col], F.col("_spr"), "median_spread"),
                       exact_median(q, [file_col], share, "median_spread_pct"))
    return per.withColumn("avg_symbols_per_minute",
                          F.coalesce(F.try_divide(F.col("total_rows").cast("double"), F.col("unique_minutes")), F.lit(0.0)))


def strikes_per_expiry(options: DataFrame) -> DataFrame:
    """Distinct strikes per (expiry code, C/P)."""
    from ..functions.symbols import OPTION_SYMBOL_RE
    s = F.col("symbol")
    o = options.filter(s.rlike(OPTION_SYMBOL_RE))
    return o.groupBy(F.concat(F.regexp_extract(s, OPTION_SYMBOL_RE, 2), F.regexp_extract(s, OPTION_SYMBOL_RE, 3)).alias("expiry_code"),
                     F.regexp_extract(s, OPTION_SYMBOL_RE, 4).alias("put_call")) \
            .agg(F.count_distinct(F.regexp_extract(s, OPTION_SYMBOL_RE, 5).cast("int")).alias("strikes"))


def expiry_distribution(options: DataFrame) -> DataFrame:
    """Calls and puts (rows) per expiry code, zero-filled."""
    from ..functions.symbols import OPTION_SYMBOL_RE
    s = F.col("symbol")
    o = options.filter(s.rlike(OPTION_SYMBOL_RE))
    pc = F.regexp_extract(s, OPTION_SYMBOL_RE, 4)
    return o.groupBy(F.concat(F.regexp_extract(s, OPTION_SYMBOL_RE, 2), F.regexp_extract(s, OPTION_SYMBOL_RE, 3)).alias("expiry_code")) \
            .agg(F.count_if(pc == "C").alias("calls"), F.count_if(pc == "P").alias("puts"))


def symbol_count_cv(per_file: DataFrame, count_col: str = "symbols") -> DataFrame:
    """Population std / mean of the per-file symbol counts; consistent
    when below 5%."""
    r = per_file.agg(F.stddev_pop(count_col).alias("std"), F.avg(count_col).alias("mean"),
                     F.count(F.lit(1)).alias("files"))
    cv = F.try_divide(F.col("std"), F.col("mean"))
    return r.withColumn("cv", cv).withColumn("consistent", F.col("cv") < SYMBOL_COUNT_CV_LIMIT)


def quote_brief(quotes: DataFrame) -> DataFrame:
    """Rows, symbols, first/last event time, median spread (vendor or
    plain price columns, chosen by schema)."""
    cols = set(quotes.columns)
    bid = "bid_px_00" if "bid_px_00" in cols else "bid_px"
    ask = "ask_px_00" if "ask_px_00" in cols else "ask_px"
    return quotes.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("symbol").alias("symbols"),
                      F.min("ts_event").alias("time_min"), F.max("ts_event").alias("time_max")) \
        .transform(with_medians, [], exact_median(quotes, [], spread(bid, ask), "median_spread"))


def daily_bar_summary(bars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Overall first/last date, bars, series; and the same by root."""
    overall = bars.agg(F.min("trading_date").alias("min_date"), F.max("trading_date").alias("max_date"),
                       F.count(F.lit(1)).alias("total_bars"), F.count_distinct("contract_series").alias("unique_series"))
    by_root = bars.groupBy(series_root("contract_series").alias("root")).agg(
        F.count(F.lit(1)).alias("bar_count"), F.min("trading_date").alias("min_date"),
        F.max("trading_date").alias("max_date"))
    return overall, by_root
