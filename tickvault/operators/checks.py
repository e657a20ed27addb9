"""Data-quality checks.

Every check yields rows ``(check_id, name, status, severity, violations,
message)``.  Checks of one table are merged into one aggregate over one scan
(``count_if`` per condition) and unpivoted, instead of one full scan per
check; key-duplicate checks share the same pass through a group-by on the key,
which combines map-side.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import col
from ..functions.symbols import series_root
from ..functions.timefns import local_ts

CHECK_SCHEMA = "check_id string, name string, status string, severity string, violations bigint, message string"

# --- fixed values (must equal the reference's) -----------------------------
# Daily continuous bar validator names, in order.
DAILY_BAR_CHECKS = [
    "Duplicate (trading_date, contract_series) pairs",
    "Negative volume values",
    "Non-CL: zero or negative OHLC prices",
    "CL: NULL in OHLC",
    "NULL trading_date",
    "NULL contract_series",
    "NULL close",
    "High < Low",
    "High < Open",
    "High < Close",
    "Low > Open",
    "Low > Close",
]
# Natural keys of the key fact tables (duplicate checks).
FACT_KEYS = [
    ("f_quote_l1", ["ts_event", "instrument_id"]),
    ("f_fut_quote_l1", ["ts_event", "instrument_id"]),
    ("f_continuous_quote_l1", ["ts_event", "contract_series", "underlying_instrument_id"]),
    ("g_continuous_bar_daily", ["trading_date", "contract_series"]),
    ("f_fred_observations", ["series_id", "date"]),
]
NEGATIVE_PRICE_ROOT = "CL"   # the root whose prices may be negative
# Check ids and names of the single checks.
CANONICAL_UNIQUE_CHECK = ("canonical.view.unique_root_date", "Canonical daily view: unique (root, trading_date)")
MAPPING_CHECK = ("canonical.mapping.sync", "Canonical mapping matches configs/canonical_series.yaml")
PRESENCE_CHECK = ("canonical.view.presence_recent_window", "Canonical daily view: non-optional roots present in window")
SESSION_POPULATED_CHECK = ("calendar.dim_session.populated", "dim_session populated (data-derived calendar)")
SESSION_FRESH_CHECK = ("calendar.dim_session.fresh", "dim_session includes latest continuous daily date")
# ---------------------------------------------------------------------------


def slug(s: str) -> str:
    s = re.sub(r"[^a-z0-9]+", "_", s.strip().lower())
    return s.strip("_")[:80]


def _status(violations: Column, severity: Column) -> Column:
    return (F.when(violations.isNull(), F.lit("SKIP"))
             .when(violations == 0, F.lit("PASS"))
             .when(severity == "WARN", F.lit("WARN"))
             .otherwise(F.lit("FAIL")))


def unpivot_checks(one_row: DataFrame, specs: Sequence[tuple[str, str, str, str]],
                   unit: str = "violations") -> DataFrame:
    """One aggregate row with a column per check -> one row per check.
    ``specs``: (check_id, name, severity, metric column)."""
    items = [F.struct(F.lit(cid).alias("check_id"), F.lit(name).alias("name"),
                      F.lit(sev).alias("severity"), F.col(m).cast("bigint").alias("violations"))
             for cid, name, sev, m in specs]
    d = one_row.select(F.explode(F.array(*items)).alias("c")).select("c.*")
    v = F.col("violations")
    return d.select("check_id", "name", _status(v, F.col("severity")).alias("status"), "severity",
                    F.coalesce(v, F.lit(0)).alias("violations"),
                    F.when(v.isNull(), F.lit("table not present")).when(v == 0, F.lit("ok"))
                     .otherwise(F.concat(v.cast("string"), F.lit(f" {unit}"))).alias("message"))


def counted(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Counts that are known already (of a write) as the one row of
    ``unpivot_checks``."""
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{n} bigint" for n in counts))


def spread_is_negative() -> Column:
    return F.col("ask_px") < F.col("bid_px")


def negative_spread(quotes: DataFrame) -> DataFrame:
    """V1: quotes with ask < bid (null prices do not count)."""
    return negative_spread_row(quotes.agg(F.count_if(spread_is_negative()).alias("v")))


def negative_spread_row(one: DataFrame) -> DataFrame:
    return unpivot_checks(one, [("quotes.negative_spread", "Negative spreads", "HARD", "v")])


def unlinked_row(one: DataFrame, label: str) -> DataFrame:
    return unpivot_checks(one, [(f"{label}.unlinked", f"Unlinked instruments ({label})", "HARD", "v")])


def unlinked(facts: dict[str, DataFrame], dim: DataFrame, key: str = "instrument_id") -> DataFrame:
    """V2: rows of each fact without a dimension row (anti join; the planner
    broadcasts the dimension when its measured size is under the threshold)."""
    out = None
    d = dim.select(key).distinct()
    for label, fact in facts.items():
        n = fact.select(key).join(d, key, "left_anti").agg(F.count(F.lit(1)).alias("v"))
        c = unlinked_row(n, label)
        out = c if out is None else out.unionByName(c)
    return out


def daily_bar_conditions() -> list[Column]:
    """V3: the conditions on a row, in the order of DAILY_BAR_CHECKS after its first."""
    o, h, l, c = (F.col(x) for x in ("open", "high", "low", "close"))
    root = series_root("contract_series")
    return [
        F.col("volume") < 0,
        (root != NEGATIVE_PRICE_ROOT) & ((o <= 0) | (h <= 0) | (l <= 0) | (c <= 0)),
        (root == NEGATIVE_PRICE_ROOT) & (o.isNull() | h.isNull() | l.isNull() | c.isNull()),
        F.col("trading_date").isNull(), F.col("contract_series").isNull(), c.isNull(),
        h < l, h < o, h < c, l > o, l > c,
    ]


def daily_bar_violations(bars: DataFrame, key: Sequence[str] = ("trading_date", "contract_series")) -> DataFrame:
    """V3: the 12 daily-bar counts in one pass (group by key, then total)."""
    conds = daily_bar_conditions()
    per_key = bars.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"),
                                     *[F.count_if(x).alias(f"m{i + 1}") for i, x in enumerate(conds)])
    one = per_key.agg(F.count_if(F.col("_n") > 1).alias("m0"),
                      *[F.sum(f"m{i + 1}").alias(f"m{i + 1}") for i in range(len(conds))])
    return daily_bar_rows(one)


def daily_bar_rows(one: DataFrame) -> DataFrame:
    """Rows of V3 from one row with the counts m0 (repeated keys), m1, ..."""
    specs = [(f"continuous_daily.validator.{slug(n)}", f"Continuous daily: {n}", "HARD", f"m{i}")
             for i, n in enumerate(DAILY_BAR_CHECKS)]
    return unpivot_checks(one, specs)


def duplicates_detail(df: DataFrame, key: Sequence[str], top: int = 10):
    """V4: (summary, top) -- total rows, distinct keys (a key with nulls still
    counts, like ``count(distinct (a, b))``), their difference; and the ``top``
    most repeated keys."""
    from .windows import top_duplicates
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    summary = per_key.agg(F.sum("n").cast("bigint").alias("total_rows"),
                          F.count(F.lit(1)).alias("unique_rows")) \
        .withColumn("duplicate_count", F.col("total_rows") - F.col("unique_rows"))
    return summary, top_duplicates(df, key, top)


def duplicate_keys(tables: dict[str, DataFrame | None], keys=None, severity: str = "HARD") -> DataFrame:
    """V5: duplicate key groups per table; a missing table is SKIP/INFO."""
    keys = keys or FACT_KEYS
    spark = next(t for t in tables.values() if t is not None).sparkSession
    parts = []
    for table, cols in keys:
        cid = f"integrity.duplicates.{table}"
        name = f"Duplicates absent: {table} on ({', '.join(cols)})"
        df = tables.get(table)
        if df is None:
            parts.append(spark.createDataFrame([(cid, name, "SKIP", "INFO", 0, "table not present")], CHECK_SCHEMA))
            continue
        one = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("v"))
        parts.append(unpivot_checks(one, [(cid, name, severity, "v")], unit="duplicate key groups"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def canonical_unique(canonical_bars: DataFrame) -> DataFrame:
    """V6: duplicate (root, trading_date) groups in the canonical view."""
    one = canonical_bars.groupBy("root", "trading_date").agg(F.count(F.lit(1)).alias("n")) \
        .agg(F.count_if(F.col("n") > 1).alias("v"))
    return unpivot_checks(one, [(*CANONICAL_UNIQUE_CHECK, "HARD", "v")],
                          unit="duplicate root-date groups")


def canonical_presence(canonical_bars: DataFrame, canonical_map: DataFrame, start, end) -> DataFrame:
    """V7: per canonical root: last trading date, rows in [start, end], and
    whether a required root is missing from the window.  One group-by over the
    bars instead of two queries per root.  The bounds may be columns, such as
    scalars of ``coverage.default_window_df``."""
    s, e = (x if isinstance(x, Column) else F.lit(x).cast("date") for x in (start, end))
    per_root = canonical_bars.groupBy("root").agg(
        F.max("trading_date").alias("last_trading_date"),
        F.count_if((F.col("trading_date") >= s) & (F.col("trading_date") <= e)).alias("rows_in_window"))
    m = canonical_map.select("root", "optional").distinct()
    j = m.join(per_root, "root", "left")
    return j.select("root", "optional", "last_trading_date",
                    F.coalesce("rows_in_window", F.lit(0)).alias("rows_in_window"),
                    ((~F.col("optional")) & (F.coalesce("rows_in_window", F.lit(0)) == 0)).alias("missing_required"))


def mapping_diff(expected: DataFrame, actual: DataFrame, key: str = "root",
                 fields: Sequence[str] = ("contract_series", "optional")) -> DataFrame:
    """V8: config map against the table: ``missing`` (in config only),
    ``extra`` (in table only), ``changed`` (any field differs, null-safe)."""
    e = expected.select(key, *[F.col(f).alias(f"exp_{f}") for f in fields])
    a = actual.select(key, *[F.col(f).alias(f"act_{f}") for f in fields])
    j = e.withColumn("_e", F.lit(True)).join(a.withColumn("_a", F.lit(True)), key, "full_outer")
    changed = None
    for f in fields:
        d = ~F.col(f"exp_{f}").eqNullSafe(F.col(f"act_{f}"))
        changed = d if changed is None else (changed | d)
    kind = (F.when(F.col("_a").isNull(), F.lit("missing")).when(F.col("_e").isNull(), F.lit("extra"))
             .when(changed, F.lit("changed")))
    return j.select(key, kind.alias("diff"), *[f"exp_{f}" for f in fields], *[f"act_{f}" for f in fields]) \
            .filter(F.col("diff").isNotNull())


def mapping_check(expected: DataFrame, actual: DataFrame, key: str = "root",
                  fields: Sequence[str] = ("contract_series", "optional")) -> DataFrame:
    """V8 as a check row: how many roots differ."""
    one = mapping_diff(expected, actual, key, fields).agg(F.count(F.lit(1)).alias("v"))
    return unpivot_checks(one, [(*MAPPING_CHECK, "HARD", "v")], unit="roots that differ")


def presence_check(canonical_bars: DataFrame, canonical_map: DataFrame, days: int) -> DataFrame:
    """V7 as a check row: required roots without a row in the last ``days``
    days (C27); a warning only."""
    last = canonical_bars.agg(F.max("trading_date").alias("_end"))
    rows = canonical_bars.withColumn("_end", last.scalar())
    recent = rows.filter(F.col("trading_date") > F.date_sub("_end", days)).select("root").distinct()
    required = canonical_map.filter(~F.col("optional")).select("root").distinct()
    one = required.join(recent, "root", "left_anti").agg(F.count(F.lit(1)).alias("v"))
    return unpivot_checks(one, [(*PRESENCE_CHECK, "WARN", "v")], unit="required roots without rows") \
        .withColumn("status", F.when(F.col("status") == "FAIL", "WARN").otherwise(F.col("status")))


def session_fresh(session: DataFrame, bars: DataFrame) -> DataFrame:
    """V9: the session table is empty while bars exist; its max date is behind
    the bars' max date."""
    s = session.agg(F.count(F.lit(1)).alias("sess_rows"), F.max("trade_date").alias("sess_max"))
    j = s.withColumn("bar_rows", bars.agg(F.count(F.lit(1))).scalar()) \
         .withColumn("bars_max", bars.agg(F.max("trading_date")).scalar())
    one = j.select(F.when((F.col("bar_rows") > 0) & (F.col("sess_rows") == 0), 1).otherwise(0).alias("populated"),
                   F.when(F.col("bars_max").isNull(), F.lit(None))
                    .when(F.col("sess_max").isNull() | (F.col("sess_max") < F.col("bars_max")), 1)
                    .otherwise(0).alias("fresh"))
    return unpivot_checks(one, [(*SESSION_POPULATED_CHECK, "HARD", "populated"), (*SESSION_FRESH_CHECK, "HARD", "fresh")])


def tables_exist(spark: SparkSession, required: dict[str, str]) -> DataFrame:
    """Required tables (name -> Parquet path or catalog name) exist.
    A driver-side catalog / file-system lookup; no job runs."""
    from ..sources.readers import list_files
    rows = []
    for name, where in required.items():
        if "/" in where or ":" in where:
            ok = bool(list_files(spark, where))
        else:
            try:
                ok = bool(spark.catalog.tableExists(where))
            except Exception:  # noqa: BLE001 -- not a valid table identifier
                ok = False
        rows.append((f"schema.table.{name}", f"Table exists: {name}", "PASS" if ok else "FAIL",
                     "HARD", 0 if ok else 1, "ok" if ok else "missing"))
    return spark.createDataFrame(rows, CHECK_SCHEMA)


def view_exists(spark: SparkSession, name: str, view: DataFrame | None) -> DataFrame:
    """V10 for a view: a frame the caller could build, or a catalog view."""
    ok = view is not None or bool(spark.catalog.tableExists(name))
    return spark.createDataFrame([(f"schema.view.{name}", f"View exists: {name}", "PASS" if ok else "FAIL", "HARD", 0 if ok else 1,
                                   "ok" if ok else "missing")], CHECK_SCHEMA)


def _window_quotes(quotes: DataFrame, symbol: str, arrival: str, options_only: bool) -> DataFrame:
    from .normalize import normalize_quote_columns
    from ..functions.symbols import is_option_symbol
    q = normalize_quote_columns(quotes)
    if options_only:
        q = q.filter(is_option_symbol(symbol))
    return q.select(symbol, arrival, "ts_event", "bid_px", "ask_px")


def _window_frame(q: DataFrame, max_span_minutes: int) -> DataFrame:
    """One row about the whole frame: rows, is its span too wide, how many
    Chicago dates."""
    span_s = F.unix_seconds(F.max("ts_event").cast("timestamp")) - F.unix_seconds(F.min("ts_event").cast("timestamp"))
    return q.agg(F.count(F.lit(1)).alias("rows"), (span_s > max_span_minutes * 60).alias("span_too_wide"),
                 F.count_distinct(F.to_date(local_ts("ts_event"))).alias("chicago_dates"))


def _window_symbols(q: DataFrame, symbol: str, arrival: str, chunk_width: int) -> DataFrame:
    """Per symbol rows, first/last time, backward steps in arrival order and
    null bid/ask rows.  Ticks are shuffled once, by (symbol, range of arrival
    numbers); steps between ranges come from one row per range."""
    ordered = Window.partitionBy(symbol, "_chunk").orderBy(arrival)
    c = q.withColumn("_chunk", F.floor(F.col(arrival) / F.lit(chunk_width)).cast("long")) \
         .withColumn("_prev", F.lag("ts_event").over(ordered))
    ts = F.struct(F.col("ts_event").alias("t"))
    per_chunk = c.groupBy(symbol, "_chunk").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts_event").alias("first_ts"), F.max("ts_event").alias("last_ts"),
        F.min_by(ts, arrival)["t"].alias("_opens"), F.max_by(ts, arrival)["t"].alias("_closes"),
        F.count_if(F.col("ts_event") < F.col("_prev")).alias("steps"),
        F.count_if(F.col("bid_px").isNull() | F.col("ask_px").isNull()).alias("nulls"))
    before = F.lag("_closes").over(Window.partitionBy(symbol).orderBy("_chunk"))
    return per_chunk.withColumn("_step", F.when(F.col("_opens") < before, 1).otherwise(0)).groupBy(symbol).agg(
        F.sum("n").alias("n_rows"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
        (F.sum("steps") + F.sum("_step")).alias("backward_steps"), F.sum("nulls").alias("_nulls")) \
        .withColumn("null_bid_ask", F.when(F.col("n_rows") >= 2, F.col("_nulls")).otherwise(F.lit(0))).drop("_nulls")


def quote_window_checks(quotes: DataFrame, symbol: str = "symbol", arrival: str = "event_id",
                        chunk_width: int = 1 << 20, max_span_minutes: int = 10,
                        options_only: bool = False) -> DataFrame:
    """Per symbol -- rows, first/last time, backward time steps in arrival
    order (the reference sorts by time first, so its check cannot fire; Q10),
    null bid/ask rows for symbols with at least two rows; and of the whole
    frame, repeated in each row, whether it spans over ``max_span_minutes`` and
    how many Chicago dates it has."""
    q = _window_quotes(quotes, symbol, arrival, options_only)
    frame = _window_frame(q, max_span_minutes)
    return _window_symbols(q, symbol, arrival, chunk_width).select(
        symbol, "n_rows", "first_ts", "last_ts", frame.select("span_too_wide").scalar().alias("span_too_wide"),
        frame.select("chicago_dates").scalar().alias("chicago_dates"), "backward_steps", "null_bid_ask")


def quote_window_report(quotes: DataFrame, symbol: str = "symbol", arrival: str = "event_id", chunk_width: int = 1 << 20,
                        max_span_minutes: int = 10, options_only: bool = False) -> DataFrame:
    """V11 as check rows: no (option) rows left, window too wide, several
    Chicago dates, symbols with backward steps, symbols with null prices."""
    q = _window_quotes(quotes, symbol, arrival, options_only)
    frame = _window_frame(q, max_span_minutes)
    per = _window_symbols(q, symbol, arrival, chunk_width).agg(
        F.count_if(F.col("backward_steps") > 0).alias("backward"), F.count_if(F.col("null_bid_ask") > 0).alias("nulls"))
    one = frame.select(F.when(F.col("rows") == 0, 1).otherwise(0).alias("empty"),
                       F.when(F.col("span_too_wide"), 1).otherwise(0).alias("wide"),
                       F.when(F.col("chicago_dates") > 1, F.col("chicago_dates") - 1).otherwise(0).alias("dates"),
                       per.select("backward").scalar().alias("backward"), per.select("nulls").scalar().alias("nulls"))
    return unpivot_checks(one, [("quotes.window.empty", "Quote window: rows left after filtering", "HARD", "empty"),
                                ("quotes.window.span", f"Quote window: at most {max_span_minutes} minutes", "HARD", "wide"),
                                ("quotes.window.dates", "Quote window: one Chicago date", "HARD", "dates"),
                                ("quotes.window.order", "Quote window: time never steps back in a symbol", "HARD", "backward"),
                                ("quotes.window.prices", "Quote window: bid and ask present", "HARD", "nulls")])


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """V11 (schema part) / R13: required columns absent from the frame."""
    have = set(df.columns)
    return [c for c in required if c not in have]


def critical_only(checks: DataFrame, tolerated_prefixes: Sequence[str] = ("Warning:",)) -> DataFrame:
    """Drop tolerated messages before deciding to fail."""
    cond = F.lit(True)
    for p in tolerated_prefixes:
        cond = cond & ~F.col("message").startswith(p)
    return checks.filter(cond & (F.col("status") != "PASS"))


def check_report(checks: DataFrame) -> DataFrame:
    """Hard failures, warnings, skipped, passed, total, overall status."""
    st, sev = F.col("status"), F.col("severity")
    hard = F.count_if(st.isin("FAIL", "ERROR") & (sev == "HARD"))
    warn = F.count_if((st == "WARN") | (st.isin("FAIL", "ERROR") & (sev == "WARN")))
    r = checks.agg(hard.alias("hard_failures"), warn.alias("warnings"),
                   F.count_if(st == "SKIP").alias("skipped"), F.count_if(st == "PASS").alias("passed"),
                   F.count(F.lit(1)).alias("total_checks"))
    return r.withColumn("overall_status", F.when(F.col("hard_failures") > 0, "FAIL")
                        .when(F.col("warnings") > 0, "WARN").otherwise("PASS")) \
            .withColumn("exit_code", F.when(F.col("hard_failures") > 0, 2).otherwise(0))
