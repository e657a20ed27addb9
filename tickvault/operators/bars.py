"""Bars and roll-ups.

Bar build plan (B1-B3): quotes and trades are each aggregated per
(bucket, key) first -- a partial (map-side) aggregate followed by one shuffle
per side on the same keys -- and only then joined 1:1.  The reference joins
raw quotes to raw trades per bucket, which is an M x N blow-up per bucket and
multiplies trade volume by the quote count; ``volume="reference"`` reproduces
that number exactly as ``n_quotes * sum`` without materialising the pairs.

Both aggregates are hash-partitioned on the same (bucket, key) columns, so
the join reuses that partitioning.  A hot instrument is split by bucket and
pre-aggregated map-side, so no task ever sees all of its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import first_by, last_by, mid, spread, time_bucket
from .selection import exact_median, with_medians

BAR_KEY = "ts_minute"


def _bucketed(df: DataFrame, width_seconds: int, bucket_col: str) -> DataFrame:
    if width_seconds == 60:
        b = F.date_trunc("minute", F.col("ts_event")).cast("timestamp_ntz")
    elif width_seconds == 3600:
        b = F.date_trunc("hour", F.col("ts_event")).cast("timestamp_ntz")
    else:
        b = time_bucket("ts_event", width_seconds)
    return df.withColumn(bucket_col, b)


def quote_bars(quotes: DataFrame, trades: DataFrame, key: str = "instrument_id",
               width_seconds: int = 60, with_spread: bool = True,
               volume: str = "once", order: Sequence[str] = ("ts_event",),
               underlying_col: str | None = None, bucket_col: str = BAR_KEY) -> DataFrame:
    """Mid-price OHLC bars per (bucket, key) with traded volume.

    * open/close = mid of the first/last quote by ``order`` with a non-null mid
      (``order`` should end in a unique tiebreak such as an event id);
      high/low = max/min mid.
    * ``with_spread`` adds first/last spread (options, B1).
    * ``volume="once"`` counts each trade once; ``"reference"`` gives the
      reference's value, n_quotes x sum.  Trades in buckets without quotes are
      dropped, as in the reference (left join from quotes).
    * ``underlying_col`` (continuous bars, B3) adds the smallest non-null
      underlying id of the bucket (a stable choice of "any value").
    """
    if volume not in ("once", "reference"):
        raise ValueError("volume must be 'once' or 'reference'")
    q = _bucketed(quotes, width_seconds, bucket_col) \
        .withColumn("_mid", mid()).withColumn("_spread", spread())
    aggs = [first_by("_mid", order).alias("o_mid"), F.max("_mid").alias("h_mid"),
            F.min("_mid").alias("l_mid"), last_by("_mid", order).alias("c_mid")]
    if with_spread:
        aggs += [first_by("_spread", order).alias("o_spread"), last_by("_spread", order).alias("c_spread")]
    if underlying_col:
        aggs.append(F.min(underlying_col).alias(underlying_col))
    aggs.append(F.count(F.lit(1)).alias("_n_quotes"))
    qa = q.groupBy(bucket_col, key).agg(*aggs)

    t = _bucketed(trades.select("ts_event", key, "last_px", "last_sz"), width_seconds, bucket_col)
    ta = t.groupBy(bucket_col, key).agg(F.sum("last_sz").alias("_v"),
                                        F.sum(F.col("last_sz") * F.col("last_px")).alias("_n"),
                                        F.count("last_sz").alias("_nt"))
    j = qa.join(ta, [bucket_col, key], "left")
    mult = F.col("_n_quotes") if volume == "reference" else F.lit(1)
    v_trades = F.coalesce(F.col("_v") * mult, F.lit(0.0))
    v_notional = F.coalesce(F.col("_n") * mult, F.lit(0.0))
    cols = [bucket_col, key] + ([underlying_col] if underlying_col else []) + \
        ["o_mid", "h_mid", "l_mid", "c_mid"] + (["o_spread", "c_spread"] if with_spread else [])
    return j.select(*cols, v_trades.alias("v_trades"), v_notional.alias("v_notional"))


def bars_options(quotes, trades, width_seconds=60, volume="once", order=("ts_event",)):
    """B1: options bars (with spread)."""
    return quote_bars(quotes, trades, "instrument_id", width_seconds, True, volume, order)


def bars_futures(quotes, trades, width_seconds=60, volume="once", order=("ts_event",)):
    """B2: futures bars (no spread)."""
    return quote_bars(quotes, trades, "instrument_id", width_seconds, False, volume, order)


def bars_continuous(quotes, trades, width_seconds=60, volume="once", order=("ts_event",)):
    """Continuous bars keyed by series, plus the underlying id."""
    return quote_bars(quotes, trades, "contract_series", width_seconds, False, volume, order,
                      underlying_col="underlying_instrument_id")


def incremental_cutoff(existing_bars: DataFrame | None, bucket_col: str = BAR_KEY,
                       default: str = "1900-01-01 00:00:00"):
    """The high-water mark, ``max(bucket)`` of the target or the default.

    One scalar aggregate; the caller passes the last partition only, as Z2
    does, so the target is not scanned."""
    import datetime as dt
    if existing_bars is None:
        return dt.datetime.fromisoformat(default)
    m = existing_bars.agg(F.max(bucket_col).alias("m")).first()["m"]
    return m if m is not None else dt.datetime.fromisoformat(default)


def incremental_quotes(quotes: DataFrame, cutoff, mode: str = "rebuild") -> DataFrame:
    """Quotes to (re)build after ``cutoff``.

    ``mode="reference"``: ``ts_event > cutoff`` (the last minute is re-read and
    appended again).  ``mode="rebuild"`` (default): ``ts_event >= cutoff`` so the
    last bucket is rebuilt whole and replaced by the caller (delete+rebuild).
    The cutoff is a literal, so it reaches the Parquet scan as a pushed filter.
    """
    c = F.lit(cutoff).cast("timestamp_ntz")
    return quotes.filter(F.col("ts_event") > c if mode == "reference" else F.col("ts_event") >= c)


DAILY_KEY = ("trading_date", "contract_series")


def daily_consolidate(raw: DataFrame, order: Sequence[str], key: Sequence[str] = DAILY_KEY,
                      positional: bool = False) -> DataFrame:
    """Several raw daily rows per (date, series) -> one bar.

    first id, first open, max high, min low, last close, sum volume.  "First"
    and "last" follow ``order`` (the input order).  B5 (default) skips nulls
    like pandas ``first/last``; ``positional=True`` (B7) takes the first/last
    row even when its value is null, like ``iloc[0]/iloc[-1]``.
    """
    skip = not positional
    return raw.groupBy(*key).agg(
        first_by("underlying_instrument_id", order, skip).alias("underlying_instrument_id"),
        first_by("open", order, skip).alias("open"),
        F.max("high").alias("high"), F.min("low").alias("low"),
        last_by("close", order, skip).alias("close"),
        F.sum(F.col("volume").cast("bigint")).alias("volume"))


REQUIRED_DAILY = ("trading_date", "contract_series", "underlying_instrument_id",
                  "open", "high", "low", "close", "volume")


def daily_consolidate_month(raw: DataFrame, order: Sequence[str]) -> DataFrame:
    """Month batch -- B5 over rows with a trading date, one row per key,
    required columns asserted (schema only, no job), plus a ``month`` column
    used as the write partition."""
    missing = [c for c in REQUIRED_DAILY if c not in raw.columns and c not in ("underlying_instrument_id",)]
    if "instrument_id" not in raw.columns and "underlying_instrument_id" not in raw.columns:
        missing.append("underlying_instrument_id")
    if missing:
        raise ValueError(f"month batch schema mismatch: missing required columns {sorted(missing)!r}")
    if "underlying_instrument_id" not in raw.columns:
        raw = raw.withColumnRenamed("instrument_id", "underlying_instrument_id")
    out = daily_consolidate(raw.filter(F.col("trading_date").isNotNull()), order)
    return out.withColumn("month", F.date_format("trading_date", "yyyy-MM"))


def quote_close(quotes: DataFrame, symbol: str = "symbol", approx: bool = False,
                accuracy: int = 10000) -> DataFrame:
    """Per (UTC date, symbol) the median mid and median spread.

    Exact medians are selected in parts of a group (``exact_median``);
    ``approx=True`` gives ``percentile_approx`` in one pass."""
    q = quotes.select(F.to_date("ts_event").alias("date"), F.col(symbol),
                      mid().alias("_mid"), spread().alias("_spr"))
    if approx:
        m1 = F.percentile_approx("_mid", 0.5, accuracy)
        m2 = F.percentile_approx("_spr", 0.5, accuracy)
        return q.groupBy("date", symbol).agg(m1.alias("mid_close"), m2.alias("spread_close"))
    by = ["date", symbol]
    return with_medians(q.select(*by).distinct(), by, exact_median(q, by, F.col("_mid"), "mid_close"), exact_median(q, by, F.col("_spr"), "spread_close"))
