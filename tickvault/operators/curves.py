"""Cross-series analytics.

Curve points are pivoted with one conditional aggregate per date instead of
a chain of self joins: one shuffle on the date, whatever the number of
points.  The canonical map is a configuration table with one row per root
(bounded by the number of roots, not by data), so it is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's) -----------------------------
VX_CURVE_SYMBOLS = ["@VX=101XN", "@VX=201XN", "@VX=301XN"]   # VX1, VX2, VX3
# ---------------------------------------------------------------------------


def canonical_bars(bars: DataFrame, canonical_map: DataFrame) -> DataFrame:
    """Daily bars of the canonical series with their root (inner join on
    the series; the map is config-sized and broadcast)."""
    m = F.broadcast(canonical_map.select("root", "contract_series"))
    return bars.join(m, "contract_series", "inner").select("root", *bars.columns)


def curve_by_rank(market: DataFrame, symbols: Sequence[str] = tuple(VX_CURVE_SYMBOLS),
                  names: Sequence[str] = ("vx1_close", "vx2_close", "vx3_close"),
                  date_col: str = "trading_date", start=None, end=None) -> DataFrame:
    """One row per date with one column per curve point.  Point 1 drives
    (dates without it are dropped), the others are left-joined.  Keys
    (date, symbol) are unique in the source."""
    m = market.filter(F.col("symbol").isin(*symbols))
    d = F.to_date(F.col(date_col))
    if start is not None:
        m = m.filter(d >= F.lit(start).cast("date"))
    if end is not None:
        m = m.filter(d <= F.lit(end).cast("date"))
    aggs = [F.max(F.when(F.col("symbol") == s, F.col("close"))).alias(n) for s, n in zip(symbols, names)]
    aggs.append(F.count_if(F.col("symbol") == symbols[0]).alias("_has1"))
    return m.groupBy(d.alias("date")).agg(*aggs).filter(F.col("_has1") > 0).drop("_has1")


def vol_spreads(vix: DataFrame, vix3m: DataFrame, curve: DataFrame) -> DataFrame:
    """Inner join of VIX, VIX3M and the VX curve by date; spreads and
    regime flags."""
    df = vix.join(vix3m, "date", "inner").join(curve, "date", "inner")
    return df.select(
        "date", "vix_close", "vix3m_close", *[c for c in curve.columns if c != "date"],
        (F.col("vix_close") - F.col("vx1_close")).alias("vix_vx1_spread"),
        (F.col("vx2_close") - F.col("vx1_close")).alias("vx2_vx1_slope"),
        (F.col("vix3m_close") - F.col("vix_close")).alias("vix3m_vix_spread"),
        (F.col("vx1_close") > F.col("vix_close")).alias("contango"),
        (F.col("vix_close") > F.col("vx1_close")).alias("backwardation"))


def term_spread(vix: DataFrame, vix3m: DataFrame, n: int = 10) -> DataFrame:
    """VIX3M - VIX by date, the latest ``n`` dates."""
    j = vix3m.join(vix, "date", "inner")
    return j.select("date", "vix_close", "vix3m_close",
                    (F.col("vix3m_close") - F.col("vix_close")).alias("term_spread")) \
            .orderBy(F.desc("date")).limit(n)


_VALS = ("open", "high", "low", "close", "volume")


def rank_pair(bars: DataFrame, series_a: str, series_b: str) -> DataFrame:
    """The two series side by side on their common dates."""
    cols = ["underlying_instrument_id", *_VALS]
    a = bars.filter(F.col("contract_series") == series_a).select("trading_date", *[F.col(c).alias(f"{c}_rank0") for c in cols])
    b = bars.filter(F.col("contract_series") == series_b).select("trading_date", *[F.col(c).alias(f"{c}_rank1") for c in cols])
    return a.join(b, "trading_date", "inner")


def rank_compare(bars: DataFrame, series_a: str, series_b: str) -> DataFrame:
    """Per column of the common dates -- identical, different, max and
    mean absolute difference -- plus same/different underlying counts; one
    aggregate, unpivoted."""
    m = rank_pair(bars, series_a, series_b)
    aggs = [F.count(F.lit(1)).alias("merged"),
            F.count_if(F.col("underlying_instrument_id_rank0") == F.col("underlying_instrument_id_rank1")).alias("same_underlying")]
    for c in _VALS:
        diff = F.abs(F.col(f"{c}_rank0") - F.col(f"{c}_rank1"))
        aggs += [F.count_if(diff == 0).alias(f"{c}__identical"), F.count_if(diff > 0).alias(f"{c}__different"),
                 F.max(diff).cast("double").alias(f"{c}__max_diff"), F.avg(diff).alias(f"{c}__mean_diff")]
    one = m.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col("merged").alias("merged"),
                     F.col("same_underlying").alias("same_underlying"),
                     F.col(f"{c}__identical").alias("identical"), F.col(f"{c}__different").alias("different"),
                     F.col(f"{c}__max_diff").alias("max_diff"), F.col(f"{c}__mean_diff").alias("mean_diff"))
            for c in _VALS]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def rank_differences(bars: DataFrame, series_a: str, series_b: str) -> DataFrame:
    """Rows of the common dates where any value differs."""
    m = rank_pair(bars, series_a, series_b)
    cond = None
    for c in _VALS:
        d = F.col(f"{c}_rank0") != F.col(f"{c}_rank1")
        cond = d if cond is None else (cond | d)
    return m.filter(cond)


def rank_symbols(bars: DataFrame, metadata: DataFrame, series_a: str, series_b: str, n: int = 5) -> DataFrame:
    """Native symbols of both ranks' underlying ids on the first ``n``
    common dates (two lookups of the same dimension, J11)."""
    m = rank_pair(bars, series_a, series_b).orderBy("trading_date").limit(n)
    md = metadata.select("instrument_id", "native_symbol")
    a = md.select(F.col("instrument_id").alias("underlying_instrument_id_rank0"), F.col("native_symbol").alias("symbol_rank0"))
    b = md.select(F.col("instrument_id").alias("underlying_instrument_id_rank1"), F.col("native_symbol").alias("symbol_rank1"))
    return m.select("trading_date", "underlying_instrument_id_rank0", "underlying_instrument_id_rank1") \
            .join(a, "underlying_instrument_id_rank0", "left").join(b, "underlying_instrument_id_rank1", "left") \
            .select("trading_date", "underlying_instrument_id_rank0", "symbol_rank0",
                    "underlying_instrument_id_rank1", "symbol_rank1")
