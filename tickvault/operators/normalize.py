"""Column normalisation of vendor quote frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import mid, spread

# --- fixed values (must equal the reference's) -----------------------------
# Level-0 vendor columns and their plain names.
VENDOR_LEVEL0 = {"bid_px_00": "bid_px", "bid_sz_00": "bid_sz", "ask_px_00": "ask_px", "ask_sz_00": "ask_sz"}
# Legacy series names and their replacements (series rename migration).
LEGACY_SERIES = {"ES_FRONT_MONTH": "ES_FRONT_CALENDAR_2D", "NQ_FRONT_MONTH": "NQ_FRONT_CALENDAR_2D"}
# ---------------------------------------------------------------------------


def normalize_quote_columns(df: DataFrame) -> DataFrame:
    """Vendor level-0 names to plain names (only when the plain name is
    absent) and ``ts_rcv`` = ``ts_recv`` if present, else ``ts_event``.
    Decided from the schema, so it is a pure projection."""
    cols = set(df.columns)
    out = df
    for src, dst in VENDOR_LEVEL0.items():
        if src in cols and dst not in cols:
            out = out.withColumnRenamed(src, dst)
    if "ts_rcv" not in cols:
        src = "ts_recv" if "ts_recv" in cols else "ts_event"
        out = out.withColumn("ts_rcv", F.col(src))
        if src == "ts_recv":
            out = out.drop("ts_recv")
    return out


def attach_symbol(df: DataFrame, symbols: DataFrame, key: str = "instrument_id",
                  feed_col: str = "symbol", resolved_col: str = "resolved_symbol") -> DataFrame:
    """Map instrument id to the resolved symbol, falling back to the
    feed symbol.  ``symbols`` is a dimension (one row per id); Catalyst
    broadcasts it when its size estimate is under the threshold."""
    return (df.join(symbols.select(key, resolved_col), key, "left")
              .withColumn(feed_col, F.coalesce(F.col(resolved_col), F.col(feed_col)))
              .drop(resolved_col))


def rename_legacy_series(df: DataFrame, col: str = "contract_series", mapping: dict | None = None) -> DataFrame:
    """Old series names to new; idempotent (new names map to nothing)."""
    m = mapping or LEGACY_SERIES
    lut = F.create_map(*[x for k, v in m.items() for x in (F.lit(k), F.lit(v))])
    return df.withColumn(col, F.coalesce(lut[F.col(col)], F.col(col)))


def mid_spread(df: DataFrame, bid: str = "bid_px", ask: str = "ask_px") -> DataFrame:
    """P20: mid, spread and spread in percent of mid (null when mid is 0)."""
    return (df.withColumn("mid", mid(bid, ask)).withColumn("spread", spread(bid, ask))
              .withColumn("spread_pct", F.try_divide(F.col("spread"), F.col("mid")) * 100))
