"""Instrument dimensions, metadata and definitions.

Dimensions are built from the fact tables by aggregation (first seen per id
via ``min_by``), so they scale with the number of instruments, not with the
number of quotes per instrument.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.symbols import (ROLL_CODES, imm_date, parse_continuous_symbol, parse_future_symbol,
                                 parse_native_symbol, parse_option_symbol)
from .dedupe import keep_first, keep_last

# --- fixed values (must equal the reference's) -----------------------------
OPTION_DEFAULTS = {"exerc_style": "American", "multiplier": 50.0, "tick_size": 0.25}
FUTURE_DEFAULTS = {"multiplier": 50.0, "tick_size": 0.25}
ADJUSTMENT_METHOD = "unadjusted"
# ---------------------------------------------------------------------------


def build_instrument_dim(raw: DataFrame, product: str, order: Sequence[str], symbol: str = "symbol") -> DataFrame:
    """One row per instrument id from raw quotes whose symbol parses
    (option or future form); the first row by ``order`` wins; constants
    added."""
    p = parse_option_symbol(symbol) if product == "options" else parse_future_symbol(symbol)
    r = raw.select("instrument_id", *order, p.alias("_p")).filter(F.col("_p").isNotNull())
    first = keep_first(r, ["instrument_id"], order).select("instrument_id", "_p.*")
    if product == "options":
        return first.select("instrument_id", "root", "expiry", "strike", "put_call",
                            F.lit(OPTION_DEFAULTS["exerc_style"]).alias("exerc_style"),
                            F.lit(OPTION_DEFAULTS["multiplier"]).alias("multiplier"),
                            F.lit(OPTION_DEFAULTS["tick_size"]).alias("tick_size"),
                            "symbol_feed", F.col("symbol_feed").alias("symbol_canonical"))
    return first.select("instrument_id", "root", "expiry", "symbol_feed", F.col("symbol_feed").alias("symbol_canonical"),
                        F.lit(FUTURE_DEFAULTS["tick_size"]).alias("tick_size"),
                        F.lit(FUTURE_DEFAULTS["multiplier"]).alias("multiplier"))


def build_contract_dim(raw: DataFrame, symbol: str = "symbol", series: str = "contract_series") -> DataFrame:
    """One row per continuous series: root, roll rule, ``unadjusted``,
    and the description text ``"<root> continuous <front month|rank n>
    (roll strategy: <strategy>, rule: <rule>)"``."""
    meta = raw.sparkSession.createDataFrame(ROLL_CODES, "code string, roll_strategy string, roll_rule string, folder string")
    p = parse_continuous_symbol(symbol)
    r = raw.select(series, p["root"].alias("root"), p["rank"].alias("rank"),
                   F.split(F.col(symbol), r"\.").getItem(1).alias("code")).distinct()
    r = r.join(F.broadcast(meta.drop("folder")), "code", "left")
    rank_txt = F.when(F.col("rank") == 0, F.lit("front month")).otherwise(F.concat(F.lit("rank "), F.col("rank").cast("string")))
    desc = F.concat(F.col("root"), F.lit(" continuous "), rank_txt, F.lit(" (roll strategy: "), F.col("roll_strategy"),
                    F.lit(", rule: "), F.col("roll_rule"), F.lit(")"))
    d = r.select(F.col(series).alias("contract_series"), "root", "roll_rule",
                 F.lit(ADJUSTMENT_METHOD).alias("adjustment_method"), desc.alias("description"))
    return keep_first(d, ["contract_series"], ["root", "roll_rule", "description"])


def instrument_active_range(bars: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """first/last trading date per underlying id (optionally only ids
    in ``ids``, as a semi join)."""
    b = bars.filter(F.col("underlying_instrument_id").isNotNull())
    if ids is not None:
        b = b.join(ids.select(F.col("instrument_id").alias("underlying_instrument_id")), "underlying_instrument_id", "left_semi")
    return b.groupBy("underlying_instrument_id").agg(F.min("trading_date").alias("first_date"),
                                                    F.max("trading_date").alias("last_date"))


def build_metadata(symbol_map: DataFrame, bars: DataFrame | None = None, as_of=None) -> DataFrame:
    """Per instrument the parsed native symbol (root, month, year), the
    IMM expiry (third Wednesday) and the active date range from the bars;
    symbols that do not parse keep null columns.  ``as_of`` stamps
    ``last_updated`` (never the wall clock)."""
    p = parse_native_symbol("native_symbol")
    m = symbol_map.select("instrument_id", "native_symbol", p.alias("_p"))
    m = m.select("instrument_id", "native_symbol", F.col("_p.root").alias("root"), F.col("_p.month").alias("month"),
                 F.col("_p.year").alias("year"))
    m = m.withColumn("expiry_date", F.when(F.col("month").isNotNull(), imm_date("year", "month")))
    if bars is not None:
        rng = instrument_active_range(bars).withColumnRenamed("underlying_instrument_id", "instrument_id")
        m = m.join(rng, "instrument_id", "left").withColumnRenamed("first_date", "date_range_start") \
             .withColumnRenamed("last_date", "date_range_end")
    else:
        m = m.withColumn("date_range_start", F.lit(None).cast("date")).withColumn("date_range_end", F.lit(None).cast("date"))
    return m.withColumn("last_updated", F.lit(as_of).cast("timestamp_ntz"))


def definition_typed(raw: DataFrame) -> DataFrame:
    """Vendor definitions to the declared ~60-column table: renamed,
    every column cast with ``try_cast`` (bad values become null), absent
    columns null, ``definition_date`` = date of ``ts_event``."""
    target = schemas.struct(schemas.DIM_INSTRUMENT_DEFINITION)
    src = raw
    for a, b in schemas.DEFINITION_RENAMES.items():
        if a in src.columns and b not in src.columns:
            src = src.withColumnRenamed(a, b)
    have = set(src.columns)
    cols = []
    for f in target.fields:
        if f.name == "definition_date":
            cols.append(F.to_date(F.col("ts_event")).alias(f.name) if "ts_event" in have else F.lit(None).cast("date").alias(f.name))
        elif f.name in have:
            cols.append(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return src.select(*cols)


def new_definitions(wanted_ids: DataFrame, known: DataFrame, bar_ids: DataFrame | None = None) -> DataFrame:
    """Wanted ids minus known ids; optionally only ids that have bars."""
    w = wanted_ids.select("instrument_id").filter(F.col("instrument_id").isNotNull()).distinct() \
        .join(known.select("instrument_id"), "instrument_id", "left_anti")
    if bar_ids is not None:
        w = w.join(bar_ids.select("instrument_id"), "instrument_id", "left_semi")
    return w


def latest_definition_view(defs: DataFrame) -> DataFrame:
    """The 24-column latest-definition view."""
    return defs.select(*schemas.LATEST_DEFINITION_VIEW)


def latest_definitions(defs: DataFrame) -> DataFrame:
    """D3 on definitions: the latest ``ts_event`` per instrument (nulls last,
    ties by ``seq`` when present)."""
    order = ["ts_event"] + (["seq"] if "seq" in defs.columns else [])
    return keep_last(defs, ["instrument_id"], order)


def metadata_summary(metadata: DataFrame, rolls: DataFrame, contracts: DataFrame):
    """Per root instruments and expiry range (grouped by root, Q12);
    per (series, rank) roll count and first/last roll."""
    per_root = metadata.filter(F.col("root").isNotNull()).groupBy("root").agg(
        F.count(F.lit(1)).alias("instrument_count"), F.min("expiry_date").alias("earliest_expiry"),
        F.max("expiry_date").alias("latest_expiry"))
    r = rolls.join(contracts.select("contract_series", "root"), "contract_series", "inner")
    per_series = r.groupBy("contract_series", "rank").agg(F.count(F.lit(1)).alias("roll_count"),
                                                          F.min("roll_date").alias("first_roll"),
                                                          F.max("roll_date").alias("last_roll"))
    return per_root, per_series


def definition_summary(defs: DataFrame) -> DataFrame:
    """Per asset distinct ids and symbols, first/last definition date."""
    return defs.groupBy("asset").agg(F.count_distinct("instrument_id").alias("instrument_count"),
                                     F.count_distinct("native_symbol").alias("symbol_count"),
                                     F.min("definition_date").alias("earliest_date"),
                                     F.max("definition_date").alias("latest_date"))


def last_trading_date(defs: DataFrame, bars: DataFrame, asset: str | None = None) -> DataFrame:
    """Per contract (symbol, expiration) the last date with a bar.
    Bars are reduced to max date per id before the join."""
    d = defs if asset is None else defs.filter(F.col("asset") == asset)
    last = bars.groupBy(F.col("underlying_instrument_id").alias("instrument_id")).agg(F.max("trading_date").alias("_l"))
    return d.join(last, "instrument_id", "inner").groupBy("native_symbol", "expiration") \
            .agg(F.max("_l").alias("last_trading_date"))
