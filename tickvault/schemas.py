"""Declared table schemas (never inferred).

Flat DDL strings; ``struct`` turns them into StructTypes without a session.
All timestamps are zone-less UTC values (``timestamp_ntz``).
"""

from __future__ import annotations

from pyspark.sql import types as T

DIM_SESSION = "trade_date date, week int, month int, quarter int, is_holiday boolean"
DIM_INSTRUMENT = ("instrument_id bigint, root string, expiry date, strike double, put_call string, exerc_style string, "
                  "multiplier double, tick_size double, symbol_feed string, symbol_canonical string")
DIM_FUT_INSTRUMENT = ("instrument_id bigint, root string, expiry date, symbol_feed string, symbol_canonical string, "
                      "tick_size double, multiplier double")
F_QUOTE_L1 = ("ts_event timestamp_ntz, ts_rcv timestamp_ntz, instrument_id bigint, bid_px double, bid_sz double, "
              "ask_px double, ask_sz double")
F_TRADE = ("ts_event timestamp_ntz, ts_rcv timestamp_ntz, instrument_id bigint, last_px double, last_sz double, "
           "aggressor string")
G_BAR_1M = ("ts_minute timestamp_ntz, instrument_id bigint, o_mid double, h_mid double, l_mid double, c_mid double, "
            "o_spread double, c_spread double, v_trades double, v_notional double")
G_FUT_BAR_1M = ("ts_minute timestamp_ntz, instrument_id bigint, o_mid double, h_mid double, l_mid double, c_mid double, "
                "v_trades double, v_notional double")
DIM_CONTINUOUS_CONTRACT = "contract_series string, root string, roll_rule string, adjustment_method string, description string"
F_CONTINUOUS_QUOTE_L1 = ("ts_event timestamp_ntz, ts_rcv timestamp_ntz, contract_series string, underlying_instrument_id bigint, "
                         "bid_px double, bid_sz double, ask_px double, ask_sz double")
F_CONTINUOUS_TRADE = ("ts_event timestamp_ntz, ts_rcv timestamp_ntz, contract_series string, underlying_instrument_id bigint, "
                      "last_px double, last_sz double, aggressor string")
G_CONTINUOUS_BAR_1M = ("ts_minute timestamp_ntz, contract_series string, underlying_instrument_id bigint, o_mid double, "
                       "h_mid double, l_mid double, c_mid double, v_trades double, v_notional double")
G_CONTINUOUS_BAR_DAILY = ("trading_date date, contract_series string, underlying_instrument_id bigint, open double, "
                          "high double, low double, close double, volume bigint")
DIM_INSTRUMENT_METADATA = ("instrument_id bigint, native_symbol string, root string, month int, year bigint, expiry_date date, "
                           "date_range_start date, date_range_end date, last_updated timestamp_ntz")
DIM_ROLL_DATES = ("contract_series string, rank int, roll_date date, old_instrument_id bigint, new_instrument_id bigint, "
                  "old_native_symbol string, new_native_symbol string, old_expiry_date date, new_expiry_date date")
DIM_FRED_SERIES = "series_id string, name string, source string, last_updated timestamp_ntz"
F_FRED_OBSERVATIONS = "date date, series_id string, value double, source string, last_updated timestamp_ntz"
DIM_CANONICAL_SERIES = "root string, contract_series string, description string, optional boolean"
MARKET_DATA = "timestamp timestamp_ntz, symbol string, open double, high double, low double, close double, volume bigint"

# --- fixed values (must equal the reference's) -----------------------------
# Instrument definition columns and types, in table order.
DIM_INSTRUMENT_DEFINITION = (
    "instrument_id bigint, native_symbol string, definition_date date, ts_event timestamp_ntz, "
    "min_price_increment double, min_price_increment_amount double, contract_multiplier double, "
    "original_contract_size double, contract_multiplier_unit int, expiration timestamp_ntz, maturity_year int, "
    "maturity_month int, maturity_day int, maturity_week int, high_limit_price double, low_limit_price double, "
    "trading_reference_price double, max_price_variation double, min_trade_vol int, max_trade_vol int, "
    "min_lot_size int, min_lot_size_block int, min_lot_size_round_lot int, currency string, settl_currency string, "
    "unit_of_measure string, unit_of_measure_qty double, underlying_id bigint, underlying string, "
    "underlying_product string, asset string, exchange string, `group` string, secsubtype string, "
    "instrument_class string, security_type string, cfi string, user_defined_instrument string, "
    "match_algorithm string, tick_rule int, flow_schedule_type int, market_depth int, market_depth_implied int, "
    "market_segment_id int, md_security_trading_status int, display_factor double, price_display_format int, "
    "main_fraction int, sub_fraction int, activation timestamp_ntz, trading_reference_date date, "
    "decay_start_date date, decay_quantity int, security_update_action string, price_ratio double, "
    "inst_attrib_value int, raw_instrument_id bigint, strike_price double, strike_price_currency string, "
    "settl_price_type int, appl_id int, maturity_year_appl int, channel_id int, last_updated timestamp_ntz")
# Vendor definition field names that differ from the table's.
DEFINITION_RENAMES = {"raw_symbol": "native_symbol"}
# Columns of the latest-definition view, in order.
LATEST_DEFINITION_VIEW = [
    "instrument_id", "native_symbol", "definition_date", "ts_event", "min_price_increment",
    "min_price_increment_amount", "contract_multiplier", "expiration", "maturity_year", "maturity_month",
    "maturity_day", "currency", "unit_of_measure", "unit_of_measure_qty", "asset", "exchange",
    "instrument_class", "security_type", "high_limit_price", "low_limit_price", "min_trade_vol",
    "max_trade_vol", "activation", "last_updated"]
# ---------------------------------------------------------------------------


_TYPES = {"bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(),
          "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(), "timestamp": T.TimestampType(),
          "boolean": T.BooleanType()}


def fields(ddl: str) -> list[tuple[str, str]]:
    """``"a bigint, b string"`` -> [("a", "bigint"), ("b", "string")] (flat
    schemas only; parsed without a Spark session)."""
    out = []
    for part in ddl.split(","):
        name, ty = part.strip().rsplit(" ", 1)
        out.append((name.strip("`"), ty))
    return out


def struct(ddl: str) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t], True) for n, t in fields(ddl)])
