"""Catalogue: readers and sinks (R1-R7, R15, W2 on Parquet, W4, W11, W12, W14)."""

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import readers as R
from ..sources import sinks as W
from .registry import query

_EV = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"


@query("scan_optional", ops="R1", oracle="""
select event_id, ts, user_id, event_type, value from events
""")
def q_scan_optional(t):
    """Declared-schema scan of a glob plus a glob that matches nothing
    (an empty frame of the same schema, not an error)."""
    spark, d = t["events"].sparkSession, t["sf_dir"]
    present = R.scan_optional(spark, f"{d}/events.parquet", _EV)
    absent = R.scan_optional(spark, f"{d}/no_such_table_*.parquet", _EV)
    return present.unionByName(absent)


@query("load_future_instruments", ops="R3", oracle="""
select instrument_id, root, cast(null as date) as expiry, symbol_feed, symbol_feed as symbol_canonical,
 coalesce(tick_size, 0.25) as tick_size, cast(50 as double) as multiplier from fx_fut_instrument
""")
def q_load_fut_instruments(t):
    """Typed futures instrument load with defaults."""
    return R.load_future_instruments(t["fx_fut_instrument"])


@query("load_quotes", ops="R4", oracle="""
select ts_event, ts_rcv, instrument_id, bid_px, bid_sz, ask_px, ask_sz from fx_quotes
""")
def q_load_quotes(t):
    """Typed L1 quote projection (only the declared columns are read)."""
    return R.load_quotes(t["fx_quotes"])


@query("load_trades", ops="R5", oracle="""
select ts_event, ts_rcv, instrument_id, last_px, last_sz, aggressor from fx_trades
""")
def q_load_trades(t):
    """Typed trade projection."""
    return R.load_trades(t["fx_trades"])


@query("load_continuous_contracts", ops="R6", oracle="""
select contract_series, root, cast(null as varchar) as roll_rule, adjustment_method, cast(null as varchar) as description from fx_continuous_contract
""")
def q_load_contracts(t):
    """Five-column contract-definition projection (absent columns null)."""
    return R.load_continuous_contracts(t["fx_continuous_contract"])


@query("load_daily_bars", rnd=("open", "high", "low", "close"), ops="R7", oracle="""
select trading_date, contract_series, underlying_instrument_id, open, high, low, close, volume from fx_bar_daily
""")
def q_load_daily_bars(t):
    """Typed daily bar projection."""
    return R.load_daily_bars(t["fx_bar_daily"])


@query("raw_vs_loaded_dates", ops="R11 R15 U4", oracle="""
with raw as (select distinct trading_date as date from fx_ohlcv_raw),
 loaded as (select trading_date as date from fx_bar_daily where contract_series = 'ES_FRONT_CALENDAR'
   union select trading_date from fx_bar_daily where contract_series = 'NQ_FRONT_CALENDAR')
select date from raw where date not in (select date from loaded where date is not null)
""")
def q_raw_vs_loaded(t):
    """Dates with a raw file (date in the file name) but no loaded row in
    either product."""
    days = t["fx_ohlcv_raw"].select("trading_date").distinct()
    raw_files = days.select(F.concat(F.lit("raw/ohlcv-"), F.col("trading_date").cast("string"),
                                     F.lit(".ohlcv-1d.parquet")).alias("path"))
    b = t["fx_bar_daily"]
    es = b.filter(F.col("contract_series") == "ES_FRONT_CALENDAR").select(F.col("trading_date").alias("date"))
    nq = b.filter(F.col("contract_series") == "NQ_FRONT_CALENDAR").select(F.col("trading_date").alias("date"))
    return R.raw_vs_loaded_dates(raw_files, es, nq)


_QCOLS = "event_id, ts_event, ts_rcv, instrument_id, bid_px, bid_sz, ask_px, ask_sz, batch"


@query("parquet_upsert_roundtrip", ops="W1 W2 W3", oracle=f"""
with old as (select * from fx_quote_landing where batch = 1), new as (select * from fx_quote_landing where batch = 2),
 latest as (select * exclude (rn) from (select *, row_number() over (partition by ts_event, instrument_id order by event_id desc) as rn from new) x where rn = 1),
 first as (select * exclude (rn) from (select *, row_number() over (partition by ts_event, instrument_id order by batch, event_id) as rn from old) x where rn = 1)
select {_QCOLS} from first f where not exists (select 1 from latest l where l.ts_event = f.ts_event and l.instrument_id = f.instrument_id)
union all select {_QCOLS} from latest
""")
def q_parquet_upsert(t):
    """W2 on real files: batch 1 written (first row per key), then batch 2
    upserted into the instrument partitions it touches (buckets of instruments,
    if they are many) through a staging table; the table read back equals the
    merge plan."""
    spark, land = t["fx_quote_landing"].sparkSession, t["fx_quote_landing"]
    path = scratch_path(spark, "quote-table")
    key, order = ["ts_event", "instrument_id"], ["batch", "event_id"]
    W.upsert_ignore(spark, land.filter("batch = 1"), path, key, ["instrument_id"], order)
    W.upsert_replace(spark, land.filter("batch = 2"), path, key, ["instrument_id"], order)
    return W.read_as(spark, path, land.schema).select(*_QCOLS.split(", "))


@query("replace_by_key_list", rnd=("close",), ops="W4", oracle="""
select * from fx_market_data where symbol not in ('@VX=201XN', '@VX=301XN')
union all select trading_date, symbol, close * 2 from fx_market_data where symbol in ('@VX=201XN', '@VX=301XN')
""")
def q_replace_by_key_list(t):
    """The rows of two symbols replaced by a re-synced source."""
    m = t["fx_market_data"]
    src = m.withColumn("close", F.col("close") * 2)
    return W.replace_by_key_list(m, src, ["@VX=201XN", "@VX=301XN"])


_STAMPED = """(select date, series_id, value, case when series_id = 'SP500' then 'stooq' else 'fred' end as source,
  timestamp '2026-01-01 00:00:00' as last_updated from fx_index_new)"""


@query("series_manifest", ops="W11 W14", oracle=f"""
select series_id, count(*) as rows, min(date) as first_date, max(date) as last_date, min(source) as source, max(last_updated) as last_updated
 from {_STAMPED} s group by 1
""")
def q_series_manifest(t):
    """Per-series manifest of stamped series files."""
    stamped = t["fx_index_new"].withColumn("source", F.when(F.col("series_id") == "SP500", "stooq").otherwise("fred")) \
        .withColumn("last_updated", F.lit("2026-01-01 00:00:00").cast("timestamp_ntz"))
    return W.series_manifest(stamped)


@query("stamp_series", rnd=("value",), ops="W14 D2", oracle="""
select date, 'VIXCLS' as series_id, value, 'fred' as source, timestamp '2026-01-01 00:00:00' as last_updated
 from fx_index_new where series_id = 'VIXCLS'
""")
def q_stamp_series(t):
    """One series stamped with id, source and last_updated, one row per date."""
    vix = t["fx_index_new"].filter(F.col("series_id") == "VIXCLS").select("date", "value")
    return W.stamp_series(vix, "VIXCLS", "fred", "2026-01-01 00:00:00", ["value"])


@query("export_quotes", rnd=("bid_px", "ask_px", "spread", "mid"), ops="W12 J6", oracle="""
select q.ts_event, q.instrument_id, d.root, d.symbol_feed, q.bid_px, q.bid_sz, q.ask_px, q.ask_sz,
 q.ask_px - q.bid_px as spread, (q.bid_px + q.ask_px) / 2 as mid from fx_quotes q join fx_fut_instrument d using (instrument_id)
""")
def q_export_quotes(t):
    """The quote export frame (written as CSV by ``export_quotes_csv``)."""
    return W.export_quotes_frame(t["fx_quotes"], t["fx_fut_instrument"])


@query("load_option_instruments", ops="R2 B9", oracle="""
with p as (select instrument_id, ts_event, event_id, symbol from fx_quote_raw where regexp_matches(symbol, '^([A-Z]+)([A-Z])(\\d)\\s+([CP])(\\d+)$')),
 f as (select * from (select *, row_number() over (partition by instrument_id order by ts_event, event_id) as rn from p) x where rn = 1)
select instrument_id, 'American' as exerc_style, cast(50 as double) as multiplier, cast(0.25 as double) as tick_size,
 symbol as symbol_feed, symbol as symbol_canonical from f
""")
def q_load_option_instruments(t):
    """R2: option instruments loaded from a feed that omits the optional
    columns; the defaults (American, 50, 0.25, canonical = feed) fill in."""
    from ..operators.instruments import build_instrument_dim
    dim = build_instrument_dim(t["fx_quote_raw"], "options", ["ts_event", "event_id"])
    raw = dim.select("instrument_id", "root", "expiry", "strike", "put_call", "symbol_feed",
                     *[F.lit(None).cast(ty).alias(c) for c, ty in
                       (("exerc_style", "string"), ("multiplier", "double"), ("tick_size", "double"),
                        ("symbol_canonical", "string"))])
    return R.load_option_instruments(raw).select("instrument_id", "exerc_style", "multiplier", "tick_size",
                                                 "symbol_feed", "symbol_canonical")
