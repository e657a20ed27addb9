"""Catalogue: dedupe, keyed merges, windows, top-k and set operations
(D1-D4, W2, W3, W6, N1-N5, K1-K2, U1-U4)."""

from pyspark.sql import functions as F

from ..operators import calendar as C
from ..operators import dedupe as D
from ..operators import sets as U
from ..operators import windows as N
from .registry import query

_QCOLS = "event_id, ts_event, ts_rcv, instrument_id, bid_px, bid_sz, ask_px, ask_sz, batch"
_KEY = ["ts_event", "instrument_id"]


@query("dedupe_keep_first", ops="D1 W3", oracle=f"""
select {_QCOLS} from (select *, row_number() over (partition by ts_event, instrument_id order by batch, event_id) as rn
 from fx_quote_landing) x where rn = 1
""")
def q_keep_first(t):
    """First row per (ts_event, instrument_id) by arrival (batch, event id)."""
    return D.keep_first(t["fx_quote_landing"], _KEY, ["batch", "event_id"])


@query("dedupe_keep_last", ops="D2", oracle=f"""
select {_QCOLS} from (select *, row_number() over (partition by ts_event, instrument_id order by batch desc, event_id desc) as rn
 from fx_quote_landing) x where rn = 1
""")
def q_keep_last(t):
    """Last row per key by arrival."""
    return D.keep_last(t["fx_quote_landing"], _KEY, ["batch", "event_id"])


_DEFS = """(select instrument_id, native_symbol, asset, seq, min_price_increment_amount,
  case when seq % 13 = 0 then null else cast(base_date + cast(age_days as integer) as timestamp) end as ts_event from fx_definition_raw)"""


@query("dedupe_latest_definition", ops="D3", oracle=f"""
select instrument_id, native_symbol, asset, seq, min_price_increment_amount, ts_event from
 (select *, row_number() over (partition by instrument_id order by ts_event desc nulls last, seq desc) as rn from {_DEFS} d) x where rn = 1
""")
def q_latest_definition(t):
    """D3: latest ts_event per instrument, nulls last, ties by highest seq."""
    defs = t["fx_definition_raw"].sparkSession.sql(f"select * from {_DEFS} d")
    return D.latest_definition(defs)


@query("dedupe_minute", ops="D4", oracle="""
select symbol, ts_min, event_id, ts_event from (select symbol, date_trunc('minute', ts_event) as ts_min, event_id, ts_event,
  row_number() over (partition by symbol, date_trunc('minute', ts_event) order by ts_event, event_id) as rn from fx_quote_raw) x where rn = 1
""")
def q_dedupe_minute(t):
    """One row per (symbol, minute), the earliest."""
    q = t["fx_quote_raw"].select("symbol", "event_id", "ts_event")
    return D.dedupe_minute(q, tiebreak="event_id").select("symbol", "ts_min", "event_id", "ts_event")


@query("upsert_replace", ops="W2 I4", oracle=f"""
with old as (select * from fx_quote_landing where batch = 1), new as (select * from fx_quote_landing where batch = 2),
 latest as (select * exclude (rn) from (select *, row_number() over (partition by ts_event, instrument_id order by event_id desc) as rn from new) x where rn = 1)
select {_QCOLS} from old where not exists (select 1 from latest l where l.ts_event = old.ts_event and l.instrument_id = old.instrument_id)
union all select {_QCOLS} from latest
""")
def q_upsert_replace(t):
    """Batch 2 replaces batch-1 rows on the natural key (new row wins whole)."""
    land = t["fx_quote_landing"]
    return D.upsert_replace(land.filter("batch = 1"), land.filter("batch = 2"), _KEY, ["event_id"])


@query("upsert_ignore", ops="W3", oracle=f"""
with old as (select * from fx_quote_landing where batch = 1 and extract(day from ts_event) <= 15),
 new as (select * from fx_quote_landing where batch = 2),
 first as (select * exclude (rn) from (select *, row_number() over (partition by ts_event, instrument_id order by event_id) as rn from new) x where rn = 1)
select {_QCOLS} from first f where not exists (select 1 from old o where o.ts_event = f.ts_event and o.instrument_id = f.instrument_id)
""")
def q_upsert_ignore(t):
    """Rows of batch 2 to append when the table holds batch 1 up to the 15th (existing rows win)."""
    land = t["fx_quote_landing"]
    old = land.filter((F.col("batch") == 1) & (F.dayofmonth("ts_event") <= 15))
    return D.upsert_ignore(old, land.filter("batch = 2"), _KEY, ["event_id"])


@query("insert_missing_dates", rnd=("value",), ops="W6 J5", oracle="""
select n.* from fx_index_new n where not exists (select 1 from fx_index_old o where o.series_id = n.series_id and o.date = n.date)
""")
def q_insert_missing(t):
    """New (series, date) rows only; existing values never overwritten."""
    return D.insert_missing(t["fx_index_old"], t["fx_index_new"], ["series_id", "date"])


@query("lag_compare", ops="N1", oracle="""
select contract_series, trading_date, close, lag(close) over (partition by contract_series order by trading_date) as prev_close from fx_bar_daily
""", rnd=("close", "prev_close"))
def q_lag(t):
    """Previous close per series."""
    b = t["fx_bar_daily"].select("contract_series", "trading_date", "close")
    return N.lag_compare(b, ["contract_series"], ["trading_date"], "close")


@query("lag_chunked", ops="N1", oracle="""
select event_id, symbol, ts_event, lag(ts_event) over (partition by symbol order by event_id) as prev_ts_event from fx_quote_raw
""")
def q_lag_chunked(t):
    """N1 for tick-sized partitions: exact lag by arrival computed in chunks
    of the arrival number (a small width exercises the chunk borders)."""
    q = t["fx_quote_raw"].select("event_id", "symbol", "ts_event")
    return N.lag_chunked(q, ["symbol"], "event_id", "ts_event", 256, out="prev_ts_event")


@query("monthly_quote_summary", rnd=("avg_daily_weighted",), ops="N2 C17", oracle="""
with d as (select cast(ts_event as date) as day, count(*) over (partition by cast(ts_event as date)) as n from fx_quotes)
select cast(extract(year from day) as int) as year, cast(extract(month from day) as int) as month,
 count(distinct day) as days, count(*) as quotes, avg(n) as avg_daily_weighted from d group by 1, 2
""")
def q_monthly(t):
    """Per month days, quotes and the row-weighted average daily count."""
    return N.daily_count_window(t["fx_quotes"])


@query("forward_fill", rnd=("value",), ops="N3", oracle="""
select series_id, date, last_value(value ignore nulls) over (partition by series_id order by date rows between unbounded preceding and current row) as value
 from fx_macro_obs
""")
def q_ffill(t):
    """Last non-null value carried forward per series."""
    return N.forward_fill(t["fx_macro_obs"], ["series_id"], ["date"], "value")


_BOOKS = """(select event_id, ts_event, case when instrument_id % 3 = 0 then null else instrument_id % 40 end as book,
  case when event_id % 9 < 6 then null else bid_px end as px from fx_quotes)"""


@query("forward_fill_ticks", rnd=("px",), ops="N3 G6", oracle=f"""
select event_id, book, last_value(px ignore nulls) over (partition by book order by event_id rows between unbounded preceding and current row) as px
 from {_BOOKS} b
""")
def q_forward_fill_ticks(t):
    """N3 over ticks: a third of all rows have one (null) key; ranges of event
    numbers are filled apart."""
    b = t["fx_quotes"].sparkSession.sql(f"select * from {_BOOKS} b")
    return N.forward_fill_chunked(b, ["book"], "event_id", "px", 5000).select("event_id", "book", "px")


@query("group_size", ops="N4", oracle="""
select event_id, symbol, count(*) over (partition by symbol) as group_size from fx_quote_raw
""")
def q_group_size(t):
    """Rows per symbol attached to each row (aggregate + join back)."""
    return N.group_size(t["fx_quote_raw"].select("event_id", "symbol"), ["symbol"])


@query("pct_change", rnd=("value", "pct_change"), ops="N5", oracle="""
select series_id, date, value, value / nullif(lag(value) over (partition by series_id order by date), 0) - 1 as pct_change from fx_index_new
""")
def q_pct_change(t):
    """Value / previous - 1 per series."""
    return N.pct_change(t["fx_index_new"], ["series_id"], ["date"], "value")


@query("latest_bars", rnd=("open", "high", "low", "close"), ops="K1", oracle="""
select * from fx_bar_daily order by trading_date desc, contract_series limit 10
""")
def q_latest(t):
    """K1: the 10 latest daily bars (top-k, the limit is the feature)."""
    return N.latest_n(t["fx_bar_daily"], [F.desc("trading_date"), F.asc("contract_series")], 10)


@query("latest_per_series", rnd=("value",), ops="K1", oracle="""
select series_id, date, value, rn from (select *, row_number() over (partition by series_id order by date desc) as rn from fx_macro_obs) x where rn <= 3
""")
def q_latest_per_series(t):
    """K1: last 3 observations per series."""
    return N.head_per_group(t["fx_macro_obs"], ["series_id"], [F.desc("date")], 3)


@query("head_tail_per_series", rnd=("close",), ops="K2", oracle="""
select contract_series, trading_date, close, 'head' as part from (select *, row_number() over (partition by contract_series order by trading_date) as rn from fx_bar_daily) x where rn <= 5
union all
select contract_series, trading_date, close, 'tail' from (select *, row_number() over (partition by contract_series order by trading_date desc) as rn from fx_bar_daily) x where rn <= 5
""")
def q_head_tail(t):
    """K2: first and last 5 bars of every series."""
    b = t["fx_bar_daily"].select("contract_series", "trading_date", "close")
    h = N.head_per_group(b, ["contract_series"], [F.asc("trading_date")], 5).drop("rn").withColumn("part", F.lit("head"))
    tl = N.head_per_group(b, ["contract_series"], [F.desc("trading_date")], 5).drop("rn").withColumn("part", F.lit("tail"))
    return h.unionByName(tl)


@query("table_counts", ops="U1", oracle="""
select 'dim_continuous_contract' as table_name, count(*) as row_count, count(distinct contract_series) as unique_keys from fx_continuous_contract
union all select 'g_continuous_bar_daily', count(*), count(distinct contract_series) from fx_bar_daily
union all select 'f_fut_quote_l1', count(*), count(distinct instrument_id) from fx_quotes
""")
def q_table_counts(t):
    """Row and distinct-key counts of the existing tables (a missing one is skipped)."""
    return U.table_counts({"dim_continuous_contract": (t["fx_continuous_contract"], "contract_series"),
                           "g_continuous_bar_1m": (None, "contract_series"),
                           "g_continuous_bar_daily": (t["fx_bar_daily"], "contract_series"),
                           "f_fut_quote_l1": (t["fx_quotes"], "instrument_id")})


@query("quality_counts", ops="U2", oracle="""
select 'Total Quotes' as check_name, count(*) as count from fx_quotes
union all select 'Quotes with NULL bid', count(*) from fx_quotes where bid_px is null
union all select 'Quotes with NULL ask', count(*) from fx_quotes where ask_px is null
union all select 'Quotes with zero bid', count(*) from fx_quotes where bid_px = 0
union all select 'Quotes with crossed market', count(*) from fx_quotes where bid_px > ask_px
union all select 'Quotes with negative spread', count(*) from fx_quotes where (ask_px - bid_px) < 0
""")
def q_quality_counts(t):
    """Six quote counts from one scan."""
    return U.quality_counts(t["fx_quotes"])


@query("date_overlap", ops="U3 J10", oracle="""
with a as (select distinct trading_date as d from fx_bar_daily where contract_series = 'SR3_FRONT_CALENDAR'),
 b as (select distinct trading_date as d from fx_bar_daily where contract_series = 'SR3_RANK_1_CALENDAR')
select (select count(*) from a where d in (select d from b)) as common, (select count(*) from a where d not in (select d from b)) as only_a,
 (select count(*) from b where d not in (select d from a)) as only_b
""")
def q_date_overlap(t):
    """Common and one-sided dates of two series."""
    b = t["fx_bar_daily"]
    return C.date_overlap(b.filter(F.col("contract_series") == "SR3_FRONT_CALENDAR"),
                          b.filter(F.col("contract_series") == "SR3_RANK_1_CALENDAR"))


@query("union_dates", ops="U4 G5", oracle="""
select distinct cast(ts_event as date) as date from fx_quotes union select distinct cast(ts_event as date) from fx_trades
""")
def q_union_dates(t):
    """U4: union of the loaded dates of two products."""
    return C.union_dates(C.existing_dates(t["fx_quotes"]), C.existing_dates(t["fx_trades"]))
