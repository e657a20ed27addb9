"""Catalogue: symbol jobs and projections."""

from pyspark.sql import functions as F

from ..functions import symbols as S
from ..functions import timefns as TF
from ..operators import normalize as N
from .registry import query

_MONTH_CASE = """case {c} when 'F' then 1 when 'G' then 2 when 'H' then 3 when 'J' then 4 when 'K' then 5 when 'M' then 6
 when 'N' then 7 when 'Q' then 8 when 'U' then 9 when 'V' then 10 when 'X' then 11 when 'Z' then 12 end"""
_OPT = r"'^([A-Z]+)([A-Z])(\d)\s+([CP])(\d+)$'"
_FUT = r"'^([A-Z]+)([A-Z])(\d)$'"
_NAT = r"'^(.{1,4}?)([FGHJKMNQUVXZfghjkmnquvxz])([0-9]+)$'"


@query("normalize_quote_columns", ops="P1", oracle="""
select event_id, ts_event, ts_recv as ts_rcv, instrument_id, bid_px_00 as bid_px, bid_sz_00 as bid_sz,
 ask_px_00 as ask_px, ask_sz_00 as ask_sz, symbol from fx_quote_raw
""")
def q_normalize(t):
    """Vendor level-0 names to plain names, ts_rcv from ts_recv."""
    return N.normalize_quote_columns(t["fx_quote_raw"])


@query("parse_option_symbols", ops="P2 Q5 Q6", oracle=f"""
select event_id, symbol,
 case when regexp_matches(symbol, {_OPT}) then regexp_extract(symbol, {_OPT}, 1) end as root,
 case when regexp_matches(symbol, {_OPT}) then make_date(2020 + cast(regexp_extract(symbol, {_OPT}, 3) as int),
   coalesce({_MONTH_CASE.format(c=f"regexp_extract(symbol, {_OPT}, 2)")}, 1), 15) end as expiry,
 case when regexp_matches(symbol, {_OPT}) then cast(regexp_extract(symbol, {_OPT}, 5) as double) end as strike,
 case when regexp_matches(symbol, {_OPT}) then regexp_extract(symbol, {_OPT}, 4) end as put_call
 from fx_quote_raw
""")
def q_parse_options(t):
    """Option symbols -> root, expiry (15th), strike, put/call."""
    p = S.parse_option_symbol("symbol")
    return t["fx_quote_raw"].select("event_id", "symbol", p["root"].alias("root"), p["expiry"].alias("expiry"),
                                    p["strike"].alias("strike"), p["put_call"].alias("put_call"))


@query("parse_future_symbols", ops="P3 P14", oracle=f"""
select event_id, symbol,
 case when regexp_matches(symbol, {_FUT}) then regexp_extract(symbol, {_FUT}, 1) end as root,
 case when regexp_matches(symbol, {_FUT}) then make_date(2020 + cast(regexp_extract(symbol, {_FUT}, 3) as int),
   coalesce({_MONTH_CASE.format(c=f"regexp_extract(symbol, {_FUT}, 2)")}, 1), 15) end as expiry
 from fx_quote_raw where not contains(symbol, '-')
""")
def q_parse_futures(t):
    """P3 + P14: future symbols after dropping calendar spreads."""
    q = t["fx_quote_raw"].filter(~S.is_calendar_spread("symbol"))
    p = S.parse_future_symbol("symbol")
    return q.select("event_id", "symbol", p["root"].alias("root"), p["expiry"].alias("expiry"))


_NATIVE_SRC = "(select native_symbol from fx_definition_raw union all select symbol as native_symbol from fx_quote_raw)"


@query("parse_native_symbols", ops="P4", oracle=f"""
select native_symbol,
 case when regexp_matches(native_symbol, {_NAT}) then regexp_extract(native_symbol, {_NAT}, 1) end as root,
 case when regexp_matches(native_symbol, {_NAT}) then {_MONTH_CASE.format(c=f"upper(regexp_extract(native_symbol, {_NAT}, 2))")} end as month,
 case when regexp_matches(native_symbol, {_NAT}) then
   case when length(regexp_extract(native_symbol, {_NAT}, 3)) = 1 then 2000 + cast(regexp_extract(native_symbol, {_NAT}, 3) as bigint)
        when cast(regexp_extract(native_symbol, {_NAT}, 3) as bigint) <= 50 then 2000 + cast(regexp_extract(native_symbol, {_NAT}, 3) as bigint)
        else 1900 + cast(regexp_extract(native_symbol, {_NAT}, 3) as bigint) end end as year,
 case when regexp_matches(native_symbol, {_NAT}) then upper(regexp_extract(native_symbol, {_NAT}, 2)) end as month_code
 from {_NATIVE_SRC} s
""")
def q_parse_native(t):
    """Native symbols (definitions and raw quotes) -> root, month, year."""
    spark = t["fx_definition_raw"].sparkSession
    p = S.parse_native_symbol("native_symbol")
    return spark.sql(f"select * from {_NATIVE_SRC} s").select(
        "native_symbol", p["root"].alias("root"), p["month"].alias("month"), p["year"].alias("year"),
        p["month_code"].alias("month_code"))


_CONT_SRC = "(select symbol from fx_ohlcv_raw union all select symbol from fx_quote_raw)"


@query("parse_continuous_symbols", ops="P5 P13", oracle=f"""
select symbol,
 case when len(string_split(symbol, '.')) >= 3 and string_split(symbol, '.')[2] in ('c', 'v', 'o') then string_split(symbol, '.')[1] else symbol end as root,
 case when len(string_split(symbol, '.')) >= 3 and string_split(symbol, '.')[2] in ('c', 'v', 'o') and regexp_matches(string_split(symbol, '.')[3], '^[0-9]+$')
   then cast(string_split(symbol, '.')[3] as int) else 0 end as rank,
 coalesce(regexp_matches(symbol, '\\.c\\.\\d+'), false) as is_calendar_continuous
 from {_CONT_SRC} s
""")
def q_parse_continuous(t):
    """P5 + P13: continuous symbols -> root, rank; calendar-code filter flag."""
    spark = t["fx_ohlcv_raw"].sparkSession
    p = S.parse_continuous_symbol("symbol")
    return spark.sql(f"select * from {_CONT_SRC} s").select(
        "symbol", p["root"].alias("root"), p["rank"].alias("rank"),
        S.is_continuous_symbol("symbol", "c").alias("is_calendar_continuous"))


@query("contract_series_naming", ops="P6 P7 P8 P9", oracle="""
select symbol, strategy, roll_code,
 concat(root, '_', case when contract_rank = 0 then 'FRONT' else concat('RANK_', cast(contract_rank as varchar)) end, '_',
   upper(replace(replace(strategy, '-', '_'), ' ', '_'))) as made_series,
 split_part(contract_series, '_', 1) as series_root,
 case when contains(contract_series, '_FRONT_') then 0 else coalesce(try_cast(regexp_extract(contract_series, 'RANK_(\\d+)', 1) as int), 0) end as rank_a,
 case when contains(contract_series, 'FRONT') then 0 else coalesce(try_cast(regexp_extract(contract_series, 'RANK_(\\d+)', 1) as int), 999) end as rank_b,
 coalesce(try_cast(regexp_extract(contract_series, 'RANK_([0-9]+)', 1) as int), 0) as rank_c
 from (select distinct symbol, root, contract_rank, contract_series,
   case code when 'c' then 'calendar-2d' when 'v' then 'volume' else 'open interest' end as strategy,
   case when code = 'c' then 'c' when code = 'v' then 'v' else 'c' end as roll_code from fx_ohlcv_raw) x
""")
def q_series_naming(t):
    """P6-P9 over every series of the raw bars: build the series name from
    (root, strategy, rank), split it back into root and the three rank forms,
    and map the strategy to its roll code."""
    r = t["fx_ohlcv_raw"].select("symbol", "root", "contract_rank", "contract_series",
                                 F.when(F.col("code") == "c", "calendar-2d").when(F.col("code") == "v", "volume")
                                 .otherwise("open interest").alias("strategy")).distinct()
    return r.select("symbol", "strategy", S.roll_code("strategy").alias("roll_code"),
                    S.make_contract_series("root", "strategy", "contract_rank").alias("made_series"),
                    S.series_root("contract_series").alias("series_root"),
                    S.series_rank("contract_series", "front_or_rank").alias("rank_a"),
                    S.series_rank("contract_series", "sortable").alias("rank_b"),
                    S.series_rank("contract_series", "sql").alias("rank_c"))


@query("expand_universe", ops="P10", oracle="""
with u as (select root, code, optional, unnest(list_sort(list_distinct(flatten(list_transform(
   list_filter(list_transform(string_split(ranks, ','), lambda p: trim(p)), lambda p: p <> ''),
   lambda p: case when contains(p, '-') then generate_series(cast(trim(split_part(p, '-', 1)) as int), cast(trim(regexp_extract(p, '^[^-]*-(.*)$', 1)) as int))
        else [cast(p as int)] end))))) as rank from fx_universe),
 s as (select *, concat(root, '.', code, '.', cast(rank as varchar)) as symbol from u),
 c as (select symbol, count(*) as bars, sum(volume) as volume from fx_ohlcv_raw group by symbol)
select s.root, s.code, s.rank, s.symbol, s.optional, coalesce(c.bars, 0) as raw_rows, coalesce(c.volume, 0) as raw_volume
 from s left join c using (symbol)
""")
def q_expand_universe(t):
    """P10: config roots x rank specs -> one row per continuous symbol, with
    the raw rows and volume found for each symbol."""
    from ..operators.universe import expand_universe
    u = expand_universe(t["fx_universe"])
    c = t["fx_ohlcv_raw"].groupBy("symbol").agg(F.count(F.lit(1)).alias("bars"), F.sum("volume").alias("volume"))
    j = u.join(c, "symbol", "left")
    return j.select("root", "code", "rank", "symbol", "optional", F.coalesce("bars", F.lit(0)).alias("raw_rows"),
                    F.coalesce("volume", F.lit(0)).cast("bigint").alias("raw_volume"))


@query("imm_dates", ops="P11", oracle="""
with m as (select distinct cast(extract(year from trading_date) as int) as year, cast(extract(month from trading_date) as int) as month from fx_bar_daily)
select year, month, cast(make_date(year, month, 1) + cast(((3 - isodow(make_date(year, month, 1)) + 7) % 7) + 14 as integer) as date) as imm_date from m
""")
def q_imm_dates(t):
    """Third Wednesday of every month present in the bars."""
    m = t["fx_bar_daily"].select(F.year("trading_date").alias("year"), F.month("trading_date").alias("month")).distinct()
    return m.select("year", "month", S.imm_date("year", "month").alias("imm_date"))


@query("filter_options", ops="P12", oracle=r"""
select event_id, symbol from fx_quote_raw where regexp_matches(symbol, '\s[CP]\d+$')
""")
def q_filter_options(t):
    """Option rows only."""
    return t["fx_quote_raw"].filter(S.is_option_symbol("symbol")).select("event_id", "symbol")


@query("attach_symbol", ops="P15", oracle="""
select q.event_id, q.instrument_id, coalesce(d.symbol_feed, q.symbol) as symbol
 from fx_quote_raw q left join fx_fut_instrument d using (instrument_id)
""")
def q_attach_symbol(t):
    """Resolved symbol per instrument, falling back to the feed symbol."""
    dim = t["fx_fut_instrument"].select("instrument_id", F.col("symbol_feed").alias("resolved_symbol"))
    return N.attach_symbol(t["fx_quote_raw"].select("event_id", "instrument_id", "symbol"), dim)


@query("trading_date_of", ops="P16 G5", oracle="""
select cast(ts_event as date) as trading_date, count(*) as quotes from fx_quotes group by 1
""")
def q_trading_date_of(t):
    """Trading date chosen by schema (ts_event here), quotes per date."""
    q = t["fx_quotes"]
    return q.groupBy(TF.trading_date_of(q).alias("trading_date")).agg(F.count(F.lit(1)).alias("quotes"))


@query("close_window", rnd=("share_in_window",), ops="P17", oracle="""
with q as (select event_id, ts_event, cast(ts_event as date) as d from fx_quotes),
 b as (select d, timezone('UTC', timezone('America/Chicago', cast(d as timestamp) + interval 15 hour)) as e from (select distinct d from q) x),
 t as (select q.*, q.ts_event between b.e - interval 5 minute and b.e as in_window from q join b using (d))
select d as date, count(*) filter (where in_window) as rows_in_window, count(*) as rows,
 count(*) filter (where in_window) * 1.0 / count(*) as share_in_window from t group by d
""")
def q_close_window(t):
    """Per UTC date, quotes inside the last 5 minutes before the 15:00
    Chicago close (closed bounds) and their share."""
    from ..operators.sessions import close_window_share
    return close_window_share(t["fx_quotes"], minutes=5)


@query("session_tagging", ops="P18 J9 Q18", oracle="""
with q as (select event_id, ts_event from fx_quotes),
 days as (select distinct cast(ts_event as date) + cast(k as integer) as d from q, range(-1, 2) r(k)),
 g as (select d, timezone('UTC', timezone('America/Chicago', cast(d - 1 as timestamp) + interval 17 hour)) as s,
   timezone('UTC', timezone('America/Chicago', cast(d as timestamp) + interval 16 hour)) as e,
   timezone('UTC', timezone('America/Chicago', cast(d as timestamp) + interval 510 minute)) as rs,
   timezone('UTC', timezone('America/Chicago', cast(d as timestamp) + interval 15 hour)) as re from days),
 tagged as (select q.event_id, g.d as globex_date from q join g on q.ts_event >= g.s and q.ts_event <= g.e),
 rth as (select q.event_id, g.d as rth_date from q join g on q.ts_event >= g.rs and q.ts_event <= g.re)
select q.event_id, t.globex_date, r.rth_date from q left join tagged t using (event_id) left join rth r using (event_id)
""")
def q_session_tagging(t):
    """Tag each quote with its Globex session date (17:00 CT d-1 to
    16:00 CT d) and RTH date (08:30-15:00 CT).  Spark computes it per row in
    exchange time; the oracle uses an explicit interval join on a day grid."""
    q = t["fx_quotes"]
    return q.select("event_id", TF.globex_session_date("ts_event").alias("globex_date"),
                    TF.rth_session_date("ts_event").alias("rth_date"))


@query("rename_legacy_series", ops="P19", oracle="""
with legacy as (select case contract_series when 'ES_FRONT_CALENDAR' then 'ES_FRONT_MONTH' when 'NQ_FRONT_CALENDAR' then 'NQ_FRONT_MONTH'
   else contract_series end as contract_series, trading_date from fx_bar_daily),
 once as (select case contract_series when 'ES_FRONT_MONTH' then 'ES_FRONT_CALENDAR_2D' when 'NQ_FRONT_MONTH' then 'NQ_FRONT_CALENDAR_2D'
   else contract_series end as contract_series, trading_date from legacy)
select contract_series, count(*) as rows, min(trading_date) as first_date from once group by 1
""")
def q_rename_legacy(t):
    """Rename applied twice equals once (idempotent)."""
    legacy = t["fx_bar_daily"].withColumn(
        "contract_series", F.when(F.col("contract_series") == "ES_FRONT_CALENDAR", "ES_FRONT_MONTH")
        .when(F.col("contract_series") == "NQ_FRONT_CALENDAR", "NQ_FRONT_MONTH").otherwise(F.col("contract_series")))
    twice = N.rename_legacy_series(N.rename_legacy_series(legacy))
    return twice.groupBy("contract_series").agg(F.count(F.lit(1)).alias("rows"), F.min("trading_date").alias("first_date"))


@query("mid_spread", rnd=("mid", "spread", "spread_pct"), ops="P20", oracle="""
select event_id, (bid_px + ask_px) / 2 as mid, ask_px - bid_px as spread,
 (ask_px - bid_px) / nullif((bid_px + ask_px) / 2, 0) * 100 as spread_pct from fx_quotes
""")
def q_mid_spread(t):
    """P20: mid, spread, spread percent of mid."""
    return N.mid_spread(t["fx_quotes"]).select("event_id", "mid", "spread", "spread_pct")


@query("point_lookup", rnd=("open", "high", "low", "close"), ops="P21", oracle="""
select trading_date, contract_series, underlying_instrument_id, open, high, low, close, volume from fx_bar_daily
 where contract_series in ('ES_FRONT_CALENDAR', 'CL_FRONT_VOLUME') and trading_date between date '1998-01-01' and date '1998-12-31'
""")
def q_point_lookup(t):
    """Series and date-range selection (pushed to the scan when the
    table is partitioned by date)."""
    from ..operators.lookup import point_lookup
    return point_lookup(t["fx_bar_daily"], ["ES_FRONT_CALENDAR", "CL_FRONT_VOLUME"], "1998-01-01", "1998-12-31")
