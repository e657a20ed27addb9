"""Catalogue: coverage and profile reports."""

from pyspark.sql import functions as F

from ..operators import calendar as CAL
from ..operators import coverage as C
from ..operators.bars import bars_futures
from ..operators.curves import canonical_bars
from ..operators.universe import expand_universe
from ..sources.readers import load_future_instruments
from .registry import query

S, E = "1998-01-01", "1998-12-31"
_SESSION = "(select distinct trading_date as trade_date from fx_bar_daily where trading_date is not null)"
_CANON = "(select c.root, b.* from fx_bar_daily b join fx_canonical c on b.contract_series = c.contract_series)"
_ROOT = "split_part(contract_series, '_', 1)"
_RANKSQL = r"coalesce(try_cast(regexp_extract(contract_series, 'RANK_([0-9]+)', 1) as int), 0)"


def _session(t):
    return CAL.sync_session(None, t["fx_bar_daily"])


_C1 = f"""with per as (select contract_series, count(distinct trading_date) as actual_days, min(trading_date) as first_date, max(trading_date) as last_date
   from fx_bar_daily where trading_date >= date '{S}' and trading_date <= date '{E}' group by 1),
 s as (select *, (select count(*) from {_SESSION} z where trade_date >= date '{S}' and trade_date <= date '{E}') as expected_days from per),
 c1 as (select *, expected_days - actual_days as missing_days,
   case when expected_days > 0 then round(actual_days / expected_days * 100 * 100) / 100 else 0.0 end as coverage_pct from s)"""


@query("series_coverage", rnd=("coverage_pct",), ops="C1", oracle=_C1 + "\nselect * from c1")
def q_series_coverage(t):
    """Per series coverage of 1998 against the data-derived session days."""
    return C.series_coverage(t["fx_bar_daily"], _session(t), S, E)[0]


@query("series_coverage_offenders", rnd=("coverage_pct",), ops="C1", oracle=_C1 + "\nselect * from c1 where missing_days > 5")
def q_series_coverage_offenders(t):
    """Series missing more than 5 session days."""
    return C.series_coverage(t["fx_bar_daily"], _session(t), S, E)[1]


@query("series_coverage_totals", rnd=("overall_pct",), ops="C1", oracle=_C1 + """
select count(*) as total_series, cast(sum(actual_days) as bigint) as total_actual, cast(sum(missing_days) as bigint) as total_missing,
 count(*) * max(expected_days) as total_expected,
 case when count(*) * max(expected_days) > 0 then sum(actual_days) / (count(*) * max(expected_days)) * 100 else 0.0 end as overall_pct from c1
""")
def q_series_coverage_totals(t):
    """Totals over all series."""
    return C.series_coverage(t["fx_bar_daily"], _session(t), S, E)[2]


@query("canonical_coverage", rnd=("coverage_pct",), ops="C2 X1", oracle=f"""
with per as (select root, contract_series, count(*) as bar_count, min(trading_date) as first_date, max(trading_date) as last_date
  from {_CANON} cb where trading_date >= date '{S}' and trading_date <= date '{E}' group by 1, 2),
 x as (select *, (select count(*) from {_SESSION} z where trade_date >= date '{S}' and trade_date <= date '{E}') as expected from per)
select *, case when expected > 0 then round(bar_count / expected * 100 * 10) / 10 end as coverage_pct from x
""")
def q_canonical_coverage(t):
    """Canonical roots' bars against the session days of 1998."""
    cb = canonical_bars(t["fx_bar_daily"], t["fx_canonical"])
    return C.canonical_coverage(cb, t["fx_canonical"], _session(t), S, E)[0]


@query("canonical_missing_roots", ops="C2", oracle=f"""
select distinct root from fx_canonical where not optional and root not in
 (select root from {_CANON} cb where trading_date >= date '{S}' and trading_date <= date '{E}')
""")
def q_canonical_missing(t):
    """Required canonical roots without data (RTY)."""
    cb = canonical_bars(t["fx_bar_daily"], t["fx_canonical"])
    return C.canonical_coverage(cb, t["fx_canonical"], _session(t), S, E)[1]


_AUDIT = f"""(select {_ROOT} as root, contract_series, min(trading_date) as first_date, max(trading_date) as last_date, count(*) as row_count,
  coalesce(datediff('day', min(trading_date), max(trading_date)) / 365.25, 0.0) as coverage_years from fx_bar_dirty group by contract_series)"""


@query("audit_series", rnd=("coverage_years",), ops="C3 P7", oracle=f"select * from {_AUDIT} a")
def q_audit(t):
    """Per series root, first, last, rows, years."""
    return C.audit_series(t["fx_bar_dirty"])


@query("best_series_per_root", rnd=("coverage_years",), ops="C4", oracle=f"""
select root, contract_series, first_date, last_date, row_count, coverage_years from
 (select *, row_number() over (partition by root order by row_count desc, last_date desc nulls last, contract_series) as rn from {_AUDIT} a) x where rn = 1
""")
def q_best_series(t):
    """C4: best-covered series per root (most rows, latest end, name)."""
    return C.best_series_per_root(C.audit_series(t["fx_bar_dirty"]))


@query("root_summary", ops="C5", oracle=f"""
select {_ROOT} as root, count(distinct contract_series) as series_count, count(*) as total_rows, min(trading_date) as first_date,
 max(trading_date) as last_date, count(distinct trading_date) as trading_days, cast(sum(volume) as bigint) as total_volume
 from fx_bar_daily group by 1
""")
def q_root_summary(t):
    """Per root series count, rows, range, distinct days, volume."""
    return C.root_summary(t["fx_bar_daily"])


@query("root_rank_summary", ops="C6", oracle=f"""
select {_ROOT} as root, {_RANKSQL} as rank, count(*) as bar_count, count(distinct trading_date) as trading_days,
 min(trading_date) as first_date, max(trading_date) as last_date, cast(sum(volume) as bigint) as total_volume from fx_bar_daily group by 1, 2
union all
select {_ROOT}, null, count(*), count(distinct trading_date), min(trading_date), max(trading_date), cast(sum(volume) as bigint) from fx_bar_daily group by 1
""")
def q_root_rank_summary(t):
    """Per (root, rank) details plus one total row per root (rollup)."""
    return C.root_rank_summary(t["fx_bar_daily"])


@query("missing_ranks", ops="C7 P10", oracle=f"""
with u as (select root, unnest(list_sort(list_distinct(flatten(list_transform(
   list_filter(list_transform(string_split(ranks, ','), lambda p: trim(p)), lambda p: p <> ''),
   lambda p: case when contains(p, '-') then generate_series(cast(trim(split_part(p, '-', 1)) as int), cast(trim(regexp_extract(p, '^[^-]*-(.*)$', 1)) as int))
        else [cast(p as int)] end))))) as rank from fx_universe),
 found as (select distinct {_ROOT} as root, {_RANKSQL} as rank from fx_bar_daily)
select u.root, u.rank from u where not exists (select 1 from found f where f.root = u.root and f.rank = u.rank)
""")
def q_missing_ranks(t):
    """Configured (root, rank) pairs with no bars."""
    return C.missing_ranks(expand_universe(t["fx_universe"]), t["fx_bar_daily"])


@query("series_stats", rnd=("avg_volume", "avg_close"), ops="C8", oracle=f"""
select contract_series, count(*) as bar_count, min(trading_date) as first_date, max(trading_date) as last_date,
 count(distinct trading_date) as trading_days, avg(volume) as avg_volume, cast(sum(volume) as bigint) as total_volume,
 round(avg(close) * 100) / 100 as avg_close from fx_bar_daily where {_ROOT} = 'SR3' group by 1
""")
def q_series_stats(t):
    """Per SR3 series bars, range, days, volume, average close."""
    return C.series_stats(t["fx_bar_daily"], "SR3")


_HBARS = """(select date_trunc('hour', ts_event) as ts_minute, instrument_id, min_by((bid_px + ask_px) / 2, (ts_event, event_id)) as o_mid,
  max_by((bid_px + ask_px) / 2, (ts_event, event_id)) as c_mid from fx_quotes group by 1, 2)"""


def _hbars(t):
    return bars_futures(t["fx_quotes"], t["fx_trades"], 3600, "once", ("ts_event", "event_id"))


@query("quote_summary", ops="C9", oracle=f"""
select count(*) as total_quotes, count(distinct instrument_id) as unique_instruments, min(cast(ts_event as date)) as min_date,
 max(cast(ts_event as date)) as max_date, count(distinct cast(ts_event as date)) as trading_days,
 (select count(*) from fx_fut_instrument) as instrument_count, (select count(*) from {_HBARS} h) as bar_count from fx_quotes
""")
def q_quote_summary(t):
    """One-row product summary."""
    return C.quote_summary(t["fx_quotes"], t["fx_fut_instrument"], _hbars(t))


@query("quotes_by_root", ops="C10 J7 Q16", oracle="""
with per as (select instrument_id, count(*) as n, min(ts_event) as lo, max(ts_event) as hi from fx_quotes group by instrument_id),
 i as (select distinct root, instrument_id, (select count(*) from fx_fut_instrument e where e.instrument_id = d.instrument_id and e.root = d.root) as copies from fx_fut_instrument d)
select root, count(*) as unique_instruments, count(per.n) as instruments_with_quotes, cast(min(lo) as date) as first_date, cast(max(hi) as date) as last_date,
 cast(sum(copies * coalesce(n, 1)) as bigint) as total_rows, cast(sum(copies * coalesce(n, 0)) as bigint) as total_quotes
 from i left join per using (instrument_id) group by root
""")
def q_quotes_by_root(t):
    """Per root from the dimension, with the reference's count(*) quirk."""
    return C.quotes_by_root(t["fx_fut_instrument"], t["fx_quotes"])


@query("quotes_per_contract", rnd=("avg_spread_pts", "avg_total_size"), ops="C11 J6 R3", oracle="""
with per as (select instrument_id, count(*) as n, count(ask_px - bid_px) as ns, sum(ask_px - bid_px) as s, count(bid_sz + ask_sz) as nz, sum(bid_sz + ask_sz) as z,
  min(ts_event) as lo, max(ts_event) as hi from fx_quotes group by instrument_id)
select symbol_feed as symbol, cast(sum(n) as bigint) as quote_count, cast(min(lo) as date) as first_quote, cast(max(hi) as date) as last_quote,
 sum(s) / sum(ns) as avg_spread_pts, sum(z) / sum(nz) as avg_total_size
 from fx_fut_instrument join per using (instrument_id) group by symbol_feed
""")
def q_quotes_per_contract(t):
    """C11: per contract symbol quotes, range, average spread and size."""
    return C.quotes_per_contract(t["fx_quotes"], load_future_instruments(t["fx_fut_instrument"]))


@query("daily_quotes", rnd=("avg_spread_pts",), ops="C12", oracle="""
select cast(ts_event as date) as date, count(*) as quote_count, count(distinct instrument_id) as active_contracts, avg(ask_px - bid_px) as avg_spread_pts
 from fx_quotes group by 1
""")
def q_daily_quotes(t):
    """Per day quotes, active contracts, average spread."""
    return C.daily_quotes(t["fx_quotes"])


@query("bars_per_contract", rnd=("avg_open", "avg_close"), ops="C13 J6", oracle=f"""
select d.symbol_feed as symbol, count(*) as bar_count, min(cast(ts_minute as date)) as first_bar, max(cast(ts_minute as date)) as last_bar,
 avg(o_mid) as avg_open, avg(c_mid) as avg_close
 from {_HBARS} h join fx_fut_instrument d using (instrument_id) group by 1
""")
def q_bars_per_contract(t):
    """Per contract bars, range, average open and close mid."""
    return C.bars_per_contract(_hbars(t), load_future_instruments(t["fx_fut_instrument"]))


def _c14_sql():
    parts = []
    for c in ("open", "high", "low", "close", "volume"):
        parts.append(f"select contract_series, '{c}' as \"column\", cast(min({c}) as double) as min, median({c}) as median, "
                     f"cast(max({c}) as double) as max from fx_bar_daily group by 1")
    return "\nunion all\n".join(parts)


@query("contract_bar_stats", rnd=("min", "median", "max"), ops="C14", oracle=_c14_sql())
def q_contract_bar_stats(t):
    """C14: min / median / max of OHLCV per series."""
    return C.contract_bar_stats(t["fx_bar_daily"])


@query("spread_stats", rnd=("min_spread", "avg_spread", "max_spread", "median_spread"), ops="C15", oracle="""
select d.symbol_feed as symbol, count(*) as quote_count, min(q.ask_px - q.bid_px) as min_spread, avg(q.ask_px - q.bid_px) as avg_spread,
 max(q.ask_px - q.bid_px) as max_spread, percentile_cont(0.5) within group (order by q.ask_px - q.bid_px) as median_spread
 from fx_quotes q join fx_fut_instrument d using (instrument_id) group by 1
""")
def q_spread_stats(t):
    """Spread distribution per contract."""
    return C.spread_stats(t["fx_quotes"], load_future_instruments(t["fx_fut_instrument"]))


@query("day_volume_class", ops="C16", oracle="""
with per as (select instrument_id, cast(ts_event as date) as date, count(*) as quotes from fx_quotes group by 1, 2)
select instrument_id, case when quotes >= 1200 then 'full' when quotes >= 200 then 'partial' when quotes >= 50 then 'very_partial' else 'test' end as day_class,
 count(*) as days, cast(sum(quotes) as bigint) as quotes from per group by 1, 2
""")
def q_day_volume_class(t):
    """Days per instrument and quote-count class."""
    return C.day_volume_class(t["fx_quotes"])


_WANTED = "(select * from (values ('VIXCLS'), ('DGS10'), ('VIX3M')) as w(series_id))"


@query("macro_coverage", ops="C18", oracle=f"""
with per as (select series_id, count(*) as row_count, min(date) as first_date, max(date) as last_date from fx_macro_obs group by 1)
select w.series_id, per.row_count, per.first_date, per.last_date, per.row_count is not null as found from {_WANTED} w left join per using (series_id)
""")
def q_macro_coverage(t):
    """Wanted macro series with rows, range and a found flag."""
    wanted = t["fx_macro_obs"].sparkSession.sql(f"select * from {_WANTED} w")
    return C.macro_coverage(t["fx_macro_obs"], wanted)


@query("table_profile", ops="C19", oracle="""
select contract_series as identifier, count(*) as row_count, min(trading_date) as min_date, max(trading_date) as max_date
 from fx_bar_dirty group by 1
""")
def q_table_profile(t):
    """Profile of a table chosen by column names (date-like, symbol-like)."""
    return C.table_profile(t["fx_bar_dirty"])[2]


_DEFS_ASSET = """(select instrument_id, native_symbol,
  case instrument_id % 10 when 0 then 'ES' when 1 then 'NQ' when 2 then 'RTY' when 3 then 'SI' when 4 then 'GC' when 5 then 'CL'
   when 6 then 'ZT' when 7 then 'ZF' when 8 then 'ZN' else 'UB' end as asset from fx_definition_raw)"""


@query("definitions_vs_bars", ops="C20 J3 J4", oracle="""
with ids as (select distinct instrument_id from fx_quotes where instrument_id is not null)
select d.asset, count(*) filter (where i.instrument_id is not null) as with_bars, count(*) filter (where i.instrument_id is null) as without_bars,
 count(distinct case when i.instrument_id is not null then d.native_symbol end) as unique_symbols_with_bars
 from fx_definition_raw d left join ids i using (instrument_id) where d.asset is not null group by 1
""")
def q_definitions_vs_bars(t):
    """C20: definitions with and without bars per asset."""
    return C.definitions_vs_bars(t["fx_definition_raw"], t["fx_quotes"])[0]


@query("definition_orphans", ops="C20", oracle="""
with ids as (select distinct instrument_id from fx_quotes where instrument_id is not null)
select asset, count(*) as orphans, array_to_string(list_sort(list_distinct(list(native_symbol))), ', ') as symbols
 from fx_definition_raw d where instrument_id not in (select instrument_id from ids) group by 1
""")
def q_definition_orphans(t):
    """C20: orphaned definitions per asset with their symbol list."""
    return C.definitions_vs_bars(t["fx_definition_raw"], t["fx_quotes"])[1]


@query("definitions_expected", ops="C21", oracle=f"""
with y as (select datediff('day', min(trading_date), max(trading_date)) / 365.25 as years from fx_bar_daily),
 per as (select asset, count(*) as actual from {_DEFS_ASSET} d where asset in ('ES','NQ','RTY','SI','GC','CL','ZT','ZF','ZN','UB') group by 1),
 j as (select per.*, case when asset in ('ES','NQ','RTY') then cast(trunc(years * 4) as int) when asset in ('SI','GC','CL') then cast(trunc(years * 12) as int) end as expected from per, y)
select asset, actual, expected, actual - expected as difference, abs((actual - expected) * 100.0 / expected) > 20 as flag from j
""")
def q_definitions_expected(t):
    """Definitions per asset against years x 4 / x 12."""
    defs = t["fx_definition_raw"].sparkSession.sql(f"select * from {_DEFS_ASSET} d")
    return C.definitions_expected(defs, t["fx_bar_daily"])


_DEFINED = "(select instrument_id from fx_symbol_map where native_symbol not like '%-BACK')"


@query("instruments_by_root", ops="C22", oracle=f"""
select {_ROOT} as root, count(distinct underlying_instrument_id) as instruments from fx_bar_daily where underlying_instrument_id is not null group by 1
""")
def q_instruments_by_root(t):
    """Distinct underlying ids per root."""
    return C.instruments_by_root(t["fx_bar_daily"], t["fx_symbol_map"])[0]


@query("instruments_missing_definition", ops="C22 J3", oracle=f"""
select {_ROOT} as root, underlying_instrument_id, min(trading_date) as first_date, max(trading_date) as last_date from fx_bar_daily
 where underlying_instrument_id is not null and underlying_instrument_id not in (select instrument_id from {_DEFINED} d) group by 1, 2
""")
def q_instruments_missing(t):
    """Bar instruments without a (parseable) definition."""
    defs = t["fx_symbol_map"].filter(~F.col("native_symbol").like("%-BACK"))
    return C.instruments_by_root(t["fx_bar_daily"], defs)[1]


@query("delete_orphans", ops="C23 J4", oracle="""
select * from fx_definition_raw where instrument_id in (select instrument_id from fx_quotes)
""")
def q_delete_orphans(t):
    """The definitions table after removing definitions without bars."""
    return C.keep_defined_with_bars(t["fx_definition_raw"], t["fx_quotes"])


_HW_S, _HW_E = "2001-09-01", "2001-11-04"


@query("health_grid", rnd=("pct",), ops="C24 J12", oracle=f"""
with grid as (select r.root, cast(unnest(generate_series(date '{_HW_S}', date '{_HW_E}', interval 1 day)) as date) as date from (select distinct root from fx_canonical) r),
 present as (select distinct root, trading_date as date from {_CANON} cb),
 g as (select grid.root, grid.date, p.date is not null as present from grid left join present p using (root, date))
select root, count(*) filter (where present) as present_days, count(*) filter (where not present) as missing_days, count(*) as days,
 round(count(*) filter (where present) * 100.0 / count(*) * 10) / 10 as pct from g group by root
""")
def q_health_grid(t):
    """Canonical roots x calendar days presence, per-root summary."""
    cb = canonical_bars(t["fx_bar_daily"], t["fx_canonical"])
    return C.health_grid(cb, t["fx_canonical"], _HW_S, _HW_E)[1]


@query("bars_per_day", ops="C25", oracle=f"""
with days as (select cast(unnest(generate_series(date '{_HW_S}', date '{_HW_E}', interval 1 day)) as date) as date),
 per as (select trading_date as date, count(*) as bars from {_CANON} cb group by 1)
select days.date, coalesce(per.bars, 0) as bars from days left join per using (date)
""")
def q_bars_per_day(t):
    """Canonical bars per calendar day, zero days included."""
    cb = canonical_bars(t["fx_bar_daily"], t["fx_canonical"])
    return C.bars_per_day(cb, _HW_S, _HW_E)


@query("root_ranges", ops="C26", oracle=f"""
with per as (select root, min(trading_date) as min_date, max(trading_date) as max_date, count(distinct trading_date) as days from {_CANON} cb group by 1)
select m.root, m.optional, per.min_date, per.max_date, per.days from (select distinct root, optional from fx_canonical) m left join per using (root)
""")
def q_root_ranges(t):
    """Per canonical root its range, distinct days, optional flag."""
    cb = canonical_bars(t["fx_bar_daily"], t["fx_canonical"])
    return C.root_ranges(cb, t["fx_canonical"])


@query("default_window", ops="C27", oracle=f"""
select cast(max(trading_date) - interval 29 day as date) as window_start, max(trading_date) as window_end from {_CANON} cb
""")
def q_default_window(t):
    """The 30-day window ending at the last canonical date."""
    return C.default_window_df(canonical_bars(t["fx_bar_daily"], t["fx_canonical"]), 30)


_OPT = r"'^([A-Z]+)([A-Z])(\d)\s+([CP])(\d+)$'"


@query("option_file_profile", rnd=("time_range_minutes", "median_spread", "median_spread_pct", "avg_symbols_per_minute"),
       ops="C28 P2 P20", oracle=f"""
with q as (select cast(ts_event as date) as file, symbol, ts_recv, bid_px_00 as bid_px, ask_px_00 as ask_px,
  (bid_px_00 + ask_px_00) / 2 as mid, ask_px_00 - bid_px_00 as spr from fx_quote_raw where regexp_matches(symbol, {_OPT})),
 per as (select file, count(*) as total_rows, count(distinct symbol) as unique_symbols,
  count(distinct concat(regexp_extract(symbol, {_OPT}, 2), regexp_extract(symbol, {_OPT}, 3))) as unique_expiries,
  count(distinct date_trunc('minute', ts_recv)) as unique_minutes, date_diff('microsecond', min(ts_recv), max(ts_recv)) / 60e6 as time_range_minutes,
  count(*) filter (where bid_px is null) as missing_bid, count(*) filter (where ask_px is null) as missing_ask,
  count(*) filter (where spr < 0) as negative_spreads, count(*) filter (where bid_px = 0 or ask_px = 0) as zero_prices,
  median(spr) as median_spread, median(spr / nullif(mid, 0) * 100) as median_spread_pct
  from q group by 1)
select *, coalesce(total_rows * 1.0 / nullif(unique_minutes, 0), 0.0) as avg_symbols_per_minute from per
""")
def q_option_file_profile(t):
    """Per daily file of raw vendor quotes: counts, span, quality, median spread."""
    return C.option_file_profile(t["fx_quote_raw"].withColumn("file", F.to_date("ts_event")))


@query("strikes_per_expiry", ops="C29", oracle=f"""
select concat(regexp_extract(symbol, {_OPT}, 2), regexp_extract(symbol, {_OPT}, 3)) as expiry_code, regexp_extract(symbol, {_OPT}, 4) as put_call,
 count(distinct cast(regexp_extract(symbol, {_OPT}, 5) as int)) as strikes from fx_quote_raw where regexp_matches(symbol, {_OPT}) group by 1, 2
""")
def q_strikes(t):
    """Distinct strikes per (expiry, call/put)."""
    return C.strikes_per_expiry(t["fx_quote_raw"])


@query("expiry_distribution", ops="C30", oracle=f"""
select concat(regexp_extract(symbol, {_OPT}, 2), regexp_extract(symbol, {_OPT}, 3)) as expiry_code,
 count(*) filter (where regexp_extract(symbol, {_OPT}, 4) = 'C') as calls, count(*) filter (where regexp_extract(symbol, {_OPT}, 4) = 'P') as puts
 from fx_quote_raw where regexp_matches(symbol, {_OPT}) group by 1
""")
def q_expiry_distribution(t):
    """Calls and puts per expiry code."""
    return C.expiry_distribution(t["fx_quote_raw"])


@query("symbol_count_cv", rnd=("std", "mean", "cv"), ops="C31", oracle="""
with per as (select cast(ts_event as date) as file, count(distinct symbol) as symbols from fx_quote_raw group by 1)
select stddev_pop(symbols) as std, avg(symbols) as mean, count(*) as files, stddev_pop(symbols) / nullif(avg(symbols), 0) as cv,
 stddev_pop(symbols) / nullif(avg(symbols), 0) < 0.05 as consistent from per
""")
def q_symbol_count_cv(t):
    """Coefficient of variation of symbols per daily file."""
    per = t["fx_quote_raw"].groupBy(F.to_date("ts_event").alias("file")).agg(F.count_distinct("symbol").alias("symbols"))
    return C.symbol_count_cv(per)


@query("quote_brief", rnd=("median_spread",), ops="C32", oracle="""
select count(*) as rows, count(distinct symbol) as symbols, min(ts_event) as time_min, max(ts_event) as time_max,
 median(ask_px_00 - bid_px_00) as median_spread from fx_quote_raw
""")
def q_quote_brief(t):
    """Rows, symbols, time range, median spread of the raw vendor quotes."""
    return C.quote_brief(t["fx_quote_raw"])


@query("daily_bar_summary", ops="C33", oracle="""
select min(trading_date) as min_date, max(trading_date) as max_date, count(*) as total_bars, count(distinct contract_series) as unique_series from fx_bar_daily
""")
def q_daily_bar_summary(t):
    """Overall range, bars and series."""
    return C.daily_bar_summary(t["fx_bar_daily"])[0]


@query("daily_bar_summary_by_root", ops="C33", oracle=f"""
select {_ROOT} as root, count(*) as bar_count, min(trading_date) as min_date, max(trading_date) as max_date
 from fx_bar_daily group by 1
""")
def q_daily_bar_summary_root(t):
    """The same per root."""
    return C.daily_bar_summary(t["fx_bar_daily"])[1]
