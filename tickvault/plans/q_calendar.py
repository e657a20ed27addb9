"""Catalogue: calendar, gaps and grids."""

from pyspark.sql import functions as F

from ..operators import calendar as C
from .registry import query


@query("trading_days", ops="G1", oracle="""
select distinct trading_date from fx_bar_daily where trading_date between date '1996-01-01' and date '1997-12-31'
""")
def q_trading_days(t):
    """G1: distinct dates with bars in 1996-1997."""
    return C.trading_days(t["fx_bar_daily"], "1996-01-01", "1997-12-31")


@query("sync_session", ops="G2 J3", oracle="""
with dates as (select distinct trading_date from fx_bar_daily where trading_date is not null),
 existing as (select trading_date as trade_date from dates where trading_date <= date '1998-12-31')
select trading_date as trade_date, cast(weekofyear(trading_date) as int) as week, cast(month(trading_date) as int) as month,
 cast(quarter(trading_date) as int) as quarter, false as is_holiday
 from dates where trading_date not in (select trade_date from existing)
""")
def q_sync_session(t):
    """Session rows (ISO week, month, quarter) for bar dates not yet in a
    session table synced up to 1998-12-31."""
    bars = t["fx_bar_daily"]
    existing = C.sync_session(None, bars.filter(F.col("trading_date") <= F.lit("1998-12-31").cast("date")))
    return C.sync_session(existing, bars)


@query("sync_session_dry_run", ops="G2", oracle="""
with dates as (select distinct trading_date from fx_bar_daily where trading_date is not null)
select count(*) as new_dates, min(trading_date) as first_date, max(trading_date) as last_date from dates where trading_date > date '1998-12-31'
""")
def q_sync_session_dry(t):
    """G2 dry run: count and range of the dates a sync would add."""
    bars = t["fx_bar_daily"]
    existing = C.sync_session(None, bars.filter(F.col("trading_date") <= F.lit("1998-12-31").cast("date")))
    return C.sync_session_dry_run(existing, bars)


@query("session_days", ops="G2b", oracle="""
select distinct trading_date as trade_date from fx_bar_daily where trading_date between date '2000-03-01' and date '2000-06-30'
""")
def q_session_days(t):
    """Session dates in a range from the data-derived session table."""
    return C.session_days(C.sync_session(None, t["fx_bar_daily"]), "2000-03-01", "2000-06-30")


@query("find_gaps", ops="G3 N1", oracle="""
with d as (select distinct contract_series, trading_date from fx_bar_daily where trading_date is not null),
 l as (select *, lag(trading_date) over (partition by contract_series order by trading_date) as prev_date from d)
select contract_series, prev_date, trading_date as next_date, datediff('day', prev_date, trading_date) as gap_days
 from l where datediff('day', prev_date, trading_date) > 3
""")
def q_find_gaps(t):
    """Gaps of more than 3 days in every series (764 at sf0.01)."""
    return C.find_gaps(t["fx_bar_daily"])


_MISSING_WD = """with present as (select distinct contract_series, trading_date as date from fx_bar_daily where trading_date is not null),
 b as (select contract_series, min(date) as s, max(date) as e from present group by 1),
 grid as (select contract_series, cast(unnest(generate_series(s, e, interval 1 day)) as date) as date from b),
 missing as (select g.* from grid g where isodow(g.date) <= 5 and not exists (select 1 from present p where p.contract_series = g.contract_series and p.date = g.date))"""


@query("missing_weekdays", ops="G4", oracle=_MISSING_WD + """
select contract_series, date from missing
""")
def q_missing_weekdays(t):
    """Mon-Fri days without a bar inside each series' own range."""
    return C.missing_weekdays(t["fx_bar_daily"])


@query("missing_weekdays_by_month", ops="G4", oracle=_MISSING_WD + """
select contract_series, strftime(date, '%Y-%m') as month, count(*) as missing_days from missing group by 1, 2
""")
def q_missing_weekdays_month(t):
    """G4 report: missing weekdays per series and month."""
    return C.missing_weekdays_by_month(C.missing_weekdays(t["fx_bar_daily"]))


@query("missing_session_days", ops="G4 G2 Q19", oracle="""
with present as (select distinct contract_series, trading_date as date from fx_bar_daily where trading_date is not null),
 b as (select contract_series, min(date) as s, max(date) as e from present group by 1),
 sess as (select distinct trading_date as date from fx_bar_daily where trading_date is not null),
 grid as (select b.contract_series, sess.date from b join sess on sess.date between b.s and b.e)
select g.contract_series, g.date from grid g
 where not exists (select 1 from present p where p.contract_series = g.contract_series and p.date = g.date)
""")
def q_missing_session_days(t):
    """G4 against the data-derived session calendar (the union of all bar
    dates) instead of Mon-Fri: days some series trades but this one lacks."""
    bars = t["fx_bar_daily"]
    return C.missing_session_days(bars, C.sync_session(None, bars))


@query("existing_dates", ops="G5", oracle="""
select distinct instrument_id, cast(ts_event as date) as date from fx_quotes where ts_event is not null
""")
def q_existing_dates(t):
    """Loaded dates per instrument."""
    return C.existing_dates(t["fx_quotes"], ["instrument_id"])


@query("month_complete", ops="G5b", oracle="""
with e as (select distinct trading_date as date from fx_ohlcv_raw),
 l as (select distinct trading_date as date from fx_bar_daily where contract_series = 'ES_FRONT_CALENDAR')
select strftime(e.date, '%Y-%m') as month, count(*) as expected_dates, count(*) filter (where l.date is null) as missing_dates,
 count(*) filter (where l.date is null) = 0 as complete from e left join l on e.date = l.date group by 1
""")
def q_month_complete(t):
    """Per month, are all raw-file dates loaded for the ES front series?"""
    expected = t["fx_ohlcv_raw"].select(F.col("trading_date").alias("date"))
    loaded = t["fx_bar_daily"].filter(F.col("contract_series") == "ES_FRONT_CALENDAR").select(F.col("trading_date").alias("date"))
    return C.month_complete(expected, loaded)


@query("normalize_business_daily", rnd=("value",), ops="G6 N3 Q8", oracle="""
with o as (select series_id, date, max(value) as value from fx_macro_obs group by 1, 2),
 k as (select distinct series_id from o),
 grid as (select series_id, cast(unnest(generate_series(date '1995-01-01', date '1998-12-31', interval 1 day)) as date) as date from k),
 g as (select grid.series_id, grid.date, o.value from grid left join o using (series_id, date) where isodow(grid.date) <= 5)
select series_id, date, last_value(value ignore nulls) over (partition by series_id order by date rows between unbounded preceding and current row) as value from g
""")
def q_normalize_business_daily(t):
    """Macro series on the Mon-Fri grid of 1995-1998, forward filled
    (weekend observations dropped before the fill, leading nulls kept)."""
    return C.normalize_business_daily(t["fx_macro_obs"], "1995-01-01", "1998-12-31")


@query("minute_coverage", rnd=("coverage_pct",), ops="G7", oracle="""
with m as (select symbol, date_trunc('minute', ts_event) as minute from fx_quote_raw),
 p as (select symbol, count(distinct minute) as minutes_present, min(minute) as first_ts, max(minute) as last_ts from m group by 1)
select symbol, minutes_present, cast(date_diff('second', first_ts, last_ts) / 60 + 1 as bigint) as minutes_expected,
 cast(date_diff('second', first_ts, last_ts) / 60 + 1 as bigint) - minutes_present as minutes_missing,
 minutes_present / cast(date_diff('second', first_ts, last_ts) / 60 + 1 as bigint) as coverage_pct,
 first_ts, last_ts from p
""")
def q_minute_coverage(t):
    """Minutes present / expected / missing per symbol."""
    return C.minute_coverage(t["fx_quote_raw"])


@query("missing_minutes_per_day", ops="G7", oracle="""
with m as (select distinct symbol, date_trunc('minute', ts_event) as minute from fx_quote_raw),
 b as (select symbol, min(minute) as s, max(minute) as e from m group by 1),
 grid as (select symbol, unnest(generate_series(s, e, interval 1 minute)) as minute from b),
 miss as (select g.* from grid g where not exists (select 1 from m where m.symbol = g.symbol and m.minute = g.minute))
select symbol, cast(minute as date) as day, count(*) as missing_minutes from miss group by 1, 2
""")
def q_missing_minutes(t):
    """G7 list form over the whole minute grid, reported per (symbol, day)."""
    miss = C.missing_minutes(t["fx_quote_raw"], by_day=True)
    return miss.select("symbol", "day", F.size("minutes").cast("long").alias("missing_minutes"))


@query("day_count_pivot", ops="G8", oracle="""
select symbol, cast(ts_event as date) as date, count(*) as rows from fx_quote_raw group by 1, 2
""")
def q_day_count(t):
    """Symbol x UTC date row counts (long form)."""
    return C.day_count_pivot(t["fx_quote_raw"])
