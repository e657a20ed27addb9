"""Catalogue: cross-series analytics (X1-X6) and index-series checks."""

from pyspark.sql import functions as F

from ..operators import curves as X
from ..operators import index_quality as IQ
from ..operators.instruments import build_metadata
from .registry import query

_CANON = "(select c.root, b.* from fx_bar_daily b join fx_canonical c on b.contract_series = c.contract_series)"
CS, CE = "1996-01-01", "2000-12-31"
_CURVE = f"""(select trading_date as date, max(case when symbol = '@VX=101XN' then close end) as vx1_close,
   max(case when symbol = '@VX=201XN' then close end) as vx2_close, max(case when symbol = '@VX=301XN' then close end) as vx3_close
  from fx_market_data where trading_date between date '{CS}' and date '{CE}' group by 1
  having count(*) filter (where symbol = '@VX=101XN') > 0)"""
_VIX = "(select date, value as vix_close from fx_macro_obs where series_id = 'VIXCLS' and value is not null)"
_VIX3M = "(select date, value as vix3m_close from fx_macro_obs where series_id = 'SP500' and value is not null)"


def _vix(t):
    return t["fx_macro_obs"].filter((F.col("series_id") == "VIXCLS") & F.col("value").isNotNull()) \
        .select("date", F.col("value").alias("vix_close"))


def _vix3m(t):
    return t["fx_macro_obs"].filter((F.col("series_id") == "SP500") & F.col("value").isNotNull()) \
        .select("date", F.col("value").alias("vix3m_close"))


@query("canonical_bars", rnd=("open", "high", "low", "close"), ops="X1 J6", oracle=f"select * from {_CANON} cb")
def q_canonical_bars(t):
    """Daily bars of the canonical series with their root (6,879 rows at sf0.01)."""
    return X.canonical_bars(t["fx_bar_daily"], t["fx_canonical"])


@query("curve_by_rank", rnd=("vx1_close", "vx2_close", "vx3_close"), ops="X2 J8", oracle=f"select * from {_CURVE} c")
def q_curve(t):
    """VX1..VX3 per date, point 1 drives (the reference's left-join chain
    as one conditional aggregate)."""
    return X.curve_by_rank(t["fx_market_data"], start=CS, end=CE)


@query("vol_spreads", rnd=("vix_close", "vix3m_close", "vx1_close", "vx2_close", "vx3_close", "vix_vx1_spread",
                           "vx2_vx1_slope", "vix3m_vix_spread"), ops="X3 J8", oracle=f"""
select date, vix_close, vix3m_close, vx1_close, vx2_close, vx3_close, vix_close - vx1_close as vix_vx1_spread,
 vx2_close - vx1_close as vx2_vx1_slope, vix3m_close - vix_close as vix3m_vix_spread, vx1_close > vix_close as contango,
 vix_close > vx1_close as backwardation
 from {_VIX} a join {_VIX3M} b using (date) join {_CURVE} c using (date)
""")
def q_vol_spreads(t):
    """VIX, VIX3M and the curve joined by date, spreads and regime flags."""
    return X.vol_spreads(_vix(t), _vix3m(t), X.curve_by_rank(t["fx_market_data"], start=CS, end=CE))


@query("term_spread", rnd=("vix_close", "vix3m_close", "term_spread"), ops="X4 K1", oracle=f"""
select date, vix_close, vix3m_close, vix3m_close - vix_close as term_spread from {_VIX3M} b join {_VIX} a using (date) order by date desc limit 10
""")
def q_term_spread(t):
    """VIX3M - VIX, latest 10 dates."""
    return X.term_spread(_vix(t), _vix3m(t), 10)


_R0, _R1 = "SR3_FRONT_CALENDAR", "SR3_RANK_1_CALENDAR"
_PAIR = f"""(select a.trading_date, a.underlying_instrument_id as u0, b.underlying_instrument_id as u1,
  a.open as open0, b.open as open1, a.high as high0, b.high as high1, a.low as low0, b.low as low1, a.close as close0, b.close as close1,
  a.volume as volume0, b.volume as volume1
  from (select * from fx_bar_daily where contract_series = '{_R0}') a join (select * from fx_bar_daily where contract_series = '{_R1}') b using (trading_date))"""


def _x5_sql():
    parts = []
    for c in ("open", "high", "low", "close", "volume"):
        parts.append(f"""select '{c}' as "column", count(*) as merged, count(*) filter (where u0 = u1) as same_underlying,
 count(*) filter (where abs({c}0 - {c}1) = 0) as identical, count(*) filter (where abs({c}0 - {c}1) > 0) as different,
 cast(max(abs({c}0 - {c}1)) as double) as max_diff, avg(abs({c}0 - {c}1)) as mean_diff from {_PAIR} p""")
    return "\nunion all\n".join(parts)


@query("rank_compare", rnd=("max_diff", "mean_diff"), ops="X5 J10 U3", oracle=_x5_sql())
def q_rank_compare(t):
    """SR3 rank 0 vs rank 1 on common dates, per column statistics."""
    return X.rank_compare(t["fx_bar_daily"], _R0, _R1)


@query("rank_differences", rnd=("open_rank0", "open_rank1", "high_rank0", "high_rank1", "low_rank0", "low_rank1",
                                "close_rank0", "close_rank1"), ops="X5", oracle=f"""
select trading_date, u0 as underlying_instrument_id_rank0, open0 as open_rank0, high0 as high_rank0, low0 as low_rank0, close0 as close_rank0,
 volume0 as volume_rank0, u1 as underlying_instrument_id_rank1, open1 as open_rank1, high1 as high_rank1, low1 as low_rank1,
 close1 as close_rank1, volume1 as volume_rank1
 from {_PAIR} p where open0 <> open1 or high0 <> high1 or low0 <> low1 or close0 <> close1 or volume0 <> volume1
""")
def q_rank_differences(t):
    """The common-date rows where any value differs."""
    return X.rank_differences(t["fx_bar_daily"], _R0, _R1)


@query("rank_symbols", ops="X6 J11 K1", oracle=f"""
with p as (select trading_date, u0, u1 from {_PAIR} p order by trading_date limit 5)
select p.trading_date, p.u0 as underlying_instrument_id_rank0, a.native_symbol as symbol_rank0,
 p.u1 as underlying_instrument_id_rank1, b.native_symbol as symbol_rank1
 from p left join fx_symbol_map a on a.instrument_id = p.u0 left join fx_symbol_map b on b.instrument_id = p.u1
""")
def q_rank_symbols(t):
    """Native symbols of both ranks for the first 5 common dates."""
    md = build_metadata(t["fx_symbol_map"])
    return X.rank_symbols(t["fx_bar_daily"], md, _R0, _R1, 5)


# --- index series -----------------------------------------------------------
_ARRIVAL = """(select series_id, date, value, 1 as src, date as d0 from fx_index_old union all
  select series_id, date, value, 2 as src, date as d0 from fx_index_new)"""


@query("index_quality", rnd=("min_value",), ops="I1 N5", oracle=f"""
with a as (select *, row_number() over (order by src, d0) as arrival from {_ARRIVAL} x),
 s as (select *, (value / nullif(lag(value) over (partition by series_id order by date, src, d0), 0) - 1) * 100 as pct,
   lag(date) over (partition by series_id order by src, d0) as prev_date,
   count(*) over (partition by series_id, date) as n_date from a)
select series_id, count(*) filter (where n_date > 1) as duplicate_date_rows, count(*) filter (where value <= 0) as non_positive,
 min(value) as min_value, min(value) < 100 as below_floor, count(*) filter (where abs(pct) > 20) as large_moves,
 count(*) filter (where date < prev_date) > 0 as not_increasing from s group by 1
""")
def q_index_quality(t):
    """Duplicate dates, non-positive values, floor, large moves and
    arrival-order monotonicity over stored + newly pulled rows."""
    raw = t["fx_index_old"].sparkSession.sql(f"select * from {_ARRIVAL} x")
    return IQ.index_quality(raw.withColumn("arrival", F.struct("src", "d0")), "arrival")


@query("index_freshness", rnd=("years",), ops="I2", oracle="""
with per as (select series_id, count(*) as rows, min(date) as first_date, max(date) as last_date from fx_macro_obs where value is not null group by 1),
 y as (select *, datediff('day', first_date, last_date) / 365.25 as years from per),
 m as (select *, case when years > 5 then 1000 else greatest(50, cast(trunc(years * 200) as int)) end as min_rows from y)
select *, last_date < date '2001-12-01' - interval 10 day as stale, rows < min_rows as too_few_rows,
 (last_date < date '2001-12-01' - interval 10 day) or (rows < min_rows) as fatal from m
""")
def q_index_freshness(t):
    """Staleness against a fixed as-of date and backfill row minimum."""
    obs = t["fx_macro_obs"].filter(F.col("value").isNotNull())
    return IQ.index_freshness(obs, "2001-12-01", True)


@query("history_changes", rnd=("max_pct_diff",), ops="I3", oracle="""
with j as (select o.series_id, o.date, abs(o.value - n.value) as abs_diff, abs(o.value - n.value) / greatest(abs(o.value), 0.01) as pct_diff
  from fx_index_old o join fx_index_new n using (series_id, date) where o.value is not null and n.value is not null)
select series_id, count(*) as overlap_dates, count(*) filter (where pct_diff > 0.0002 or abs_diff > 1.0) as changed_dates,
 max(pct_diff) as max_pct_diff, max_by(date, (pct_diff, date)) as max_diff_date from j group by 1
""")
def q_history_changes(t):
    """Changed history on overlapping dates (19 beyond tolerance at sf0.01)."""
    return IQ.history_changes(t["fx_index_old"], t["fx_index_new"])


@query("merge_new_wins", rnd=("value",), ops="I4 W2", oracle="""
select * from fx_index_old o where not exists (select 1 from fx_index_new n where n.series_id = o.series_id and n.date = o.date)
union all select * from fx_index_new
""")
def q_merge_new_wins(t):
    """I4: stored rows without a new date plus every new row."""
    return IQ.merge_new_wins(t["fx_index_old"], t["fx_index_new"])


@query("source_compare", rnd=("avg_abs_diff_pct",), ops="I5 K1", oracle="""
with j as (select a.series_id, a.date, a.value as a_value, b.value as b_value from fx_index_new a join fx_index_old b using (series_id, date)),
 l as (select * from (select *, row_number() over (partition by series_id order by date desc) as rn from j) x where rn <= 5),
 p as (select series_id, case when a_value is not null and b_value is not null and a_value <> 0 and b_value <> 0 then (a_value - b_value) / b_value * 100 end as pct from l)
select series_id, count(pct) as compared, avg(abs(pct)) as avg_abs_diff_pct, avg(abs(pct)) > 0.5 as warn from p group by 1
""")
def q_source_compare(t):
    """The new pull against the stored series on the last 5 common dates."""
    return IQ.source_compare(t["fx_index_new"], t["fx_index_old"])


_CANDIDATES = """(select series_id, 1 as priority, date, value from fx_index_old where series_id in ('VIXCLS', 'DGS2')
  union all select series_id, 2 as priority, date, value from fx_index_new)"""


@query("source_fallback", rnd=("value",), ops="I6", oracle=f"""
select c.* from {_CANDIDATES} c join (select series_id, min(priority) as priority from {_CANDIDATES} z group by 1) m using (series_id, priority)
""")
def q_source_fallback(t):
    """Primary source where it has rows, else the secondary."""
    c = t["fx_index_old"].sparkSession.sql(f"select * from {_CANDIDATES} c")
    return IQ.source_fallback(c)


_RAWSER = """(select series_id, case when value is null then 'n/a' else cast(value as varchar(40)) end as value,
  cast(date as varchar(10)) as date, case when series_id = 'SP500' then 'stooq' else 'fred' end as source,
  timestamp '2026-01-01 00:00:00' + to_days(cast(extract(day from date) as integer)) as last_updated, date as _order from fx_macro_obs)"""


@query("series_clean", rnd=("value",), ops="I7", oracle=f"""
with r as (select series_id, try_cast(value as double) as value, try_cast(date as date) as date, source, last_updated, _order from {_RAWSER} x),
 f as (select * from r where date is not null and value is not null),
 m as (select series_id, min_by(source, _order) as source, max(last_updated) as last_updated from f group by 1),
 one as (select * from (select *, row_number() over (partition by series_id, date order by _order desc) as rn from f) y where rn = 1)
select one.date, one.series_id, one.value, m.source, m.last_updated from one join m using (series_id)
""")
def q_series_clean(t):
    """Text series coerced, nulls dropped, one row per date, source and last_updated per series."""
    spark = t["fx_macro_obs"].sparkSession
    raw = spark.sql("""select series_id, case when value is null then 'n/a' else cast(value as string) end as value,
      cast(date as string) as date, case when series_id = 'SP500' then 'stooq' else 'fred' end as source,
      timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(extract(day from date)) as last_updated, date as _order from fx_macro_obs""")
    return IQ.series_clean(raw)
