"""Catalogue: rolls, instruments, metadata, definitions."""

from pyspark.sql import functions as F

from .. import schemas
from ..operators import instruments as I
from ..operators import rolls as L
from .registry import query

AS_OF = "2026-01-01 00:00:00"
_NAT = r"'^(.{1,4}?)([FGHJKMNQUVXZfghjkmnquvxz])([0-9]+)$'"
_MONTH = """case upper(regexp_extract(native_symbol, {nat}, 2)) when 'F' then 1 when 'G' then 2 when 'H' then 3 when 'J' then 4
 when 'K' then 5 when 'M' then 6 when 'N' then 7 when 'Q' then 8 when 'U' then 9 when 'V' then 10 when 'X' then 11 when 'Z' then 12 end""".format(nat=_NAT)
_YEAR = f"""case when length(regexp_extract(native_symbol, {_NAT}, 3)) = 1 then 2000 + cast(regexp_extract(native_symbol, {_NAT}, 3) as bigint)
 when cast(regexp_extract(native_symbol, {_NAT}, 3) as bigint) <= 50 then 2000 + cast(regexp_extract(native_symbol, {_NAT}, 3) as bigint)
 else 1900 + cast(regexp_extract(native_symbol, {_NAT}, 3) as bigint) end"""
# Metadata (B11) in SQL: parsed symbol, IMM expiry, active range.
_MD = f"""(select m.instrument_id, m.native_symbol, m.root, m.month, m.year,
   case when m.month is not null then cast(make_date(m.year, m.month, 1) + cast(((3 - isodow(make_date(m.year, m.month, 1)) + 7) % 7) + 14 as integer) as date) end as expiry_date,
   r.first_date as date_range_start, r.last_date as date_range_end
  from (select instrument_id, native_symbol,
     case when regexp_matches(native_symbol, {_NAT}) then regexp_extract(native_symbol, {_NAT}, 1) end as root,
     case when regexp_matches(native_symbol, {_NAT}) then {_MONTH} end as month,
     case when regexp_matches(native_symbol, {_NAT}) then {_YEAR} end as year from fx_symbol_map) m
  left join (select underlying_instrument_id, min(trading_date) as first_date, max(trading_date) as last_date from fx_bar_daily
    where underlying_instrument_id is not null group by 1) r on r.underlying_instrument_id = m.instrument_id)"""
_RANK = r"case when contains(contract_series, '_FRONT_') then 0 else coalesce(try_cast(regexp_extract(contract_series, 'RANK_(\d+)', 1) as int), 0) end"
_ROLLS = f"""(select contract_series, rank, trading_date as roll_date, old_id as old_instrument_id, underlying_instrument_id as new_instrument_id
  from (select contract_series, {_RANK} as rank, trading_date, underlying_instrument_id,
     lag(underlying_instrument_id) over (partition by contract_series, {_RANK} order by trading_date) as old_id
    from fx_bar_daily where underlying_instrument_id is not null) x
  where old_id is not null and old_id <> underlying_instrument_id)"""


def _metadata(t):
    return I.build_metadata(t["fx_symbol_map"], t["fx_bar_daily"], as_of=AS_OF)


@query("build_metadata", ops="B11 B12 P4 P11", oracle=f"""
select *, timestamp '{AS_OF}' as last_updated from {_MD} md
""")
def q_build_metadata(t):
    """Parsed native symbol, IMM expiry and active range per instrument;
    unparsed symbols keep null columns."""
    return _metadata(t)


@query("detect_rolls", ops="L1 J11 N1", oracle=f"""
with md as {_MD}
select r.*, mo.native_symbol as old_native_symbol, mn.native_symbol as new_native_symbol,
 mo.expiry_date as old_expiry_date, mn.expiry_date as new_expiry_date
 from {_ROLLS} r left join md mo on mo.instrument_id = r.old_instrument_id left join md mn on mn.instrument_id = r.new_instrument_id
""")
def q_detect_rolls(t):
    """L1: roll dates of every (series, rank) with old/new symbol and expiry
    (486 rolls at sf0.01)."""
    return L.detect_rolls(t["fx_bar_daily"], _metadata(t))


@query("detect_rolls_raw", ops="L2 Q9", oracle="""
with r as (select root, contract_rank as rank, trading_date,
   min_by(underlying_instrument_id, (l_orderkey, l_linenumber, l_partkey, l_suppkey)) as instrument_id
   from fx_ohlcv_raw where code = 'c' group by 1, 2, 3),
 l as (select *, lag(instrument_id) over (partition by root, rank order by trading_date) as old_id from r where instrument_id is not null)
select root, rank, trading_date as roll_date, old_id as old_instrument_id, instrument_id as new_instrument_id
 from l where old_id is not null and old_id <> instrument_id
""")
def q_detect_rolls_raw(t):
    """L2: rolls from raw calendar-code rows, first id per date by arrival."""
    from .q_bars import _arrival
    return L.detect_rolls_raw(_arrival(t["fx_ohlcv_raw"]), ["arrival"])


_OPT = r"'^([A-Z]+)([A-Z])(\d)\s+([CP])(\d+)$'"


@query("build_instrument_dim", ops="B9 P2 D1", oracle=f"""
with p as (select instrument_id, ts_event, event_id, symbol from fx_quote_raw where regexp_matches(symbol, {_OPT})),
 f as (select * from (select *, row_number() over (partition by instrument_id order by ts_event, event_id) as rn from p) x where rn = 1)
select instrument_id, regexp_extract(symbol, {_OPT}, 1) as root,
 make_date(2020 + cast(regexp_extract(symbol, {_OPT}, 3) as int), coalesce(case regexp_extract(symbol, {_OPT}, 2) when 'F' then 1 when 'G' then 2
  when 'H' then 3 when 'J' then 4 when 'K' then 5 when 'M' then 6 when 'N' then 7 when 'Q' then 8 when 'U' then 9 when 'V' then 10
  when 'X' then 11 when 'Z' then 12 end, 1), 15) as expiry,
 cast(regexp_extract(symbol, {_OPT}, 5) as double) as strike, regexp_extract(symbol, {_OPT}, 4) as put_call,
 'American' as exerc_style, cast(50 as double) as multiplier, cast(0.25 as double) as tick_size, symbol as symbol_feed, symbol as symbol_canonical
 from f
""")
def q_build_instrument_dim(t):
    """Option instrument dimension, first parsed symbol per id wins."""
    return I.build_instrument_dim(t["fx_quote_raw"], "options", ["ts_event", "event_id"])


@query("build_contract_dim", ops="B10 P5 P9", oracle="""
select distinct contract_series, root,
 case code when 'c' then 'databento_calendar' when 'v' then 'databento_volume' else 'databento_open_interest' end as roll_rule,
 'unadjusted' as adjustment_method,
 concat(root, ' continuous ', case when contract_rank = 0 then 'front month' else concat('rank ', cast(contract_rank as varchar)) end,
   ' (roll strategy: ', case code when 'c' then 'calendar' when 'v' then 'volume' else 'open-interest' end,
   ', rule: ', case code when 'c' then 'databento_calendar' when 'v' then 'databento_volume' else 'databento_open_interest' end, ')') as description
 from fx_ohlcv_raw
""")
def q_build_contract_dim(t):
    """One row per continuous series with its description text."""
    return I.build_contract_dim(t["fx_ohlcv_raw"])


@query("instrument_active_range", ops="B12 J4", oracle="""
select underlying_instrument_id, min(trading_date) as first_date, max(trading_date) as last_date from fx_bar_daily
 where underlying_instrument_id is not null and underlying_instrument_id in (select instrument_id from fx_symbol_map where native_symbol not like '%-BACK')
 group by 1
""")
def q_active_range(t):
    """Active range of the ids of a key list (semi join)."""
    ids = t["fx_symbol_map"].filter(~F.col("native_symbol").like("%-BACK"))
    return I.instrument_active_range(t["fx_bar_daily"], ids)


_DEFS = """(select instrument_id, native_symbol as raw_symbol, asset, seq, cast(min_price_increment_amount as varchar(32)) as min_price_increment_amount,
  case when seq % 13 = 0 then null else cast(base_date + cast(age_days as integer) as timestamp) end as ts_event,
  case when seq % 7 = 0 then 'n/a' else cast(age_days as varchar(12)) end as maturity_day from fx_definition_raw)"""

_DUCK_TYPES = {"string": "varchar", "int": "integer", "timestamp_ntz": "timestamp", "bigint": "bigint",
               "double": "double", "date": "date", "boolean": "boolean"}


def _typed_sql(src: str) -> str:
    target = schemas.struct(schemas.DIM_INSTRUMENT_DEFINITION)
    have = {"instrument_id", "native_symbol", "asset", "min_price_increment_amount", "ts_event", "maturity_day"}
    cols = []
    for f in target.fields:
        ty = _DUCK_TYPES[f.dataType.simpleString()]
        q = f'"{f.name}"'
        if f.name == "definition_date":
            cols.append(f"cast(ts_event as date) as {q}")
        elif f.name == "native_symbol":
            cols.append(f"try_cast(raw_symbol as {ty}) as {q}")
        elif f.name in have:
            cols.append(f"try_cast({q} as {ty}) as {q}")
        else:
            cols.append(f"cast(null as {ty}) as {q}")
    return f"select {', '.join(cols)} from {src} s"


def _typed(t):
    raw = t["fx_definition_raw"].sparkSession.sql(f"select * from {_DEFS} d")
    return I.definition_typed(raw)


@query("definition_typed", ops="B13", oracle=_typed_sql(_DEFS))
def q_definition_typed(t):
    """Vendor definitions to the declared 64-column table (renamed,
    try_cast, absent columns null, definition_date from ts_event)."""
    return _typed(t)


@query("latest_definition_view", rnd=("min_price_increment_amount",), ops="B15 D3", oracle=f"""
with typed as ({_typed_sql(_DEFS)}),
 d as (select *, row_number() over (partition by instrument_id order by ts_event desc nulls last, rn0 desc) as rn
   from (select typed.*, s.seq as rn0 from typed join (select instrument_id, ts_event, seq, raw_symbol from {_DEFS} z) s
     on typed.instrument_id = s.instrument_id and typed.native_symbol = s.raw_symbol and typed.ts_event is not distinct from s.ts_event) y)
select {", ".join(schemas.LATEST_DEFINITION_VIEW)} from d where rn = 1
""")
def q_latest_definition_view(t):
    """D3 + B15: the latest definition per instrument through the 24-column view."""
    raw = t["fx_definition_raw"].sparkSession.sql(f"select * from {_DEFS} d")
    latest = I.latest_definitions(raw)
    return I.latest_definition_view(I.definition_typed(latest))


@query("new_definitions", ops="B14 J3 J4", oracle="""
with wanted as (select instrument_id from fx_quotes union select underlying_instrument_id from fx_bar_daily)
select distinct instrument_id from wanted where instrument_id is not null
 and instrument_id not in (select instrument_id from fx_definition_raw where instrument_id is not null)
 and instrument_id in (select underlying_instrument_id from fx_bar_daily)
""")
def q_new_definitions(t):
    """Wanted ids minus known definitions, kept only when they have bars."""
    wanted = t["fx_quotes"].select("instrument_id").unionByName(
        t["fx_bar_daily"].select(F.col("underlying_instrument_id").alias("instrument_id")))
    bars = t["fx_bar_daily"].select(F.col("underlying_instrument_id").alias("instrument_id"))
    return I.new_definitions(wanted, t["fx_definition_raw"], bars)


@query("metadata_summary_root", ops="B16 Q12", oracle=f"""
select root, count(*) as instrument_count, min(expiry_date) as earliest_expiry, max(expiry_date) as latest_expiry
 from {_MD} md where root is not null group by root
""")
def q_metadata_summary_root(t):
    """Per root instruments and expiry range (with the GROUP BY the reference misses)."""
    per_root, _ = I.metadata_summary(_metadata(t), L.detect_rolls(t["fx_bar_daily"]), t["fx_continuous_contract"])
    return per_root


@query("metadata_summary_rolls", ops="B16", oracle=f"""
select r.contract_series, r.rank, count(*) as roll_count, min(r.roll_date) as first_roll, max(r.roll_date) as last_roll
 from {_ROLLS} r join fx_continuous_contract c on r.contract_series = c.contract_series group by 1, 2
""")
def q_metadata_summary_rolls(t):
    """Per (series, rank) roll count and first/last roll."""
    _, per_series = I.metadata_summary(_metadata(t), L.detect_rolls(t["fx_bar_daily"]), t["fx_continuous_contract"])
    return per_series


@query("definition_summary", ops="B17", oracle=f"""
with typed as ({_typed_sql(_DEFS)})
select asset, count(distinct instrument_id) as instrument_count, count(distinct native_symbol) as symbol_count,
 min(definition_date) as earliest_date, max(definition_date) as latest_date from typed group by asset
""")
def q_definition_summary(t):
    """Per asset distinct instruments and symbols, definition date range."""
    return I.definition_summary(_typed(t))


@query("last_trading_date", ops="B18 J6", oracle=f"""
select md.native_symbol, md.expiry_date as expiration, max(b.trading_date) as last_trading_date
 from {_MD} md join fx_bar_daily b on md.instrument_id = b.underlying_instrument_id where md.root = 'SR3' group by 1, 2
""")
def q_last_trading_date(t):
    """Per SR3 contract its expiration and last bar date."""
    defs = _metadata(t).select("instrument_id", "native_symbol", F.col("expiry_date").alias("expiration"),
                               F.col("root").alias("asset"))
    return I.last_trading_date(defs, t["fx_bar_daily"], asset="SR3")
