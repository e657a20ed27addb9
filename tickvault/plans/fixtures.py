"""Test inputs derived from the driver's tables.

Each fixture is plain SQL that runs unchanged in Spark SQL and in DuckDB, so
the Spark query and the oracle see the same rows.  Spark binds each view to
the base tables of one ``sf_dir`` at creation time; the oracle receives the
same text as CTEs (``oracle_with``).

Every fixture reads whole driver tables and grows with them.  The dirty-bar
fixture numbers its rows from the row's own columns, not with a global
window, so no fixture funnels a table through one task.
"""

from __future__ import annotations

import re
import threading

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

# name -> SQL, in dependency order.
FIXTURES: dict[str, str] = {}

FIXTURES["fx_quotes"] = """
select event_id, ts as ts_event, ts as ts_rcv, user_id as instrument_id,
 case when event_id % 97 = 0 then null else value end as bid_px, cast(event_id % 50 + 1 as double) as bid_sz,
 value + (event_id % 5 - 1) * cast(0.25 as double) as ask_px, cast(event_id % 40 + 1 as double) as ask_sz
 from events where event_type <> 'purchase'
"""

FIXTURES["fx_trades"] = """
select event_id, ts as ts_event, ts as ts_rcv, user_id as instrument_id, value as last_px,
 cast(event_id % 10 + 1 as double) as last_sz, case event_id % 3 when 0 then 'B' when 1 then 'A' else 'N' end as aggressor
 from events where event_type = 'purchase'
"""

FIXTURES["fx_fut_instrument"] = """
select p_partkey as instrument_id, 'ES' as root, concat('ES', substr('HMUZ', cast(p_partkey % 4 + 1 as int), 1), cast(p_partkey % 10 as varchar(4))) as symbol_feed,
 case when p_partkey % 3 = 0 then null else cast(0.25 as double) end as tick_size from part where p_partkey % 10 <> 9
"""

FIXTURES["fx_ohlcv_raw"] = """
select cast(l_shipdate as date) as trading_date, root, rnk as contract_rank, code,
 concat(root, '.', code, '.', cast(rnk as varchar(4))) as symbol,
 concat(root, '_', case when rnk = 0 then 'FRONT' else concat('RANK_', cast(rnk as varchar(4))) end, '_', case code when 'c' then 'CALENDAR' else 'VOLUME' end) as contract_series,
 cast((extract(year from l_shipdate) * 4 + extract(quarter from l_shipdate)) * 100 + ridx * 10 + rnk as bigint) as underlying_instrument_id,
 px as open, px * (1 + l_tax) as high, px * (1 - l_discount) as low, px * (1 + l_tax) * cast(0.5 as double) + px * (1 - l_discount) * cast(0.5 as double) as close,
 cast(l_quantity as bigint) as volume, l_orderkey, l_linenumber, l_partkey, l_suppkey
 from (select *, l_suppkey % 6 as ridx, l_linenumber % 3 as rnk, l_extendedprice / l_quantity as px,
   case l_suppkey % 6 when 0 then 'ES' when 1 then 'NQ' when 2 then 'ZN' when 3 then 'CL' when 4 then 'GC' else 'SR3' end as root,
   case when l_suppkey % 6 in (2, 3, 4) then 'v' else 'c' end as code from lineitem) x
"""

FIXTURES["fx_bar_daily"] = """
select trading_date, contract_series, max(case when rn_f = 1 then underlying_instrument_id end) as underlying_instrument_id,
 max(case when rn_f = 1 then open end) as open, max(high) as high, min(low) as low, max(case when rn_l = 1 then close end) as close, cast(sum(volume) as bigint) as volume
 from (select *, row_number() over (partition by trading_date, contract_series order by l_orderkey, l_linenumber, l_partkey, l_suppkey, open, volume) as rn_f,
   row_number() over (partition by trading_date, contract_series order by l_orderkey desc, l_linenumber desc, l_partkey desc, l_suppkey desc, open desc, volume desc) as rn_l from fx_ohlcv_raw) y
 group by trading_date, contract_series
"""

FIXTURES["fx_macro_obs"] = """
select cast(o_orderdate as date) as date, case substr(o_orderpriority, 1, 1) when '1' then 'VIXCLS' when '2' then 'DGS2' when '3' then 'DGS10' when '4' then 'SP500' else 'FEDFUNDS' end as series_id,
 case when min(o_orderkey) % 11 = 0 then null else min(o_totalprice) / 1000 end as value from orders group by 1, 2
"""

FIXTURES["fx_definition_raw"] = """
select cast(floor(p_partkey / 5) as bigint) as instrument_id, concat('SYM', cast(p_partkey % 350 as varchar(8))) as native_symbol, p_brand as asset,
 date '2020-01-01' as base_date, p_size as age_days, p_partkey as seq, p_retailprice as min_price_increment_amount from part
"""

FIXTURES["fx_quote_raw"] = """
select event_id, ts_event, ts_rcv as ts_recv, instrument_id, bid_px as bid_px_00, bid_sz as bid_sz_00, ask_px as ask_px_00, ask_sz as ask_sz_00,
 case when event_id % 4 = 0 then concat('ES', substr('HMUZ', cast(instrument_id % 4 + 1 as int), 1), '5')
      when event_id % 4 = 1 then concat('ESH6-ESM', cast(instrument_id as varchar(4)))
      else concat('ES', substr('HMUZ', cast(instrument_id % 4 + 1 as int), 1), '5 ', case when event_id % 2 = 0 then 'C' else 'P' end, cast(6000 + 25 * (event_id % 8) as varchar(8))) end as symbol
 from fx_quotes
"""

FIXTURES["fx_quote_landing"] = """
select *, 1 as batch from fx_quotes union all
 select event_id, ts_event, ts_rcv, instrument_id, bid_px + 1 as bid_px, bid_sz, ask_px + 1 as ask_px, ask_sz, 2 as batch from fx_quotes where event_id % 20 = 0
"""

FIXTURES["fx_continuous_contract"] = """
select contract_series, min(root) as root, min(contract_rank) as contract_rank, 'unadjusted' as adjustment_method from fx_ohlcv_raw group by contract_series
"""

FIXTURES["fx_canonical"] = """
select * from (values ('ES','ES_FRONT_CALENDAR',false), ('NQ','NQ_FRONT_CALENDAR',false), ('ZN','ZN_FRONT_VOLUME',false),
 ('CL','CL_FRONT_VOLUME',false), ('RTY','RTY_FRONT_CALENDAR',false), ('VX','VX_FRONT_CALENDAR',true)) as t(root, contract_series, optional)
"""

FIXTURES["fx_universe"] = """
select * from (values ('ES','c','0-1',false), ('NQ','c','0,1',false), ('ZN','v','0-1',false), ('CL','v','0-3',false), ('SR3','c','0-4,2',false), ('VX','c','0-2',true)) as t(root, code, ranks, optional)
"""

# Row number from the row's own columns (no global window): a pseudo-random
# but deterministic integer per (trading_date, contract_series) row.
FIXTURES["fx_bar_dirty"] = """
select case when rn % 501 = 0 then null else trading_date end as trading_date, contract_series, case when rn % 97 = 0 then -open else open end as open,
 case when rn % 89 = 0 then low - 1 else high end as high, low, case when rn % 83 = 0 then null else close end as close, case when rn % 79 = 0 then -volume else volume end as volume
 from (select *, volume * 7 + extract(day from trading_date) * 31 + extract(month from trading_date) * 373 + extract(year from trading_date) + length(contract_series) * 11 as rn from fx_bar_daily) x
 union all select trading_date, contract_series, open, high, low, close, volume from fx_bar_daily where extract(day from trading_date) = 13
"""

FIXTURES["fx_index_old"] = """
select date, series_id, value from fx_macro_obs where value is not null and date < date '2000-01-01'
"""

FIXTURES["fx_index_new"] = """
select date, series_id, case when extract(day from date) = 7 then value * 1.001 when extract(day from date) = 8 then value * 1.0001 else value end as value
 from fx_macro_obs where value is not null and date >= date '1999-07-01'
"""

FIXTURES["fx_market_data"] = """
select trading_date, case contract_series when 'SR3_FRONT_CALENDAR' then '@VX=101XN' when 'SR3_RANK_1_CALENDAR' then '@VX=201XN' else '@VX=301XN' end as symbol, close
 from fx_bar_daily where contract_series in ('SR3_FRONT_CALENDAR', 'SR3_RANK_1_CALENDAR', 'SR3_RANK_2_CALENDAR')
"""

# Symbol table of the underlying contracts of the raw daily bars (stands in
# for a symbology lookup); rank-2 contracts get a symbol that does not parse.
FIXTURES["fx_symbol_map"] = """
select distinct underlying_instrument_id as instrument_id,
 case when contract_rank = 2 then concat(root, '-BACK') else
 concat(root, substr('HMUZ', cast(extract(quarter from trading_date) as int), 1), substr(cast(extract(year from trading_date) as varchar(4)), 3, 2)) end as native_symbol
 from fx_ohlcv_raw
"""

def _spark_bar_daily(t: dict) -> DataFrame:
    """``fx_bar_daily`` is by definition the B5 consolidation of
    ``fx_ohlcv_raw`` in input order.  Spark builds it with the B5 operator
    (one hash aggregation on a single arrival key; ``l_linenumber`` is 1..7,
    so ``l_orderkey * 8 + l_linenumber`` is unique and ordered like the SQL
    text's order columns) instead of the two full-table windows of the SQL
    text; the query ``daily_consolidate`` checks the two agree."""
    from pyspark.sql import functions as F
    from ..operators.bars import daily_consolidate
    raw = t["fx_ohlcv_raw"].withColumn("arrival", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    return daily_consolidate(raw, ["arrival"]).select(
        "trading_date", "contract_series", "underlying_instrument_id", "open", "high", "low", "close", "volume")


# Spark-side builders that produce exactly the rows of the SQL text.
SPARK_BUILDERS = {"fx_bar_daily": _spark_bar_daily}

_FX_RE = re.compile(r"\bfx_[a-z_0-9]+\b")


def _deps(name: str) -> list[str]:
    return [d for d in dict.fromkeys(_FX_RE.findall(FIXTURES[name])) if d != name]


def closure(names) -> list[str]:
    """Fixture names needed for ``names``, in definition order."""
    need: set[str] = set()
    stack = list(names)
    while stack:
        n = stack.pop()
        if n in need or n not in FIXTURES:
            continue
        need.add(n)
        stack.extend(_deps(n))
    return [n for n in FIXTURES if n in need]


def oracle_with(sql: str) -> str:
    """Prefix ``sql`` with the fixture CTEs it references (for DuckDB)."""
    names = closure(_FX_RE.findall(sql))
    if not names:
        return sql.strip()
    ctes = ",\n".join(f"{n} as ({FIXTURES[n].strip()})" for n in names)
    body = sql.strip()
    if body[:5].lower() == "with ":
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"


_lock = threading.Lock()
_cache: dict[tuple, dict[str, DataFrame]] = {}


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All base tables and fixtures of ``sf_dir`` as lazy DataFrames.

    Views are bound when created (``DataFrame.createOrReplaceTempView`` keeps
    the analysed plan), so fixtures of different ``sf_dir`` never mix.
    """
    key = (spark.sparkContext.applicationId, id(spark), sf_dir.rstrip("/"))
    with _lock:
        if key in _cache:
            return _cache[key]
        out: dict[str, DataFrame] = {}
        for t in BASE_TABLES:
            df = base(spark, sf_dir, t)
            df.createOrReplaceTempView(t)
            out[t] = df
        for n, text in FIXTURES.items():
            df = SPARK_BUILDERS[n](out) if n in SPARK_BUILDERS else spark.sql(text)
            df.createOrReplaceTempView(n)
            out[n] = df
        out["sf_dir"] = sf_dir.rstrip("/")
        _cache[key] = out
        return out


def fx(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load(spark, sf_dir)[name]
