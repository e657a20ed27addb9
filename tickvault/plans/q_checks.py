"""Catalogue: data-quality checks."""

from pyspark.sql import functions as F

from ..operators import checks
from .registry import query

def _chk_sql(cid, name, sev, expr_sql, unit="violations"):
    """Oracle text of one check row from a scalar subquery."""
    return f"""select '{cid}' as check_id, '{name}' as name,
 case when v = 0 then 'PASS' when '{sev}' = 'WARN' then 'WARN' else 'FAIL' end as status, '{sev}' as severity,
 cast(v as bigint) as violations, case when v = 0 then 'ok' else concat(cast(v as varchar), ' {unit}') end as message
 from ({expr_sql}) s(v)"""


@query("check_negative_spread", ops="V1", oracle=_chk_sql(
    "quotes.negative_spread", "Negative spreads", "HARD", "select count(*) from fx_quotes where ask_px < bid_px"))
def q_neg_spread(t):
    """V1 on the quote fixture (1,590 crossed quotes at sf0.01)."""
    return checks.negative_spread(t["fx_quotes"])


@query("check_unlinked", ops="V2 J2", oracle=_chk_sql(
    "quotes.unlinked", "Unlinked instruments (quotes)", "HARD",
    "select count(*) from fx_quotes q left join fx_fut_instrument d using (instrument_id) where d.instrument_id is null")
    + "\nunion all\n" + _chk_sql(
    "trades.unlinked", "Unlinked instruments (trades)", "HARD",
    "select count(*) from fx_trades t left join fx_fut_instrument d using (instrument_id) where d.instrument_id is null"))
def q_unlinked(t):
    """V2: quotes and trades without an instrument row."""
    return checks.unlinked({"quotes": t["fx_quotes"], "trades": t["fx_trades"]}, t["fx_fut_instrument"])


def _v3_sql():
    conds = [
        "select count(*) from (select trading_date, contract_series from fx_bar_dirty group by 1, 2 having count(*) > 1)",
        "select count(*) from fx_bar_dirty where volume < 0",
        "select count(*) from fx_bar_dirty where split_part(contract_series, '_', 1) != 'CL' and (open <= 0 or high <= 0 or low <= 0 or close <= 0)",
        "select count(*) from fx_bar_dirty where split_part(contract_series, '_', 1) = 'CL' and (open is null or high is null or low is null or close is null)",
        "select count(*) from fx_bar_dirty where trading_date is null",
        "select count(*) from fx_bar_dirty where contract_series is null",
        "select count(*) from fx_bar_dirty where close is null",
        "select count(*) from fx_bar_dirty where high < low",
        "select count(*) from fx_bar_dirty where high < open",
        "select count(*) from fx_bar_dirty where high < close",
        "select count(*) from fx_bar_dirty where low > open",
        "select count(*) from fx_bar_dirty where low > close",
    ]
    return "\nunion all\n".join(
        _chk_sql(f"continuous_daily.validator.{checks.slug(n)}", f"Continuous daily: {n}", "HARD", c)
        for n, c in zip(checks.DAILY_BAR_CHECKS, conds))


@query("check_daily_bars", ops="V3", oracle=_v3_sql())
def q_daily_bars(t):
    """V3: twelve daily-bar checks on the dirty-bar fixture, one scan."""
    return checks.daily_bar_violations(t["fx_bar_dirty"])


@query("check_duplicates_summary", ops="V4", oracle="""
select count(*) as total_rows, count(distinct (ts_event, instrument_id)) as unique_rows,
 count(*) - count(distinct (ts_event, instrument_id)) as duplicate_count from fx_quote_landing
""")
def q_dup_summary(t):
    """V4: total rows, distinct keys and their difference."""
    return checks.duplicates_detail(t["fx_quote_landing"], ["ts_event", "instrument_id"])[0]


@query("check_duplicates_top", ops="V4 K3", oracle="""
select ts_event, instrument_id, count(*) as dup_count from fx_quote_landing group by 1, 2 having count(*) > 1
 order by dup_count desc, ts_event nulls first, instrument_id nulls first limit 10
""")
def q_dup_top(t):
    """V4/K3: the 10 most repeated keys."""
    return checks.duplicates_detail(t["fx_quote_landing"], ["ts_event", "instrument_id"])[1]


def _v5_sql():
    parts = []
    tabs = {"f_quote_l1": "fx_quote_landing", "f_fut_quote_l1": "fx_quotes",
            "g_continuous_bar_daily": "fx_bar_dirty", "f_fred_observations": "fx_macro_obs"}
    for table, cols in checks.FACT_KEYS:
        cid = f"integrity.duplicates.{table}"
        name = f"Duplicates absent: {table} on ({', '.join(cols)})"
        if table not in tabs:
            parts.append(f"select '{cid}' as check_id, '{name}' as name, 'SKIP' as status, 'INFO' as severity, "
                         "cast(0 as bigint) as violations, 'table not present' as message")
            continue
        c = ", ".join(cols)
        parts.append(_chk_sql(cid, name, "HARD", f"select count(*) from (select {c} from {tabs[table]} group by {c} having count(*) > 1)",
                              unit="duplicate key groups"))
    return "\nunion all\n".join(parts)


@query("check_duplicate_keys", ops="V5", oracle=_v5_sql())
def q_dup_keys(t):
    """V5: duplicate key groups of five tables; the absent one is SKIP."""
    return checks.duplicate_keys({"f_quote_l1": t["fx_quote_landing"], "f_fut_quote_l1": t["fx_quotes"],
                                  "f_continuous_quote_l1": None, "g_continuous_bar_daily": t["fx_bar_dirty"],
                                  "f_fred_observations": t["fx_macro_obs"]})


_CANON = "(select c.root, b.* from fx_bar_dirty b join fx_canonical c on b.contract_series = c.contract_series)"


@query("check_canonical_unique", ops="V6", oracle=_chk_sql(
    "canonical.view.unique_root_date", "Canonical daily view: unique (root, trading_date)", "HARD",
    f"select count(*) from (select root, trading_date from {_CANON} x group by 1, 2 having count(*) > 1)",
    unit="duplicate root-date groups"))
def q_canonical_unique(t):
    """V6: duplicate (root, date) in the canonical view over dirty bars."""
    from ..operators.curves import canonical_bars
    return checks.canonical_unique(canonical_bars(t["fx_bar_dirty"], t["fx_canonical"]))


@query("check_canonical_presence", ops="V7 C27", oracle="""
with cb as (select c.root, b.* from fx_bar_daily b join fx_canonical c on b.contract_series = c.contract_series),
 w as (select max(trading_date) as e, cast(max(trading_date) - interval 29 day as date) as s from cb),
 per as (select root, max(trading_date) as last_trading_date,
   count(*) filter (where trading_date >= (select s from w) and trading_date <= (select e from w)) as rows_in_window from cb group by root)
select m.root, m.optional, per.last_trading_date, coalesce(per.rows_in_window, 0) as rows_in_window,
 (not m.optional) and coalesce(per.rows_in_window, 0) = 0 as missing_required
 from (select distinct root, optional from fx_canonical) m left join per using (root)
""")
def q_canonical_presence(t):
    """V7 over the default 30-day window ending at the last canonical date."""
    from ..operators.curves import canonical_bars
    from ..operators.coverage import default_window_df
    cb = canonical_bars(t["fx_bar_daily"], t["fx_canonical"])
    w = default_window_df(cb, 30)
    return checks.canonical_presence(cb, t["fx_canonical"], w.select("window_start").scalar(), w.select("window_end").scalar())


@query("check_presence_row", ops="V7 C27", oracle=_chk_sql(
    "canonical.view.presence_recent_window", "Canonical daily view: non-optional roots present in window", "WARN",
    """select count(*) from (select root from fx_canonical where not optional except
     select c.root from fx_bar_daily b join fx_canonical c using (contract_series)
      where date_diff('day', b.trading_date, (select max(x.trading_date) from fx_bar_daily x join fx_canonical using (contract_series))) < 30) r""",
    unit="required roots without rows"))
def q_presence_row(t):
    """V7 as a check row: required roots without a row in the last 30 days."""
    from ..operators.curves import canonical_bars
    return checks.presence_check(canonical_bars(t["fx_bar_daily"], t["fx_canonical"]), t["fx_canonical"], 30)


_ACTUAL_MAP = """(select root, min(contract_series) as contract_series, false as optional from fx_continuous_contract
  where contract_rank = 0 group by root)"""


@query("check_mapping_diff", ops="V8", oracle=f"""
select coalesce(e.root, a.root) as root,
 case when a.root is null then 'missing' when e.root is null then 'extra' else 'changed' end as diff,
 e.contract_series as exp_contract_series, e.optional as exp_optional, a.contract_series as act_contract_series, a.optional as act_optional
 from fx_canonical e full outer join {_ACTUAL_MAP} a on e.root = a.root
 where a.root is null or e.root is null or e.contract_series is distinct from a.contract_series or e.optional is distinct from a.optional
""")
def q_mapping_diff(t):
    """V8: canonical config against the map found in the series table."""
    spark = t["fx_canonical"].sparkSession
    return checks.mapping_diff(t["fx_canonical"], spark.sql(f"select * from {_ACTUAL_MAP} a"))


@query("check_mapping_row", ops="V8", oracle=_chk_sql(
    "canonical.mapping.sync", "Canonical mapping matches configs/canonical_series.yaml", "HARD",
    f"""select count(*) from (
     (select root, contract_series, optional from fx_canonical except select root, contract_series, optional from {_ACTUAL_MAP} a
      union select root, contract_series, optional from {_ACTUAL_MAP} a2 where root not in (select root from fx_canonical))) r""",
    unit="roots that differ"))
def q_mapping_row(t):
    """V8 as a check row."""
    spark = t["fx_canonical"].sparkSession
    return checks.mapping_check(t["fx_canonical"], spark.sql(f"select * from {_ACTUAL_MAP} a"))


@query("check_session_fresh", ops="V9 G2", oracle="""
with sess as (select distinct trading_date as trade_date from fx_bar_daily where trading_date <= date '2001-06-30'),
 s as (select count(*) as n, max(trade_date) as m from sess), b as (select count(*) as n, max(trading_date) as m from fx_bar_daily),
 v as (select case when b.n > 0 and s.n = 0 then 1 else 0 end as populated,
   case when b.m is null then null when s.m is null or s.m < b.m then 1 else 0 end as fresh from s, b)
select 'calendar.dim_session.populated' as check_id, 'dim_session populated (data-derived calendar)' as name,
 case when populated = 0 then 'PASS' else 'FAIL' end as status, 'HARD' as severity, cast(populated as bigint) as violations,
 case when populated = 0 then 'ok' else concat(cast(populated as varchar), ' violations') end as message from v
union all
select 'calendar.dim_session.fresh', 'dim_session includes latest continuous daily date',
 case when fresh is null then 'SKIP' when fresh = 0 then 'PASS' else 'FAIL' end, 'HARD', cast(coalesce(fresh, 0) as bigint),
 case when fresh is null then 'table not present' when fresh = 0 then 'ok' else concat(cast(fresh as varchar), ' violations') end from v
""")
def q_session_fresh(t):
    """V9: a session calendar synced up to 2001-06-30 is behind the bars."""
    from ..operators.calendar import sync_session
    bars = t["fx_bar_daily"]
    sess = sync_session(None, bars.filter(F.col("trading_date") <= F.lit("2001-06-30").cast("date")))
    return checks.session_fresh(sess, bars)


@query("check_quote_window", ops="V11 N4 Q10", oracle="""
with q as (select symbol, event_id, ts_event, bid_px_00 as bid_px, ask_px_00 as ask_px,
   lag(ts_event) over (partition by symbol order by event_id) as prev_ts from fx_quote_raw)
select symbol, count(*) as n_rows, min(ts_event) as first_ts, max(ts_event) as last_ts,
 (select date_diff('second', min(ts_event), max(ts_event)) > 600 from q) as span_too_wide,
 (select count(distinct cast(timezone('America/Chicago', timezone('UTC', ts_event)) as date)) from q) as chicago_dates,
 count(*) filter (where ts_event < prev_ts) as backward_steps,
 case when count(*) >= 2 then count(*) filter (where bid_px is null or ask_px is null) else 0 end as null_bid_ask
 from q group by symbol
""")
def q_quote_window(t):
    """Window checks in arrival (event id) order.  The chunk width is
    small here so the cross-chunk stitching is exercised."""
    return checks.quote_window_checks(t["fx_quote_raw"], chunk_width=512)


@query("check_quote_window_rows", ops="V11", oracle="""
with q as (select symbol, event_id, ts_event, bid_px_00 as bid_px, ask_px_00 as ask_px,
   lag(ts_event) over (partition by symbol order by event_id) as prev_ts from fx_quote_raw where regexp_matches(symbol, '\\s[CP]\\d+$')),
 per as (select symbol, count(*) filter (where ts_event < prev_ts) as back, count(*) filter (where bid_px is null or ask_px is null) as empty, count(*) as n from q group by symbol),
 f as (select count(*) as n, date_diff('second', min(ts_event), max(ts_event)) as s,
   count(distinct cast(timezone('America/Chicago', timezone('UTC', ts_event)) as date)) as d from q),
 c(check_id, name, v) as (
  select 'quotes.window.empty', 'Quote window: rows left after filtering', (select case when n = 0 then 1 else 0 end from f) union all
  select 'quotes.window.span', 'Quote window: at most 10 minutes', (select case when s > 600 then 1 else 0 end from f) union all
  select 'quotes.window.dates', 'Quote window: one Chicago date', (select greatest(d - 1, 0) from f) union all
  select 'quotes.window.order', 'Quote window: time never steps back in a symbol', (select count(*) from per where back > 0) union all
  select 'quotes.window.prices', 'Quote window: bid and ask present', (select count(*) from per where empty > 0 and n >= 2))
select check_id, name, case when v = 0 then 'PASS' else 'FAIL' end as status, 'HARD' as severity, v as violations,
 case when v = 0 then 'ok' else concat(cast(v as varchar), ' violations') end as message from c
""")
def q_quote_window_rows(t):
    """V11 as check rows over the option quotes."""
    return checks.quote_window_report(t["fx_quote_raw"], chunk_width=512, options_only=True)


@query("check_report", ops="V12 Z5", oracle=f"""
with c as (
{_chk_sql("quotes.negative_spread", "Negative spreads", "HARD", "select count(*) from fx_quotes where ask_px < bid_px")}
union all
{_v3_sql()}
union all
{_v5_sql()})
select count(*) filter (where status in ('FAIL', 'ERROR') and severity = 'HARD') as hard_failures,
 count(*) filter (where status = 'WARN' or (status in ('FAIL', 'ERROR') and severity = 'WARN')) as warnings,
 count(*) filter (where status = 'SKIP') as skipped, count(*) filter (where status = 'PASS') as passed, count(*) as total_checks,
 case when count(*) filter (where status in ('FAIL', 'ERROR') and severity = 'HARD') > 0 then 'FAIL'
      when count(*) filter (where status = 'WARN' or (status in ('FAIL', 'ERROR') and severity = 'WARN')) > 0 then 'WARN' else 'PASS' end as overall_status,
 case when count(*) filter (where status in ('FAIL', 'ERROR') and severity = 'HARD') > 0 then 2 else 0 end as exit_code
 from c
""")
def q_check_report(t):
    """Roll-up of V1, V3 and V5 into the overall status."""
    c = checks.negative_spread(t["fx_quotes"]).unionByName(checks.daily_bar_violations(t["fx_bar_dirty"])) \
        .unionByName(q_dup_keys(t))
    return checks.check_report(c)


@query("critical_checks", ops="V11b V3", oracle=f"""
select * from (
{_v3_sql()}
) c where status <> 'PASS' and not starts_with(message, 'Warning:')
""")
def q_critical_checks(t):
    """Only the failing, non-tolerated checks of the daily-bar validator."""
    return checks.critical_only(checks.daily_bar_violations(t["fx_bar_dirty"]))
