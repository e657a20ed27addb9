"""Literal edge frames (empty input, null keys, ties, bucket edges, DST,
negative prices, weekends, leading nulls, disjoint sources)."""

import datetime as dt

from pyspark.sql import functions as F

from tickvault.functions import timefns as TF
from tickvault.operators import bars, calendar, checks, dedupe, index_quality
from tickvault.schemas import F_QUOTE_L1, F_TRADE, struct

Q = "event_id bigint, ts_event timestamp_ntz, instrument_id bigint, bid_px double, ask_px double"
T = "event_id bigint, ts_event timestamp_ntz, instrument_id bigint, last_px double, last_sz double"


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_empty_input(spark):
    q = spark.createDataFrame([], Q)
    t = spark.createDataFrame([], T)
    assert bars.bars_futures(q, t).count() == 0
    assert dedupe.keep_first(q, ["instrument_id"], ["ts_event", "event_id"]).count() == 0


def test_ties_bucket_edge_and_trades_without_quotes(spark):
    q = spark.createDataFrame([
        (1, ts("2025-01-02 10:00:00"), 7, 100.0, 101.0),   # exactly on the bucket edge
        (2, ts("2025-01-02 10:00:00"), 7, 102.0, 103.0),   # same ts: event id breaks the tie
        (3, ts("2025-01-02 10:00:59"), 7, None, 105.0),    # null mid is skipped for open/close
        (4, ts("2025-01-02 10:01:00"), 7, 90.0, 91.0),     # next bucket
    ], Q)
    t = spark.createDataFrame([(10, ts("2025-01-02 10:00:30"), 7, 100.0, 2.0),
                               (11, ts("2025-01-02 10:05:00"), 7, 100.0, 5.0)], T)  # no quotes in 10:05
    b = {r["ts_minute"]: r for r in bars.bars_futures(q, t, 60, order=("ts_event", "event_id")).collect()}
    assert set(b) == {ts("2025-01-02 10:00:00"), ts("2025-01-02 10:01:00")}
    r = b[ts("2025-01-02 10:00:00")]
    assert (r["o_mid"], r["c_mid"], r["v_trades"]) == (100.5, 102.5, 2.0)
    ref = {r["ts_minute"]: r for r in bars.bars_futures(q, t, 60, "reference", ("ts_event", "event_id")).collect()}
    assert ref[ts("2025-01-02 10:00:00")]["v_trades"] == 6.0           # 3 quotes x 2


def test_null_keys_dedupe(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), (1, 3, "c")], "k bigint, o bigint, v string")
    got = {(r["k"], r["v"]) for r in dedupe.keep_first(df, ["k"], ["o"]).collect()}
    assert got == {(None, "a"), (1, "c")}
    got = {(r["k"], r["v"]) for r in dedupe.keep_last(df, ["k"], ["o"]).collect()}
    assert got == {(None, "b"), (1, "c")}


def test_dst_session_dates(spark):
    rows = [(ts("2025-03-09 21:59:59"),), (ts("2025-03-09 22:00:00"),), (ts("2025-03-09 20:59:00"),),
            (ts("2025-11-02 22:00:00"),), (ts("2025-11-02 22:30:00"),), (ts("2025-11-02 23:00:00"),),
            (ts("2025-03-10 13:30:00"),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz").select(
        "ts", TF.globex_session_date("ts").alias("g"), TF.rth_session_date("ts").alias("r"))
    got = {r["ts"]: (r["g"], r["r"]) for r in df.collect()}
    # 2025-03-09 is the first CDT day: 16:00 CT = 21:00 UTC, 17:00 CT = 22:00 UTC
    assert got[ts("2025-03-09 21:59:59")][0] is None
    assert got[ts("2025-03-09 22:00:00")][0] == dt.date(2025, 3, 10)
    assert got[ts("2025-03-09 20:59:00")][0] == dt.date(2025, 3, 9)
    # 2025-11-02 is back on CST: 16:00 CT = 22:00 UTC (closed end), 17:00 CT = 23:00 UTC
    assert got[ts("2025-11-02 22:00:00")][0] == dt.date(2025, 11, 2)
    assert got[ts("2025-11-02 22:30:00")][0] is None
    assert got[ts("2025-11-02 23:00:00")][0] == dt.date(2025, 11, 3)
    assert got[ts("2025-03-10 13:30:00")][1] == dt.date(2025, 3, 10)      # 08:30 CDT opening bound


def test_negative_cl_prices_are_allowed(spark):
    df = spark.createDataFrame([(dt.date(2020, 4, 20), "CL_FRONT_VOLUME", -37.6, -10.0, -40.3, -37.6, 10),
                                (dt.date(2020, 4, 20), "ES_FRONT_CALENDAR", -1.0, 2.0, -1.0, 1.0, 10)],
                               "trading_date date, contract_series string, open double, high double, low double, close double, volume bigint")
    v = {r["name"]: r["violations"] for r in checks.daily_bar_violations(df).collect()}
    assert v["Continuous daily: Non-CL: zero or negative OHLC prices"] == 1
    assert v["Continuous daily: CL: NULL in OHLC"] == 0


def test_weekend_and_leading_nulls(spark):
    obs = spark.createDataFrame([("S", dt.date(2024, 1, 3), None), ("S", dt.date(2024, 1, 4), 5.0),
                                 ("S", dt.date(2024, 1, 6), 9.0)],            # Saturday: dropped before the fill
                                "series_id string, date date, value double")
    got = {r["date"]: r["value"] for r in calendar.normalize_business_daily(obs, "2024-01-01", "2024-01-09").collect()}
    assert got[dt.date(2024, 1, 2)] is None and got[dt.date(2024, 1, 3)] is None   # leading nulls stay
    assert got[dt.date(2024, 1, 5)] == 5.0 and got[dt.date(2024, 1, 8)] == 5.0     # Saturday 9.0 not carried
    assert dt.date(2024, 1, 6) not in got


def test_disjoint_sources(spark):
    a = spark.createDataFrame([("S", dt.date(2024, 1, 2), 1.0)], "series_id string, date date, value double")
    b = spark.createDataFrame([("S", dt.date(2024, 2, 2), 1.0)], "series_id string, date date, value double")
    assert index_quality.source_compare(a, b).count() == 0
    assert index_quality.history_changes(a, b).count() == 0


def test_declared_schemas_parse():
    assert struct(F_QUOTE_L1).names[:3] == ["ts_event", "ts_rcv", "instrument_id"]
    assert len(struct(F_TRADE).fields) == 6


def test_quote_close_exact_and_approx(spark):
    rows = [(i, ts("2025-01-02 10:00:00") + dt.timedelta(seconds=i), "ESZ5", 100.0 + (i % 7) * 0.25, 100.5 + (i % 7) * 0.25)
            for i in range(301)]
    q = spark.createDataFrame(rows, "event_id long, ts_event timestamp_ntz, symbol string, bid_px double, ask_px double")
    exact = bars.quote_close(q).first()
    approx = bars.quote_close(q, approx=True).first()
    assert exact["mid_close"] == 101.0 and exact["spread_close"] == 0.5
    assert abs(approx["mid_close"] - exact["mid_close"]) <= 0.25


def test_high_water_mark_modes(spark):
    q = spark.createDataFrame([(1, ts("2025-01-02 10:00:10"), 1, 100.0, 101.0), (2, ts("2025-01-02 10:00:40"), 1, 104.0, 105.0),
                               (3, ts("2025-01-02 10:01:20"), 1, 90.0, 91.0)], Q)
    t = spark.createDataFrame([], T)
    first = bars.bars_futures(q.filter(F.col("event_id") == 1), t, 60)
    cutoff = bars.incremental_cutoff(first)
    assert cutoff == ts("2025-01-02 10:00:00")
    # reference mode (ts_event > cutoff): the last minute is built again from the later quotes and appended -> two bars
    ref = first.unionByName(bars.bars_futures(bars.incremental_quotes(q, cutoff, "reference"), t, 60))
    assert ref.filter(F.col("ts_minute") == cutoff).count() == 2
    # rebuild mode (>= cutoff, replace the bucket): one bar per minute, equal to a full build
    reb = first.filter(F.col("ts_minute") < F.lit(cutoff)).unionByName(
        bars.bars_futures(bars.incremental_quotes(q, cutoff, "rebuild"), t, 60))
    assert sorted(map(tuple, reb.collect())) == sorted(map(tuple, bars.bars_futures(q, t, 60).collect()))


def test_missing_minutes_of_rare_symbols(spark):
    """A symbol with few rows over many days lists every minute between them,
    a null symbol all of its span, and nothing but rows per day is shuffled."""
    from tickvault.operators import calendar as C
    rows = [("a", "2024-01-01 23:58:10"), ("a", "2024-01-02 00:01:30"), ("a", "2024-01-02 00:01:59"), ("a", "2024-01-04 00:00:00"),
            ("b", "2024-01-01 10:00:00"), ("b", "2024-01-01 10:01:00"), ("c", None), (None, "2024-01-01 00:00:00"), (None, "2024-01-01 00:02:00")]
    q = spark.createDataFrame(rows, "symbol string, t string").select("symbol", F.col("t").cast("timestamp_ntz").alias("ts_event"))
    got = sorted((r["symbol"] or "", str(r["minute"])) for r in C.missing_minutes(q).collect())
    a = spark.sql("select explode(sequence(timestamp_ntz'2024-01-01 23:58:00', timestamp_ntz'2024-01-04 00:00:00', interval 1 minute)) m").collect()
    there = {"2024-01-01 23:58:00", "2024-01-02 00:01:00", "2024-01-04 00:00:00"}
    none = [("", f"2024-01-01 00:0{i}:00") for i in range(3)]
    assert got == none + [("a", str(r["m"])) for r in a if str(r["m"]) not in there]
    days = {(r["symbol"], r["day"].day): r["minutes"] for r in C.missing_minutes(q, by_day=True).collect()}
    assert {k: len(v) for k, v in days.items()} == {("a", 1): 1, ("a", 2): 1439, ("a", 3): 1440, (None, 1): 3}
    plan = C.missing_minutes(q)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan  # which would shuffle the grid
