"""File readers and writers (R2, R8-R14, W5-W10, W13, V10, V11b, X1b) and
the composed jobs (Z1-Z8) on a temporary warehouse."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tickvault.operators import checks
from tickvault.plans import fixtures
from tickvault.plans.jobs import Warehouse
from tickvault.sources import readers as R
from tickvault.sources import sinks as W

from places import SF_SMALL


def test_option_instrument_defaults(spark):
    raw = spark.createDataFrame([(1, "ES", dt.date(2025, 12, 15), 6000.0, "C", None, None, None, "ESZ5 C6000", None)],
                                "instrument_id long, root string, expiry date, strike double, put_call string, "
                                "exerc_style string, multiplier double, tick_size double, symbol_feed string, symbol_canonical string")
    r = R.load_option_instruments(raw).first()
    assert (r["exerc_style"], r["multiplier"], r["tick_size"], r["symbol_canonical"]) == ("American", 50.0, 0.25, "ESZ5 C6000")


def test_macro_json(spark, tmp_dir):
    p = f"{tmp_dir}/obs.json"
    with open(p, "w") as f:
        json.dump({"observations": [{"date": "2024-01-02", "value": "1.5", "realtime_start": "x"},
                                    {"date": "2024-01-03", "value": "."}]}, f)
    got = {r["date"]: r["value"] for r in R.read_macro_json(spark, p).collect()}
    assert got == {"2024-01-02": "1.5", "2024-01-03": "."}
    p2 = f"{tmp_dir}/noval.json"
    with open(p2, "w") as f:
        json.dump({"observations": [{"date": "2024-01-02"}]}, f)
    assert R.read_macro_json(spark, p2).first()["value"] is None


def test_price_csv(spark, tmp_dir):
    p = f"{tmp_dir}/px.csv"
    with open(p, "w") as f:
        f.write("Date,Open,CLOSE\n2024-01-03,1,10\n2024-01-02,1,9\nbad,1,8\n2024-01-04,1,x\n2024-01-03,1,11\n")
    got = [(r["date"], r["value"]) for r in R.read_price_csv(spark, p).orderBy("date").collect()]
    assert got == [(dt.date(2024, 1, 2), 9.0), (dt.date(2024, 1, 3), 11.0)]    # last row per date wins


def test_vendor_csv(spark, tmp_dir):
    p = f"{tmp_dir}/mw.csv"
    with open(p, "w") as f:
        f.write('Date,Close\n01/05/2024,"$4,700.50"\n01/04/2024,N/A\n01/03/2024, 4690 \n01/05/2024,4701\n,5\n')
    with open(f"{tmp_dir}/iso.csv", "w") as f:
        f.write("Date,Close\n2024-02-01,1\n2024-02-02,-\n")
    for name, line in (("torn", "not a date,7"), ("mixed", "2024-03-02,7")):      # one format for a file
        with open(f"{tmp_dir}/{name}.csv", "w") as f:
            f.write(f"Date,Close\n03/01/2024,6\n{line}\n")
    rows, files = R.read_vendor_csv(spark, f"{tmp_dir}/*.csv")
    got = sorted((r["date"], r["value"]) for r in rows.collect())
    assert got == [(dt.date(2024, 1, 3), 4690.0), (dt.date(2024, 1, 5), 4701.0), (dt.date(2024, 2, 1), 1.0)]
    status = {r["file"].rsplit("/", 1)[-1]: (r["date_format"], r["error"]) for r in files.collect()}
    bad = (None, "Failed to parse dates")
    assert status == {"mw.csv": ("vendor", None), "iso.csv": ("general", None), "torn.csv": bad, "mixed.csv": bad}


def test_price_csv_of_several_splits(spark, tmp_dir):
    """The last row of a date in file order, also when blocks are read apart."""
    n = 4000
    with open(f"{tmp_dir}/long.csv", "w") as f:
        f.write("date,close\n" + "".join(f"2024-01-{i % 28 + 1:02d},{i}\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        raw = spark.read.option("header", "true").csv(f"{tmp_dir}/long.csv")
        assert raw.rdd.getNumPartitions() > 5
        got = {r["date"].day: r["value"] for r in R.read_price_csv(spark, f"{tmp_dir}/long.csv").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {i % 28 + 1: float(i) for i in range(n - 28, n)}


def test_scan_tolerant_and_schema_checks(spark, tmp_dir):
    good = f"{tmp_dir}/in/2024-01-02.parquet"
    spark.range(5).withColumn("v", F.col("id") * 1.5).write.parquet(good)
    with open(f"{tmp_dir}/in/2024-01-03.parquet", "w") as f:
        f.write("not parquet")
    import pyarrow as pa
    import pyarrow.parquet as pq
    torn = f"{tmp_dir}/in/2024-01-04 a+b.parquet"             # breaks after its first row group
    pq.write_table(pa.table({"id": range(100, 4100), "v": [float(x) for x in range(4000)]}), torn, row_group_size=1000, compression="none", use_dictionary=False)
    at = pq.ParquetFile(torn).metadata.row_group(2).column(0).data_page_offset
    with open(torn, "r+b") as f:
        f.seek(at)
        f.write(b"\xff" * 64)
    df, skipped = R.scan_tolerant(spark, f"{tmp_dir}/in/*", "id bigint, v double")
    bad = {r["path"].rsplit("/", 1)[-1]: r["error"] for r in skipped.collect()}
    assert df.count() == 5 and set(bad) == {"2024-01-03.parquet", "2024-01-04 a+b.parquet"} and all(bad.values())
    assert R.require_columns(df, ["id", "v", "w"]) == ["w"]
    assert R.require_types(df, {"id": "bigint", "v": "string", "zz": "int"}) == ["v: expected string, got double"]
    d = df.select(R.date_from_filename().alias("d")).distinct().collect()
    assert d[0]["d"] == dt.date(2024, 1, 2)
    assert R.scan_optional(spark, f"{tmp_dir}/nothing/*.parquet", "id bigint").count() == 0


def test_partitioned_writers(spark, tmp_dir):
    t = fixtures.load(spark, SF_SMALL)
    b = t["fx_bar_daily"]
    W.write_by_trading_date(b, f"{tmp_dir}/by_date")
    assert spark.read.parquet(f"{tmp_dir}/by_date").count() == b.count()
    raw = t["fx_ohlcv_raw"].withColumn("arrival", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    from tickvault.operators.bars import daily_consolidate_month
    W.compact_month(daily_consolidate_month(raw, ["arrival"]), f"{tmp_dir}/months")
    assert spark.read.parquet(f"{tmp_dir}/months").count() == b.count()
    one_year = t["fx_ohlcv_raw"].filter(F.year("trading_date") == 1996)     # fewer tiny directories
    W.write_by_rank_date(one_year.select("root", "contract_rank", "trading_date", "open"), f"{tmp_dir}/rank")
    assert "root=ES" in os.listdir(f"{tmp_dir}/rank")
    # Rebuilding one day replaces only that partition
    day = b.agg(F.max("trading_date")).first()[0]
    one = b.filter(F.col("trading_date") == day).limit(1)
    W.delete_days_and_rebuild(spark, one, f"{tmp_dir}/by_date")
    back = spark.read.parquet(f"{tmp_dir}/by_date")
    assert back.filter(F.col("trading_date") == day).count() == 1
    assert back.count() == b.filter(F.col("trading_date") != day).count() + 1
    # Full replace of the canonical map
    W.replace_small_table(t["fx_canonical"], f"{tmp_dir}/canon")
    W.replace_small_table(t["fx_canonical"].filter("not optional"), f"{tmp_dir}/canon")
    assert W.read_table(spark, f"{tmp_dir}/canon").count() == 5
    # W5 / W6
    assert W.create_like(b).count() == 0 and W.create_like(b).schema == b.schema
    W.insert_missing_dates(spark, t["fx_index_old"], f"{tmp_dir}/idx", ["series_id", "date"])
    W.insert_missing_dates(spark, t["fx_index_new"], f"{tmp_dir}/idx", ["series_id", "date"])
    W.insert_missing_dates(spark, t["fx_index_new"], f"{tmp_dir}/idx", ["series_id", "date"])
    idx = spark.read.parquet(f"{tmp_dir}/idx")
    assert idx.count() == idx.select("series_id", "date").distinct().count()


def test_check_report_files_and_tables_exist(spark, tmp_dir):
    t = fixtures.load(spark, SF_SMALL)
    c = checks.daily_bar_violations(t["fx_bar_dirty"])
    W.write_check_report(c, checks.check_report(c), f"{tmp_dir}/report")
    assert spark.read.json(f"{tmp_dir}/report/summary").first()["overall_status"] == "FAIL"
    ex = {r["check_id"]: r["status"] for r in checks.tables_exist(
        spark, {"report": f"{tmp_dir}/report", "absent": f"{tmp_dir}/absent"}).collect()}
    assert ex == {"schema.table.report": "PASS", "schema.table.absent": "FAIL"}
    crit = checks.critical_only(spark.createDataFrame(
        [("a", "n", "FAIL", "HARD", 1, "Warning: no bid/ask"), ("b", "n", "FAIL", "HARD", 1, "3 violations"),
         ("c", "n", "PASS", "HARD", 0, "ok")], checks.CHECK_SCHEMA))
    assert [r["check_id"] for r in crit.collect()] == ["b"]


def _write_product_source(spark, t, root):
    q = t["fx_quotes"].select("ts_event", "ts_rcv", "instrument_id", "bid_px", "bid_sz", "ask_px", "ask_sz")
    tr = t["fx_trades"].select("ts_event", "ts_rcv", "instrument_id", "last_px", "last_sz", "aggressor")
    inst = t["fx_fut_instrument"].select("instrument_id", "root", "symbol_feed", "tick_size")
    inst.write.parquet(f"{root}/fut_instruments/a.parquet")
    q.write.parquet(f"{root}/fut_quotes_l1/a.parquet")
    tr.write.parquet(f"{root}/fut_trades/a.parquet")
    return q, tr


def test_jobs_end_to_end(spark, tmp_dir):
    t = fixtures.load(spark, SF_SMALL)
    src = f"{tmp_dir}/src"
    q, tr = _write_product_source(spark, t, src)
    wh = Warehouse(spark, f"{tmp_dir}/wh")
    wh.ingest("ES_FUTURES_MDP3", src)
    wh.ingest("ES_FUTURES_MDP3", src)                      # quotes: insert-or-ignore, idempotent
    nq = wh.table("f_fut_quote_l1").count()
    assert nq == q.select("ts_event", "instrument_id").distinct().count()
    assert wh.table("dim_fut_instrument").count() == t["fx_fut_instrument"].count()
    wh.build("ES_FUTURES_MDP3", width_seconds=3600)
    wh.build("ES_FUTURES_MDP3", width_seconds=3600)         # rebuild from the high-water mark
    got = sorted(tuple(r) for r in wh.table("g_fut_bar_1m").drop("bar_date").collect())
    from tickvault.operators.bars import bars_futures
    want = sorted(tuple(r) for r in bars_futures(wh.table("f_fut_quote_l1"), wh.table("f_fut_trade"), 3600, "once",
                                                  ("ts_event", "ts_rcv")).collect())
    assert got == want
    v = {r["check_id"]: r["violations"] for r in wh.validate("ES_FUTURES_MDP3").collect()}
    assert v["quotes.unlinked"] > 0
    assert wh.validate("UNKNOWN") is None
    # Z4 daily universe, twice (complete months are skipped the second time)
    raw = t["fx_ohlcv_raw"].withColumn("arrival", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    wh.ingest_daily_universe(raw, ["arrival"])
    wh.ingest_daily_universe(raw, ["arrival"])
    assert wh.table("g_continuous_bar_daily").count() == t["fx_bar_daily"].count()
    # Z5 diagnostics
    assert wh.validate("ES_OPTIONS_MDP3").filter("status = 'FAIL'").count() == 3
    empty, rep = Warehouse(spark, f"{tmp_dir}/empty").diagnostics()
    assert empty.count() == 4 and rep.first()["exit_code"] == 2
    chk, rep = wh.diagnostics()
    assert rep.first()["total_checks"] == chk.count()
    # Z8 metadata + rolls
    wh.refresh_metadata(t["fx_symbol_map"], "2026-01-01 00:00:00")
    assert wh.table("dim_roll_dates").count() > 0
    # Z6 index update with a fallback source
    cand = t["fx_index_new"].withColumn("priority", F.lit(1)).withColumn("source", F.lit("a"))
    status = wh.update_index_series(cand, "2001-12-01", allow_fatal=True)
    assert status.count() == cand.select("series_id").distinct().count()
    # Z7 sync two symbols from another warehouse
    other = Warehouse(spark, f"{tmp_dir}/other")
    t["fx_market_data"].write.parquet(other.path("market_data"))
    wh.sync_volatility(other, {"market_data": ["@VX=101XN"]})
    assert wh.table("market_data").select("symbol").distinct().count() == 1


def test_rerun_after_a_crash_loads_each_file_once(spark, tmp_dir, monkeypatch):
    """Stopped before, within and after the append: the next run ends with one
    set of trades, and a file that grew is loaded as a new one."""
    import pytest
    src, wh = f"{tmp_dir}/src", Warehouse(spark, f"{tmp_dir}/wh")
    day = lambda d, n: spark.range(n).select(F.lit(dt.datetime(2025, 1, d)).cast("timestamp_ntz").alias("ts_event"), F.lit(None).cast("timestamp_ntz").alias("ts_rcv"),
                                             F.col("id").alias("instrument_id"), F.lit(1.0).alias("last_px"), F.lit(1.0).alias("last_sz"), F.lit("B").alias("aggressor"))
    run = lambda **k: wh.ingest("ES_FUTURES_MDP3", src, **k)
    rows = lambda: wh.table("f_fut_trade").count()
    day(1, 10).coalesce(1).write.parquet(f"{src}/fut_trades/a [1].parquet")
    real = W.append

    def none(*a):
        raise RuntimeError("stopped")

    def half(df, *a):
        real(df.limit(3), *a)
        raise RuntimeError("stopped")

    def whole(df, *a):
        real(df, *a)
        raise RuntimeError("stopped")

    for crash in (none, half, whole):
        monkeypatch.setattr(W, "append", crash)
        with pytest.raises(RuntimeError):
            run()
    monkeypatch.setattr(W, "append", real)
    run()
    assert rows() == 10
    run()
    day(2, 5).coalesce(1).write.parquet(f"{src}/fut_trades/b.parquet")
    monkeypatch.setattr(W, "append", half)
    with pytest.raises(RuntimeError):
        run()
    monkeypatch.setattr(W, "append", real)
    run()
    run()
    assert rows() == 15
    run(rerun="again")
    assert rows() == 30
    run()
    assert rows() == 30
