"""Streaming semantics beyond the catalogue's stream = batch checks:
late quotes within the watermark revise their bar; later than the watermark
they are dropped; a replayed micro-batch does not change the upserted table;
results of two checkpoints do not overwrite each other."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tickvault.streaming import streams as ST

EV = ("kind string, event_id bigint, ts_event timestamp_ntz, instrument_id bigint, bid_px double, ask_px double, "
      "last_px double, last_sz double")


def ts(s):
    return dt.datetime.fromisoformat(s)


def q(i, t, bid, ask):
    return ("Q", i, ts(t), 1, bid, ask, None, None)


def test_late_quote_within_watermark_updates_bar(spark, tmp_dir):
    src, table, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/bars", f"{tmp_dir}/ckpt"
    run = lambda: ST.run_bars_stream(spark, src, table, ckpt, width="1 hour", watermark="2 hours")
    spark.createDataFrame([q(1, "2025-01-02 10:05:00", 100.0, 101.0), q(2, "2025-01-02 10:50:00", 102.0, 103.0)], EV) \
        .write.mode("append").parquet(src)
    run()
    bar = lambda: {r["ts_minute"]: r for r in spark.read.parquet(table).collect()}
    assert bar()[ts("2025-01-02 10:00:00")]["h_mid"] == 102.5
    # the next hour arrives with a late 10:59 quote (within the 2-hour watermark)
    spark.createDataFrame([q(3, "2025-01-02 11:10:00", 90.0, 91.0), q(4, "2025-01-02 10:59:00", 110.0, 111.0)], EV) \
        .write.mode("append").parquet(src)
    run()
    b = bar()
    assert b[ts("2025-01-02 10:00:00")]["h_mid"] == 110.5 and b[ts("2025-01-02 10:00:00")]["c_mid"] == 110.5
    assert b[ts("2025-01-02 11:00:00")]["o_mid"] == 90.5
    # much later data moves the watermark past 10:00; a 10:30 quote is then dropped
    spark.createDataFrame([q(5, "2025-01-02 16:00:00", 95.0, 96.0)], EV).write.mode("append").parquet(src)
    run()
    spark.createDataFrame([q(6, "2025-01-02 10:30:00", 500.0, 501.0)], EV).write.mode("append").parquet(src)
    run()
    assert bar()[ts("2025-01-02 10:00:00")]["h_mid"] == 110.5
    assert len(spark.read.parquet(table).collect()) == 3


def test_replay_after_a_lost_commit(spark, tmp_dir):
    """A micro-batch whose commit is missing from the checkpoint is run again:
    the stream goes on and the table is as if it had run once."""
    src, table, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/bars", f"{tmp_dir}/ckpt"
    run = lambda: ST.run_bars_stream(spark, src, table, ckpt, width="1 hour", watermark="2 hours")
    rows = lambda: sorted(tuple(r) for r in spark.read.parquet(table).collect())
    for i, t in enumerate(("2025-01-02 10:05:00", "2025-01-02 11:10:00")):
        spark.createDataFrame([q(i, t, 100.0 + i, 101.0 + i)], EV).write.mode("append").parquet(src)
        run()
    before = rows()
    last = max((n for n in os.listdir(f"{ckpt}/commits") if n.isdigit()), key=int)
    for n in (last, f".{last}.crc"):
        if os.path.exists(f"{ckpt}/commits/{n}"):
            os.remove(f"{ckpt}/commits/{n}")
    run()
    assert rows() == before
    spark.createDataFrame([q(9, "2025-01-02 11:20:00", 300.0, 301.0)], EV).write.mode("append").parquet(src)
    run()
    assert max(r["h_mid"] for r in spark.read.parquet(table).collect()) == 300.5


def test_upsert_sink_is_idempotent(spark, tmp_dir):
    table = f"{tmp_dir}/t"
    sink = ST.upsert_sink(spark, table, ["bar_date", "ts_minute", "instrument_id"], ["bar_date"], ["ts_minute"])
    df = spark.createDataFrame([(ts("2025-01-02 10:00:00"), 1, 1.0)], "ts_minute timestamp_ntz, instrument_id bigint, v double") \
        .withColumn("bar_date", F.to_date("ts_minute"))
    sink(df, 0)
    sink(df, 0)
    assert [r["v"] for r in spark.read.parquet(table).collect()] == [1.0]
    sink(df.withColumn("v", F.lit(3.0)), 0)          # another stream's batch of the same number counts too
    assert [r["v"] for r in spark.read.parquet(table).collect()] == [3.0]


def test_check_results_of_two_runs_stay(spark, tmp_dir):
    src, table = f"{tmp_dir}/src", f"{tmp_dir}/checks"
    spark.createDataFrame([(1, 5.0, 4.0)], "instrument_id bigint, bid_px double, ask_px double").write.parquet(src)
    dim = spark.createDataFrame([(1,)], "instrument_id bigint")
    for n in (1, 2):
        ST.run_checks_stream(spark, src, "instrument_id bigint, bid_px double, ask_px double", dim, table, f"{tmp_dir}/ckpt{n}")
    assert spark.read.parquet(table).filter("check_id = 'quotes.negative_spread'").agg(F.sum("violations")).first()[0] == 2


BARS = "trading_date date, contract_series string, underlying_instrument_id bigint"


def bar(d, i, series="ES_FRONT_CALENDAR"):
    return (dt.date(2025, 1, 1) + dt.timedelta(d - 1), series, i)


def roll_run(spark, tmp_dir, chunks, delay):
    src, table, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/rolls", f"{tmp_dir}/ckpt"
    for rows in chunks:                                       # every run starts again from the checkpoint
        spark.createDataFrame(rows, BARS).write.mode("append").parquet(src)
        ST.run_roll_stream(spark, src, table, ckpt, delay=delay)
    cols = ("contract_series", "roll_date", "old_instrument_id", "new_instrument_id")
    return [sorted(tuple(r[c] for c in cols) for r in ST.read_rolls(spark, table, late).collect()) for late in (False, True)]


def test_shuffled_bars_give_the_rolls_of_the_batch(spark, tmp_dir):
    """Bars up to six days late, two series, one with a null id; the state
    outlives the runs."""
    import random
    from tickvault.operators.rolls import detect_rolls
    rng = random.Random(4)
    bars = [bar(d, rng.choice([1, 1, 1, 2, None]), s) for d in range(1, 41) for s in ("ES_FRONT_CALENDAR", "CL_RANK_1_VOLUME")]
    late = sorted(bars, key=lambda b: (b[0] - dt.date(2025, 1, 1)).days + rng.randint(0, 6))
    chunks = [late[i:i + 27] for i in range(0, len(late), 27)] + [[bar(99, None, "")]]
    rolls, side = roll_run(spark, tmp_dir, chunks, "7 days")
    want = detect_rolls(spark.createDataFrame(bars, BARS)).drop("rank").collect()
    assert rolls == sorted(map(tuple, want)) and rolls and side == []


def test_late_daily_bar_is_kept_aside(spark, tmp_dir):
    chunks = [[bar(2, 1), bar(3, 1)], [bar(6, 2)], [bar(5, 7)], [bar(9, 2)], [bar(2, 8)], [bar(20, None, "")]]
    rolls, side = roll_run(spark, tmp_dir, chunks, "2 days")
    s = "ES_FRONT_CALENDAR"
    assert rolls == [(s, dt.date(2025, 1, 5), 1, 7), (s, dt.date(2025, 1, 6), 7, 2)]     # 5 January came late, but in time
    assert side == [(s, dt.date(2025, 1, 2), None, 8)]


def test_first_arrival_inside_and_over_batches(spark, tmp_dir):
    from tickvault.operators.dedupe import keep_first
    schema = "ts_event timestamp_ntz, instrument_id bigint, seq int, v double"
    t = lambda m: ts(f"2025-01-02 10:{m:02d}:00")
    chunks = [[(t(1), 1, 5, 0.5), (t(1), 1, 4, 0.4), (t(2), None, 9, 0.9)], [(t(1), 1, 3, 0.3), (t(1), 2, 8, 0.8), (t(2), None, 7, None)], [(t(59), 9, 0, 0.0)]]
    for rows in chunks:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{tmp_dir}/src")
        ST.run_dedupe_stream(spark, f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", schema, ["ts_event", "instrument_id"], "30 minutes", order=["seq"])
    want = keep_first(spark.createDataFrame(chunks[0] + chunks[1], schema), ["ts_event", "instrument_id"], ["seq"])
    assert sorted(map(str, spark.read.parquet(f"{tmp_dir}/out").collect())) == sorted(map(str, want.collect()))
