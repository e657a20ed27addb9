"""Catalogue: Structured Streaming jobs (ST1-ST5).

Each query writes its input as Parquet files in arrival chunks under the
shared scratch folder, runs the stream with ``availableNow`` (several
micro-batches), and returns the sink table read back; the oracle is the
batch form of the same operator.
"""

from pyspark.sql import functions as F

from ..streaming import streams as ST
from .q_bars import _Q_AGG, _T_AGG
from .q_rolls import _ROLLS
from .registry import query

_DAY_CHUNKS = [(1, 10), (11, 20), (21, 31)]


def _write_chunks(df, path, chunks, col):
    for lo, hi in chunks:
        df.filter(F.col(col).between(lo, hi)).write.mode("append").parquet(path)


@query("stream_bars", rnd=("o_mid", "h_mid", "l_mid", "c_mid", "v_trades", "v_notional"), ops="ST1 ST3", oracle=f"""
with qa as ({_Q_AGG}), ta as ({_T_AGG})
select qa.ts_minute, qa.instrument_id, o_mid, h_mid, l_mid, c_mid, coalesce(ta.v, 0) as v_trades, coalesce(ta.n, 0) as v_notional
 from qa left join ta on qa.ts_minute = ta.ts_minute and qa.instrument_id = ta.instrument_id
""")
def q_stream_bars(t):
    """ST1 + ST3: hourly bars from a quote/trade event stream arriving in
    three chunks, upserted per micro-batch; equals the batch build."""
    spark = t["fx_quotes"].sparkSession
    p = ST.new_scratch(spark, "stream-bars")
    ev = ST.unify_quotes_trades(t["fx_quotes"], t["fx_trades"]).withColumn("_d", F.dayofmonth("ts_event"))
    _write_chunks(ev.drop("_d").withColumn("_d", F.dayofmonth("ts_event")), p["source"], _DAY_CHUNKS, "_d")
    ST.run_bars_stream(spark, p["source"], p["table"], p["checkpoint"], width="1 hour", watermark="11 days", max_files=4)
    return spark.read.parquet(p["table"]).drop("bar_date")


_LAND = "event_id bigint, ts_event timestamp_ntz, ts_rcv timestamp_ntz, instrument_id bigint, bid_px double, bid_sz double, ask_px double, ask_sz double, batch int"


@query("stream_dedupe", ops="ST2 W3", oracle="""
select * from fx_quote_landing where batch = 1
""")
def q_stream_dedupe(t):
    """ST2: the landing stream (batch 1, then the re-sent batch 2 in a later
    run from the same checkpoint) deduplicated on the event id: first wins."""
    spark, land = t["fx_quote_landing"].sparkSession, t["fx_quote_landing"]
    p = ST.new_scratch(spark, "stream-dedupe")
    b1 = land.filter("batch = 1").withColumn("_d", F.dayofmonth("ts_event"))
    _write_chunks(b1, p["source"], _DAY_CHUNKS, "_d")
    ST.run_dedupe_stream(spark, p["source"], p["table"], p["checkpoint"], _LAND + ", _d int", ["event_id"], "11 days", 4)
    land.filter("batch = 2").withColumn("_d", F.dayofmonth("ts_event")).write.mode("append").parquet(p["source"])
    ST.run_dedupe_stream(spark, p["source"], p["table"], p["checkpoint"], _LAND + ", _d int", ["event_id"], "11 days", 4)
    return spark.read.parquet(p["table"]).drop("_d")


@query("stream_dedupe_first", ops="ST2 D1", oracle="""
select event_id, ts_event, ts_rcv, instrument_id, bid_px, bid_sz, ask_px, ask_sz, batch from
 (select *, row_number() over (partition by ts_event, instrument_id order by batch, event_id) as rn from fx_quote_landing) x where rn = 1
""")
def q_stream_dedupe_first(t):
    """ST2 by arrival: first and re-sent rows mixed inside the micro-batches,
    the re-sent ones in earlier runs too; the least (batch, event id) of every
    key stays, as in D1.  A row far ahead moves the watermark past the last key."""
    spark, land = t["fx_quote_landing"].sparkSession, t["fx_quote_landing"]
    p = ST.new_scratch(spark, "stream-dedupe-first")
    names = [c.split()[0] for c in _LAND.split(", ")]
    last = land.agg((F.max("ts_event") + F.expr("interval 60 days")).alias("ts_event"))
    end = last.select(*[F.col(c) if c == "ts_event" else F.lit(None).cast(land.schema[c].dataType).alias(c) for c in names])
    early = (F.col("batch") == 2) | (F.col("event_id") % 2 == 0)
    for part in (land.filter(early), land.filter(~early), end):
        part.select(*names).write.mode("append").parquet(p["source"])
        ST.run_dedupe_stream(spark, p["source"], p["table"], p["checkpoint"], _LAND, ["ts_event", "instrument_id"], "40 days", order=["batch", "event_id"])
    return spark.read.parquet(p["table"])


@query("stream_checks", ops="ST4 V1 V2", oracle="""
select 'quotes.negative_spread' as check_id, count(*) filter (where ask_px < bid_px) as violations from fx_quotes
union all
select 'quotes.unlinked', count(*) from fx_quotes q where not exists (select 1 from fx_fut_instrument d where d.instrument_id = q.instrument_id)
""")
def q_stream_checks(t):
    """ST4: per-micro-batch V1/V2 against the static instrument dimension;
    summed over batches equals the batch checks."""
    spark = t["fx_quotes"].sparkSession
    p = ST.new_scratch(spark, "stream-checks")
    q = t["fx_quotes"].withColumn("_d", F.dayofmonth("ts_event"))
    _write_chunks(q, p["source"], _DAY_CHUNKS, "_d")
    schema = ("event_id bigint, ts_event timestamp_ntz, ts_rcv timestamp_ntz, instrument_id bigint, bid_px double, "
              "bid_sz double, ask_px double, ask_sz double, _d int")
    ST.run_checks_stream(spark, p["source"], schema, t["fx_fut_instrument"], p["table"], p["checkpoint"], max_files=4)
    return spark.read.parquet(p["table"]).groupBy("check_id").agg(F.sum("violations").alias("violations"))


_YEAR_CHUNKS = [(1990, 1995), (1996, 2100)]


@query("stream_rolls", ops="ST5 L1", oracle=f"select * from {_ROLLS} r")
def q_stream_rolls(t):
    """ST5: rolls detected by a stateful stream over daily bars that arrive 0,
    20 or 40 days after their date (one run per chunk from the same
    checkpoint); a row without an id moves the watermark past the last bar."""
    spark = t["fx_bar_daily"].sparkSession
    p = ST.new_scratch(spark, "stream-rolls")
    bars = t["fx_bar_daily"].select("trading_date", "contract_series", "underlying_instrument_id")
    arrival = F.year(F.date_add("trading_date", (F.crc32(F.concat("contract_series", F.col("trading_date").cast("string"))) % 3 * 20).cast("int")))
    end = bars.agg(F.date_add(F.max("trading_date"), 100).alias("trading_date")) \
        .select("trading_date", F.lit("").alias("contract_series"), F.lit(None).cast("bigint").alias("underlying_instrument_id"))
    for part in [bars.filter(arrival.between(lo, hi)) for lo, hi in _YEAR_CHUNKS] + [end]:
        part.write.mode("append").parquet(p["source"])
        ST.run_roll_stream(spark, p["source"], p["table"], p["checkpoint"], delay="45 days")
    return ST.read_rolls(spark, p["table"])
