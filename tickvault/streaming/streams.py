"""Structured Streaming forms of the incremental jobs (ST1-ST5).

The reference builds bars incrementally with a hand-kept high-water mark and
deduplicates with a unique index.  Here:

* ST1 ``stream_bars``: quotes and trades arrive as one event stream (a
  ``kind`` column); one windowed aggregation per (bucket, key) computes the
  mid OHLC from quote events and the traded volume from trade events, so no
  stream-stream join is needed.  Late events within the watermark update
  their bar instead of being lost.
* ST2 ``stream_dedupe``: with an arrival ``order``, the least arrival of every
  key (``first_arrivals``), over micro-batches and inside one, as in D1; a key
  is given out when the watermark passes its event time.  Without an order
  ``dropDuplicatesWithinWatermark``: rows go out at once, the first batch wins,
  and which of a key's rows inside one micro-batch stays is open.
* ST3 ``stream_upsert``: ``foreachBatch`` calling the partition upsert (W2),
  which is idempotent, so a replayed batch changes nothing.
* ST4 ``stream_checks``: ``foreachBatch`` computing V1/V2 per micro-batch
  against a static dimension, appended to a check table.
* ST5 ``stream_rolls``: ``transformWithState`` keyed by series.  A list state
  holds the bars that wait, an event-time timer releases them in date order
  once the watermark has passed them, and a value state holds the last bar
  released; a roll is given out where the id changes.  Bars that come after
  their neighbours were compared go to a side table (``late=true``).

Event time must be ``timestamp`` (not ``timestamp_ntz``) for watermarks, so
streams cast ``ts_event`` on input and back on output (session zone UTC).
Checkpoints live under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..functions.columns import first_by, last_by
from ..functions.symbols import series_rank
from ..session import configure, scratch_path, ship_package
from ..sources import sinks

QUOTE, TRADE = "Q", "T"


def event_stream(spark: SparkSession, path: str, schema: str, max_files: int | None = None) -> DataFrame:
    """A Parquet file source with a declared schema."""
    r = spark.readStream.schema(schema).format("parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.load(path)


def bar_aggregate(events: DataFrame, key: str = "instrument_id", width: str = "1 hour",
                  watermark: str = "10 minutes", volume: str = "once",
                  order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """ST1: streaming bars over a unified quote/trade event stream.

    ``events`` has ``kind`` ('Q' or 'T'), ``ts_event`` (timestamp_ntz),
    ``event_id``, ``key``, ``bid_px``, ``ask_px``, ``last_px``, ``last_sz``.
    Buckets without quotes are dropped (as in the batch form)."""
    e = events.withColumn("ts", F.col("ts_event").cast("timestamp")).withWatermark("ts", watermark)
    isq, ist = F.col("kind") == QUOTE, F.col("kind") == TRADE
    m = F.when(isq, (F.col("bid_px") + F.col("ask_px")) / 2)
    sz = F.when(ist, F.col("last_sz"))
    agg = e.groupBy(F.window("ts", width).alias("w"), key).agg(
        first_by(m, order).alias("o_mid"), F.max(m).alias("h_mid"), F.min(m).alias("l_mid"),
        last_by(m, order).alias("c_mid"),
        F.sum(sz).alias("_v"), F.sum(sz * F.col("last_px")).alias("_n"), F.count_if(isq).alias("_nq"))
    mult = F.col("_nq") if volume == "reference" else F.lit(1)
    return agg.filter(F.col("_nq") > 0).select(
        F.col("w.start").cast("timestamp_ntz").alias("ts_minute"), key, "o_mid", "h_mid", "l_mid", "c_mid",
        F.coalesce(F.col("_v") * mult, F.lit(0.0)).alias("v_trades"),
        F.coalesce(F.col("_n") * mult, F.lit(0.0)).alias("v_notional"))


def unify_quotes_trades(quotes: DataFrame, trades: DataFrame, key: str = "instrument_id") -> DataFrame:
    """Quotes and trades as one event frame (the stream's input layout)."""
    q = quotes.select(F.lit(QUOTE).alias("kind"), "event_id", "ts_event", key, "bid_px", "ask_px",
                      F.lit(None).cast("double").alias("last_px"), F.lit(None).cast("double").alias("last_sz"))
    t = trades.select(F.lit(TRADE).alias("kind"), "event_id", "ts_event", key, F.lit(None).cast("double").alias("bid_px"),
                      F.lit(None).cast("double").alias("ask_px"), "last_px", "last_sz")
    return q.unionByName(t)


def upsert_sink(spark: SparkSession, path: str, key: Sequence[str], partition_by: Sequence[str],
                order: Sequence[str]):
    """ST3: a ``foreachBatch`` function upserting each micro-batch into a
    partitioned Parquet table (W2).  The upsert is idempotent, so a replayed
    micro-batch is simply written again: it must be run, since the stream's
    state store expects every partition of the batch to be computed."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        sinks.upsert_replace(spark, batch, path, key, partition_by, order)
    return fn


def run_bars_stream(spark: SparkSession, source: str, table: str, checkpoint: str, key: str = "instrument_id",
                    width: str = "1 hour", watermark: str = "10 minutes", max_files: int | None = None,
                    volume: str = "once") -> None:
    """ST1 + ST3: bars from a file source, upserted per micro-batch (update
    mode, so every window is written, and revised when late data arrive)."""
    configure(spark)
    schema = (f"kind string, event_id bigint, ts_event timestamp_ntz, {key} bigint, bid_px double, ask_px double, "
              "last_px double, last_sz double")
    bars = bar_aggregate(event_stream(spark, source, schema, max_files), key, width, watermark, volume)
    sink = upsert_sink(spark, table, ["bar_date", "ts_minute", key], ["bar_date"], ["ts_minute"])
    q = (bars.withColumn("bar_date", F.to_date("ts_minute")).writeStream.outputMode("update")
         .foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def first_arrivals(rows: DataFrame, key: Sequence[str], order: Sequence[str], ts: str = "ts") -> DataFrame:
    """ST2: the row of least ``order`` per (``ts``, key), the form of D1 for a
    stream with a watermark on ``ts``: partial aggregates, one state row per key
    until the watermark passes ``ts``.  Copies of a key carry the same ``ts``,
    which must not be null."""
    rest = [c for c in rows.columns if c not in (ts, *key)]
    first = rows.groupBy(ts, *key).agg(first_by(F.struct(*rest), order).alias("_r"))
    return first.select(*[F.col(c) if c in (ts, *key) else F.col(f"_r.{c}") for c in rows.columns])


def run_dedupe_stream(spark: SparkSession, source: str, table: str, checkpoint: str, schema: str,
                      key: Sequence[str], watermark: str = "1 day", max_files: int | None = None,
                      order: Sequence[str] | None = None) -> None:
    """ST2: first row per key within the watermark, appended to Parquet; by
    ``order`` if given, else by micro-batch."""
    configure(spark)
    s = event_stream(spark, source, schema, max_files).withColumn("ts", F.col("ts_event").cast("timestamp")) \
        .withWatermark("ts", watermark)
    s = first_arrivals(s, key, order) if order else s.dropDuplicatesWithinWatermark(list(key))
    q = (s.drop("ts").writeStream.outputMode("append").format("parquet").option("path", table)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def checks_sink(spark: SparkSession, dim: DataFrame, table: str, key: str = "instrument_id"):
    """ST4: per micro-batch V1 (negative spread) and V2 (unlinked, a
    stream-static anti join), stored under query and batch id (idempotent)."""
    dim_keys = dim.select(key).distinct()

    def fn(batch: DataFrame, batch_id: int) -> None:
        v1 = batch.agg(F.count_if(F.col("ask_px") < F.col("bid_px")).alias("v")) \
            .select(F.lit("quotes.negative_spread").alias("check_id"), "v")
        v2 = batch.select(key).join(dim_keys, key, "left_anti").agg(F.count(F.lit(1)).alias("v")) \
            .select(F.lit("quotes.unlinked").alias("check_id"), "v")
        # One directory per query (its checkpoint's id) and batch id, overwritten:
        # a replayed batch rewrites its own rows instead of appending them twice,
        # and another query's batch of the same number stays.
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        v1.unionByName(v2).select("check_id", F.col("v").cast("long").alias("violations")) \
            .write.mode("overwrite").parquet(f"{table}/query_id={run}/batch_id={batch_id}")
    return fn


def run_checks_stream(spark: SparkSession, source: str, schema: str, dim: DataFrame, table: str,
                      checkpoint: str, max_files: int | None = None) -> None:
    q = (event_stream(spark, source, schema, max_files).writeStream.foreachBatch(checks_sink(spark, dim, table))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


ROLL_SCHEMA = "contract_series string, roll_date date, old_instrument_id bigint, new_instrument_id bigint, late boolean"
BAR_STATE = "trading_date date, id bigint"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EPOCH, DAY_MS = dt.date(1970, 1, 1), 86_400_000


def _ms(day: dt.date) -> int:
    return (day - EPOCH).days * DAY_MS


class RollProcessor(StatefulProcessor):
    """State of one series: the bars that wait (as many as the watermark's delay
    has days) and the last one released.  Bars of one date are ordered by id."""

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", BAR_STATE)
        self.last = handle.getValueState("last", BAR_STATE)

    def handleInputRows(self, key, rows, timerValues):
        last, late, new = self.last.get(), [], []
        for part in rows:
            part = part[part["underlying_instrument_id"].notna()]
            for day, i in zip(part["trading_date"], part["underlying_instrument_id"].astype("int64")):
                (late if last is not None and day <= last[0] else new).append((day, int(i)))
        if new:
            self.waiting.appendList(new)
            self.handle.registerTimer(_ms(min(new)[0]))
        if late:
            yield self._rows(key, [(day, None, i, True) for day, i in late])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        """Compare every bar the watermark has passed with the one before it;
        the earliest of those that still wait sets the next timer."""
        until = timerValues.getCurrentWatermarkInMs()
        bars = sorted((r[0], int(r[1])) for r in self.waiting.get())
        ready, rest = [b for b in bars if _ms(b[0]) <= until], [b for b in bars if _ms(b[0]) > until]
        if not ready:
            return
        if rest:
            self.waiting.put(rest)
            self.handle.registerTimer(_ms(rest[0][0]))
        else:
            self.waiting.clear()
        last = self.last.get()
        before = [None if last is None else int(last[1])] + [i for _, i in ready[:-1]]
        self.last.update(ready[-1])
        rolls = [(day, old, i, False) for (day, i), old in zip(ready, before) if old is not None and old != i]
        if rolls:
            yield self._rows(key, rolls)

    def _rows(self, key, found) -> pd.DataFrame:
        out = pd.DataFrame(found, columns=["roll_date", "old_instrument_id", "new_instrument_id", "late"])
        out["old_instrument_id"] = out["old_instrument_id"].astype("Int64")
        out.insert(0, "contract_series", key[0])
        return out

    def close(self) -> None:
        pass


def roll_stream(bars: DataFrame, delay: str = "10 days") -> DataFrame:
    """ST5: rolls (L1) from a stream of daily bars that arrive in any order
    within ``delay``, and with ``late`` the bars that arrived after a later one
    of their series was compared (date and id, no old id).  The event time is
    dropped below the state, or Spark would drop late bars unseen."""
    ship_package(__name__)                   # the processor runs in Python workers
    b = bars.withColumn("ts", F.col("trading_date").cast("timestamp")).withWatermark("ts", delay) \
        .select("contract_series", "trading_date", "underlying_instrument_id")
    rolls = b.groupBy("contract_series").transformWithStateInPandas(
        RollProcessor(), outputStructType=ROLL_SCHEMA, outputMode="append", timeMode="eventTime")
    return rolls.select("contract_series", series_rank("contract_series").alias("rank"), "roll_date",
                        "old_instrument_id", "new_instrument_id", "late")


def run_roll_stream(spark: SparkSession, source: str, table: str, checkpoint: str, max_files: int | None = None,
                    delay: str = "10 days") -> None:
    """ST5 from a file source; rolls and late bars are partitions of one table,
    so both are written exactly once.  This kind of state needs RocksDB, which
    is set for this query only."""
    schema = "trading_date date, contract_series string, underlying_instrument_id bigint"
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        q = (roll_stream(event_stream(spark, source, schema, max_files), delay).writeStream.outputMode("append")
             .format("parquet").partitionBy("late").option("path", table).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)
    q.awaitTermination()


def read_rolls(spark: SparkSession, table: str, late: bool = False) -> DataFrame:
    """Rolls written by ``run_roll_stream``, or the bars that came too late."""
    return spark.read.schema(ROLL_SCHEMA.replace("roll_date", "rank int, roll_date")).parquet(table) \
        .filter(F.col("late") == late).drop("late")


def new_scratch(spark: SparkSession, name: str) -> dict[str, str]:
    """Fresh source / table / checkpoint paths under the shared folder."""
    base = scratch_path(spark, name)
    return {"source": f"{base}/source", "table": f"{base}/table", "checkpoint": f"{base}/checkpoint"}
