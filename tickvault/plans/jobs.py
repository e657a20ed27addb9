"""Composed jobs (Z1-Z8) over a warehouse root of partitioned Parquet tables.

A product is a plain dict entry (declared loads and, if it has one, a bar build);
there is no dynamic import.  Every step is a Spark job over all the files at
once -- no per-file, per-root or per-month Python loops.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..functions.symbols import series_root
from ..operators import bars as B
from ..operators import checks as V
from ..operators import index_quality as IQ
from ..operators import instruments as I
from ..operators import rolls as L
from ..operators.curves import canonical_bars
from ..session import configure, size_shuffle_partitions
from ..sources import ledger as LG
from ..sources import readers as R
from ..sources import sinks as W


@dataclass(frozen=True)
class Load:
    """One step of a product's load: files, how they are typed, the table they
    go to and the write: ``replace`` (W2), ``ignore`` (W3) or ``append`` (W1).
    ``partition`` is a column and the expression that gives it."""
    glob: str
    schema: str
    typed: Callable[[DataFrame], DataFrame]
    table: str
    write: str
    key: tuple[str, ...] = ()
    partition: tuple[str, Callable[[], Column]] | None = None
    order: tuple[str, ...] = ()
    sort_by: tuple[str, ...] | None = None
    bloom: tuple[str, ...] = ()


@dataclass(frozen=True)
class Bars:
    """How a product's bars are built (Z2) and what its rows link to (Z3)."""
    quotes: str
    trades: str
    table: str
    dimension: str
    key: str
    with_spread: bool = False
    underlying: str | None = None


@dataclass(frozen=True)
class Product:
    loads: tuple[Load, ...]
    bars: Bars | None = None


TRADE_DATE = ("trade_date", lambda: F.to_date("ts_event"))
MONTH = ("month", lambda: F.date_format("trading_date", "yyyy-MM"))


def _ticks(key: str, quotes: str, trades: str, quote_table: str, trade_table: str, continuous: bool = False) -> tuple[Load, Load]:
    """Quotes are inserted unless there; trades have no key and are appended, a
    file once (see ``ingest``).  Files are sorted by (key, time) inside each
    day, so point lookups skip row groups."""
    more = ("underlying_instrument_id",) if continuous else ()
    return (Load(quotes, schemas.F_CONTINUOUS_QUOTE_L1 if continuous else schemas.F_QUOTE_L1, lambda d: R.load_quotes(d, continuous), quote_table,
                 "ignore", ("trade_date", "ts_event", key, *more), TRADE_DATE, ("ts_rcv", "ts_event"), (key, "ts_event")),
            Load(trades, schemas.F_CONTINUOUS_TRADE if continuous else schemas.F_TRADE, lambda d: R.load_trades(d, continuous), trade_table,
                 "append", (), TRADE_DATE, (), (key, "ts_event")))


# --- fixed values (must equal the reference's) -----------------------------
CONTRACTS = Load("continuous_instruments/*.parquet", schemas.DIM_CONTINUOUS_CONTRACT, R.load_continuous_contracts,
                 "dim_continuous_contract", "replace", ("contract_series",), None, ("contract_series",))
PRODUCTS = {
    "ES_OPTIONS_MDP3": Product(
        (Load("instruments/*.parquet", schemas.DIM_INSTRUMENT, R.load_option_instruments, "dim_instrument", "replace",
              ("instrument_id",), None, ("instrument_id",)),
         *_ticks("instrument_id", "quotes_l1/*.parquet", "trades/*.parquet", "f_quote_l1", "f_trade")),
        Bars("f_quote_l1", "f_trade", "g_bar_1m", "dim_instrument", "instrument_id", with_spread=True)),
    "ES_FUTURES_MDP3": Product(
        (Load("fut_instruments/*.parquet", schemas.DIM_FUT_INSTRUMENT, R.load_future_instruments, "dim_fut_instrument", "replace",
              ("instrument_id",), None, ("instrument_id",)),
         *_ticks("instrument_id", "fut_quotes_l1/*.parquet", "fut_trades/*.parquet", "f_fut_quote_l1", "f_fut_trade")),
        Bars("f_fut_quote_l1", "f_fut_trade", "g_fut_bar_1m", "dim_fut_instrument", "instrument_id")),
    "ES_CONTINUOUS_MDP3": Product(
        (CONTRACTS, *_ticks("contract_series", "continuous_quotes_l1/*.parquet", "continuous_trades/*.parquet",
                            "f_continuous_quote_l1", "f_continuous_trade", continuous=True)),
        Bars("f_continuous_quote_l1", "f_continuous_trade", "g_continuous_bar_1m", "dim_continuous_contract", "contract_series",
             underlying="underlying_instrument_id")),
    "ES_CONTINUOUS_DAILY_MDP3": Product(
        (CONTRACTS, Load("continuous_bars_daily/*.parquet", schemas.G_CONTINUOUS_BAR_DAILY, R.load_daily_bars, "g_continuous_bar_daily",
                         "replace", ("month", "trading_date", "contract_series"), MONTH, ("underlying_instrument_id", "volume", "close"),
                         ("trading_date",), ("contract_series",)))),
}
# ---------------------------------------------------------------------------


#: Types of the columns that tables are partitioned by: without them Spark
#: would guess from directory names (a symbol ``001`` would become 1).
PARTITION_TYPES = StructType().add("trade_date", "date").add("bar_date", "date").add("month", "string") \
    .add("symbol", "string").add("series_id", "string")


class Warehouse:
    """Table name -> ``<root>/<name>`` Parquet directory."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        configure(spark)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def table(self, name: str) -> DataFrame | None:
        p = self.path(name)
        return W.read_as(self.spark, p, PARTITION_TYPES).drop(W.BUCKET) if W.exists(self.spark, p) else None

    # Z1 ---------------------------------------------------------------------
    def ingest(self, product: str, source: str, rerun: str = "skip") -> DataFrame:
        """A product's loads, one after the other; a load without files is
        skipped.  Ticks are partitioned by UTC date, daily bars by month.

        Trades have no key: a file that was loaded is left out of a rerun by the
        ledger; ``rerun="again"`` appends it again, as the reference does.

        Returns the product's checks (those of Z3) of the rows that this call
        wrote, counted by the writes without a scan of their own: of ticks the
        rows added, so that counts of calls add up to Z3's while the dimension
        keeps its keys; of daily bars the months touched, whole, whose keys are
        distinct by the write.  Without the dimension the rows say which table
        is missing, as in Z3."""
        s = self.spark
        counts: dict[str, W.Counts | None] = {}
        size_shuffle_partitions(s, source)
        for load in PRODUCTS[product].loads:
            glob, path = f"{source}/{load.glob}", self.path(load.table)
            if not R.list_files(s, glob):
                continue
            counts[load.table] = count = self._counts(product, load)
            if load.write == "append":
                ledger = self.path(f"_ledger/{load.table}")
                if rerun == "again":
                    LG.undo_open(s, ledger, path)
                    self._append(load, R.scan_optional(s, glob, load.schema), count)
                else:
                    LG.load_once(s, glob, ledger, path, lambda files, load=load, count=count: self._append(load, R.scan_paths(s, files, load.schema), count))
                continue
            rows, parts = self._typed(load, R.scan_optional(s, glob, load.schema))
            upsert = W.upsert_ignore if load.write == "ignore" else W.upsert_replace
            upsert(s, rows, path, list(load.key), parts, list(load.order), load.sort_by, count, load.bloom)
        return self._counted(product, counts)

    def _counts(self, product: str, load: Load) -> W.Counts | None:
        """What a load's write counts for the product's checks."""
        p = PRODUCTS[product].bars
        if p is None:
            bars = load.table == "g_continuous_bar_daily"
            return W.Counts({f"m{i}": c for i, c in enumerate(V.daily_bar_conditions(), 1)}) if bars else None
        dim = self.table(p.dimension) if load.table in (p.quotes, p.trades) else None
        if dim is None:
            return None
        spread = {"spread": V.spread_is_negative()} if product == "ES_OPTIONS_MDP3" and load.table == p.quotes else {}
        return W.Counts({"unlinked": F.col("_linked").isNull(), **spread}, (dim, [p.key]))

    def _counted(self, product: str, counts: dict[str, W.Counts | None]) -> DataFrame:
        """The rows of the product's checks from what its writes counted."""
        s, p = self.spark, PRODUCTS[product].bars
        if p is None:
            known = counts.get("g_continuous_bar_daily")
            return V.daily_bar_rows(V.counted(s, {"m0": 0, **{n: known.found.get(n, 0) for n in known.conditions}})) if known else s.createDataFrame([], V.CHECK_SCHEMA)
        facts = {n: counts[t] for n, t in (("quotes", p.quotes), ("trades", p.trades)) if t in counts}
        if not facts or any(c is None for c in facts.values()):
            return V.tables_exist(s, {n: self.path(n) for n in (p.dimension, p.quotes, p.trades)})
        rows = [V.unlinked_row(V.counted(s, {"v": c.found.get("unlinked", 0)}), n) for n, c in facts.items()]
        rows += [V.negative_spread_row(V.counted(s, {"v": c.found.get("spread", 0)})) for c in facts.values() if "spread" in c.conditions]
        out = rows[0]
        for r in rows[1:]:
            out = out.unionByName(r)
        return out

    def _typed(self, load: Load, raw: DataFrame) -> tuple[DataFrame, list[str]]:
        rows = load.typed(raw)
        return (rows.withColumn(load.partition[0], load.partition[1]()), [load.partition[0]]) if load.partition else (rows, [])

    def _append(self, load: Load, raw: DataFrame, counts: W.Counts | None) -> None:
        rows, parts = self._typed(load, raw)
        W.append(rows, self.path(load.table), parts, load.sort_by, counts, load.bloom)

    # Z2 ---------------------------------------------------------------------
    def build(self, product: str, width_seconds: int = 60, volume: str = "once") -> None:
        """Incremental bars (a product of daily bars has none to build).
        The high-water mark (B4) selects the quotes to (re)build; the rebuilt
        days replace their partitions (W7)."""
        p = PRODUCTS[product].bars
        quotes, trades = (self.table(p.quotes), self.table(p.trades)) if p else (None, None)
        if quotes is None:
            return
        existing = self.table(p.table)
        days = [d for d in (f.rsplit("bar_date=", 1)[-1] for f in R.list_files(self.spark, f"{self.path(p.table)}/bar_date=*"))
                if d[:1].isdigit()]
        last = existing.filter(F.col("bar_date") == F.lit(max(days)).cast("date")) if existing is not None and days else existing
        cutoff = B.incremental_cutoff(last)
        q = B.incremental_quotes(quotes, cutoff)
        t = B.incremental_quotes(trades, cutoff) if trades is not None else \
            self.spark.createDataFrame([], schemas.F_TRADE).withColumn(p.key, F.lit(None).cast("bigint"))
        order = ("ts_event", "ts_rcv")
        bars = B.quote_bars(q, t, p.key, width_seconds, p.with_spread, volume, order, p.underlying) \
            .withColumn("bar_date", F.to_date("ts_minute"))
        if existing is not None:
            # keep older bars of the first rebuilt day
            first_day = F.to_date(F.lit(cutoff).cast("timestamp_ntz"))
            keep = existing.filter((F.col("bar_date") == first_day) & (F.col("ts_minute") < F.lit(cutoff).cast("timestamp_ntz")))
            bars = bars.unionByName(keep.select(*bars.columns))
        W.delete_days_and_rebuild(self.spark, bars, self.path(p.table), "bar_date")

    # Z3 ---------------------------------------------------------------------
    def validate(self, product: str) -> DataFrame | None:
        """Z3: the product's check list; an unknown product has none."""
        if product == "ES_CONTINUOUS_DAILY_MDP3":
            bars = self.table("g_continuous_bar_daily")
            return V.daily_bar_violations(bars) if bars is not None else None
        if product not in PRODUCTS:
            return None
        p = PRODUCTS[product].bars
        q, t, d = self.table(p.quotes), self.table(p.trades), self.table(p.dimension)
        facts = {n: x for n, x in (("quotes", q), ("trades", t)) if x is not None}
        if not facts or d is None:               # nothing to link, or nothing to link with: say which table is missing
            return V.tables_exist(self.spark, {n: self.path(n) for n in (p.dimension, p.quotes, p.trades)})
        out = V.unlinked(facts, d, p.key)
        if product == "ES_OPTIONS_MDP3" and q is not None:
            out = V.negative_spread(q).unionByName(out)
        return out

    # Z4 ---------------------------------------------------------------------
    def ingest_daily_universe(self, raw: DataFrame, order: list[str]) -> None:
        """All raw daily rows at once -> month batches (B6) -> months in
        which a (series, date) is still missing -> upsert into the daily bar
        table (W2).  A month that other series have filled is not complete
        for a new one."""
        batch = B.daily_consolidate_month(raw, order)
        loaded = self.table("g_continuous_bar_daily")
        if loaded is not None:
            key = ["contract_series", "trading_date"]
            missing = batch.join(loaded.select(*key).distinct(), key, "left_anti").select("contract_series", "month").distinct()
            batch = batch.join(missing, ["contract_series", "month"], "left_semi")
        W.upsert_replace(self.spark, batch.drop("month").withColumn("month", F.date_format("trading_date", "yyyy-MM")),
                         self.path("g_continuous_bar_daily"), ["month", "trading_date", "contract_series"], ["month"],
                         ["trading_date"])

    # Z5 ---------------------------------------------------------------------
    def diagnostics(self, canonical_config: DataFrame | None = None, window_days: int = 30) -> tuple[DataFrame, DataFrame]:
        """All checks, then the roll-up (exit code 2 on a hard failure):
        tables and the canonical view exist (V10), mapping sync (V8, against
        ``canonical_config``), session (V9), daily bars (V3), canonical
        uniqueness (V6) and presence (V7) in the last ``window_days`` (C27),
        unique keys (V5).  A missing table fails its own check; what needs it
        is skipped."""
        required = ["dim_session", "g_continuous_bar_daily", "dim_canonical_map"]
        bars, sess, mapping = (self.table(n) for n in ("g_continuous_bar_daily", "dim_session", "dim_canonical_map"))
        view = canonical_bars(bars, mapping) if bars is not None and mapping is not None else None
        parts = [V.tables_exist(self.spark, {n: self.path(n) for n in required}),
                 V.view_exists(self.spark, "v_canonical_continuous_bar_daily", view)]
        if canonical_config is not None and mapping is not None:
            parts.append(V.mapping_check(canonical_config, mapping))
        if sess is not None and bars is not None:
            parts.append(V.session_fresh(sess, bars))
        if bars is not None:
            parts.append(V.daily_bar_violations(bars))
        if view is not None:
            parts.append(V.canonical_unique(view))
            parts.append(V.presence_check(view, mapping, window_days))
        facts = {t: self.table(t) for t, _ in V.FACT_KEYS}
        if any(v is not None for v in facts.values()):
            parts.append(V.duplicate_keys(facts))
        checks = parts[0]
        for p in parts[1:]:
            checks = checks.unionByName(p)
        return checks, V.check_report(checks)

    # Z6 ---------------------------------------------------------------------
    def update_index_series(self, candidates: DataFrame, as_of, allow_fatal: bool = False, allow_history_change: bool = False,
                            is_backfill: bool = False, start=None, end=None) -> DataFrame:
        """Per series choose the source (I6), check freshness (I2, with the
        row minimum of a backfill) and quality (I1), compare with stored
        history (I3), merge new-wins (I4), write, and rewrite the manifest
        (W11).  A series with a fatal issue is not written unless
        ``allow_fatal``, nor is one whose stored values the source changed
        unless ``allow_history_change``.  Rows that do not change keep their
        source and last_updated.  Returns the per-series status.

        ``candidates``: series_id, date, value, source, priority."""
        chosen = IQ.source_fallback(candidates)
        status = IQ.index_freshness(chosen, as_of, is_backfill, start, end)
        quality = IQ.index_quality(chosen.withColumn("_arrival", F.struct("date", "value")), "_arrival")
        status = status.join(quality, "series_id", "left")
        stored = self.table("f_index_observations")
        if stored is not None:
            changes = IQ.history_changes(stored.select("date", "series_id", "value"), chosen.select("date", "series_id", "value"))
            status = status.join(changes, "series_id", "left")
        else:
            status = status.withColumn("overlap_dates", F.lit(0).cast("long")).withColumn("changed_dates", F.lit(0).cast("long"))
        changed = F.coalesce("changed_dates", F.lit(0)) > 0
        status = status.withColumn("history_changed", changed) \
            .withColumn("written", (F.lit(allow_fatal) | ~F.col("fatal")) & (F.lit(allow_history_change) | ~changed))
        status, staging = W._staged(status, "status")     # asked after the write as it was before
        new = chosen.join(status.filter("written").select("series_id"), "series_id", "left_semi") \
            .select("date", "series_id", "value", "source", F.lit(as_of).cast("timestamp_ntz").alias("last_updated"))
        if stored is not None:
            old = stored.select("series_id", "date", F.col("value").alias("_v"), F.col("source").alias("_s"), F.col("last_updated").alias("_lu"))
            same = F.col("_v").eqNullSafe(F.col("value")) & F.col("_lu").isNotNull()
            new = new.join(old, ["series_id", "date"], "left").select(
                "date", "series_id", "value", F.when(same, F.col("_s")).otherwise(F.col("source")).alias("source"),
                F.when(same, F.col("_lu")).otherwise(F.col("last_updated")).alias("last_updated"))
        W.upsert_replace(self.spark, new, self.path("f_index_observations"), ["series_id", "date"], ["series_id"], ["date"])
        W.replace_small_table(W.series_manifest(self.table("f_index_observations")), self.path("index_manifest"))
        return status

    # Z7 ---------------------------------------------------------------------
    def sync_volatility(self, source: "Warehouse", tables_and_symbols: dict[str, list[str]]) -> None:
        """Create missing tables like the source (W5), then replace the
        listed symbols' rows from the source (W4) -- partition overwrite by
        symbol; a listed symbol without rows in the source loses its rows."""
        for table, symbols in tables_and_symbols.items():
            src = source.table(table)
            if src is None:
                continue
            W.delete_days_and_rebuild(self.spark, src.filter(F.col("symbol").isin(symbols)), self.path(table), "symbol", symbols)

    # Z8 ---------------------------------------------------------------------
    def refresh_metadata(self, symbol_map: DataFrame, as_of) -> tuple[DataFrame, DataFrame | None]:
        """Active ranges (B12) + parsed metadata (B11) upserted, rolls (L1)
        recomputed from the daily bars and replaced in one commit; returns the
        summary (B16) per root and, with daily bars, per series."""
        bars = self.table("g_continuous_bar_daily")
        md = I.build_metadata(symbol_map, bars, as_of)
        W.upsert_replace(self.spark, md, self.path("dim_instrument_metadata"), ["instrument_id"], [], ["instrument_id"])
        md = self.table("dim_instrument_metadata")
        if bars is None:
            none = self.spark.createDataFrame([], schemas.DIM_ROLL_DATES)
            return I.metadata_summary(md, none, none.withColumn("root", F.lit("")))[0], None
        W.replace_table(L.detect_rolls(bars, md), self.path("dim_roll_dates"))
        contracts = self.table("dim_continuous_contract")
        if contracts is None:
            contracts = bars.select("contract_series", series_root("contract_series").alias("root")).distinct()
        return I.metadata_summary(md, self.table("dim_roll_dates"), contracts)
