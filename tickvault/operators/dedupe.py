"""Deduplication and keyed merges (D1-D4, W2, W3, W6 as DataFrame plans).

"First/last row per key" is an aggregate, not a window: ``min_by``/``max_by``
of the whole row by an explicit order struct.  The aggregate combines
map-side, so a key repeated a billion times is reduced inside every input
task before the shuffle; a ``row_number`` window would instead sort all of a
hot key's rows in one task.  The order must end in a unique tiebreak.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, order_key


def _pick(df: DataFrame, key: Sequence[str], order: Sequence, last: bool) -> DataFrame:
    others = [c for c in df.columns if c not in key]
    row = F.struct(*[F.col(c) for c in others])
    ok = order_key(order)
    pick = F.max_by(row, ok) if last else F.min_by(row, ok)
    return df.groupBy(*key).agg(pick.alias("_r")).select(*key, *[F.col("_r")[c].alias(c) for c in others]) \
             .select(*df.columns)


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence) -> DataFrame:
    """The first row per key by ``order`` (arrival)."""
    return _pick(df, key, order, last=False)


def keep_last(df: DataFrame, key: Sequence[str], order: Sequence) -> DataFrame:
    """The last row per key by ``order``."""
    return _pick(df, key, order, last=True)


def latest_definition(df: DataFrame, key: str = "instrument_id", ts: str = "ts_event",
                      tiebreak: str = "seq") -> DataFrame:
    """D3: latest ``ts`` per key, nulls last (a null-ts row wins only when the
    key has no dated row); ties go to the highest ``tiebreak``.  Struct
    ordering puts null fields first, so ``max_by`` gives nulls last."""
    return keep_last(df, [key], [ts, tiebreak])


def dedupe_minute(df: DataFrame, symbol: str = "symbol", ts: str = "ts_event",
                  tiebreak: str | None = None) -> DataFrame:
    """One row per (symbol, minute), the earliest."""
    d = df.withColumn("ts_min", F.date_trunc("minute", col(ts)).cast("timestamp_ntz"))
    order = [ts] + ([tiebreak] if tiebreak else [])
    return keep_first(d, [symbol, "ts_min"], order)


def _absent(rows: DataFrame, there: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key is not ``there``; null is a key value like any other, as
    in the group-by of ``_pick``."""
    k = there.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)])
    same = F.lit(True)
    for i, c in enumerate(key):
        same = same & rows[c].eqNullSafe(k[f"_k{i}"])
    return rows.join(k, same, "left_anti")


def upsert_replace(old: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence) -> DataFrame:
    """W2 plan: ``insert or replace`` -- every key of ``new`` replaces the old
    row whole; inside ``new`` the last row by ``order`` wins."""
    latest = keep_last(new, key, order).select(*old.columns)
    return _absent(old, latest, key).unionByName(latest)


def upsert_ignore(old: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence) -> DataFrame:
    """W3 plan: ``insert or ignore`` -- rows whose key exists are dropped;
    inside ``new`` the first row by ``order`` wins.  Returns the rows to append."""
    first = keep_first(new, key, order).select(*old.columns)
    return _absent(first, old, key)


def insert_missing(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Only keys not present in ``old`` (never overwrite)."""
    return _absent(new, old.select(*key).distinct(), key)
