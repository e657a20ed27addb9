"""Exchange-time expressions.

Session membership is computed per row by moving the UTC timestamp to
exchange-local time.  Because the sessions of consecutive days never overlap,
this equals an interval join against a day grid, without any join.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import col

# --- fixed values (must equal the reference's) -----------------------------
EXCHANGE_TZ = "America/Chicago"
RTH_START = (8, 30)        # regular trading hours, Chicago
RTH_END = (15, 0)
GLOBEX_START = (17, 0)     # previous calendar day, Chicago
GLOBEX_END = (16, 0)
# ---------------------------------------------------------------------------


def local_ts(ts, tz: str = EXCHANGE_TZ) -> Column:
    """Zone-less UTC timestamp -> zone-less exchange-local timestamp."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), col(ts).cast("timestamp_ntz"))


def utc_of_local(date_col, hour: int, minute: int, tz: str = EXCHANGE_TZ, day_offset: int = 0) -> Column:
    """UTC instant (zone-less) of local wall clock ``hour:minute`` on
    ``date_col + day_offset`` in ``tz``."""
    d = F.date_add(col(date_col), day_offset) if day_offset else col(date_col)
    local = F.make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d), F.lit(hour), F.lit(minute), F.lit(0))
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), local)


def close_window_bounds(date_col, minutes: int = 5, tz: str = EXCHANGE_TZ):
    """(start_utc, end_utc) of the last ``minutes`` before the 15:00 close."""
    end = utc_of_local(date_col, *RTH_END, tz=tz)
    start = end - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes), F.lit(0))
    return start, end


def close_window_bounds_py(d: _dt.date, minutes: int = 5):
    """Driver-side literal bounds for one day (used as pushed-down filters)."""
    from zoneinfo import ZoneInfo
    chi, utc = ZoneInfo(EXCHANGE_TZ), _dt.timezone.utc
    end = _dt.datetime(d.year, d.month, d.day, *RTH_END, tzinfo=chi)
    start = end - _dt.timedelta(minutes=minutes)
    return start.astimezone(utc).replace(tzinfo=None), end.astimezone(utc).replace(tzinfo=None)


def globex_session_date(ts, tz: str = EXCHANGE_TZ) -> Column:
    """Session date of a UTC timestamp for the 17:00 (d-1) to 16:00 (d)
    Chicago session, null in the 16:00-17:00 maintenance hour.  Bounds are
    closed on both ends, like the reference's mask."""
    lt = local_ts(ts, tz)
    mins = F.hour(lt) * 60 + F.minute(lt)
    secs = mins * 60 + F.second(lt)
    start = GLOBEX_START[0] * 3600 + GLOBEX_START[1] * 60
    end = GLOBEX_END[0] * 3600 + GLOBEX_END[1] * 60
    on_end = (secs == end) & (F.date_trunc("second", lt) == lt)
    return (F.when(secs >= start, F.date_add(F.to_date(lt), 1))
            .when((secs < end) | on_end, F.to_date(lt)))


def rth_session_date(ts, tz: str = EXCHANGE_TZ) -> Column:
    """Local date when the row falls in 08:30-15:00 Chicago (closed), else null."""
    lt = local_ts(ts, tz)
    secs = F.hour(lt) * 3600 + F.minute(lt) * 60 + F.second(lt)
    frac = lt != F.date_trunc("second", lt)
    start = RTH_START[0] * 3600 + RTH_START[1] * 60
    end = RTH_END[0] * 3600 + RTH_END[1] * 60
    return F.when((secs >= start) & ((secs < end) | ((secs == end) & ~frac)), F.to_date(lt))


def trading_date_of(df, fallback: _dt.date | None = None) -> Column:
    """Trading date from the first usable column of the frame's schema:
    ``ts_event`` (UTC date), then ``index``, then ``trading_date``, else the
    fallback literal.  Chosen by schema, once, not per row."""
    for c in ("ts_event", "index", "trading_date"):
        if c in df.columns:
            return F.to_date(F.col(c))
    return F.lit(fallback).cast("date")
