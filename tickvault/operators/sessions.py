"""Exchange-session operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefns import RTH_END, close_window_bounds_py, globex_session_date, rth_session_date, utc_of_local


def close_window_share(quotes: DataFrame, minutes: int = 5, ts: str = "ts_event") -> DataFrame:
    """Per UTC date, rows inside [close - minutes, close] where close is
    15:00 Chicago of that date (converted per row; DST-correct), and their
    share of the day's rows.  A projection plus one aggregate, no join."""
    d = F.to_date(ts)
    end = utc_of_local(d, *RTH_END)
    start = end - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes), F.lit(0))
    inw = F.col(ts).between(start, end)
    return quotes.groupBy(d.alias("date")).agg(F.count_if(inw).alias("rows_in_window"),
                                               F.count(F.lit(1)).alias("rows")) \
                 .withColumn("share_in_window", F.col("rows_in_window") / F.col("rows"))


def close_window_rows(quotes: DataFrame, day, minutes: int = 5, ts: str = "ts_event") -> DataFrame:
    """P17 for one day: keep the rows of the close window.  The bounds are
    literals computed on the driver, so the filter reaches the Parquet scan."""
    s, e = close_window_bounds_py(day, minutes)
    return quotes.filter(F.col(ts).between(F.lit(s).cast("timestamp_ntz"), F.lit(e).cast("timestamp_ntz")))


def tag_sessions(df: DataFrame, ts: str = "ts_event") -> DataFrame:
    """Globex session date and RTH date of every row."""
    return df.withColumn("globex_date", globex_session_date(ts)).withColumn("rth_date", rth_session_date(ts))
