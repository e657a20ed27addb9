"""Ledger of loaded files (Z1): an append without a key, run again, loads no
file twice.

A ledger is a small Parquet table: one row per file (path, length, time) and
state of its load.  ``load_once`` lists the files of a glob, leaves out (anti
join) those that a finished load holds, notes ``begun``, appends, and notes
``done``.  A load that stopped in between is undone first by the next one: the
data files of its write are those whose write id (part of every file name that
Spark writes) was not there when it began.  A file whose length or time changed
is a new file.  Loads of one table come one after the other.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import list_files
from .sinks import remove

FILE = "path string, length bigint, modified timestamp"
ENTRY = f"load string, state string, writes array<string>, {FILE}"
WRITE_ID = r"part-\d+-([0-9a-f-]{36})"


def files(spark: SparkSession, glob: str, recursive: bool = False) -> DataFrame:
    """Path, length and time of the files of a glob; none is opened."""
    if not list_files(spark, glob):
        return spark.createDataFrame([], FILE)
    d = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(glob)
    return d.select("path", "length", F.col("modificationTime").alias("modified"))


def _data_files(spark: SparkSession, table: str) -> DataFrame:
    """A table's data files and the id of the write that made each."""
    return files(spark, table, recursive=True).select("path", F.regexp_extract(F.substring_index("path", "/", -1), WRITE_ID, 1).alias("write")).filter("write <> ''")


def entries(spark: SparkSession, ledger: str) -> DataFrame:
    if not list_files(spark, f"{ledger}/[!_.]*"):
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).parquet(ledger)


def _note(spark: SparkSession, ledger: str, load: str, state: str, writes: list[str], rows: list) -> None:
    """One file per note: it appears whole or not at all."""
    spark.createDataFrame([(load, state, writes, *r) for r in rows], ENTRY).coalesce(1).write.mode("append").parquet(ledger)


def undo_open(spark: SparkSession, ledger: str, table: str) -> None:
    """Remove what a load that was begun and not finished has written."""
    e = entries(spark, ledger)
    closed = e.filter("state <> 'begun'").select("load").distinct()
    for load in e.filter("state = 'begun'").join(closed, "load", "left_anti").groupBy("load").agg(F.first("writes").alias("writes")).collect():
        written = _data_files(spark, table).filter(~F.col("write").isin(load["writes"])) if load["writes"] else _data_files(spark, table)
        remove(spark, *(r["path"] for r in written.select("path").collect()))
        _note(spark, ledger, load["load"], "undone", [], [(None, None, None)])


def load_once(spark: SparkSession, glob: str, ledger: str, table: str, append: Callable[[list[str]], None]) -> int:
    """Load the files of ``glob`` that no finished load of this ledger holds,
    by ``append`` of their paths; how many there were.  File names, not rows,
    come to the driver."""
    undo_open(spark, ledger, table)
    loaded = entries(spark, ledger).filter("state = 'done'").select("path", "length", "modified")
    fresh = [tuple(r) for r in files(spark, glob).join(loaded, ["path", "length", "modified"], "left_anti").orderBy("path").collect()]
    if not fresh:
        return 0
    load = uuid.uuid4().hex
    _note(spark, ledger, load, "begun", [r[0] for r in _data_files(spark, table).select("write").distinct().collect()], fresh)
    append([r[0] for r in fresh])
    _note(spark, ledger, load, "done", [], fresh)
    return len(fresh)
