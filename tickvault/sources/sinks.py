"""Sinks (W1-W14): partitioned Parquet writes and keyed upserts.

Plain Parquet has no MERGE, so keyed writes are done partition-wise:

1. stage the batch once under the cluster-shared ``spark.checkpoint.dir`` (a
   micro-batch is not computed again for its partition values),
2. read only the target partitions the staged batch touches (its distinct
   partition values as a literal filter, null included, which prunes
   directories at planning time), with the batch's column types, so that a
   partition value such as ``001`` stays the string it was,
3. merge them with the batch (``dedupe.upsert_replace`` / ``upsert_ignore``),
4. stage the merged partitions, which also cuts the lineage,
5. overwrite exactly those partitions of the target from staging with
   ``partitionOverwriteMode=dynamic``, and remove the staging tables.

A table that an upsert creates with more than PARTITIONS values of its partition
columns (ids, not dates) is partitioned by a hash of them, in BUCKETS
directories of rows sorted by them: a directory and a file for each value would
cost a listing, a task's writer and a move each, whatever they hold.  Later
writes find the layout in the table.

The target is never read and overwritten by the same plan.  An unpartitioned
target has versions: a new one is written beside the old and committed by one
file (``current``).  A rerun with the same batch gives the same table
(idempotent).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegralType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from ..operators import dedupe
from ..session import configure, scratch_path
from .readers import list_files


#: Most partition values, not dates, that an upsert gives a directory each; of more, the directories that a new table is dealt over by their hash.
PARTITIONS, BUCKETS, BUCKET = 1000, 256, "part_bucket"


def _commits(spark: SparkSession, path: str) -> list[str]:
    """Names of a versioned table's commits, the last one at the end."""
    return sorted(f.rsplit("/", 1)[-1] for f in list_files(spark, f"{path.rstrip('/')}/_commits/*-*"))


def current(spark: SparkSession, path: str) -> str:
    """Where a table's files are: for a versioned table, the version that its
    last commit names; for any other, the path itself."""
    commits = _commits(spark, path)
    return f"{path.rstrip('/')}/_versions/{commits[-1].split('-', 1)[1]}" if commits else path


def exists(spark: SparkSession, path: str) -> bool:
    """Does a table have files or partitions, or a committed version?"""
    return bool(_commits(spark, path) or list_files(spark, f"{path.rstrip('/')}/[!_.]*"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table as it was last committed."""
    return spark.read.parquet(current(spark, path)).drop(BUCKET)


def _fs(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        fs, p = _fs(spark, path)
        fs.delete(p, True)


def read_as(spark: SparkSession, path: str, types: StructType) -> DataFrame:
    """A table with the types of the columns of ``types``; partition values
    are read as such, never guessed from directory names."""
    want = {f.name: f.dataType for f in types}
    path = current(spark, path)
    found = spark.read.parquet(path).schema
    return spark.read.schema(StructType([StructField(f.name, want.get(f.name, f.dataType)) for f in found])).parquet(path)


@dataclass
class Counts:
    """Rows of a write that meet each condition, counted by the write itself.

    With ``link`` (a dimension and its key) a row without a dimension row has a
    null ``_linked`` in the conditions; null keys have none.  ``found`` holds the
    counts after the write; a table that was written in two writes has their
    sums.  The metrics are collected in the last stage, where Spark counts a
    task that ran twice once."""
    conditions: dict[str, Column]
    link: tuple[DataFrame, Sequence[str]] | None = None
    found: dict[str, int] = field(default_factory=dict)

    def linked(self, df: DataFrame) -> DataFrame:
        if not self.link:
            return df
        dim, key = self.link
        return df.join(dim.select(*key).distinct().withColumn("_linked", F.lit(True)), list(key), "left")

    def add(self, seen: dict) -> None:
        for name in self.conditions:
            self.found[name] = self.found.get(name, 0) + (seen.get(name) or 0)


def _write(df: DataFrame, path: str, mode: str, partition_by: Sequence[str], sort_by: Sequence[str] | None,
           counts: Counts | None = None, bloom: Sequence[str] = ()) -> None:
    """Rows are clustered by partition (a large one is split over several
    tasks), and sorted by partition, then ``sort_by``: Spark keeps that order
    when it writes partitions, so every file and row group covers a narrow
    range of ``sort_by`` and later scans skip row groups by their statistics,
    which replaces the reference's indexes.  Row groups get a Parquet bloom
    filter (sized by their own distinct values) of each column of ``bloom``:
    lookups by a column that the files are not sorted by skip row groups too."""
    columns, seen = df.columns, Observation()
    if counts:
        df = counts.linked(df)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if counts:
        df = df.observe(seen, *(F.count_if(c).alias(n) for n, c in counts.conditions.items())).select(*columns)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    w = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    for c in bloom:
        w = w.option("parquet.bloom.filter.adaptive.enabled", "true").option(f"parquet.bloom.filter.enabled#{c}", "true")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    if counts:
        counts.add(seen.get)


def _layout(df: DataFrame, path: str, partition_by: Sequence[str], create: bool) -> list[str]:
    """The columns of a table's directories: partition_by, or BUCKET where the
    table has it or is to be created (``create``) for too many values."""
    spark, many = df.sparkSession, False
    if partition_by and exists(spark, path):
        many = bool(list_files(spark, f"{path.rstrip('/')}/{BUCKET}=*"))
    elif create and partition_by and not any(isinstance(f.dataType, DateType) for f in df.select(*partition_by).schema):
        many = df.select(*partition_by).distinct().limit(PARTITIONS + 1).count() > PARTITIONS
    return [BUCKET] if many else list(partition_by)


def _placed(df: DataFrame, dirs: Sequence[str], partition_by: Sequence[str], sort_by: Sequence[str] | None) -> tuple[DataFrame, Sequence[str] | None]:
    """df with the columns of the directories, and what its files are sorted by."""
    if list(dirs) != [BUCKET]:
        return df, sort_by
    bucket = F.pmod(F.xxhash64(*(F.col(c).cast("string") for c in partition_by)), F.lit(BUCKETS)).cast("int")
    return df.withColumn(BUCKET, bucket), [*partition_by, *(c for c in sort_by or () if c not in partition_by)]


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] | None = None,
           counts: Counts | None = None, bloom: Sequence[str] = ()) -> None:
    """Plain insert (into the current version of a versioned table)."""
    dirs = _layout(df, path, partition_by, False)
    df, sort_by = _placed(df, dirs, partition_by, sort_by)
    _write(df, current(df.sparkSession, path), "append", dirs, sort_by, counts, bloom)


def _staged(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, f"staging-{tag}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _touched(existing: DataFrame, batch: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Target rows of the partitions present in the (staged) batch.

    The batch's distinct partition values (one row per touched partition --
    days or symbols, never data rows) become a literal filter, which the
    planner turns into ``PartitionFilters`` so only those directories are
    listed and read.  A semi join against the batch would be simpler, but
    dynamic partition pruning does not fire for it without a selective
    predicate on the batch side (checked), so the whole target would be read.
    """
    if not partition_by:
        return existing
    vals = [tuple(r) for r in batch.select(*partition_by).distinct().collect()]
    cond = F.lit(False)
    if len(partition_by) == 1:
        column, known = F.col(partition_by[0]), [v[0] for v in vals if v[0] is not None]
        cond = column.isin(known) if known else cond
        cond = cond | column.isNull() if len(known) < len(vals) else cond
    else:
        for v in vals:
            one = F.lit(True)
            for k, x in zip(partition_by, v):
                one = one & F.col(k).eqNullSafe(F.lit(x))
            cond = cond | one
    return existing.filter(cond)


def _near(existing: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Target rows whose key columns lie between the least and the greatest
    values of the (staged) batch, the only ones that can hold its keys.  The
    bounds (one row, as text that casts back exactly) become literals, which the
    scan uses to leave out row groups; as subqueries they are not pushed down
    (checked).  A column with nulls in the batch keeps the target's nulls;
    columns of other types (floating point, with NaN) are not bounded."""
    bounded = [f for f in batch.select(*key).schema if isinstance(f.dataType, IntegralType | DecimalType | StringType | DateType | TimestampType | TimestampNTZType)]
    if not bounded:
        return existing
    ends = [(F.min(f.name).cast("string"), F.max(f.name).cast("string"), F.count_if(F.col(f.name).isNull())) for f in bounded]
    row = iter(batch.agg(*(c for end in ends for c in end)).first())
    for f in bounded:
        c, low, high, holes = F.col(f.name), next(row), next(row), next(row)
        inside = c.between(F.lit(low).cast(f.dataType), F.lit(high).cast(f.dataType))
        existing = existing.filter(inside | c.isNull() if holes else inside)
    return existing


def _switch(spark: SparkSession, df: DataFrame, path: str, sort_by: Sequence[str] | None = None,
            counts: Counts | None = None, bloom: Sequence[str] = ()) -> None:
    """Replace an unpartitioned table: a new version is written whole, then
    committed by one empty file whose name holds the next number and the
    version.  That file appears at once or not at all, so a reader, or a writer
    that crashes at any point, sees the old table or the new one.  Writers of
    one table come one after the other."""
    version = uuid.uuid4().hex[:12]
    _write(df, f"{path.rstrip('/')}/_versions/{version}", "error", (), sort_by, counts, bloom)
    _commit(spark, path, version)
    _tidy(spark, path)


def _commit(spark: SparkSession, path: str, version: str) -> None:
    commits = _commits(spark, path)
    number = int(commits[-1].split("-")[0]) + 1 if commits else 1
    fs, file = _fs(spark, f"{path.rstrip('/')}/_commits/{number:012d}-{version}")
    fs.create(file, False).close()


def _tidy(spark: SparkSession, path: str) -> None:
    """Remove what neither the last commit nor the one before it needs (readers
    may still be at that one): files of the time before versions, older
    versions and commits, versions never committed."""
    root, commits = path.rstrip("/"), _commits(spark, path)
    keep = {c.split("-", 1)[1] for c in commits[-2:]}
    old = [f"{root}/_commits/{c}" for c in commits[:-2]]
    old += [v for v in list_files(spark, f"{root}/_versions/*") if v.rsplit("/", 1)[-1] not in keep]
    remove(spark, *old, *(list_files(spark, f"{root}/[!_.]*") if len(commits) > 1 else ()))


def _overwrite_partitions(spark: SparkSession, merged: DataFrame, path: str, partition_by: Sequence[str],
                          tag: str, sort_by: Sequence[str] | None = None, counts: Counts | None = None, bloom: Sequence[str] = ()) -> None:
    staged, staging = _staged(merged, tag)
    if partition_by:
        _write(staged, path, "overwrite", partition_by, sort_by, counts, bloom)
    else:
        _switch(spark, staged, path, sort_by, counts, bloom)
    remove(spark, staging)


def _drop_partitions(spark: SparkSession, path: str, column: str, values: Sequence) -> None:
    """Delete the partitions ``column=value`` of a table."""
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    remove(spark, *(f"{path}/{escape(column, None if v is None else str(v))}" for v in values))


def upsert_replace(spark: SparkSession, batch: DataFrame, path: str, key: Sequence[str],
                   partition_by: Sequence[str], order: Sequence[str], sort_by: Sequence[str] | None = None,
                   counts: Counts | None = None, bloom: Sequence[str] = ()) -> None:
    """``insert or replace`` into a partitioned Parquet table (the new
    row wins whole; inside the batch the last by ``order``).  ``partition_by``
    must be part of ``key`` so a key never moves between partitions.
    ``counts`` are of the touched partitions, whole."""
    configure(spark)
    dirs = _layout(batch, path, partition_by, True)
    if not exists(spark, path):
        first = dedupe.keep_last(batch, key, order)
        if partition_by:
            first, sort_by = _placed(first, dirs, partition_by, sort_by)
            _write(first, path, "overwrite", dirs, sort_by, counts, bloom)
        else:
            _switch(spark, first, path, sort_by, counts, bloom)
        return
    batch, sort_by = _placed(batch, dirs, partition_by, sort_by)
    batch, staging = _staged(batch, "batch")
    existing = read_as(spark, path, batch.schema)
    old = _touched(existing, batch, dirs)
    merged = dedupe.upsert_replace(old, batch.select(*existing.columns), key, order)
    _overwrite_partitions(spark, merged, path, dirs, "upsert", sort_by, counts, bloom)
    remove(spark, staging)


def upsert_ignore(spark: SparkSession, batch: DataFrame, path: str, key: Sequence[str],
                  partition_by: Sequence[str], order: Sequence[str], sort_by: Sequence[str] | None = None,
                  counts: Counts | None = None, bloom: Sequence[str] = ()) -> None:
    """``insert or ignore`` -- append only keys not yet present (the
    existing row wins; inside the batch the first by ``order``).  ``counts``
    are of the appended rows."""
    configure(spark)
    dirs = _layout(batch, path, partition_by, True)
    if not exists(spark, path):
        first, sort_by = _placed(dedupe.keep_first(batch, key, order), dirs, partition_by, sort_by)
        _write(first, path, "overwrite", dirs, sort_by, counts, bloom)
        return
    batch, sort_by = _placed(batch, dirs, partition_by, sort_by)
    batch, staging = _staged(batch, "batch")
    existing = read_as(spark, path, batch.schema)
    old = _near(_touched(existing, batch, dirs), batch, key)
    new_rows, fresh = _staged(dedupe.upsert_ignore(old, batch.select(*existing.columns), key, order), "append")
    _write(new_rows, current(spark, path), "append", dirs, sort_by, counts, bloom)
    remove(spark, staging, fresh)


def replace_by_key_list(old: DataFrame, src: DataFrame, keys: Sequence, col: str = "symbol") -> DataFrame:
    """W4 plan: drop rows whose ``col`` is in ``keys``, insert the source
    rows for those keys (idempotent).  With the table partitioned by ``col``
    this is a partition overwrite of the listed keys only."""
    k = list(keys)
    return old.filter(~F.col(col).isin(k)).unionByName(src.filter(F.col(col).isin(k)).select(*old.columns))


def replace_table(df: DataFrame, path: str, sort_by: Sequence[str] | None = None) -> None:
    """Full replace of an unpartitioned table in one commit; df may read it."""
    _switch(df.sparkSession, df, path, sort_by)


def replace_small_table(df: DataFrame, path: str) -> None:
    """Full replace of a configuration-sized table (the canonical map),
    in one file and one commit."""
    staged, staging = _staged(df, "small-table")
    _switch(df.sparkSession, staged.coalesce(1), path)
    remove(df.sparkSession, staging)


def create_like(df: DataFrame) -> DataFrame:
    """An empty table with the source schema."""
    return df.sparkSession.createDataFrame([], df.schema)


def insert_missing_dates(spark: SparkSession, batch: DataFrame, path: str, key: Sequence[str],
                         partition_by: Sequence[str] = ()) -> None:
    """Append only (series, date) pairs not present; never overwrite."""
    if not exists(spark, path):
        append(batch, path, partition_by)
        return
    dirs = _layout(batch, path, partition_by, False)
    batch, sort_by = _placed(batch, dirs, partition_by, None)
    batch, staging = _staged(batch, "batch")
    existing = read_as(spark, path, batch.schema)
    old = _near(_touched(existing, batch, dirs), batch, key)
    new_rows, fresh = _staged(dedupe.insert_missing(old, batch.select(*existing.columns), key), "missing")
    _write(new_rows, current(spark, path), "append", dirs, sort_by)
    remove(spark, staging, fresh)


def delete_days_and_rebuild(spark: SparkSession, rebuilt: DataFrame, path: str, day_col: str = "trading_date",
                            days: Sequence | None = None) -> None:
    """Replace partitions (days) by their rows in ``rebuilt``; of the
    listed ``days``, those without rows there are deleted.  Other days are
    untouched.  ``rebuilt`` may read the target itself, so it is staged first
    (never read and overwrite one path in a single plan)."""
    configure(spark)
    staged, staging = _staged(rebuilt, "rebuild")
    if days is not None:
        present = {r[0] for r in staged.select(day_col).distinct().collect()}
        _drop_partitions(spark, path, day_col, [d for d in days if d not in present])
    _write(staged, path, "overwrite", [day_col], None)
    remove(spark, staging)


def write_by_trading_date(df: DataFrame, path: str, day_col: str = "trading_date") -> None:
    """One directory per trading date.  The ``rebalance`` hint clusters
    rows by date but lets AQE split a hot date over several tasks/files, so a
    day with a third of all rows is not written by one task."""
    df.hint("rebalance", day_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(day_col).parquet(path)


def compact_month(month_batch: DataFrame, path: str) -> None:
    """A month batch (B6) written as one file set per month."""
    month_batch.hint("rebalance", "month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("month").parquet(path)


def write_by_rank_date(df: DataFrame, path: str) -> None:
    """Layout root / rank / date."""
    df.hint("rebalance", "root", "contract_rank", "trading_date").write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("root", "contract_rank", "trading_date").parquet(path)


def series_manifest(obs: DataFrame, series: str = "series_id") -> DataFrame:
    """Per series rows, first/last date, source, last_updated."""
    return obs.groupBy(series).agg(F.count(F.lit(1)).alias("rows"), F.min("date").alias("first_date"),
                                   F.max("date").alias("last_date"), F.min("source").alias("source"),
                                   F.max("last_updated").alias("last_updated"))


def export_quotes_frame(quotes: DataFrame, instruments: DataFrame) -> DataFrame:
    """W12 plan: quotes with their instrument symbol, spread and mid."""
    j = quotes.join(instruments.select("instrument_id", "root", "symbol_feed"), "instrument_id", "inner")
    return j.select("ts_event", "instrument_id", "root", "symbol_feed", "bid_px", "bid_sz", "ask_px", "ask_sz",
                    (F.col("ask_px") - F.col("bid_px")).alias("spread"),
                    ((F.col("bid_px") + F.col("ask_px")) / 2).alias("mid"))


def export_quotes_csv(quotes: DataFrame, instruments: DataFrame, path: str) -> None:
    """The export written as CSV with a header."""
    export_quotes_frame(quotes, instruments).write.mode("overwrite").option("header", "true").csv(path)


def write_check_report(checks: DataFrame, report: DataFrame, path: str) -> None:
    """Check rows and the roll-up as JSON."""
    checks.write.mode("overwrite").json(f"{path}/checks")
    report.write.mode("overwrite").json(f"{path}/summary")


def stamp_series(df: DataFrame, series_id: str, source: str, as_of, order: Sequence[str]) -> DataFrame:
    """Add series id, source and last_updated, normalise the date, fix
    the column order, one row per date (the last by the columns ``order``,
    such as file and line; Spark keeps no input order of its own)."""
    d = df.withColumn("_i", F.struct(*order)) \
          .withColumn("date", F.to_date(F.col("date"))) \
          .withColumn("series_id", F.lit(series_id)).withColumn("source", F.lit(source)) \
          .withColumn("last_updated", F.lit(as_of).cast("timestamp_ntz"))
    return dedupe.keep_last(d.select("date", "series_id", "value", "source", "last_updated", "_i"), ["date"], ["_i"]) \
        .select("date", "series_id", "value", "source", "last_updated")
