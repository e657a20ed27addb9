"""Helpers shared by the operators: columns, scratch tables, Arrow batches."""

from __future__ import annotations

import ctypes
import sys
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickvault.session import scratch_path
from tickvault.sources.sinks import remove

#: Texts are handed to the vectorised code in runs of whole documents of about this many bytes.
CHUNK_BYTES = 1 << 20
#: Most bytes of an Arrow batch that Spark hands to a Python worker.
BATCH_BYTES = 4 << 20
#: About as many small rows are worked on in one task (by_tasks).
TASK_ROWS = 1 << 17


def by_value() -> None:
    """Send the operators' functions to the executors by value, so that the
    package need not be installed there."""
    for name, module in list(sys.modules.items()):
        if name.startswith("tickvault.llm"):
            cloudpickle.register_pickle_by_value(module)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow over batches of at most BATCH_BYTES or one row, unless the
    session says otherwise: a batch of long texts is held by the JVM, by Arrow
    and, decoded, by Python at the same time."""
    by_value()
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)

    def task(batches):
        try:
            yield from fn(batches)
        finally:
            give_back()

    return df.mapInArrow(task, schema)


def give_back() -> None:
    """Return freed memory of this process to the system: a Python worker stays
    for later tasks, beside those that work, with all that it ever took."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):  # glibc
        libc.malloc_trim(0)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh table under the shared scratch folder and read it back:
    cuts the lineage, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    began = time.monotonic()
    df.write.parquet(path)
    if time.monotonic() - began > 1:  # a large step: let Spark's cleaner drop the shuffle files that made the table
        spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def by_tasks(df: DataFrame, rows: int) -> DataFrame:
    """df, of about so many rows, by as many tasks as they need (one a core at
    least), or by all its partitions if they are fewer: a step of few rows does
    not start a task, and write a file, for every shuffle partition."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)))


def drop(*tables: DataFrame) -> None:
    """Delete tables of written() that nothing reads any more."""
    for t in tables:
        remove(t.sparkSession, t.scratch)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fingerprint(text: Column) -> Column:
    """64 bits of a text; null and the empty text differ."""
    return F.when(text.isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(text))


def words_sql(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as an array (null: none)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[ \\x09-\\x0D]+"), lambda w: w != "")


def text_chunks(batch: pa.RecordBatch, column: str, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts: first row, end row, their bytes, and the offsets of
    each text within these bytes (one more than texts).  Null is empty."""
    col = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary()).fill_null(b"")
    if not len(col):
        return
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, np.int64, len(col) + 1, 8 * col.offset)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(col):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + size, "right")) - 1)
        yield lo, hi, raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def pack_texts(df: DataFrame, column: str) -> DataFrame:
    """df with its text column compressed, as the last column ``packed``: long
    texts are packed before they are shuffled."""
    kept = [c for c in df.columns if c != column]

    def work(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).cast(pa.large_binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([None if t is None else pack.compress(t) for t in texts], pa.binary())], names=[*kept, "packed"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema if f.name != column)
    return map_arrow(df.select(*kept, column), work, schema + "packed binary")


def unpack_texts(df: DataFrame, column: str) -> DataFrame:
    """df with ``packed`` turned back into a text column, the last one."""
    kept = [c for c in df.columns if c != "packed"]

    def work(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            texts = [None if p is None else unpack.decompress(p) for p in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.binary()).cast(pa.string())], names=[*kept, column])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema if f.name != "packed")
    return map_arrow(df.select(*kept, "packed"), work, f"{schema}`{column}` string")
