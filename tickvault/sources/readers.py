"""Readers (R1-R15): Parquet, CSV and JSON inputs with declared schemas.

Every reader returns a lazy DataFrame.  Typed projections (R2-R7) are
``select`` + ``cast``, so on a Parquet source only the projected columns are
read (``ReadSchema``) and filters added later are pushed to the scan.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.columns import col
from ..operators.dedupe import keep_last
from ..session import scratch_path, ship_package

# --- fixed values (must equal the reference's) -----------------------------
OPTION_LOAD_DEFAULTS = {"exerc_style": "American", "multiplier": 50, "tick_size": 0.25}
NA_TOKENS = ["N/A", "n/a", "NA", "null", "NULL", "", "-"]
VENDOR_DATE_FORMAT = "MM/dd/yyyy"
FILE_DATE_RE = r"(\d{4}-\d{2}-\d{2})"
# ---------------------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_files(spark: SparkSession, glob: str) -> list[str]:
    """Paths matching a glob (driver-side listing, no job)."""
    p, fs = _fs(spark, glob)
    st = fs.globStatus(p)
    return [] if st is None else [s.getPath().toString() for s in st]


def scan_optional(spark: SparkSession, glob: str, schema: T.StructType | str, fmt: str = "parquet") -> DataFrame:
    """Read a glob with a declared schema; a glob that matches nothing
    gives an empty DataFrame of that schema instead of an error."""
    st = schemas.struct(schema) if isinstance(schema, str) else schema
    if not list_files(spark, glob):
        return spark.createDataFrame([], st)
    return spark.read.schema(st).format(fmt).load(glob)


def scan_paths(spark: SparkSession, paths: list[str], schema: T.StructType | str, fmt: str = "parquet") -> DataFrame:
    """R1 for listed files: names are taken as they are, not as globs."""
    st = schemas.struct(schema) if isinstance(schema, str) else schema
    return spark.read.schema(st).format(fmt).load([re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths])


def load_option_instruments(raw: DataFrame) -> DataFrame:
    """R2: typed option instrument projection with defaults."""
    d = OPTION_LOAD_DEFAULTS
    return raw.select(
        col("instrument_id").cast("bigint").alias("instrument_id"), col("root").cast("string").alias("root"),
        col("expiry").cast("date").alias("expiry"), col("strike").cast("double").alias("strike"),
        col("put_call").cast("string").alias("put_call"),
        F.coalesce(col("exerc_style").cast("string"), F.lit(d["exerc_style"])).alias("exerc_style"),
        F.coalesce(col("multiplier").cast("double"), F.lit(float(d["multiplier"]))).alias("multiplier"),
        F.coalesce(col("tick_size").cast("double"), F.lit(d["tick_size"])).alias("tick_size"),
        col("symbol_feed").cast("string").alias("symbol_feed"),
        F.coalesce(col("symbol_canonical").cast("string"), col("symbol_feed").cast("string")).alias("symbol_canonical"))


def _opt(raw: DataFrame, name: str, ty: str):
    return F.col(name).cast(ty) if name in raw.columns else F.lit(None).cast(ty)


def load_future_instruments(raw: DataFrame) -> DataFrame:
    """Typed futures instrument projection (no strike / put_call)."""
    d = OPTION_LOAD_DEFAULTS
    return raw.select(
        F.col("instrument_id").cast("bigint").alias("instrument_id"), _opt(raw, "root", "string").alias("root"),
        _opt(raw, "expiry", "date").alias("expiry"), F.col("symbol_feed").cast("string").alias("symbol_feed"),
        F.coalesce(_opt(raw, "symbol_canonical", "string"), F.col("symbol_feed").cast("string")).alias("symbol_canonical"),
        F.coalesce(_opt(raw, "tick_size", "double"), F.lit(d["tick_size"])).alias("tick_size"),
        F.coalesce(_opt(raw, "multiplier", "double"), F.lit(float(d["multiplier"]))).alias("multiplier"))


def _typed(raw: DataFrame, ddl: str) -> DataFrame:
    return raw.select(*[_opt(raw, n, t).alias(n) for n, t in schemas.fields(ddl)])


def load_quotes(raw: DataFrame, continuous: bool = False) -> DataFrame:
    """Typed L1 quote projection (plain or continuous)."""
    return _typed(raw, schemas.F_CONTINUOUS_QUOTE_L1 if continuous else schemas.F_QUOTE_L1)


def load_trades(raw: DataFrame, continuous: bool = False) -> DataFrame:
    """Typed trade projection."""
    return _typed(raw, schemas.F_CONTINUOUS_TRADE if continuous else schemas.F_TRADE)


def load_continuous_contracts(raw: DataFrame) -> DataFrame:
    """The five contract-definition columns."""
    return _typed(raw, schemas.DIM_CONTINUOUS_CONTRACT)


def load_daily_bars(raw: DataFrame) -> DataFrame:
    """Typed daily bar projection."""
    return _typed(raw, schemas.G_CONTINUOUS_BAR_DAILY)


def read_macro_json(spark: SparkSession, path: str) -> DataFrame:
    """API observation payloads (``{"observations": [{date, value, ..}]}``,
    one document per file) to rows; a missing ``date``/``value`` field becomes
    a null column."""
    raw = spark.read.option("multiLine", "true").json(path)
    if "observations" not in raw.columns:
        return spark.createDataFrame([], "date string, value string")
    obs = raw.select(F.explode("observations").alias("o")).select("o.*")
    for c in ("date", "value"):
        if c not in obs.columns:
            obs = obs.withColumn(c, F.lit(None).cast("string"))
    return obs


def _ci(df: DataFrame, name: str) -> str | None:
    return next((c for c in df.columns if c.strip().lower() == name), None)


def read_price_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with case-insensitive ``date``/``close``; bad dates or values
    dropped; the last row per date (file order) kept; (date, value)."""
    raw = spark.read.option("header", "true").csv(path)
    dc, cc = _ci(raw, "date"), _ci(raw, "close")
    if dc is None or cc is None:
        raise ValueError(f"CSV missing required columns date/close; found {raw.columns}")
    d = raw.select(F.to_date(F.col(f"`{dc}`").try_cast("timestamp")).alias("date"),
                   F.col(f"`{cc}`").try_cast("double").alias("value"),
                   *_file_order())
    d = d.filter(F.col("date").isNotNull() & F.col("value").isNotNull())
    return keep_last(d, ["date"], ["_file", "_block", "_row"]).select("date", "value")


def _file_order() -> list[F.Column]:
    """The place of a row of a text file: file, start of the block read, and an
    id that grows inside the block (a block is read by one task)."""
    return [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row")]


def read_vendor_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Like R9, plus ``MM/DD/YYYY`` dates, ``$``/``,`` stripped and N/A
    tokens as null.  The date format is chosen per file: ``MM/DD/YYYY`` if all
    its dates are such, else a general parse if that reads them all; a file with
    a date that neither reads is rejected as a whole.  Rows without a date or
    value are left out; of two rows of a date in a file the last stays.

    Returns the rows (date, value) of accepted files, and (file, date_format,
    error) of all files."""
    raw = spark.read.option("header", "true").csv(path)
    dc, cc = _ci(raw, "date"), _ci(raw, "close")
    if dc is None or cc is None:
        raise ValueError(f"CSV missing required columns date/close; found {raw.columns}")
    txt = F.trim(F.col(f"`{dc}`"))
    txt = F.when(txt != "", txt)
    vendor, general = F.try_to_timestamp(txt, F.lit(VENDOR_DATE_FORMAT)), txt.try_cast("timestamp")
    v = F.regexp_replace(F.trim(F.col(f"`{cc}`").cast("string")), r"[$,]", "")
    v = F.when(v.isin(*NA_TOKENS), F.lit(None)).otherwise(v).try_cast("double")
    rows = raw.select(F.to_date(vendor).alias("_vendor"), F.to_date(general).alias("_general"), txt.alias("_text"), v.alias("value"), *_file_order())
    reads = lambda c: F.every(F.col("_text").isNull() | F.col(c).isNotNull())
    files = rows.groupBy(F.col("_file").alias("file")).agg(F.when(reads("_vendor"), "vendor").when(reads("_general"), "general").alias("date_format"))
    files = files.withColumn("error", F.when(F.col("date_format").isNull(), "Failed to parse dates"))
    good = rows.join(files.where("error is null").select(F.col("file").alias("_file"), "date_format"), "_file")
    good = good.withColumn("date", F.when(F.col("date_format") == "vendor", F.col("_vendor")).otherwise(F.col("_general")))
    good = good.where("date is not null and value is not null").select("date", "value", "_file", "_block", "_row")
    return keep_last(good, ["_file", "date"], ["_block", "_row"]).select("date", "value"), files


def date_from_filename(path_col=None) -> F.Column:
    """``YYYY-MM-DD`` out of the input file path (null when absent);
    the path, not the bare name, so a date-named directory written by Spark
    (``2024-01-02.parquet/part-*.parquet``) also counts."""
    p = path_col if path_col is not None else F.col("_metadata.file_path")
    s = F.regexp_extract(p, FILE_DATE_RE, 1)
    return F.when(s != "", s.try_cast("date"))


def open_files(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """(path, rows, error) of Parquet files, or of the files in folders: each is
    opened whole on an executor, its footer and all its row groups, one file at
    a time.  A file without rows is an error too."""
    def opened(pair):
        import pyarrow as pa
        import pyarrow.parquet as pq
        path, data = pair
        try:
            f = pq.ParquetFile(pa.BufferReader(data))
            rows = sum(f.read_row_group(g).num_rows for g in range(f.num_row_groups))
            return path, rows, None if rows else "no rows"
        except Exception as e:  # whatever is wrong with a file is its report
            return path, None, f"{type(e).__name__}: {e}"[:500]

    ship_package(__name__)
    return spark.createDataFrame(spark.sparkContext.binaryFiles(",".join(files)).map(opened), "path string, rows long, error string")


def scan_tolerant(spark: SparkSession, glob: str, schema=None) -> tuple[DataFrame, DataFrame]:
    """The rows of all readable Parquet files of a glob, and (path, rows,
    error) of those left out.  A file that breaks anywhere is left out whole:
    the files are opened first, and rows of bad ones are dropped by an anti
    join, so no list of files passes through the driver."""
    st = schemas.struct(schema) if isinstance(schema, str) else schema
    none = spark.createDataFrame([], "path string, rows long, error string")
    files = list_files(spark, glob)
    if not files:
        return spark.createDataFrame([], st if st is not None else T.StructType([])), none
    report = scratch_path(spark, "bad-files")
    open_files(spark, files).where("error is not null").write.parquet(report)
    bad = spark.read.schema(none.schema).parquet(report)
    reader = spark.read.option("ignoreCorruptFiles", "true").format("parquet")
    rows = (reader.schema(st) if st is not None else reader).load(files)
    return rows.join(bad.select(_plain_path(F.col("path")).alias("_bad")), _plain_path(F.url_decode(F.replace(rows["_metadata"]["file_path"], F.lit("+"), F.lit("%2B")))) == F.col("_bad"), "left_anti"), bad


def _plain_path(path: F.Column) -> F.Column:
    return F.regexp_replace(path, "^file:/*", "/")


def require_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns missing from the schema (footer only, no job)."""
    have = set(df.columns)
    return [c for c in required if c not in have]


def require_types(df: DataFrame, expected: dict[str, str]) -> list[str]:
    """``"col: expected X, got Y"`` for present columns of another type."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [f"{c}: expected {t}, got {types[c]}" for c, t in expected.items() if c in types and types[c] != t]


def raw_vs_loaded_dates(raw_files: DataFrame, *loaded: DataFrame) -> DataFrame:
    """Dates that have a raw file but no row in any loaded table.
    ``raw_files`` has a ``path`` column; loaded frames a ``date`` column."""
    raw = raw_files.select(date_from_filename(F.col("path")).alias("date")).filter(F.col("date").isNotNull()).distinct()
    have = None
    for df in loaded:
        d = df.select("date")
        have = d if have is None else have.union(d)
    return raw.join(have.distinct(), "date", "left_anti")
