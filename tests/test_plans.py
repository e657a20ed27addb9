"""Physical-plan properties that matter at scale: map-side partial
aggregation, shuffle reuse in the bar join, scan pruning and pushdown,
partition pruning for upserts, partial top-N, and no cartesian products."""

import pytest
from pyspark.sql import functions as F

from tickvault.operators import bars, dedupe, windows
from tickvault.plans import fixtures
from tickvault.sources import readers as R
from tickvault.sources import sinks as W

from places import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    old = (spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old[0])
    spark.conf.set("spark.sql.adaptive.enabled", old[1])


def test_bar_join_reuses_aggregate_partitioning(spark, no_broadcast):
    t = fixtures.load(spark, SF_SMALL)
    p = plan(bars.bars_futures(t["fx_quotes"], t["fx_trades"], 3600))
    assert p.count("Exchange hashpartitioning") == 2          # one per side, none added by the join
    assert "partial_min_by" in p and "partial_sum" in p      # map-side combine before the shuffle
    assert "CartesianProduct" not in p


def test_dedupe_combines_map_side(spark, no_broadcast):
    t = fixtures.load(spark, SF_SMALL)
    p = plan(dedupe.keep_first(t["fx_quote_landing"], ["ts_event", "instrument_id"], ["batch", "event_id"]))
    assert "partial_min_by" in p
    assert "Window" not in p


def test_top_n_per_group_is_limited_before_shuffle(spark):
    t = fixtures.load(spark, SF_SMALL)
    p = plan(windows.head_per_group(t["fx_macro_obs"], ["series_id"], [F.desc("date")], 3))
    assert "WindowGroupLimit" in p


def test_projection_and_filter_reach_the_scan(spark, tmp_dir):
    t = fixtures.load(spark, SF_SMALL)
    src = f"{tmp_dir}/quotes"
    t["fx_quotes"].withColumn("extra", F.lit("x" * 50)).write.parquet(src)
    q = R.load_quotes(spark.read.parquet(src)).filter(F.col("instrument_id") == 3)
    p = plan(q)
    scan = [ln for ln in p.split("\n") if "FileScan" in ln][0]
    assert "extra" not in scan.split("ReadSchema:")[1] and "event_id" not in scan.split("ReadSchema:")[1]
    assert "EqualTo(instrument_id,3)" in scan


def test_upsert_reads_only_touched_partitions(spark, tmp_dir):
    spark.range(5000).select((F.col("id") % 50).alias("p"), "id").write.partitionBy("p").parquet(f"{tmp_dir}/t")
    spark.range(100).select((F.col("id") % 3 + 7).alias("p"), "id").write.parquet(f"{tmp_dir}/b")
    touched = W._touched(spark.read.parquet(f"{tmp_dir}/t"), spark.read.parquet(f"{tmp_dir}/b"), ["p"])
    scan = [ln for ln in plan(touched).split("\n") if "FileScan" in ln][0]
    assert "PartitionFilters: [" in scan and "p#" in scan.split("PartitionFilters:")[1].split("]")[0]
    assert touched.count() == 300


def test_no_cartesian_or_nested_loop_in_catalogue(spark):
    import __spark_entry__ as E
    qs = E.queries()
    writes = {n for n in qs if n.startswith("stream_") or n == "parquet_upsert_roundtrip"}
    bad = []
    for n, fn in qs.items():
        if n in writes:
            continue
        p = plan(fn(spark, SF_SMALL))
        if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p:
            bad.append(n)
    assert bad == []


def test_sorted_files_let_row_groups_be_skipped(spark, tmp_dir):
    import glob

    import pyarrow.parquet as pq
    df = spark.range(200000).select((F.col("id") % 97).alias("instrument_id"), F.col("id").alias("seq"))
    W.append(df.repartition(4), f"{tmp_dir}/s", sort_by=["instrument_id", "seq"])
    files = sorted(glob.glob(f"{tmp_dir}/s/*.parquet"))
    assert len(files) == 4
    for f in files:
        t = pq.read_table(f).to_pandas()
        keys = list(zip(t["instrument_id"], t["seq"]))
        assert keys == sorted(keys)          # clustered: row-group min/max cover narrow ranges


def test_size_shuffle_partitions_never_lowers(spark, tmp_dir):
    from tickvault.session import size_shuffle_partitions
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.range(1000).write.parquet(f"{tmp_dir}/small")
    assert size_shuffle_partitions(spark, f"{tmp_dir}/small") == int(old)
    assert size_shuffle_partitions(spark, f"{tmp_dir}/small", target_bytes=100) > int(old)
    spark.conf.set("spark.sql.shuffle.partitions", old)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", old)
