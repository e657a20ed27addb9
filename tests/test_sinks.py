"""Keyed writes on files: null and number-like partitions, order inside files,
staging that is removed, tables that are replaced whole."""

import glob
import os

from pyspark.sql import functions as F

from tickvault.session import shared_dir
from tickvault.sources import sinks as W


def test_null_and_padded_partitions_survive(spark, tmp_dir):
    rows = [(1, "001", 1.0), (2, "002", 2.0), (3, None, 3.0), (4, None, 4.0)]
    d = spark.createDataFrame(rows, "id long, symbol string, v double")
    W.upsert_replace(spark, d, f"{tmp_dir}/t", ["symbol", "id"], ["symbol"], ["v"])
    new = spark.createDataFrame([(1, "001", 10.0), (3, None, 30.0), (5, None, 50.0)], d.schema)
    W.upsert_replace(spark, new, f"{tmp_dir}/t", ["symbol", "id"], ["symbol"], ["v"])
    back = W.read_as(spark, f"{tmp_dir}/t", d.schema).select("id", "symbol", "v")
    assert sorted(back.collect(), key=lambda r: r["id"]) == [(1, "001", 10.0), (2, "002", 2.0), (3, None, 30.0), (4, None, 4.0), (5, None, 50.0)]
    W.upsert_ignore(spark, new.withColumn("v", F.lit(0.0)), f"{tmp_dir}/t", ["symbol", "id"], ["symbol"], ["v"])
    assert back.agg(F.sum("v")).first()[0] == 96.0


def test_files_of_partitions_are_sorted(spark, tmp_dir):
    d = spark.range(2000).select((F.col("id") * 7919 % 2000).alias("k"), (F.col("id") % 3).alias("day"))
    W.append(d, f"{tmp_dir}/t", ["day"], ["k"])
    files = glob.glob(f"{tmp_dir}/t/day=*/*.parquet")
    assert len(files) == 3                      # clustered: one file a day, not one per task and day
    for f in files:
        keys = [r["k"] for r in spark.read.parquet(f).collect()]
        assert keys == sorted(keys)


def test_staging_is_removed(spark, tmp_dir):
    left = lambda: set(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/tickvault/staging-*"))
    before = left()
    d = spark.createDataFrame([(1, 1)], "k int, v int")
    for f in (W.upsert_replace, W.upsert_ignore):
        f(spark, d, f"{tmp_dir}/{f.__name__}", ["k"], [], ["v"])
        f(spark, d, f"{tmp_dir}/{f.__name__}", ["k"], [], ["v"])
    W.replace_small_table(d, f"{tmp_dir}/small")
    assert left() == before
    assert W.read_table(spark, f"{tmp_dir}/upsert_replace").count() == 1


def test_a_crash_leaves_the_old_table_or_the_new(spark, tmp_dir, monkeypatch):
    """Stopped at every step of a replace, first and later, plain or versioned
    before: a reader sees the old rows until the commit, then the new ones."""
    path = f"{tmp_dir}/t"
    spark.range(3).write.parquet(path)                       # a table from before versions
    seen = lambda: sorted(r[0] for r in W.read_table(spark, path).collect())

    class Crash(Exception):
        pass

    def crash(*_):
        raise Crash

    old = [0, 1, 2]
    for turn in range(3):
        new = [10 * (turn + 1) + i for i in range(2)]
        d = spark.createDataFrame([(x,) for x in new], "id long")
        for step, after in (("_write", old), ("_commit", old), ("_tidy", new)):
            with monkeypatch.context() as m:
                m.setattr(W, step, crash)
                try:
                    W.replace_table(d, path)
                    raise AssertionError("no crash")
                except Crash:
                    pass
            assert seen() == after, (turn, step)
        W.replace_table(d, path)
        old = new
    W.upsert_replace(spark, spark.createDataFrame([(30,), (40,)], "id long"), path, ["id"], [], ["id"])
    assert seen() == [30, 31, 40]
    W.upsert_ignore(spark, spark.createDataFrame([(31,), (50,)], "id long"), path, ["id"], [], ["id"])
    assert seen() == [30, 31, 40, 50]
    assert len(W._commits(spark, path)) == 2 and len(glob.glob(f"{path}/_versions/*")) == 2 and not glob.glob(f"{path}/part-*")


def test_a_first_write_that_crashes_is_no_table(spark, tmp_dir, monkeypatch):
    path, d = f"{tmp_dir}/t", spark.range(3)
    with monkeypatch.context() as m:
        m.setattr(W, "_commit", lambda *_: 1 / 0)
        try:
            W.replace_table(d, path)
        except ZeroDivisionError:
            pass
    assert not W.exists(spark, path)
    W.replace_table(d, path)
    assert W.exists(spark, path) and W.read_table(spark, path).count() == 3


def _rows_read(df):
    """Rows that came out of the file scan of a query, which it runs."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.executedPlan()
    if "ResultQueryStage" in plan.nodeName():
        plan = plan.plan()
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


def test_bloom_filters_skip_files_of_a_lookup(spark, tmp_dir):
    d = spark.range(400_000).select(F.md5(F.col("id").cast("string")).alias("k"), "id").repartition(4)
    W.append(d, f"{tmp_dir}/plain")
    W.append(d, f"{tmp_dir}/bloom", bloom=["k"])
    keys = [r["k"] for r in d.filter("id < 10").collect()]
    read = {n: sum(_rows_read(spark.read.parquet(f"{tmp_dir}/{n}").filter(F.col("k") == k)) for k in keys) for n in ("plain", "bloom")}
    assert read["plain"] == 4_000_000 and 1_000_000 <= read["bloom"] < 1_500_000    # one file of four, rarely a second


def test_an_insert_reads_only_rows_near_its_keys(spark, tmp_dir):
    """1 % of the keys at one end: files outside their range are not read; the
    result is that of the whole anti join, nulls included."""
    d = spark.range(0, 100_000, 1, 10).select("id", F.when(F.col("id") > 5, F.col("id").cast("string")).alias("name"))
    W.append(d, f"{tmp_dir}/t", sort_by=["id"])
    batch = spark.range(99_500, 100_500).select("id", F.col("id").cast("string").alias("name"))
    there = spark.read.parquet(f"{tmp_dir}/t")
    assert _rows_read(W._near(there, batch, ["id"])) <= 10_000
    W.upsert_ignore(spark, batch, f"{tmp_dir}/t", ["id"], [], ["id"])
    assert spark.read.parquet(f"{tmp_dir}/t").agg(F.count("id"), F.countDistinct("id")).first() == (100_500, 100_500)
    odd = spark.createDataFrame([(3, None), (3, "x"), (200_000, None), (3, None)], "id long, name string")
    W.upsert_ignore(spark, odd, f"{tmp_dir}/t", ["id", "name"], [], ["id"])
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 100_502
    W.insert_missing_dates(spark, odd.distinct(), f"{tmp_dir}/t", ["id", "name"])
    W.insert_missing_dates(spark, odd.limit(0), f"{tmp_dir}/t", ["id", "name"])
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 100_502


def test_writes_count_what_they_write(spark, tmp_dir):
    """Counts equal a scan after the write: with and without partitions, of an
    empty batch, over two writes, and with a key that holds most rows."""
    dim = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    d = spark.range(10_000).select(F.when(F.col("id") % 10 < 8, 1).when(F.col("id") % 10 == 8, 5).cast("int").alias("k"), (F.col("id") % 4).alias("p"), "id")
    for parts in ([], ["p"]):
        c = W.Counts({"alone": F.col("_linked").isNull(), "low": F.col("id") < 100}, (dim, ["k"]))
        path = f"{tmp_dir}/t{len(parts)}"
        W.append(d, path, parts, ["id"], c)
        assert c.found == {"alone": 2000, "low": 100}
        assert set(spark.read.parquet(path).columns) == {"k", "p", "id"} and spark.read.parquet(path).count() == 10_000
        W.append(d.filter("id < 0"), path, parts, ["id"], c)
        assert c.found == {"alone": 2000, "low": 100}
        W.upsert_ignore(spark, d.filter("id < 50").withColumn("id", -F.col("id") - 1), path, ["p", "id"], parts, ["id"], ["id"], c)
        assert c.found == {"alone": 2010, "low": 150}


def test_upserts_of_many_partition_values(spark, tmp_dir, monkeypatch):
    """A table of more ids than get a directory each is dealt over buckets:
    upserts, inserts and appends give the same rows, and stay in that layout."""
    monkeypatch.setattr(W, "PARTITIONS", 20)
    monkeypatch.setattr(W, "BUCKETS", 4)
    d = spark.range(200).select((F.col("id") % 50).alias("p"), F.col("id").alias("k"), F.lit(1.0).alias("v"))
    d = d.unionAll(spark.createDataFrame([(None, 900, 1.0)], d.schema))
    key, parts, path = ["p", "k"], ["p"], f"{tmp_dir}/t"
    W.upsert_ignore(spark, d, path, key, parts, ["v"])
    dirs = sorted(os.listdir(path))
    assert len([x for x in dirs if "=" in x]) <= 4 and not any(x.startswith("p=") for x in dirs)
    W.upsert_replace(spark, d.where("k % 20 = 0").withColumn("v", F.lit(2.0)), path, key, parts, ["v"])
    W.upsert_ignore(spark, spark.createDataFrame([(3, 3, 9.0), (3, 777, 3.0), (77, 778, 3.0), (None, 900, 9.0)], d.schema), path, key, parts, ["v"])
    W.insert_missing_dates(spark, spark.createDataFrame([(3, 3, 9.0), (4, 779, 4.0)], d.schema), path, key, parts)
    W.append(spark.createDataFrame([(5, 780, 5.0)], d.schema), path, parts)
    got = {(r["p"], r["k"]): r["v"] for r in W.read_table(spark, path).collect()}
    want = {(i % 50, i): 2.0 if i % 20 == 0 else 1.0 for i in range(200)}
    want |= {(3, 777): 3.0, (77, 778): 3.0, (4, 779): 4.0, (5, 780): 5.0}
    assert {k: v for k, v in got.items() if k[0] is not None} == want and got[None, 900] == 2.0
    assert W.read_table(spark, path).columns == ["p", "k", "v"] and W.read_table(spark, path).count() == len(got)
    few = f"{tmp_dir}/few"
    W.upsert_ignore(spark, d.where("p < 3"), few, key, parts, ["v"])
    assert sorted(x for x in os.listdir(few) if "=" in x) == ["p=0", "p=1", "p=2"]
