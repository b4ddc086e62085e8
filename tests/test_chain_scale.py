"""Figures of the warehouse build that grow with its input: keys counted exactly, dates parsed."""

import datetime
import os
import random
import time

from pyspark.sql import functions as F

from tallyworks.functions import records as R
from tallyworks.operators import joins
from tallyworks.plans import chains, standins, warehouse
from tallyworks.sinks import tables


def frames(spark):
    many = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    hot = [spark.range(n).select(F.lit("hot").alias("k")) for n in (90, 30, 1)]
    none = spark.createDataFrame([(None,)] * 5_000, "k string")
    return [many.unionByName(h).unionByName(none) for h in hot]


def test_few_keys_are_counted_exactly(spark):
    left = joins.maybe_hot(frames(spark), ["k"], 2_000)
    assert all(f.where("k = 'hot'").count() == n for f, n in zip(left, (90, 30, 1)))
    assert sum(f.count() for f in left) < 0.2 * 3 * 20_000


def test_the_hot_keys_are_the_same(spark):
    for hot_rows in (1, 50, 2_000, 2_699, 2_700):
        all_keys, few = frames(spark), joins.maybe_hot(frames(spark), ["k"], hot_rows)
        expected = joins.hot_keys(all_keys, ["k"], hot_rows).collect()
        assert joins.hot_keys(few, ["k"], hot_rows).collect() == expected
        assert len(expected) == (hot_rows < 2_700)


def test_the_warehouse_counts_only_keys_that_may_be_hot(spark, monkeypatch, tmp_path):
    spark.range(60_000).selectExpr(
        "id % 15000 AS l_orderkey", "id % 1999 AS l_partkey", "id % 97 AS l_suppkey", "cast(id % 7 + 1 AS int) AS l_linenumber",
        "cast(id % 50 AS double) AS l_quantity", "'A' AS l_returnflag", "'O' AS l_linestatus",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(15_000).selectExpr(
        "id AS o_orderkey", "id % 1500 AS o_custkey", "'O' AS o_orderstatus", "'high' AS o_orderpriority",
        "timestamp'2001-02-03 00:00:00' AS o_orderdate",
    ).write.parquet(f"{tmp_path}/orders.parquet")
    counted = []
    monkeypatch.setattr(warehouse, "hot_keys", lambda f, keys, n: counted.extend(f) or joins.hot_keys(f, keys, n))
    folder = str(tmp_path)
    warehouse.build_warehouse(
        standins.attendance(spark, folder), standins.enrollment(spark, folder), standins.grade_roster(spark, folder)
    )
    assert sum(f.count() for f in counted) < 0.05 * 60_000


def test_short_dates_are_those_of_the_pattern(spark):
    rng = random.Random(3)
    texts = [f"{d:02d}/{m:02d}/{y:02d}" for d in (0, 1, 28, 29, 30, 31, 32) for m in range(14) for y in (0, 1, 4, 99)]
    odd = ["", " ", "1/02/03", "01/2/03", "01/02/2003", " 01/02/03", "01/02/03 ", "01/02/03\n", "01-02-03", "+1/02/03",
           "-1/02/03", "٠١/٠٢/٠٣", "0a/02/03", "01/02/3", "01/02/0３", "2003-02-01", "\t01/02/03", None]
    texts += odd + ["".join(rng.choices("0123/", k=8)) for _ in range(3_000)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    both = frame.select("t", R.short_date("t").alias("got"), F.try_to_date("t", "dd/MM/yy").alias("by_pattern")).collect()
    assert [r for r in both if r["got"] != r["by_pattern"]] == []
    assert {r["t"]: r["got"] for r in both}["29/02/04"] == datetime.date(2004, 2, 29)
    plan = frame.select(R.short_date("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "gettimestamp" not in plan.lower()


def bytes_below(folder, part=""):
    return sum(os.path.getsize(f"{d}/{f}") for d, _, files in os.walk(folder) for f in files if part in f"{d}/{f}")


def test_the_extracts_are_packed_and_go_once_they_are_read(spark, tmp_path, monkeypatch):
    spark.range(20_000).selectExpr(
        "id div 4 * 7 AS l_orderkey", "id % 1999 + 1 AS l_partkey", "id % 97 + 1 AS l_suppkey", "cast(id % 4 + 1 AS int) AS l_linenumber",
        "cast(id % 49 + 1 AS double) AS l_quantity", "'A' AS l_returnflag", "'O' AS l_linestatus",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(5_000).selectExpr(
        "id * 7 AS o_orderkey", "id % 1500 AS o_custkey", "'O' AS o_orderstatus", "'high' AS o_orderpriority",
        "timestamp'2001-02-03 00:00:00' AS o_orderdate",
    ).write.parquet(f"{tmp_path}/orders.parquet")
    folder, shared = str(tmp_path), str(tmp_path / "shared")
    sources = standins.attendance(spark, folder), standins.enrollment(spark, folder), standins.grade_roster(spark, folder)
    built = warehouse.build_warehouse(*sources)
    expected = sorted(map(str, built.collect()))
    plain = str(tmp_path / "plain")
    standins.attendance_text(spark, folder).write.csv(plain)
    read, left = [], []
    build, layout = warehouse.build_warehouse, tables.overwrite_partitions
    monkeypatch.setattr(tables, "shared_folder", lambda _: shared)
    monkeypatch.setattr(warehouse, "build_warehouse", lambda *f, **o: read.append(bytes_below(shared, "ttendance")) or build(*f, **o))
    monkeypatch.setattr(tables, "overwrite_partitions", lambda *a: left.append(os.listdir(f"{shared}/tallyworks")) or layout(*a))
    facts = chains._warehouse_layout(spark, folder)
    assert sorted(map(str, facts.select(*built.columns).collect())) == expected and expected
    assert 0 < read[0] < bytes_below(plain) / 2
    assert left == [["scratch"]]


def test_an_intermediate_table_leaves_no_shuffle_files(spark):
    dirs = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs())

    def shuffled():
        return {f for d in dirs for _, _, files in os.walk(str(d)) for f in files if f.startswith("shuffle_") and f.endswith(".data")}

    before = shuffled()
    numbers = spark.range(1_000).selectExpr("id % 700 AS k").distinct()
    written = tables.scratch(numbers, "numbers")
    for _ in range(50):
        if shuffled() <= before:
            break
        time.sleep(0.2)
    assert shuffled() <= before
    numbers.collect()
    assert not shuffled() <= before  # a plain query leaves them
    assert written.count() == 700
    assert spark.conf.get(tables.DROP_SHUFFLES) == "false"
