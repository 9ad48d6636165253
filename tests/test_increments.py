"""Changes cost what they touch: buckets, months and landing files that are not theirs are neither read nor written."""

from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from venuelake.plans import increments, marts
from venuelake.sources import arrivals, buckets


def files(path):
    return {
        os.path.join(root, name) for root, _, names in os.walk(path) for name in names if name.endswith(".parquet")
    }


def opened_files(df):
    """How many files the (only) scan of ``df`` opens, by its metric."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numFiles").value()


def in_buckets(found, touched):
    return {f for f in found if any(f"/bucket={b}/" in f for b in touched)}


@pytest.fixture
def table(spark, tmp_path):
    rows = spark.range(400).select(
        F.col("id").alias("key"), (F.col("id") * 2).alias("value"), F.lit("old").alias("kind")
    ).union(spark.createDataFrame([(None, 1, "no key")], "key long, value long, kind string"))
    table = buckets.Table(str(tmp_path), "t", ("key",))
    buckets.lay_out(rows, table, 32)
    return table


def test_upsert_touches_only_its_buckets(spark, table):
    before = files(table.path)
    changes = spark.createDataFrame([(3, 7), (5, 8), (1000, 9)], "key int, value int")
    touched = buckets.upsert(table, changes.withColumn("kind", F.lit("new")))
    assert 0 < len(touched) <= 3
    after = files(table.path)
    assert before - after == in_buckets(before, touched) and after - before == in_buckets(after, touched)
    rows = {r.key: (r.value, r.kind) for r in buckets.read(spark, table).collect()}
    assert len(rows) == 402 and rows[3] == (7, "new") and rows[1000] == (9, "new") and rows[None] == (1, "no key")
    assert rows[4] == (8, "old")


def test_read_of_touched_buckets_prunes_the_scan(spark, table):
    touched = buckets.touched_buckets(spark.createDataFrame([(3,)], "key long"), table)
    own = buckets.read(spark, table, touched)
    assert 0 < opened_files(own) == len(in_buckets(files(table.path), touched)) < len(files(table.path))


def test_bucket_that_loses_its_last_row(spark, tmp_path):
    table = buckets.Table(str(tmp_path), "t", ("key",))
    buckets.lay_out(spark.range(3).toDF("key"), table, 8)
    buckets.delete_keys(table, spark.range(3).toDF("gone"))
    assert buckets.read(spark, table).count() == 0 and buckets.bucket_count(spark, table) == 8
    buckets.append_new(table, spark.range(5).toDF("key"), "key")
    buckets.append_new(table, spark.range(7).toDF("key"), "key")
    assert sorted(r.key for r in buckets.read(spark, table).collect()) == list(range(7))


def test_unfinished_change_is_finished_or_dropped(spark, table, monkeypatch):
    monkeypatch.setattr(buckets, "finish", lambda *_: None)
    touched = buckets.upsert(table, spark.createDataFrame([(3, 7, "new")], "key long, value long, kind string"))
    monkeypatch.undo()
    assert buckets.read(spark, table).where("kind = 'new'").count() == 0
    buckets.finish(spark, table)
    assert buckets.read(spark, table).where("kind = 'new'").count() == 1 and len(touched) == 1
    os.makedirs(table.pending)
    buckets.finish(spark, table)
    assert not os.path.exists(table.pending) and buckets.read(spark, table).count() == 401


def test_only_differing_buckets_are_replaced(spark, table):
    new = buckets.read(spark, table).withColumn("value", F.when(F.col("key") == 9, 0).otherwise(F.col("value")))
    before = files(table.path)
    touched = buckets.replace_changed(table, new.where("key is null or key <> 11"))
    assert len(touched) in (1, 2) and before - files(table.path) == in_buckets(before, touched)
    assert buckets.replace_changed(table, buckets.read(spark, table)) == []
    assert buckets.read(spark, table).count() == 400


def test_changed_buckets_are_moved_not_written_again(spark, table, monkeypatch):
    monkeypatch.setattr(buckets, "finish", lambda *_: None)
    touched = buckets.upsert(table, spark.createDataFrame([(3, 7, "new")], "key long, value long, kind string"))
    monkeypatch.undo()
    waiting = {os.path.relpath(f, table.pending) for f in files(table.pending)}
    buckets.finish(spark, table)
    there = {os.path.relpath(f, table.path) for f in in_buckets(files(table.path), touched)}
    assert there == waiting and there and not os.path.exists(table.pending)


def test_keys_must_contain_those_of_the_bucket(spark, table):
    with pytest.raises(ValueError):
        buckets.upsert(table, spark.createDataFrame([(1, 2, "x")], "key long, value long, kind string"), ["value"])


SWIPES = "id long, userId long, imageId long, timestamp timestamp, swipeLeft int"


def test_days_replace_their_states_and_leave_other_months(spark, tmp_path):
    at = lambda m, d: datetime(2024, m, d, 12)
    rows = [(k, k % 9 + 40_000 * (k % 2), k % 6, at(1 + k % 4, 1 + k % 20), k % 2) for k in range(400)]
    rows += [(900, None, 1, at(2, 3), 1), (901, 4, 1, at(2, 3), None)]
    swipes = spark.createDataFrame(rows, SWIPES)
    images = spark.createDataFrame([(k, k % 3) for k in range(6)], "id long, restaurantId long")
    names = spark.createDataFrame([(k, f"r{k}") for k in range(3)], "key long, restaurant_name string")
    late = F.to_date("timestamp") == "2024-02-03"
    folder = str(tmp_path)
    first = swipes.where((F.col("timestamp") < "2024-04-01") & (~late | (F.col("userId") > 5)))
    assert increments.add_days(spark, folder, first, images, names) == [202401, 202402, 202403]
    before = files(folder)
    new = swipes.where((F.col("timestamp") >= "2024-04-01") | late)
    assert increments.add_days(spark, folder, new, images, names) == [202402, 202404]
    gone = before - files(folder)
    assert gone and all("state_month=202402" in f or "_pending" in f for f in gone)
    daily = increments.daily_from_states(increments.month_states(spark, folder))
    assert sorted(daily.collect()) == sorted(marts.daily_stats(swipes, images).collect())
    monthly = spark.read.parquet(f"{folder}/{increments.MONTHLY}").drop("state_month")
    fresh = marts.monthly_stats(marts.daily_stats(swipes, images), names)
    assert sorted(monthly.select(*fresh.columns).collect()) == sorted(fresh.collect())
    own = {f for f in files(f"{folder}/{increments.STATES}") if "state_month=202404" in f}
    assert opened_files(increments.month_states(spark, folder, [202404])) == len(own)
    assert increments.add_days(spark, folder, swipes.limit(0), images, names) == []


def test_states_of_scattered_visitors_are_small(spark):
    """A visitor among keys that lie far apart takes a row of numbers, not a bitmap of all keys near it."""
    keys = F.col("id") * 40_000 - 20_000_000
    swipes = spark.range(1000).select("id", keys.alias("userId"), F.lit(1).alias("imageId"), F.lit(datetime(2024, 1, 2)).alias("timestamp"), F.lit(1).alias("swipeLeft"))
    twice = swipes.union(swipes).union(swipes.limit(1).withColumn("userId", F.lit(-20_000_001)))
    images = spark.createDataFrame([(1, 7)], "id long, restaurantId long")
    states = increments.day_states(twice, images)
    assert {f.dataType.typeName() for f in states.schema} <= {"long", "integer", "date"}
    assert states.count() == 1001
    assert increments.daily_from_states(states).collect() == marts.daily_stats(twice, images).select("restaurantId", "date", "users", "impressions", "left_swipes").collect()
    assert [r.visitors for r in increments.visitors_from_states(states).collect()] == [1001]


def test_files_are_read_once(spark, tmp_path):
    landing, seen = str(tmp_path / "landing"), []
    take = lambda: arrivals.read_arrivals(
        spark, landing, str(tmp_path / "record"), "n long, name string",
        lambda rows, batch: seen.append((batch, sorted((r.n, r.name, r.key) for r in rows.collect()))), key="key",
        key_pattern="/(g_[a-z])/",
    )
    spark.range(2).toDF("n").write.parquet(f"{landing}/g_a")
    assert take() == 1
    assert take() == 0
    spark.range(5, 6).select(F.lit("x").alias("name"), F.col("id").alias("n")).write.parquet(f"{landing}/g_b")
    assert take() == 1
    assert seen == [(0, [(0, None, "g_a"), (1, None, "g_a")]), (1, [(5, "x", "g_b")])]


def test_failed_batch_comes_again(spark, tmp_path):
    landing, seen = str(tmp_path / "landing"), []
    spark.range(3).toDF("n").write.parquet(landing)

    def handle(rows, batch):
        seen.append((batch, rows.count()))
        if len(seen) == 1:
            raise RuntimeError("lost")

    with pytest.raises(Exception):
        arrivals.read_arrivals(spark, landing, str(tmp_path / "record"), "n long", handle)
    assert arrivals.read_arrivals(spark, landing, str(tmp_path / "record"), "n long", handle) == 1
    assert seen == [(0, 3), (0, 3)]
