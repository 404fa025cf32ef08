"""Tables by key on disk, their joins, and published versions."""

import random
import time

import pytest
from pyspark.sql import functions as F

from punctua.operators import buckets, settle
from punctua.sources import tables as io


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def sample(spark, n=600):
    dice = random.Random(1)
    rows = [(dice.choice(["hot", "hot", f"k{dice.randrange(90)}", None]), i) for i in range(n)]
    return spark.createDataFrame(rows, "k string, v int").repartition(4)


def lookup(spark):
    return spark.createDataFrame([(f"k{i}", i) for i in range(0, 90, 2)] + [("hot", -1)], "k string, w int")


@pytest.mark.parametrize("heavy", [[], ["hot"]])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_joins_of_stored_tables_shuffle_nothing(spark, how, heavy):
    facts, other = sample(spark), lookup(spark)
    left = buckets.store_buckets(facts, "k", 8, heavy)
    right = buckets.store_buckets(other, "k", 8)
    met = buckets.join_buckets(left, right, "k", how, heavy)
    assert " Exchange" not in plan(met).replace("BroadcastExchange", "")
    wanted = sorted(map(tuple, facts.join(other, "k", how).select("k", "v", "w").collect()), key=repr)
    assert sorted(map(tuple, met.select("k", "v", "w").collect()), key=repr) == wanted


def test_raw_facts_are_shuffled_once(spark):
    right = buckets.store_buckets(lookup(spark), "k", 8)
    met = buckets.join_buckets(sample(spark), right, "k")
    assert plan(met).count("hashpartitioning(k") == 1


def test_rows_lie_in_the_bucket_of_their_key(spark):
    facts = sample(spark)
    dealt = buckets.spread_by_key(facts, "k", 8, ["hot"]).withColumn("p", F.spark_partition_id())
    light = dealt.where("k is not null and k <> 'hot'")
    assert light.where(F.col("p") != buckets.bucket_of("k", 8)).isEmpty()
    loose = dealt.where("k is null or k = 'hot'").groupBy("p").count().collect()
    assert len(loose) == 8 and max(r["count"] for r in loose) < 3 * min(r["count"] for r in loose)
    left = buckets.store_buckets(facts, "k", 8, ["hot"])
    named = left.withColumn("b", F.regexp_extract(F.input_file_name(), r"_(\d+)\.c", 1).cast("int"))
    assert named.where(F.col("b") != buckets.bucket_of("k", 8)).isEmpty()
    assert left.count() == facts.count()


def test_frequent_keys_are_never_missed(spark):
    rows = [("a",)] * 300 + [("b",)] * 200 + [(f"x{i}",) for i in range(2000)] + [(None,)] * 400
    frame = spark.createDataFrame(rows, "k string").repartition(5)
    assert buckets.frequent_keys(frame, "k", 0.05, 10) == ["a", "b"]
    assert buckets.frequent_keys(frame, "k", 0.05, 1000) == []
    assert buckets.frequent_keys(frame.limit(0), "k") == []


def test_an_integer_for_each_bucket(spark):
    keys = buckets.range_keys(spark, 37)
    found = spark.createDataFrame(list(enumerate(keys)), "i int, k int").select(
        "i", buckets.bucket_of("k", 37).alias("b")).collect()
    assert all(r.i == r.b for r in found) and len(found) == 37


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "table")
    io.write_table(spark.range(100), path)
    opened = io.read_table(spark, path)
    broken = spark.range(0, 100, 1, 10).select(
        F.when(F.col("id") == 95, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="killed"):
        io.write_table(broken, path)
    assert io.read_table(spark, path).count() == 100 and opened.count() == 100
    io.write_table(spark.range(7), path)
    # A reader of the version before still sees it; the next but one is gone.
    assert opened.count() == 100 and io.read_table(spark, path).count() == 7
    io.write_table(spark.range(8), path)
    kept = [p for p in (tmp_path / "table").iterdir() if p.name.startswith("v-")]
    assert io.read_table(spark, path).count() == 8 and len(kept) == 2


def test_a_reader_between_writing_and_switching_sees_the_old_rows(spark, tmp_path):
    path, seen = str(tmp_path / "table"), []

    def write(version):
        spark.range(3).write.parquet(version)
        seen.append(io.read_table(spark, path).count())

    io.write_table(spark.range(9), path)
    io.publish(spark, path, write)
    assert seen == [9] and io.read_table(spark, path).count() == 3


def test_intermediates_go_and_other_tables_stay(spark):
    before = settle.store(spark.range(3))
    with settle.intermediates(spark):
        inside = settle.store(spark.range(5))
        outer = settle.fresh_path(spark, "outer")
        with settle.intermediates(spark):
            settle.store(spark.range(7)).write.parquet(outer)
        assert inside.count() == 5 and spark.read.parquet(outer).count() == 7
    assert before.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(outer)


def test_lookups_are_broadcast_by_rows_and_bytes(spark):
    wide = spark.createDataFrame([(i, "x" * 1000) for i in range(50)], "i int, t string")
    assert settle.fits_broadcast(wide, 50) and not settle.fits_broadcast(wide, 49)
    assert not settle.fits_broadcast(wide, 50, 10_000)


def test_work_side_by_side_ends_before_a_failure_is_raised(spark):
    done, stored = [], []

    def fails():
        raise ValueError("first")

    def works():
        time.sleep(0.3)
        stored.append(settle.store(spark.range(4)))
        done.append(stored[0].count())

    with settle.intermediates(spark):
        with pytest.raises(ValueError, match="first"):
            settle.side_by_side(spark, [fails, works])
        assert done == [4]
    with pytest.raises(Exception, match="PATH_NOT_FOUND|FAILED_READ_FILE"):
        stored[0].count()
        spark.read.parquet(stored[0].inputFiles()[0])
    settle.side_by_side(spark, [])
