"""Scratch tables belong to the job that made them; key ranges to the append that reserved them."""

import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from starmart.operators import keys
from starmart.operators.keys import KeyLedger, append_with_keys, dense_key
from starmart.session import (create_text, in_scope, path_exists, read_text, replace_text,
                              scratch_path, scratch_scope)


def test_a_jobs_clean_up_leaves_other_jobs_alone(spark):
    entered, made = threading.Event(), threading.Event()

    def other_job():
        with scratch_scope(spark):
            mine = dense_key(spark.range(10).selectExpr("id"), ["id"], "k").inputFiles()
            entered.set()
            assert made.wait(60)
        return mine

    with ThreadPoolExecutor(1) as pool:
        job = pool.submit(other_job)
        assert entered.wait(60)
        with scratch_scope(spark):                      # a second job, which ends later
            keyed = dense_key(spark.range(100).selectExpr("id"), ["id"], "k")
            made.set()
            gone = job.result()
            assert sorted(r.k for r in keyed.collect()) == list(range(1, 101))
            kept = keyed.inputFiles()
    unscoped = dense_key(spark.range(5).selectExpr("id"), ["id"], "k")
    assert unscoped.count() == 5
    assert not any(path_exists(spark, f) for f in gone + kept)


def test_pool_threads_work_for_their_scope(spark):
    with ThreadPoolExecutor(2) as pool:
        with scratch_scope(spark):
            with scratch_scope(spark):
                inner = list(pool.map(in_scope(lambda n: scratch_path(spark, n)), ["a", "b", "c"]))
                stray = pool.submit(scratch_path, spark, "stray").result()
                for p in [*inner, stray]:
                    spark.range(1).write.parquet(p)
            assert not any(path_exists(spark, p) for p in inner)
    assert path_exists(spark, stray)


def test_small_files(spark):
    folder = scratch_path(spark, "t_text")
    replace_text(spark, f"{folder}/m", "one")
    replace_text(spark, f"{folder}/m", "zwei €")
    assert read_text(spark, f"{folder}/m") == "zwei €"
    assert not create_text(spark, f"{folder}/m", "three") and read_text(spark, f"{folder}/m") == "zwei €"
    assert create_text(spark, f"{folder}/n", "four") and read_text(spark, f"{folder}/n") == "four"


def test_concurrent_reservations_are_disjoint(spark):
    ledger = KeyLedger(spark, scratch_path(spark, "t_ledger"))
    counts = [1, 7, 100, 0, 3, 50, 2, 9] * 3
    with ThreadPoolExecutor(8) as pool:
        firsts = list(pool.map(lambda n: ledger.reserve(n, floor=40), counts))
    keys_ = [k for f, n in zip(firsts, counts) for k in range(f, f + n)]
    assert len(keys_) == len(set(keys_)) == sum(counts)
    assert sorted(keys_) == list(range(41, 41 + sum(counts)))
    assert [a for a, b in ledger.ranges()] == sorted(a for a, b in ledger.ranges())


def test_concurrent_appends_get_disjoint_keys(spark):
    existing = spark.range(1, 11).selectExpr("id AS sk", "id AS v")
    ledger = KeyLedger(spark, scratch_path(spark, "t_append"))
    both = threading.Barrier(2)

    def append(start):
        rows = spark.range(start, start + 500).selectExpr("id AS v")
        both.wait(60)
        return [r.sk for r in append_with_keys(existing, rows, "sk", ["v"], ledger=ledger).orderBy("v").collect()]

    with ThreadPoolExecutor(2) as pool:
        a, b = pool.map(append, [1000, 5000])
    assert not set(a) & set(b) and sorted(a + b) == list(range(11, 1011))
    assert a == sorted(a) and b == sorted(b)
    # without a ledger, as before
    assert [r.sk for r in append_with_keys(existing, spark.range(2).selectExpr("id v"), "sk", ["v"]).collect()] \
        == [11, 12]


def test_sketches_of_many_tasks_merge_as_a_tree(spark):
    v = F.when(F.col("id") % 3 == 0, F.lit(-7)).otherwise(F.col("id"))
    rows = spark.range(0, 60_000, 1, 300).select(v.alias("v"))          # 300 tasks: three levels
    hot = keys._hot_copy_hashes(rows, 8)
    assert hot == [spark.sql("SELECT xxhash64(CAST(-7 AS BIGINT)) AS h").first().h]
    got = dense_key(rows, ["v"], "k")
    assert got.agg(F.min("k"), F.max("k"), F.countDistinct("k")).first()[:] == (1, 60_000, 60_000)
    assert got.where("v = -7").agg(F.max("k")).first()[0] == 20_000
    # a task of the tree merges at most FAN_IN sketches, whatever the number of scan tasks
    sketch = keys._merged_sketch(rows, 1000)
    assert sketch.first().n == 60_000
    assert keys._hot_copy_hashes(spark.range(0).selectExpr("id v"), 8) == []
