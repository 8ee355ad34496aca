"""Incremental daily load: a later file replaces the keys it repeats and keeps the rest;
a restarted query with the same checkpoint does not reload processed files."""

import datetime
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from covid_fixture import make_feeds
from starmart.plans import marts, star
from starmart.schemas import STATES_DAILY
from starmart.session import delete_path, path_exists, scratch_path
from starmart.streaming import daily_load, mart_store


def _land(spark, rows, path):
    spark.createDataFrame(rows, STATES_DAILY).coalesce(1).write.option("header", True).csv(path)


def _row(fips, date, state, pos):
    return (fips, date, state, pos, None, None, None, None, None, 0.0, None, None, None, int(pos))


def test_keyed_merge_and_restart(spark):
    feeds = make_feeds(spark)
    region = star.region_dimension(feeds["case"], feeds["county"])
    hosp = star.hospital_dimension(feeds["hospitals"])
    landing = scratch_path(spark, "t_landing")
    target = scratch_path(spark, "t_fact")
    ck = scratch_path(spark, "t_ck")

    _land(spark, [_row(1.0, 20200113, "AL", 10.0), _row(6.0, 20200113, "CA", 100.0),
                  _row(1.0, 20200201, "AL", 7.0)], f"{landing}/a_first")
    daily_load.start(spark, f"{landing}/*", region, hosp, target, ck).awaitTermination()
    first = {(r.date, r.state_fips): r.positive for r in daily_load.read_fact(spark, target).collect()}
    assert first == {(20200113, "01"): 10.0, (20200113, "06"): 100.0, (20200201, "01"): 7.0}

    # a correction for one key lands later, in a newer file
    _land(spark, [_row(1.0, 20200113, "AL", 11.0)], f"{landing}/b_correction")
    daily_load.start(spark, f"{landing}/*", region, hosp, target, ck).awaitTermination()
    second = {(r.date, r.state_fips): r.positive for r in daily_load.read_fact(spark, target).collect()}
    assert second == {(20200113, "01"): 11.0, (20200113, "06"): 100.0, (20200201, "01"): 7.0}

    # restart with nothing new: the checkpoint remembers both files, the table is unchanged
    q = daily_load.start(spark, f"{landing}/*", region, hosp, target, ck)
    q.awaitTermination()
    third = {(r.date, r.state_fips): r.positive for r in daily_load.read_fact(spark, target).collect()}
    assert third == second
    months = sorted(d for d in os.listdir(target.replace("file:", "")) if d.startswith("load_month="))
    assert months == ["load_month=202001", "load_month=202002"]


def test_latest_file_wins_within_a_batch(spark):
    rows = spark.createDataFrame(
        [_row(1.0, 20200113, "AL", 10.0) + ("file:/l/a.csv",),
         _row(1.0, 20200113, "AL", 12.0) + ("file:/l/b.csv",),
         _row(6.0, 20200113, "CA", 5.0) + ("file:/l/a.csv",)],
        T.StructType(STATES_DAILY.fields + [T.StructField("__sm_source", T.StringType())]))
    same_time = rows.withColumn("__sm_landed", F.lit("2020-01-14").cast("timestamp"))
    got = {(r.fips, r.positive) for r in daily_load._latest_per_key(same_time).collect()}
    assert got == {(1.0, 12.0), (6.0, 5.0)}
    # a newer file wins even if its path sorts first
    times = rows.withColumn("__sm_landed", F.when(F.col("__sm_source").endswith("a.csv"),
                                                  F.lit("2020-01-15")).otherwise(F.lit("2020-01-14"))
                            .cast("timestamp"))
    got = {(r.fips, r.positive) for r in daily_load._latest_per_key(times).collect()}
    assert got == {(1.0, 10.0), (6.0, 5.0)}


def test_replay_uses_the_complete_staging(spark):
    """A batch that failed after staging, in the middle of replacing a month, ends the same."""
    feeds = make_feeds(spark)
    region = star.region_dimension(feeds["case"], feeds["county"])
    hosp = star.hospital_dimension(feeds["hospitals"])
    target, staging = scratch_path(spark, "t_replay"), scratch_path(spark, "t_replay_stage")

    def batch(*rows):
        return (spark.createDataFrame(list(rows), STATES_DAILY)
                .withColumn("__sm_source", F.lit("f")).withColumn("__sm_landed", F.current_timestamp()))

    daily_load.merge_batch(batch(_row(1.0, 20200113, "AL", 10.0), _row(6.0, 20200114, "CA", 4.0)),
                           region, hosp, target, f"{staging}/0")
    second = batch(_row(1.0, 20200113, "AL", 11.0))
    daily_load._stage(second, region, hosp, target, f"{staging}/1")
    delete_path(spark, f"{target}/load_month=202001")  # the crash: the month is gone
    daily_load.merge_batch(second, region, hosp, target, f"{staging}/1")
    got = {(r.date, r.state_fips): r.positive for r in daily_load.read_fact(spark, target).collect()}
    assert got == {(20200113, "01"): 11.0, (20200114, "06"): 4.0}
    assert not path_exists(spark, f"{staging}/1")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _stored(spark, store, region):
    return [_rows(mart_store.state_totals(spark, store, region)), _rows(mart_store.us_totals(spark, store)),
            _rows(mart_store.state_daily(spark, store))]


def _recomputed(fact, region, calendar):
    return [_rows(marts.state_totals(fact, region)), _rows(marts.us_totals(fact)),
            _rows(marts.state_daily(fact, calendar, region))]


def test_marts_follow_by_deltas(spark):
    """Stored marts equal a full recompute after corrections, and other months are left alone."""
    feeds = make_feeds(spark)
    region = star.region_dimension(feeds["case"], feeds["county"])
    hosp = star.hospital_dimension(feeds["hospitals"])
    calendar = star.calendar(spark, datetime.date(2020, 1, 1), 366)
    landing, target, ck, store = (scratch_path(spark, f"t_delta_{n}") for n in ("land", "fact", "ck", "store"))

    def load():
        daily_load.start(spark, f"{landing}/*", region, hosp, target, ck, store=store).awaitTermination()
        fact = daily_load.read_fact(spark, target)
        assert _stored(spark, store, region) == _recomputed(fact, region, calendar)

    def files():
        root = store.replace("file:", "")
        return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}

    _land(spark, [_row(1.0, 20200113, "AL", 10.0), _row(6.0, 20200113, "CA", 100.0),
                  _row(1.0, 20200201, "AL", 7.0), _row(6.0, 20200331, "CA", 1.0)], f"{landing}/a")
    load()
    before = files()
    # the greatest of January is corrected downwards and a first day is added: no sum, minimum or
    # maximum of the old rows may stay
    _land(spark, [_row(6.0, 20200113, "CA", 3.0), _row(1.0, 20200102, "AL", 4.0)], f"{landing}/b")
    load()
    us = mart_store.us_totals(spark, store).first()
    assert tuple(us) == (25.0, 0.0, 20200102, 20200331)
    kept = before & files()
    assert kept and all("load_month=202002" in f or "load_month=202003" in f for f in kept)
    assert {f for f in before - kept if "load_month=202001" not in f} == set()
    # the store made anew is the same
    again = scratch_path(spark, "t_delta_again")
    mart_store.rebuild(daily_load.read_fact(spark, target), region, again)
    assert _stored(spark, again, region) == _stored(spark, store, region)


def test_replayed_batch_refreshes_the_store(spark):
    feeds = make_feeds(spark)
    region = star.region_dimension(feeds["case"], feeds["county"])
    hosp = star.hospital_dimension(feeds["hospitals"])
    target, staging, store = (scratch_path(spark, f"t_replay_{n}") for n in ("fact", "stage", "store"))

    def batch(*rows):
        return (spark.createDataFrame(list(rows), STATES_DAILY)
                .withColumn("__sm_source", F.lit("f")).withColumn("__sm_landed", F.current_timestamp()))

    daily_load.merge_batch(batch(_row(1.0, 20200113, "AL", 10.0), _row(6.0, 20200214, "CA", 4.0)),
                           region, hosp, target, f"{staging}/0", store)
    second = batch(_row(1.0, 20200113, "AL", 11.0))
    daily_load._stage(second, region, hosp, target, f"{staging}/1")
    mart_store.refresh(spark.read.parquet(f"{staging}/1"), region, store)   # the crash: fact not yet written
    daily_load.merge_batch(second, region, hosp, target, f"{staging}/1", store)
    assert tuple(mart_store.us_totals(spark, store).first()) == (15.0, 0.0, 20200113, 20200214)
