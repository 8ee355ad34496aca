import datetime

from pyspark.sql import functions as F

from starmart.functions import (calendar_columns, date_id, left_chars, parse_yyyymmdd, recode,
                                right_chars, zfill_code)


def test_zfill_matches_python_zfill(spark):
    values = [1001.0, 72.0, 6.0, -1.0, 123456.0, 99999.0, 0.0, None, 12.9]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(zfill_code("x", 5)).collect()]
    expected = [None if v is None else str(int(v)).zfill(5) for v in values]
    assert got == expected  # '-0001', '123456' (not truncated), NULL stays NULL


def test_left_right_short_text(spark):
    df = spark.createDataFrame([("01001",), ("ab",), (None,)], "s string")
    got = df.select(left_chars("s", 2).alias("l"), right_chars("s", 3).alias("r")).collect()
    assert [(r.l, r.r) for r in got] == [("01", "001"), ("ab", "ab"), (None, None)]


def test_recode_keeps_other_values_and_null(spark):
    df = spark.createDataFrame([("00",), ("01",), (None,)], "s string")
    got = [r[0] for r in df.select(recode("s", {"00": "72"})).collect()]
    assert got == ["72", "01", None]


def test_calendar_parts(spark):
    df = spark.createDataFrame([(20210101,), (20210103,), (20200229,)], "d int")
    df = df.select(parse_yyyymmdd("d").alias("date"))
    parts = calendar_columns("date")
    rows = df.select("date", date_id("date").alias("date_id"),
                     *[e.alias(n) for n, e in parts.items()]).collect()
    by_day = {r.date: r for r in rows}
    fri = by_day[datetime.date(2021, 1, 1)]
    assert (fri.date_id, fri.day_name, fri.day_of_week, fri.week, fri.is_weekend) == \
        (20210101, "Friday", 5, 53, False)
    sun = by_day[datetime.date(2021, 1, 3)]
    assert (sun.day_of_week, sun.is_weekend, sun.month_name, sun.quarter, sun.year_half) == \
        (7, True, "January", 1, 1)
    leap = by_day[datetime.date(2020, 2, 29)]
    assert (leap.day, leap.day_of_year, leap.month) == (29, 60, 2)


def test_round_is_half_away_from_zero(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (0.5,)], "x double")
    assert [r[0] for r in df.select(F.round("x", 0)).collect()] == [3.0, -3.0, 1.0]


def test_scratch_paths_live_below_the_checkpoint_folder(spark):
    from starmart.session import ensure_checkpoint_dir, scratch_path

    ck = ensure_checkpoint_dir(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(ck) and b.startswith(ck) and a != b
