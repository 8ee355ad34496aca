"""Dimension and fact builders of the star schema.

Inputs are DataFrames with the raw feed column names of ``starmart.schemas``; the
driver-table analogue in ``plans.analogue`` produces frames of the same shape, so one
code path serves both.

Plan shape (per builder):

* ``region_dimension``: filter + null drops are pushed into the scans, each side of the
  many-to-many ``fips`` join is de-duplicated by a partial/final aggregate before the
  shuffle, then ``dense_key`` numbers the rows (range partitioned, no single task).
* ``hospital_dimension``: narrow column work, then ``dense_key``.
* ``calendar_dimension``: one bounds aggregate over the feed (partial per task, one row
  out), then one row per day of the span (bounded by the span, not by the data).
* ``covid_fact``: the two per-state lookups are partial aggregates over the dimensions
  (one row per state code, at most 121 by construction) and are broadcast under that
  proven bound; the large daily feed is never shuffled for them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions.codes import left_chars, recode, right_chars, zfill_code
from starmart.functions.dates import calendar_columns, date_id, parse_yyyymmdd
from starmart.operators.clean import (drop_null_rows, fill_numeric_zero,
                                      filter_not_equal_keep_null)
from starmart.operators.joins import first_per_group, join_distinct, lookup_join
from starmart.operators.keys import dense_key
from starmart.schemas import DIM_DATE, DIM_HOSPITAL, DIM_REGION, FACT_COVID

# The excluded cruise-ship place name and the state-code recode rule.
EXCLUDED_PLACE = "Grand Princess"
STATE_RECODE = {"00": "72"}

# Upper bound on distinct state codes: the first two characters of a zero-padded
# integer are each a digit or a minus sign, so there are at most 11 * 11 of them.
# A per-state lookup therefore has at most this many rows, whatever the data size.
MAX_STATE_CODES = 121


def conform_fips(df: DataFrame, src: str = "fips", recode_map: Mapping[str, str] | None = None,
                 width: int = 5, state_width: int = 2, county_width: int = 3) -> DataFrame:
    """fips (numeric) -> padded text, plus ``state_fips`` / ``county_fips`` parts."""
    padded = zfill_code(src, width)
    state = left_chars(padded, state_width)
    if recode_map:
        state = recode(state, recode_map)
    return (df.withColumn(src, padded)
              .withColumn("state_fips", state)
              .withColumn("county_fips", right_chars(F.col(src), county_width)))


def region_dimension(case_feed: DataFrame, county_feed: DataFrame,
                     excluded_place: str | None = EXCLUDED_PLACE,
                     recode_map: Mapping[str, str] | None = None) -> DataFrame:
    """``dim_region``: one row per distinct (place, county, position) with a dense key."""
    recode_map = STATE_RECODE if recode_map is None else recode_map
    places = case_feed.select("fips", "province_state", "country_region", "latitude", "longitude")
    if excluded_place is not None:
        places = filter_not_equal_keep_null(places, "province_state", excluded_place)
    # Rows without a position are dropped after the join in a row-wise step, so
    # dropping them before it is equivalent and lets Catalyst push it into the scan.
    places = drop_null_rows(places, ["fips", "latitude", "longitude"])
    counties = drop_null_rows(county_feed.select("fips", "county"), ["fips"])
    joined = join_distinct(places, counties, on=["fips"])
    conformed = conform_fips(joined, recode_map=recode_map)
    named = conformed.select(
        "fips", "state_fips", "county_fips",
        F.col("province_state").alias("state"), "county",
        F.col("country_region").alias("country"), "latitude", "longitude")
    # rows are distinct here (join of de-duplicated sides), so no copies to collapse
    keyed = dense_key(named, ["state_fips", "county_fips", "fips", "state", "county",
                              "country", "latitude", "longitude"], "region_sk",
                      collapse_copies=False, key_type="int")  # declared INTEGER
    return keyed.select(*DIM_REGION.names)


_HOSPITAL_RAW = ["fips", "state_name", "county_name", "latitude", "longtitude", "hospital_name",
                 "hq_address", "hq_city", "hq_state", "hq_zip_code", "hospital_type"]


def hospital_dimension(hospitals: DataFrame) -> DataFrame:
    """``dim_hospital``: hospitals with a known place and state, keyed by position."""
    rows = drop_null_rows(hospitals.select(*_HOSPITAL_RAW), ["fips", "state_name"])
    rows = conform_fips(rows, recode_map=None)
    rows = rows.withColumn("hq_zip_code", zfill_code("hq_zip_code", 5))
    order = ["state_fips", "county_fips", "fips", "state_name", "county_name", "hospital_name",
             "hq_address", "hq_city", "hq_state", "hq_zip_code", "hospital_type",
             "latitude", "longtitude"]
    keyed = dense_key(rows.select(*order), order, "hosp_sk", key_type="int")  # declared INTEGER
    return keyed.select(*DIM_HOSPITAL.names)


def date_bounds(daily: DataFrame, date_col: str = "date") -> DataFrame:
    """Global first and last day of an integer ``yyyymmdd`` column, as DATEs.

    Computed over the unfiltered feed, as the calendar must cover every reported day. The
    integers order like the days, so only the two results are parsed.
    """
    ends = daily.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    return ends.select(parse_yyyymmdd("lo").alias("first_date"), parse_yyyymmdd("hi").alias("last_date"))


def calendar(spark, first_date, n_days: int, num_partitions: int | None = None) -> DataFrame:
    """``dim_date`` for ``n_days`` consecutive days from ``first_date``.

    ``spark.range`` spreads the days over tasks; no single row is exploded.
    """
    days = spark.range(0, max(n_days, 0), numPartitions=num_partitions)
    with_date = days.select(F.date_add(F.lit(first_date), F.col("id").cast("int")).alias("date"))
    parts = calendar_columns("date")
    return with_date.select(
        date_id("date").alias("date_id"), "date",
        *[expr.alias(name) for name, expr in parts.items()]).select(*DIM_DATE.names)


def calendar_dimension(daily: DataFrame, date_col: str = "date") -> DataFrame:
    """``dim_date`` spanning the feed's first to last reported day, built lazily.

    The bounds are one aggregate row (partial min/max per task); the days are produced
    by ``explode(sequence(first, last))``. Its size is the number of days in the span
    (36,525 for a century), independent of the data volume, and because it stays inside
    the consumer's plan Spark can reuse the feed's shuffle between the fact and the
    calendar instead of running a separate bounds job.
    """
    days = date_bounds(daily, date_col).select(
        F.explode(F.sequence("first_date", "last_date")).alias("date"))
    parts = calendar_columns("date")
    return days.select(date_id("date").alias("date_id"), "date",
                       *[expr.alias(name) for name, expr in parts.items()]).select(*DIM_DATE.names)


_FACT_MEASURES = ["positive", "negative", "hospitalized", "hospitalizedcurrently",
                  "hospitalizeddischarged", "hospitalizedcumulative", "death", "recovered",
                  "deathincrease", "hospitalizedincrease", "positiveincrease"]


def covid_fact(daily: DataFrame, dim_region: DataFrame, dim_hospital: DataFrame) -> DataFrame:
    """``fact_covid`` at grain (date, state_fips).

    Each state points at its lowest region key and lowest hospital key; states with no
    region or no hospital are dropped (inner joins); missing measures become 0.
    """
    rows = drop_null_rows(daily.select("fips", "date", "state", *_FACT_MEASURES), ["fips", "state"])
    rows = rows.withColumn("state_fips", zfill_code("fips", 2)).drop("fips")
    region_first = first_per_group(dim_region, "state_fips", "region_sk")
    hosp_first = first_per_group(dim_hospital, "state_fips", "hosp_sk")
    joined = lookup_join(rows, region_first, "state_fips", proven_rows=MAX_STATE_CODES)
    joined = lookup_join(joined, hosp_first, "state_fips", proven_rows=MAX_STATE_CODES)
    return fill_numeric_zero(joined.select(*FACT_COVID.names))
