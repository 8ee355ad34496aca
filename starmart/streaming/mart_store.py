"""Marts kept up to date by deltas: stored partial aggregates instead of a recompute.

The daily load replaces whole months of the fact, the ones its batch touches. What a mart needs
of a month is stored beside the fact, in tables partitioned by month as the fact is:

* ``partials``: per month, region key and state the sums, counts, minima and maxima that
  ``state_totals`` and ``us_totals`` are made of. They merge by adding and comparing, so a mart
  is an aggregate over months x states rows, not over the fact.
* ``state_daily``: the mart's own rows of the month.

A batch rewrites these of its months from the months' new contents, which it has at hand.
Rows that the batch replaced are gone from the month's partials as they are from the month, so
nothing needs to be subtracted, which a minimum could not be. The cost follows the batch:
other months are neither read nor written. Rewriting a month twice gives the same rows, so a
batch that is replayed after a failure may do so.

The store holds region keys of the dimensions it was built with; after a rebuild of those,
``rebuild`` makes it anew from the whole fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.dates import parse_yyyymmdd
from starmart.plans import marts
from starmart.schemas import STATE_TOTALS_COLS, US_TOTALS_COLS

MONTH = "load_month"  # yyyymm


def month_of(date_col: str):
    return (F.col(date_col) / 100).cast("int")


def partials(fact: DataFrame) -> DataFrame:
    """Mergeable parts of the aggregate marts, one row per month, region key and state."""
    return fact.groupBy(MONTH, "region_sk", "state").agg(
        F.sum("positive").alias("positive"), F.sum("death").alias("death"),
        F.sum("hospitalizedcurrently").alias("hosp_sum"), F.count("hospitalizedcurrently").alias("hosp_days"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def _daily_rows(fact: DataFrame, dim_region: DataFrame) -> DataFrame:
    days = fact.select(F.col("date").alias("date_id")).distinct().withColumn("date", parse_yyyymmdd("date_id"))
    rows = marts.state_daily(fact, days, dim_region)
    return rows.withColumn(MONTH, F.date_format("date", "yyyyMM").cast("int"))


def refresh(months: DataFrame, dim_region: DataFrame, store: str) -> None:
    """Rewrite the stored parts of the months whose whole new contents ``months`` are (fact
    columns and ``load_month``)."""
    for name, rows in (("partials", partials(months)), ("state_daily", _daily_rows(months, dim_region))):
        (rows.repartition(MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(MONTH).parquet(f"{store}/{name}"))


def rebuild(fact: DataFrame, dim_region: DataFrame, store: str) -> None:
    """The whole store anew from the whole fact."""
    months = fact.withColumn(MONTH, month_of("date"))
    for name, rows in (("partials", partials(months)), ("state_daily", _daily_rows(months, dim_region))):
        rows.repartition(MONTH).write.mode("overwrite").partitionBy(MONTH).parquet(f"{store}/{name}")


def state_totals(spark: SparkSession, store: str, dim_region: DataFrame) -> DataFrame:
    """The per-state mart from the stored partials."""
    by_state = spark.read.parquet(f"{store}/partials").groupBy("region_sk", "state").agg(
        *[F.sum(c).alias(c) for c in ("positive", "death", "hosp_sum", "hosp_days")])
    regions = dim_region.select("region_sk", F.col("state").alias("region_state"))
    return (by_state.join(regions, "region_sk").groupBy("region_state", "state")
            .agg(F.sum("positive"), F.sum("death"),
                 F.round(F.try_divide(F.sum("hosp_sum"), F.sum("hosp_days")), 0)).toDF(*STATE_TOTALS_COLS))


def us_totals(spark: SparkSession, store: str) -> DataFrame:
    """The national mart from the stored partials."""
    return (spark.read.parquet(f"{store}/partials")
            .agg(F.sum("positive"), F.sum("death"), F.min("first_date"), F.max("last_date")).toDF(*US_TOTALS_COLS))


def state_daily(spark: SparkSession, store: str) -> DataFrame:
    """The daily mart as stored."""
    return spark.read.parquet(f"{store}/state_daily").drop(MONTH)
