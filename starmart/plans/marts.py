"""Reporting marts over the star schema.

The marts are defined without ORDER BY (ordering is applied once, at extract time).

``state_totals`` pre-aggregates the fact by (region_sk, state) before it meets the
region dimension: the join then sees at most one row per state instead of one per
fact row, and the second aggregate combines the partial sums and counts. The region
side is only ever the key, name and position columns of the dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.sources.catalog import POINTER, current_version_sql
from starmart.schemas import STATE_DAILY_COLS, STATE_TOTALS_COLS, US_TOTALS_COLS


def state_totals(fact: DataFrame, dim_region: DataFrame) -> DataFrame:
    """Per (region state name, state abbreviation): summed positives and deaths and the
    rounded mean of currently hospitalized (``ROUND`` = half away from zero)."""
    partial = (fact.groupBy("region_sk", "state")
                   .agg(F.sum("positive").alias("p_pos"),
                        F.sum("death").alias("p_death"),
                        F.sum("hospitalizedcurrently").alias("p_hsum"),
                        F.count("hospitalizedcurrently").alias("p_hcnt")))
    regions = dim_region.select("region_sk", F.col("state").alias("region_state"))
    joined = partial.join(regions, "region_sk")
    out = (joined.groupBy("region_state", "state")
                 .agg(F.sum("p_pos").alias("total_positive_cases"),
                      F.sum("p_death").alias("total_deaths"),
                      F.round(F.try_divide(F.sum("p_hsum"), F.sum("p_hcnt")), 0).alias("avg_hospitalized")))
    return out.select(F.col("region_state").alias("state"), F.col("state").alias("state_abv"),
                      "total_positive_cases", "total_deaths",
                      "avg_hospitalized").toDF(*STATE_TOTALS_COLS)


def us_totals(fact: DataFrame) -> DataFrame:
    """National sums and the first and last reported day (one row)."""
    return fact.agg(F.sum("positive"), F.sum("death"),
                    F.min("date"), F.max("date")).toDF(*US_TOTALS_COLS)


def state_daily(fact: DataFrame, dim_date: DataFrame, dim_region: DataFrame) -> DataFrame:
    """Daily state rows with calendar date, state name and one position per row."""
    dates = dim_date.select(F.col("date_id"), F.col("date").alias("cal_date"))
    regions = dim_region.select("region_sk", F.col("state").alias("region_state"),
                                F.col("latitude").alias("r_lat"), F.col("longitude").alias("r_lon"))
    joined = (fact.join(dates, fact["date"] == dates["date_id"])
                  .join(regions, "region_sk"))
    keys = ["cal_date", "region_state", "state", "positive", "positiveincrease", "negative",
            "death", "deathincrease", "recovered", "hospitalized", "hospitalizedcurrently",
            "hospitalizedincrease"]
    out = joined.groupBy(*keys).agg(F.min("r_lat").alias("lat"), F.min("r_lon").alias("lon"))
    return out.select(*keys, "lat", "lon").toDF(*STATE_DAILY_COLS)


def view_sql(db: str) -> dict[str, tuple[str, list[str]]]:
    """The marts as view queries over the published tables of ``db``: name -> (query, columns).

    The same rows as the functions above; a catalog view needs its text. A query looks the
    version in force up once, so its tables are of one version even where the pointer is
    replaced while the query is being analysed.
    """
    once = f"WITH pointer AS (SELECT version FROM `{db}`.`{POINTER}`)"
    fact, region, dates = (current_version_sql(db, t, "pointer") for t in ("fact_covid", "dim_region", "dim_date"))
    keys = ["d.`date`", "r.state", "f.state", *[f"f.{c}" for c in (
        "positive", "positiveincrease", "negative", "death", "deathincrease", "recovered",
        "hospitalized", "hospitalizedcurrently", "hospitalizedincrease")]]
    grouped = ", ".join(keys)
    return {
        "state_totals": (f"""{once}
            SELECT r.state AS c1, p.state AS c2, sum(p.pos) AS c3, sum(p.dead) AS c4,
                   round(try_divide(sum(p.hosp), sum(p.days)), 0) AS c5
            FROM (SELECT region_sk, state, sum(positive) AS pos, sum(death) AS dead,
                         sum(hospitalizedcurrently) AS hosp, count(hospitalizedcurrently) AS days
                  FROM {fact} GROUP BY region_sk, state) p
            JOIN {region} r ON p.region_sk = r.region_sk
            GROUP BY r.state, p.state""", STATE_TOTALS_COLS),
        "us_totals": (f"{once} SELECT sum(positive) AS c1, sum(death) AS c2, min(`date`) AS c3, max(`date`) AS c4 "
                      f"FROM {fact}",
                      US_TOTALS_COLS),
        "state_daily": (f"""{once}
            SELECT {grouped}, min(r.latitude) AS lat, min(r.longitude) AS lon
            FROM {fact} f JOIN {dates} d ON f.`date` = d.date_id
            JOIN {region} r ON f.region_sk = r.region_sk
            GROUP BY {grouped}""", STATE_DAILY_COLS),
    }
