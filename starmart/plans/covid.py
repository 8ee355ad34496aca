"""End-to-end star build on the driver-table analogue, shared by the query registry."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from starmart.plans import analogue, marts, star, warehouse


@dataclass
class Star:
    dim_region: DataFrame
    dim_hospital: DataFrame
    dim_date: DataFrame | None
    fact_covid: DataFrame
    daily: DataFrame


def region_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.region_dimension(analogue.case_feed(spark, sf_dir),
                                 analogue.county_feed(spark, sf_dir),
                                 excluded_place=analogue.ANALOGUE_EXCLUDED_PLACE)


def hospital_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.hospital_dimension(analogue.hospital_feed(spark, sf_dir))


def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.calendar_dimension(analogue.states_daily(spark, sf_dir))


def feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The analogue feeds under the names ``warehouse.build`` expects."""
    return {"case": analogue.case_feed(spark, sf_dir), "county": analogue.county_feed(spark, sf_dir),
            "daily": analogue.states_daily(spark, sf_dir),
            "hospitals": analogue.hospital_feed(spark, sf_dir)}


def build_star(spark: SparkSession, sf_dir: str, with_calendar: bool = True) -> Star:
    f = feeds(spark, sf_dir)
    t = warehouse.build(f, analogue.ANALOGUE_EXCLUDED_PLACE, with_calendar)
    return Star(t["dim_region"], t["dim_hospital"], t.get("dim_date"), t["fact_covid"], t["daily"])


def fact_covid(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = build_star(spark, sf_dir, with_calendar=False)
    return s.fact_covid


def state_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = build_star(spark, sf_dir, with_calendar=False)
    return marts.state_totals(s.fact_covid, s.dim_region)


def us_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = build_star(spark, sf_dir, with_calendar=False)
    return marts.us_totals(s.fact_covid)


def state_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = build_star(spark, sf_dir)
    return marts.state_daily(s.fact_covid, s.dim_date, s.dim_region)
