"""Explicit schemas of the raw inputs and declarations of the warehouse tables.

Raw inputs are read with these schemas instead of inference (inference costs a full extra
pass over the files). Codes that arrive as float-like text (``1001.0``) are read as
double and cast to int before padding; a string ``'1001.0'`` cast straight to int fails
under ANSI mode.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Raw inputs (used columns only).
# ---------------------------------------------------------------------------

CASE_FEED = T.StructType([
    T.StructField("fips", T.DoubleType()),
    T.StructField("province_state", T.StringType()),
    T.StructField("country_region", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

COUNTY_FEED = T.StructType([
    T.StructField("fips", T.DoubleType()),
    T.StructField("county", T.StringType()),
])

_DOUBLE_MEASURES = ["positive", "negative", "hospitalized", "hospitalizedcurrently",
                    "hospitalizeddischarged", "hospitalizedcumulative", "death", "recovered"]
_INT_MEASURES = ["deathincrease", "hospitalizedincrease", "positiveincrease"]

STATES_DAILY = T.StructType(
    [T.StructField("fips", T.DoubleType()),
     T.StructField("date", T.IntegerType()),
     T.StructField("state", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in _DOUBLE_MEASURES]
    + [T.StructField(c, T.IntegerType()) for c in _INT_MEASURES]
)

HOSPITALS = T.StructType([
    T.StructField("fips", T.DoubleType()),
    T.StructField("state_name", T.StringType()),
    T.StructField("county_name", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longtitude", T.DoubleType()),
    T.StructField("hospital_name", T.StringType()),
    T.StructField("hq_address", T.StringType()),
    T.StructField("hq_city", T.StringType()),
    T.StructField("hq_state", T.StringType()),
    T.StructField("hq_zip_code", T.IntegerType()),
    T.StructField("hospital_type", T.StringType()),
])


# ---------------------------------------------------------------------------
# Warehouse tables: column, type, NOT NULL, maximum length (None = unbounded).
# Names, types and declarations of the published warehouse schema,
# including its public spellings (``longtitude``).
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Column:
    name: str
    ddl_type: str
    not_null: bool = False
    max_len: int | None = None


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...]
    sort_key: tuple[str, ...]
    foreign_keys: tuple[tuple[str, str, str], ...] = ()  # (column, parent table, parent column)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def ddl(self) -> str:
        return ", ".join(f"`{c.name}` {c.ddl_type}" for c in self.columns)


DIM_DATE = TableSpec(
    "dim_date",
    (
        Column("date_id", "INT"),
        Column("date", "DATE", True),
        Column("day_name", "STRING", True, 9),
        Column("day_of_week", "INT", True),
        Column("day", "INT", True),
        Column("day_of_year", "INT", True),
        Column("month", "INT", True),
        Column("month_name", "STRING", True, 10),
        Column("week", "INT", True),
        Column("quarter", "INT", True),
        Column("year", "INT", True),
        Column("year_half", "INT", True),
        Column("is_weekend", "BOOLEAN", True),
    ),
    primary_key=("date_id",),
    sort_key=("date",),
)

DIM_HOSPITAL = TableSpec(
    "dim_hospital",
    (
        Column("hosp_sk", "INT"),
        Column("fips", "STRING", True, 6),
        Column("state_fips", "STRING", True, 2),
        Column("county_fips", "STRING", True, 3),
        Column("state_name", "STRING", True, 30),
        Column("county_name", "STRING", False, 120),
        Column("hospital_name", "STRING", True),
        Column("hq_address", "STRING", False, 150),
        Column("hq_city", "STRING", False, 150),
        Column("hq_state", "STRING", False, 2),
        Column("hq_zip_code", "STRING", False, 5),
        Column("hospital_type", "STRING", False, 150),
        Column("latitude", "DOUBLE"),
        Column("longtitude", "DOUBLE"),
    ),
    primary_key=("hosp_sk",),
    sort_key=("state_name",),
)

DIM_REGION = TableSpec(
    "dim_region",
    (
        Column("region_sk", "INT"),
        Column("fips", "STRING", True, 6),
        Column("state_fips", "STRING", True, 2),
        Column("county_fips", "STRING", True, 3),
        Column("state", "STRING", True, 30),
        Column("county", "STRING", False, 120),
        Column("country", "STRING", False, 20),
        Column("latitude", "DOUBLE"),
        Column("longitude", "DOUBLE"),
    ),
    primary_key=("region_sk",),
    sort_key=("state",),
)

FACT_COVID = TableSpec(
    "fact_covid",
    (
        Column("date", "INT"),
        Column("state_fips", "STRING", True, 3),
        Column("state", "STRING", True, 30),
        Column("positive", "DOUBLE"),
        Column("positiveincrease", "INT"),
        Column("negative", "DOUBLE"),
        Column("death", "DOUBLE"),
        Column("deathincrease", "INT"),
        Column("recovered", "DOUBLE"),
        Column("hospitalized", "DOUBLE"),
        Column("hospitalizedcurrently", "DOUBLE"),
        Column("hospitalizeddischarged", "DOUBLE"),
        Column("hospitalizedcumulative", "DOUBLE"),
        Column("hospitalizedincrease", "INT"),
        Column("region_sk", "INT"),
        Column("hosp_sk", "INT"),
    ),
    primary_key=("date", "state_fips"),
    sort_key=("date", "state"),
    foreign_keys=(
        ("date", "dim_date", "date_id"),
        ("region_sk", "dim_region", "region_sk"),
        ("hosp_sk", "dim_hospital", "hosp_sk"),
    ),
)

WAREHOUSE = (DIM_DATE, DIM_HOSPITAL, DIM_REGION, FACT_COVID)

# Published mart column names (fixed values, public spellings kept).
STATE_TOTALS_COLS = ("state", "state_abv", "total_positive_cases", "total_deaths", "avg_hospitalized")
US_TOTALS_COLS = ("postive_cases", "deaths", "begin_data", "end_data")
STATE_DAILY_COLS = ("date", "state", "state_abv", "positive", "pos_increase", "negative", "deaths",
                    "death_increase", "recovered", "hospitalized", "hosp_currently", "hosp_increase",
                    "lattitude", "longitude")
