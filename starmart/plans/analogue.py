"""The star pipeline's raw feeds, derived from the driver's TPC-H-like tables.

The public-health inputs are not available offline, so every operator is exercised on
feeds of the same shape computed by Spark from ``customer``, ``orders``, ``supplier`` and
``nation``; their size grows with the scale factor like the real feeds grow with days.

| feed | derived from | role |
|---|---|---|
| case feed | ``customer``: fips = nation*1000 + custkey mod 100 (NULL for 3007), place = market segment (NULL for BUILDING), latitude = floor(balance / 100), longitude = nation | many rows per place |
| county feed | ``orders`` JOIN ``customer`` JOIN ``nation`` (without nation 24): one row per order with the customer's fips and the nation name as county | daily rows per county |
| hospitals | ``supplier``: fips = nation*1000 + suppkey mod 100, names, an address holding a comma and a quote, zip = suppkey | point features |
| states daily | ``orders`` JOIN ``customer`` grouped by (nation, order day): counts by status and priority, some turned into NULL | one row per state and day |

The excluded place of the analogue is ``MACHINERY``. Nation 0 pads to state code ``00``
(recoded to ``72`` in the region dimension, so it finds no region) and nation 24 has
no county rows: both states drop out of the fact, as territories do in the real data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.dates import date_id

ANALOGUE_EXCLUDED_PLACE = "MACHINERY"


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Driver table ``name``; the file listing and footer schema are resolved once per session
    (the inputs are read-only, and a DataFrame is an immutable, lazy plan)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (f"{id(spark)}:{spark.conf.get('spark.app.id', '')}", path)
    df = _TABLES.get(key)
    if df is None:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def _fips_number(nation: str, key: str):
    return F.col(nation) * 1000 + F.col(key) % 100


def case_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    code = _fips_number("c_nationkey", "c_custkey")
    return c.select(
        F.when(code == 3007, F.lit(None)).otherwise(code).cast("double").alias("fips"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None))
         .otherwise(F.col("c_mktsegment")).alias("province_state"),
        F.lit("US").alias("country_region"),
        F.floor(F.col("c_acctbal") / 100).cast("double").alias("latitude"),
        F.col("c_nationkey").cast("double").alias("longitude"),
    )


def county_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = (table(spark, sf_dir, "nation").where(F.col("n_nationkey") != 24)
         .select(F.col("n_nationkey").alias("c_nationkey"), "n_name"))
    rows = o.join(c, o["o_custkey"] == c["c_custkey"])
    # nation is a fixed-size lookup: the planner broadcasts it from its file-size
    # statistics, and AQE re-checks the measured size at run time.
    rows = rows.join(n, "c_nationkey")
    return rows.select(_fips_number("c_nationkey", "c_custkey").cast("double").alias("fips"),
                       F.col("n_name").alias("county"))


def hospital_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        _fips_number("s_nationkey", "s_suppkey").cast("double").alias("fips"),
        F.concat(F.lit("STATE_"), F.col("s_nationkey").cast("string")).alias("state_name"),
        F.concat(F.lit("COUNTY_"), (F.col("s_suppkey") % 100).cast("string")).alias("county_name"),
        F.floor(F.col("s_acctbal") / 100).cast("double").alias("latitude"),
        F.col("s_nationkey").cast("double").alias("longtitude"),
        F.col("s_name").alias("hospital_name"),
        F.concat(F.col("s_suppkey").cast("string"), F.lit(' Main St, Suite "'),
                 F.col("s_nationkey").cast("string"), F.lit('"')).alias("hq_address"),
        F.concat(F.lit("CITY_"), F.col("s_nationkey").cast("string")).alias("hq_city"),
        F.lit("ST").alias("hq_state"),
        F.col("s_suppkey").cast("int").alias("hq_zip_code"),
        F.when(F.col("s_acctbal") < 0, F.lit("CRITICAL ACCESS"))
         .otherwise(F.lit("GENERAL ACUTE CARE")).alias("hospital_type"),
    )


def states_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority",
                                              "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    rows = o.join(c, o["o_custkey"] == c["c_custkey"])
    status, prio = F.col("o_orderstatus"), F.col("o_orderpriority")

    def nonzero(cnt):
        return F.when(cnt == 0, F.lit(None)).otherwise(cnt)

    day = date_id("o_orderdate")
    daily = rows.groupBy(F.col("c_nationkey"), day.alias("date")).agg(
        F.count(F.lit(1)).alias("n_all"),
        F.count_if(status == "O").alias("n_open"),
        F.count_if(status == "P").alias("n_pending"),
        F.count_if(status == "F").alias("n_filled"),
        F.count_if(prio == "1-URGENT").alias("n_urgent"),
        F.count_if(prio == "2-HIGH").alias("n_high"),
        F.count_if(prio == "3-MEDIUM").alias("n_medium"),
        F.count_if(prio == "5-LOW").alias("n_low"),
    )
    return daily.select(
        F.col("c_nationkey").cast("double").alias("fips"),
        "date",
        F.concat(F.lit("S"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("state"),
        F.col("n_all").cast("double").alias("positive"),
        F.col("n_open").cast("double").alias("negative"),
        F.col("n_urgent").cast("double").alias("hospitalized"),
        nonzero(F.col("n_filled")).cast("double").alias("hospitalizedcurrently"),
        F.col("n_high").cast("double").alias("hospitalizeddischarged"),
        nonzero(F.col("n_medium")).cast("double").alias("hospitalizedcumulative"),
        F.col("n_pending").cast("double").alias("death"),
        nonzero(F.col("n_low")).cast("double").alias("recovered"),
        F.col("n_pending").cast("int").alias("deathincrease"),
        F.col("n_urgent").cast("int").alias("hospitalizedincrease"),
        F.col("n_all").cast("int").alias("positiveincrease"),
    )
