"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL re-derives the analogue feeds and the star from the driver's tables with plain
window functions (``row_number() OVER (ORDER BY ...)``), so it shares no code with the
Spark implementation. Integer sums are cast back to BIGINT (DuckDB widens them).
"""

from __future__ import annotations


def _zfill(expr: str, width: int) -> str:
    text = f"CAST(CAST(trunc({expr}) AS BIGINT) AS VARCHAR)"
    return (f"(CASE WHEN length({text}) >= {width} THEN {text} "
            f"WHEN {text} LIKE '-%' THEN '-' || lpad(substr({text}, 2), {width - 1}, '0') "
            f"ELSE lpad({text}, {width}, '0') END)")


def _nl(cols: str) -> str:
    return ", ".join(f"{c.strip()} ASC NULLS LAST" for c in cols.split(","))


FEEDS = f"""
feed AS (
  SELECT CAST(NULLIF(c_nationkey * 1000 + c_custkey % 100, 3007) AS DOUBLE) AS fips,
         NULLIF(c_mktsegment, 'BUILDING') AS province_state,
         'US' AS country_region,
         CAST(floor(c_acctbal / 100) AS DOUBLE) AS latitude,
         CAST(c_nationkey AS DOUBLE) AS longitude
  FROM customer),
county_feed AS (
  SELECT CAST(c.c_nationkey * 1000 + c.c_custkey % 100 AS DOUBLE) AS fips, n.n_name AS county
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE n.n_nationkey <> 24),
hospital_feed AS (
  SELECT CAST(s_nationkey * 1000 + s_suppkey % 100 AS DOUBLE) AS fips,
         'STATE_' || CAST(s_nationkey AS VARCHAR) AS state_name,
         'COUNTY_' || CAST(s_suppkey % 100 AS VARCHAR) AS county_name,
         CAST(floor(s_acctbal / 100) AS DOUBLE) AS latitude,
         CAST(s_nationkey AS DOUBLE) AS longtitude,
         s_name AS hospital_name,
         CAST(s_suppkey AS VARCHAR) || ' Main St, Suite "' || CAST(s_nationkey AS VARCHAR) || '"' AS hq_address,
         'CITY_' || CAST(s_nationkey AS VARCHAR) AS hq_city,
         'ST' AS hq_state,
         CAST(s_suppkey AS INTEGER) AS hq_zip_code,
         CASE WHEN s_acctbal < 0 THEN 'CRITICAL ACCESS' ELSE 'GENERAL ACUTE CARE' END AS hospital_type
  FROM supplier),
daily_counts AS (
  SELECT c.c_nationkey AS nk,
         CAST(strftime(o.o_orderdate, '%Y%m%d') AS INTEGER) AS date,
         count(*) AS n_all,
         count(*) FILTER (WHERE o.o_orderstatus = 'O') AS n_open,
         count(*) FILTER (WHERE o.o_orderstatus = 'P') AS n_pending,
         count(*) FILTER (WHERE o.o_orderstatus = 'F') AS n_filled,
         count(*) FILTER (WHERE o.o_orderpriority = '1-URGENT') AS n_urgent,
         count(*) FILTER (WHERE o.o_orderpriority = '2-HIGH') AS n_high,
         count(*) FILTER (WHERE o.o_orderpriority = '3-MEDIUM') AS n_medium,
         count(*) FILTER (WHERE o.o_orderpriority = '5-LOW') AS n_low
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2),
daily AS (
  SELECT CAST(nk AS DOUBLE) AS fips, date, 'S' || lpad(CAST(nk AS VARCHAR), 2, '0') AS state,
         CAST(n_all AS DOUBLE) AS positive,
         CAST(n_open AS DOUBLE) AS negative,
         CAST(n_urgent AS DOUBLE) AS hospitalized,
         CAST(NULLIF(n_filled, 0) AS DOUBLE) AS hospitalizedcurrently,
         CAST(n_high AS DOUBLE) AS hospitalizeddischarged,
         CAST(NULLIF(n_medium, 0) AS DOUBLE) AS hospitalizedcumulative,
         CAST(n_pending AS DOUBLE) AS death,
         CAST(NULLIF(n_low, 0) AS DOUBLE) AS recovered,
         CAST(n_pending AS INTEGER) AS deathincrease,
         CAST(n_urgent AS INTEGER) AS hospitalizedincrease,
         CAST(n_all AS INTEGER) AS positiveincrease
  FROM daily_counts)"""

STAR = FEEDS + f""",
places AS (
  SELECT DISTINCT fips, province_state, country_region, latitude, longitude FROM feed
  WHERE province_state IS DISTINCT FROM 'MACHINERY'),
region_joined AS (
  SELECT DISTINCT p.fips, p.province_state, p.country_region, p.latitude, p.longitude, c.county
  FROM places p JOIN county_feed c ON p.fips = c.fips
  WHERE p.fips IS NOT NULL AND p.latitude IS NOT NULL AND p.longitude IS NOT NULL),
region_conf AS (
  SELECT {_zfill('fips', 5)} AS fips, province_state AS state, county,
         country_region AS country, latitude, longitude
  FROM region_joined),
region_parts AS (
  SELECT fips,
         CASE WHEN left(fips, 2) = '00' THEN '72' ELSE left(fips, 2) END AS state_fips,
         right(fips, 3) AS county_fips, state, county, country, latitude, longitude
  FROM region_conf),
dim_region AS (
  SELECT CAST(row_number() OVER (ORDER BY {_nl('state_fips, county_fips, fips, state, county, country, latitude, longitude')}) AS INTEGER) AS region_sk,
         fips, state_fips, county_fips, state, county, country, latitude, longitude
  FROM region_parts),
hosp_conf AS (
  SELECT {_zfill('fips', 5)} AS fips, state_name, county_name, hospital_name, hq_address, hq_city,
         hq_state, {_zfill('hq_zip_code', 5)} AS hq_zip_code, hospital_type, latitude, longtitude
  FROM hospital_feed WHERE fips IS NOT NULL AND state_name IS NOT NULL),
hosp_parts AS (
  SELECT fips, left(fips, 2) AS state_fips, right(fips, 3) AS county_fips, state_name, county_name,
         hospital_name, hq_address, hq_city, hq_state, hq_zip_code, hospital_type, latitude, longtitude
  FROM hosp_conf),
dim_hospital AS (
  SELECT CAST(row_number() OVER (ORDER BY {_nl('state_fips, county_fips, fips, state_name, county_name, hospital_name, hq_address, hq_city, hq_state, hq_zip_code, hospital_type, latitude, longtitude')}) AS INTEGER) AS hosp_sk,
         fips, state_fips, county_fips, state_name, county_name, hospital_name, hq_address, hq_city,
         hq_state, hq_zip_code, hospital_type, latitude, longtitude
  FROM hosp_parts),
bounds AS (
  SELECT min(CAST(strptime(CAST(date AS VARCHAR), '%Y%m%d') AS DATE)) AS d0,
         max(CAST(strptime(CAST(date AS VARCHAR), '%Y%m%d') AS DATE)) AS d1
  FROM daily),
cal AS (
  SELECT CAST(d0 + CAST(i AS INTEGER) AS DATE) AS d FROM bounds, range(0, (d1 - d0) + 1) t(i)),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS date, dayname(d) AS day_name,
         CAST(isodow(d) AS INTEGER) AS day_of_week, CAST(day(d) AS INTEGER) AS day,
         CAST(dayofyear(d) AS INTEGER) AS day_of_year, CAST(month(d) AS INTEGER) AS month,
         monthname(d) AS month_name, CAST(week(d) AS INTEGER) AS week,
         CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
         CASE WHEN month(d) < 7 THEN 1 ELSE 2 END AS year_half, isodow(d) >= 6 AS is_weekend
  FROM cal),
fact_rows AS (
  SELECT *, {_zfill('fips', 2)} AS state_fips FROM daily WHERE fips IS NOT NULL AND state IS NOT NULL),
region_first AS (
  SELECT state_fips, min(region_sk) AS region_sk FROM dim_region WHERE state_fips IS NOT NULL GROUP BY 1),
hosp_first AS (
  SELECT state_fips, min(hosp_sk) AS hosp_sk FROM dim_hospital WHERE state_fips IS NOT NULL GROUP BY 1),
fact_covid AS (
  SELECT f.date, f.state_fips, f.state,
         coalesce(f.positive, 0) AS positive, coalesce(f.positiveincrease, 0) AS positiveincrease,
         coalesce(f.negative, 0) AS negative, coalesce(f.death, 0) AS death,
         coalesce(f.deathincrease, 0) AS deathincrease, coalesce(f.recovered, 0) AS recovered,
         coalesce(f.hospitalized, 0) AS hospitalized,
         coalesce(f.hospitalizedcurrently, 0) AS hospitalizedcurrently,
         coalesce(f.hospitalizeddischarged, 0) AS hospitalizeddischarged,
         coalesce(f.hospitalizedcumulative, 0) AS hospitalizedcumulative,
         coalesce(f.hospitalizedincrease, 0) AS hospitalizedincrease,
         r.region_sk, h.hosp_sk
  FROM fact_rows f JOIN region_first r ON f.state_fips = r.state_fips
  JOIN hosp_first h ON f.state_fips = h.state_fips)"""


def with_star(select: str) -> str:
    return "WITH " + STAR.strip() + "\n" + select


SQL: dict[str, str] = {
    "dim_region": with_star("SELECT * FROM dim_region"),
    "dim_hospital": with_star("SELECT * FROM dim_hospital"),
    "dim_date": with_star("SELECT * FROM dim_date"),
    "fact_covid": with_star("SELECT * FROM fact_covid"),
    "date_bounds": with_star("SELECT d0 AS first_date, d1 AS last_date FROM bounds"),
    "state_totals": with_star("""
SELECT dr.state AS state, fc.state AS state_abv, sum(fc.positive) AS total_positive_cases,
       sum(fc.death) AS total_deaths, round(avg(fc.hospitalizedcurrently), 0) AS avg_hospitalized
FROM fact_covid fc JOIN dim_region dr ON fc.region_sk = dr.region_sk
GROUP BY dr.state, fc.state"""),
    "us_totals": with_star("""
SELECT sum(positive) AS postive_cases, sum(death) AS deaths, min(date) AS begin_data,
       max(date) AS end_data
FROM fact_covid"""),
    "state_daily": with_star("""
SELECT dd.date AS date, dr.state AS state, fc.state AS state_abv, fc.positive AS positive,
       fc.positiveincrease AS pos_increase, fc.negative AS negative, fc.death AS deaths,
       fc.deathincrease AS death_increase, fc.recovered AS recovered,
       fc.hospitalized AS hospitalized, fc.hospitalizedcurrently AS hosp_currently,
       fc.hospitalizedincrease AS hosp_increase, min(dr.latitude) AS lattitude,
       min(dr.longitude) AS longitude
FROM fact_covid fc JOIN dim_date dd ON fc.date = dd.date_id
JOIN dim_region dr ON fc.region_sk = dr.region_sk
GROUP BY dd.date, dr.state, fc.state, fc.positive, fc.positiveincrease, fc.negative, fc.death,
         fc.deathincrease, fc.recovered, fc.hospitalized, fc.hospitalizedcurrently,
         fc.hospitalizedincrease"""),
}


def with_feeds(select: str) -> str:
    return "WITH " + FEEDS.strip() + "\n" + select


def _ncols(table: str) -> str:
    return (f"(SELECT CAST(count(*) AS INTEGER) FROM information_schema.columns "
            f"WHERE table_name = '{table}')")


def _profile(pairs: list[tuple[str, str]]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{label}' AS table_name, {_ncols(src)} AS n_columns, count(*) AS n_rows FROM {src}"
        for label, src in pairs)


# The declared columns of each table: name, whether NULL is barred, longest text.
_DECLARED = {
    "dim_date": (
        "date_id, date not_null, day_name not_null 9, day_of_week not_null, day not_null, "
        "day_of_year not_null, month not_null, month_name not_null 10, week not_null, "
        "quarter not_null, year not_null, year_half not_null, is_weekend not_null"),
    "dim_hospital": (
        "hosp_sk, fips not_null 6, state_fips not_null 2, county_fips not_null 3, "
        "state_name not_null 30, county_name 120, hospital_name not_null, hq_address 150, "
        "hq_city 150, hq_state 2, hq_zip_code 5, hospital_type 150, latitude, longtitude"),
    "dim_region": (
        "region_sk, fips not_null 6, state_fips not_null 2, county_fips not_null 3, "
        "state not_null 30, county 120, country 20, latitude, longitude"),
    "fact_covid": (
        "date, state_fips not_null 3, state not_null 30, positive, positiveincrease, "
        "negative, death, deathincrease, recovered, hospitalized, hospitalizedcurrently, "
        "hospitalizeddischarged, hospitalizedcumulative, hospitalizedincrease, region_sk, "
        "hosp_sk"),
}


def _column_checks() -> str:
    parts = []
    for table, columns in _DECLARED.items():
        for words in (c.split() for c in columns.split(", ")):
            name, bars_null = words[0], "not_null" in words
            longest = words[-1] if words[-1].isdigit() else None
            n_null = f'count(*) FILTER (WHERE "{name}" IS NULL)' if bars_null else "count(*) FILTER (WHERE false)"
            too = lambda size: (f'count(*) FILTER (WHERE {size}(CAST("{name}" AS VARCHAR)) > {longest})'
                                if longest else "count(*) FILTER (WHERE false)")
            parts.append(f"SELECT '{table}' AS table_name, '{name}' AS column_name, "
                         f"CAST({n_null} AS BIGINT) AS n_null, CAST({too('strlen')} AS BIGINT) AS n_too_long, "
                         f"CAST({too('length')} AS BIGINT) AS n_too_many_chars "
                         f"FROM {table}")
    return "\nUNION ALL\n".join(parts)


_SPLIT = "string_split(url, '/')"
_FEED_FIPS5 = _zfill("fips", 5)

# The column-list DDL each star table must have.
_DDL = {
    "fact_covid": "date INT, state_fips STRING, state STRING, positive DOUBLE, positiveincrease INT, "
                  "negative DOUBLE, death DOUBLE, deathincrease INT, recovered DOUBLE, "
                  "hospitalized DOUBLE, hospitalizedcurrently DOUBLE, hospitalizeddischarged DOUBLE, "
                  "hospitalizedcumulative DOUBLE, hospitalizedincrease INT, region_sk INT, hosp_sk INT",
    "dim_date": "date_id INT, date DATE, day_name STRING, day_of_week INT, day INT, day_of_year INT, "
                "month INT, month_name STRING, week INT, quarter INT, year INT, year_half INT, "
                "is_weekend BOOLEAN",
    "dim_hospital": "hosp_sk INT, fips STRING, state_fips STRING, county_fips STRING, "
                    "state_name STRING, county_name STRING, hospital_name STRING, hq_address STRING, "
                    "hq_city STRING, hq_state STRING, hq_zip_code STRING, hospital_type STRING, "
                    "latitude DOUBLE, longtitude DOUBLE",
    "dim_region": "region_sk INT, fips STRING, state_fips STRING, county_fips STRING, state STRING, "
                  "county STRING, country STRING, latitude DOUBLE, longitude DOUBLE",
}

# The published columns of each mart.
_MARTS = {
    "state_totals": "state,state_abv,total_positive_cases,total_deaths,avg_hospitalized",
    "us_totals": "postive_cases,deaths,begin_data,end_data",
    "state_daily": "date,state,state_abv,positive,pos_increase,negative,deaths,death_increase,recovered,"
                   "hospitalized,hosp_currently,hosp_increase,lattitude,longitude",
}

SQL.update({
    # sources
    "scan_csv": "SELECT * FROM orders",
    "scan_geojson": with_feeds("SELECT *, longtitude AS lon, latitude AS lat FROM hospital_feed"),
    "scan_feature_collection": with_feeds(
        "SELECT *, longtitude AS lon, latitude AS lat FROM hospital_feed"),
    "mart_views": SQL["state_totals"],
    "mart_view_us_totals": SQL["us_totals"],
    "mart_view_state_daily": SQL["state_daily"],
    "register_csv": """
SELECT 'csv_customer' AS table_name, 3 AS n_columns, count(*) AS n_rows,
       'int,string,double' AS column_types FROM customer
UNION ALL
SELECT 'csv_supplier', 2, count(*), 'int,string' FROM supplier""",
    "evolve_csv": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN year(o_orderdate) < 1994 THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders""",
    "register_tables": _profile([("src_region", "region"), ("src_nation", "nation"),
                                 ("src_customer", "customer"), ("src_supplier", "supplier"),
                                 ("src_orders", "orders"), ("src_lineitem", "lineitem")]),
    "list_tables": _profile([("lst_customer", "customer"), ("lst_orders", "orders"),
                             ("lst_part", "part"), ("lst_supplier", "supplier")]),
    "table_scan": "SELECT * FROM lineitem",
    "schema_evolve": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN NULL ELSE o_orderpriority END
         AS o_orderpriority
FROM orders""",
    "landing_path": f"""
SELECT page_id, url,
       CASE WHEN len({_SPLIT}) > 5 THEN {_SPLIT}[4] || '/' || {_SPLIT}[-2] || '/'
            ELSE {_SPLIT}[4] || '/' END AS folder,
       {_SPLIT}[-1] AS file_name
FROM pages""",
    # projections
    "project_cols": "SELECT c_nationkey, c_custkey, c_mktsegment FROM customer",
    "drop_copy_col": "SELECT c_custkey, c_name, c_acctbal, c_mktsegment, c_nationkey AS state_key "
                     "FROM customer",
    "rename_positional": "SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, "
                         "c_acctbal AS balance, c_mktsegment AS segment FROM customer",
    "preview_head": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
    "promote_header": "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, "
                      "CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer",
    # filters / nulls
    "filter_null_safe_ne": with_feeds(
        "SELECT * FROM feed WHERE province_state IS DISTINCT FROM 'MACHINERY'"),
    "dropna_subset": with_feeds(
        "SELECT * FROM feed WHERE fips IS NOT NULL AND province_state IS NOT NULL"),
    "recode_state": with_feeds(f"""
SELECT {_FEED_FIPS5} AS fips,
       CASE WHEN left({_FEED_FIPS5}, 2) = '00' THEN '72' ELSE left({_FEED_FIPS5}, 2) END AS state_fips
FROM feed WHERE fips IS NOT NULL"""),
    "fill_zero": with_feeds("""
SELECT coalesce(fips, 0) AS fips, coalesce(date, 0) AS date, state,
       coalesce(positive, 0) AS positive, coalesce(negative, 0) AS negative,
       coalesce(hospitalized, 0) AS hospitalized,
       coalesce(hospitalizedcurrently, 0) AS hospitalizedcurrently,
       coalesce(hospitalizeddischarged, 0) AS hospitalizeddischarged,
       coalesce(hospitalizedcumulative, 0) AS hospitalizedcumulative,
       coalesce(death, 0) AS death, coalesce(recovered, 0) AS recovered,
       coalesce(deathincrease, 0) AS deathincrease,
       coalesce(hospitalizedincrease, 0) AS hospitalizedincrease,
       coalesce(positiveincrease, 0) AS positiveincrease
FROM daily"""),
    # scalar functions
    "code_pad": f"""
SELECT c_custkey, {_zfill('c_custkey', 5)} AS key5, {_zfill('c_nationkey', 2)} AS nation2,
       {_zfill('c_acctbal', 6)} AS balance6
FROM customer""",
    "code_split": with_feeds(f"""
SELECT {_FEED_FIPS5} AS fips, left({_FEED_FIPS5}, 2) AS state_fips,
       right({_FEED_FIPS5}, 3) AS county_fips, left(province_state, 2) AS place_head,
       right(province_state, 3) AS place_tail
FROM feed WHERE fips IS NOT NULL"""),
    # aggregation / joins / keys / sort
    "distinct_rows": with_feeds("SELECT DISTINCT fips, county FROM county_feed"),
    "join_m2m_dedup": """
SELECT DISTINCT a.o_custkey, a.o_orderstatus, b.o_orderpriority
FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey""",
    "first_per_group": with_star("SELECT * FROM region_first"),
    "surrogate_key": """
SELECT CAST(row_number() OVER (ORDER BY c_nationkey NULLS LAST, c_mktsegment NULLS LAST,
                                        c_acctbal NULLS LAST, c_custkey NULLS LAST) AS BIGINT)
         AS customer_sk, *
FROM customer""",
    "surrogate_key_append": """
WITH s AS (SELECT s_suppkey AS party_key, s_name AS name, s_nationkey AS nation FROM supplier),
c AS (SELECT c_custkey AS party_key, c_name AS name, c_nationkey AS nation FROM customer),
e AS (SELECT CAST(row_number() OVER (ORDER BY nation, name, party_key) AS BIGINT) AS party_sk, *
      FROM s)
SELECT party_sk, party_key, name, nation FROM e
UNION ALL
SELECT CAST((SELECT max(party_sk) FROM e) + row_number() OVER (ORDER BY nation, name, party_key)
            AS BIGINT) AS party_sk, party_key, name, nation
FROM c""",
    "copy_key": """
SELECT CAST(row_number() OVER (ORDER BY v) AS BIGINT) AS copy_sk, v
FROM (SELECT CASE WHEN l_quantity % 5 < 2 THEN 'copy'
                  ELSE l_orderkey || '-' || l_linenumber || '-' || l_partkey END AS v FROM lineitem)""",
    "line_key": """
SELECT CAST(row_number() OVER (ORDER BY l_shipdate NULLS LAST, l_orderkey NULLS LAST,
    l_linenumber NULLS LAST, l_partkey NULLS LAST, l_suppkey NULLS LAST, l_quantity NULLS LAST,
    l_extendedprice NULLS LAST, l_discount NULLS LAST, l_tax NULLS LAST, l_returnflag NULLS LAST,
    l_linestatus NULLS LAST) AS BIGINT) AS line_sk, *
FROM lineitem""",
    "sort_multi": """
SELECT CAST(row_number() OVER (ORDER BY o_orderdate DESC NULLS LAST, o_totalprice ASC NULLS LAST,
                                        o_orderkey ASC NULLS LAST) AS BIGINT) AS pos, *
FROM orders""",
    # constraint reports
    "check_pk": with_star("""
SELECT 'dim_region_natural' AS check_name, state_fips || '|' || county_fips AS key_value,
       count(*) AS n_rows
FROM dim_region GROUP BY state_fips, county_fips HAVING count(*) > 1
UNION ALL
SELECT 'dim_region_pk', CAST(region_sk AS VARCHAR), count(*)
FROM dim_region GROUP BY region_sk HAVING count(*) > 1
UNION ALL
SELECT 'fact_covid_pk', CAST(date AS VARCHAR) || '|' || state_fips, count(*)
FROM fact_covid GROUP BY date, state_fips HAVING count(*) > 1"""),
    "check_fk": with_star(f"""
SELECT 'fact_covid' AS child_table, 'date' AS fk_column, 'dim_date' AS parent_table,
       count(*) AS n_orphans
FROM fact_covid f WHERE f.date IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.date_id = f.date)
UNION ALL
SELECT 'fact_covid', 'region_sk', 'dim_region', count(*)
FROM fact_covid f WHERE f.region_sk IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM dim_region r WHERE r.region_sk = f.region_sk)
UNION ALL
SELECT 'fact_covid', 'hosp_sk', 'dim_hospital', count(*)
FROM fact_covid f WHERE f.hosp_sk IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM dim_hospital h WHERE h.hosp_sk = f.hosp_sk)
UNION ALL
SELECT 'daily', 'state_fips', 'dim_region', count(*)
FROM daily y WHERE y.fips IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM dim_region r WHERE r.state_fips = {_zfill('y.fips', 2)})"""),
    "check_not_null_len": with_star(_column_checks()),
    # sinks
    "write_csv": with_star("SELECT * FROM fact_covid"),
    "load_warehouse": with_star("SELECT * FROM dim_region"),
    "load_hospital": with_star("SELECT * FROM dim_hospital"),
    "write_sorted_dim": with_star("SELECT * FROM dim_region"),
    "extract_state_daily": SQL["state_daily"],
    "extract_us_totals": SQL["us_totals"],
    "write_sorted": with_star("SELECT * FROM fact_covid"),
    "stream_load_fact": with_star("SELECT * FROM fact_covid"),
    "extract_csv": SQL["state_totals"],
    "create_tables": with_star("\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, {len(columns.split(', '))} AS n_columns, count(*) AS n_rows "
        f"FROM {name}" for name, columns in _DECLARED.items())),
    "schema_ddl": with_star("\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, '{ddl}' AS ddl, count(*) AS n_rows FROM {name}"
        for name, ddl in _DDL.items())),
    "evolve_csv_files": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders""",
    "scan_feature_ranges": with_feeds("SELECT *, longtitude AS lon, latitude AS lat FROM hospital_feed"),
    "register_geojson": with_feeds(
        "SELECT * REPLACE (CAST(hq_zip_code AS BIGINT) AS hq_zip_code), longtitude AS lon, latitude AS lat "
        "FROM hospital_feed"),
    "recrawl": """
WITH o AS (SELECT count(*) AS n FROM orders), c AS (SELECT count(*) AS n FROM customer)
SELECT 'orders' AS table_name, x.column_name, x.status, o.n AS n_rows
FROM o, (VALUES ('', 'updated'), ('o_orderkey', 'unchanged'), ('o_custkey', 'unchanged'),
                ('o_orderstatus', 'deprecated'), ('o_totalprice', 'unchanged'),
                ('o_orderdate', 'unchanged'), ('o_orderpriority', 'added')) x(column_name, status)
UNION ALL
SELECT 'customer', x.column_name, 'unchanged', c.n
FROM c, (VALUES (''), ('c_custkey'), ('c_name'), ('c_nationkey'), ('c_acctbal'), ('c_mktsegment')) x(column_name)
UNION ALL SELECT 'supplier', '', 'deprecated', NULL""",
    "surrogate_key_reserved": """
WITH s AS (SELECT s_suppkey AS party_key, s_name AS name, s_nationkey AS nation FROM supplier),
c AS (SELECT c_custkey AS party_key, c_name AS name, c_nationkey AS nation FROM customer),
e AS (SELECT CAST(row_number() OVER (ORDER BY nation, name, party_key) AS BIGINT) AS party_sk, * FROM s)
SELECT party_sk, party_key, name, nation FROM e
UNION ALL
SELECT CAST((SELECT count(*) FROM s) + row_number() OVER (ORDER BY nation >= 12, nation, name, party_key) AS BIGINT),
       party_key, name, nation
FROM c""",
    "extract_manifest": "\nUNION ALL\n".join(
        f"SELECT '{mart}' AS mart, '{columns}' AS columns, count(*) AS n_rows, count(*) AS n_file_rows FROM ({SQL[mart]})"
        for mart, columns in _MARTS.items()),
    "delta_state_totals": SQL["state_totals"],
    "delta_us_totals": SQL["us_totals"],
    "delta_state_daily": SQL["state_daily"],
})
