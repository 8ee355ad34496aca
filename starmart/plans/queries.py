"""Registry of the queries run against the driver's tables: name -> (spark, sf_dir) -> DataFrame.

Every query reads whole driver tables (or data Spark derives from them). Queries for
sources and sinks write below the shared scratch folder (``session.scratch_path``) and
return what Spark reads back, so the round trip itself is what gets checked.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.codes import left_chars, recode, right_chars, zfill_code
from starmart.operators import checks, clean
from starmart.operators.joins import first_per_group, join_distinct
from starmart.operators.keys import KeyLedger, append_with_keys, dense_key
from starmart.plans import analogue, covid, marts, star, warehouse
from starmart.schemas import (DIM_DATE, DIM_HOSPITAL, DIM_REGION, FACT_COVID, HOSPITALS, WAREHOUSE)
from starmart.session import delete_path, scratch_path
from starmart.sources.files import CSV_DIALECT
from starmart.sinks import writers
from starmart.sources import catalog, files

QueryFn = Callable[[SparkSession, str], DataFrame]

_T = analogue.table

# ---------------------------------------------------------------------------
# Sources
# ---------------------------------------------------------------------------


def q_scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> gzip CSV and plain CSV -> typed reads, unioned (each row once per format)."""
    orders = _T(spark, sf_dir, "orders")
    base = scratch_path(spark, "scan_csv")
    writers.write_csv(orders.where(F.col("o_orderstatus") != "F"), f"{base}/plain")
    writers.write_csv(orders.where(F.col("o_orderstatus") == "F"), f"{base}/gzip", compression="gzip")
    plain = files.read_csv(spark, f"{base}/plain", schema=orders.schema)
    gz = files.read_csv(spark, f"{base}/gzip", schema=orders.schema,
                        partitions=spark.sparkContext.defaultParallelism)
    return plain.unionByName(gz)


def q_scan_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hospital features -> line-delimited GeoJSON -> flattened properties and position."""
    feed = analogue.hospital_feed(spark, sf_dir)
    path = scratch_path(spark, "scan_geojson")
    files.to_geojson_lines(feed, "longtitude", "latitude").write.mode("overwrite").text(path)
    return files.read_geojson(spark, path, HOSPITALS)


def q_scan_feature_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hospital features -> FeatureCollection documents of some hundred features -> flat rows."""
    feed = analogue.hospital_feed(spark, sf_dir)
    path = files.write_feature_collections(feed, scratch_path(spark, "scan_collection"), "longtitude",
                                           "latitude", F.floor(F.col("hq_zip_code") / 200).cast("int"))
    return files.read_geojson(spark, f"{path}/part=*", HOSPITALS, multiline=True)


def _register_driver_tables(spark: SparkSession, sf_dir: str, names: list[str], prefix: str):
    db = "starmart_raw"
    catalog.create_database(spark, db, scratch_path(spark, "db"))
    sources = {n: f"{sf_dir.rstrip('/')}/{n}.parquet" for n in names}
    return db, catalog.register_tables(spark, db, sources, prefix=prefix)


def q_register_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue driver files as external tables (no copy), profile them from the catalog.

    One entry names a single path; the other lists several paths, registered as one
    table per path, named after the file."""
    db = "starmart_raw"
    catalog.create_database(spark, db, scratch_path(spark, "db"))
    base = sf_dir.rstrip("/")
    tables = catalog.register_tables(
        spark, db,
        {"region": f"{base}/region.parquet",
         "static": [f"{base}/{n}.parquet" for n in ("nation", "customer", "supplier",
                                                    "orders", "lineitem")]},
        prefix="src_")
    return catalog.table_profile(spark, tables)


def q_list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List the catalogued tables matching a pattern, with column and row counts."""
    db, _ = _register_driver_tables(spark, sf_dir, ["customer", "orders", "supplier", "part"],
                                    prefix="lst_")
    listed = catalog.list_tables(spark, db, "lst_*")
    return catalog.table_profile(spark, [f"{db}.{t}" for t in listed])


def q_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``SELECT *`` of a catalogued table, read through the catalog."""
    _, tables = _register_driver_tables(spark, sf_dir, ["lineitem"], prefix="scan_")
    return spark.table(tables[0])


SCHEMA_CHANGE_DAY = "1998-01-01"


def q_schema_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older batches lack ``o_orderpriority``; the merged read fills it with NULL."""
    orders = _T(spark, sf_dir, "orders")
    base = scratch_path(spark, "schema_evolve")
    old = orders.where(F.col("o_orderdate") < F.lit(SCHEMA_CHANGE_DAY).cast("timestamp_ntz"))
    new = orders.where(F.col("o_orderdate") >= F.lit(SCHEMA_CHANGE_DAY).cast("timestamp_ntz"))
    old.drop("o_orderpriority").write.mode("overwrite").parquet(f"{base}/batch_1")
    new.write.mode("overwrite").parquet(f"{base}/batch_2")
    return catalog.read_evolving(spark, [f"{base}/batch_1", f"{base}/batch_2"])


def q_evolve_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV batches of three layouts (one without the priority, one in another column order),
    read as one table by column name; the priority of the oldest is NULL."""
    orders = _T(spark, sf_dir, "orders")
    base = scratch_path(spark, "evolve_csv")
    year = F.year("o_orderdate")
    writers.write_csv(orders.where(year < 1994).drop("o_orderpriority"), f"{base}/batch_1")
    writers.write_csv(orders.where((year >= 1994) & (year < 1996)), f"{base}/batch_2")
    writers.write_csv(orders.where(year >= 1996).select(*reversed(orders.columns)), f"{base}/batch_3")
    return files.read_csv_by_name(spark, [f"{base}/batch_{i}" for i in (1, 2, 3)], orders.schema)


def q_register_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headered CSV folders catalogued as external tables with inferred types; one profiled
    row per table, with its column types."""
    db = "starmart_raw"
    catalog.create_database(spark, db, scratch_path(spark, "db"))
    base = scratch_path(spark, "register_csv")
    feeds = {"customer": ["c_custkey", "c_name", "c_acctbal"], "supplier": ["s_suppkey", "s_name"]}
    for name, columns in feeds.items():
        writers.write_csv(_T(spark, sf_dir, name).select(*columns), f"{base}/{name}")
    tables = catalog.register_tables(spark, db, {n: f"{base}/{n}" for n in feeds}, fmt="csv",
                                     prefix="csv_", options={"inferSchema": "true"})
    types = {t.split(".")[-1]: ",".join(k for _, k in spark.table(t).dtypes) for t in tables}
    kinds = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    return catalog.table_profile(spark, tables).withColumn("column_types", kinds[F.col("table_name")])


def q_evolve_csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSV file per order day and status, in three layouts by status, read by column name: some
    thousand files with the same number of jobs as a few."""
    orders = _T(spark, sf_dir, "orders")
    base = scratch_path(spark, "evolve_csv_files")
    month = F.date_format("o_orderdate", "yyyyMM")
    layouts = {"F": orders.columns, "O": orders.columns[::-1],
               "P": [c for c in orders.columns if c != "o_orderpriority"]}
    for status, columns in layouts.items():
        (orders.where(F.col("o_orderstatus") == status).select(*columns, month.alias("month")).repartition("month")
               .write.options(**CSV_DIALECT).option("header", True).partitionBy("month").csv(f"{base}/{status}"))
    return files.read_csv_by_name(spark, [f"{base}/{s}/month=*" for s in layouts], orders.schema)


def q_scan_feature_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hospital features -> one FeatureCollection document -> read by byte ranges."""
    feed = analogue.hospital_feed(spark, sf_dir)
    path = files.write_feature_collection(feed, scratch_path(spark, "scan_ranges"), "longtitude", "latitude")
    return files.read_geojson(spark, path, HOSPITALS, multiline=True)


def q_register_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hospital feed catalogued as a GeoJSON table with a flat view, its schema inferred; read
    through the catalog."""
    feed = analogue.hospital_feed(spark, sf_dir)
    path = files.write_feature_collection(feed, scratch_path(spark, "register_geojson"), "longtitude", "latitude")
    db = "starmart_raw"
    catalog.create_database(spark, db, scratch_path(spark, "db"))
    return spark.table(catalog.register_geojson(spark, db, "hospital_beds", path, multiline=True))


def q_recrawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second crawl of three tables: one whose new batch has a column more and lacks one, one that
    is as it was, one whose files are gone; with the rows that the catalog reads now."""
    db, base = "starmart_crawl", scratch_path(spark, "recrawl")
    catalog.create_database(spark, db, scratch_path(spark, "db"))
    orders, customer = _T(spark, sf_dir, "orders"), _T(spark, sf_dir, "customer")
    orders.drop("o_orderpriority").write.parquet(f"{base}/orders/batch_1")
    customer.write.parquet(f"{base}/customer")
    _T(spark, sf_dir, "supplier").write.parquet(f"{base}/supplier")
    tag = scratch_path(spark, "crawl").rsplit("-", 1)[1]
    sources = {"orders": f"{base}/orders/*", "customer": f"{base}/customer", "supplier": f"{base}/supplier"}
    catalog.crawl(spark, db, sources, prefix=f"t{tag}_", crawler=tag)
    orders.drop("o_orderstatus").write.parquet(f"{base}/orders/batch_2")
    delete_path(spark, f"{base}/orders/batch_1")
    delete_path(spark, f"{base}/supplier")
    report = catalog.crawl(spark, db, sources, prefix=f"t{tag}_", crawler=tag)
    rows = catalog.table_profile(spark, [f"{db}.t{tag}_{n}" for n in ("orders", "customer")])
    named = lambda c: F.regexp_replace(c, "^t[^_]*_", "")
    counted = rows.select(named("table_name").alias("table_name"), "n_rows")
    return (report.withColumn("table_name", named("table_name")).join(counted, "table_name", "left")
            .select("table_name", F.coalesce("column_name", F.lit("")).alias("column_name"), "status", "n_rows"))


def q_landing_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing folder and file name of every page URL (deep-path threshold 5)."""
    pages = _T(spark, sf_dir, "pages").select("page_id", "url")
    folder, file_name = files.landing_path("url", deep_parts=5)
    return pages.select("page_id", "url", folder.alias("folder"), file_name.alias("file_name"))


# ---------------------------------------------------------------------------
# Projections
# ---------------------------------------------------------------------------


def q_project_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column subset in a new order."""
    return clean.project(_T(spark, sf_dir, "customer"), ["c_nationkey", "c_custkey", "c_mktsegment"])


def q_drop_copy_col(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copy the nation key to a new name and drop the source column."""
    c = _T(spark, sf_dir, "customer")
    return clean.copy_column(c, "c_nationkey", "state_key", drop_src=True)


def q_rename_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rename one column by name, then all of them by position."""
    c = clean.rename(_T(spark, sf_dir, "customer"), {"c_mktsegment": "segment"})
    return clean.rename_positional(c, ["id", "name", "nation", "balance", "segment"])


def q_preview_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First five orders by key (a distributed top-k)."""
    return clean.preview(_T(spark, sf_dir, "orders"), ["o_orderkey"], n=5)


_HEADER = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]


def q_promote_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A header catalogued as a data row: names live in one row of generic columns."""
    c = _T(spark, sf_dir, "customer")
    body = c.select(*[F.col(n).cast("string").alias(f"col{i}") for i, n in enumerate(_HEADER)])
    head = spark.range(1).select(*[F.lit(n).alias(f"col{i}") for i, n in enumerate(_HEADER)])
    return clean.promote_header(head.unionByName(body), _HEADER)


# ---------------------------------------------------------------------------
# Filters and null handling
# ---------------------------------------------------------------------------


def q_filter_null_safe_ne(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop the excluded place, keep rows whose place is NULL."""
    feed = analogue.case_feed(spark, sf_dir)
    return clean.filter_not_equal_keep_null(feed, "province_state", analogue.ANALOGUE_EXCLUDED_PLACE)


def q_dropna_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop feed rows with a NULL code or place."""
    return clean.drop_null_rows(analogue.case_feed(spark, sf_dir), ["fips", "province_state"])


def q_recode_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded code and its state part with the 00 -> 72 recode."""
    feed = clean.drop_null_rows(analogue.case_feed(spark, sf_dir), ["fips"])
    padded = zfill_code("fips", 5)
    return feed.select(padded.alias("fips"),
                       recode(left_chars(padded, 2), star.STATE_RECODE).alias("state_fips"))


def q_fill_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily feed with NULL measures turned into 0."""
    return clean.fill_numeric_zero(analogue.states_daily(spark, sf_dir))


# ---------------------------------------------------------------------------
# Scalar code functions
# ---------------------------------------------------------------------------


def q_code_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero-padded keys, nation codes and signed balances."""
    c = _T(spark, sf_dir, "customer")
    return c.select("c_custkey",
                    zfill_code("c_custkey", 5).alias("key5"),
                    zfill_code("c_nationkey", 2).alias("nation2"),
                    zfill_code("c_acctbal", 6).alias("balance6"))


def q_code_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State / county parts of the padded code, and short-text slices."""
    feed = clean.drop_null_rows(analogue.case_feed(spark, sf_dir), ["fips"])
    padded = zfill_code("fips", 5)
    return feed.select(padded.alias("fips"),
                       left_chars(padded, 2).alias("state_fips"),
                       right_chars(padded, 3).alias("county_fips"),
                       left_chars("province_state", 2).alias("place_head"),
                       right_chars("province_state", 3).alias("place_tail"))


# ---------------------------------------------------------------------------
# Aggregation, joins, keys, sorting
# ---------------------------------------------------------------------------


def q_distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (code, county) rows of the per-county feed."""
    return clean.distinct_rows(analogue.county_feed(spark, sf_dir))


def q_join_m2m_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders self-join on the customer (many-to-many), de-duplicated."""
    o = _T(spark, sf_dir, "orders")
    return join_distinct(o.select("o_custkey", "o_orderstatus"),
                         o.select("o_custkey", "o_orderpriority"), on=["o_custkey"])


def q_first_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lowest region key per state code."""
    return first_per_group(covid.region_dim(spark, sf_dir), "state_fips", "region_sk")


def q_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense customer key by nation, segment, balance and key."""
    c = _T(spark, sf_dir, "customer")
    # c_custkey is unique, so rows cannot be copies of each other
    return dense_key(c, ["c_nationkey", "c_mktsegment", "c_acctbal", "c_custkey"], "customer_sk",
                     collapse_copies=False)


def q_surrogate_key_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers form the existing table; customers are appended with keys after its max."""
    s = _T(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"))
    c = _T(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"))
    order = ["nation", "name", "party_key"]  # party_key is unique within each table
    existing = dense_key(s, order, "party_sk", collapse_copies=False)
    appended = append_with_keys(existing, c, "party_sk", order, collapse_copies=False)
    return existing.unionByName(appended)


def q_surrogate_key_reserved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends that see the same existing table, neither the other's rows: each reserves its
    keys in the table's ledger, so they do not meet."""
    s = _T(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("name"),
                                             F.col("s_nationkey").alias("nation"))
    c = _T(spark, sf_dir, "customer").select(F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"),
                                             F.col("c_nationkey").alias("nation"))
    order = ["nation", "name", "party_key"]
    existing = dense_key(s, order, "party_sk", collapse_copies=False)
    ledger = KeyLedger(spark, scratch_path(spark, "party-keys"))
    parts = [append_with_keys(existing, c.where(half), "party_sk", order, collapse_copies=False, ledger=ledger)
             for half in ("nation < 12", "nation >= 12")]
    return existing.unionByName(parts[0]).unionByName(parts[1])


def q_line_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense key over every line item in ship order: the largest key build (600,000 rows
    at sf0.1), comparable with the survey's single-partition window measurement."""
    li = _T(spark, sf_dir, "lineitem")
    # (order, line) is not unique in this data: ties fall to the remaining columns, and no
    # column set is declared unique, so exact copies are collapsed (the default)
    return dense_key(li, ["l_shipdate", "l_orderkey", "l_linenumber"], "line_sk")


def q_copy_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense key over text rows of which two in five are copies of one row."""
    li = _T(spark, sf_dir, "lineitem")
    row = F.when(F.col("l_quantity") % 5 < 2, F.lit("copy")).otherwise(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey"))
    return dense_key(li.select(row.alias("v")), ["v"], "copy_sk")


def q_sort_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position of every order under (date DESC, price ASC, key ASC)."""
    o = _T(spark, sf_dir, "orders")
    order = [F.col("o_orderdate").desc_nulls_last(), F.col("o_totalprice").asc_nulls_last(),
             F.col("o_orderkey").asc_nulls_last()]
    return dense_key(o, order, "pos", collapse_copies=False)  # o_orderkey is unique


# ---------------------------------------------------------------------------
# Constraint reports
# ---------------------------------------------------------------------------


def q_check_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Natural key (state_fips, county_fips) of dim_region is not unique (one row per
    distinct place row); the surrogate key and the fact key are."""
    s = covid.build_star(spark, sf_dir, with_calendar=False)
    dup_natural = checks.duplicate_keys(s.dim_region, ["state_fips", "county_fips"])
    dup_sk = checks.duplicate_keys(s.dim_region, ["region_sk"])
    dup_fact = checks.duplicate_keys(s.fact_covid, list(FACT_COVID.primary_key))

    def report(df: DataFrame, name: str, key: list[str]) -> DataFrame:
        key_text = F.concat_ws("|", *[F.col(k).cast("string") for k in key])
        return df.select(F.lit(name).alias("check_name"), key_text.alias("key_value"), "n_rows")

    return (report(dup_natural, "dim_region_natural", ["state_fips", "county_fips"])
            .unionByName(report(dup_sk, "dim_region_pk", ["region_sk"]))
            .unionByName(report(dup_fact, "fact_covid_pk", list(FACT_COVID.primary_key))))


def q_check_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan counts of the fact's three foreign keys and of the daily feed's state code."""
    s = covid.build_star(spark, sf_dir)
    fact_report = checks.orphan_counts(s.fact_covid, "fact_covid", [
        ("date", s.dim_date, "dim_date", "date_id"),
        ("region_sk", s.dim_region, "dim_region", "region_sk"),
        ("hosp_sk", s.dim_hospital, "dim_hospital", "hosp_sk"),
    ])
    daily = s.daily.withColumn("state_fips", zfill_code("fips", 2))
    daily_report = checks.orphan_counts(daily, "daily", [
        ("state_fips", s.dim_region, "dim_region", "state_fips")])
    return fact_report.unionByName(daily_report)


def q_check_not_null_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NOT NULL and length violations of every declared warehouse column."""
    s = covid.build_star(spark, sf_dir)
    out = None
    for spec, df in ((DIM_DATE, s.dim_date), (DIM_HOSPITAL, s.dim_hospital),
                     (DIM_REGION, s.dim_region), (FACT_COVID, s.fact_covid)):
        rep = checks.column_violations(df, spec)
        out = rep if out is None else out.unionByName(rep)
    return out


# ---------------------------------------------------------------------------
# Sinks
# ---------------------------------------------------------------------------


def q_write_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact written as headered CSV and read back with its declared types."""
    fact = covid.fact_covid(spark, sf_dir)
    path = writers.write_csv(fact, scratch_path(spark, "fact_csv"))
    return files.read_csv(spark, path, schema=writers.spec_schema(FACT_COVID), check_header=True)


def q_load_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_region -> CSV extract -> typed table loaded by position (idempotent overwrite)."""
    dim = covid.region_dim(spark, sf_dir)
    csv_path = writers.write_csv(dim, scratch_path(spark, "dim_region_csv"))
    table = writers.create_table(spark, DIM_REGION, scratch_path(spark, "wh_dim_region"),
                                 db=_warehouse_db(spark, "starmart_load"))
    writers.load_positional(spark, table, csv_path, DIM_REGION)
    return writers.load_positional(spark, table, csv_path, DIM_REGION)  # re-run: no duplicates


def q_load_hospital(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_hospital, whose addresses hold commas and quotes, through CSV into its typed table."""
    dim = covid.hospital_dim(spark, sf_dir)
    csv_path = writers.write_csv(dim, scratch_path(spark, "dim_hospital_csv"))
    table = writers.create_table(spark, DIM_HOSPITAL, scratch_path(spark, "wh_dim_hospital"),
                                 db=_warehouse_db(spark, "starmart_load"))
    return writers.load_positional(spark, table, csv_path, DIM_HOSPITAL)


def _warehouse_db(spark: SparkSession, db: str = "starmart_dw") -> str:
    catalog.create_database(spark, db, scratch_path(spark, "dw"))
    return db


def q_write_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact written in sort-key order (range partitioned, sorted files) and read back."""
    fact = covid.fact_covid(spark, sf_dir)
    path = writers.write_sorted(fact, scratch_path(spark, "fact_sorted"), list(FACT_COVID.sort_key))
    return spark.read.parquet(path)


def q_write_sorted_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_region, which has a handful of sort values, written in order of them to 64 files:
    equal values are cut by the primary key."""
    path = writers.write_sorted(covid.region_dim(spark, sf_dir), scratch_path(spark, "region_sorted"),
                                list(DIM_REGION.sort_key), partitions=64,
                                tie_cols=list(DIM_REGION.primary_key))
    return spark.read.parquet(path)


def _extract(spark: SparkSession, mart: DataFrame, name: str, order: list[str], **layout) -> DataFrame:
    """``mart`` put in force as an extract and read back through its manifest."""
    path = scratch_path(spark, name)
    writers.publish_extract(mart, path, order, **layout)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in mart.schema.fields)
    return writers.read_extract(spark, path, schema)


def q_extract_state_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """state_daily ordered by date and state into eight or more files, each with a header."""
    return _extract(spark, covid.state_daily(spark, sf_dir), "state_daily_extract", ["date", "state_abv"],
                    partitions=8)


def q_extract_us_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-row national mart as a single file."""
    return _extract(spark, covid.us_totals(spark, sf_dir), "us_totals_extract", [], single_file=True)


def q_extract_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """state_totals ordered by state abbreviation into one quoted CSV file (bounded mart)."""
    return _extract(spark, covid.state_totals(spark, sf_dir), "state_totals_extract", ["state_abv"],
                    single_file=True)


def q_extract_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and columns of the three extracts as their manifests record them."""
    s = covid.build_star(spark, sf_dir)
    views = {"state_totals": marts.state_totals(s.fact_covid, s.dim_region), "us_totals": marts.us_totals(s.fact_covid),
             "state_daily": marts.state_daily(s.fact_covid, s.dim_date, s.dim_region)}
    base = scratch_path(spark, "extract_manifest")
    warehouse.extract(views, base)
    found = {name: writers.extract_manifest(spark, f"{base}/{name}") for name in views}
    return spark.createDataFrame(
        [(name, ",".join(m["columns"]), m["rows"], sum(f["rows"] for f in m["files"])) for name, m in found.items()],
        "mart STRING, columns STRING, n_rows LONG, n_file_rows LONG")


def _mart_view(view: str) -> QueryFn:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        s = covid.build_star(spark, sf_dir)
        tables = {"dim_date": s.dim_date, "dim_hospital": s.dim_hospital,
                  "dim_region": s.dim_region, "fact_covid": s.fact_covid}
        warehouse.publish(spark, tables, scratch_path(spark, "published"), db="starmart_pub")
        warehouse.create_mart_views(spark, db="starmart_pub")
        return spark.table(f"starmart_pub.{view}")

    query.__doc__ = f"""Publish the star as tables in sort-key order, define the mart views over
    them in the same database and read ``{view}`` back through its catalog view."""
    return query


def q_create_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create the four typed warehouse tables, load the star, profile the tables."""
    s = covid.build_star(spark, sf_dir)
    db = _warehouse_db(spark)
    frames = {"dim_date": s.dim_date, "dim_hospital": s.dim_hospital,
              "dim_region": s.dim_region, "fact_covid": s.fact_covid}
    names = [writers.create_table(spark, spec, scratch_path(spark, f"wh_{spec.name}"), db=db)
             for spec in WAREHOUSE]

    def load(item):
        spec, name = item
        frames[spec.name].select(*spec.names).write.insertInto(name, overwrite=True)

    with ThreadPoolExecutor(max_workers=len(WAREHOUSE)) as pool:  # independent loads
        list(pool.map(load, zip(WAREHOUSE, names)))
    return catalog.table_profile(spark, names)


def q_schema_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column-list DDL of each star table, with its row count."""
    s = covid.build_star(spark, sf_dir)
    out = None
    for name, df in (("fact_covid", s.fact_covid), ("dim_date", s.dim_date),
                     ("dim_hospital", s.dim_hospital), ("dim_region", s.dim_region)):
        ddl = writers.schema_ddl(df, with_nullability=False)
        part = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), F.lit(ddl).alias("ddl"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------------------
# Streaming
# ---------------------------------------------------------------------------


def _streamed(spark: SparkSession, sf_dir: str, with_store: bool = False) -> tuple[str, str | None, DataFrame]:
    """Daily files land in date order and are loaded by the streaming merge, two files per
    micro-batch; a first delivery with wrong measures is corrected by a second one, whose
    files are newer although their paths sort first. The merge is keyed, not appended.
    Returns where the fact and the stored marts are, and the region dimension."""
    from starmart.streaming import daily_load

    daily = analogue.states_daily(spark, sf_dir)
    dim_region = covid.region_dim(spark, sf_dir)
    dim_hospital = covid.hospital_dim(spark, sf_dir)
    landing = scratch_path(spark, "landing")
    target = scratch_path(spark, "fact_stream")
    checkpoint = scratch_path(spark, "fact_stream_ck")
    store = scratch_path(spark, "mart_store") if with_store else None
    wrong = daily.withColumn("positive", F.col("positive") + 1000).withColumn("death", F.lit(-1.0))
    for delivery, rows in (("first", wrong.select(*daily.columns)), ("again", daily)):
        writers.write_csv(rows.repartitionByRange(4, "date"), f"{landing}/{delivery}")
        q = daily_load.start(spark, f"{landing}/*", dim_region, dim_hospital, target, checkpoint,
                             available_now=True, max_files_per_trigger=2, store=store)
        q.awaitTermination()
    return target, store, dim_region


def q_stream_load_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after both deliveries."""
    from starmart.streaming import daily_load

    return daily_load.read_fact(spark, _streamed(spark, sf_dir)[0])


def q_delta_state_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-state mart from the partials that every batch of the stream kept up to date."""
    from starmart.streaming import mart_store

    _, store, dim_region = _streamed(spark, sf_dir, with_store=True)
    return mart_store.state_totals(spark, store, dim_region)


def q_delta_us_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The national mart from the same partials."""
    from starmart.streaming import mart_store

    return mart_store.us_totals(spark, _streamed(spark, sf_dir, with_store=True)[1])


def q_delta_state_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily mart as the batches left it."""
    from starmart.streaming import mart_store

    return mart_store.state_daily(spark, _streamed(spark, sf_dir, with_store=True)[1])


def _date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.date_bounds(analogue.states_daily(spark, sf_dir))


REGISTRY: dict[str, QueryFn] = {
    # star build and marts
    "dim_region": covid.region_dim,
    "dim_hospital": covid.hospital_dim,
    "dim_date": covid.date_dim,
    "date_bounds": _date_bounds,
    "fact_covid": covid.fact_covid,
    "state_totals": covid.state_totals,
    "us_totals": covid.us_totals,
    "state_daily": covid.state_daily,
    # sources
    "scan_csv": q_scan_csv,
    "scan_geojson": q_scan_geojson,
    "scan_feature_collection": q_scan_feature_collection,
    "register_tables": q_register_tables,
    "list_tables": q_list_tables,
    "table_scan": q_table_scan,
    "schema_evolve": q_schema_evolve,
    "evolve_csv": q_evolve_csv,
    "evolve_csv_files": q_evolve_csv_files,
    "scan_feature_ranges": q_scan_feature_ranges,
    "register_geojson": q_register_geojson,
    "recrawl": q_recrawl,
    "register_csv": q_register_csv,
    "landing_path": q_landing_path,
    # projections
    "project_cols": q_project_cols,
    "drop_copy_col": q_drop_copy_col,
    "rename_positional": q_rename_positional,
    "preview_head": q_preview_head,
    "promote_header": q_promote_header,
    # filters / nulls
    "filter_null_safe_ne": q_filter_null_safe_ne,
    "dropna_subset": q_dropna_subset,
    "recode_state": q_recode_state,
    "fill_zero": q_fill_zero,
    # scalar functions
    "code_pad": q_code_pad,
    "code_split": q_code_split,
    # aggregation / joins / keys / sort
    "distinct_rows": q_distinct_rows,
    "join_m2m_dedup": q_join_m2m_dedup,
    "first_per_group": q_first_per_group,
    "surrogate_key": q_surrogate_key,
    "surrogate_key_append": q_surrogate_key_append,
    "surrogate_key_reserved": q_surrogate_key_reserved,
    "sort_multi": q_sort_multi,
    "line_key": q_line_key,
    "copy_key": q_copy_key,
    # constraint reports
    "check_pk": q_check_pk,
    "check_fk": q_check_fk,
    "check_not_null_len": q_check_not_null_len,
    # sinks
    "write_csv": q_write_csv,
    "load_warehouse": q_load_warehouse,
    "load_hospital": q_load_hospital,
    "write_sorted": q_write_sorted,
    "write_sorted_dim": q_write_sorted_dim,
    "extract_csv": q_extract_csv,
    "extract_state_daily": q_extract_state_daily,
    "extract_us_totals": q_extract_us_totals,
    "extract_manifest": q_extract_manifest,
    "create_tables": q_create_tables,
    "mart_views": _mart_view("state_totals"),
    "mart_view_us_totals": _mart_view("us_totals"),
    "mart_view_state_daily": _mart_view("state_daily"),
    "schema_ddl": q_schema_ddl,
    # streaming
    "stream_load_fact": q_stream_load_fact,
    "delta_state_totals": q_delta_state_totals,
    "delta_us_totals": q_delta_us_totals,
    "delta_state_daily": q_delta_state_daily,
}
