"""Build and publish the warehouse from raw feed files.

This is the end-to-end job: raw CSV / GeoJSON feeds -> conformed star -> typed tables
written in sort-key order -> mart views -> CSV extracts.

Every intermediate is a DataFrame; the only things that reach the driver are the
per-partition row counts used by the surrogate keys, file names and file headers. The daily
feed and the dimensions are written once per run (below the shared checkpoint folder, freed
at the end of ``run``), then as warehouse tables, and the marts are computed from the
written tables, so a lost executor never re-runs the dimension builds and a later run in
the same session never sees an earlier run's feed.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators import checks
from starmart.plans import marts, star
from starmart.schemas import CASE_FEED, COUNTY_FEED, HOSPITALS, STATES_DAILY, WAREHOUSE
from starmart.session import delete_path, in_scope, scratch_scope, write_once
from starmart.sinks import writers
from starmart.sources import catalog, files


@dataclass(frozen=True)
class FeedPaths:
    """Locations of the raw feeds (files or folders, plain or gzip CSV, GeoJSON)."""

    case_feed: str
    county_feed: str
    states_daily: str
    hospitals: str
    state_abbreviations: str | None = None
    hospitals_multiline: bool = False


def read_feeds(spark: SparkSession, paths: FeedPaths, partitions: int | None = None) -> dict[str, DataFrame]:
    """Typed raw feeds, their columns matched by name in every file (raw files carry more
    columns than the pipeline uses, in their own order, and older files lack some).
    ``partitions`` spreads single-partition gzip input before wide work."""
    return {
        "case": files.read_csv_by_name(spark, paths.case_feed, CASE_FEED, partitions),
        "county": files.read_csv_by_name(spark, paths.county_feed, COUNTY_FEED, partitions),
        "daily": files.read_csv_by_name(spark, paths.states_daily, STATES_DAILY, partitions),
        "hospitals": files.read_geojson(spark, paths.hospitals, HOSPITALS,
                                        multiline=paths.hospitals_multiline),
    }


def register_feeds(spark: SparkSession, paths: FeedPaths, db: str) -> list[str]:
    """The raw feeds as external tables of ``db`` (metadata only); the hospital feed, which is
    GeoJSON, also as the flat view ``raw_hospitals`` over its table."""
    catalog.create_database(spark, db)
    feeds = {"case_feed": paths.case_feed, "county_feed": paths.county_feed,
             "states_daily": paths.states_daily}
    if paths.state_abbreviations:
        feeds["state_abbreviations"] = paths.state_abbreviations
    names = catalog.register_tables(spark, db, feeds, fmt="csv", prefix="raw_")
    return [*names, catalog.register_geojson(spark, db, "raw_hospitals", paths.hospitals,
                                             multiline=paths.hospitals_multiline)]


def build(feeds: Mapping[str, DataFrame], excluded_place: str | None = star.EXCLUDED_PLACE,
          with_calendar: bool = True) -> dict[str, DataFrame]:
    """Dimensions, the fact, and the daily feed they were built from.

    The dimensions and the feed's table are independent jobs and run concurrently. Without
    the calendar only the fact reads the feed, so it is not written.
    """
    with ThreadPoolExecutor(max_workers=3) as pool:
        region_f = pool.submit(in_scope(star.region_dimension), feeds["case"], feeds["county"],
                               excluded_place)
        hosp_f = pool.submit(in_scope(star.hospital_dimension), feeds["hospitals"])
        # The calendar and the fact both read the daily feed: written once for this run.
        daily_f = pool.submit(in_scope(write_once), feeds["daily"], "daily-feed") if with_calendar else None
        dim_region, dim_hospital = region_f.result(), hosp_f.result()
        daily = daily_f.result() if daily_f else feeds["daily"]
    tables = {"dim_hospital": dim_hospital, "dim_region": dim_region, "daily": daily,
              "fact_covid": star.covid_fact(daily, dim_region, dim_hospital)}
    if with_calendar:
        tables["dim_date"] = star.calendar_dimension(daily)
    return tables


def publish(spark: SparkSession, tables: Mapping[str, DataFrame], out_dir: str,
            db: str) -> dict[str, str]:
    """Write each table sorted by its sort key as a new version and put that in force.

    Surrogate keys are numbered anew by every run, so a fact of one version must never meet
    a dimension of another. The four versions are written first (independent jobs, submitted
    concurrently) and added to the catalog, where no view reads them yet; replacing the
    pointer ``db.published`` then switches all tables and marts in one catalog change. A
    failed run leaves the version in force as it was, and re-running the job does not
    duplicate rows. Earlier versions stay for readers still on them (``retire_versions``) and
    can be put back in force (``catalog.switch_version``).
    """
    catalog.create_database(spark, db, f"{out_dir}/_db")
    version = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"

    def write(spec) -> str:
        path = f"{out_dir}/{spec.name}/version={version}"
        return writers.write_sorted(tables[spec.name].select(*spec.names), path, list(spec.sort_key),
                                    tie_cols=list(spec.primary_key))

    with ThreadPoolExecutor(max_workers=len(WAREHOUSE)) as pool:
        paths = list(pool.map(in_scope(write), WAREHOUSE))
    for spec, path in zip(WAREHOUSE, paths):
        kinds = dict(tables[spec.name].dtypes)
        ddl = ", ".join(f"`{c}` {kinds[c]}" for c in spec.names)
        catalog.add_version(spark, db, spec.name, path, version, ddl, f"{out_dir}/{spec.name}")
    catalog.switch_version(spark, db, version)
    return {spec.name: catalog.version_view(spark, db, spec.name, spec.names) for spec in WAREHOUSE}


def retire_versions(spark: SparkSession, db: str, keep: int = 2) -> list[str]:
    """Forget and delete all but the newest ``keep`` versions (never the one in force)."""
    gone: set[str] = set()
    for spec in WAREHOUSE:
        for version in catalog.list_versions(spark, db, spec.name)[:-keep or None]:
            if version != catalog.published_version(spark, db):
                delete_path(spark, catalog.drop_version(spark, db, spec.name, version))
                gone.add(version)
    return sorted(gone)


def create_mart_views(spark: SparkSession, db: str) -> dict[str, DataFrame]:
    """Catalog views ``db.state_totals``, ``db.us_totals`` and ``db.state_daily`` over the
    version in force, re-evaluated on every read; returns a DataFrame of each."""
    views = {}
    for name, (query, columns) in marts.view_sql(db).items():
        spark.sql(f"CREATE OR REPLACE VIEW `{db}`.`{name}` ({', '.join(columns)}) AS {query}")
        views[name] = spark.table(f"{db}.{name}")
    return views


# Extract order per mart; only the per-state mart is bounded (one row per state and
# name) and therefore written as a single file.
EXTRACTS = {
    "state_totals": (["state_abv"], True),
    "us_totals": ([], True),
    "state_daily": (["date", "state_abv"], False),
}


def extract(views: Mapping[str, DataFrame], out_dir: str) -> dict[str, str]:
    """A new version of each mart's extract, put in force by its manifest; the version's folders."""
    paths = {}
    for name, (order, single) in EXTRACTS.items():
        manifest = writers.publish_extract(views[name], f"{out_dir}/{name}", order, single_file=single)
        paths[name] = f"{out_dir}/{name}/{manifest['version']}"
    return paths


def run(spark: SparkSession, paths: FeedPaths, out_dir: str, db: str,
        partitions: int | None = None, keep_versions: int | None = None) -> dict[str, str]:
    """Raw feeds -> published warehouse tables, mart views and CSV extracts.

    ``keep_versions``: delete all but that many of the newest versions at the end.
    """
    catalog.create_database(spark, db, f"{out_dir}/warehouse/_db")
    register_feeds(spark, paths, db)
    with scratch_scope(spark):
        tables = build(read_feeds(spark, paths, partitions))
        publish(spark, tables, f"{out_dir}/warehouse", db)
    views = create_mart_views(spark, db)
    if paths.state_abbreviations:  # lookup with its header catalogued as a data row
        state_abbreviations(spark, paths.state_abbreviations).createOrReplaceTempView("state_abv")
    extracts = extract(views, f"{out_dir}/extracts")
    if keep_versions is not None:
        retire_versions(spark, db, keep_versions)
    return extracts


def constraint_report(spark: SparkSession, db: str) -> DataFrame:
    """All declared constraints of the published tables as one violation report:
    (check, table_name, column_name, n_violations)."""
    t = {spec.name: spark.table(f"{db}.{spec.name}") for spec in WAREHOUSE}
    parts = []
    for spec in WAREHOUSE:
        dup = checks.duplicate_keys(t[spec.name], list(spec.primary_key))
        parts.append(dup.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit("primary_key").alias("check"), F.lit(spec.name).alias("table_name"),
            F.lit(",".join(spec.primary_key)).alias("column_name"), F.col("n").alias("n_violations")))
        cols = checks.column_violations(t[spec.name], spec)
        parts.append(cols.select(F.lit("not_null").alias("check"), "table_name", "column_name",
                                 F.col("n_null").alias("n_violations")))
        parts.append(cols.select(F.lit("max_length").alias("check"), "table_name", "column_name",
                                 F.col("n_too_long").alias("n_violations")))
        if spec.foreign_keys:  # all foreign keys of a table in one pass over it
            fk = checks.orphan_counts(t[spec.name], spec.name,
                                      [(c, t[parent], parent, pc) for c, parent, pc in spec.foreign_keys])
            parts.append(fk.select(F.lit("foreign_key").alias("check"),
                                   F.col("child_table").alias("table_name"),
                                   F.col("fk_column").alias("column_name"),
                                   F.col("n_orphans").alias("n_violations")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def state_abbreviations(spark: SparkSession, path: str) -> DataFrame:
    """The state-abbreviation lookup, its first line read as the header (a catalogue that
    took it for a data row is put right with ``clean.promote_header``)."""
    return files.read_csv(spark, path)


__all__ = ["FeedPaths", "build", "constraint_report", "create_mart_views", "extract", "publish",
           "read_feeds", "register_feeds", "retire_versions", "run", "state_abbreviations"]
