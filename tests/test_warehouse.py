"""The end-to-end job from raw files: gzip CSV with extra columns in their own order,
a GeoJSON FeatureCollection, typed sorted tables, mart views, extracts, constraints."""

import csv
import glob
import json
import os

from pyspark.sql import functions as F

from covid_fixture import make_feeds
from starmart.plans import warehouse
from starmart.session import scratch_path
from starmart.sinks import writers
from starmart.sources import catalog


def _local(p):
    return p.replace("file:", "")


def test_run_from_raw_files(spark):
    feeds = make_feeds(spark)
    base = scratch_path(spark, "t_raw")
    # the case feed has extra columns and another column order; it lands gzip-compressed
    case = feeds["case"].withColumn("last_update", F.lit("2020-01-13")) \
        .select("last_update", "longitude", "latitude", "country_region", "province_state", "fips")
    writers.write_csv(case.coalesce(1), f"{base}/case", compression="gzip")
    writers.write_csv(feeds["county"], f"{base}/county")
    writers.write_csv(feeds["daily"], f"{base}/daily")
    hosp_dir = _local(f"{base}/hosp")
    os.makedirs(hosp_dir)
    features = [{"type": "Feature",
                 "properties": {k: v for k, v in r.asDict().items()},
                 "geometry": {"type": "Point", "coordinates": [r.longtitude, r.latitude]}}
                for r in feeds["hospitals"].collect()]
    with open(os.path.join(hosp_dir, "beds.geojson"), "w") as fh:
        json.dump({"type": "FeatureCollection", "features": features}, fh)

    abv_dir = _local(f"{base}/abv")
    os.makedirs(abv_dir)
    with open(os.path.join(abv_dir, "states_abv.csv"), "w") as fh:
        fh.write("State,Abbreviation\nAlabama,AL\nCalifornia,CA\n")
    paths = warehouse.FeedPaths(case_feed=f"{base}/case", county_feed=f"{base}/county",
                                states_daily=f"{base}/daily", hospitals=f"{base}/hosp",
                                state_abbreviations=f"{base}/abv", hospitals_multiline=True)
    out = scratch_path(spark, "t_out")
    extracts = warehouse.run(spark, paths, out, db="t_dw", partitions=4)

    assert sorted(r.Abbreviation for r in spark.table("state_abv").collect()) == ["AL", "CA"]
    totals = {r.state_abv: r for r in spark.table("t_dw.state_totals").collect()}
    assert totals["AL"].total_positive_cases == 25.0
    us = spark.table("t_dw.us_totals").first()
    assert spark.table("t_dw.raw_case_feed").columns[0] == "last_update"  # the raw feeds are catalogued
    assert spark.table("t_dw.state_daily").count() == 4
    assert (us.begin_data, us.end_data) == (20200113, 20200115)

    part = [p for p in glob.glob(os.path.join(_local(extracts["state_totals"]), "part-*"))
            if not p.endswith(".crc")]
    assert len(part) == 1
    with open(part[0], newline="") as fh:
        rows = list(csv.reader(fh))
    assert rows[0] == ["state", "state_abv", "total_positive_cases", "total_deaths", "avg_hospitalized"]
    assert [r[1] for r in rows[1:]] == ["AL", "CA"]  # ordered by abbreviation
    assert rows[2][0] == ""  # NULL written as empty text

    report = {(r.check, r.table_name, r.column_name): r.n_violations
              for r in warehouse.constraint_report(spark, "t_dw").collect()}
    assert report[("primary_key", "fact_covid", "date,state_fips")] == 0
    assert report[("foreign_key", "fact_covid", "region_sk")] == 0
    assert report[("not_null", "dim_region", "state")] == 1  # the NULL place is kept


def test_state_abbreviations_header_row(spark):
    path = _local(scratch_path(spark, "t_abv"))
    os.makedirs(path)
    with open(os.path.join(path, "states_abv.csv"), "w") as fh:
        fh.write("State,Abbreviation\nAlabama,AL\nAlaska,AK\n")
    df = warehouse.state_abbreviations(spark, path)
    assert df.columns == ["State", "Abbreviation"]
    assert sorted(r.Abbreviation for r in df.collect()) == ["AK", "AL"]


def test_second_run_reads_new_files(spark):
    """A second run in the same session publishes the files that landed in between."""
    feeds = make_feeds(spark)
    base = scratch_path(spark, "t_again")
    writers.write_csv(feeds["case"], f"{base}/case")
    writers.write_csv(feeds["county"], f"{base}/county")
    from starmart.sources import files
    files.to_geojson_lines(feeds["hospitals"], "longtitude", "latitude").write.text(f"{base}/hosp")
    paths = warehouse.FeedPaths(f"{base}/case", f"{base}/county", f"{base}/daily/*", f"{base}/hosp")
    days = feeds["daily"].where("state = 'AL'")
    writers.write_csv(days.where("date = 20200113"), f"{base}/daily/one")
    out = scratch_path(spark, "t_again_out")
    warehouse.run(spark, paths, out, db="t_again_dw")
    assert tuple(spark.table("t_again_dw.us_totals").first()) == (10.0, 1.0, 20200113, 20200113)
    writers.write_csv(days.where("date = 20200114"), f"{base}/daily/two")
    warehouse.run(spark, paths, out, db="t_again_dw", keep_versions=1)
    assert tuple(spark.table("t_again_dw.us_totals").first()) == (25.0, 3.0, 20200113, 20200114)
    assert len(catalog.list_versions(spark, "t_again_dw", "fact_covid")) == 1
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_command_line(spark, capsys):
    from starmart.__main__ import main

    feeds = make_feeds(spark)
    base = scratch_path(spark, "t_cli")
    writers.write_csv(feeds["case"], f"{base}/case")
    writers.write_csv(feeds["county"], f"{base}/county")
    writers.write_csv(feeds["daily"], f"{base}/daily")
    from starmart.sources import files
    files.to_geojson_lines(feeds["hospitals"], "longtitude", "latitude").write.text(f"{base}/hosp")
    writers.write_csv(spark.createDataFrame([("Alabama", "AL")], "State string, Abbreviation string"),
                      f"{base}/abv")
    out = scratch_path(spark, "t_cli_out")
    rc = main(["--case", f"{base}/case", "--county", f"{base}/county", "--daily", f"{base}/daily",
               "--hospitals", f"{base}/hosp", "--state-abbreviations", f"{base}/abv",
               "--out", out, "--db", "t_cli_dw", "--keep-versions", "2"], spark=spark)
    assert rc == 0
    assert spark.table("state_abv").first().Abbreviation == "AL"
    result = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(result["extracts"]) == {"state_totals", "us_totals", "state_daily"}
    assert {"check": "not_null", "table_name": "dim_region", "column_name": "state",
            "n_violations": 1} in result["violations"]
