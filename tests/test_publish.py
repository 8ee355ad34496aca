"""Publishing: readers find one whole version after every single step, failed or not."""

import json
import os
import re

import pytest
from pyspark.sql import functions as F

from covid_fixture import make_feeds
from starmart.plans import marts, warehouse
from starmart.session import path_exists, read_text, scratch_path
from starmart.sinks import writers
from starmart.sources import catalog

MARTS = ("state_totals", "us_totals", "state_daily")


@pytest.fixture(scope="module")
def versions(spark):
    """Two versions whose region keys are numbered the other way round and whose measures differ."""
    one = warehouse.build(make_feeds(spark), with_calendar=True)
    top = one["dim_region"].agg(F.max("region_sk")).first()[0] + 1
    turned = lambda df: df.withColumn("region_sk", (F.lit(top) - F.col("region_sk")).cast("int"))
    two = {**one, "dim_region": turned(one["dim_region"]),
           "fact_covid": turned(one["fact_covid"]).withColumn("positive", F.col("positive") + 1000)}
    return one, two


def _expected(tables):
    return {"state_totals": marts.state_totals(tables["fact_covid"], tables["dim_region"]),
            "us_totals": marts.us_totals(tables["fact_covid"]),
            "state_daily": marts.state_daily(tables["fact_covid"], tables["dim_date"], tables["dim_region"])}


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_every_step_shows_one_version(spark, versions, monkeypatch):
    one, two = versions
    out, db = scratch_path(spark, "t_publish"), "t_publish"
    warehouse.publish(spark, one, out, db)
    warehouse.create_mart_views(spark, db)
    old, new = ({k: _rows(v) for k, v in _expected(t).items()} for t in versions)
    assert all(old[m] != new[m] for m in MARTS)
    seen, plain, inside = [], type(spark).sql, []

    def look():
        return {m: _rows(plain(spark, f"SELECT * FROM {db}.{m}")) for m in MARTS}

    def spy(self, *args, **kwargs):
        result = plain(self, *args, **kwargs)
        if not inside:
            inside.append(1)
            seen.append((args[0].split()[0:3], look()))
            inside.pop()
        return result

    monkeypatch.setattr(type(spark), "sql", spy)
    warehouse.publish(spark, two, out, db)
    warehouse.create_mart_views(spark, db)
    monkeypatch.undo()
    assert len(seen) > 8
    states = ["old" if s == old else "new" if s == new else "mixed" for _, s in seen]
    assert "mixed" not in states and states == sorted(states, reverse=True)   # old ones, then new ones
    switch = [step for (step, _), a, b in zip(seen[1:], states, states[1:]) if a != b]
    assert switch == [["CREATE", "OR", "REPLACE"]]
    # and back: one step
    first = catalog.list_versions(spark, db, "fact_covid")[0]
    catalog.switch_version(spark, db, first)
    assert look() == old
    assert spark.table(f"{db}.fact_covid").columns == one["fact_covid"].columns


def test_reads_scan_the_version_in_force_only(spark, versions):
    one, two = versions
    out, db = scratch_path(spark, "t_pruned"), "t_pruned"
    for tables in (one, two):
        warehouse.publish(spark, tables, out, db)
    views = warehouse.create_mart_views(spark, db)
    version = catalog.published_version(spark, db)
    for df in [*views.values(), spark.table(f"{db}.dim_region")]:
        scanned = {m for f in df.inputFiles() for m in re.findall("version=([^/]+)/", f)}
        assert scanned <= {version} or scanned == set(catalog.list_versions(spark, db, "fact_covid"))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Subquery" not in plan and f"version#" in plan     # the pointer is folded into the scan


def test_failed_publish_changes_nothing(spark, versions):
    one, two = versions
    out, db = scratch_path(spark, "t_failed"), "t_failed"
    warehouse.publish(spark, one, out, db)
    views = warehouse.create_mart_views(spark, db)
    before = {m: _rows(v) for m, v in views.items()}
    broken = {**two, "dim_date": two["dim_date"].withColumn("year", F.raise_error(F.lit("lost")).cast("int"))}
    with pytest.raises(Exception, match="lost"):
        warehouse.publish(spark, broken, out, db)
    assert {m: _rows(spark.table(f"{db}.{m}")) for m in MARTS} == before
    assert len(catalog.list_versions(spark, db, "dim_region")) == 1


def test_retired_versions_are_deleted(spark, versions):
    one, two = versions
    out, db = scratch_path(spark, "t_retire"), "t_retire"
    for tables in (one, two, one):
        warehouse.publish(spark, tables, out, db)
    first, second, third = catalog.list_versions(spark, db, "fact_covid")
    catalog.switch_version(spark, db, first)
    assert warehouse.retire_versions(spark, db, keep=1) == [second]
    assert catalog.list_versions(spark, db, "dim_date") == [first, third]
    assert path_exists(spark, f"{out}/fact_covid/version={first}")
    assert not path_exists(spark, f"{out}/fact_covid/version={second}")
    with pytest.raises(ValueError, match="in force"):
        catalog.drop_version(spark, db, "fact_covid", first)
    assert _rows(spark.table(f"{db}.fact_covid")) == _rows(one["fact_covid"])


def test_tables_of_the_earlier_layout_make_way(spark, versions):
    one, _ = versions
    db, out = "t_earlier", scratch_path(spark, "t_earlier")
    catalog.create_database(spark, db, scratch_path(spark, "t_earlier_db"))
    path = scratch_path(spark, "t_earlier_fact")
    one["fact_covid"].write.parquet(path)
    catalog.point_table(spark, db, "fact_covid", path)
    warehouse.publish(spark, one, out, db)
    assert _rows(spark.table(f"{db}.fact_covid")) == _rows(one["fact_covid"])
    assert path_exists(spark, path)


def test_extract_manifest(spark):
    path = scratch_path(spark, "t_extract")
    rows = spark.range(1000).selectExpr("id AS n", "IF(id % 7 = 0, NULL, concat('a \"b\"\\n', id)) AS s")
    first = writers.publish_extract(rows, path, ["n"], partitions=4)
    assert first["rows"] == 1000 and len(first["files"]) >= 3 and first["columns"] == ["n", "s"]
    assert all(f["rows"] > 0 and f["bytes"] > 0 for f in first["files"])
    assert writers.extract_manifest(spark, path) == json.loads(read_text(spark, f"{path}/manifest.json")) == first
    back = writers.read_extract(spark, path, "n LONG, s STRING", multi_line=True)
    assert _rows(back) == _rows(rows)
    # a failed extract leaves the one in force
    with pytest.raises(Exception, match="lost"):
        writers.publish_extract(rows.withColumn("s", F.when(F.col("n") == 999, F.raise_error(F.lit("lost")))
                                                .otherwise(F.col("s"))), path, ["n"], partitions=4)
    assert writers.extract_manifest(spark, path) == first
    second = writers.publish_extract(rows.where("n < 10"), path, ["n"], single_file=True)
    assert second["rows"] == 10 and len(second["files"]) == 1 and second["version"] != first["version"]
    assert writers.read_extract(spark, path, "n LONG, s STRING", multi_line=True).count() == 10
    assert path_exists(spark, f"{path}/{first['version']}")              # for readers still on it
    none = writers.publish_extract(rows.where("n < 0"), path, ["n"], single_file=True)
    assert none["rows"] == 0 and writers.read_extract(spark, path, "n LONG, s STRING").count() == 0


def test_extract_that_lost_rows_is_refused(spark, monkeypatch):
    path = scratch_path(spark, "t_short")
    rows = spark.range(100).selectExpr("id AS n")
    writers.publish_extract(rows, path, ["n"])
    before = writers.extract_manifest(spark, path)
    whole = writers.extract_csv

    def short(df, folder, *args):
        whole(df, folder, *args)
        name = sorted(n for n in os.listdir(folder.replace("file:", "")) if n.startswith("part-"))[0]
        os.remove(os.path.join(folder.replace("file:", ""), name))
        return folder

    monkeypatch.setattr(writers, "extract_csv", short)
    with pytest.raises(RuntimeError, match="were computed"):
        writers.publish_extract(rows, path, ["n"], partitions=4)
    assert writers.extract_manifest(spark, path) == before
