import csv
import glob
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators import checks
from starmart.schemas import DIM_REGION, HOSPITALS
from starmart.session import scratch_path
from starmart.sinks import writers
from starmart.sources import catalog, files


def test_duplicate_keys_and_orphans(spark):
    child = spark.createDataFrame([(1, 10), (1, 11), (2, 99), (3, None)], "k int, fk int")
    parent = spark.createDataFrame([(10,), (11,)], "id int")
    dups = checks.duplicate_keys(child, ["k"]).collect()
    assert [(r.k, r.n_rows) for r in dups] == [(1, 2)]
    orphan_rows = checks.orphans(child, parent, "fk", "id").collect()
    assert [(r.k, r.fk) for r in orphan_rows] == [(2, 99)]  # NULL keys are not orphans
    report = checks.orphan_counts(child, "child", [("fk", parent, "parent", "id")]).first()
    assert (report.child_table, report.fk_column, report.n_orphans) == ("child", "fk", 1)


def test_column_violations(spark):
    df = spark.createDataFrame(
        [(1, "0100", "01", "001", None, "c", "US", 1.0, 2.0),
         (2, "01001", "01", "001", "Alabama", "x" * 121, "US", 1.0, 2.0)],
        ",".join(f"{c.name} {c.ddl_type}" for c in DIM_REGION.columns))
    rep = {r.column_name: (r.n_null, r.n_too_long) for r in checks.column_violations(df, DIM_REGION).collect()}
    assert rep["state"] == (1, 0)      # NOT NULL violated
    assert rep["county"] == (0, 1)     # longer than 120 characters
    assert rep["fips"] == (0, 0)


def test_extract_csv_unload_format(spark):
    df = spark.createDataFrame([("b", 'x, "y"', None, 49.0), ("a", "plain", 1.5, 6158147.0)],
                               "k string, v string, n double, total double")
    path = writers.extract_csv(df, scratch_path(spark, "t_extract"), ["k"], single_file=True)
    parts = glob.glob(os.path.join(path.replace("file:", ""), "part-*"))
    parts = [p for p in parts if not p.endswith(".crc")]
    assert len(parts) == 1
    with open(parts[0], newline="") as fh:
        lines = fh.read().splitlines()
    assert lines == ['k,v,n,total', '"a","plain","1.5","6158147"', '"b","x, ""y""","","49"']
    with open(parts[0], newline="") as fh:
        parsed = list(csv.reader(fh))
    assert parsed[2] == ["b", 'x, "y"', "", "49"]


def test_extract_keeps_order_across_files(spark):
    df = spark.range(500).selectExpr("CAST(499 - id AS INT) AS k", "id * 0.5 AS x")
    path = writers.extract_csv(df.repartition(7), scratch_path(spark, "t_extract_multi"), ["k"],
                               partitions=8)
    parts = sorted(p for p in glob.glob(os.path.join(path.replace("file:", ""), "part-*"))
                   if not p.endswith(".crc"))
    assert len(parts) == 8
    keys = []
    for f in parts:
        with open(f, newline="") as fh:
            rows = list(csv.reader(fh))
        assert rows[0] == ["k", "x"]  # every file has its header
        keys += [int(r[0]) for r in rows[1:]]
    assert keys == list(range(500))
    assert spark.read.option("header", True).csv(path).count() == 500


def test_csv_dialect_is_rfc_4180(spark):
    value = 'St. "Mary" Hospital, East'
    df = spark.createDataFrame([(1, value, "two\nlines", "back\\slash")], "k int, a string, b string, c string")
    path = writers.write_csv(df, scratch_path(spark, "t_dialect"))
    parts = [p for p in glob.glob(os.path.join(path.replace("file:", ""), "part-*"))
             if not p.endswith(".crc") and os.path.getsize(p) > 10]
    with open(parts[0], newline="") as fh:
        raw = fh.read()
    assert '"St. ""Mary"" Hospital, East"' in raw
    assert list(csv.reader(raw.splitlines(True)))[1] == ["1", value, "two\nlines", "back\\slash"]
    assert tuple(files.read_csv(spark, path, schema=df.schema, multi_line=True).first()) == \
        (1, value, "two\nlines", "back\\slash")
    other = scratch_path(spark, "t_dialect_in").replace("file:", "")
    os.makedirs(other)
    with open(os.path.join(other, "x.csv"), "w", newline="") as fh:
        csv.writer(fh).writerows([["k", "a"], [1, value]])
    assert files.read_csv(spark, other).first().a == value


def test_columns_are_matched_by_name(spark):
    base = scratch_path(spark, "t_names").replace("file:", "")
    os.makedirs(base)
    for name, rows in (("a.csv", [["fips", "county", "state"], [1, "Autauga", "AL"]]),
                       ("b.csv", [["state", "County", "fips"], ["AL", "Baldwin", 3]]),
                       ("c.csv", [["fips"], [5]])):
        with open(os.path.join(base, name), "w", newline="") as fh:
            csv.writer(fh).writerows(rows)
    wanted = T.StructType([T.StructField("fips", T.DoubleType()), T.StructField("county", T.StringType())])
    got = sorted(tuple(r) for r in files.read_csv_by_name(spark, base, wanted).collect())
    assert got == [(1.0, "Autauga"), (3.0, "Baldwin"), (5.0, None)]
    with pytest.raises(Exception):  # by position the header must agree
        files.read_csv(spark, os.path.join(base, "b.csv"), check_header=True, schema=T.StructType([
            T.StructField(c, T.StringType()) for c in ("fips", "county", "state")])).collect()


def test_malformed_features_fail(spark):
    good = spark.createDataFrame([(1001.0, "Alabama", "A", 1.0, 2.0, "H", None, None, "AL", 1, "T")], HOSPITALS)
    lines = [r.value for r in files.to_geojson_lines(good, "longtitude", "latitude").collect()]
    for bad in (lines[0][:40], lines[0].replace("1001.0", '"abc"')):
        path = scratch_path(spark, "t_bad_geo")
        spark.createDataFrame([(lines[0],), (bad,)], "value string").coalesce(1).write.text(path)
        with pytest.raises(Exception):
            files.read_geojson(spark, path, HOSPITALS).collect()
        assert files.read_geojson(spark, path, HOSPITALS, mode="PERMISSIVE").count() == 2


def test_hot_sort_value_is_split(spark):
    df = spark.range(4000).selectExpr("CASE WHEN id % 3 = 0 THEN 'AL' ELSE 'CA' END AS state", "id")
    path = writers.write_sorted(df, scratch_path(spark, "t_hot_sort"), ["state"], partitions=64, tie_cols=["id"])
    parts = sorted(p for p in glob.glob(os.path.join(path.replace("file:", ""), "part-*.parquet")))
    assert len(parts) >= 60
    states = [r.state for p in parts for r in spark.read.parquet(p).select("state").collect()]
    assert states == sorted(states)


def test_managed_tables_are_never_dropped(spark):
    db = "t_managed"
    catalog.create_database(spark, db, scratch_path(spark, "t_managed_db"))
    spark.range(3).write.mode("overwrite").saveAsTable(f"{db}.src_kept")
    path = scratch_path(spark, "t_managed_src")
    spark.range(5).write.parquet(path)
    for act in (lambda: catalog.register_tables(spark, db, {"kept": path}, prefix="src_"),
                lambda: catalog.point_table(spark, db, "src_kept", path)):
        with pytest.raises(ValueError):
            act()
    assert spark.table(f"{db}.src_kept").count() == 3
    odd = scratch_path(spark, "t_o'dd")  # a quote in a path is escaped
    spark.range(2).write.parquet(odd)
    assert spark.table(catalog.point_table(spark, db, "odd", odd)).count() == 2
    spark.range(7).write.parquet(odd + "2")
    assert spark.table(catalog.point_table(spark, db, "odd", odd + "2")).count() == 7


def test_geojson_both_layouts(spark):
    props = HOSPITALS
    row = (1001.0, "Alabama", "Autauga", 32.4, -86.5, "H, \"1\"", None, None, "AL", 36067, "T")
    df = spark.createDataFrame([row], props)
    lines_path = scratch_path(spark, "t_geo_lines")
    files.to_geojson_lines(df, "longtitude", "latitude").write.text(lines_path)
    got = files.read_geojson(spark, lines_path, props).first()
    assert (got.hospital_name, got.lon, got.lat, got.hq_zip_code) == ('H, "1"', -86.5, 32.4, 36067)

    coll_dir = scratch_path(spark, "t_geo_coll").replace("file:", "")
    os.makedirs(coll_dir)
    feature = {"type": "Feature", "properties": {"fips": 6037.0, "state_name": "California"},
               "geometry": {"type": "Point", "coordinates": [-118.2, 34.0]}}
    with open(os.path.join(coll_dir, "beds.geojson"), "w") as fh:
        json.dump({"type": "FeatureCollection", "features": [feature, feature]}, fh, indent=2)
    coll = files.read_geojson(spark, coll_dir, props, multiline=True).collect()
    assert len(coll) == 2 and coll[0].state_name == "California" and coll[0].lon == -118.2


def test_landing_path_rule(spark):
    urls = ["https://data.example.com/lake/csv/daily.csv.gz",
            "https://data.example.com/lake/csv/us_county/us_county.csv",
            "https://data.example.com/x"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    folder, name = files.landing_path("url")
    got = [(r.f, r.n) for r in df.select(folder.alias("f"), name.alias("n")).collect()]
    assert got == [("lake/", "daily.csv.gz"), ("lake/us_county/", "us_county.csv"), ("x/", "x")]


def test_csv_gzip_and_plain_round_trip(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") * 1.5).alias("x"))
    base = scratch_path(spark, "t_csv")
    writers.write_csv(df, f"{base}/gz", compression="gzip")
    writers.write_csv(df, f"{base}/plain")
    gz = files.read_csv(spark, f"{base}/gz", schema=df.schema, partitions=4)
    plain = files.read_csv(spark, f"{base}/plain", schema=df.schema)
    assert gz.exceptAll(df).count() == 0 and plain.exceptAll(df).count() == 0
    inferred = files.read_csv(spark, f"{base}/plain", infer_schema=True)
    assert dict(inferred.dtypes) == {"id": "int", "x": "double"}


def test_catalog_and_positional_load(spark):
    db = "t_catalog"
    catalog.create_database(spark, db, scratch_path(spark, "t_db"))
    src = scratch_path(spark, "t_src")
    spark.range(10).selectExpr("id", "id * 2 AS v").write.parquet(src)
    names = catalog.register_tables(spark, db, {"nums": src}, prefix="raw_")
    assert names == [f"{db}.raw_nums"]
    assert catalog.list_tables(spark, db, "raw_*") == ["raw_nums"]
    prof = catalog.table_profile(spark, names).first()
    assert (prof.table_name, prof.n_columns, prof.n_rows) == ("raw_nums", 2, 10)
    # a list of folders: one table per folder, named after it
    many = [scratch_path(spark, "t_list") + "/us_county", scratch_path(spark, "t_list") + "/us-states"]
    for p in many:
        spark.range(2).write.parquet(p)
    listed = catalog.register_tables(spark, db, {"counties": many}, prefix="cty_")
    assert listed == [f"{db}.cty_us_county", f"{db}.cty_us_states"]

    a = scratch_path(spark, "t_b1")
    b = scratch_path(spark, "t_b2")
    spark.range(3).selectExpr("id").write.parquet(a)
    spark.range(3, 5).selectExpr("id", "'new' AS extra").write.parquet(b)
    evolved = catalog.read_evolving(spark, [a, b])
    assert sorted(evolved.columns) == ["extra", "id"]
    assert evolved.where("extra IS NULL").count() == 3
    unioned = catalog.evolve_union([spark.range(2).selectExpr("id"),
                                    spark.range(1).selectExpr("id", "'z' AS extra")])
    assert unioned.count() == 3

    table = writers.create_table(spark, DIM_REGION, scratch_path(spark, "t_wh"), db=db)
    rows = spark.createDataFrame([(1, "01001", "01", "001", "Alabama", "Autauga", "US", 1.0, 2.0)],
                                 writers.spec_schema(DIM_REGION))
    csv_path = writers.write_csv(rows, scratch_path(spark, "t_dim_csv"))
    writers.load_positional(spark, table, csv_path, DIM_REGION)
    loaded = writers.load_positional(spark, table, csv_path, DIM_REGION)  # idempotent re-run
    assert loaded.count() == 1 and loaded.first().county == "Autauga"
    assert writers.schema_ddl(loaded).startswith("region_sk INT, fips STRING")


def test_write_sorted_files_are_ordered(spark):
    df = spark.range(1000).selectExpr("id", "(id * 7919) % 1000 AS k")
    path = writers.write_sorted(df, scratch_path(spark, "t_sorted"), ["k"], partitions=4)
    back = spark.read.parquet(path)
    per_file = back.groupBy(F.input_file_name().alias("f")).agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
    ranges = sorted((r.lo, r.hi) for r in per_file.collect())
    assert all(prev[1] < nxt[0] for prev, nxt in zip(ranges, ranges[1:]))  # disjoint key ranges


def test_read_csv_parse_modes(spark):
    import pytest
    from pyspark.sql import types as T

    path = scratch_path(spark, "t_bad_csv").replace("file:", "")
    os.makedirs(path)
    with open(os.path.join(path, "f.csv"), "w") as fh:
        fh.write("fips,county\n1001.0,Autauga\nnot-a-number,Bad\n1003.0,Baldwin\n")
    schema = T.StructType([T.StructField("fips", T.DoubleType()), T.StructField("county", T.StringType())])
    with pytest.raises(Exception):
        files.read_csv(spark, path, schema=schema).collect()
    # collect, not count(): a CSV count needs no column and so parses no field
    assert len(files.read_csv(spark, path, schema=schema, mode="DROPMALFORMED").collect()) == 2
    rows = files.read_csv(spark, path, schema=schema, mode="PERMISSIVE").collect()
    assert sorted((r.fips is None, r.county) for r in rows)[-1] == (True, "Bad")
