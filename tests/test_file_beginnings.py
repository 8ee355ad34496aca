"""Headers and feature borders found by one job; files of many layouts, large documents."""

import gzip
import json
import os

import pytest
from pyspark.sql import types as T

from starmart.session import scratch_path
from starmart.sources import files

WANTED = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()),
                       T.StructField("d", T.DoubleType()), T.StructField("t", T.DateType())])


def _folder(spark, name):
    path = scratch_path(spark, name).replace("file:", "")
    os.makedirs(path)
    return path


def _put(path, text):
    with open(path, "w", newline="", encoding="utf-8") as fh:
        fh.write(text)


def _jobs(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = run()
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_many_layouts_by_name(spark):
    path = _folder(spark, "t_layouts")
    _put(f"{path}/1.csv", 'a,b,d,t\n1,"x, ""y""",1.5,2020-01-02\n2,,,\n')
    _put(f"{path}/2.csv", '﻿T,extra,A\r\n2020-02-03,"q,r",3\r\n')                    # fewer, other order
    _put(f"{path}/3.csv", 'b,"odd, name",d,a,t,more\n"",1,2.5,4,,z\n')                   # more columns
    _put(f"{path}/4.csv", "\n\nb\nonly\n")                                             # one column
    _put(f"{path}/5.csv", "")                                                          # no header
    _put(f"{path}/6.csv", "a,b,d,t\n")                                                 # no rows
    with gzip.open(f"{path}/7.csv.gz", "wt") as fh:
        fh.write("d,a\n9.5,5\n" + "0.5,6\n" * 3)
    import datetime as dt
    want = [(1, 'x, "y"', 1.5, dt.date(2020, 1, 2)), (2, None, None, None), (3, None, None, dt.date(2020, 2, 3)),
            (4, None, 2.5, None), (None, "only", None, None), (5, None, 9.5, None)] + [(6, None, 0.5, None)] * 3
    got = files.read_csv_by_name(spark, path, WANTED)
    assert got.schema == WANTED and _rows(got) == sorted(want, key=repr)
    assert _rows(files.read_csv_by_name(spark, [f"{path}/1.csv", f"{path}/6.csv"], WANTED)) \
        == sorted(want[:2], key=repr)
    assert files.read_csv_by_name(spark, f"{path}/5.csv", WANTED).count() == 0
    heads = {tuple(r.header) for r in files.csv_headers(spark, path).collect()}
    assert ("b", "odd, name", "d", "a", "t", "more") in heads and ("T", "extra", "A") in heads


@pytest.mark.parametrize("bad", ["1,x,2.0,2020-01-01,9\n", "1,x\n", '1,"x,y"\n'])
def test_ragged_lines_fail(spark, bad):
    path = _folder(spark, "t_ragged")
    _put(f"{path}/1.csv", "a,b,d\n1,x,2.0\n" + bad)
    with pytest.raises(Exception):
        files.read_csv_by_name(spark, path, WANTED).collect()
    _put(f"{path}/2.csv", "a,b,d,t\n")
    with pytest.raises(Exception, match="number of fields|CAST_INVALID|MALFORMED"):
        files.read_csv_by_name(spark, path, WANTED).collect()


def test_bad_values_fail(spark):
    path = _folder(spark, "t_bad")
    _put(f"{path}/1.csv", "a,b\none,x\n")
    _put(f"{path}/2.csv", "b,a\nx,2\n")
    with pytest.raises(Exception):
        files.read_csv_by_name(spark, path, WANTED).collect()


def test_line_ends_in_names_and_values(spark):
    path = _folder(spark, "t_lines")
    _put(f"{path}/1.csv", '"a","long\nname",b\n1,z,"two\nlines"\n')
    _put(f"{path}/2.csv", 'b,a\n"x\n,y",2\n')
    got = files.read_csv_by_name(spark, path, WANTED, multi_line=True)
    assert _rows(got.select("a", "b")) == [(1, "two\nlines"), (2, "x\n,y")]


def test_jobs_do_not_grow_with_the_files(spark):
    counts = []
    for n in (4, 60):
        path = _folder(spark, f"t_files_{n}")
        for i in range(n):
            _put(f"{path}/{i}.csv", ("a,b\n" if i % 2 else "b,a\n") + "1,2\n" * 500)
        (rows, jobs) = _jobs(spark, f"files-{n}", lambda p=path: files.read_csv_by_name(spark, p, WANTED).count())
        assert rows == n * 500
        counts.append(jobs)
    assert counts[0] == counts[1]


def test_large_files_are_left_after_their_answer(spark, monkeypatch):
    """Small and large files alike; of a large one the first records only."""
    monkeypatch.setattr(files, "_SMALL_FILE", 2000)
    path = _folder(spark, "t_sizes")
    for i in range(9):
        _put(f"{path}/{i}.csv", ("a,b\n" if i % 3 else "b,a\n") + "1,2\n" * (10 if i < 6 else 200_000))
    heads = {r.path[-5:]: r.header for r in files.csv_headers(spark, path).collect()}
    assert heads == {f"{i}.csv": ["a", "b"] if i % 3 else ["b", "a"] for i in range(9)}
    assert files.read_csv_by_name(spark, path, WANTED).count() == 600_060


PROPS = T.StructType([T.StructField("n", T.LongType()), T.StructField("s", T.StringType())])


def _feature(i, **more):
    return {"type": "Feature", "properties": {"n": i, "s": f'{{"type":"Feature"}} "F", Ü{i}'},
            "geometry": {"type": "Point", "coordinates": [i / 2, -i]}, **more}


def test_collection_read_by_byte_ranges(spark):
    path = _folder(spark, "t_ranges")
    n = 30_000
    with open(f"{path}/one.geojson", "w") as fh:
        json.dump({"type": "FeatureCollection", "name": "x", "features": [_feature(i) for i in range(n)]}, fh)
    size = os.path.getsize(f"{path}/one.geojson")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // 20))
    try:
        got = files.read_geojson(spark, path, PROPS, multiline=True)
        tasks = got.rdd.getNumPartitions()
        per_task = got.selectExpr("spark_partition_id() p").groupBy("p").count().collect()
        rows = {r.n: (r.s, r.lon, r.lat) for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tasks >= 20 and len(per_task) >= 19 and max(r["count"] for r in per_task) < n / 10
    assert len(rows) == n and sum(r["count"] for r in per_task) == n
    assert rows[77] == ('{"type":"Feature"} "F", Ü77', 38.5, -77.0)


def test_spellings_of_collections(spark):
    base = _folder(spark, "t_spellings")
    docs = {"spaced": json.dumps({"type": "FeatureCollection", "features": [_feature(1), _feature(2)]}, indent=2),
            "tight": json.dumps({"type": "FeatureCollection", "features": [_feature(3)]}, separators=(",", ":")),
            "none": '{"type":"FeatureCollection","features":[]}',
            "bom": "﻿" + json.dumps({"features": [_feature(4, id=7)], "type": "FeatureCollection"})}
    for name, text in docs.items():
        os.makedirs(f"{base}/{name}")
        _put(f"{base}/{name}/f.json", text)
    read = lambda *names: sorted(r.n for r in files.read_geojson(
        spark, [f"{base}/{n}" for n in names], PROPS, multiline=True).collect())
    assert read("spaced") == [1, 2] and read("tight") == [3] and read("none") == [] and read("bom") == [4]
    assert read("spaced", "tight", "none", "bom") == [1, 2, 3, 4]
    # a type that is not the first member: the file is read whole
    late = {"features": [{"properties": {"n": 8, "s": ""}, "type": "Feature", "geometry": None}]}
    os.makedirs(f"{base}/late")
    _put(f"{base}/late/f.json", json.dumps({"type": "FeatureCollection", **late}))
    assert read("late") == [8] and read("late", "tight") == [3, 8]


@pytest.mark.parametrize("broken", [
    '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"n":1,"s":"a"}},'
    '{ "type": "Feature","properties":{"n":2,"s":"b"}}]}',                              # two spellings
    '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"n":1,"s":"a"}},'
    '{"type":"Feature","properties":{"n":"x"',                                         # cut off
])
def test_broken_collections_fail(spark, broken):
    path = _folder(spark, "t_broken")
    _put(f"{path}/f.json", broken)
    with pytest.raises(Exception):
        files.read_geojson(spark, path, PROPS, multiline=True).collect()


def test_collection_written_as_one_document(spark):
    path = scratch_path(spark, "t_one_document")
    df = spark.range(50).selectExpr("id AS n", "concat('s', id) AS s", "id / 2.0 AS x", "double(-id) AS y")
    files.write_feature_collection(df, path, "x", "y")
    local = path.replace("file:", "")
    (name,) = [f for f in os.listdir(local) if f.startswith("part-")]
    document = json.load(open(os.path.join(local, name)))
    assert document["type"] == "FeatureCollection" and len(document["features"]) == 50
    back = files.read_geojson(spark, path, PROPS, multiline=True)
    assert _rows(back) == _rows(df.selectExpr("n", "s", "double(x) lon", "y lat"))
    files.write_feature_collection(df.where("n < 0"), path, "x", "y")
    assert files.read_geojson(spark, path, PROPS, multiline=True).count() == 0
