"""A second crawl updates, deprecates and restores; nested feeds are catalogued flat."""

import json
import os

import pytest
from pyspark.sql import functions as F

from starmart.session import delete_path, scratch_path
from starmart.sources import catalog


def _db(spark, name):
    catalog.create_database(spark, name, scratch_path(spark, name))
    return name


def _report(df):
    return {(r.table_name, r.column_name): r.status for r in df.collect()}


def test_recrawl_of_parquet(spark, monkeypatch):
    db, base = _db(spark, "t_crawl"), scratch_path(spark, "t_crawl_files")
    rows = spark.range(4)
    rows.selectExpr("id AS a", "'x' AS b").write.parquet(f"{base}/t/1")
    rows.selectExpr("id AS k").write.parquet(f"{base}/u")
    rows.selectExpr("id AS k").write.parquet(f"{base}/w")
    spark.sql(f"CREATE TABLE {db}.other (z INT) USING parquet LOCATION '{base}/other'")
    sources = {"t": f"{base}/t/*", "u": f"{base}/u", "w": f"{base}/w"}
    first = _report(catalog.crawl(spark, db, sources, prefix="c_"))
    assert set(first.values()) == {"added"} and ("c_t", "b") in first and ("other", None) not in first
    again = _report(catalog.crawl(spark, db, sources, prefix="c_"))
    assert set(again.values()) == {"unchanged"}

    # a new column in a new folder, another table without files, a third one not looked for
    rows.selectExpr("id AS a", "'y' AS b", "id / 2.0 AS extra").write.parquet(f"{base}/t/2")
    delete_path(spark, f"{base}/u")
    statements, plain = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: statements.append(q) or plain(self, q, *a, **k))
    second = _report(catalog.crawl(spark, db, {k: sources[k] for k in ("t", "u")}, prefix="c_"))
    monkeypatch.undo()
    assert second == {("c_t", None): "updated", ("c_t", "a"): "unchanged", ("c_t", "b"): "unchanged",
                      ("c_t", "extra"): "added", ("c_u", None): "deprecated", ("c_w", None): "deprecated"}
    assert not any(q.startswith(("DROP", "CREATE")) for q in statements)     # in place
    assert spark.table(f"{db}.c_t").where("extra IS NULL").count() == 4
    assert catalog.is_deprecated(spark, db, "c_u") and catalog.is_deprecated(spark, db, "c_w")
    assert spark.table(f"{db}.c_w").count() == 4                              # still readable

    # a column that is in no file any more stays, reads as NULL and is marked
    rows.selectExpr("id AS a", "1.5D AS extra").write.mode("overwrite").parquet(f"{base}/t/1")
    rows.selectExpr("id AS a", "1.5D AS extra").write.mode("overwrite").parquet(f"{base}/t/2")
    rows.selectExpr("id AS k").write.parquet(f"{base}/u")
    third = _report(catalog.crawl(spark, db, sources, prefix="c_"))
    assert third[("c_t", "b")] == "deprecated" and third[("c_u", None)] == third[("c_w", None)] == "restored"
    assert third[("c_t", "extra")] == "retyped"                              # decimal to double
    marked = {f.name: f.metadata.get("comment") for f in spark.table(f"{db}.c_t").schema}
    assert marked["b"] == catalog.GONE and spark.table(f"{db}.c_t").where("b IS NULL").count() == 8
    assert not catalog.is_deprecated(spark, db, "c_u")
    rows.selectExpr("'q' AS b", "id AS a", "2.5D AS extra").write.mode("overwrite").parquet(f"{base}/t/2")
    fourth = _report(catalog.crawl(spark, db, sources, prefix="c_"))
    assert fourth[("c_t", "b")] == "restored" and fourth[("c_t", "extra")] == "unchanged"
    assert spark.table(f"{db}.c_t").where("b = 'q'").count() == 4


def test_recrawl_of_csv_and_json(spark):
    db, base = _db(spark, "t_crawl_csv"), scratch_path(spark, "t_crawl_csv_files")
    local = base.replace("file:", "")
    os.makedirs(f"{local}/c")
    with open(f"{local}/c/1.csv", "w") as fh:
        fh.write("id,name\n1,a\n2,b\n")
    typed = {"inferSchema": "true"}
    assert _report(catalog.crawl(spark, db, {"c": f"{base}/c"}, fmt="csv", options=typed))[("c", "id")] == "added"
    with open(f"{local}/c/2.csv", "w") as fh:
        fh.write("id,name,score\n3,c,1.5\n")
    second = _report(catalog.crawl(spark, db, {"c": f"{base}/c"}, fmt="csv", options=typed))
    assert second == {("c", None): "updated", ("c", "id"): "unchanged", ("c", "name"): "unchanged",
                      ("c", "score"): "added"}
    rows = sorted(map(tuple, spark.table(f"{db}.c").collect()))
    assert rows == [(1, "a", None), (2, "b", None), (3, "c", 1.5)]
    with open(f"{local}/c/3.csv", "w") as fh:
        fh.write("name,id\nd,4\n")
    with pytest.raises(ValueError, match="differ"):
        catalog.crawl(spark, db, {"c": f"{base}/c"}, fmt="csv", options=typed)

    spark.range(2).selectExpr("id", "named_struct('x', id) AS s").write.json(f"{base}/j")
    catalog.crawl(spark, db, {"j": f"{base}/j"}, fmt="json")
    spark.range(2).selectExpr("id", "named_struct('x', id) AS s", "'n' AS n").write.mode("append").json(f"{base}/j")
    assert _report(catalog.crawl(spark, db, {"j": f"{base}/j"}, fmt="json"))[("j", "n")] == "added"
    spark.sql(f"CREATE TABLE {db}.m (a INT) USING parquet")
    with pytest.raises(ValueError, match="managed"):
        catalog.crawl(spark, db, {"m": f"{base}/j"}, fmt="json")


def _features(n):
    return [{"type": "Feature",
             "properties": {"FIPS": i, "Name": "ü ]" if i else None, "Beds": {"Total": i, "ICU": {"Total": 2.5}}},
             "geometry": {"type": "Point", "coordinates": [i + 0.5, -i]}} for i in range(n)]


@pytest.mark.parametrize("multiline", [False, True])
def test_nested_feed_is_catalogued_flat(spark, multiline):
    db = _db(spark, "t_nested")
    path = scratch_path(spark, "t_nested_files").replace("file:", "")
    os.makedirs(path)
    with open(f"{path}/f.json", "w") as fh:
        if multiline:
            json.dump({"type": "FeatureCollection", "features": _features(40)}, fh, indent=1)
        else:
            fh.write("\n".join(map(json.dumps, _features(40))))
    name = catalog.register_geojson(spark, db, f"beds_{multiline}", path, multiline=multiline)
    df = spark.table(name)
    assert sorted(df.columns) == sorted(["fips", "name", "beds_total", "beds_icu_total", "lon", "lat"])
    rows = {r.fips: r for r in df.collect()}
    assert len(rows) == 40 and rows[7].asDict() == {
        "fips": 7, "name": "ü ]", "beds_total": 7, "beds_icu_total": 2.5, "lon": 7.5, "lat": -7.0}
    assert rows[0].name is None
    assert f"beds_{multiline}_features".lower() in catalog.list_tables(spark, db)
    # files that land later are read through the same view, and registering again changes nothing
    os.link(f"{path}/f.json", f"{path}/g.json")
    catalog.register_geojson(spark, db, f"beds_{multiline}", path, multiline=multiline)
    assert spark.table(name).count() == 80


def test_lengths_are_bytes(spark):
    from starmart.operators import checks
    from starmart.schemas import Column, TableSpec

    spec = TableSpec("t", (Column("name", "string", max_len=9), Column("code", "string", True)), ("name",), ())
    df = spark.createDataFrame([("Doña Anax", "a"), ("Los Angel", None), ("ninechars!", "b"), (None, "c")],
                               "name string, code string")
    got = {r.column_name: tuple(r)[2:] for r in checks.column_violations(df, spec).collect()}
    assert got == {"name": (0, 2, 1), "code": (1, 0, 0)}      # 9 characters, 10 bytes: too long
    assert df.where(F.octet_length("name") == 10).count() == 2


def test_registering_again_switches_in_place(spark, monkeypatch):
    db, base = _db(spark, "t_register"), scratch_path(spark, "t_register_files")
    spark.range(3).selectExpr("id AS a").write.parquet(f"{base}/1")
    spark.range(5).selectExpr("id AS a").write.parquet(f"{base}/2")
    spark.range(7).selectExpr("id AS a", "'x' AS b").write.parquet(f"{base}/3")
    (name,) = catalog.register_tables(spark, db, {"t": f"{base}/1"})
    assert spark.table(name).count() == 3
    statements, plain = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: statements.append(q) or plain(self, q, *a, **k))
    catalog.register_tables(spark, db, {"t": f"{base}/2"})
    monkeypatch.undo()
    assert spark.table(name).count() == 5 and not any(q.startswith(("DROP", "CREATE")) for q in statements)
    catalog.register_tables(spark, db, {"t": f"{base}/3"})
    assert spark.table(name).count() == 7 and spark.table(name).columns == ["a", "b"]
