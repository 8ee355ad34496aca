import pytest

from starmart.operators import clean


def test_not_equal_keeps_null(spark):
    df = spark.createDataFrame([("Grand Princess",), (None,), ("Ohio",)], "p string")
    got = {r.p for r in clean.filter_not_equal_keep_null(df, "p", "Grand Princess").collect()}
    assert got == {"Ohio", None}


def test_drop_null_rows_any(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (1.0, None)], "a double, b double")
    assert clean.drop_null_rows(df, ["a"]).count() == 2
    assert clean.drop_null_rows(df, ["a", "b"]).count() == 1


def test_fill_zero_numeric_only(spark):
    df = spark.createDataFrame([(None, None, None)], "x double, n int, s string")
    r = clean.fill_numeric_zero(df).first()
    assert (r.x, r.n, r.s) == (0.0, 0, None)


def test_promote_header_by_value(spark):
    df = spark.createDataFrame([("state", "abv"), ("Ohio", "OH"), ("Iowa", "IA")], "c0 string, c1 string")
    out = clean.promote_header(df, ["state", "abv"])
    assert out.columns == ["state", "abv"]
    assert sorted(r.abv for r in out.collect()) == ["IA", "OH"]


def test_rename_positional_checks_length(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert clean.rename_positional(df, ["x", "y"]).columns == ["x", "y"]
    with pytest.raises(ValueError):
        clean.rename_positional(df, ["x"])
    with pytest.raises(ValueError):
        clean.rename(df, {"missing": "z"})


def test_preview_is_ordered_top_k(spark):
    df = spark.range(100).selectExpr("99 - id AS k")
    assert [r.k for r in clean.preview(df, ["k"], 3).collect()] == [0, 1, 2]


def test_copy_and_drop(spark):
    df = spark.createDataFrame([(6.0,)], "fips double")
    out = clean.copy_column(df, "fips", "state_fips", drop_src=True)
    assert out.columns == ["state_fips"]
