"""Property tests: column rules against plain-Python statements of the same rule.

Each example evaluates a whole generated batch in one Spark job."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from starmart.functions import left_chars, right_chars, zfill_code
from starmart.operators.keys import dense_key
from starmart.sources.files import landing_path

FAST = settings(max_examples=12, deadline=None)


@FAST
@given(st.lists(st.one_of(st.none(), st.floats(-2e6, 2e6, allow_nan=False)), min_size=1, max_size=40),
       st.integers(1, 7))
def test_zfill_code_is_int_then_zfill(spark, values, width):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(zfill_code("x", width)).collect()]
    assert got == [None if v is None else str(int(v)).zfill(width) for v in values]


@FAST
@given(st.lists(st.text(alphabet="ab0-", min_size=0, max_size=6), min_size=1, max_size=30))
def test_left_right_match_python_slices(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [(r.l, r.r) for r in df.select(left_chars("s", 2).alias("l"), right_chars("s", 3).alias("r")).collect()]
    assert got == [(v[:2], v[-3:] if len(v) >= 3 else v) for v in values]


_segment = st.text(alphabet="abcxyz._-", min_size=1, max_size=5)


@FAST
@given(st.lists(st.lists(_segment, min_size=2, max_size=6), min_size=1, max_size=20), st.integers(4, 7))
def test_landing_path_matches_split_rule(spark, paths, deep):
    urls = ["https://host.example/" + "/".join(p) for p in paths]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    folder, name = landing_path("url", deep_parts=deep)
    got = [(r.f, r.n) for r in df.select(folder.alias("f"), name.alias("n")).collect()]
    expected = []
    for u in urls:
        parts = u.split("/")
        loc = f"{parts[3]}/{parts[-2]}/" if len(parts) > deep else f"{parts[3]}/"
        expected.append((loc, parts[-1]))
    assert got == expected


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["01", "06", None]), st.integers(0, 3)), min_size=1, max_size=60))
def test_dense_key_equals_row_number(spark, rows):
    df = spark.createDataFrame(rows, "s string, v int")
    got = dense_key(df, ["s", "v"], "sk", num_partitions=3)
    w = Window.orderBy(F.col("s").asc_nulls_last(), F.col("v").asc_nulls_last())
    exp = df.withColumn("sk", F.row_number().over(w).cast("int")).select("sk", "s", "v")
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
