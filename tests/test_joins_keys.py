from pyspark.sql import Window
from pyspark.sql import functions as F

from starmart.operators.joins import first_per_group, join_distinct, lookup_join
from starmart.operators.keys import append_with_keys, dense_key


def test_join_distinct_equals_distinct_of_join(spark):
    # several days per county on both sides: a many-to-many join on fips
    left = spark.createDataFrame(
        [(1001.0, "AL", 1.0)] * 3 + [(1001.0, "AL", 2.0)] * 2 + [(1003.0, "AL", 5.0)],
        "fips double, st string, lat double")
    right = spark.createDataFrame([(1001.0, "Autauga")] * 4 + [(1003.0, "Baldwin"), (9.0, "x")],
                                  "fips double, county string")
    got = join_distinct(left, right, ["fips"])
    expected = left.join(right, "fips").distinct()
    assert got.count() == 3
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_first_per_group_drops_null_group(spark):
    df = spark.createDataFrame([("01", 5), ("01", 2), (None, 1), ("02", 7)], "g string, v int")
    got = {r.g: r.v for r in first_per_group(df, "g", "v").collect()}
    assert got == {"01": 2, "02": 7}


def test_lookup_join_hints_only_proven_bounds(spark):
    big = spark.range(50).selectExpr("id % 5 AS k", "id")
    small = spark.createDataFrame([(i, f"n{i}") for i in range(5)], "k long, name string")
    proven = lookup_join(big, small, "k", proven_rows=5)
    plain = lookup_join(big, small, "k")
    beyond = lookup_join(big, small, "k", proven_rows=10_000_000)
    assert proven.count() == plain.count() == beyond.count() == 50
    logical = [d._jdf.queryExecution().logical().toString() for d in (proven, plain, beyond)]
    assert ["ResolvedHint" in t or "UnresolvedHint" in t for t in logical] == [True, False, False]


def _reference_keys(df, order_cols, key):
    w = Window.orderBy(*[F.col(c).asc_nulls_last() for c in order_cols])
    return df.withColumn(key, F.row_number().over(w).cast("int"))


def test_dense_key_matches_row_number_with_nulls(spark):
    rows = [("01", None, 1.0), ("01", "b", None), (None, "a", 2.0), ("02", "a", 1.0),
            ("01", "a", 3.0), ("01", "a", 1.0)]
    df = spark.createDataFrame(rows, "s string, c string, x double")
    order = ["s", "c", "x"]
    got = dense_key(df, order, "sk", num_partitions=3)
    exp = _reference_keys(df, order, "sk")
    assert got.columns[0] == "sk"
    assert sorted(map(tuple, got.collect()), key=str) == \
        sorted(map(tuple, exp.select(*got.columns).collect()), key=str)


def test_dense_key_with_hot_leading_key(spark):
    # one state holds a third of all rows; ranges follow the whole key, so it is split
    df = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN '06' ELSE lpad(CAST(id % 50 AS STRING), 2, '0') END AS state",
        "id")
    got = dense_key(df, ["state", "id"], "sk", num_partitions=8)
    exp = _reference_keys(df, ["state", "id"], "sk")
    assert got.exceptAll(exp.select(*got.columns)).count() == 0
    # the range partitioning dense_key relies on spreads the hot state over several tasks
    ranged = df.repartitionByRange(8, F.col("state").asc_nulls_last(), F.col("id").asc_nulls_last())
    hot_tasks = ranged.where("state = '06'").select(F.spark_partition_id()).distinct().count()
    assert hot_tasks >= 2
    keys = [r.sk for r in got.select("sk").collect()]
    assert sorted(keys) == list(range(1, 3001))


def test_dense_key_descending_order(spark):
    df = spark.createDataFrame([(1,), (3,), (2,)], "v int")
    got = {r.v: r.pos for r in dense_key(df, [F.col("v").desc()], "pos").collect()}
    assert got == {3: 1, 2: 2, 1: 3}


def test_append_with_keys_continues_after_max(spark):
    existing = dense_key(spark.createDataFrame([("a",), ("b",)], "n string"), ["n"], "sk")
    new = spark.createDataFrame([("d",), ("c",)], "n string")
    got = {r.n: r.sk for r in append_with_keys(existing, new, "sk", ["n"]).collect()}
    assert got == {"c": 3, "d": 4}


def test_dense_key_spreads_copies(spark):
    # a third of the rows are copies of one row: collapsed, expanded with ordinals (the
    # heavy row in chunks spread by a round-robin shuffle) and split over range partitions
    df = spark.range(3000).selectExpr("CASE WHEN id < 1000 THEN 'same' ELSE CAST(id AS STRING) END AS v")
    got = dense_key(df, ["v"], "sk", num_partitions=8)
    keys = sorted(r.sk for r in got.collect())
    assert keys == list(range(1, 3001))
    exp = _reference_keys(df, ["v"], "sk")
    assert got.exceptAll(exp.select(*got.columns)).count() == 0
    files = got.where("v = 'same'").select(F.input_file_name()).distinct().count()
    assert files >= 2
    same = sorted(r.sk for r in got.where("v = 'same'").collect())
    assert same == list(range(same[0], same[0] + 1000))  # copies get consecutive keys


def test_dense_key_without_collapse_on_distinct_input(spark):
    df = spark.range(200).selectExpr("CAST(id % 7 AS INT) AS a", "id")
    got = dense_key(df, ["a"], "sk", collapse_copies=False, num_partitions=4)
    exp = _reference_keys(df, ["a", "id"], "sk")
    assert got.exceptAll(exp.select(*got.columns)).count() == 0


def test_hot_copy_detection_is_bounded(spark):
    from starmart.operators.keys import _hot_copy_hashes

    distinct = spark.range(5000).selectExpr("id")
    assert _hot_copy_hashes(distinct, 4) == []
    doubled = spark.range(5000).selectExpr("id % 2500 AS id")  # every row twice: harmless
    assert _hot_copy_hashes(doubled, 4) == []
    few = spark.range(100_000).selectExpr("CASE WHEN id < 3 THEN id + 10 ELSE id END AS id")
    assert _hot_copy_hashes(few, 4) == []  # three doubled rows among distinct ones
    hot = spark.range(5000).selectExpr("CASE WHEN id < 2000 THEN -1 ELSE id END AS id")
    found = _hot_copy_hashes(hot, 4)
    assert len(found) == 1
    many = spark.range(20000).selectExpr("id % 100 AS id")  # 100 groups of 200 copies
    assert len(_hot_copy_hashes(many, 4)) <= 16  # never more than 4 * partitions


def test_keys_beyond_32_bits(spark):
    df = spark.range(5).selectExpr("id")
    got = sorted(r.k for r in dense_key(df, ["id"], "k", start=2**31 + 7).collect())
    assert got == [2**31 + 7 + i for i in range(5)]
    old = spark.createDataFrame([(2**31 + 4, 1)], "k long, id long")
    more = append_with_keys(old, df, "k", ["id"])
    assert min(r.k for r in more.collect()) == 2**31 + 5


def test_scratch_scope_frees_key_tables(spark):
    from starmart.session import path_exists, scratch_scope, scratch_path

    with scratch_scope(spark):
        keyed = dense_key(spark.range(10).selectExpr("id"), ["id"], "k")
        files = keyed.inputFiles()
        assert keyed.count() == 10
    outside = scratch_path(spark, "t_outside")
    assert not path_exists(spark, files[0])
    spark.range(1).write.parquet(outside)
    assert path_exists(spark, outside)
