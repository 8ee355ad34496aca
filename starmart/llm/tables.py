"""Shared steps of the training-data operators: input columns and written intermediates."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.session import scratch_path


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The ``documents`` table, read by Spark (any file system), narrowed to ``columns``."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*columns) if columns else df


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below the shared checkpoint folder and read back.

    Fixes the rows for every later use and cuts the lineage: a lost executor re-reads
    files instead of running the steps again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def first_by_hash(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows, the first by a hash of ``key`` (a string column) and the other columns.

    A threshold taken from the number of rows comes before the sort, with room for the spread
    of a binomial, so the last task of the sort gets little more than ``most`` rows in all.
    """
    n = rows.count()
    place = F.conv(F.substring(F.md5(F.col(key)), 1, 8), 16, 10).cast("long")
    room = most + 10 * int(most ** 0.5) + 100
    near = rows.where(place < int(2 ** 32 * room / n)) if n > room else rows
    return near.orderBy(F.md5(F.col(key)), key, *[c for c in rows.columns if c != key]).limit(most)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in Python workers, once an application, where it is not
    installed on the executors: the code goes with the job as a zip file."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="run-"), "starmart-code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def map_in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                 schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with a function of this package."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]],
              schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from fn(batch)

    return map_in_arrow(df, run, schema)


SEPARATORS = "[\\x20\\x09-\\x0D]+"


def words_array(text: Column) -> Column:
    """Native array of the words (runs outside space and 0x09-0x0D) of a text column."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS, -1), lambda w: w != "")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once a row, also where lambdas use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
