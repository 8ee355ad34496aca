"""Sinks.

* ``write_csv``: headered CSV, one part file per task, overwrite (re-runs are idempotent).
* ``create_table`` / ``load_positional``: a typed table declared from a ``TableSpec``;
  rows are inserted by position (as a bulk copy with a skipped header does) and the load
  overwrites, so a re-run does not duplicate rows.
* ``write_sorted``: range partitioned on the sort key and a tie-breaking key, sorted inside
  each file, so Parquet row-group min/max statistics skip data for range predicates on the
  sort key and a hot sort value is cut over many tasks.
* ``extract_csv``: ordered extract in unload format (every value quoted, NULL as ``""``).
  A single file is produced only when asked for; that funnels the rows through one task
  and is meant for marts whose size is bounded (one row per state). Otherwise the global
  order is kept across the part files of a range partitioned write, each with its header.
* ``publish_extract`` / ``read_extract``: versions of an extract, the one in force named by a
  manifest of its files with their rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.keys import sort_columns
from starmart.schemas import TableSpec
from starmart.session import list_files, read_text, replace_text
from starmart.sources.catalog import sql_text
from starmart.sources.files import CSV_DIALECT, read_csv

MANIFEST = "manifest.json"


def write_csv(df: DataFrame, path: str, header: bool = True, compression: str | None = None) -> str:
    writer = df.write.mode("overwrite").options(**CSV_DIALECT).option("header", header)
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)
    return path


def spec_schema(spec: TableSpec) -> T.StructType:
    """Spark schema of a warehouse table declaration."""
    return T.StructType.fromDDL(", ".join(f"`{c.name}` {c.ddl_type}" for c in spec.columns))


def create_table(spark: SparkSession, spec: TableSpec, location: str, db: str | None = None,
                 fmt: str = "parquet") -> str:
    """``CREATE TABLE IF NOT EXISTS`` with the declared column types at ``location``."""
    name = f"`{db}`.`{spec.name}`" if db else f"`{spec.name}`"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({spec.ddl()}) USING {fmt} "
              f"LOCATION {sql_text(location)}")
    return name.replace("`", "")


def load_positional(spark: SparkSession, table: str, csv_path: str, spec: TableSpec,
                    multi_line: bool = False) -> DataFrame:
    """Load a headered CSV into ``table`` by column position, replacing its contents."""
    rows = read_csv(spark, csv_path, schema=spec_schema(spec), multi_line=multi_line)
    rows.write.insertInto(table, overwrite=True)
    return spark.table(table)


def write_sorted(df: DataFrame, path: str, sort_cols: Sequence[str | Column],
                 partitions: int | None = None, tie_cols: Sequence[str] = ()) -> str:
    """Files in order of ``sort_cols``; ``tie_cols`` (the primary key) split equal sort values."""
    order = sort_columns([*sort_cols, *[c for c in tie_cols if c not in sort_cols]])
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.mode("overwrite").parquet(path)
    return path


def _extract_text(c: Column, dtype: T.DataType) -> Column:
    """A value as warehouse unload text: whole doubles without a fraction (``49``, not
    ``49.0``), booleans as ``t`` / ``f``, everything else as its string form."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        whole = (c == F.floor(c)) & (F.abs(c) < F.lit(1e15))
        return F.when(whole, c.cast("bigint").cast("string")).otherwise(c.cast("string"))
    if isinstance(dtype, T.BooleanType):
        return F.when(c, F.lit("t")).when(~c, F.lit("f"))
    return c.cast("string")


def _quoted(text: Column) -> Column:
    """Always quoted, inner quotes doubled, NULL as an empty quoted field."""
    return F.concat(F.lit('"'), F.coalesce(F.replace(text, F.lit('"'), F.lit('""')), F.lit("")),
                    F.lit('"'))


def extract_csv(df: DataFrame, path: str, order_cols: Sequence[str],
                single_file: bool = False, partitions: int | None = None,
                told: Observation | None = None) -> str:
    """Ordered CSV extract in unload format: every value quoted, NULL as ``""``.

    Several files (``partitions`` of them, or as many as the session shuffles to): each has
    its header, so the folder reads back whole as headered CSV; the rows in order of file
    name and line are in the requested order. ``single_file`` writes one file with a plain
    header line through one task, for marts of bounded size. ``told`` gets ``n``, the rows that
    reach the write.
    """
    watched = lambda rows: rows.observe(told, F.count(F.lit(1)).alias("n")) if told else rows
    if not single_file:
        text = [_extract_text(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields]
        order = sort_columns(order_cols)
        if order:
            df = (df.repartitionByRange(partitions, *order) if partitions
                  else df.repartitionByRange(*order)).sortWithinPartitions(*order)
        # behind the range partitioning, whose sampling evaluates what is before it once more
        (watched(df).select(*[F.coalesce(c, F.lit("")).alias(f.name) for c, f in zip(text, df.schema.fields)])
           .write.mode("overwrite").options(**CSV_DIALECT).option("header", True)
           .option("quoteAll", True).option("emptyValue", "").csv(path))
        return path
    rank = "__sm_line"
    keys = list(order_cols)
    line = F.concat_ws(",", *[_quoted(_extract_text(F.col(f.name), f.dataType))
                              for f in df.schema.fields])
    body = watched(df).select(F.lit(1).alias(rank), *keys, line.alias("value"))
    header = df.sparkSession.range(1).select(
        F.lit(0).alias(rank), *[F.lit(None).cast(df.schema[k].dataType).alias(k) for k in keys],
        F.lit(",".join(df.columns)).alias("value"))
    # one partition, sorted inside it: the header row comes first
    ordered = header.unionByName(body).coalesce(1).sortWithinPartitions(F.col(rank), *sort_columns(keys))
    ordered.select("value").write.mode("overwrite").text(path)
    return path


def publish_extract(df: DataFrame, path: str, order_cols: Sequence[str], single_file: bool = False,
                    partitions: int | None = None) -> dict:
    """A new version of an extract below ``path``, put in force by its manifest.

    The files go to a folder of their own. They are then read back: the manifest lists every
    file with its rows and bytes, and an extract whose rows are not those that were computed
    fails. Replacing ``path/manifest.json`` by one rename is the last step, so a reader finds
    the earlier extract whole or the new one whole, and a failed extract changes nothing.
    """
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex[:12]}"
    folder = f"{path}/{version}"
    told = Observation()
    extract_csv(df, folder, order_cols, single_file, partitions, told)
    schema = ", ".join(f"`{c}` STRING" for c in df.columns)
    # quoted values may hold line ends
    back = (spark.read.options(**CSV_DIALECT).option("header", True).option("multiLine", True)
            .option("mode", "FAILFAST").schema(schema).csv(folder))
    counted = {r["name"]: r["n"] for r in back.select(F.col("_metadata.file_name").alias("name"))
               .groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect()}
    files = [{"file": name, "rows": counted.get(name, 0), "bytes": size}
             for name, size in list_files(spark, folder)]
    rows = sum(f["rows"] for f in files)
    # a write of no rows at all may run without a task, so nothing is told
    wanted = told.get.get("n", 0) if rows else 0
    if rows != wanted:
        raise RuntimeError(f"extract below {folder} holds {rows} rows, {wanted} were computed")
    manifest = {"version": version, "columns": df.columns, "rows": rows, "files": files}
    replace_text(spark, f"{path}/{MANIFEST}", json.dumps(manifest, indent=1))
    return manifest


def extract_manifest(spark: SparkSession, path: str) -> dict:
    """The manifest of the extract in force below ``path``."""
    return json.loads(read_text(spark, f"{path}/{MANIFEST}"))


def read_extract(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """The extract in force below ``path``: the files that its manifest lists, the empty text as
    NULL."""
    manifest = extract_manifest(spark, path)
    files = [f"{path}/{manifest['version']}/{f['file']}" for f in manifest["files"]]
    reader = (spark.read.options(**CSV_DIALECT).option("header", True).option("emptyValue", "")
              .option("nullValue", "").option("mode", "FAILFAST").option("multiLine", multi_line).schema(schema))
    return reader.csv(files) if files else spark.createDataFrame([], schema)


def schema_ddl(df: DataFrame, with_nullability: bool = True) -> str:
    """Column list DDL of a DataFrame: ``name TYPE [NOT NULL], ...``."""
    parts = []
    for f in df.schema.fields:
        t = f.dataType.simpleString().upper()
        not_null = with_nullability and not f.nullable
        parts.append(f"{f.name} {t}" + (" NOT NULL" if not_null else ""))
    return ", ".join(parts)
