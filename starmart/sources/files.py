"""File sources: CSV (plain or gzip) and GeoJSON, with explicit schemas.

Scale notes
* A gzip file cannot be split, so it arrives as one partition per file; pass
  ``partitions`` to spread the rows before any wide work. Plain CSV splits by
  ``spark.sql.files.maxPartitionBytes``.
* Line-delimited GeoJSON (one Feature per line) splits like any JSON-lines file. A
  ``FeatureCollection`` document is cut into byte ranges at the borders of its features. Only
  one whose features do not open with their type needs ``multiLine`` parsing, which reads
  each file whole in one task.
* What the beginnings of files tell (header lines, feature borders) is found by one job over
  all files, each read up to its first records; the driver sees the distinct answers.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.session import scratch_path

# RFC 4180: a quote inside a quoted field is doubled (Spark's own default is a backslash).
# Used by every CSV read and write of the library.
CSV_DIALECT = {"quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
             header: bool = True, infer_schema: bool = False, null_value: str | None = None,
             partitions: int | None = None, mode: str = "FAILFAST",
             multi_line: bool = False, check_header: bool = False) -> DataFrame:
    """Headered CSV, gzip or plain (compression is detected from the file extension).

    With a ``schema`` the columns are taken by position and the header line is skipped,
    which is how a typed bulk load reads a file; with ``check_header`` a file whose header
    names other columns, or in another order, fails the read. ``mode`` is Spark's parse
    mode: ``FAILFAST`` (default: a malformed line fails the read), ``PERMISSIVE`` (bad
    fields become NULL) or ``DROPMALFORMED``. ``multi_line`` allows line ends inside
    quoted fields; such files cannot be split, so each is read by one task.
    """
    reader = (spark.read.options(**CSV_DIALECT).option("header", header).option("mode", mode)
              .option("multiLine", multi_line).option("enforceSchema", not check_header))
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", True)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    df = reader.csv(path)
    return df.repartition(partitions) if partitions else df


_SMALL_FILE = 4 << 20


def _beginnings(spark: SparkSession, path: str | list[str], answer: Callable, kind: str, name: str,
                line_sep: str | None = None) -> DataFrame:
    """(``path``, ``found``) of every text file: what ``answer(records, ended)`` makes of its first
    records, as a tuple of one value, or ``None`` while it needs more of them.

    Files of under ``_SMALL_FILE`` bytes are read together, some megabytes to a task. Larger ones
    are a task each, which stops with the answer: what it leaves is not read. Sessions beside the
    caller's have these layouts; the caller's settings stay as they are. The answers are
    written once and read back by the caller's session.
    """
    whole, where = str(1 << 40), scratch_path(spark, name)
    layouts = [(f"_metadata.file_size < {_SMALL_FILE}", str(_SMALL_FILE), str(_SMALL_FILE // 64), "10000"),
               (f"_metadata.file_size >= {_SMALL_FILE}", whole, whole, "8")]

    def of(alone: bool):
        def run(batches):
            file, records = None, None          # records: None once the file's answer is there
            out: list[tuple] = []

            def result():
                rows, out[:] = out[:], []
                return pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], value_type)],
                    ["path", "found"])

            for batch in batches:
                files, values = batch.column(0), batch.column(1)
                n = batch.num_rows
                turns = [0] if n else []
                if n > 1:
                    other = pc.not_equal(files.slice(1), files.slice(0, n - 1)).to_numpy(zero_copy_only=False)
                    turns += (np.flatnonzero(other) + 1).tolist()
                for begin, end in zip(turns, [*turns[1:], n]):
                    here = files[begin].as_py()
                    if here != file:
                        if records:
                            out.append((file, *(answer(records, True) or (None,))))
                        file, records = here, []
                    for i in range(begin, end if records is not None else begin):
                        records.append(values[i].as_py())
                        known = answer(records, False)
                        if known is not None:
                            out.append((file, *known))
                            records = None
                            if alone:
                                yield result()
                                return
                            break
                if out:
                    yield result()
            if records:
                last = answer(records, True)
                if last is not None:
                    out.append((file, *last))
                    yield result()
        return run

    value_type = pa.list_(pa.string()) if kind.startswith("array") else pa.string()
    for condition, part, cost, rows in layouts:
        beside = spark.newSession()
        for key, value in {"spark.sql.files.maxPartitionBytes": part, "spark.sql.files.openCostInBytes": cost,
                           "spark.sql.files.minPartitionNum": "1",       # no file in parts
                           "spark.sql.execution.arrow.maxRecordsPerBatch": rows}.items():
            beside.conf.set(key, value)
        reader = beside.read.option("lineSep", line_sep) if line_sep else beside.read
        lines = (reader.text(path).where(condition)
                 .select(F.col("_metadata.file_path").alias("path"), "value"))
        (lines.mapInArrow(of(alone=part == whole), f"path string, found {kind}")
              .where("path is not null").write.mode("append").parquet(where))
    return spark.read.schema(f"path string, found {kind}").parquet(where)


def csv_headers(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """(``path``, ``header``: array of names) of every CSV file with a header line, found on the
    executors from the beginnings of the files."""

    def header(lines: list[str], ended: bool):
        record = "\n".join(lines).removeprefix("\ufeff").lstrip("\n")
        if not record.strip() or (multi_line and record.count('"') % 2 and not ended):
            return None                          # an empty line, or a name with a line end
        return (next(csv.reader(io.StringIO(record, newline="") if multi_line else [record])),)

    found = _beginnings(spark, path, header, "array<string>", "csv-headers")
    return found.where("found is not null").withColumnRenamed("found", "header")


def read_csv_by_name(spark: SparkSession, path: str | list[str], wanted: T.StructType,
                     partitions: int | None = None, multi_line: bool = False) -> DataFrame:
    """The ``wanted`` columns of headered CSV files, matched by name in every file.

    Files may order their columns differently, carry more of them, or (older ones) lack
    some, which become NULL. Names match without regard to case; of names that repeat in a
    header the first counts. A line with more or fewer fields than its file's header fails the
    read.

    One job catalogues the headers (``csv_headers``); the driver sees the distinct ones only.
    Then all files are read by one scan, whatever the number of headers: fields are taken by
    position and named by a join with the file's header, a table of one row a file that the
    planner broadcasts where it is small. Files that agree on their header need no join.
    """
    heads = csv_headers(spark, path, multi_line)
    headers = sorted(list(r[0]) for r in heads.select("header").distinct().collect())
    if not headers:
        df = spark.createDataFrame([], wanted)
    elif len(headers) == 1:
        df = _of_one_header(spark, path, headers[0], wanted, multi_line)
    else:
        df = _of_headers(spark, path, heads, headers, wanted, multi_line)
    return df.repartition(partitions) if partitions else df


def _places(header: list[str]) -> dict[str, int]:
    """Place of each name, in lower case; the first of equal ones."""
    return {c.lower(): i for i, c in reversed(list(enumerate(header)))}


def _of_one_header(spark: SparkSession, path: str | list[str], header: list[str], wanted: T.StructType,
                   multi_line: bool) -> DataFrame:
    """Files of one header: typed by the scan itself."""
    at = _places(header)
    kinds = {at[f.name.lower()]: f.dataType for f in wanted.fields if f.name.lower() in at}
    schema = T.StructType([T.StructField(f"c{i}", kinds.get(i, T.StringType())) for i in range(len(header))])
    rows = read_csv(spark, path, schema=schema, multi_line=multi_line)
    return rows.select(*[(F.col(f"c{at[f.name.lower()]}") if f.name.lower() in at else F.lit(None).cast(f.dataType))
                         .alias(f.name) for f in wanted.fields])


def _of_headers(spark: SparkSession, path: str | list[str], heads: DataFrame, headers: list[list[str]],
                wanted: T.StructType, multi_line: bool) -> DataFrame:
    """Files of several headers, by one scan of text fields."""
    width, raw = max(map(len, headers)), "__sm_record"
    fields = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)]
                          + [T.StructField(raw, T.StringType())])
    rows = (spark.read.options(**CSV_DIALECT).option("header", True).option("multiLine", multi_line)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", raw)
            .option("columnPruning", "false")   # every line's fields are counted, whatever is asked for
            .schema(fields).csv(path)
            .withColumn("__sm_file", F.col("_metadata.file_path")))
    which = F.array_position(F.array(*[F.array(*map(F.lit, h)) for h in headers]), F.col("header")).cast("int")
    known = heads.select(F.col("path").alias("__sm_file"), which.alias("__sm_header"))
    rows = rows.join(known, "__sm_file")
    # the record itself is there where it has not ``width`` fields; quoted parts hold no separators
    bare = F.regexp_replace(raw, '"[^"]*"', "")
    have = F.when(F.col(raw).isNull(), F.lit(width)).otherwise(F.regexp_count(bare, F.lit(",")) + 1)
    should = F.element_at(F.array(*[F.lit(len(h)) for h in headers]), F.col("__sm_header"))
    # (no scan may be asked for the record alone: the first field goes with it)
    rows = rows.where(F.when((have == should) & (F.length(F.coalesce("c0", F.lit(""))) >= 0), F.lit(True)).otherwise(F.raise_error(F.concat(
        F.lit("line with another number of fields than the header of "), F.col("__sm_file"))).cast("boolean")))

    def value(name: str) -> Column:
        out = F.when(F.lit(False), F.lit(None))
        for k, header in enumerate(headers, start=1):
            at = _places(header).get(name.lower())
            if at is not None:
                out = out.when(F.col("__sm_header") == k, F.col(f"c{at}"))
        return out

    return rows.select(*[value(f.name).cast(f.dataType).alias(f.name) for f in wanted.fields])


def _geometry_schema() -> T.StructType:
    return T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.ArrayType(T.DoubleType())),
    ])


def feature_schema(properties: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("properties", properties),
        T.StructField("geometry", _geometry_schema()),
    ])


def read_geojson(spark: SparkSession, path: str | list[str], properties: T.StructType,
                 multiline: bool = False, mode: str = "FAILFAST") -> DataFrame:
    """GeoJSON point features flattened to ``properties.*`` plus ``lon`` / ``lat``.

    ``multiline=False`` reads one Feature per line; ``multiline=True`` reads
    FeatureCollection documents, in byte ranges where the features can be told apart without
    parsing (see ``feature_borders``), else each file whole. A truncated feature or a value of
    the wrong type fails the read unless ``mode`` says otherwise.
    """
    feature = feature_schema(properties)
    if multiline:
        feats = _collection_features(spark, path, feature, mode)
    else:
        feats = spark.read.schema(feature).option("mode", mode).json(path)
    coords = F.col("geometry.coordinates")
    return feats.select("properties.*",
                        F.try_element_at(coords, F.lit(1)).alias("lon"),
                        F.try_element_at(coords, F.lit(2)).alias("lat"))


_FEATURE = '"Feature"'
_OPENING = r'\{\s*"type"\s*:\s*$'


def feature_borders(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(``path``, ``border``) of FeatureCollection files: the text that opens every feature of a
    file, ``{"type":"Feature"`` with that file's own spaces; empty for a file without features,
    NULL where the type is not a feature's first member. One job, reading the beginnings."""

    def border(records: list[str], ended: bool):
        if len(records) == 1:
            return ("",) if ended else None      # the file holds one feature's opening, or none
        opening = re.search(_OPENING, records[0])
        return (opening.group() + _FEATURE if opening else None,)

    found = _beginnings(spark, path, border, "string", "feature-borders", line_sep=_FEATURE)
    return found.withColumnRenamed("found", "border")


def _collection_features(spark: SparkSession, path: str | list[str], feature: T.StructType,
                         mode: str) -> DataFrame:
    """Features of FeatureCollection documents.

    The border of a file's features serves as its record separator, so a large document is
    read by as many tasks as it has splits: each starts at the first border in its range and
    ends with the record that crosses its end. A border cannot stand inside a JSON text, where
    its quotes are escaped. A record that holds another feature's opening, in other spaces,
    fails the read: nothing is passed over.
    """
    borders = feature_borders(spark, path)
    kinds = [r[0] for r in borders.select("border").distinct().collect()]
    if None in kinds:
        coll = T.StructType([T.StructField("type", T.StringType()),
                             T.StructField("features", T.ArrayType(feature))])
        raw = spark.read.schema(coll).option("multiLine", True).option("mode", mode).json(path)
        return raw.select(F.explode("features").alias("f")).select("f.*")
    parts = []
    for kind in sorted(k for k in kinds if k):
        records = spark.read.option("lineSep", kind).text(path).withColumn("path", F.col("_metadata.file_path"))
        if len(kinds) > 1:
            records = records.join(borders.where(F.col("border") == kind).select("path"), "path", "left_semi")
        # What precedes a file's first feature opens the document; a feature goes on with a comma
        # or ends. The opening has no text to parse: filters may be evaluated in any order.
        opening = F.col("value").rlike("^(\\uFEFF)?\\s*\\{")
        other = F.col("value").rlike(r'\{\s*"type"\s*:\s*"Feature"')
        text = (F.when(opening, F.lit(None).cast("string"))
                .when(other, F.raise_error(F.concat(F.lit("features in several spellings in "), F.col("path")))
                      .cast("string"))
                .otherwise(F.concat(F.lit(kind), "value")))
        parts.append(records.where(~opening).select(F.from_json(text, feature, {"mode": mode}).alias("f"))
                     .select("f.*"))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], feature)


def _feature(df: DataFrame, lon_col: str, lat_col: str) -> Column:
    props = F.struct(*[F.col(c) for c in df.columns])
    geometry = F.struct(F.lit("Point").alias("type"),
                        F.array(F.col(lon_col).cast("double"), F.col(lat_col).cast("double"))
                        .alias("coordinates"))
    return F.struct(F.lit("Feature").alias("type"), props.alias("properties"),
                    geometry.alias("geometry"))


def to_geojson_lines(df: DataFrame, lon_col: str, lat_col: str) -> DataFrame:
    """One GeoJSON Feature text per row (``value`` column), ready for ``write.text``."""
    return df.select(F.to_json(_feature(df, lon_col, lat_col), {"ignoreNullFields": "false"}).alias("value"))


def write_feature_collections(df: DataFrame, path: str, lon_col: str, lat_col: str,
                              part: Column) -> str:
    """One FeatureCollection document per value of ``part``, each in a folder of its own.

    ``part`` must keep a document small enough for one row (a few hundred features).
    """
    docs = (df.select(part.alias("part"), _feature(df, lon_col, lat_col).alias("f")).groupBy("part")
            .agg(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"),
                                    F.collect_list("f").alias("features")),
                           {"ignoreNullFields": "false"}).alias("value")))
    docs.write.mode("overwrite").partitionBy("part").text(path)
    return path


def write_feature_collection(df: DataFrame, path: str, lon_col: str, lat_col: str) -> str:
    """All features as one FeatureCollection document, in one file: a stream through one task."""
    line, place = to_geojson_lines(df, lon_col, lat_col), "__sm_place"
    spark = df.sparkSession
    ends = spark.range(2).select(
        F.when(F.col("id") == 0, F.lit('{"type":"FeatureCollection","features":[')).otherwise(F.lit("]}"))
        .alias("value"), (F.col("id") * 2).cast("int").alias(place))
    body = line.withColumn(place, F.lit(1))
    ordered = body.unionByName(ends).coalesce(1).sortWithinPartitions(place, "value")
    # one partition: the opening is row 0, the first feature row 1; the others bring a comma
    row = ordered.withColumn("__sm_row", F.monotonically_increasing_id())
    text = F.when((F.col(place) == 1) & (F.col("__sm_row") > 1), F.concat(F.lit(","), "value")).otherwise(
        F.col("value"))
    row.select(text.alias("value")).write.mode("overwrite").text(path)
    return path


def landing_path(url: str | Column, deep_parts: int = 6) -> tuple[Column, Column]:
    """Folder and file name under which a downloaded URL is landed.

    The URL is split on ``/``. With more than ``deep_parts`` parts the folder is
    ``part[3]/part[-2]/`` (0-based, so the first path segment and the parent
    directory), otherwise ``part[3]/``; the file name is the last part. Missing parts
    give NULL rather than an error.
    """
    parts = F.split(F.col(url) if isinstance(url, str) else url, "/")
    first = F.try_element_at(parts, F.lit(4))
    parent = F.try_element_at(parts, F.lit(-2))
    folder = (F.when(F.size(parts) > deep_parts, F.concat(first, F.lit("/"), parent, F.lit("/")))
              .otherwise(F.concat(first, F.lit("/"))))
    return folder, F.try_element_at(parts, F.lit(-1))
