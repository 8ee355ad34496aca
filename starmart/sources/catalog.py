"""Catalog work: databases, external table registration, listing and schema evolution.

Registering a table writes metadata only: the table points at the files where they
already are (``CREATE TABLE ... USING fmt LOCATION``), so cataloguing a large lake
costs a footer/schema read, not a copy. Reads go through ``spark.table`` and get the
same pruning and pushdown as a direct file scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.session import in_scope, scratch_path
from starmart.sources.files import CSV_DIALECT, csv_headers, feature_borders, feature_schema


def create_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    loc = f" LOCATION {sql_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`{loc}")


def _table_name(path: str) -> str:
    """Folder (or file stem) name as a table name: ``.../us_county/`` -> ``us_county``."""
    leaf = path.rstrip("/").split("/")[-1]
    leaf = leaf.split(".")[0] if "." in leaf else leaf
    return "".join(ch if ch.isalnum() else "_" for ch in leaf).lower()


def register_tables(spark: SparkSession, db: str, sources: Mapping[str, str | Sequence[str]],
                    fmt: str = "parquet", prefix: str = "",
                    options: Mapping[str, str] | None = None) -> list[str]:
    """Register external tables in ``db``; returns the qualified names.

    ``sources`` maps a name to one path, which becomes ``db.prefix+name``, or to a list of
    paths, each of which becomes its own table ``db.prefix+<folder name>`` (one table per
    crawled folder). Tables point at the files where they are; nothing is copied, and the
    schema comes from the files (Parquet footers, or CSV inference when asked for). CSV is
    read in the library's dialect. A name that already belongs to a managed table is
    refused: replacing that table would delete its rows. A known table whose files have the
    catalogued schema is switched to ``path`` in one catalog change; another schema is
    declared anew (``crawl`` changes it in place).
    """
    opts = {**(CSV_DIALECT | {"header": "true"} if fmt == "csv" else {}), **(options or {})}
    targets: list[tuple[str, str]] = []
    for name, path in sources.items():
        if isinstance(path, str):
            targets.append((f"{prefix}{name}", path))
        else:
            targets.extend((f"{prefix}{_table_name(p)}", p) for p in path)
    names = []
    for table, path in targets:
        qualified = f"`{db}`.`{table}`"
        opt_sql = "".join(f", {sql_text(k)} {sql_text(v)}" for k, v in opts.items())
        if not _switched(spark, qualified, path, fmt, opts):
            _drop_external(spark, qualified)
            spark.sql(f"CREATE TABLE {qualified} USING {fmt} OPTIONS (path {sql_text(path)}{opt_sql})")
        names.append(f"{db}.{table}")
    return names


def sql_text(value: str) -> str:
    """A string as a SQL literal."""
    inner = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{inner}'"


def _switched(spark: SparkSession, qualified: str, path: str, fmt: str, options: Mapping[str, str]) -> bool:
    """Point a known external table of the same format and schema at ``path``; whether that was so."""
    if not spark.catalog.tableExists(qualified) or spark.catalog.getTable(qualified).tableType != "EXTERNAL":
        return False
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {qualified}").collect()}
    found = spark.read.format(fmt).options(**options).load(path).schema
    same = [(f.name, f.dataType) for f in found.fields] == [(f.name, f.dataType) for f in spark.table(qualified).schema]
    if described.get("Provider", "").lower() != fmt or not same:
        return False
    spark.sql(f"ALTER TABLE {qualified} SET LOCATION {sql_text(path)}")
    spark.sql(f"REFRESH TABLE {qualified}")
    return True


def _drop_external(spark: SparkSession, qualified: str) -> None:
    """Forget an external table (its files stay); a managed one is refused."""
    if not spark.catalog.tableExists(qualified):
        return
    if spark.catalog.getTable(qualified).tableType == "MANAGED":
        raise ValueError(f"{qualified} is a managed table: dropping it would delete its rows")
    spark.sql(f"DROP TABLE IF EXISTS {qualified}")


def point_table(spark: SparkSession, db: str, name: str, path: str, fmt: str = "parquet") -> str:
    """Make ``db.name`` read the complete files at ``path``: created where it is missing,
    else switched to the new location in one catalog change, so readers always find a
    table and never a half-written one."""
    qualified = f"`{db}`.`{name}`"
    if not spark.catalog.tableExists(qualified):
        spark.sql(f"CREATE TABLE {qualified} USING {fmt} LOCATION {sql_text(path)}")
    else:
        if spark.catalog.getTable(qualified).tableType == "MANAGED":
            raise ValueError(f"{qualified} is a managed table and keeps its own location")
        spark.sql(f"ALTER TABLE {qualified} SET LOCATION {sql_text(path)}")
        spark.sql(f"REFRESH TABLE {qualified}")
    return f"{db}.{name}"


# Crawling. ``crawl`` brings catalogued tables up to date with the files that are there now.

_CRAWLER, _DEPRECATED = "starmart.crawler", "starmart.deprecated"
GONE = "deprecated: not in the files"

CRAWL_SCHEMA = "table_name STRING, column_name STRING, status STRING"


def _found_schema(spark: SparkSession, path: str, fmt: str, options: Mapping[str, str]) -> T.StructType | None:
    """Schema of the files now at ``path``, or ``None`` where there are none.

    Parquet: all footers merged. CSV: the longest header, of which all others must be beginnings
    (fields are taken by position). JSON: inferred.
    """
    try:
        if fmt == "parquet":
            return spark.read.options(**options).option("mergeSchema", "true").parquet(path).schema
        if fmt == "csv":
            headers = [tuple(r[0]) for r in csv_headers(spark, path).select("header").distinct().collect()]
            if not headers:
                return None
            widest = max(headers, key=len)
            if any(widest[:len(h)] != h for h in headers):
                raise ValueError(f"headers below {path} differ by more than columns at their end")
            if options.get("inferSchema", "false") != "true":
                return T.StructType([T.StructField(c, T.StringType()) for c in widest])
            # values are inferred by position over all files, shorter ones without the last columns
            names = ", ".join(f"`{c}` STRING" for c in widest)
            texts = spark.read.options(**{**options, "inferSchema": "false"}).schema(names).csv(path)
            where = scratch_path(spark, "csv-values")
            texts.write.options(**CSV_DIALECT).option("header", True).csv(where)
            return spark.read.options(**options).csv(where).schema
        return spark.read.format(fmt).options(**options).load(path).schema
    except AnalysisException as failure:
        if "PATH_NOT_FOUND" in str(failure) or "UNABLE_TO_INFER_SCHEMA" in str(failure):
            return None
        raise


def _properties(spark: SparkSession, qualified: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {qualified}").collect()}


def _set_properties(spark: SparkSession, qualified: str, **values: str) -> None:
    listed = ", ".join(f"{sql_text(k)} = {sql_text(v)}" for k, v in values.items())
    spark.sql(f"ALTER TABLE {qualified} SET TBLPROPERTIES ({listed})")


def _external(spark: SparkSession, qualified: str, path: str, fmt: str, schema: T.StructType,
              options: Mapping[str, str]) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    opt_sql = "".join(f", {sql_text(k)} {sql_text(v)}" for k, v in options.items())
    spark.sql(f"CREATE TABLE {qualified} ({columns}) USING {fmt} OPTIONS (path {sql_text(path)}{opt_sql})")


def crawl(spark: SparkSession, db: str, sources: Mapping[str, str], fmt: str = "parquet", prefix: str = "",
          options: Mapping[str, str] | None = None, crawler: str = "default") -> DataFrame:
    """Bring the external tables of ``db`` up to date with the files of ``sources`` (name -> path).

    Returns one row per table (``column_name`` NULL) and per column with its status. Tables are
    *added*, *updated*, *unchanged*, *restored* or *deprecated*; columns *added*, *unchanged*,
    *retyped*, *restored* or *deprecated*. Nothing that is catalogued is dropped: a column that no
    file has any more stays, reads as NULL and is marked by its comment; a table whose files are
    gone, or that this crawler no longer looks for, is marked by a property. New columns are
    added to the table in place, after the known ones, so readers always find it. Only a
    column whose type changed makes the table be declared anew (metadata only; Spark's session
    catalog cannot change a type), with all its columns, deprecated ones included.

    Only schemas and catalogue entries reach the driver.
    """
    opts = {**(CSV_DIALECT | {"header": "true"} if fmt == "csv" else {}), **(options or {})}
    report: list[tuple[str, str | None, str]] = []
    seen = set()
    with ThreadPoolExecutor(max_workers=8) as pool:   # schemas are read side by side
        look = in_scope(lambda path: _found_schema(spark, path, fmt, opts))
        schemas = dict(zip(sources, pool.map(look, sources.values())))
    for name, path in sources.items():
        table = f"{prefix}{name}"
        seen.add(table)
        qualified = f"`{db}`.`{table}`"
        found = schemas[name]
        known = spark.catalog.tableExists(qualified)
        if known and spark.catalog.getTable(qualified).tableType == "MANAGED":
            raise ValueError(f"{qualified} is a managed table: it is not described by files elsewhere")
        if found is None:
            if known:
                report.extend(_deprecate(spark, db, table))
            continue
        if not known:
            _external(spark, qualified, path, fmt, found, opts)
            _set_properties(spark, qualified, **{_CRAWLER: crawler})
            report += [(table, None, "added"), *[(table, f.name, "added") for f in found.fields]]
            continue
        report.extend(_update(spark, db, table, path, fmt, found, opts, crawler))
    for table in list_tables(spark, db):
        qualified = f"`{db}`.`{table}`"
        if table not in seen and spark.catalog.getTable(qualified).tableType == "EXTERNAL" \
                and _properties(spark, qualified).get(_CRAWLER) == crawler:
            report.extend(_deprecate(spark, db, table))
    return spark.createDataFrame(report, CRAWL_SCHEMA)


def _deprecate(spark: SparkSession, db: str, table: str) -> list[tuple[str, str | None, str]]:
    _set_properties(spark, f"`{db}`.`{table}`", **{_DEPRECATED: "true"})
    return [(table, None, "deprecated")]


def _update(spark: SparkSession, db: str, table: str, path: str, fmt: str, found: T.StructType,
            opts: Mapping[str, str], crawler: str) -> list[tuple[str, str | None, str]]:
    """One known table against the schema found now."""
    qualified = f"`{db}`.`{table}`"
    catalogued = spark.table(qualified).schema
    now = {f.name.lower(): f for f in found.fields}
    before = {f.name.lower(): f for f in catalogued.fields}
    status: dict[str, str] = {}
    for key, field in before.items():
        marked = (field.metadata or {}).get("comment") == GONE
        if key not in now:
            status[field.name] = "deprecated"
        elif now[key].dataType != field.dataType:
            status[field.name] = "retyped"
        else:
            status[field.name] = "restored" if marked else "unchanged"
    fresh = [f for k, f in now.items() if k not in before]
    status.update({f.name: "added" for f in fresh})
    properties = _properties(spark, qualified)
    if "retyped" in status.values():
        kept = [T.StructField(f.name, now[k].dataType if k in now else f.dataType) for k, f in before.items()]
        spark.sql(f"DROP TABLE {qualified}")
        _external(spark, qualified, path, fmt, T.StructType([*kept, *fresh]), opts)
    elif fresh:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh)
        spark.sql(f"ALTER TABLE {qualified} ADD COLUMNS ({added})")
    for column, state in status.items():
        if state in ("deprecated", "restored"):
            comment = GONE if state == "deprecated" else ""
            spark.sql(f"ALTER TABLE {qualified} ALTER COLUMN `{column}` COMMENT {sql_text(comment)}")
    _set_properties(spark, qualified, **{_CRAWLER: crawler, _DEPRECATED: "false"})
    spark.sql(f"REFRESH TABLE {qualified}")
    changed = set(status.values()) - {"unchanged"}
    if properties.get(_DEPRECATED) == "true":
        whole = "restored"
    else:
        whole = "updated" if changed else "unchanged"
    return [(table, None, whole), *[(table, c, state) for c, state in status.items()]]


def is_deprecated(spark: SparkSession, db: str, table: str) -> bool:
    """Whether the last crawl found no files of the table."""
    return _properties(spark, f"`{db}`.`{table}`").get(_DEPRECATED) == "true"


# Nested feeds.


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Paths of the columns below all structs; arrays and maps stay whole."""
    out = []
    for f in schema.fields:
        inner = (*path, f.name)
        out += _leaves(f.dataType, inner) if isinstance(f.dataType, T.StructType) else [inner]
    return out


def flat_columns(schema: T.StructType) -> dict[tuple[str, ...], str]:
    """Lower-case column name of every leaf: its own name, or its whole path joined by ``_`` where
    several leaves share the name."""
    leaves = _leaves(schema)
    short = [p[-1].lower() for p in leaves]
    return {p: s if short.count(s) == 1 else "_".join(p).lower() for p, s in zip(leaves, short)}


def register_geojson(spark: SparkSession, db: str, name: str, path: str, multiline: bool = False,
                     properties: T.StructType | None = None) -> str:
    """Catalogue a GeoJSON feed: an external table of its files and a flat view over it.

    ``db.<name>_features`` points at the files where they are; ``db.<name>`` has one row per
    feature: the properties by their lower-case names, and ``lon`` / ``lat`` of the point. The
    properties' schema is inferred unless given. FeatureCollection documents (``multiline``) are
    catalogued as text whose record separator is the border between their features, so the view
    reads a large document in byte ranges, as ``read_geojson`` does.
    """
    base, view = f"`{db}`.`{name}_features`", f"`{db}`.`{name}`"
    if multiline:
        borders = [r[0] for r in feature_borders(spark, path).select("border").distinct().collect()]
        kinds = [b for b in borders if b]
        if None in borders or len(kinds) != 1:
            raise ValueError(f"{path}: features need one opening with their type first to be catalogued")
        border = kinds[0]
        is_feature = "NOT value RLIKE '^(\\\\uFEFF)?\\\\s*\\\\{'"
        text = f"CASE WHEN {is_feature} THEN concat({sql_text(border)}, value) END"
        if properties is None:
            lines = (spark.read.option("lineSep", border).text(path).selectExpr(f"{text} AS value")
                     .where("value IS NOT NULL"))
            properties = _inferred_properties(spark, lines)
        feature = feature_schema(properties)
        options, fmt, columns = {"lineSep": border}, "text", "value STRING"
        rows = (f"SELECT f.* FROM (SELECT from_json({text}, {sql_text(feature.toDDL())}, "
                f"map('mode', 'FAILFAST')) AS f FROM {base} WHERE {is_feature})")
    else:
        if properties is None:
            inferred = spark.read.json(path).schema
            properties = inferred["properties"].dataType
        feature = feature_schema(properties)
        options, fmt, columns = {"mode": "FAILFAST"}, "json", feature.toDDL()
        rows = f"SELECT * FROM {base}"
    opt_sql = "".join(f", {sql_text(k)} {sql_text(v)}" for k, v in options.items())
    _drop_external(spark, base)
    spark.sql(f"CREATE TABLE {base} ({columns}) USING {fmt} OPTIONS (path {sql_text(path)}{opt_sql})")
    flat = ", ".join(f"{'.'.join(f'`{part}`' for part in ('properties', *leaf))} AS `{column}`"
                     for leaf, column in flat_columns(properties).items())
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {flat}, "
              f"try_element_at(geometry.coordinates, 1) AS lon, try_element_at(geometry.coordinates, 2) AS lat "
              f"FROM ({rows})")
    return f"{db}.{name}"


def _inferred_properties(spark: SparkSession, features: DataFrame) -> T.StructType:
    """Schema of the properties of feature texts, inferred over all of them."""
    where = scratch_path(spark, "features")
    # one JSON text a line; a line ends with its first object, whatever follows a feature in its record
    features.select(F.regexp_replace("value", "[\r\n]", " ").alias("value")).write.text(where)
    found = spark.read.option("mode", "FAILFAST").json(where).schema
    return found["properties"].dataType if "properties" in found.names else T.StructType([])


# Versions. Each published table has one external table of all its versions,
# ``<name>__versions``, partitioned by version; a partition is added when its files are
# complete. One view, ``published``, names the version in force. Every public name is a view
# that reads the partition the pointer names, so replacing the pointer, a single catalog
# change, switches all of them at once. The version is a constant to the optimizer: a read
# lists and scans that one partition's files only.

POINTER = "published"


def versions_table(name: str) -> str:
    return f"{name}__versions"


def add_version(spark: SparkSession, db: str, name: str, path: str, version: str, ddl: str,
                location: str) -> None:
    """Make the complete Parquet files at ``path`` the partition ``version`` of ``db.name``'s
    versions. No reader sees it until ``switch_version`` names it. ``ddl``: the columns;
    ``location``: the folder of the versions table."""
    table = f"`{db}`.`{versions_table(name)}`"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}, version STRING) USING parquet "
              f"PARTITIONED BY (version) LOCATION {sql_text(location)}")
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (version = {sql_text(version)}) "
              f"LOCATION {sql_text(path)}")


def switch_version(spark: SparkSession, db: str, version: str) -> None:
    """Make ``version`` the one that all views of ``db`` read, in one catalog change."""
    spark.sql(f"CREATE OR REPLACE VIEW `{db}`.`{POINTER}` AS SELECT {sql_text(version)} AS version")


def published_version(spark: SparkSession, db: str) -> str | None:
    """The version in force, or ``None`` before the first publish."""
    pointer = f"`{db}`.`{POINTER}`"
    return spark.table(pointer).first()["version"] if spark.catalog.tableExists(pointer) else None


def current_version_sql(db: str, name: str, pointer: str) -> str:
    """A table expression of the version that the one-row relation ``pointer`` names."""
    return f"(SELECT * FROM `{db}`.`{versions_table(name)}` WHERE version = (SELECT version FROM {pointer}))"


def version_view(spark: SparkSession, db: str, name: str, columns: Sequence[str]) -> str:
    """``db.name``: a view of the version in force. Defined once; an external table of that name
    (metadata only) makes way for it."""
    qualified = f"`{db}`.`{name}`"
    if spark.catalog.tableExists(qualified):
        if spark.catalog.getTable(qualified).tableType == "VIEW":
            return f"{db}.{name}"
        _drop_external(spark, qualified)
    listed = ", ".join(f"`{c}`" for c in columns)
    source = current_version_sql(db, name, f"`{db}`.`{POINTER}`")
    spark.sql(f"CREATE OR REPLACE VIEW {qualified} AS SELECT {listed} FROM {source}")
    return f"{db}.{name}"


def list_versions(spark: SparkSession, db: str, name: str) -> list[str]:
    """Versions of a published table, oldest first (their names begin with the time)."""
    rows = spark.sql(f"SHOW PARTITIONS `{db}`.`{versions_table(name)}`").collect()
    return sorted(r[0].split("=", 1)[1] for r in rows)


def drop_version(spark: SparkSession, db: str, name: str, version: str) -> str:
    """Forget one version; returns where its files are. The one in force is refused."""
    if version == published_version(spark, db):
        raise ValueError(f"version {version} of {db} is in force")
    table = f"`{db}`.`{versions_table(name)}`"
    where = spark.sql(f"DESCRIBE EXTENDED {table} PARTITION (version = {sql_text(version)})").collect()
    path = next(r["data_type"] for r in where if r["col_name"] == "Location")
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (version = {sql_text(version)})")
    return path


def list_tables(spark: SparkSession, db: str, pattern: str | None = None) -> list[str]:
    """Table names of ``db`` (optionally filtered by a ``*`` wildcard pattern)."""
    return sorted(t.name for t in spark.catalog.listTables(db, pattern))


def table_profile(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """(table_name, n_columns, n_rows) for catalogued tables: one count job per table."""
    parts = []
    for t in tables:
        df = spark.table(t)
        parts.append(df.agg(F.count(F.lit(1)).alias("n_rows"))
                       .select(F.lit(t.split(".")[-1]).alias("table_name"),
                               F.lit(len(df.columns)).alias("n_columns"), "n_rows"))
    return reduce(DataFrame.unionByName, parts)


def evolve_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of batches whose schemas grew over time: columns matched by name, columns
    missing from older batches become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_evolving(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Read batches written with growing schemas as one table (Parquet schema merge)."""
    return spark.read.format(fmt).option("mergeSchema", "true").load(list(paths))
