"""Projection, renaming, null handling and row filters with explicit null semantics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Column subset / reorder to a target layout."""
    return df.select(*[F.col(c) for c in cols])


def copy_column(df: DataFrame, src: str, dst: str, drop_src: bool = False) -> DataFrame:
    """Derive ``dst`` as a copy of ``src``; optionally drop the source afterwards."""
    out = df.withColumn(dst, F.col(src))
    return out.drop(src) if drop_src else out


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by name; unknown names are an error rather than a silent no-op."""
    missing = [k for k in mapping if k not in df.columns]
    if missing:
        raise ValueError(f"cannot rename missing columns {missing}")
    return df.withColumnsRenamed(dict(mapping))


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename by position, as a headerless bulk load into a typed table does."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def promote_header(df: DataFrame, header: Sequence[str]) -> DataFrame:
    """Turn the data row holding the column names into the header.

    Rows carry no order in Spark, so the header row is identified by its values, not by
    its position: every row equal to ``header`` is removed. For files whose first line is
    the header, read them with ``header=True`` instead.
    """
    if len(header) != len(df.columns):
        raise ValueError("header length does not match the column count")
    is_header = None
    for c, name in zip(df.columns, header):
        cond = F.col(c).eqNullSafe(F.lit(name))
        is_header = cond if is_header is None else (is_header & cond)
    return df.where(~is_header).toDF(*header)


def preview(df: DataFrame, order_cols: Sequence[str | Column], n: int = 5) -> DataFrame:
    """First ``n`` rows under a total order (planned as a distributed top-k)."""
    return df.orderBy(*order_cols).limit(n)


def filter_not_equal_keep_null(df: DataFrame, col: str, value) -> DataFrame:
    """Drop rows whose ``col`` equals ``value`` but keep rows where ``col`` is NULL.

    This is the null semantics of a pandas ``!=`` mask; SQL ``col <> value`` would
    drop the NULL rows too.
    """
    return df.where(~F.col(col).eqNullSafe(F.lit(value)))


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any of ``subset``."""
    return df.dropna(how="any", subset=list(subset))


def fill_numeric_zero(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULL -> 0 in numeric columns (text and boolean columns are left as they are)."""
    return df.fillna(0, subset=list(cols) if cols else None)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Exact duplicate removal (partial aggregation happens before the shuffle)."""
    return df.distinct()
