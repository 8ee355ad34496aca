"""Constraint reports: primary-key duplicates, foreign-key orphans, NOT NULL and length.

Spark's file tables do not enforce PRIMARY KEY / FOREIGN KEY / NOT NULL, so the
declarations of a ``TableSpec`` become queries that return the violations. Each report
is one aggregate or one anti join; nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.schemas import TableSpec


def duplicate_keys(df: DataFrame, key_cols: Sequence[str], count_col: str = "n_rows") -> DataFrame:
    """Key values that occur more than once, with their row counts."""
    return (df.groupBy(*key_cols)
              .agg(F.count(F.lit(1)).alias(count_col))
              .where(F.col(count_col) > 1))


def orphans(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent row (a left anti join)."""
    keys = parent.select(F.col(parent_col).alias("__sm_parent_key")).distinct()
    return (child.where(F.col(child_col).isNotNull())
                 .join(keys, F.col(child_col) == F.col("__sm_parent_key"), "left_anti"))


def orphan_counts(child: DataFrame, child_name: str,
                  parents: Sequence[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """One row per foreign key: (child_table, fk_column, parent_table, n_orphans).

    ``parents`` holds (child column, parent DataFrame, parent table name, parent column).
    The child is evaluated once, whatever the number of its keys: its key columns become rows of
    (key name, value), which are counted first (a hot key leaves each task as one row); the
    few distinct values meet the parents' keys in one anti join, and the counts of those
    without a parent are summed.
    """
    kinds = dict(child.dtypes)
    columns = list(dict.fromkeys(c for c, *_ in parents))
    listed = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
    by_key = (child.selectExpr(f"stack({len(columns)}, {listed}) AS (fk, value)").where("value IS NOT NULL")
              .groupBy("fk", "value").agg(F.count(F.lit(1)).alias("n")))
    keys = [parent.select(F.lit(i).alias("i"), F.lit(c).alias("fk"), F.col(pc).cast(kinds[c]).cast("string").alias("value"))
            for i, (c, parent, _, pc) in enumerate(parents)]
    known = reduce(DataFrame.unionByName, keys).distinct()
    # the foreign keys of a column (it may refer to several parents), by their numbers
    numbers = {c: [i for i, (other, *_) in enumerate(parents) if other == c] for c in columns}
    of = F.create_map(*[x for c, n in numbers.items() for x in (F.lit(c), F.array(*map(F.lit, n)))])
    asked = by_key.select(F.explode(of[F.col("fk")]).alias("i"), "fk", "value", "n")
    lost = asked.join(known, ["i", "fk", "value"], "left_anti").select("i", "n")
    every = child.sparkSession.range(len(parents), numPartitions=1).select(
        F.col("id").cast("int").alias("i"), F.lit(0).cast("bigint").alias("n"))
    text = lambda values: F.get(F.array(*map(F.lit, values)), F.col("i"))
    return lost.unionByName(every).groupBy("i").agg(F.sum("n").alias("n_orphans")).select(
        F.lit(child_name).alias("child_table"), text([c for c, *_ in parents]).alias("fk_column"),
        text([name for _, _, name, _ in parents]).alias("parent_table"), "n_orphans")


def column_violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """NULLs in NOT NULL columns and over-long text, one output row per column.

    A declared length counts bytes (of UTF-8), as the warehouse's VARCHAR does, so a text
    with letters beyond ASCII may be too long (``n_too_long``) though its characters are not too
    many (``n_too_many_chars``). A single pass computes every counter (one partial + final
    aggregate), then the one-row result is unpivoted into (table_name, column_name, n_null,
    n_too_long, n_too_many_chars).
    """
    aggs = []
    for c in spec.columns:
        n_null = (F.count_if(F.col(c.name).isNull()) if c.not_null
                  else F.lit(0).cast("bigint"))
        text = F.col(c.name).cast("string")
        none = F.lit(0).cast("bigint")
        n_long = F.count_if(F.octet_length(text) > c.max_len) if c.max_len else none
        n_chars = F.count_if(F.length(text) > c.max_len) if c.max_len else none
        aggs += [n_null.alias(f"{c.name}__null"), n_long.alias(f"{c.name}__long"),
                 n_chars.alias(f"{c.name}__chars")]
    wide = df.agg(*aggs)
    stack_args = ", ".join(
        f"'{c.name}', `{c.name}__null`, `{c.name}__long`, `{c.name}__chars`" for c in spec.columns)
    return wide.selectExpr(
        f"'{spec.name}' AS table_name",
        f"stack({len(spec.columns)}, {stack_args}) AS (column_name, n_null, n_too_long, n_too_many_chars)")
