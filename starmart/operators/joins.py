"""Joins with explicit size discipline.

* ``join_distinct`` rewrites "join many-to-many, then de-duplicate" as "de-duplicate each
  side, then join": the de-duplication runs as a partial + final hash aggregate, so a hot
  key collapses map-side before any row is shuffled, and the join never materialises
  the product of the duplicates. Catalyst does not perform this rewrite on its own.
* ``lookup_join`` hints a broadcast only for a lookup whose few rows are proven by
  construction; otherwise the planner decides from measured bytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest bound by construction that is hinted for broadcast.
PROVEN_MAX_ROWS = 10_000


def join_distinct(left: DataFrame, right: DataFrame, on: Sequence[str],
                  how: str = "inner") -> DataFrame:
    """DISTINCT(left JOIN right USING on), computed without the many-to-many blow-up.

    Joining two duplicate-free inputs on ``USING`` columns yields duplicate-free output
    (every output row is one distinct (left row, right row) pair), so no aggregate is
    needed above the join.
    """
    return left.distinct().join(right.distinct(), on=list(on), how=how)


def first_per_group(df: DataFrame, group_col: str, value_col: str,
                    alias: str | None = None) -> DataFrame:
    """Smallest ``value_col`` per ``group_col``: the first value after sorting by it.

    NULL groups are dropped (as a grouped index drops them). Runs as a partial
    aggregate, so each map task ships at most one row per group.
    """
    return (df.where(F.col(group_col).isNotNull())
              .groupBy(group_col)
              .agg(F.min(value_col).alias(alias or value_col)))


def lookup_join(big: DataFrame, small: DataFrame, on: Sequence[str] | str,
                how: str = "inner", proven_rows: int | None = None) -> DataFrame:
    """Many-to-one join against a lookup.

    ``proven_rows`` is an upper bound on the lookup's rows that holds by construction (for
    example one row per two-character code); a lookup with such a bound of at most
    ``PROVEN_MAX_ROWS`` is broadcast. Any other is left to the planner, which broadcasts by
    measured bytes and splits skewed partitions at run time.
    """
    keys = [on] if isinstance(on, str) else list(on)
    proven = proven_rows is not None and proven_rows <= PROVEN_MAX_ROWS
    return big.join(F.broadcast(small) if proven else small, on=keys, how=how)
