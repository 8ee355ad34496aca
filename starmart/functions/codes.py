"""Geographic code conformance: numeric codes to zero-padded text and back apart.

All helpers return Column expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zfill_code(c: str | Column, width: int) -> Column:
    """Number (possibly float-typed, e.g. ``1001.0``) to zero-padded text of ``width``.

    Matches Python's ``str(int(x)).zfill(width)``: the value is truncated to an integer,
    a leading minus sign stays in front of the padding, and text already at least
    ``width`` long is returned unchanged (``lpad`` alone would cut it). NULL stays NULL.
    """
    text = _col(c).cast("bigint").cast("string")
    digits = F.substring(text, 2, 1 << 30)
    return (
        F.when(F.length(text) >= width, text)
        .when(text.startswith("-"), F.concat(F.lit("-"), F.lpad(digits, width - 1, "0")))
        .otherwise(F.lpad(text, width, "0"))
    )


def left_chars(c: str | Column, n: int) -> Column:
    """First ``n`` characters (shorter text is returned whole)."""
    return F.substring(_col(c), 1, n)


def right_chars(c: str | Column, n: int) -> Column:
    """Last ``n`` characters (shorter text is returned whole)."""
    return F.right(_col(c), F.lit(n))


def recode(c: str | Column, mapping: dict[str, str]) -> Column:
    """Replace listed values, keep every other value (and NULL) as it is."""
    column = _col(c)
    out = None
    for old, new in mapping.items():
        out = (F.when(column == old, F.lit(new)) if out is None
               else out.when(column == old, F.lit(new)))
    return column if out is None else out.otherwise(column)
