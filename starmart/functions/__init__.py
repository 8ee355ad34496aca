"""Column-level helpers built only from JVM-side ``pyspark.sql.functions``."""

from starmart.functions.codes import left_chars, recode, right_chars, zfill_code
from starmart.functions.dates import calendar_columns, date_id, parse_yyyymmdd

__all__ = ["calendar_columns", "date_id", "left_chars", "parse_yyyymmdd", "recode",
           "right_chars", "zfill_code"]
