"""Date expressions. The reference day is always a parameter, so results repeat."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowfold.functions.arithmetic import floor_div

ISO_DATE = "yyyy-MM-dd"


def parse_date(column: Column, pattern: str = ISO_DATE) -> Column:
    return F.to_date(column, pattern)


def format_date(column: Column, pattern: str = ISO_DATE) -> Column:
    return F.date_format(column, pattern)


def age_in_years(born: Column, as_of: Column | str) -> Column:
    """Whole 365-day years from ``born`` to ``as_of``."""
    day = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    return floor_div(F.datediff(day, born), F.lit(365)).cast("int")
