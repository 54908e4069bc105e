"""Row rules used by the cleaners."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c, fmt: str) -> Column:
    """Text to TIMESTAMP; text that does not fit the pattern becomes null (ANSI stays on)."""
    return F.try_to_timestamp(_c(c), F.lit(fmt))


def text_to_int(c) -> Column:
    """Blank, null or non-numeric text becomes null; ``45.0`` is 45 (a fraction is cut off); an
    int column passes through."""
    return F.coalesce(_c(c).try_cast("int"), _c(c).try_cast("double").try_cast("int"))


def null_if(c, cond: Column) -> Column:
    """Null out a value where ``cond`` holds (e.g. an implausible weight)."""
    return F.when(cond, F.lit(None)).otherwise(_c(c))


def null_unless_true(value, flag) -> Column:
    """Null out ``value`` when ``flag`` is false; a null flag keeps the value."""
    return F.when(_c(flag) == F.lit(False), F.lit(None)).otherwise(_c(value))
