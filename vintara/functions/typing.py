"""Tolerant typing: a value that does not parse becomes null, never an error.

All of it is safe with ANSI mode on, and none of it raises and catches a parser
exception for the values known to be dirty, which matters on billions of rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from vintara.functions.text import null_if_listed

# Fixed value: the smallest positive double.
SMALLEST = 5e-324

# Fixed value: ISO day, alone or followed by a time of day.
ISO_DAY = r"^\d{4}-\d{2}-\d{2}( \d{2}:\d{2}:\d{2}(\.\d+)?)?$"


def to_date(col: Column) -> Column:
    """Strict ``yyyy-MM-dd``; a trailing time of day is accepted and dropped.

    The pattern is checked first because a bare date cast also takes ``2022`` and
    ``2022-1-3``.
    """
    return F.when(col.rlike(ISO_DAY), F.substring(col, 1, 10).try_cast("date"))


def to_int(col: Column) -> Column:
    return col.try_cast("int")


def to_double(col: Column, sentinels: Iterable[str]) -> Column:
    """Double; the sentinels are taken out first, as a failed parse is expensive."""
    return null_if_listed(col, sentinels).try_cast("double")


def finite_nonzero(number: Column) -> Column:
    """Null for zero, NaN and infinities, which mark a position that is not known."""
    return F.when(F.abs(number).between(SMALLEST, sys.float_info.max), number)


def month_key(day: Column, undated: str = "000000") -> Column:
    """``yyyyMM`` partition key, with a fixed key for undated rows."""
    return F.coalesce(F.date_format(day, "yyyyMM"), F.lit(undated))


def day_key(day: Column) -> Column:
    """``yyyyMMdd`` as an integer, by arithmetic rather than by formatting."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
