"""Instants written in the shapes of the feeds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def feed_instant(value: Column) -> Column:
    """The instant of `yyyy-MM-dd HH:mm:ss.fraction Z`, or with `+HHmm` / `-HHmm` for Z; null for anything else."""
    shape = r"^\s*(\d{4}-\d\d-\d\d) (\d\d:\d\d:\d\d(?:\.\d{1,9})?) ?(Z|[+-]\d\d:?\d\d)\s*$"
    return F.when(value.rlike(shape), F.regexp_replace(value, shape, "$1 $2$3").try_cast("timestamp"))


def utc_month(instant: Column) -> Column:
    """`yyyy-MM` of an instant in a session whose time zone is UTC."""
    return F.date_format(instant, "yyyy-MM")
