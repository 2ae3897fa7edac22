"""Row rules. Each is a boolean Column that is never NULL."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def required(columns: Iterable[str]) -> Column:
    """All of the named columns hold a value."""
    return reduce(and_, (F.col(name).isNotNull() for name in columns))


def positive(column: str) -> Column:
    """Above zero and finite. NaN sorts above infinity in Spark, so it fails too."""
    value = F.col(column)
    return F.coalesce((value > 0) & (value < F.lit(float("inf"))), F.lit(False))


def domain(column: str, allowed: Iterable[str]) -> Column:
    """One of the allowed values; a missing value is not one of them."""
    return F.coalesce(F.col(column).isin(*allowed), F.lit(False))
