"""Row-level measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def inflow(kind: Column, amount: Column) -> Column:
    """What a transaction brings into a fund: the amount of a BUY, else 0."""
    return F.when(kind == "BUY", amount).otherwise(0)


def outflow(kind: Column, amount: Column) -> Column:
    """What a transaction takes out of a fund: the amount of a SELL, else 0."""
    return F.when(kind == "SELL", amount).otherwise(0)


def signed_amount(kind: Column, amount: Column) -> Column:
    """Net effect on a fund: BUY counts up, SELL down, any other type 0.

    Linear in ``amount``, so it holds for single rows and for the total of all
    rows of one type alike.
    """
    return inflow(kind, amount) - outflow(kind, amount)


def daily_return(opening: Column, closing: Column) -> Column:
    """Percent change from opening to closing price, rounded to 4 places.

    Both prices are the published, already rounded ones. An opening price that
    rounds to 0 gives NULL.
    """
    return F.round(F.try_divide(closing - opening, opening) * 100, 4)
