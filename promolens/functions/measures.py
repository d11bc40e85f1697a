"""Measure helpers: value = price x quantity, conditional measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def value(price="bid_base_current_price", quantity="bid_quantity_ok") -> Column:
    """Sales value of a line: price x quantity (exact decimal arithmetic)."""
    return _col(price) * _col(quantity)


def when_flag(flag, measure) -> Column:
    """``measure`` where ``flag = 1``, else 0 (a null flag counts as not set)."""
    return F.when(_col(flag) == 1, _col(measure)).otherwise(F.lit(0))
