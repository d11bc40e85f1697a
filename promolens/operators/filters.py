"""Row filters shared by the jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.constants import MARKETPLACE
from promolens.functions.timefmt import ds_bound, run_day

_OPS = {
    ">=": lambda a, b: a >= b,
    ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b,
    "<": lambda a, b: a < b,
}


def ds_window(bounds, analysis_date=None, ds: str = "ds") -> Column:
    """P5: lexical window on the text partition column.

    ``bounds`` is a sequence of ``(op, days_back, suffix)``; e.g.
    ``((">=", 2, ""), ("<", 0, ""))`` is ``ds >= 'T-2' AND ds < 'T'``."""
    preds = [_OPS[op](F.col(ds), ds_bound(analysis_date, days, suffix)) for op, days, suffix in bounds]
    return reduce(lambda a, b: a & b, preds)


def where_path(df: DataFrame, *paths: str) -> DataFrame:
    """Event type by path (equality or IN list); pushed to the scan."""
    return df.where(F.col("path") == paths[0] if len(paths) == 1 else F.col("path").isin(*paths))


def gmv_sales(bids: DataFrame) -> DataFrame:
    """Lines that count as sales value, on the main marketplace."""
    return bids.where((F.col("ite_gmv_flag") == 1) & (F.col("mkt_marketplace_id") == MARKETPLACE))


def day_before(analysis_date=None) -> Column:
    """``T - 1`` as a DATE."""
    return F.date_sub(run_day(analysis_date), 1)


def sold_on(bids: DataFrame, analysis_date=None) -> DataFrame:
    """Won on ``T - 1``."""
    return bids.where(F.col("tim_day_winning_date") == day_before(analysis_date))


def created_on(bids: DataFrame, analysis_date=None) -> DataFrame:
    """Order created on ``T - 1``."""
    return bids.where(F.col("ord_created_dt") == day_before(analysis_date))


def promo_flagged(bids: DataFrame) -> DataFrame:
    """Lines sold under a promotion that day."""
    return bids.where(F.col("ite_today_promotion_flag") == 1)
