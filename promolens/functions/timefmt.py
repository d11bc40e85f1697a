"""Time text helpers.

The click-stream keeps time as text: ``server_timestamp`` is ISO-like
(``2024-01-02T10:00:07.000-04:00``) and the hourly partition ``ds`` is
``yyyy-MM-dd HH``.  The reference compares these as strings, so the helpers
produce canonical ``yyyy-MM-dd HH:mm:ss`` text and never reinterpret zones.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from promolens.constants import LOOKBACK_SECONDS, TIME_FORMAT


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Helpers accept a Column or a SQL expression string (a column name is one).
# For strings the whole expression is built with one ``F.expr`` call: the same
# expression tree, far fewer driver round trips while a plan is assembled.


def _as_date(analysis_date):
    if isinstance(analysis_date, str):
        return _dt.date.fromisoformat(analysis_date)
    return analysis_date


def run_day(analysis_date=None) -> Column:
    """The run date T as a DATE column: a literal, a column, or today."""
    if analysis_date is None:
        return F.current_date()
    if isinstance(analysis_date, Column):
        return analysis_date
    return F.lit(_as_date(analysis_date))


def server_time_sql(c: str = "server_timestamp") -> str:
    return f"concat(substring({c}, 1, 10), ' ', substring({c}, 12, 8))"


def server_time(c: str = "server_timestamp") -> Column:
    """Event time as ``yyyy-MM-dd HH:mm:ss``: characters 1-10 and 12-19 of the
    ISO text; fraction and offset are dropped as in the reference."""
    return F.expr(server_time_sql(c))


def minus_lookback(time_text: str, seconds: int = LOOKBACK_SECONDS) -> Column:
    """The text that the SQL expression ``time_text`` gives, minus exactly
    ``seconds`` seconds, as text.

    Parsed strictly; text that does not parse gives null (never an error).
    Seconds arithmetic, not a calendar interval, so a DST change cannot turn
    24 h into a calendar day."""
    return F.expr(f"from_unixtime(unix_timestamp(try_to_timestamp({time_text}, '{TIME_FORMAT}')) "
                  f"- {int(seconds)}, '{TIME_FORMAT}')")


_CANONICAL = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} ([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$"


def wall_seconds_sql(c: str) -> str:
    """Seconds since 1970-01-01 00:00:00 of the wall-clock text ``c``, as SQL.

    Null unless the text is a canonical ``yyyy-MM-dd HH:mm:ss`` of a day that
    exists.  No time zone takes part, so text inside a clock-change gap counts
    like any other.  For such text, string order equals the order of this
    number, which lets a string range predicate be bucketed exactly."""
    return (f"CASE WHEN {c} RLIKE '{_CANONICAL}' "
            f"THEN CAST(unix_date(try_cast(substring({c}, 1, 10) AS DATE)) AS BIGINT) * 86400 "
            f"+ CAST(substring({c}, 12, 2) AS BIGINT) * 3600 "
            f"+ CAST(substring({c}, 15, 2) AS BIGINT) * 60 "
            f"+ CAST(substring({c}, 18, 2) AS BIGINT) END")


def hour_of(hhmmss) -> Column:
    """Two-digit hour of an ``HHMMSS`` number stored without leading zeros
    (93015 -> '09'), for integer, decimal or floating input."""
    if isinstance(hhmmss, str):
        return F.expr(f"lpad(CAST(floor({hhmmss} / 10000) AS STRING), 2, '0')")
    return F.lpad(F.floor(_col(hhmmss) / 10000).cast("string"), 2, "0")


def hour_label(day, hhmmss) -> Column:
    """``yyyy-MM-dd HH`` label of a sale from its day and ``HHMMSS`` time."""
    if isinstance(day, str) and isinstance(hhmmss, str):
        return F.expr(f"concat(CAST({day} AS STRING), ' ', lpad(CAST(floor({hhmmss} / 10000) AS STRING), 2, '0'))")
    return F.concat(_col(day).cast("string"), F.lit(" "), hour_of(hhmmss))


def ds_bound(analysis_date, days_back: int, suffix: str = " 00") -> Column:
    """Text bound for the ``ds`` partition: ``(T - days_back)`` plus a suffix.

    ``suffix=''`` gives a bare date: lexically ``ds >= 'yyyy-MM-dd'`` keeps
    the whole day, ``ds < 'yyyy-MM-dd'`` drops it.  For a literal date the
    expression folds to a constant, so the bound reaches ``PartitionFilters``."""
    if isinstance(analysis_date, (_dt.date, str)):
        text = (_as_date(analysis_date) - _dt.timedelta(days=days_back)).isoformat()
        return F.lit(text + suffix)
    day = F.date_sub(run_day(analysis_date), days_back).cast("string")
    return F.concat(day, F.lit(suffix)) if suffix else day
