"""Join-key helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def item_key(site, item) -> Column:
    """Site-qualified item id as the click-stream writes it: ``trim(site || item)``."""
    return F.trim(F.concat(_col(site), _col(item).cast("string")))


def key_text(df: DataFrame, name: str) -> Column:
    """A key column as text, so that keys of different types (a string login id
    against a numeric customer id) compare without an ANSI cast error.  Whole
    numbers of any numeric type give their digits only (7.0 -> '7')."""
    c, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        whole = c.try_cast("decimal(38,0)")
        return F.when(c == F.floor(c), whole.cast("string")).otherwise(c.cast("string"))
    return c.cast("string")
