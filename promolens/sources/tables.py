"""Readers for the three inputs and the staged touches.

``src`` may be a DataFrame, a table name, or a Parquet path.  The click-stream
is expected as Parquet partitioned by the text column ``ds``; filters on
``ds`` then prune partitions, and nested-field projections reach the scan's
``ReadSchema``.  Struct columns are left alone so that extra nested fields in
real data do not break the read; see ``conform`` for the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promolens.sources.schemas import BIDS_SCHEMA, CUSTOMERS_SCHEMA, TEXT_AS, TOUCH_SCHEMA


def _load(spark: SparkSession, src) -> DataFrame:
    if isinstance(src, DataFrame):
        return src
    if "/" in src or ":" in src:
        return spark.read.parquet(src)
    return spark.table(src)


def conform(df: DataFrame, schema: T.StructType, optional: tuple = ()) -> DataFrame:
    """Columns of ``schema`` by name (in any case), other columns kept.

    Text is read as the declared type, exactly: a value that is no number, or
    would have to be rounded or cut to become one of that type, stops the job.
    Columns that are numbers already keep their type, so no price or quantity is
    rounded; dates and times become the declared type."""
    have = {f.name.lower(): f for f in df.schema.fields}
    out = []
    for f in schema.fields:
        src = have.get(f.name.lower())
        if src is None:
            if f.name in optional:
                continue
            raise ValueError(f"missing column {f.name}")
        c = F.col(src.name)
        both_numbers = isinstance(src.dataType, T.NumericType) and isinstance(f.dataType, T.NumericType)
        if not isinstance(f.dataType, T.StructType) and src.dataType != f.dataType and not both_numbers:
            kind = TEXT_AS.get(f.name, f.dataType)
            c = _exact(c, kind, f.name) if isinstance(kind, T.NumericType) else c.cast(kind)
        out.append(c.alias(f.name))
    known = {f.name.lower() for f in schema.fields}
    rest = [F.col(f.name) for f in df.schema.fields if f.name.lower() not in known]
    return df.select(*out, *rest)


#: Wider than any declared type, to compare with, and more decimals than it holds.
_WIDE, _BEYOND = T.DecimalType(38, 18), r"\.[0-9]{18}[0-9]*[1-9]"


def _exact(text: Column, kind: T.DataType, name: str) -> Column:
    """``text`` as a number of that type that is equal to it; other text is an error, null stays null."""
    text = F.trim(text.cast("string"))
    value = (text.try_cast(_WIDE) if isinstance(kind, T.IntegralType) else text).try_cast(kind)
    same = (value.try_cast(_WIDE) == text.try_cast(_WIDE)) & ~text.rlike(_BEYOND)
    wrong = F.raise_error(F.concat(F.lit(f"{name}: not an exact {kind.simpleString()}: "), text))
    return F.when(text.isNull(), F.lit(None)).when(F.coalesce(same, F.lit(False)), value).otherwise(wrong).cast(kind)


def read_tracks(spark: SparkSession, src) -> DataFrame:
    """The click-stream (nested columns, text partition ``ds``)."""
    return _load(spark, src)


def read_bids(spark: SparkSession, src) -> DataFrame:
    """Sale lines, one row per (order, item)."""
    return conform(_load(spark, src), BIDS_SCHEMA)


def read_customers(spark: SparkSession, src) -> DataFrame:
    """Customer dimension."""
    return conform(_load(spark, src), CUSTOMERS_SCHEMA)


def read_touches(spark: SparkSession, src) -> DataFrame:
    """Promotion touches staged by ``stage_touches``."""
    return conform(_load(spark, src), TOUCH_SCHEMA, optional=("user_id",))


def test_customers(customers: DataFrame) -> DataFrame:
    """S3: ids of test accounts (``is_test = 'true'``; a boolean column works too)."""
    return customers.where(F.col("is_test").cast("string") == F.lit("true")).select("cus_cust_id")
