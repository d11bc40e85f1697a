"""Registered queries: each runs one operator or job of the package over the
inputs derived from the benchmark tables (``sources.fixtures``), stored once
per session as Parquet tables (the click-stream partitioned by ``ds``).

Run date for single-day queries: 2024-01-03 (reports cover 2024-01-02, the
busiest day of the sf0.01 data); backfills cover the day after each day on
which orders of the sale lines were created.  Output columns are normalised for comparison: integral numbers
as BIGINT, other numbers as DOUBLE."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promolens.operators.extract import (
    collapse_origin, exclude_test_buyers, extract_orders, extract_touches, sales_lines,
)
from promolens.plans.mart import (
    attributed_sales, backfill, created_days, daily_mart, promo_sales, site_sales,
)
from promolens.plans.profiles import DAILY, GMV_REPORT, HISTORY, VOLUME_REPORT
from promolens.plans.reports import SITE_HOUR, gmv_report, order_touch_counts, volume_report
from promolens.session import checkpoint_dir
from promolens.sources import fixtures
from promolens.sources.mart import (
    append_mart, create_mart_table, read_mart, remove_staged, stage_touches, write_mart_run,
)
from promolens.sources.tables import test_customers as _test_customers

ANALYSIS_DATE = _dt.date(2024, 1, 3)

HISTORY_ORIGIN = HISTORY.but(pin_win_day=True)


def normalise(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        t = f.dataType
        if isinstance(t, T.DecimalType):
            c = c.cast("long") if t.scale == 0 else c.cast("double")
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _in(spark, sf_dir):
    return fixtures.stored_inputs(spark, sf_dir)


def q_touches_gmv(spark, sf_dir):
    return extract_touches(_in(spark, sf_dir)["tracks"], ANALYSIS_DATE, GMV_REPORT)


def q_touches_volume(spark, sf_dir):
    return extract_touches(_in(spark, sf_dir)["tracks"], ANALYSIS_DATE, VOLUME_REPORT)


def q_touches_staged(spark, sf_dir):
    return extract_touches(_in(spark, sf_dir)["tracks"], ANALYSIS_DATE, DAILY)


def q_touches_global(spark, sf_dir):
    return collapse_origin(extract_touches(_in(spark, sf_dir)["tracks"], ANALYSIS_DATE, DAILY))


def q_orders_gmv(spark, sf_dir):
    return extract_orders(_in(spark, sf_dir)["tracks"], ANALYSIS_DATE, GMV_REPORT)


def q_orders_volume(spark, sf_dir):
    i = _in(spark, sf_dir)
    return extract_orders(i["tracks"], ANALYSIS_DATE, VOLUME_REPORT, test_buyers=_test_customers(i["customers"]))


def q_orders_staged(spark, sf_dir):
    return extract_orders(_in(spark, sf_dir)["tracks"], ANALYSIS_DATE, DAILY)


def q_sales_lines(spark, sf_dir):
    return sales_lines(_in(spark, sf_dir)["bids"], ANALYSIS_DATE)


def q_test_customers(spark, sf_dir):
    return _test_customers(_in(spark, sf_dir)["customers"])


def q_orders_without_test_buyers(spark, sf_dir):
    """All order-created events (every day) minus those of test accounts."""
    i = _in(spark, sf_dir)
    ev = i["tracks"].where(F.col("path") == "/orders/ordercreated")
    kept = exclude_test_buyers(ev, _test_customers(i["customers"]))
    return kept.select(F.col("usr.user_id").alias("user_id"), F.col("event_data"), F.col("ds"))


def q_order_touch_counts(spark, sf_dir):
    tr = _in(spark, sf_dir)["tracks"]
    touches = extract_touches(tr, ANALYSIS_DATE, GMV_REPORT)
    orders = extract_orders(tr, ANALYSIS_DATE, GMV_REPORT)
    return order_touch_counts(touches, orders, compare=GMV_REPORT.compare)


def q_gmv_report(spark, sf_dir):
    i = _in(spark, sf_dir)
    return gmv_report(i["tracks"], i["bids"], ANALYSIS_DATE)


def q_gmv_report_site_hour(spark, sf_dir):
    """Coarse site x hour grain, order ids joined as trimmed text."""
    i = _in(spark, sf_dir)
    return gmv_report(i["tracks"], i["bids"], ANALYSIS_DATE, grain=SITE_HOUR, order_key="text")


def q_volume_report(spark, sf_dir):
    i = _in(spark, sf_dir)
    return volume_report(i["tracks"], i["customers"], ANALYSIS_DATE)


def q_history_origin(spark, sf_dir):
    i = _in(spark, sf_dir)
    return attributed_sales(i["tracks"], i["bids"], ANALYSIS_DATE, HISTORY_ORIGIN, "origin", stage_path=_scratch(spark, "lines"))


def q_history_global(spark, sf_dir):
    i = _in(spark, sf_dir)
    return attributed_sales(i["tracks"], i["bids"], ANALYSIS_DATE, HISTORY, "global", stage_path=_scratch(spark, "lines"))


def q_daily_origin(spark, sf_dir):
    i = _in(spark, sf_dir)
    return attributed_sales(i["tracks"], i["bids"], ANALYSIS_DATE, DAILY, "origin", stage_path=_scratch(spark, "lines"))


def q_daily_global(spark, sf_dir):
    i = _in(spark, sf_dir)
    return attributed_sales(i["tracks"], i["bids"], ANALYSIS_DATE, DAILY, "global", stage_path=_scratch(spark, "lines"))


def q_daily_origin_once(spark, sf_dir):
    """Each line and order event credited once for each origin, however many touches it has."""
    i = _in(spark, sf_dir)
    return attributed_sales(i["tracks"], i["bids"], ANALYSIS_DATE, DAILY, "origin", stage_path=_scratch(spark, "lines"),
                            dedup_touches=True)


def q_backfill_global_once(spark, sf_dir):
    """The history of all runs, a line credited once for each order event and touch platform."""
    return _backfill(spark, sf_dir, "global", dedup_touches=True)


def q_daily_mart_today(spark, sf_dir):
    """The daily job without a date: it runs for today, on inputs moved so that the usual run date is today."""
    today = spark.sql("SELECT current_date()").first()[0]
    i = fixtures.stored_inputs(spark, sf_dir, (today - ANALYSIS_DATE).days)
    return daily_mart(i["tracks"], i["bids"], stage_path=_scratch(spark, "staged"))


def q_promo_sales(spark, sf_dir):
    return promo_sales(_in(spark, sf_dir)["bids"], ANALYSIS_DATE)


def q_site_sales(spark, sf_dir):
    return site_sales(_in(spark, sf_dir)["bids"], ANALYSIS_DATE)


def _scratch(spark, prefix):
    """A fresh folder under the session's checkpoint folder (shared storage)."""
    import uuid
    return f"{checkpoint_dir(spark).rstrip('/')}/{prefix}-{uuid.uuid4().hex}"


def q_daily_mart(spark, sf_dir):
    """The daily job: touches staged once in the checkpoint folder, four families."""
    i = _in(spark, sf_dir)
    return daily_mart(i["tracks"], i["bids"], ANALYSIS_DATE, stage_path=_scratch(spark, "staged"))


def q_mart_round_trip(spark, sf_dir):
    """Write the daily mart (append, partitioned by ``fecha``) under the
    session's checkpoint folder and read it back with the mart schema."""
    i = _in(spark, sf_dir)
    path, staged = _scratch(spark, "mart"), _scratch(spark, "staged")
    append_mart(daily_mart(i["tracks"], i["bids"], ANALYSIS_DATE, stage_path=staged), path)
    remove_staged(spark, staged)
    return read_mart(spark, path)


def _run_twice(spark, sf_dir, target):
    """The daily job as the same run, and a run of another day in between and its rows removed again by
    an empty rerun: a rerun replaces its own run and nothing else."""
    i = _in(spark, sf_dir)
    staged, other = _scratch(spark, "staged"), ANALYSIS_DATE + _dt.timedelta(days=1)
    mart = daily_mart(i["tracks"], i["bids"], ANALYSIS_DATE, stage_path=staged)
    write_mart_run(mart, target, ANALYSIS_DATE)
    another = site_sales(i["bids"], other)
    write_mart_run(another, target, other)
    write_mart_run(another.limit(0), target, other)
    write_mart_run(mart, target, ANALYSIS_DATE)
    remove_staged(spark, staged)
    return read_mart(spark, target)


def q_mart_run(spark, sf_dir):
    """The daily mart written twice as the same run, into a folder that the
    second write replaces, and read back."""
    return _run_twice(spark, sf_dir, _scratch(spark, "runs"))


def _table(prefix):
    import uuid
    return f"{prefix}_{uuid.uuid4().hex}"


def q_mart_table_run(spark, sf_dir):
    """The same into a catalog table partitioned by run date and day."""
    table = _table("mart_runs")
    create_mart_table(spark, table, _scratch(spark, "runs"), by_run=True)
    return _run_twice(spark, sf_dir, table)


def q_mart_external(spark, sf_dir):
    """The mart as an external table: written by path, registered, and read from the catalog."""
    i = _in(spark, sf_dir)
    path, staged, table = _scratch(spark, "mart"), _scratch(spark, "staged"), _table("mart")
    create_mart_table(spark, table, path)
    append_mart(daily_mart(i["tracks"], i["bids"], ANALYSIS_DATE, stage_path=staged), path, table)
    remove_staged(spark, staged)
    return read_mart(spark, table)


def q_touches_reread(spark, sf_dir):
    """Touches staged as Parquet and read again."""
    return stage_touches(extract_touches(_in(spark, sf_dir)["tracks"], ANALYSIS_DATE, DAILY), _scratch(spark, "staged"))


def _backfill(spark, sf_dir, by, **options):
    i = _in(spark, sf_dir)
    dates = [d + _dt.timedelta(days=1) for d in created_days(i["bids"])]
    return backfill(i["tracks"], i["bids"], dates, by=by, stage_path=_scratch(spark, "lines"), **options)


def q_backfill_origin(spark, sf_dir):
    return _backfill(spark, sf_dir, "origin")


def q_backfill_global(spark, sf_dir):
    return _backfill(spark, sf_dir, "global")


_QUERIES = {
    "touches_gmv": q_touches_gmv,
    "touches_volume": q_touches_volume,
    "touches_staged": q_touches_staged,
    "touches_global": q_touches_global,
    "orders_gmv": q_orders_gmv,
    "orders_volume": q_orders_volume,
    "orders_staged": q_orders_staged,
    "sales_lines": q_sales_lines,
    "test_customers": q_test_customers,
    "orders_without_test_buyers": q_orders_without_test_buyers,
    "order_touch_counts": q_order_touch_counts,
    "gmv_report": q_gmv_report,
    "gmv_report_site_hour": q_gmv_report_site_hour,
    "volume_report": q_volume_report,
    "history_origin": q_history_origin,
    "history_global": q_history_global,
    "daily_origin": q_daily_origin,
    "daily_global": q_daily_global,
    "daily_origin_once": q_daily_origin_once,
    "promo_sales": q_promo_sales,
    "site_sales": q_site_sales,
    "daily_mart": q_daily_mart,
    "mart_round_trip": q_mart_round_trip,
    "daily_mart_today": q_daily_mart_today,
    "mart_run": q_mart_run,
    "mart_table_run": q_mart_table_run,
    "mart_external": q_mart_external,
    "touches_reread": q_touches_reread,
    "backfill_origin": q_backfill_origin,
    "backfill_global": q_backfill_global,
    "backfill_global_once": q_backfill_global_once,
}


def queries():
    """name -> callable(spark, sf_dir) -> DataFrame (normalised types)."""
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return normalise(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run
    return {k: wrap(v) for k, v in _QUERIES.items()}
