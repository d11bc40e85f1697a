import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from promolens.sources.schemas import BIDS_SCHEMA, CUSTOMERS_SCHEMA, TRACKS_SCHEMA  # noqa: E402

CAROUSEL = '{"c_id":"/home/carousel/card"}'
DEAL = '{"deal_print_id":"7"}'


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]").appName("promolens-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.ui.enabled", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="promolens-test-ckpt-"))
    yield s


def iso(text):
    """'2024-01-02 10:00:00' -> server timestamp text."""
    return text[:10] + "T" + text[11:19] + ".000-04:00"


def view(site="S0", platform="web", uid="u1", user_id="1", fragment=DEAL, item="S01", at="2024-01-02 10:00:00",
         path="/vip", key="item_id", event_data=None):
    data = event_data if event_data is not None else '{"%s":"%s"}' % (key, item)
    return ((site,), (platform,), (uid, user_id), (fragment,), data, iso(at) if at else None, path,
            at[:13] if at else None)


def order(order_id=1, site="S0", platform="web", uid="u1", user_id="1", item="S01", qty=2, amount="10.50",
          status="F", at="2024-01-02 12:00:00", event_data=None):
    data = event_data if event_data is not None else (
        '{"order_id":%s,"status":"%s","total_amount_usd":%s,"items":[{"item":{"id":"%s"},"quantity":%s}]}'
        % (order_id, status, amount, item, qty))
    return ((site,), (platform,), (uid, user_id), ("{}",), data, iso(at), "/orders/ordercreated", at[:13])


def tracks_df(spark, rows):
    return spark.createDataFrame(rows, TRACKS_SCHEMA)


def bid(order_id=1, site="S0", item=1, price="100.00", qty=2, won="2024-01-02", time=120000, created=None,
        promo=1, gmv=1, mkt="TM", l1="C1", l2="C2", l3="C3"):
    from decimal import Decimal
    won_d = dt.date.fromisoformat(won) if won else None
    created_d = dt.date.fromisoformat(created) if created else won_d
    return (won_d, time, site, l1, l2, l3, "n" + l1, "n" + l2, "n" + l3, Decimal(order_id), created_d, item,
            promo, gmv, Decimal(price), qty, mkt)


def bids_df(spark, rows):
    return spark.createDataFrame(rows, BIDS_SCHEMA)


def customers_df(spark, rows):
    return spark.createDataFrame(rows, CUSTOMERS_SCHEMA)


def srt(items):
    """Sort tuples that may hold None (None sorts last)."""
    return sorted(items, key=lambda t: tuple((v is None, v) for v in t))


def rows(df, *cols):
    cols = cols or df.columns
    return srt(tuple(r[c] for c in cols) for r in df.collect())
