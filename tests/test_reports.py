import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import CAROUSEL, bid, bids_df, customers_df, order, tracks_df, view

from promolens.plans.reports import SITE_HOUR, gmv_report, volume_report
from promolens.sources import fixtures

T = dt.date(2024, 1, 3)


def test_gmv_report_credits_every_line_per_order_row(spark):
    tr = tracks_df(spark, [
        view(platform="web", fragment=CAROUSEL, at="2024-01-02 10:00:00"),
        view(platform="mobile", at="2024-01-02 11:00:00"),
        order(1, platform="web", at="2024-01-02 12:00:00"),
        order(1, platform="mobile", at="2024-01-02 12:00:00"),
        order(2, at="2024-01-02 12:00:00", item="S09"),
    ])
    b = bids_df(spark, [bid(1, price="100.00", qty=2, promo=1), bid(1, item=2, price="50.00", qty=1, promo=0),
                        bid(2, price="10.00", qty=1, promo=0)])
    r = gmv_report(tr, b, T).collect()
    assert len(r) == 1
    r = r[0].asDict()
    # order 1 has two (site, platform, item) count rows: its lines count twice
    assert float(r["GMVE_TS"]) == (200 + 50) * 2 + 10
    assert r["SI_TS"] == 3 * 2 + 1
    assert float(r["GMVE_AG"]) == 200 * 2
    assert float(r["GMVE_CAR"]) == 250 and float(r["GMVE_LAN"]) == 250 and float(r["GMVE_TA"]) == 500
    assert r["SI_TA"] == 6


def test_volume_report_keeps_unattributed_orders(spark):
    tr = tracks_df(spark, [
        view(fragment=CAROUSEL, at="2024-01-02 10:00:00", path="/pdp"),
        order(1, at="2024-01-02 12:00:00", qty=2, amount="10.50"),
        order(2, at="2024-01-02 13:00:00", item="S07", qty=1, amount="5.25"),
        order(3, at="2024-01-02 13:00:00", user_id="99", qty=9, amount="99.00"),
    ])
    cust = customers_df(spark, [(99, "true")])
    r = volume_report(tr, cust, T).collect()
    assert len(r) == 1
    r = r[0].asDict()
    assert (r["GMV_CAR"], r["SI_CAR"], r["GMV_LAN"], r["GMVE_TS"], r["SI_TS"]) == (10.5, 2.0, 0.0, 15.75, 3.0)
    assert r["GMV_AG"] == 10.5


@pytest.fixture(scope="module")
def small(spark):
    return fixtures.inputs(spark, "/root/testdata/sf0.001")


def test_report_invariants_on_benchmark_data(spark, small):
    d = dt.date(2024, 1, 10)
    fine = gmv_report(small["tracks"], small["bids"], d).cache()
    bad = fine.where((F.col("GMVE_TA") > F.col("GMVE_TS")) | (F.col("GMVE_AG") > F.col("GMVE_TS"))
                     | (F.greatest("GMVE_LAN", "GMVE_CAR") > F.col("GMVE_TA"))
                     | (F.col("GMVE_TA") > F.col("GMVE_LAN") + F.col("GMVE_CAR")))
    assert bad.count() == 0
    coarse = gmv_report(small["tracks"], small["bids"], d, grain=SITE_HOUR)
    f = fine.agg(F.sum("GMVE_TS"), F.sum("GMVE_TA"), F.sum("SI_AG")).first()
    c = coarse.agg(F.sum("GMVE_TS"), F.sum("GMVE_TA"), F.sum("SI_AG")).first()
    assert tuple(f) == tuple(c)


def test_reports_trim_padded_keys_but_loaders_do_not(spark):
    from promolens.plans.mart import attributed_sales
    from promolens.plans.profiles import HISTORY
    tr = tracks_df(spark, [
        view(site=" S0", platform="web ", uid="u1 ", item=" S01", fragment=CAROUSEL, at="2024-01-02 10:00:00"),
        order(1, site="S0", platform="web", uid="u1", item="S01", at="2024-01-02 12:00:00"),
    ])
    b = bids_df(spark, [bid(1, price="10.00", qty=1)])
    r = gmv_report(tr, b, T).first()
    assert float(r["GMVE_CAR"]) == 10.0                      # trimmed keys match
    assert attributed_sales(tr, b, T, HISTORY, "origin").count() == 0   # raw keys do not


def test_volume_report_unreadable_amount_is_null(spark):
    tr = tracks_df(spark, [
        order(1, at="2024-01-02 12:00:00", amount='"12,5"', qty=1),
        order(2, at="2024-01-02 12:00:00", amount="4.50", qty=2, item="S02"),
    ])
    r = volume_report(tr, customers_df(spark, []), T).first()
    assert (r["GMVE_TS"], r["SI_TS"]) == (4.5, 3.0)


def test_unknown_price_of_a_line_without_touches_counts_nothing(spark):
    from conftest import BIDS_SCHEMA
    tr = tracks_df(spark, [view(fragment=CAROUSEL, at="2024-01-02 10:00:00"), order(1, at="2024-01-02 12:00:00")])
    lines = [bid(1, price="10.00", qty=1), bid(2, price="1.00", qty=1)]
    lines[1] = lines[1][:14] + (None,) + lines[1][15:]
    r = gmv_report(tr, spark.createDataFrame(lines, BIDS_SCHEMA), T).first()
    assert (float(r["GMVE_CAR"]), float(r["GMVE_LAN"]), float(r["GMVE_TA"])) == (10.0, 0.0, 10.0)
    alone = gmv_report(tr, spark.createDataFrame(lines[1:], BIDS_SCHEMA), T).first()
    assert (float(alone["GMVE_CAR"]), float(alone["GMVE_TA"]), alone["SI_TA"]) == (0.0, 0.0, 0)


def test_touch_windows_of_a_past_date_can_be_closed(spark):
    from promolens.operators.extract import extract_touches
    from promolens.plans.profiles import GMV_REPORT
    tr = tracks_df(spark, [view(at="2024-01-02 10:00:00"), view(at="2024-01-05 10:00:00")])
    assert extract_touches(tr, T, GMV_REPORT).count() == 2
    assert extract_touches(tr, T, GMV_REPORT.but(touch_until=("<=", 0, " 00"))).count() == 1


def test_carousel_id_is_a_setting(spark):
    from promolens.plans.profiles import DAILY
    from promolens.operators.extract import extract_touches
    tr = tracks_df(spark, [view(fragment='{"c_id":"/mine"}'), view(fragment=CAROUSEL)])
    assert [r["landing"] for r in extract_touches(tr, T, DAILY.but(carousel="/mine")).collect()] == [0]


def test_reports_without_a_date_cover_yesterday(spark):
    won = spark.sql("SELECT cast(date_sub(current_date(), 1) AS STRING) AS d").first()["d"]
    tr = tracks_df(spark, [view(fragment=CAROUSEL, at=f"{won} 10:00:00"), order(1, at=f"{won} 12:00:00")])
    assert float(gmv_report(tr, bids_df(spark, [bid(1, won=won, price="10.00", qty=1)])).first()["GMVE_CAR"]) == 10.0
    assert volume_report(tr, customers_df(spark, [])).first()["GMV_CAR"] == 10.5
