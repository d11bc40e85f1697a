import datetime as dt

from conftest import CAROUSEL, customers_df, order, rows, srt, tracks_df, view

from promolens.operators.extract import collapse_origin, extract_orders, extract_touches
from promolens.plans.profiles import DAILY, GMV_REPORT, HISTORY, VOLUME_REPORT
from promolens.sources.tables import test_customers as find_test_customers

T = dt.date(2024, 1, 3)


def test_touch_filters_and_window(spark):
    tr = tracks_df(spark, [
        view(at="2024-01-01 00:00:01"),                   # first hour of T-2: in
        view(at="2023-12-31 23:59:59"),                   # before: out
        view(at="2024-01-03 00:00:00"),                   # day T: out (ds < 'T')
        view(at="2024-01-02 10:00:00", uid=None),         # no device id: out
        view(at="2024-01-02 10:00:01", fragment="{}"),    # not a promotion view: out
        view(at="2024-01-02 10:00:02", path="/pdp"),      # /pdp: out for the daily job
        view(at="2024-01-02 10:00:03", fragment=CAROUSEL, item="S02"),
        view(at="2024-01-02 10:00:03", fragment=CAROUSEL, item="S02"),   # duplicate: one row
        view(at="2024-01-02 10:00:04", key="items", item="S03"),
        view(at="2024-01-02 10:00:05", key="item_ids", item="S04"),
    ])
    got = rows(extract_touches(tr, T, DAILY), "ite_item_id", "event_exact_date", "landing", "user_id")
    assert got == [("S01", "2024-01-01 00:00:01", 1, "1"), ("S02", "2024-01-02 10:00:03", 0, "1"),
                   ("S03", "2024-01-02 10:00:04", 1, "1"), ("S04", "2024-01-02 10:00:05", 1, "1")]
    assert "user_id" not in extract_touches(tr, T, HISTORY).columns
    vol = rows(extract_touches(tr, T, VOLUME_REPORT), "event_exact_date")
    assert ("2024-01-02 10:00:02",) in vol and ("2024-01-01 00:00:01",) in vol
    gmv = extract_touches(tr, T, GMV_REPORT)
    # the GMV report looks up item_id only; its window starts at T-1 00 and has
    # no upper bound, so the view on day T is kept
    assert rows(gmv, "item_id", "origin") == srt([("S01", "Landing"), ("S02", "Carrousel"),
                                                          (None, "Landing"), (None, "Landing")])


def test_collapse_origin_merges_origins(spark):
    tr = tracks_df(spark, [view(at="2024-01-02 10:00:00", fragment=CAROUSEL),
                           view(at="2024-01-02 10:00:00")])
    staged = extract_touches(tr, T, DAILY)
    assert staged.count() == 2
    merged = collapse_origin(staged)
    assert rows(merged, "landing") == [(99,)]


def test_orders_shapes_dedup_and_bad_values(spark):
    tr = tracks_df(spark, [
        order(1, at="2024-01-02 12:00:00"), order(1, at="2024-01-02 12:00:00"),
        order(2, at="2024-01-03 00:59:59"),               # ds 'T 00' is inside (<= 'T 00')
        order(3, at="2024-01-03 01:00:00"),               # out
        order(4, at="2024-01-02 13:00:00", event_data='{"order_id":"x1","items":[]}'),
    ])
    staged = extract_orders(tr, T, DAILY)
    assert staged.count() == 4                            # no dedup: duplicates kept
    ids = sorted((r["ord_order_id"] is None, r["ord_order_id"]) for r in staged.collect())
    assert [i for _, i in ids][:3] == [1, 1, 2] and ids[3][1] is None
    r = staged.where("ord_order_id = 2").first()
    assert r["order_exact_date_sub_24h"] == "2024-01-02 00:59:59"
    assert extract_orders(tr, T, GMV_REPORT).where("order_id = 1").count() == 1


def test_test_buyers_removed_with_anti_join(spark):
    tr = tracks_df(spark, [order(1, user_id="7", at="2024-01-02 12:00:00"),
                           order(2, user_id="8", at="2024-01-02 12:00:00"),
                           order(3, user_id=None, at="2024-01-02 12:00:00")])
    cust = customers_df(spark, [(7, "true"), (8, "false")])
    out = extract_orders(tr, T, VOLUME_REPORT, test_buyers=find_test_customers(cust))
    assert rows(out, "order_id") == [(2,), (3,)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan


def test_touch_fragment_edge_cases(spark):
    tr = tracks_df(spark, [
        view(at="2024-01-02 10:00:00", fragment='{"deal_print_id":7}'),      # numeric id: promo, landing
        view(at="2024-01-02 10:00:01", fragment='{bad'),                     # malformed: not promo
        view(at="2024-01-02 10:00:02", fragment=None),                       # missing: not promo
        view(at="2024-01-02 10:00:03", fragment='{"deal_print_id":null}'),   # JSON null: not promo
        view(at="2024-01-02 10:00:04", fragment='{"c_id":"/other","deal_print_id":"1"}'),
        view(at="2024-01-02 10:00:05", event_data='{bad'),                   # promo, no readable item
    ])
    got = rows(extract_touches(tr, T, DAILY), "event_exact_date", "landing", "ite_item_id")
    assert got == srt([("2024-01-02 10:00:00", 1, "S01"), ("2024-01-02 10:00:04", 1, "S01"),
                       ("2024-01-02 10:00:05", 1, None)])
