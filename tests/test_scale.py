"""Steps whose volume must not grow faster than the input."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import bid, bids_df, order, rows, tracks_df, view
from promolens.operators import joins
from promolens.operators.joins import only_packed, pack_ids
from promolens.plans.mart import backfill
from promolens.sources import fixtures


def test_packed_ids_pick_out_the_same_rows_as_a_semi_join(spark, monkeypatch):
    some = [0, 1, 63, 64, -1, -64, -65, 7, 7, None, 2**62, 999999999999999999]
    ids = spark.createDataFrame([(i,) for i in some], "i long")
    df = spark.createDataFrame([(i,) for i in [*some, 2, 62, 65, -2, 2**62 + 1]], "key long")
    want = rows(df.join(ids, F.col("key") == F.col("i"), "left_semi"))
    packed = pack_ids(ids)
    assert rows(only_packed(df, "key", packed)) == want and len(want) == 11 and packed.count() < len(set(some)) - 1
    as_decimal = df.where("abs(key) < 1000").select(F.col("key").cast("decimal(18,0)").alias("key"))
    assert only_packed(as_decimal, "key", packed).count() == 9
    monkeypatch.setattr(joins, "PACKED_ROWS", 1)
    assert only_packed(df, "key", packed).count() == df.count()


def test_only_lines_of_orders_with_an_event_are_shuffled(spark):
    t = fixtures.load(spark, "/root/testdata/sf0.001")
    buys = t["events"].where("event_type = 'purchase'")
    plan = fixtures.first_line_of_orders(buys, t["orders"], t["lineitem"])._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


def test_bids_shuffle_their_lines_by_the_order_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = fixtures.bids(fixtures.load(spark, "/root/testdata/sf0.001"))
        plan = b._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # events, orders and lines by the order; lines and parts by the part
    assert plan.count("Exchange hashpartitioning") == 5


def test_staged_backfill_moves_only_lines_with_an_order_event(spark, tmp_path):
    tr = tracks_df(spark, [view(at="2024-01-02 10:00:00"), order(1, at="2024-01-02 12:00:00"), order(1, at="2024-01-02 12:00:00"),
                           order(70, at="2024-01-02 13:00:00")])
    b = bids_df(spark, [bid(1, price="10.00", qty=1), bid(2, price="4.00", qty=1), bid(70, price="1.00", qty=1), bid(70, item=2)])
    dates = [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    for once in (False, True):
        plain = rows(backfill(tr, b, dates, dedup_touches=once))
        at = str(tmp_path / f"staged-{once}")
        assert rows(backfill(tr, b, dates, stage_path=at, dedup_touches=once)) == plain and len(plain) == 1
        # ids 1 and 70 make two rows
        assert spark.read.parquet(f"{at}/ids").count() == 2
