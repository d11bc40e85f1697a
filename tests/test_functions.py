import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from promolens.functions import (
    ds_bound, hour_label, hour_of, is_promo, json_field, landing_code, minus_lookback,
    origin_label, server_time, wall_seconds_sql,
)
from promolens.functions.keys import item_key, key_text


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_server_time_drops_fraction_and_offset(spark):
    assert one(spark, server_time("v"), "2024-01-02T10:11:12.345-04:00") == "2024-01-02 10:11:12"


def test_minus_lookback_is_86400_seconds(spark):
    assert one(spark, minus_lookback("v"), "2024-01-02 10:00:00") == "2024-01-01 10:00:00"
    assert one(spark, minus_lookback("v"), "2024-03-01 00:00:05") == "2024-02-29 00:00:05"


def test_minus_lookback_bad_text_is_null_not_error(spark):
    for bad in ["garbage", "2024-01-02 25:00:00", "2024-1-2 10:00:00", None]:
        assert one(spark, minus_lookback("v"), bad) is None


def test_minus_lookback_across_dst_uses_seconds(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Santiago")
    try:
        # clocks go forward on 2024-09-08; 24 real hours before 12:00 is 11:00 the day before
        assert one(spark, minus_lookback("v"), "2024-09-08 12:00:00") == "2024-09-07 11:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_hour_of_pads_and_accepts_numeric_types(spark):
    assert one(spark, hour_of("v"), 93015, "v int") == "09"
    assert one(spark, hour_of("v"), 0, "v int") == "00"
    assert one(spark, hour_of("v"), 235959, "v int") == "23"
    assert one(spark, hour_of("v"), Decimal("93015"), "v decimal(18,0)") == "09"
    assert one(spark, hour_of("v"), 93015.0, "v double") == "09"


def test_hour_label(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), 93015)], "d date, t int")
    assert df.select(hour_label("d", "t")).first()[0] == "2024-01-02 09"


def test_wall_seconds_only_for_canonical_text(spark):
    assert one(spark, F.expr(wall_seconds_sql("v")), "1970-01-02 00:00:01") == 86401
    assert one(spark, F.expr(wall_seconds_sql("v")), "2024-02-29 23:59:59") == 1709251199
    for bad in ["2024-02-30 10:00:00", "2024-01-02 24:00:00", "2024-01-02 10:00:60", "2024-01-02 10:00:0", "2024-01-02T10:00:00", "2024-01-02 10:61:00", "x", None]:
        assert one(spark, F.expr(wall_seconds_sql("v")), bad) is None


def test_json_lookups(spark):
    assert one(spark, json_field("v", "item_id"), '{"item_id":"S01"}') == "S01"
    assert one(spark, json_field("v", "$.items[0].item.id"), '{"items":[{"item":{"id":"A"}}]}') == "A"
    assert one(spark, json_field("v", "item_id"), '{"item_id":null}') is None
    assert one(spark, json_field("v", "item_id"), "{bad") is None


def test_promo_predicate_and_origin(spark):
    df = spark.createDataFrame([("/home/carousel/card", None), (None, "1"), (None, None), ("other", None)], "c string, d string")
    got = df.select(is_promo("c", "d"), landing_code("c"), origin_label("c"), is_promo("c", "d", "other")).collect()
    assert [tuple(r) for r in got] == [(True, 0, "Carrousel", False), (True, 1, "Landing", True), (False, 1, "Landing", False),
                                       (False, 1, "Landing", True)]


def test_key_text_of_whole_numbers(spark):
    df = spark.createDataFrame([(7.0, Decimal("7.00"), 7, "07"), (7.5, None, None, None)], "a double, b decimal(10,2), c long, d string")
    got = df.select(*[key_text(df, c) for c in "abcd"]).collect()
    assert [tuple(r) for r in got] == [("7", "7", "7", "07"), ("7.5", None, None, None)]


def test_item_key_trims_and_casts(spark):
    df = spark.createDataFrame([(" S0", 12)], "s string, i bigint")
    assert df.select(item_key("s", "i")).first()[0] == "S012"


def test_ds_bound_folds_to_literal(spark):
    df = spark.range(1).select(ds_bound(dt.date(2024, 1, 3), 2, "").alias("a"), ds_bound("2024-01-03", 1).alias("b"))
    r = df.first()
    assert (r["a"], r["b"]) == ("2024-01-01", "2024-01-02 00")


def test_session_settings_are_known_to_spark(spark):
    from promolens.session import RECOMMENDED_CONF, SCALE_CONF
    known = {r["key"] for r in spark.sql("SET -v").collect()}
    unknown = [k for k in {**RECOMMENDED_CONF, **SCALE_CONF} if k.startswith("spark.sql.") and k not in known]
    assert not unknown, unknown
