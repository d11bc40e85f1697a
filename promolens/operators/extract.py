"""Extraction operators (Q1-Q3, A1-A3): promotion touches, order-created
events and sale lines.

Each takes the run date ``analysis_date`` (a date, ISO text, a DATE column
for multi-date runs, or ``None`` for today) and a profile from
``promolens.plans.profiles`` that fixes the variant's paths, ``ds`` windows
and output shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.constants import LANDING_ANY
from promolens.functions import (
    hour_label, hour_of, json_field, minus_lookback, server_time, value, when_flag,
)
from promolens.functions.jsonpath import is_promo, landing_code, origin_label
from promolens.functions.keys import key_text
from promolens.functions.timefmt import server_time_sql
from promolens.operators.filters import ds_window, gmv_sales, sold_on, where_path


def _carry(carry):
    return [F.col(c) for c in carry]


def touch_rows(tracks: DataFrame, window, profile, carry=()) -> DataFrame:
    """The promotion views of a click-stream window, a row for each event (Q1 without its DISTINCT)."""
    p = profile
    df = where_path(tracks, *p.touch_paths)
    df = df.where(window & F.col("usr.uid").isNotNull())
    # each JSON document is parsed once: json_tuple pulls several top-level keys in one pass
    df = df.select("*", F.json_tuple(F.col("platform.fragment"), "c_id", "deal_print_id").alias("__c_id", "__deal"))
    df = df.where(is_promo("__c_id", "__deal", p.carousel))
    item_cols = [f"__item{i}" for i in range(len(p.item_keys))]
    df = df.select("*", F.json_tuple(F.col("event_data"), *p.item_keys).alias(*item_cols))
    item = F.coalesce(*[F.col(c) for c in item_cols])
    if p.touch_shape == "report":
        cols = [F.col("application.site_id").alias("site_id"),
                F.col("device.platform").alias("platform"),
                F.col("usr.uid").alias("uid"),
                item.alias("item_id"),
                origin_label("__c_id", p.carousel).alias("origin"),
                server_time().alias("event_exact_date")]
    else:
        cols = [F.col("application.site_id").alias("sit_site_id")]
        if p.with_user_id:
            cols.append(F.col("usr.user_id").alias("user_id"))
        cols += [F.col("usr.uid").alias("uid"),
                 item.alias("ite_item_id"),
                 F.col("device.platform").alias("platform"),
                 server_time().alias("event_exact_date"),
                 landing_code("__c_id", p.carousel).alias("landing")]
    return df.select(*cols, *_carry(carry))


def extract_touches(tracks: DataFrame, analysis_date=None, profile=None, carry=()) -> DataFrame:
    """Q1: distinct promotion views at second grain.

    ``profile.touch_shape``:

    * ``"report"``: ``site_id, platform, uid, item_id, origin,
      event_exact_date`` (origin as 'Carrousel' / 'Landing');
    * ``"staged"``: ``sit_site_id, [user_id,] uid, ite_item_id, platform,
      event_exact_date, landing`` (origin as 0 / 1).

    ``carry`` names extra columns (a run date) kept in the output and in the
    distinct key."""
    from promolens.plans.profiles import DAILY
    p = profile or DAILY
    return touch_rows(tracks, ds_window(p.touch_bounds, analysis_date), p, carry).distinct()


def collapse_origin(touches: DataFrame) -> DataFrame:
    """A3: staged touches with the origin merged (``landing = 99``).  Rows
    that differ only by origin become one."""
    cols = [c for c in touches.columns if c != "landing"]
    return touches.select(*cols).distinct().withColumn("landing", F.lit(LANDING_ANY))


def with_merged_origin(touches: DataFrame) -> DataFrame:
    """Staged touches and, beside them, those of ``collapse_origin``, in one pass."""
    cols = [c for c in touches.columns if c != "landing"]
    both = touches.groupBy(*cols).agg(F.collect_set("landing").alias("__set"))
    return both.select(*cols, F.explode(F.concat("__set", F.array(F.lit(LANDING_ANY)))).alias("landing"))


def extract_orders(tracks: DataFrame, analysis_date=None, profile=None, test_buyers: DataFrame | None = None,
                   carry=()) -> DataFrame:
    """Q2: order-created events with their 24 h look-back bound.

    ``profile.order_shape``:

    * ``"report"``: ``site_id, platform, item_id (first item), order_id, uid,
      order_exact_date, order_exact_date_sub_24h``;
    * ``"volume"``: the above plus ``status, item_quantity, gmv`` (text, as
      in the event);
    * ``"staged"``: ``sit_site_id, ord_order_id, [user_id,] uid, [platform,]
      order_exact_date, order_exact_date_sub_24h`` (no dedup: duplicate
      events are kept and fan out downstream, as in the reference loaders).

    ``test_buyers`` (ids) removes the orders of test accounts with a left
    anti join on the login id compared as text."""
    from promolens.plans.profiles import DAILY
    p = profile or DAILY
    df = where_path(tracks, *p.order_paths).where(ds_window(p.order_ds, analysis_date))
    if test_buyers is not None:
        df = exclude_test_buyers(df, test_buyers)
    data = F.col("event_data")
    when = server_time()
    sub_24h = minus_lookback(server_time_sql())
    order_id = json_field(data, "order_id").try_cast("decimal(18,0)")
    if p.order_shape in ("report", "volume"):
        cols = [F.col("application.site_id").alias("site_id"),
                F.col("device.platform").alias("platform"),
                json_field(data, "items[0].item.id").alias("item_id"),
                order_id.alias("order_id")]
        if p.order_shape == "volume":
            cols.append(json_field(data, "status").alias("status"))
        cols.append(F.col("usr.uid").alias("uid"))
        if p.order_shape == "volume":
            cols += [json_field(data, "items[0].quantity").alias("item_quantity"),
                     json_field(data, "total_amount_usd").alias("gmv")]
        cols += [when.alias("order_exact_date"), sub_24h.alias("order_exact_date_sub_24h")]
        out = df.select(*cols, *_carry(carry))
        return out.distinct() if p.order_dedup else out
    cols = [F.col("application.site_id").alias("sit_site_id"), order_id.alias("ord_order_id")]
    if p.with_user_id:
        cols.append(F.col("usr.user_id").alias("user_id"))
    cols.append(F.col("usr.uid").alias("uid"))
    if p.order_platform:
        cols.append(F.col("device.platform").alias("platform"))
    cols += [when.alias("order_exact_date"), sub_24h.alias("order_exact_date_sub_24h")]
    out = df.select(*cols, *_carry(carry))
    return out.distinct() if p.order_dedup else out


def exclude_test_buyers(events: DataFrame, test_buyers: DataFrame) -> DataFrame:
    """Drop events of test accounts.  Written as a left anti join (the
    reference's LEFT JOIN ... IS NULL is not rewritten by the optimizer);
    keys compared as text.  The id list is small after its filter, so AQE
    turns this into a broadcast join at run time when its measured size
    allows, and keeps a shuffle join otherwise."""
    ids = test_buyers.select(key_text(test_buyers, "cus_cust_id").alias("_test_id")).distinct()
    return events.join(ids, F.col("usr.user_id") == F.col("_test_id"), "left_anti")


def sales_lines(bids: DataFrame, analysis_date=None, carry=()) -> DataFrame:
    """Q3: sale lines won on ``T - 1`` that count as sales value, with hour
    label, trimmed site / first category, and promo / total measures."""
    df = gmv_sales(sold_on(bids, analysis_date))
    line_value = value()
    return df.select(
        hour_label("tim_day_winning_date", "tim_time_winning_date").alias("FechaHora"),
        hour_of("tim_time_winning_date").alias("hora"),
        F.trim("sit_site_id").alias("sit_site_id"),
        F.trim("cat_categ_id_l1").alias("category_L1"),
        F.col("cat_categ_id_l2").alias("category_L2"),
        F.col("cat_categ_id_l3").alias("category_L3"),
        F.col("cat_categ_name_l1").alias("category_name_L1"),
        F.col("cat_categ_name_l2").alias("category_name_L2"),
        F.col("cat_categ_name_l3").alias("category_name_L3"),
        F.col("ord_order_id").alias("order_id"),
        when_flag("ite_today_promotion_flag", line_value).alias("GMVE_AG"),
        when_flag("ite_today_promotion_flag", F.col("bid_quantity_ok")).alias("SI_AG"),
        line_value.alias("GMVE_TS"),
        F.col("bid_quantity_ok").alias("SI_TS"),
        *_carry(carry),
    )
