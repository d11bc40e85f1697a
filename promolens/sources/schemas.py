"""Input, staging and output schemas.

The click-stream, sale-line and customer tables have no DDL in the reference;
their types are inferred from use.  The mart and staging schemas follow the
reference DDL, except that ``landing`` is staged as INT (the reference stages
text and inserts it into an INT column, which Spark refuses as unsafe)."""

from pyspark.sql import types as T

_S = T.StringType()

TRACKS_SCHEMA = T.StructType([
    T.StructField("application", T.StructType([T.StructField("site_id", _S)])),
    T.StructField("device", T.StructType([T.StructField("platform", _S)])),
    T.StructField("usr", T.StructType([T.StructField("uid", _S), T.StructField("user_id", _S)])),
    T.StructField("platform", T.StructType([T.StructField("fragment", _S)])),
    T.StructField("event_data", _S),
    T.StructField("server_timestamp", _S),
    T.StructField("path", _S),
    T.StructField("ds", _S),
])

BIDS_SCHEMA = T.StructType([
    T.StructField("tim_day_winning_date", T.DateType()),
    T.StructField("tim_time_winning_date", T.IntegerType()),
    T.StructField("sit_site_id", _S),
    T.StructField("cat_categ_id_l1", _S),
    T.StructField("cat_categ_id_l2", _S),
    T.StructField("cat_categ_id_l3", _S),
    T.StructField("cat_categ_name_l1", _S),
    T.StructField("cat_categ_name_l2", _S),
    T.StructField("cat_categ_name_l3", _S),
    T.StructField("ord_order_id", T.DecimalType(18, 0)),
    T.StructField("ord_created_dt", T.DateType()),
    T.StructField("ite_item_id", T.LongType()),
    T.StructField("ite_today_promotion_flag", T.IntegerType()),
    T.StructField("ite_gmv_flag", T.IntegerType()),
    T.StructField("bid_base_current_price", T.DecimalType(18, 2)),
    T.StructField("bid_quantity_ok", T.IntegerType()),
    T.StructField("mkt_marketplace_id", _S),
])

#: Types that text is read as where the usual type could cut a value.
TEXT_AS = {"bid_base_current_price": T.DecimalType(20, 6), "bid_quantity_ok": T.DecimalType(18, 3)}

CUSTOMERS_SCHEMA = T.StructType([
    T.StructField("cus_cust_id", T.LongType()),
    T.StructField("is_test", _S),
])

TOUCH_SCHEMA = T.StructType([
    T.StructField("sit_site_id", _S),
    T.StructField("user_id", _S),
    T.StructField("uid", _S),
    T.StructField("ite_item_id", _S),
    T.StructField("platform", _S),
    T.StructField("event_exact_date", _S),
    T.StructField("landing", T.IntegerType()),
])

MART_SCHEMA = T.StructType([
    T.StructField("FechaHora", _S),
    T.StructField("hora", _S),
    T.StructField("sit_site_id", _S),
    T.StructField("category_L1", _S),
    T.StructField("category_L2", _S),
    T.StructField("category_L3", _S),
    T.StructField("category_name_L1", _S),
    T.StructField("category_name_L2", _S),
    T.StructField("category_name_L3", _S),
    T.StructField("platform", _S),
    T.StructField("landing", T.IntegerType()),
    T.StructField("atr_type", _S),
    T.StructField("gmve", T.FloatType()),
    T.StructField("SI", T.DecimalType(38, 0)),
    T.StructField("fecha", _S),
])

#: Grain of the sale-line measures: hour label, hour, site, three category
#: levels with their names.
SALES_GRAIN = ["FechaHora", "hora", "sit_site_id", "category_L1", "category_L2", "category_L3",
               "category_name_L1", "category_name_L2", "category_name_L3"]
