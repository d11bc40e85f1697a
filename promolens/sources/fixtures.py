"""Derive the click-stream, sale lines and customers from the benchmark tables.

The benchmark ships TPC-H-like tables plus an ``events`` table, not the
click-stream and sales tables the attribution jobs read.  This module maps
them (the mapping is documented in FIXTURES.md) with plain DataFrame
operations, so the derived inputs grow with the benchmark tables and every
query built on them runs on Spark end to end.

Mapping summary (``k`` = ``props.k``, 0..99):

* site = ``'S' || user_id % 3``; platform = ``web`` for even event ids, else
  ``mobile``; server time = ``ts`` to the second + ``.000-04:00``;
  ``ds`` = ``yyyy-MM-dd HH`` of ``ts``.
* clicks and views become promotion-surface candidates; signups and errors are
  the same rows under paths of their own; purchases become order-created events
  carrying the order and its first line.  Some item ids are padded, some are
  JSON arrays, some order events occur twice.
* every line of ``lineitem`` becomes a sale line (``bids``): at the time of its
  order's purchase event, or, where the order has none, at a time derived from
  the order key.  Some prices are unknown.
"""

from __future__ import annotations

import datetime as _dt
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.constants import CAROUSEL_COMPONENT, PATH_ORDER_CREATED, PATH_PDP, PATH_VIP
from promolens.operators.joins import only_packed, pack_ids
from promolens.session import checkpoint_dir
from promolens.sources.tables import read_bids, read_customers, read_tracks

# --- fixed values of the mapping (shared with the DuckDB oracle) --------------
ISO_SUFFIX = ".000-04:00"
CATEGORY_NAME_PREFIX = "name "
TEST_SEGMENT = "MACHINERY"
LOW_PRIORITY = "5-LOW"
FIRST_DAY = "2024-01-01"
# ------------------------------------------------------------------------------

TABLES = ("events", "orders", "lineitem", "part", "customer")


def load(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}


def _site() -> F.Column:
    return F.concat(F.lit("S"), (F.col("user_id") % 3).cast("string"))


def _common(ev: DataFrame) -> DataFrame:
    return ev.select(
        "event_id", "user_id", "event_type", "props",
        _site().alias("_site"),
        F.when(F.col("event_id") % 2 == 0, "web").otherwise("mobile").alias("_platform"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(ISO_SUFFIX)).alias("server_timestamp"),
        F.date_format("ts", "yyyy-MM-dd HH").alias("ds"),
        F.to_date("ts").alias("_day"),
        (F.hour("ts") * 10000 + F.minute("ts") * 100 + F.second("ts")).alias("_hhmmss"),
    )


def _json_obj(*pairs) -> F.Column:
    """``{"k":v,...}`` from (key, column-of-JSON-text) pairs."""
    parts = [F.lit("{")]
    for i, (k, v) in enumerate(pairs):
        parts += [F.lit(("," if i else "") + f'"{k}":'), v]
    return F.concat(*parts, F.lit("}"))


def _quoted(c: F.Column) -> F.Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def first_line_of_orders(buys: DataFrame, orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Purchase events with their order and the order's first line: smallest
    (linenumber, partkey, suppkey, extendedprice, shipdate, quantity); orders
    without lines keep null line columns.

    Equal events are one.  Only the lines of orders with an event are shuffled."""
    lines = only_packed(lineitem, "l_orderkey", pack_ids(buys.select("event_id")))
    j = (buys.join(orders, buys.event_id == F.col("o_orderkey"))
         .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left"))
    first = F.min(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                           "l_shipdate", "l_quantity")).alias("f")
    keys = buys.columns + ["o_orderkey", "o_orderstatus", "o_totalprice"]
    return (j.groupBy(*keys).agg(first)
            .select(*keys, F.col("f.l_partkey").alias("l_partkey"), F.col("f.l_quantity").alias("l_quantity")))


def tracks(t: dict[str, DataFrame]) -> DataFrame:
    """Click-stream with the nested layout of the real table."""
    ev = _common(t["events"])
    views = ev.where(F.col("event_type") != "purchase").withColumn("_k", F.get_json_object("props", "$.k").try_cast("int"))
    k = F.col("_k")  # read once for each event
    item = F.concat(F.when(F.col("event_id") % 31 == 0, " ").otherwise(""), F.col("_site"), (k % 3).cast("string"))
    key = (F.when(F.col("event_id") % 11 == 0, "items")
           .when(F.col("event_id") % 13 == 0, "item_ids").otherwise("item_id"))
    fragment = (F.when(k < 5, F.lit("{}"))
                .when(F.col("event_type") == "click", F.lit('{"c_id":"%s"}' % CAROUSEL_COMPONENT))
                .otherwise(F.concat(F.lit('{"deal_print_id":"'), k.cast("string"), F.lit('"}'))))
    views = views.select(
        F.struct(F.col("_site").alias("site_id")).alias("application"),
        F.struct(F.col("_platform").alias("platform")).alias("device"),
        F.struct(F.when(k != 99, F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("uid"),
                 F.when(F.col("event_id") % 4 != 0, F.col("user_id").cast("string")).alias("user_id")
                 ).alias("usr"),
        F.struct(fragment.alias("fragment")).alias("platform"),
        F.concat(F.lit('{"'), key, F.when(F.col("event_id") % 77 == 0, '":["').otherwise('":"'), item,
                 F.when(F.col("event_id") % 77 == 0, '"]}').otherwise('"}')).alias("event_data"),
        "server_timestamp",
        F.when(F.col("event_type").isin("signup", "error"), F.concat(F.lit("/"), "event_type"))
        .when(F.col("event_id") % 5 == 0, PATH_PDP).otherwise(PATH_VIP).alias("path"),
        "ds",
    )

    buys = first_line_of_orders(ev.where(F.col("event_type") == "purchase"), t["orders"], t["lineitem"])
    line_item = F.concat(F.col("_site"), (F.coalesce(F.col("l_partkey"), F.lit(0)) % 3).cast("string"))
    qty = F.coalesce(F.col("l_quantity").cast("int"), F.lit(0)).cast("string")
    items = F.concat(F.lit('[{"item":{"id":'), _quoted(line_item), F.lit('},"quantity":'), qty, F.lit("}]"))
    data = _json_obj(("order_id", F.col("o_orderkey").cast("string")),
                     ("status", _quoted(F.col("o_orderstatus"))),
                     ("total_amount_usd", F.col("o_totalprice").cast("decimal(18,2)").cast("string")),
                     ("items", items))
    buys = buys.withColumn("_copy", F.explode(F.when(F.col("event_id") % 23 == 0, F.array(F.lit(1), F.lit(2)))
                                              .otherwise(F.array(F.lit(1)))))
    buys = buys.select(
        F.struct(F.col("_site").alias("site_id")).alias("application"),
        F.struct(F.col("_platform").alias("platform")).alias("device"),
        F.struct(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("uid"),
                 F.col("user_id").cast("string").alias("user_id")).alias("usr"),
        F.struct(F.lit("{}").alias("fragment")).alias("platform"),
        data.alias("event_data"),
        "server_timestamp",
        F.lit(PATH_ORDER_CREATED).alias("path"),
        "ds",
    )
    return views.unionByName(buys)


def bids(t: dict[str, DataFrame], first_day: str = FIRST_DAY) -> DataFrame:
    """Sale lines: every line with its order, part and purchase event, if any.

    Events, orders and lines are joined by the same key in one shuffle of the lines; what
    goes on to the join with the parts is narrow."""
    ev = _common(t["events"]).where(F.col("event_type") == "purchase").select("event_id", "_site", "_day", "_hhmmss")
    key = F.col("o_orderkey")
    second = (key * 37) % 86400
    orders = t["orders"].join(ev, key == ev.event_id, "left").select(
        "o_orderkey", F.when(F.col("o_orderpriority") == LOW_PRIORITY, "XX").otherwise("TM").alias("_market"),
        F.coalesce("_site", F.concat(F.lit("S"), (key % 3).cast("string"))).alias("_site"),
        F.coalesce("_day", F.date_add(F.lit(first_day).cast("date"), (key % 30).cast("int"))).alias("_day"),
        F.coalesce(F.col("_hhmmss").cast("long"), F.floor(second / 3600) * 10000
                   + F.floor(second % 3600 / 60) * 100 + second % 60).cast("int").alias("_hhmmss"))
    lines = orders.join(t["lineitem"], key == F.col("l_orderkey")).select(
        "o_orderkey", "_market", "_site", "_day", "_hhmmss", "l_partkey",
        F.when(F.col("l_discount") >= 0.05, 1).otherwise(0).alias("_promo"),
        F.when(F.col("l_returnflag") != "R", 1).otherwise(0).alias("_gmv"),
        F.col("l_quantity").cast("int").alias("_quantity"))
    lines = lines.join(t["part"], F.col("l_partkey") == F.col("p_partkey"))

    def cat(c):
        return c.cast("string")

    def name(c):
        return F.concat(F.lit(CATEGORY_NAME_PREFIX), c.cast("string"))

    return lines.select(
        F.col("_day").alias("tim_day_winning_date"),
        F.col("_hhmmss").alias("tim_time_winning_date"),
        F.col("_site").alias("sit_site_id"),
        cat(F.col("p_type")).alias("cat_categ_id_l1"),
        cat(F.col("p_brand")).alias("cat_categ_id_l2"),
        cat(F.col("p_size")).alias("cat_categ_id_l3"),
        name(F.col("p_type")).alias("cat_categ_name_l1"),
        name(F.col("p_brand")).alias("cat_categ_name_l2"),
        name(F.col("p_size")).alias("cat_categ_name_l3"),
        F.col("o_orderkey").cast("decimal(18,0)").alias("ord_order_id"),
        F.col("_day").alias("ord_created_dt"),
        (F.col("l_partkey") % 3).cast("long").alias("ite_item_id"),
        F.col("_promo").alias("ite_today_promotion_flag"),
        F.col("_gmv").alias("ite_gmv_flag"),
        F.when(F.col("l_partkey") % 97 != 0, F.col("p_retailprice").cast("decimal(18,2)")).alias("bid_base_current_price"),
        F.col("_quantity").alias("bid_quantity_ok"),
        F.col("_market").alias("mkt_marketplace_id"),
    )


def customers(t: dict[str, DataFrame]) -> DataFrame:
    c = t["customer"]
    return c.select(F.col("c_custkey").alias("cus_cust_id"),
                    F.when(F.col("c_mktsegment") == TEST_SEGMENT, "true").otherwise("false").alias("is_test"))


def inputs(spark: SparkSession, sf_dir: str, days: int = 0) -> dict[str, DataFrame]:
    """``{"tracks", "bids", "customers"}`` derived from the tables in ``sf_dir``, all
    times moved by so many days."""
    t = load(spark, sf_dir)
    if days:
        t["events"] = t["events"].withColumn("ts", F.col("ts") + F.expr(f"INTERVAL {int(days)} DAYS"))
    first = _dt.date.fromisoformat(FIRST_DAY) + _dt.timedelta(days=days)
    return {"tracks": tracks(t), "bids": bids(t, first.isoformat()), "customers": customers(t)}


_WRITTEN: dict = {}
_LOCK = threading.Lock()


def stored_inputs(spark: SparkSession, sf_dir: str, days: int = 0) -> dict[str, DataFrame]:
    """The derived inputs written once per application as Parquet tables and
    read back through the readers, like the warehouse tables they stand for;
    all times moved by so many ``days``.

    The click-stream is sorted by ``ds`` within each file, where it was made: nothing is
    shuffled for it, an hour that holds very many rows lies in several files, and a pushed
    ``ds`` filter skips pages.  The tables live in the session's checkpoint folder
    (``spark.checkpoint.dir``, shared storage on a cluster) in a folder of this
    application's own; a changed source is seen by a new application."""
    key = (spark.sparkContext.applicationId, sf_dir, days)
    with _LOCK:
        if key not in _WRITTEN:
            _WRITTEN[key] = _store(spark, sf_dir, days)
        paths = _WRITTEN[key]
    return {"tracks": read_tracks(spark, paths["tracks"]), "bids": read_bids(spark, paths["bids"]),
            "customers": read_customers(spark, paths["customers"])}


def _store(spark: SparkSession, sf_dir: str, days: int = 0) -> dict[str, str]:
    base = f"{checkpoint_dir(spark).rstrip('/')}/inputs-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    derived = inputs(spark, sf_dir, days)
    paths = {name: f"{base}/{name}" for name in derived}
    derived["tracks"].sortWithinPartitions("ds").write.parquet(paths["tracks"])
    derived["bids"].write.parquet(paths["bids"])
    derived["customers"].write.parquet(paths["customers"])
    return paths
