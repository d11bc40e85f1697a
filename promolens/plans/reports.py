"""The two ad-hoc reports (Q4-Q7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.constants import ORIGIN_CAROUSEL, ORIGIN_LANDING
from promolens.operators.extract import extract_orders, extract_touches, sales_lines
from promolens.operators.window_join import N, count_in_window
from promolens.plans.profiles import GMV_REPORT, VOLUME_REPORT
from promolens.sources.schemas import SALES_GRAIN
from promolens.sources.tables import test_customers

SITE_HOUR = ["sit_site_id", "FechaHora"]

_TOUCH_KEYS = ("site_id", "platform", "item_id", "uid")


def _origin_touches(touches: DataFrame) -> DataFrame:
    return touches.withColumnRenamed("origin", "__origin").select(
        *[F.col(k).alias("t_" + k) for k in _TOUCH_KEYS], "__origin", "event_exact_date")


def _counts(matched: DataFrame, grain) -> DataFrame:
    carousel = F.sum(F.when(F.col("__origin") == ORIGIN_CAROUSEL, F.col(N)).otherwise(0))
    landing = F.sum(F.when(F.col("__origin") == ORIGIN_LANDING, F.col(N)).otherwise(0))
    return matched.groupBy(*grain).agg(carousel.alias("n_carousel"), landing.alias("n_landing"))


def order_touch_counts(touches: DataFrame, orders: DataFrame, *, compare="timestamp", how="inner",
                       grain=("site_id", "platform", "item_id", "order_id")) -> DataFrame:
    """Q4 (A4 over J1/J2): per order, the number of carousel and landing
    touches by the same device, of the same item on the same site and
    platform, in the 24 h before the order."""
    t = _origin_touches(touches)
    on = [(F.trim(F.col(k)), F.trim(F.col("t_" + k))) for k in _TOUCH_KEYS]
    matched = count_in_window(orders, t, on=on, lo="order_exact_date_sub_24h", hi="order_exact_date",
                              at="event_exact_date", split=("__origin", [ORIGIN_CAROUSEL, ORIGIN_LANDING]), compare=compare, how=how,
                              preaggregate=False, expand="probes")
    counts = _counts(matched, list(grain))
    return counts if how == "left" else counts.where("n_carousel + n_landing > 0")


def gmv_report(tracks: DataFrame, bids: DataFrame, analysis_date=None, grain=SALES_GRAIN,
               profile=GMV_REPORT, order_key: str = "number") -> DataFrame:
    """Q5/Q6: attributed sales value by hour x site x category (or any
    coarser ``grain``, e.g. ``SITE_HOUR``).

    Sales are the value lines won on T-1.  An order counts as attributed to
    an origin when it has at least one touch of that origin on its first item
    in the look-back; every line of the order is then credited.  The lines
    are joined to per-(site, platform, item, order) counts on the order id
    only, so an order with several such rows credits its lines once per row,
    exactly as the reference's LEFT JOIN does.  The counts are first folded
    to one row per order (how many rows, and how many with a landing /
    carousel / any touch), which makes the final join many-to-one.

    Measures: ``GMVE_AG, SI_AG`` (promotion-flagged lines), ``GMVE_TS, SI_TS``
    (all lines), ``GMVE_LAN, SI_LAN``, ``GMVE_CAR, SI_CAR``, ``GMVE_TA, SI_TA``
    (attributed to landing, carousel, either).

    ``order_key="text"`` joins lines and counts on the order id as trimmed
    text instead of as a number (the reference's variant for keys stored
    with different types)."""
    if order_key not in ("number", "text"):
        raise ValueError("order_key must be 'number' or 'text'")

    def keyed(df):
        return df.withColumn("order_id", F.trim(F.col("order_id").cast("string"))) if order_key == "text" else df

    touches = extract_touches(tracks, analysis_date, profile)
    lines = keyed(sales_lines(bids, analysis_date))
    # orders whose device has no touch of the item end in the first join of the count, which needs no
    # second pass over the sale lines to be selective
    orders = keyed(extract_orders(tracks, analysis_date, profile))
    counts = order_touch_counts(touches, orders, compare=profile.compare)
    per_order = counts.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("__rows"),
        F.count(F.when(F.col("n_landing") > 0, 1)).alias("__lan"),
        F.count(F.when(F.col("n_carousel") > 0, 1)).alias("__car"),
        F.count(F.when(F.col("n_landing") + F.col("n_carousel") > 0, 1)).alias("__ta"),
    )
    j = lines.join(per_order, "order_id", "left")
    rows = F.coalesce(F.col("__rows"), F.lit(1))

    def weighted(measure, w):
        if w is None:
            return F.sum(F.col(measure) * rows)
        # a line without touches adds 0, also when its value is unknown
        return F.sum(F.when(F.col(w) > 0, F.col(measure) * F.col(w)).otherwise(F.lit(0)))

    out = j.groupBy(*grain).agg(
        weighted("GMVE_AG", None).alias("GMVE_AG"), weighted("SI_AG", None).alias("SI_AG"),
        weighted("GMVE_TS", None).alias("GMVE_TS"), weighted("SI_TS", None).alias("SI_TS"),
        weighted("GMVE_TS", "__lan").alias("GMVE_LAN"), weighted("SI_TS", "__lan").alias("SI_LAN"),
        weighted("GMVE_TS", "__car").alias("GMVE_CAR"), weighted("SI_TS", "__car").alias("SI_CAR"),
        weighted("GMVE_TS", "__ta").alias("GMVE_TA"), weighted("SI_TS", "__ta").alias("SI_TA"),
    )
    return out


def volume_report(tracks: DataFrame, customers: DataFrame, analysis_date=None, profile=VOLUME_REPORT) -> DataFrame:
    """Q7: attributed order value and units by site x platform x status.

    Orders are the order-created events of T-1 (test accounts removed); the
    value and units come from the event itself (``total_amount_usd`` and the
    first item's ``quantity``), read as numbers (unreadable text -> null).
    Every order is kept (left join) with its carousel / landing touch counts;
    ``GMV_AG``/``SI_AG`` are the orders with any touch."""
    touches = extract_touches(tracks, analysis_date, profile)
    orders = extract_orders(tracks, analysis_date, profile, test_buyers=test_customers(customers))
    inner_grain = ["site_id", "platform", "item_id", "order_id", "uid", "status", "item_quantity", "gmv"]
    per_order = order_touch_counts(touches, orders, compare=profile.compare, how="left",
                                   grain=inner_grain)

    def num(c):
        # read as DOUBLE like the reference, then sum exactly (decimal) so the
        # total does not depend on the order of addition
        return F.col(c).try_cast("double").try_cast("decimal(38,6)")

    def attributed(cond, c):
        return F.sum(F.when(cond, num(c)).otherwise(F.lit(0))).cast("double")

    car = F.col("n_carousel") > 0
    lan = F.col("n_landing") > 0
    anyt = (F.col("n_carousel") + F.col("n_landing")) > 0
    return per_order.groupBy("site_id", "platform", "status").agg(
        attributed(car, "gmv").alias("GMV_CAR"), attributed(car, "item_quantity").alias("SI_CAR"),
        attributed(lan, "gmv").alias("GMV_LAN"), attributed(lan, "item_quantity").alias("SI_LAN"),
        attributed(anyt, "gmv").alias("GMV_AG"), attributed(anyt, "item_quantity").alias("SI_AG"),
        F.sum(num("item_quantity")).cast("double").alias("SI_TS"),
        F.sum(num("gmv")).cast("double").alias("GMVE_TS"),
    )
