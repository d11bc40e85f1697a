"""Plain forms of the look-back join, as checks: every (probe, touch) pair."""

from functools import reduce

from pyspark.sql import functions as F

from promolens.operators.window_join import N


def pair_counts(probes, touches, *, on, lo, hi, at, groups=(), compare="string", how="inner", condition=None):
    """Probe columns, ``groups`` and ``n`` = 1 for each touch in the window."""
    def value(c):
        return F.col(c) if compare == "string" else F.col(c).try_cast("timestamp")

    p = probes.select("*", *[F.col(a).alias(f"__p{i}") for i, (a, _) in enumerate(on)], value(lo).alias("__lo"), value(hi).alias("__hi"))
    extra = [c for c in touches.columns if c not in groups]
    t = touches.select(*[F.col(b).alias(f"__t{i}") for i, (_, b) in enumerate(on)], *groups, *extra, value(at).alias("__at"), F.lit(1).alias("__one"))
    cond = reduce(lambda a, b: a & b, [p[f"__p{i}"] == t[f"__t{i}"] for i in range(len(on))])
    cond = cond & (t["__at"] >= p["__lo"]) & (t["__at"] < p["__hi"])
    if condition is not None:
        cond = cond & condition(p, t)
    j = p.join(t, cond, how)
    return j.select(*[p[c] for c in probes.columns], *[t[g] for g in groups], F.coalesce(t["__one"], F.lit(0)).cast("long").alias(N))


def attributed_pairs(tracks, bids, day, profile, by, once=False):
    """The attributed family with the conditional identity as a residual of an equi
    join on site and item: one row for each line, order event and touch (with ``once``
    one for each line, order event, origin and reported platform)."""
    from promolens.operators.extract import collapse_origin, extract_orders, extract_touches
    from promolens.operators.filters import created_on, day_before, gmv_sales, promo_flagged
    from promolens.operators.joins import line_item_key
    from promolens.functions import value
    from promolens.plans.mart import MART_GRAIN, _finish, _grain_columns

    touches = extract_touches(tracks, day, profile)
    touches = collapse_origin(touches) if by == "global" else touches
    orders = extract_orders(tracks, day, profile)
    o = orders.select(*[F.col(c).alias("o_" + c) for c in orders.columns])
    lines = promo_flagged(created_on(gmv_sales(bids), day))
    won = F.col("tim_day_winning_date")
    lines = lines.where(won == day_before(day) if profile.pin_win_day else won.isNotNull())
    lines = line_item_key(lines).select(*_grain_columns(), "ord_order_id", "item_key", value().alias("__value"), F.col("bid_quantity_ok").alias("__qty"))
    probes = lines.join(o, F.col("ord_order_id") == F.col("o_ord_order_id")).withColumn("__row", F.monotonically_increasing_id())
    t = touches.select(*[F.col(c).alias("t_" + c) for c in touches.columns])
    if profile.identity == "user_then_uid":
        def same(p, tt):
            return F.when(tt["t_user_id"].isNotNull(), tt["t_user_id"] == p["o_user_id"]).otherwise(tt["t_uid"] == p["o_uid"])
    else:
        def same(p, tt):
            return tt["t_uid"] == p["o_uid"]
    matched = pair_counts(probes, t, on=[("o_sit_site_id", "t_sit_site_id"), ("item_key", "t_ite_item_id")], lo="o_order_exact_date_sub_24h",
                          hi="o_order_exact_date", at="t_event_exact_date", groups=["t_landing", "t_platform"], compare=profile.compare, condition=same)
    if once:
        reported = ["t_landing"] + (["t_platform"] if profile.platform_from == "touch" else [])
        matched = matched.dropDuplicates(["__row", *reported])
    platform = F.col("t_platform" if profile.platform_from == "touch" else "o_platform")
    out = matched.groupBy(*MART_GRAIN, "fecha", platform.alias("platform"), F.col("t_landing").alias("landing")).agg(
        F.sum("__value").alias("gmve"), F.sum("__qty").alias("SI")).withColumn("atr_type", F.lit("24 HOURS"))
    return _finish(out)
