"""Join building blocks for the attributed-sales families."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.functions.keys import item_key

LOGIN, DEVICE = "login", "device"


def collapse_copies(df: DataFrame, weight: str = "__m") -> DataFrame:
    """Identical rows folded into one with their multiplicity.  Partial
    aggregation folds copies map-side, so a group of copies holding a large
    share of the rows never reaches one task whole; downstream sums multiply
    by ``weight`` and stay exactly what the uncollapsed join would give."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(weight))


#: Most rows of packed ids that are broadcast to pick out rows.
PACKED_ROWS = 2_000_000


def pack_ids(ids: DataFrame) -> DataFrame:
    """The whole numbers of a one-column frame, up to 64 neighbours to a row: ``__word, __bits``."""
    i = F.col(ids.columns[0]).cast("long")
    return (ids.where(i.isNotNull()).groupBy(F.shiftright(i, 6).alias("__word"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), i.bitwiseAND(F.lit(63)).cast("int"))).alias("__bits")))


def only_packed(df: DataFrame, column: str, packed: DataFrame) -> DataFrame:
    """Rows whose ``column`` is among the ``packed`` ids, picked out before anything is shuffled.
    ``packed`` must be cheap to count, such as a stored table; with more than ``PACKED_ROWS`` rows
    ``df`` comes back as it is, and a join that follows must drop the others."""
    if packed.limit(PACKED_ROWS + 1).count() > PACKED_ROWS:
        return df
    i = F.col(column).cast("long")
    here = F.getbit("__bits", i.bitwiseAND(F.lit(63)).cast("int")) == 1
    return df.join(F.broadcast(packed), (F.shiftright(i, 6) == F.col("__word")) & here, "left_semi")


def bids_orders(lines: DataFrame, orders: DataFrame, carry=()) -> DataFrame:
    """Sale lines x order-created events on the order id (inner).
    Order columns come out prefixed ``o_``."""
    o = orders.select(*[F.col(c).alias(c if c in carry else "o_" + c) for c in orders.columns])
    cond = [lines["ord_order_id"] == o["o_ord_order_id"]] + [lines[c] == o[c] for c in carry]
    j = lines.join(o, cond, "inner")
    return j.select(*[lines[c] for c in lines.columns], *[o[c] for c in o.columns if c not in carry])


def line_item_key(df: DataFrame) -> DataFrame:
    """The sale line's site-qualified item key, projected before the join."""
    return df.withColumn("item_key", item_key("sit_site_id", "ite_item_id"))


def _tagged(kind: str, c) -> Column:
    """An id with its kind before it, so that ids of different kinds never meet; null stays null."""
    return F.concat(F.lit(f"{kind}:"), c)


def touch_identity(touches: DataFrame, identity: str) -> DataFrame:
    """``identity`` of a touch.  ``user_then_uid``: the login id when the
    touch has one, else the device id; ``uid``: the device id."""
    device = _tagged(DEVICE, F.col("uid"))
    if identity == "uid":
        return touches.withColumn("identity", device)
    if identity != "user_then_uid":
        raise ValueError(identity)
    return touches.withColumn("identity", F.coalesce(_tagged(LOGIN, F.col("user_id")), device))


def order_identities(identity: str, user_col: str, uid_col: str) -> list[Column]:
    """What an order looks up.  With ``user_then_uid`` that is its login id
    (against touches that have one) and its device id (against touches that have
    none).  The two are disjoint by construction, so together they equal the
    reference's CASE-in-ON join, while both stay equi joins on the identity (no
    hot residual on item)."""
    device = _tagged(DEVICE, F.col(uid_col))
    return [device] if identity == "uid" else [_tagged(LOGIN, F.col(user_col)), device]
