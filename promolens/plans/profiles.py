"""Variant profiles: the rows of the variant tables (paths, ``ds`` windows,
item lookup, identity, output shapes) as parameters instead of six copies
of the same job."""

from __future__ import annotations

from dataclasses import dataclass, replace

from promolens.constants import CAROUSEL_COMPONENT, PATH_ORDER_CREATED, PATH_PDP, PATH_VIP

ITEM_ONLY = ("item_id",)
ITEM_FALLBACK = ("item_id", "items", "item_ids")


@dataclass(frozen=True)
class Profile:
    name: str
    touch_paths: tuple = (PATH_VIP,)
    #: ds bounds as (op, days before T, suffix)
    touch_ds: tuple = ((">=", 2, ""), ("<", 0, ""))
    item_keys: tuple = ITEM_FALLBACK
    touch_shape: str = "staged"            # "report" | "staged"
    with_user_id: bool = True              # staged touches / orders keep the login id
    order_paths: tuple = (PATH_ORDER_CREATED,)
    order_ds: tuple = ((">=", 1, " 00"), ("<=", 0, " 00"))
    order_shape: str = "staged"            # "report" | "volume" | "staged"
    order_dedup: bool = False
    order_platform: bool = True            # staged orders keep device.platform
    identity: str = "user_then_uid"        # "uid" | "user_then_uid"
    platform_from: str = "order"           # mart platform: "order" | "touch"
    pin_win_day: bool = False              # also require won on T-1 (else: won date not null)
    compare: str = "string"                # window predicate on text or timestamps
    carousel: str = CAROUSEL_COMPONENT     # fragment c_id of a carousel view
    touch_until: tuple | None = None       # an upper ds bound for runs of a past date

    def but(self, **kw) -> "Profile":
        return replace(self, **kw)

    @property
    def touch_bounds(self) -> tuple:
        return self.touch_ds + ((self.touch_until,) if self.touch_until else ())

    def days(self) -> tuple[int | None, int | None]:
        """Most and least days before the run date that any of its ``ds`` windows
        reaches (the widest window decides); None: not bounded."""
        most, least = [], []
        for bounds in (self.touch_bounds, self.order_ds):
            low = [d for op, d, _ in bounds if op in (">=", ">")]
            high = [d for op, d, _ in bounds if op in ("<=", "<")]
            most.append(min(low) if low else None)
            least.append(max(high) if high else None)
        return (None if None in most else max(most), None if None in least else min(least))


#: attributed GMV report: /vip, item_id only, effective touch window ds >= T-1 00
GMV_REPORT = Profile(
    name="gmv_report", touch_ds=((">=", 8, " 00"), (">=", 1, " 00")), item_keys=ITEM_ONLY,
    touch_shape="report", order_ds=((">=", 7, " 00"), ("<=", 0, " 00")), order_shape="report",
    order_dedup=True, identity="uid", compare="timestamp")

#: attributed volume report: /vip and /pdp, orders of test buyers removed
VOLUME_REPORT = Profile(
    name="volume_report", touch_paths=(PATH_VIP, PATH_PDP), touch_ds=((">=", 2, " 00"), ("<", 0, " 00")),
    touch_shape="report", order_ds=((">=", 1, " 00"), ("<", 0, " 00")), order_shape="volume",
    order_dedup=True, identity="uid", compare="string")

#: daily job: login id when the touch has one, else device id; order platform
DAILY = Profile(name="daily")

#: history loaders: device id only, touch platform
HISTORY = Profile(name="history", with_user_id=False, order_platform=False, identity="uid",
                  platform_from="touch")
