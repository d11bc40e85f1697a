"""Row families of the attributed-sales mart (Q8-Q15).

* ``attributed_sales``: value and units of promotion-flagged sales whose
  buyer viewed the item through a promotion surface in the 24 h before the
  order, by origin (``landing`` 0/1) or merged (99).  Like the reference,
  every (sale line, order event, qualifying touch) combination counts, so
  two touches credit a line twice; this is computed as
  ``sum(value x copies x touch count)`` without pairing rows.  With
  ``dedup_touches`` a line is credited once however many touches it has: once
  for each origin (and each platform, where the touch's platform is reported).
* ``promo_sales`` / ``site_sales``: all promotion-flagged / all value sales.
* ``daily_mart``: the four families of one day, ready for one write.
* ``backfill``: the attributed families for many run dates in one plan.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.constants import (
    ATR_24H, ATR_PROMO, ATR_TOTAL, LANDING_ANY, LANDING_CAROUSEL, LANDING_LANDING, LANDING_NONE, PLATFORM_NONE,
)
from promolens.functions import ds_bound, hour_label, hour_of, value, when_flag
from promolens.operators.extract import (
    collapse_origin, extract_orders, extract_touches, touch_rows, with_merged_origin,
)
from promolens.operators.filters import created_on, day_before, gmv_sales, promo_flagged, sold_on
from promolens.operators.joins import (
    bids_orders, collapse_copies, line_item_key, only_packed, order_identities, pack_ids, touch_identity,
)
from promolens.operators.window_join import N, Source, count_in_windows
from promolens.plans.profiles import DAILY, HISTORY
from promolens.sources.mart import stage, stage_touches

MART_GRAIN = ["FechaHora", "hora", "sit_site_id", "category_L1", "category_L2", "category_L3",
              "category_name_L1", "category_name_L2", "category_name_L3"]
MART_COLUMNS = MART_GRAIN + ["platform", "landing", "atr_type", "gmve", "SI", "fecha"]


_LINE = ["tim_day_winning_date", "tim_time_winning_date", "sit_site_id", "cat_categ_id_l1", "cat_categ_id_l2", "cat_categ_id_l3",
         "cat_categ_name_l1", "cat_categ_name_l2", "cat_categ_name_l3", "ord_order_id", "ite_item_id", "bid_base_current_price",
         "bid_quantity_ok"]


def _grain_columns():
    return [
        hour_label("tim_day_winning_date", "tim_time_winning_date").alias("FechaHora"),
        hour_of("tim_time_winning_date").alias("hora"),
        F.col("sit_site_id"),
        F.col("cat_categ_id_l1").alias("category_L1"),
        F.col("cat_categ_id_l2").alias("category_L2"),
        F.col("cat_categ_id_l3").alias("category_L3"),
        F.col("cat_categ_name_l1").alias("category_name_L1"),
        F.col("cat_categ_name_l2").alias("category_name_L2"),
        F.col("cat_categ_name_l3").alias("category_name_L3"),
        F.col("tim_day_winning_date").cast("string").alias("fecha"),
    ]


def _finish(df: DataFrame) -> DataFrame:
    """Measures as DOUBLE value / BIGINT units; columns in mart order."""
    return df.select(*MART_GRAIN, "platform", F.col("landing").cast("int").alias("landing"), "atr_type",
                     F.col("gmve").cast("double").alias("gmve"), F.col("SI").cast("long").alias("SI"), "fecha",
                     *[c for c in df.columns if c not in MART_COLUMNS])


def _probe_windows(bids: DataFrame, orders: DataFrame, analysis_date, profile, carry) -> DataFrame:
    """Promotion-flagged sale lines with the look-back windows of their orders
    (J6), folded to one row per grain, platform and window: map-side partial
    aggregation, so a hot order never reaches one task whole; sums stay linear
    in the touch count applied later."""
    lines = promo_flagged(created_on(gmv_sales(bids), analysis_date))
    if profile.pin_win_day:
        lines = lines.where(F.col("tim_day_winning_date") == day_before(analysis_date))
    else:
        lines = lines.where(F.col("tim_day_winning_date").isNotNull())
    # the join moves the lines as they are stored; text is made of the rows that it leaves
    lines = lines.select(*_LINE, *carry)
    joined = line_item_key(bids_orders(lines, collapse_copies(orders), carry=carry))
    probes = joined.select(*_grain_columns(), "item_key", value().alias("__value"), F.col("bid_quantity_ok").alias("__qty"), *carry,
                           *[c for c in joined.columns if c.startswith("o_")])
    platform_cols = ["o_platform"] if profile.platform_from == "order" else []
    return probes.groupBy(*carry, *MART_GRAIN, "fecha", *platform_cols, *_ids(profile), *_WINDOW).agg(
        F.sum(F.col("__value") * F.col("o___m")).alias("__value"),
        F.sum(F.col("__qty") * F.col("o___m")).alias("__qty"))


_WINDOW = ["o_sit_site_id", "item_key", "o_order_exact_date_sub_24h", "o_order_exact_date"]


def _ids(profile) -> list[str]:
    return ["o_uid"] if profile.identity == "uid" else ["o_user_id", "o_uid"]


def _source(touches: DataFrame, profile, carry) -> Source:
    """Touches by the keys that the probe rows look up."""
    t = touch_identity(touches, profile.identity)
    t = t.select(F.col("sit_site_id").alias("t_site"), "identity", F.col("ite_item_id").alias("t_item"),
                 "event_exact_date", F.col("landing").alias("t_landing"), F.col("platform").alias("t_platform"),
                 *[F.col(c).alias("t_" + c) for c in carry])
    on = [("o_sit_site_id", "t_site"), (order_identities(profile.identity, "o_user_id", "o_uid"), "identity"), ("item_key", "t_item")]
    on += [(c, "t_" + c) for c in carry]
    return Source(t, on, "o_order_exact_date_sub_24h", "o_order_exact_date", "event_exact_date")


def _credit(probes: DataFrame, source: Source, profile, carry, landings, dedup_touches: bool) -> DataFrame:
    """Value and units of the probe rows, once for each touch in their window (or once if there is any)."""
    groups = ["t_platform"] if profile.platform_from == "touch" else []
    matched = count_in_windows(probes, [source], groups=groups, split=("t_landing", landings), compare=profile.compare,
                               preaggregate=False, once=dedup_touches, window=[*carry, *_ids(profile), *_WINDOW])
    platform = F.col("t_platform") if profile.platform_from == "touch" else F.col("o_platform")
    out = (matched.groupBy(*carry, *MART_GRAIN, "fecha", platform.alias("platform"),
                           F.col("t_landing").alias("landing"))
           .agg(F.sum(F.col("__value") * F.col(N)).alias("gmve"), F.sum(F.col("__qty") * F.col(N)).alias("SI"))
           .withColumn("atr_type", F.lit(ATR_24H)))
    return _finish(out)


_ORIGINS = [LANDING_CAROUSEL, LANDING_LANDING]
_LANDINGS = {"origin": _ORIGINS, "global": [LANDING_ANY], "both": [*_ORIGINS, LANDING_ANY]}


def attributed_sales(tracks: DataFrame, bids: DataFrame, analysis_date=None, profile=DAILY, by: str = "origin",
                     touches: DataFrame | None = None, orders: DataFrame | None = None, carry=(),
                     probes: DataFrame | None = None, stage_path: str | None = None,
                     dedup_touches: bool = False) -> DataFrame:
    """Q8-Q11: the ``24 HOURS`` family.

    ``profile``: ``DAILY`` (login id else device id, order platform) or
    ``HISTORY`` (device id, touch platform; with ``pin_win_day`` the line
    must also be won on T-1).  ``by``: ``"origin"`` (landing 0/1),
    ``"global"`` (99) or ``"both"``, counted in one pass.  ``touches``,
    ``orders`` and ``probes`` may be passed ready-made to share them between
    families.

    ``dedup_touches``: a line is credited once for each origin that it was
    viewed through (for ``"global"`` once in all; where the platform is the
    touch's, once for each platform), however often.  That is a range semi-join:
    the last touch before the order decides, and nothing is counted.  Duplicate
    order events still credit a line once each.

    The range count reads the folded sale lines twice, for their windows and
    for the join back.  ``stage_path``, a fresh folder on shared storage, keeps
    them there in between, so that each input is scanned once and the join of
    lines and orders runs once."""
    carry = list(carry)
    if by not in _LANDINGS:
        raise ValueError("by must be 'origin', 'global' or 'both'")
    if touches is None:
        touches = extract_touches(tracks, analysis_date, profile, carry=carry)
    touches = _merged(touches, by)
    if probes is None:
        if orders is None:
            orders = extract_orders(tracks, analysis_date, profile, carry=carry)
        probes = _probe_windows(bids, orders, analysis_date, profile, carry)
        if stage_path is not None:
            probes = stage(probes, stage_path)
    return _credit(probes, _source(touches, profile, carry), profile, carry, _LANDINGS[by], dedup_touches)


def _merged(touches: DataFrame, by: str) -> DataFrame:
    return {"origin": lambda t: t, "global": collapse_origin, "both": with_merged_origin}[by](touches)


def _sold_value_lines(bids: DataFrame, analysis_date=None) -> DataFrame:
    return gmv_sales(sold_on(bids, analysis_date)).select(
        *_grain_columns(), value().alias("__value"), F.col("bid_quantity_ok").alias("__qty"),
        F.col("ite_today_promotion_flag").alias("__promo"))


def _not_touch_based(df: DataFrame, atr_type: str) -> DataFrame:
    return _finish(df.withColumn("platform", F.lit(PLATFORM_NONE)).withColumn("landing", F.lit(LANDING_NONE))
                   .withColumn("atr_type", F.lit(atr_type)))


def promo_sales(bids: DataFrame, analysis_date=None) -> DataFrame:
    """Q12: the ``NO ATTRIBUTION`` family: value and units of promotion-flagged
    sales won on T-1.  Groups without any flagged sale are kept at 0."""
    agg = _sold_value_lines(bids, analysis_date).groupBy(*MART_GRAIN, "fecha").agg(
        F.sum(when_flag("__promo", F.col("__value"))).alias("gmve"),
        F.sum(when_flag("__promo", F.col("__qty"))).alias("SI"))
    return _not_touch_based(agg, ATR_PROMO)


def site_sales(bids: DataFrame, analysis_date=None) -> DataFrame:
    """Q13: the ``TOTAL SITE`` family: value and units of all sales won on T-1."""
    agg = _sold_value_lines(bids, analysis_date).groupBy(*MART_GRAIN, "fecha").agg(
        F.sum("__value").alias("gmve"), F.sum("__qty").alias("SI"))
    return _not_touch_based(agg, ATR_TOTAL)


def promo_and_site_sales(bids: DataFrame, analysis_date=None) -> DataFrame:
    """Q12 and Q13 from one aggregate of one scan: each group emits its
    ``NO ATTRIBUTION`` and its ``TOTAL SITE`` row."""
    agg = _sold_value_lines(bids, analysis_date).groupBy(*MART_GRAIN, "fecha").agg(
        F.sum(when_flag("__promo", F.col("__value"))).alias("p_gmve"),
        F.sum(when_flag("__promo", F.col("__qty"))).alias("p_si"),
        F.sum("__value").alias("t_gmve"), F.sum("__qty").alias("t_si"))
    fam = F.explode(F.array(
        F.struct(F.lit(ATR_PROMO).alias("atr_type"), F.col("p_gmve").alias("gmve"), F.col("p_si").alias("SI")),
        F.struct(F.lit(ATR_TOTAL).alias("atr_type"), F.col("t_gmve").alias("gmve"), F.col("t_si").alias("SI"))))
    rows = agg.select(*MART_GRAIN, "fecha", fam.alias("f")).select(
        *MART_GRAIN, "fecha", "f.atr_type", "f.gmve", "f.SI")
    return _finish(rows.withColumn("platform", F.lit(PLATFORM_NONE)).withColumn("landing", F.lit(LANDING_NONE)))


def daily_mart(tracks: DataFrame, bids: DataFrame, analysis_date=None, profile=DAILY,
               stage_path: str | None = None, dedup_touches: bool = False) -> DataFrame:
    """Q14: the day's four families (by origin, merged, promotion-flagged,
    total) as one frame, for a single partitioned write.  Both attributed
    families come from one pass over touches and lines (``by="both"``);
    ``dedup_touches`` as in ``attributed_sales``.

    With ``stage_path`` (a fresh folder on shared storage) the touches, as in
    the reference job (K1), and the folded sale lines are staged there first:
    the click-stream and the sale lines are then scanned once for both
    attributed families, which read a short lineage that survives executor
    loss.  ``sources.mart.remove_staged`` deletes the folder after the write."""
    touches = extract_touches(tracks, analysis_date, profile)
    probes = _probe_windows(bids, extract_orders(tracks, analysis_date, profile), analysis_date, profile, [])
    if stage_path is not None:
        touches = stage_touches(touches, f"{stage_path}/touches")
        probes = stage(probes, f"{stage_path}/lines")
    attributed = attributed_sales(tracks, bids, analysis_date, profile, "both", touches, probes=probes, dedup_touches=dedup_touches)
    return attributed.unionByName(promo_and_site_sales(bids, analysis_date))


def _as_dates(dates):
    return sorted({_dt.date.fromisoformat(d) if isinstance(d, str) else d for d in dates})


def tag_runs(tracks: DataFrame, dates, profile=HISTORY) -> DataFrame:
    """Click-stream rows tagged with every run date of ``dates`` whose ``ds``
    windows may need them; the windows of ``profile`` give how far back and
    ahead.  The exact per-run predicates are applied later by the extraction
    operators with ``T = run_date``.  A literal range on ``ds`` first keeps
    partition pruning.  ``ds`` text that is no hour is compared as text, as in
    a single run."""
    dates = _as_dates(dates)
    most, least = profile.days()
    if most is None or least is None:
        raise ValueError(f"profile {profile.name!r} has a ds window without a bound, so runs cannot share one plan")
    day = _dt.timedelta(days=1)
    tracks = tracks.where((F.col("ds") >= (dates[0] - most * day).isoformat())
                          & (F.col("ds") < (dates[-1] - (least - 1) * day).isoformat()))
    at = F.expr("try_cast(substring(ds, 1, 10) AS DATE)")
    hour = F.col("ds").rlike(r"^\d{4}-\d{2}-\d{2} \d{2}$") & at.isNotNull()
    near = F.sequence(F.date_add(at, least), F.date_add(at, most))
    as_text = F.filter(F.array(*[F.lit(d) for d in dates]), lambda d: (
        (F.col("ds") >= F.date_sub(d, most).cast("string")) & (F.col("ds") < F.date_sub(d, least - 1).cast("string"))))
    tagged = tracks.withColumn("run_date", F.explode(F.when(hour, near).otherwise(as_text)))
    return tagged.where(F.col("run_date").isin(*dates))


def created_days(bids: DataFrame) -> list:
    """The days on which orders of the sale lines were created (one small row each)."""
    return sorted(r[0] for r in bids.select("ord_created_dt").where("ord_created_dt is not null").distinct().collect())


def _bounds_as_time(profile) -> bool:
    """Whether bounds on the text ``ds`` are bounds on the time text of an event that is stored under its own hour:
    of texts that begin with the ``ds``, those from a bound on (or before it) are the same."""
    return profile.compare == "string" and all(op in (">=", "<") and len(suffix) <= 3 for op, _, suffix in profile.touch_bounds)


#: Run dates of one mask of bits.
_MASK = 60


def run_touches(tracks: DataFrame, dates, profile=HISTORY, by: str = "origin") -> DataFrame:
    """Touches for many run dates, without a copy for each run.  ``run`` is null for touches stored
    under the hour of their own time, which are there once; the others have a row for every run whose
    ``ds`` window they are in.

    Which of the first a run may see is left to the probes (see ``backfill``).  A touch that was stored under
    its own hour and under others is one touch, as in the runs' DISTINCT."""
    dates = _as_dates(dates)
    if by not in ("origin", "global"):
        raise ValueError("by must be 'origin' or 'global'")
    bounds = [(_bound_text(profile.touch_bounds, d, ">="), _bound_text(profile.touch_bounds, d, "<")) for d in dates]
    near = reduce(lambda a, b: a | b, [(F.col("ds") >= lo) & (F.col("ds") < hi) for lo, hi in _merged_ranges(bounds)])
    rows = touch_rows(tracks, near, profile, ["ds"]).where("event_exact_date is not null")
    if by == "global":
        rows = rows.withColumn("landing", F.lit(LANDING_ANY))
    hour = F.substring("event_exact_date", 1, 13)
    own = F.col("ds") == hour
    cols = [c for c in rows.columns if c != "ds"]

    def runs(k):  # one expression: a call for each literal would take longer than the query
        each = list(zip(dates, bounds))[k:k + _MASK]
        return F.expr("array(" + ", ".join(f"named_struct('run', DATE'{d}', 'lo', '{lo}', 'hi', '{hi}', 'bit', {1 << b}L)"
                                           for b, (d, (lo, hi)) in enumerate(each)) + ")")

    def mask(k):
        seen = F.filter(runs(k), lambda r: (F.col("ds") >= r["lo"]) & (F.col("ds") < r["hi"]))
        return F.when(own, F.lit(0).cast("long")).otherwise(
            F.aggregate(seen, F.lit(0).cast("long"), lambda m, r: m.bitwiseOR(r["bit"])))

    steps = range(0, len(dates), _MASK)
    once = rows.groupBy(*cols).agg(F.max(own).alias("__own"), *[F.bit_or(mask(k)).alias(f"__mask{k}") for k in steps])
    elsewhere = [_others(runs(k), F.col(f"__mask{k}"), hour) for k in steps]
    here = F.when(F.col("__own"), F.array(F.lit(None).cast("date"))).otherwise(F.array().cast("array<date>"))
    some = reduce(lambda a, b: a | b, [F.col(f"__mask{k}") != 0 for k in steps])
    return once.select(*cols, F.explode(F.when(some, F.concat(here, *elsewhere)).otherwise(here)).alias("run"))


def _others(runs, mask, hour):
    """Runs of a mask of bits, but for those that see the touch under its own hour."""
    seen = F.filter(runs, lambda r: (mask.bitwiseAND(r["bit"]) != 0) & ~(F.col("__own") & (hour >= r["lo"]) & (hour < r["hi"])))
    return F.transform(seen, lambda r: r["run"])


def _merged_ranges(ranges: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Text ranges joined where they touch; of very many one that holds all."""
    out: list[list[str]] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out] if len(out) <= 50 else [(out[0][0], max(hi for _, hi in out))]


def _bound_text(bounds, day, wanted: str) -> str:
    """The bound of that direction on ``ds`` for one run date."""
    texts = [(day - _dt.timedelta(days=back)).isoformat() + suffix for op, back, suffix in bounds if op == wanted]
    return max(texts) if wanted == ">=" else min(texts)


def _bound_column(bounds, day, wanted: str):
    """The same for a column of run dates."""
    texts = [ds_bound(day, back, suffix) for op, back, suffix in bounds if op == wanted]
    return texts[0] if len(texts) == 1 else (F.greatest if wanted == ">=" else F.least)(*texts)


def backfill(tracks: DataFrame, bids: DataFrame, dates, profile=None, by: str = "origin",
             stage_path: str | None = None, dedup_touches: bool = False) -> DataFrame:
    """Q15: the history loaders for many run dates as one plan.

    Equivalent to running the loader once per date and appending: rows of
    different runs are never merged, even at the same grain.  ``dedup_touches``
    as in ``attributed_sales``.

    Touches are not copied for the runs.  A run reads the touches of a ``ds``
    window; for an event stored under the hour of its own time that is a range
    of its time, so it narrows the look-back windows of the run's orders instead.
    Only touches stored elsewhere (late files) are tagged with their runs, and
    looked up beside the others."""
    dates = _as_dates(dates)
    if profile is None:
        profile = HISTORY.but(pin_win_day=(by == "origin"))
    run = F.col("run_date")
    tagged_tracks = tag_runs(tracks, dates, profile)
    # literals on the source columns, so that they reach the scan
    days = [d - _dt.timedelta(days=1) for d in dates]

    def on_days(c):
        return F.col(c).between(days[0], days[-1]) & F.col(c).isin(*days)

    wanted = on_days("ord_created_dt")
    if profile.pin_win_day:
        wanted = wanted & on_days("tim_day_winning_date")
    tagged_bids = bids.where(wanted).withColumn("run_date", F.date_add("ord_created_dt", 1))
    if not _bounds_as_time(profile):
        out = attributed_sales(tagged_tracks, tagged_bids, run, profile, by, carry=["run_date"], stage_path=stage_path,
                               dedup_touches=dedup_touches)
        return out.drop("run_date")
    carry = ["run_date"]
    orders = extract_orders(tagged_tracks, run, profile, carry=carry)
    if stage_path is not None:
        # few lines belong to an order event: the others are not moved
        orders = stage(orders, f"{stage_path}/orders")
        known = stage(pack_ids(orders.select("ord_order_id")), f"{stage_path}/ids")
        tagged_bids = only_packed(tagged_bids, "ord_order_id", known)
    probes = _probe_windows(tagged_bids, orders, run, profile, carry)
    if stage_path is not None:
        probes = stage(probes, f"{stage_path}/lines")
    every = F.lit("every")
    t = run_touches(tracks, dates, profile, by).withColumn("seen_by", F.coalesce(F.col("run").cast("string"), every))
    source = _source(t, profile, ["seen_by"])
    site, (ids, identity), item, _ = source.on
    low, high = (_bound_column(profile.touch_bounds, run, op) for op in (">=", "<"))
    lo, hi = F.col(source.lo), F.col(source.hi)
    # for each identity a lookup among the touches that runs share, within the run's bounds, and one among its own
    source = source._replace(
        on=[site, ([i for i in ids for _ in range(2)], identity), item, ([every, run.cast("string")] * len(ids), "t_seen_by")],
        lo=[F.greatest(lo, low), lo] * len(ids), hi=[F.least(hi, high), hi] * len(ids))
    out = _credit(probes, source, profile, carry, _LANDINGS[by], dedup_touches)
    return out.drop("run_date")
