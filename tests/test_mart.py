import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import CAROUSEL, DEAL, bid, bids_df, order, rows, srt, tracks_df, view

from pairs import attributed_pairs
from promolens.operators.extract import extract_touches
from promolens.plans.mart import attributed_sales, backfill, created_days, daily_mart, promo_sales, site_sales, tag_runs
from promolens.plans.profiles import DAILY, HISTORY
from promolens.sources import fixtures
from promolens.sources.mart import append_mart, read_mart, write_mart_run
from promolens.sources.schemas import MART_SCHEMA

T = dt.date(2024, 1, 3)


def _gmve(df, **where):
    out = df
    for k, v in where.items():
        out = out.where(F.col(k) == v)
    return sorted(float(r["gmve"]) for r in out.collect())


def test_conditional_identity(spark):
    tr = tracks_df(spark, [
        view(user_id="1", uid="u5", item="S01", at="2024-01-02 09:00:00"),   # login match
        view(user_id="2", uid="u1", item="S02", at="2024-01-02 09:00:00"),   # login set, unequal: no match
        view(user_id=None, uid="u1", item="S03", at="2024-01-02 09:00:00"),  # no login: device match
        order(1, user_id="1", uid="u1", at="2024-01-02 12:00:00"),
    ])
    b = bids_df(spark, [bid(1, item=1, price="10.00", qty=1), bid(1, item=2, price="20.00", qty=1),
                        bid(1, item=3, price="40.00", qty=1)])
    daily = attributed_sales(tr, b, T, DAILY, "origin")
    assert _gmve(daily) == [50.0]                          # items 1 and 3, same grain
    hist = attributed_sales(tr, b, T, HISTORY, "origin")   # device id only
    assert _gmve(hist) == [60.0]                           # items 2 and 3 by device id, same grain
    assert _gmve(attributed_pairs(tr, b, T, DAILY, "origin")) == [50.0]


def test_fan_out_of_touches_and_duplicate_orders(spark):
    tr = tracks_df(spark, [
        view(fragment=CAROUSEL, at="2024-01-02 09:00:00"),
        view(at="2024-01-02 10:00:00"),
        view(at="2024-01-02 10:00:00", platform="mobile"),    # same second, other platform: a third touch
        order(1, at="2024-01-02 12:00:00"), order(1, at="2024-01-02 12:00:00"),   # duplicate event
    ])
    b = bids_df(spark, [bid(1, price="10.00", qty=1)])
    origin = attributed_sales(tr, b, T, DAILY, "origin")
    assert rows(origin, "landing", "gmve", "SI") == [(0, 20.0, 2), (1, 40.0, 4)]
    merged = attributed_sales(tr, b, T, DAILY, "global")
    assert rows(merged, "landing", "gmve", "SI") == [(99, 60.0, 6)]


def test_promo_and_total_families(spark):
    b = bids_df(spark, [bid(1, price="10.00", qty=1, promo=1), bid(2, price="5.00", qty=2, promo=0),
                        bid(3, price="7.00", qty=1, promo=0, gmv=0), bid(4, price="7.00", qty=1, mkt="XX"),
                        bid(5, price="3.00", qty=1, won="2024-01-01")])
    p = promo_sales(b, T).first()
    s = site_sales(b, T).first()
    assert (p["gmve"], p["SI"], p["platform"], p["landing"], p["atr_type"]) == (10.0, 1, "NA", 100, "NO ATTRIBUTION")
    assert (s["gmve"], s["SI"], s["atr_type"], s["fecha"]) == (20.0, 3, "TOTAL SITE", "2024-01-02")
    only_plain = promo_sales(bids_df(spark, [bid(9, promo=0)]), T).first()
    assert (only_plain["gmve"], only_plain["SI"]) == (0.0, 0)      # group kept at 0


@pytest.fixture(scope="module")
def small(spark):
    return fixtures.inputs(spark, "/root/testdata/sf0.001")


def test_daily_mart_is_the_union_and_round_trips(spark, tmp_path):
    i = fixtures.inputs(spark, "/root/testdata/sf0.01")
    d = T
    mart = daily_mart(i["tracks"], i["bids"], d).cache()
    fams = {r["atr_type"]: r["count"] for r in mart.groupBy("atr_type").count().collect()}
    assert fams["TOTAL SITE"] == fams["NO ATTRIBUTION"] > 0
    assert set(r["landing"] for r in mart.collect()) == {0, 1, 99, 100}
    path = str(tmp_path / "mart")
    append_mart(mart, path)
    back = read_mart(spark, path)
    assert back.schema == MART_SCHEMA
    assert back.count() == mart.count()
    append_mart(mart, path)                           # reference mode: a rerun appends again
    assert read_mart(spark, path).count() == 2 * mart.count()
    runs = str(tmp_path / "runs")
    write_mart_run(mart, runs, d)
    write_mart_run(mart, runs, d)                     # idempotent per run
    assert read_mart(spark, runs).count() == mart.count()
    total = mart.where("atr_type = 'TOTAL SITE'").agg(F.sum("gmve")).first()[0]
    promo = mart.where("atr_type = 'NO ATTRIBUTION'").agg(F.sum("gmve")).first()[0]
    assert promo <= total


def test_backfill_equals_one_run_per_date(spark, small):
    dates = [dt.date(2024, 1, 5), dt.date(2024, 1, 6), dt.date(2024, 1, 9)]
    for by, prof in (("origin", HISTORY.but(pin_win_day=True)), ("global", HISTORY)):
        one_plan = backfill(small["tracks"], small["bids"], dates, by=by)
        per_date = None
        for d in dates:
            part = attributed_sales(small["tracks"], small["bids"], d, prof, by)
            per_date = part if per_date is None else per_date.unionByName(part)
        assert sorted(map(tuple, one_plan.collect())) == sorted(map(tuple, per_date.collect()))


def _displaced(tracks):
    """The click-stream with a tenth of its events also, and a tenth only, stored under another hour."""
    h = F.xxhash64("event_data", "server_timestamp", "usr") % 10
    later = F.date_format(F.to_timestamp("ds", "yyyy-MM-dd HH") + F.expr("INTERVAL 30 HOURS"), "yyyy-MM-dd HH")
    earlier = F.date_format(F.to_timestamp("ds", "yyyy-MM-dd HH") - F.expr("INTERVAL 20 HOURS"), "yyyy-MM-dd HH")
    moved = tracks.where(F.abs(h) == 1).withColumn("ds", later).unionByName(tracks.where(F.abs(h) == 2).withColumn("ds", earlier))
    return tracks.where(F.abs(h) != 2).unionByName(moved).unionByName(tracks.where(F.abs(h) == 3).withColumn("ds", F.lit("2024-01-0")))


@pytest.mark.parametrize("once", [False, True])
def test_backfill_with_touches_stored_under_other_hours(spark, once):
    i = fixtures.inputs(spark, "/root/testdata/sf0.001")
    tracks = _displaced(i["tracks"]).cache()
    dates = [dt.date(2024, 1, d) for d in (2, 3, 4, 6, 9)]
    for by, prof in (("origin", HISTORY.but(pin_win_day=True)), ("global", HISTORY), ("origin", DAILY)):
        one_plan = backfill(tracks, i["bids"], dates, prof, by, dedup_touches=once)
        per_date = [r for d in dates for r in rows(attributed_sales(tracks, i["bids"], d, prof, by, dedup_touches=once))]
        assert rows(one_plan) == srt(per_date) and per_date


def test_more_runs_than_a_mask_holds(spark, small, monkeypatch):
    from promolens.plans import mart
    tracks = _displaced(small["tracks"]).cache()
    dates = [dt.date(2024, 1, d) for d in range(1, 20)]
    whole = rows(mart.run_touches(tracks, dates))
    monkeypatch.setattr(mart, "_MASK", 4)
    assert rows(mart.run_touches(tracks, dates)) == whole


def test_backfill_does_not_copy_touches(spark, small, tmp_path):
    from promolens.plans.mart import run_touches
    dates = [dt.date(2024, 1, d) for d in range(2, 9)]
    small["tracks"].write.parquet(str(tmp_path / "tracks"))
    tracks = spark.read.parquet(str(tmp_path / "tracks"))
    own = run_touches(tracks, dates)
    assert own.where("run is not null").count() == 0 and own.count() > 0
    own = own.drop("run")
    want = None
    for d in dates:
        one = extract_touches(tracks, d, HISTORY)
        want = one if want is None else want.union(one)
    assert rows(own) == rows(want.distinct())
    plan = own._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and not any("Generate explode" in ln for ln in final[final.index("Exchange"):].splitlines())
    # of touches stored under other hours only those have a row for each run
    late = run_touches(_displaced(tracks), dates)
    assert 0 < late.where("run is not null").count() < late.where("run is null").count()


@pytest.mark.parametrize("profile", [DAILY, HISTORY], ids=["daily", "history"])
@pytest.mark.parametrize("by", ["origin", "global"])
def test_dedup_touches_against_pairs(spark, profile, by):
    i = fixtures.inputs(spark, "/root/testdata/sf0.01")
    got = attributed_sales(i["tracks"], i["bids"], T, profile, by, dedup_touches=True)
    want = attributed_pairs(i["tracks"], i["bids"], T, profile, by, once=True)
    assert rows(got) == rows(want) and got.count() > 0
    more = attributed_sales(i["tracks"], i["bids"], T, profile, by)
    assert got.agg(F.sum("SI")).first()[0] <= more.agg(F.sum("SI")).first()[0]


def test_dedup_touches_by_hand(spark):
    tr = tracks_df(spark, [
        view(fragment=CAROUSEL, at="2024-01-02 09:00:00"), view(fragment=CAROUSEL, at="2024-01-02 09:30:00"),
        view(at="2024-01-02 10:00:00"), view(at="2024-01-02 10:00:00", platform="mobile"), view(at="2024-01-02 12:00:00"),
        order(1, at="2024-01-02 12:00:00"), order(1, at="2024-01-02 12:00:00"), order(2, item="S02", at="2024-01-02 12:00:00"),
    ])
    b = bids_df(spark, [bid(1, price="10.00", qty=1), bid(2, item=2, price="7.00", qty=1)])
    origin = attributed_sales(tr, b, T, DAILY, "origin", dedup_touches=True)
    assert rows(origin, "landing", "gmve", "SI") == [(0, 20.0, 2), (1, 20.0, 2)]      # two order events
    assert rows(attributed_sales(tr, b, T, DAILY, "global", dedup_touches=True), "landing", "gmve") == [(99, 20.0)]
    history = attributed_sales(tr, b, T, HISTORY, "origin", dedup_touches=True)
    assert rows(history, "platform", "landing", "SI") == [("mobile", 1, 2), ("web", 0, 2), ("web", 1, 2)]
    mart = daily_mart(tr, b, T, dedup_touches=True)
    assert rows(mart.where("atr_type = '24 HOURS'"), "landing", "gmve") == [(0, 20.0), (1, 20.0), (99, 20.0)]


def test_both_families_in_one_pass(spark):
    i = fixtures.inputs(spark, "/root/testdata/sf0.01")
    for once in (False, True):
        both = attributed_sales(i["tracks"], i["bids"], T, DAILY, "both", dedup_touches=once)
        apart = [attributed_sales(i["tracks"], i["bids"], T, DAILY, by, dedup_touches=once) for by in ("origin", "global")]
        assert rows(both) == rows(apart[0].unionByName(apart[1]))
    with pytest.raises(ValueError):
        attributed_sales(i["tracks"], i["bids"], T, DAILY, "none")


def test_origin_rows_cover_merged_rows(spark):
    i = fixtures.inputs(spark, "/root/testdata/sf0.01")
    by_origin = attributed_sales(i["tracks"], i["bids"], T, DAILY, "origin")
    merged = attributed_sales(i["tracks"], i["bids"], T, DAILY, "global")
    o = by_origin.agg(F.sum("gmve"), F.sum("SI")).first()
    m = merged.agg(F.sum("gmve"), F.sum("SI")).first()
    assert o[0] >= m[0] > 0 and o[1] >= m[1] > 0
    pairs = attributed_pairs(i["tracks"], i["bids"], T, DAILY, "origin")
    assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, by_origin.collect()))


def test_hot_key_matches_brute_force(spark):
    """One (site, user, item) key holds about a third of all rows: the bucketed
    count must equal the plain pair join exactly."""
    import random
    rnd = random.Random(7)
    rows_ = []
    for i in range(600):       # hot key: many touches of one item by one user
        rows_.append(view(user_id="1", uid="u1", item="S01", fragment=CAROUSEL if i % 3 else DEAL,
                          at=f"2024-01-0{rnd.choice([1, 2])} {rnd.randint(0, 23):02d}:{rnd.randint(0, 59):02d}:"
                             f"{rnd.randint(0, 59):02d}"))
    for i in range(1200):      # background keys
        u = rnd.randint(2, 400)
        rows_.append(view(user_id=str(u), uid=f"u{u}", item=f"S0{rnd.randint(0, 2)}",
                          at=f"2024-01-0{rnd.choice([1, 2])} {rnd.randint(0, 23):02d}:00:00"))
    for k in range(60):        # many orders on the hot key, plus duplicates of one
        rows_.append(order(k + 1, user_id="1", uid="u1", at=f"2024-01-02 {k % 24:02d}:30:00"))
    rows_.append(order(1, user_id="1", uid="u1", at="2024-01-02 00:30:00"))
    tr = tracks_df(spark, rows_)
    b = bids_df(spark, [bid(k + 1, item=1, price="3.00", qty=1 + k % 2) for k in range(60)]
                + [bid(1, item=1, price="5.00", qty=1)])
    for by in ("origin", "global"):
        got = attributed_sales(tr, b, T, DAILY, by)
        want = attributed_pairs(tr, b, T, DAILY, by)
        assert rows(got) == rows(want) and got.count() > 0


def test_mart_run_rerun_replaces_whole_run(spark, tmp_path):
    from promolens.sources.mart import write_mart_run as write_run
    b = bids_df(spark, [bid(1, won="2024-01-02"), bid(2, won="2024-01-01", created="2024-01-02")])
    two_days = site_sales(b, "2024-01-03").unionByName(site_sales(b, "2024-01-02"))
    runs = str(tmp_path / "runs")
    write_run(two_days, runs, T)
    assert sorted(r["fecha"] for r in read_mart(spark, runs).collect()) == ["2024-01-01", "2024-01-02"]
    write_run(site_sales(b, "2024-01-03"), runs, T)        # rerun no longer has 2024-01-01
    assert [r["fecha"] for r in read_mart(spark, runs).collect()] == ["2024-01-02"]
    write_run(site_sales(b, "2024-01-02"), runs, dt.date(2024, 1, 2))   # another run is kept apart
    assert read_mart(spark, runs).count() == 2


def test_stage_touches_round_trip(spark, tmp_path):
    from promolens.operators.extract import extract_touches
    from promolens.sources.mart import stage_touches
    from promolens.sources.schemas import TOUCH_SCHEMA
    tr = tracks_df(spark, [view(at="2024-01-02 10:00:00"), view(at="2024-01-02 11:00:00", fragment=CAROUSEL,
                                                                    user_id=None)])
    touches = extract_touches(tr, T, DAILY)
    staged = stage_touches(touches, str(tmp_path / "stage"))
    assert staged.schema == TOUCH_SCHEMA
    assert rows(staged) == rows(touches.select(*[f.name for f in TOUCH_SCHEMA.fields]))


def test_residual_identity_join_equals_tagged(spark):
    i = fixtures.inputs(spark, "/root/testdata/sf0.01")
    for prof in (DAILY, HISTORY):
        for by in ("origin", "global"):
            tagged = attributed_sales(i["tracks"], i["bids"], T, prof, by)
            residual = attributed_pairs(i["tracks"], i["bids"], T, prof, by)
            assert rows(tagged) == rows(residual) and tagged.count() > 0


def test_backfill_follows_the_profile_however_far_it_looks(spark):
    tr = tracks_df(spark, [view(at="2024-01-02 10:00:00"), order(1, at="2024-01-02 12:00:00"),
                           order(2, at="2023-12-28 12:00:00"), view(at="2023-12-28 10:00:00")])
    b = bids_df(spark, [bid(1, price="10.00", qty=1), bid(2, price="4.00", qty=1)])
    wide = HISTORY.but(order_ds=((">=", 7, " 00"), ("<=", 0, " 00")), touch_ds=((">=", 8, ""), ("<", 0, "")))
    assert wide.days() == (8, 0)
    assert _gmve(attributed_sales(tr, b, T, wide, "origin")) == [14.0]
    assert _gmve(backfill(tr, b, [T], wide)) == [14.0]
    open_ended = wide.but(touch_ds=((">=", 8, ""),))
    with pytest.raises(ValueError, match="without a bound"):
        backfill(tr, b, [T], open_ended)


def test_malformed_hours_are_compared_as_text(spark):
    from promolens.sources.schemas import TRACKS_SCHEMA
    rows_ = [order(1, at="2024-01-02 12:00:00"), view(at="2024-01-02 10:00:00")]
    odd = [r[:-1] + (ds,) for r, ds in ((view(at="2024-01-02 11:00:00"), "2024-01-02x"), (view(at="2024-01-02 11:30:00"), "2024-13-45 99"))]
    tr = spark.createDataFrame(rows_ + odd, TRACKS_SCHEMA)
    b = bids_df(spark, [bid(1, price="10.00", qty=1)])
    want = _gmve(attributed_sales(tr, b, T, HISTORY, "origin"))
    assert want == [20.0] and _gmve(backfill(tr, b, [T], HISTORY)) == want
    assert {r["ds"] for r in tag_runs(tr, [T]).collect()} == {"2024-01-02 12", "2024-01-02 10", "2024-01-02x"}


def test_backfill_dates_come_from_the_lines(spark, small):
    days = created_days(small["bids"])
    assert days == sorted(set(days)) and len(days) >= 30


def test_staging_gives_the_same_rows_and_can_be_removed(spark, tmp_path):
    from promolens.sources.mart import remove_staged
    i = fixtures.inputs(spark, "/root/testdata/sf0.001")
    d = dt.date(2024, 1, 10)
    plain = rows(daily_mart(i["tracks"], i["bids"], d))
    at = str(tmp_path / "staged")
    assert rows(daily_mart(i["tracks"], i["bids"], d, stage_path=at)) == plain
    remove_staged(spark, at)
    assert not (tmp_path / "staged").exists()


def test_mart_in_a_catalog_table(spark):
    b = bids_df(spark, [bid(1), bid(2, won="2024-01-01")])
    spark.sql("DROP TABLE IF EXISTS mart_test")
    try:
        append_mart(site_sales(b, T), "mart_test")
        append_mart(site_sales(b, "2024-01-02"), "mart_test")
        assert read_mart(spark, "mart_test").schema == MART_SCHEMA
        assert sorted(r["fecha"] for r in read_mart(spark, "mart_test").collect()) == ["2024-01-01", "2024-01-02"]
        assert spark.sql("SHOW PARTITIONS mart_test").count() == 2
    finally:
        spark.sql("DROP TABLE IF EXISTS mart_test")


def test_no_date_means_today(spark):
    today = spark.sql("SELECT current_date() AS d").first()["d"]
    won = (today - dt.timedelta(days=1)).isoformat()
    tr = tracks_df(spark, [view(at=f"{won} 10:00:00"), order(1, at=f"{won} 12:00:00")])
    b = bids_df(spark, [bid(1, won=won, price="10.00", qty=1), bid(1, won="2024-01-02", price="1.00", qty=1)])
    assert _gmve(daily_mart(tr, b)) == _gmve(daily_mart(tr, b, today)) == [10.0] * 4
