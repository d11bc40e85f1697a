import random

import pytest
from pyspark.sql import functions as F

from conftest import srt
from pairs import pair_counts
from promolens.functions import minus_lookback
from promolens.operators.window_join import Source, count_in_window, count_in_windows


def _probes(spark, rows):
    df = spark.createDataFrame(rows, "pid int, k string, hi string")
    return df.withColumn("lo", minus_lookback("hi"))


def _touches(spark, rows):
    return spark.createDataFrame(rows, "tk string, g string, t string")


def _counts(df, how="inner"):
    """Nonzero counts per (probe, group); for left joins also the probe ids present."""
    agg = df.groupBy("pid", "g").agg(F.sum("n").alias("n"))
    got = srt((r["pid"], r["g"], r["n"]) for r in agg.collect() if r["n"])
    if how == "left":
        return got, sorted({r["pid"] for r in df.select("pid").collect()})
    return got


def run(probes, touches, strategy, compare="string", how="inner", **kw):
    join = pair_counts if strategy == "pairs" else count_in_window
    if "split" not in kw:
        kw["groups"] = ["g"]
    return join(probes, touches, on=[("k", "tk")], lo="lo", hi="hi", at="t", compare=compare, how=how, **kw)


XY = ("g", ["x", "y"])


@pytest.mark.parametrize("compare", ["string", "timestamp"])
def test_window_is_half_open(spark, compare):
    p = _probes(spark, [(1, "a", "2024-01-02 12:00:00")])
    t = _touches(spark, [
        ("a", "x", "2024-01-01 12:00:00"),   # exactly 24 h before: in
        ("a", "x", "2024-01-01 11:59:59"),   # 1 s too early: out
        ("a", "x", "2024-01-02 11:59:59"),   # 1 s before: in
        ("a", "x", "2024-01-02 12:00:00"),   # the order's own second: out
        ("a", "x", "2024-01-02 00:30:00"),   # in a part between those of both ends
        ("b", "x", "2024-01-02 11:00:00"),   # other key
        (None, "x", "2024-01-02 11:00:00"),  # null key never joins
    ])
    for strategy in ("lookups", "pairs"):
        assert _counts(run(p, t, strategy, compare)) == [(1, "x", 3)]


def test_non_canonical_touch_time_still_compared_as_text(spark):
    # the reference compares text: '2024-01-02 1' sorts inside the window
    p = _probes(spark, [(1, "a", "2024-01-02 12:00:00")])
    t = _touches(spark, [("a", "x", "2024-01-02 1"), ("a", "x", "zzz"), ("a", "x", None)])
    assert _counts(run(p, t, "lookups")) == _counts(run(p, t, "pairs")) == [(1, "x", 1)]


def test_left_keeps_unmatched_probes_once(spark):
    p = _probes(spark, [(1, "a", "2024-01-02 12:00:00"), (2, "z", "2024-01-02 12:00:00"), (3, "a", "bad")])
    t = _touches(spark, [("a", "x", "2024-01-02 11:00:00"), ("a", "y", "2024-01-01 13:00:00")])
    out = run(p, t, "lookups", how="left")
    per_probe = {r["pid"]: r["n"] for r in out.groupBy("pid").agg(F.sum("n").alias("n")).collect()}
    assert _counts(out, "left") == _counts(run(p, t, "pairs", how="left"), "left")
    assert per_probe == {1: 2, 2: 0, 3: 0}
    assert out.where("pid = 2").count() == 1 and out.where("pid = 3").count() == 1


def test_duplicate_probes_count_separately(spark):
    p = _probes(spark, [(1, "a", "2024-01-02 12:00:00"), (1, "a", "2024-01-02 12:00:00")])
    t = _touches(spark, [("a", "x", "2024-01-02 11:00:00")])
    assert _counts(run(p, t, "lookups")) == [(1, "x", 2)]


def _random_case(seed):
    rnd = random.Random(seed)
    keys = ["a", "b", "c"]

    def stamp():
        if rnd.random() < 0.05:
            return rnd.choice(["2024-01-02 1", "2024-01-0z 00:00:00", "bad", None])
        day = rnd.randint(1, 3)
        return f"2024-01-0{day} {rnd.randint(0, 23):02d}:{rnd.choice([0, 0, 30, 59]):02d}:{rnd.choice([0, 1, 59]):02d}"

    probes = [(i, rnd.choice(keys), stamp()) for i in range(40)]
    touches = [(rnd.choice(keys + [None]), rnd.choice(["x", "y"]), stamp()) for _ in range(300)]
    return probes, touches


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("compare", ["string", "timestamp"])
def test_lookups_equal_pairs_on_random_data(spark, seed, compare):
    probes, touches = _random_case(seed)
    p, t = _probes(spark, probes), _touches(spark, touches)
    expected = _counts(run(p, t, "pairs", compare))
    assert expected, "the random case should produce matches"
    assert _counts(run(p, t, "lookups", compare)) == expected
    assert _counts(run(p, t, "lookups", compare, preaggregate=False)) == expected
    assert _counts(run(p, t, "lookups", compare, expand="probes")) == expected
    for expand in ("windows", "probes"):
        assert _counts(run(p, t, "lookups", compare, split=XY, expand=expand)) == expected
    assert _counts(run(p, t, "lookups", compare, how="left", expand="probes", split=XY), "left") == \
        _counts(run(p, t, "pairs", compare, how="left"), "left")
    left = _counts(run(p, t, "lookups", compare, how="left"), "left")
    assert left == _counts(run(p, t, "pairs", compare, how="left"), "left")
    assert left[1] == list(range(40))


@pytest.mark.parametrize("zone,hours", [
    ("America/Santiago", ["2024-09-08 00:30:00", "2024-09-08 01:30:00", "2024-04-06 23:30:00"]),   # gap at midnight, repeated hour
    ("Europe/Berlin", ["2024-03-31 02:30:00", "2024-03-31 03:10:00", "2024-10-27 02:30:00"]),
])
@pytest.mark.parametrize("compare", ["string", "timestamp"])
def test_clock_changes_of_the_session_zone(spark, zone, hours, compare):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        p = _probes(spark, [(i, "a", h) for i, h in enumerate(hours)])
        days = sorted({h[:10] for h in hours})
        stamps = [f"{d} {h:02d}:{m:02d}:00" for d in days for h in range(0, 5) for m in (10, 30)]
        before = ["2024-09-07 10:00:00", "2024-04-05 23:40:00", "2024-03-30 03:00:00", "2024-10-26 02:45:00"]
        t = _touches(spark, [("a", "x", s) for s in stamps + before])
        want = _counts(run(p, t, "pairs", compare))
        assert want and _counts(run(p, t, "lookups", compare)) == want
        assert _counts(run(p, t, "lookups", compare, expand="probes")) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _once(df):
    return srt({(pid, g) for pid, g, n in _counts(df) if n})


@pytest.mark.parametrize("seed", [4, 5, 6])
@pytest.mark.parametrize("compare", ["string", "timestamp"])
def test_once_is_existence(spark, seed, compare):
    probes, touches = _random_case(seed)
    p, t = _probes(spark, probes), _touches(spark, touches)
    want = _once(run(p, t, "pairs", compare))
    for kw in ({"expand": e, **s} for e in ("windows", "probes") for s in ({}, {"split": XY})):
        got = _counts(run(p, t, "lookups", compare, once=True, **kw))
        assert [(pid, g) for pid, g, _ in got] == want and {n for *_, n in got} == {1}
    left = run(p, t, "lookups", compare, how="left", once=True)
    assert _once(left) == want and {r["pid"] for r in left.collect()} == set(range(40))


def test_windows_of_any_text_and_length(spark):
    texts = ["", "2", "2023-12-31", "2024-01-0", "2024-01-01 09:59:59", "2024-01-01 1", "2024-01-01 10", "2024-01-01 10:00:00", "2024-01-01 10x",
             "2024-01-0:", "2024-01-10 00:00:00", "2024-02-01 12:30:00", "z", "\u00e9", "\U0001f600"]
    p = spark.createDataFrame([(i * 100 + j, "a", lo, hi) for i, lo in enumerate(texts) for j, hi in enumerate(texts)],
                              "pid int, k string, lo string, hi string")
    t = _touches(spark, [("a", g, x) for x in texts for g in ("x", None)] + [("a", "x", texts[3])])
    want = _counts(run(p, t, "pairs"))
    assert len(want) > 100 and _counts(run(p, t, "lookups")) == want
    assert _once(run(p, t, "lookups", once=True)) == _once(run(p, t, "pairs"))


def test_several_sources_add_up(spark):
    probes, touches = _random_case(7)
    p, t = _probes(spark, probes).withColumn("k2", F.when(F.col("pid") % 3 > 0, F.col("k"))), _touches(spark, touches)
    one, two = t.where("g = 'x'"), t.where("g = 'y'")
    sources = [Source(one, [("k", "tk")], "lo", "hi", "t"), Source(two, [("k2", "tk"), ("k", "tk")], "lo", F.lit("2024-01-02 06"), "t")]
    plain = dict(lo="lo", at="t", groups=["g"])
    p2 = p.withColumn("six", F.lit("2024-01-02 06"))
    a = pair_counts(p2, one, on=[("k", "tk")], hi="hi", **plain)
    b = pair_counts(p2, two, on=[("k2", "tk")], hi="six", **plain)
    want = _counts(a.unionByName(b))
    assert want and _counts(count_in_windows(p, sources, groups=["g"])) == want
    assert _once(count_in_windows(p, sources, groups=["g"], once=True)) == _once(a.unionByName(b))
    assert _counts(count_in_windows(p, sources, split=XY)) == want
    assert _once(count_in_windows(p, sources, split=XY, once=True)) == _once(a.unionByName(b))


def test_unexpected_split_value_stops(spark):
    p, t = _probes(spark, [(1, "a", "2024-01-02 12:00:00")]), _touches(spark, [("a", "z", "2024-01-02 11:00:00")])
    with pytest.raises(Exception, match="unexpected g: z"):
        run(p, t, "lookups", split=XY).collect()


def test_left_rows_without_a_key_are_spread(spark):
    """Probes without a key or a time are a third of all and stay apart from each other."""
    p = _probes(spark, [(i, None if i % 2 else "a", "bad") for i in range(200)] + [(i, "a", "2024-01-02 12:00:00") for i in range(200, 210)])
    t = _touches(spark, [("a", "x", "2024-01-02 11:00:00")])
    out = run(p, t, "lookups", how="left", expand="probes", split=XY)
    got = {(r["pid"], r["n"]) for r in out.groupBy("pid").agg(F.sum("n").alias("n")).collect()}
    assert got == {(i, 0) for i in range(200)} | {(i, 1) for i in range(200, 210)}
    with pytest.raises(ValueError):
        run(p, t, "lookups", how="left", expand="probes")


def test_two_lookups_for_each_window(spark):
    """Rows that the lookups make: two for each window, however long the windows are; with groups of unknown
    values two for each that its key has."""
    p = spark.createDataFrame([(i, "a", "2020-01-01 00:00:00", f"2024-01-01 00:00:{i:02d}") for i in range(50)]
                              + [(i, "c", "2020-01-01 00:00:00", "2024-01-01 00:00:00") for i in range(50, 90)], "pid int, k string, lo string, hi string")
    t = _touches(spark, [("a", g, f"202{y}-03-01 00:00:00") for g in "xy" for y in range(4)])
    for kw, rows in (({"split": XY}, 51 * 2), ({}, 50 * 2 * 2)):
        df = run(p, t, "lookups", **kw)
        assert _counts(df) == [(i, g, 4) for i in range(50) for g in "xy"]
        assert "sequence(" not in df._jdf.queryExecution().executedPlan().toString()
        assert rows in _metric(df, "Generate")
        assert max(_metric(df, "Sort")) <= rows + 8


def _metric(df, *names):
    """Output rows of such nodes (of nodes without that metric: of their child) in the final plan."""
    df.collect()
    out, plan = [], df._jdf.queryExecution().executedPlan()

    def rows_of(node):
        m = node.metrics()
        if m.contains("numOutputRows"):
            return m.apply("numOutputRows").value()
        if m.contains("shuffleRecordsWritten"):
            return m.apply("shuffleRecordsWritten").value()
        below = [*_children(node)]
        return rows_of(below[0]) if below else 0

    def _children(node):
        it = node.children().iterator()
        while it.hasNext():
            yield it.next()
        for inner in ("plan", "finalPhysicalPlan"):
            try:
                yield getattr(node, inner)()
            except Exception:  # noqa: BLE001
                pass

    def walk(node):
        if node.nodeName() in names:
            out.append(rows_of(node))
        for c in _children(node):
            walk(c)
    walk(plan.finalPhysicalPlan())
    return out


@pytest.mark.parametrize("stamp", ["2024-01-{d:02d} {h:02d}:{m:02d}:{s:02d}", "{d:02d}/01/2024 {h:02d}:{m:02d}:{s:02d}"])
def test_hot_key_with_any_time_format_is_spread(spark, stamp):
    """A third of all touches on one key, canonical or not: no task of the lookups reads more than
    four times the median."""
    rnd = random.Random(3)

    def at(form):
        return form.format(d=rnd.randint(1, 2), h=rnd.randint(0, 23), m=rnd.randint(0, 59), s=rnd.randint(0, 59))
    touches = [("hot", "x", at(stamp)) for _ in range(3000)] + [(f"k{rnd.randint(0, 300)}", "x", at("2024-01-{d:02d} {h:02d}:{m:02d}:{s:02d}")) for _ in range(6000)]
    probes = [(i, "hot" if i % 3 == 0 else f"k{i % 300}", "2024-01-02 12:00:00") for i in range(600)]
    p, t = _probes(spark, probes), _touches(spark, touches).repartition(8)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert _counts(run(p, t, "lookups")) == _counts(run(p, t, "pairs"))
        from promolens.operators.window_join import _touch_side
        side = _touch_side(Source(t, [("k", "tk")], "lo", "hi", "t"), ["__k0"], [], XY, "string", None, True)
        dealt = side.repartition(8, "__k0", "__p").groupBy(F.spark_partition_id()).count().collect()
        sizes = sorted(r["count"] for r in dealt)
        assert len(sizes) == 8 and sizes[-1] <= 4 * sizes[3]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
