import datetime as dt

import pytest

from promolens import catalog
from promolens.operators.extract import extract_orders, extract_touches
from promolens.plans.profiles import DAILY, HISTORY
from promolens.sources import fixtures
from promolens.sources.tables import read_tracks

SF = "/root/testdata/sf0.001"
T = dt.date(2024, 1, 10)


@pytest.fixture(autouse=True, scope="module")
def whole_paths(spark):
    """Scans show their whole path and filters."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _scan_lines(plan):
    return [ln for ln in plan.splitlines() if "FileScan" in ln or "Scan parquet" in ln]


@pytest.fixture(scope="module")
def partitioned_tracks(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tracks") / "t")
    fixtures.inputs(spark, SF)["tracks"].write.partitionBy("ds").parquet(path)
    return read_tracks(spark, path)


def test_touch_scan_prunes_partitions_and_pushes_filters(partitioned_tracks):
    plan = _plan(extract_touches(partitioned_tracks, T, DAILY))
    scan = " ".join(_scan_lines(plan))
    assert "PartitionFilters: [isnotnull(ds" in scan and "2024-01-08" in scan
    assert "EqualTo(path,/vip)" in scan and "IsNotNull(usr.uid)" in scan


def test_order_scan_reads_only_needed_nested_fields(partitioned_tracks):
    plan = _plan(extract_orders(partitioned_tracks, T, HISTORY))
    scan = " ".join(_scan_lines(plan))
    schema = scan[scan.index("ReadSchema"):]
    assert "site_id" in schema and "uid" in schema
    assert "user_id" not in schema and "fragment" not in schema and "device" not in schema


def _scan_metrics(df):
    """numFiles / numPartitions of the scans in the final adaptive plan."""
    out = []

    def walk(node):
        if "Scan" in node.nodeName():
            m = node.metrics()
            out.append({k: m.apply(k).value() for k in ("numFiles", "numPartitions") if m.contains(k)})
        it = node.children().iterator()
        while it.hasNext():
            walk(it.next())
        try:
            walk(node.plan())                    # query stages wrap their plan
        except Exception:  # noqa: BLE001
            pass

    plan = df._jdf.queryExecution().executedPlan()
    walk(plan.finalPhysicalPlan() if hasattr(plan, "finalPhysicalPlan") else plan)
    return out


def test_partition_pruning_reads_only_the_window(spark, partitioned_tracks):
    df = extract_touches(partitioned_tracks, T, DAILY)   # ds in [T-2, T): two days of hours
    df.collect()
    scans = _scan_metrics(df)
    assert scans and all(m["numPartitions"] <= 48 for m in scans)
    assert all(m["numFiles"] * 5 < len(partitioned_tracks.inputFiles()) for m in scans)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_cartesian_or_nested_loop_joins(spark, name):
    plan = _plan(catalog.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_volume_report_uses_anti_join(spark):
    plan = _plan(catalog.queries()["volume_report"](spark, SF))
    assert "LeftAnti" in plan


def _scans(df):
    """Paths of the Parquet scans in the final adaptive plan; a reused exchange is no scan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return [ln for ln in final.splitlines() if "FileScan" in ln]


@pytest.mark.parametrize("by", ["origin", "global"])
def test_attributed_sales_scan_each_input_once(spark, tmp_path, by):
    from promolens.plans.mart import _probe_windows, attributed_sales
    day = catalog.ANALYSIS_DATE   # a day with sales: adaptive execution drops the scans of an empty result
    for name, df in fixtures.inputs(spark, "/root/testdata/sf0.01").items():
        df.write.parquet(str(tmp_path / name))
    tracks, bids = (spark.read.parquet(str(tmp_path / n)) for n in ("tracks", "bids"))
    staging = _scans(_probe_windows(bids, extract_orders(tracks, day, DAILY), day, DAILY, []))
    assert len([s for s in staging if "/bids" in s]) == 1 and len([s for s in staging if "/tracks" in s]) == 1
    scans = _scans(attributed_sales(tracks, bids, day, DAILY, by, stage_path=str(tmp_path / "staged")))
    assert not [s for s in scans if "/bids" in s]
    assert len([s for s in scans if "/tracks" in s]) == 1   # the touches


def test_backfill_pushes_literal_days_into_the_scan(spark, tmp_path):
    from promolens.plans.mart import backfill
    i = fixtures.inputs(spark, SF)
    i["bids"].write.partitionBy("ord_created_dt").parquet(str(tmp_path / "bids"))
    bids = spark.read.parquet(str(tmp_path / "bids"))
    plan = _plan(backfill(i["tracks"], bids, [T, T + dt.timedelta(days=1)], by="origin"))
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "/bids" in ln]
    assert scans
    for scan in scans:
        assert "2024-01-09" in scan[scan.index("PartitionFilters"):scan.index("PushedFilters")]
        assert "tim_day_winning_date,2024-01-09" in scan or "In(tim_day_winning_date" in scan


@pytest.mark.parametrize("order_key", ["number", "text"])
def test_gmv_report_scans_the_sale_lines_once(spark, tmp_path, order_key):
    from promolens.plans.reports import gmv_report
    for name, df in fixtures.inputs(spark, "/root/testdata/sf0.01").items():
        df.write.parquet(str(tmp_path / name))
    tracks, bids = (spark.read.parquet(str(tmp_path / n)) for n in ("tracks", "bids"))
    scans = _scans(gmv_report(tracks, bids, catalog.ANALYSIS_DATE, order_key=order_key))
    assert len([s for s in scans if "/bids" in s]) == 1
    assert len([s for s in scans if "/tracks" in s]) == 2   # touches and orders


def test_volume_report_reads_touches_and_orders_once(spark, tmp_path):
    from promolens.plans.reports import volume_report
    for name, df in fixtures.inputs(spark, "/root/testdata/sf0.01").items():
        df.write.parquet(str(tmp_path / name))
    tracks, customers = (spark.read.parquet(str(tmp_path / n)) for n in ("tracks", "customers"))
    scans = _scans(volume_report(tracks, customers, catalog.ANALYSIS_DATE))
    assert len([s for s in scans if "/tracks" in s]) == 2 and len([s for s in scans if "/customers" in s]) == 1


def test_a_run_without_a_date_prunes_partitions(spark, partitioned_tracks):
    today = spark.sql("SELECT current_date()").first()[0]
    for df in (extract_touches(partitioned_tracks, None, DAILY), extract_orders(partitioned_tracks, None, DAILY)):
        scan = " ".join(_scan_lines(_plan(df)))
        filters = scan[scan.index("PartitionFilters"):scan.index("PushedFilters")]
        assert today.isoformat() in filters and "current_date" not in filters
